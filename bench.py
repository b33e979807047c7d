"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from lexiframe import queries as registry  # noqa: E402
from lexiframe.session import local_session, scratch  # noqa: E402

HEADLINE = [
    "b03_keep_first",
    "b04_stage_counts",
    "c02_strip_boilerplate_lines",
    "d10_word_ngrams",
    "d12_merged_collocations",
    "f01_sentence_lengths",
    "f02_flesch_reading_ease",
    "f07_dale_chall",
    "f15_moving_type_token_ratio",
    "f17_word_classes",
    "f20_style_record",
    "g05_category_substrings",
    "g08_vocabulary_counts",
    "g10_sentiment",
    "g11_mean_word_vector",
    "h01_vocabulary",
    "h02_tfidf",
    "h05_bag_of_words",
    "i02_quantiles",
    "j02_two_step_split",
    "j04_oversample",
    "k01_anova_top",
    "k02_mutual_information_top",
    "l03_knn_vote",
    "m02_classification_report",
    "m06_silhouette",
    "n05_clean_catalogue",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    registry.load_all()
    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/documents.parquet").count()  # start the engine outside the timings
    seconds: dict[str, float] = {}
    for name in names:
        begun = time.perf_counter()
        with scratch(spark):
            registry.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begun, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name,
            }
        )
    )


if __name__ == "__main__":
    main()
