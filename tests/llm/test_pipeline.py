import pytest
from public_tokenizers import path
from pyspark.sql import functions as F

import corpus_pipeline
from lexiframe.llm import decontaminate, language, queries
from lexiframe.session import materialize

from .cases import MEDIUM, documents, edge_docs
from .test_minhash import check
from .test_packing import binary_lengths, whole
from .test_secret_scan import brute as base_spans


@pytest.fixture(scope="module")
def tables(spark):
    """What each stage gets, and the last result."""
    docs, out = documents(spark, MEDIUM), []
    for name, stage in corpus_pipeline.STAGES:
        out.append(docs)
        docs = materialize(stage(spark, docs, MEDIUM), name)
    return [*out, docs]


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_columns(tables):
    for df in tables[:-1]:
        assert df.columns == tables[0].columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "benchmark", "secrets", "packing"]


def test_filters_keep_and_drop(spark, tables):
    first, spoken, single, clean, blanked, _ = tables
    judged = language.identify(first, queries.language_model(spark, first))
    assert set(rows(spoken)) == {r["doc_id"] for r in judged.collect() if r["lang_pred"] != "und" and r["fit"] >= -9}
    assert len(rows(spoken)) >= 0.99 * len(rows(first))
    check([(r["doc_id"], r["text"]) for r in spoken.collect()], set(rows(single)))  # five-word sets, every pair
    assert len({r["text"] for r in single.collect()}) == single.count()
    leaks = decontaminate.contaminated(single, spark.read.parquet(f"{MEDIUM}/benchmark.parquet"))
    assert set(rows(clean)) == set(rows(single)) - {r["doc_id"] for r in leaks.collect()}
    assert set(rows(blanked)) == set(rows(clean))


def test_secrets_go_and_nothing_else(tables):
    before, after = rows(tables[3]), rows(tables[4])
    changed = 0
    for k, r in before.items():
        found = base_spans(r["text"])
        new = after[k]["text"]
        assert not base_spans(new)
        if not found and new == r["text"]:
            assert after[k] == r
        else:
            changed += 1
            assert "[SECRET]" in new and after[k]["n_chars"] == len(new)
    assert 0 < changed <= sum(bool(base_spans(r["text"])) for r in before.values()) + 0.01 * len(before)


def test_packing_is_whole(tables):
    texts = rows(tables[4])
    got = tables[5].collect()
    want = sum(len(binary_lengths(len(w), 4096)) for w in whole([r["text"] for r in texts.values()]))
    assert len(got) == want and {r["doc_id"] for r in got} == set(texts)


def test_run(spark, tables):
    got = corpus_pipeline.run(spark, MEDIUM)
    assert sorted(map(str, got.collect())) == sorted(map(str, tables[5].collect()))


def test_odd_rows(spark):
    docs = edge_docs(spark, keyed=False).select("doc_id", "text", F.lit("en").alias("lang"), "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, MEDIUM), name)
    assert 9 in {r["doc_id"] for r in docs.collect()}
    empty = documents(spark).limit(0)
    for name, stage in corpus_pipeline.STAGES:
        empty = materialize(stage(spark, empty, MEDIUM), name)
    assert empty.count() == 0 and path("word_bpe_49k.json")
