"""Checks of the third round: work that was done twice, and frequent terms found without shuffling all."""

from pyspark.sql import functions as F

from lexiframe.functions import tokens as tk
from lexiframe.functions.syllables import GLIDES_WIDE, SOUNDED, SYLLABLE_EXCEPTIONS, syllables_refined
from lexiframe.operators import corpus
from lexiframe.operators import lexicons as lx
from lexiframe.operators import stylometry as sty


def test_mean_works_its_values_out_once(spark):
    rows = spark.createDataFrame([(["a", "bb", "ccc"],), ([],)], "t array<string>")
    values = F.transform("t", lambda w: F.length(w))
    assert [r[0] for r in rows.select(sty.mean_of(values)).collect()] == [2.0, None]

    def times(column):
        return rows.select(column.alias("v"))._jdf.queryExecution().optimizedPlan().toString().count("length(")

    assert times(sty.mean_of(values)) == times(values) == 1


def test_refined_syllables_count_vowels_less_glides(spark):
    words = ["".join(w) for w in ("iao", "ieo", "uouo", "queue", "io", "radio", "ieieie", "yuoa", "b", "area", "ooo", "ia")]
    rows = spark.createDataFrame([(w,) for w in words], "w string")
    found = {r["w"]: r["n"] for r in rows.select("w", F.regexp_count("w", F.lit(SOUNDED)).alias("n")).collect()}
    assert found == {w: sum(map("aeiouy".count, w)) - sum(w.count(g) for g in GLIDES_WIDE) for w in words}
    known = spark.createDataFrame([(w,) for w in SYLLABLE_EXCEPTIONS], "w string")
    found = {r["w"]: r["n"] for r in known.select("w", syllables_refined(F.col("w")).alias("n")).collect()}
    assert found == SYLLABLE_EXCEPTIONS


def test_ngrams_of_short_and_missing_tokens(spark):
    rows = spark.createDataFrame([(1, ["a", "b", "c", "d"]), (2, ["a", "b"]), (3, []), (4, None)], "id int, t array<string>")
    found = {r["id"]: r[1:] for r in rows.select("id", tk.ngrams(F.col("t"), 2), tk.ngrams(F.col("t"), 3), tk.ngrams_upto(F.col("t"), 3)).collect()}
    assert found[1] == (["a b", "b c", "c d"], ["a b c", "b c d"], ["a", "b", "c", "d", "a b", "b c", "c d", "a b c", "b c d"])
    assert found[2] == (["a b"], [], ["a", "b", "a b"])
    assert found[3] == ([], [], []) and found[4] == ([], [], None)


def test_frequent_vocabulary_counts_few_terms_exactly(spark, monkeypatch):
    common = [(i, [f"w{k}" for k in range(12) for _ in range(12 - k)] + [f"rare{i}x{j}" for j in range(20)]) for i in range(30)]
    docs = spark.createDataFrame([*common, (1, ["w0", "w1"]), (None, None), (99, [])], "doc_id long, t array<string>")
    terms = lx.term_rows(docs, tk.ngrams_upto(F.col("t"), 2))
    counted = []
    whole = corpus.vocabulary
    monkeypatch.setattr(corpus, "vocabulary", lambda t, *a, **k: counted.append(t.distinct().count()) or whole(t, *a, **k))
    for top_k, options in ((6, {}), (6, {"min_df": 2, "max_df": 0.8}), (40, {"min_df": 2}), (5_000, {})):
        found = corpus.frequent_vocabulary(docs, F.col("t"), 2, 33, top_k, **options).collect()
        assert found == whole(terms, 33, top_k=top_k, **options).collect()
    assert counted[0] < terms.count() / 3  # the rare runs were never counted as terms
    assert corpus.frequent_vocabulary(docs.limit(0), F.col("t"), 2, 0, 3).collect() == []
