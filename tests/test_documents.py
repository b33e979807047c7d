import math

from pyspark.sql import functions as F

from lexiframe.functions import tokens as tk
from lexiframe.operators import corpus
from lexiframe.operators import hygiene as hy
from lexiframe.operators import lexicons as lx
from lexiframe.operators import stylometry as sty
from lexiframe.operators import tagged as tg
from lexiframe.operators import topics as tp
from lexiframe.operators.automaton import category_hits
from lexiframe.plans.catalogue import clean_catalogue


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_style_record_by_hand(spark):
    text = "The cat sat. The Dog ran away (fast)! Said he; 'no'.\n\nShe shall go on and on..."
    row = sty.style_record(docs(spark, text, "", "word")).orderBy("doc_id").collect()
    assert row[0]["avg_sentence_length"] == (3 + 5 + 3 + 6) / 4
    assert row[0]["max_sentence_length"] == 6.0 and row[0]["median_sentence_length"] == 4.0
    assert row[0]["parentheses"] == 2.0 and row[0]["ellipses"] == 1.0 and row[0]["semicolons"] == 1.0
    assert row[0]["avg_paragraph_length"] == 8.5 and row[0]["var_paragraph_length"] == 6.25
    assert row[0]["romanticism/gothic_markers"] == 1.0
    assert row[0]["capitalized_words"] > 0 and row[0]["sentence_fragments"] == 50.0
    blank = row[1].asDict()
    assert all(v == 0.0 for k, v in blank.items() if k != "doc_id")
    assert row[2]["type_token_ratio"] == 1.0 and row[2]["mattr"] == 1.0
    assert len(row[0]) - 1 == 39


def test_moving_ratio_windows(spark):
    words = [f"w{chr(97 + i % 7)}" for i in range(2200)]
    got = docs(spark, " ".join(words)).select(
        sty.moving_type_token_ratio(tk.letter_tokens(F.col("text")), 1000).alias("m")
    ).first()["m"]
    starts = range(0, 2200 - 1000, 500)
    assert math.isclose(got, sum(len(set(words[i : i + 1000])) / 1000 for i in starts) / len(starts))


def test_substring_counts_match_str_count(spark):
    text, terms = "the art of hearts, art arts", ["art", "heart", "art", "zz"]
    got = docs(spark, text).select(category_hits(F.col("text"), {"all": terms, "none": []}).alias("n")).first()["n"]
    assert got == [sum(text.count(t) for t in terms), 0]


def test_collocations_and_merge(spark):
    filler = " ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200))
    tokens = docs(spark, ("new york " + filler + " ") * 4).select("doc_id", tk.letter_tokens(F.col("text")).alias("tokens"))
    # every pair appears 4 times and every word 4 times: (4 - 2) / 4 / 4 * V
    found = corpus.collocations(tokens).collect()
    by_pair = {(r["a"], r["b"]): r for r in found}
    words = 202
    size = words + 202
    assert math.isclose(by_pair["new", "york"]["score"], 2 / 4 / 4 * size)
    merged = corpus.merge_collocations(tokens).first()["tokens"]
    assert merged[0] == "new_york" and len(merged) == 404


def test_tfidf_rows_have_length_one(spark):
    terms = lx.term_rows(docs(spark, "a b b c", "b c", "c d"), tk.words(F.col("text")))
    vocab = corpus.vocabulary(terms, 3, min_df=1, max_df=1.0, top_k=3)
    assert [r["term"] for r in vocab.collect()] == ["b", "c", "a"]
    rows = corpus.tfidf(terms, vocab, 3).collect()
    for d in {r["doc_id"] for r in rows}:
        assert math.isclose(sum(r["weight"] ** 2 for r in rows if r["doc_id"] == d), 1.0)


def test_dictionary_extremes(spark):
    units = spark.createDataFrame([(["a", "a", "b"],), (["a", "c"],), (["b"],), (["d"],)], "tokens array<string>")
    assert {r["term"] for r in corpus.unit_dictionary(units, no_below=2, no_above=0.5).collect()} == {"a", "b"}


def test_expansion_and_scores(spark):
    seeds = spark.createDataFrame([("c", "big"), ("c", "sad")], "category string, term string")
    edges = spark.createDataFrame(
        [("big", 1, "synonym", "Large"), ("big", 4, "synonym", "fat"), ("big", 2, "hypernym", "great_size")],
        "term string, sense_rank int, relation string, related string",
    )
    assert {r["term"] for r in lx.expand_terms(seeds, edges).collect()} == {"big", "sad", "large", "great size"}
    assert {r["term"] for r in lx.expand_terms(seeds, edges, depth=0).collect()} == {"big", "sad", "large"}
    terms = lx.term_rows(docs(spark, "x x x y y y y z"), tk.words(F.col("text")))
    lexicon = spark.createDataFrame([("p", "x"), ("q", "y"), ("p", "y")], "category string, term string")
    row = lx.category_scores(terms, lexicon, ["p", "q"]).first()
    assert math.isclose(row["p_term_score"], 7 / 5) and math.isclose(row["q_term_score"], 4 / 5)


def test_sentiment_negation_and_silence(spark):
    moods = spark.createDataFrame([("good", 0.8, 0.6)], "term string, polarity double, subjectivity double")
    tokens = docs(spark, "good", "not good", "nothing").select("doc_id", tk.letter_tokens(F.col("text")).alias("tokens"))
    rows = {r["doc_id"]: r for r in lx.sentiment(tokens, moods).collect()}
    assert rows[0]["sentiment_polarity"] == 0.8 and rows[1]["sentiment_polarity"] == -0.4
    assert rows[2]["sentiment_polarity"] == 0.0 and rows[1]["sentiment_subjectivity"] == 0.6


def test_mean_vectors(spark):
    d = docs(spark, "a a b", "zzz")
    vectors = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [4.0, 3.0])], "term string, vector array<double>")
    means = lx.mean_vectors(lx.term_rows(d, tk.words(F.col("text"))), vectors, d, 2)
    assert {r["doc_id"]: list(r["vector"]) for r in means.collect()} == {0: [2.0, 1.0], 1: [0.0, 0.0]}


def test_mean_vectors_in_blocks(spark, monkeypatch):
    """Missing numbers are zeros, listed twice counts twice, and blocks of any size give the same means."""
    d = docs(spark, "a a b", "zzz", "b c c c", "n", "a n")
    rows = [("a", [1.0, 0.0]), ("b", [4.0, 3.0]), ("b", [2.0, 1.0]), ("c", [None, 6.0]), ("n", None)]
    vectors = spark.createDataFrame(rows, "term string, vector array<double>")
    terms = lx.term_rows(d, tk.words(F.col("text")))
    want = {0: [2.0, 1.0], 1: [0.0, 0.0], 2: [1.2, 4.4], 3: [0.0, 0.0], 4: [0.5, 0.0]}
    for size in (1, 1_000_000):
        monkeypatch.setattr(lx, "VECTOR_BLOCK_TERMS", size)
        assert {r["doc_id"]: [round(x, 9) for x in r["vector"]] for r in lx.mean_vectors(terms, vectors, d, 2).collect()} == want
    for some in (vectors.limit(0), vectors.where("term = 'none'"), spark.createDataFrame([("a", [1.0, 0.0])], vectors.schema)):
        found = {r["doc_id"]: list(r["vector"]) for r in lx.mean_vectors(terms, some, d, 2).collect()}
        assert found == {i: [float(some.count() and i in (0, 4)), 0.0] for i in range(5)}


def test_tagger_plug_point(spark):
    def tagger(batches):
        import pandas as pd

        for batch in batches:
            rows = [
                (d, 0, i, w, "VERB" if w.endswith("ed") else "NOUN", "VBD" if w.endswith("ed") else "NN", "dep")
                for d, t in zip(batch["doc_id"], batch["text"]) for i, w in enumerate(t.split())
            ]
            yield pd.DataFrame(rows, columns=["doc_id", "sent_no", "tok_no", "token", "pos", "tag", "dep"])

    tagged = tg.tag_with(docs(spark, "dogs barked loud things", "cats"), tagger)
    rows = {r["doc_id"]: r for r in tg.tagged_features(tagged, tg.word_class_shares() | tg.tense_shares()).collect()}
    assert rows[0]["verb_freq"] == 25.0 and rows[0]["past_tense_ratio"] == 100.0 and rows[1]["past_tense_ratio"] == 0.0


def test_topics_sum_to_one(spark):
    texts = ["red blue green " * 5, "cat dog bird " * 5] * 6
    tokens = docs(spark, *texts).select("doc_id", tk.words(F.col("text")).alias("tokens"))
    model = tp.fit_lda(tokens, tp.topic_count(12), passes=5)
    for r in tp.topic_vectors(model, tokens, floor=0.0).collect():
        assert math.isclose(sum(r["topics"]), 1.0, abs_tol=1e-6)
    for r in tp.mean_topic_vectors(model, tokens).collect():
        assert math.isclose(sum(r["topics"]), 1.0, abs_tol=1e-6)
    terms = lx.term_rows(tokens, F.col("tokens"))
    vocab = corpus.vocabulary(terms, 12, top_k=100)
    factors = tp.fit_factors(corpus.tfidf(terms, vocab, 12), k=2)
    assert all(min(r["factors"]) >= 0 for r in tp.factor_vectors(factors).collect())


def catalogue(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "seq long, book_id string, title string")


def test_catalogue_hygiene(spark):
    rows = [("1", "a"), (None, "b"), (" ", "c"), ("1", "d"), ("2", "a"), ("3", "e")]
    done = clean_catalogue(catalogue(spark, rows), "book_id")
    assert [r["seq"] for r in done.kept.orderBy("seq").collect()] == [0, 5]
    assert {r["seq"]: r["stage"] for r in done.dropped.collect()} == {1: "blank", 2: "blank", 3: "dup_key", 4: "dup_title"}
    assert list(done.counts.first()) == [6, 4, 3, 2]


def test_hygiene_with_one_hot_key(spark):
    rows = spark.range(3000).select(
        F.col("id").alias("seq"), F.when(F.col("id") < 1500, "hot").otherwise(F.col("id").cast("string")).alias("k")
    )
    assert hy.keep_first(rows, "k", "seq").count() == 1501
    assert hy.duplicates(rows, "k", "seq").count() == 1499


def test_small_table_helpers(spark):
    df = spark.createDataFrame([(1, "b", None, float("nan")), (2, "a", 3, 1.0)], "id int, c string, n int, x double")
    assert hy.numeric_columns(df, ["id"]) == ["n", "x"]
    assert [tuple(r) for r in hy.fill_zero(df).orderBy("id").collect()] == [(1, "b", 0, 0.0), (2, "a", 3, 1.0)]
    assert {r["c"]: r["label_code"] for r in hy.encode_labels(df, "c").collect()} == {"a": 0, "b": 1}
    assert hy.filter_if_present(df, "is_prose").count() == 2
    assert hy.head(df, "id", 1).first()["id"] == 1 and hy.head(df, "id", None).count() == 2
