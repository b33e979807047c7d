import itertools
import math
import random

import numpy as np
import pytest
from public_tokenizers import path
from pyspark.sql import functions as F

from lexiframe.llm import language, queries
from lexiframe.llm.language import PieceModel, Vocabulary, fit_pieces, identify, keep_languages

from .cases import MEDIUM, documents, edge_docs


def tiny():
    vocabulary = Vocabulary({p: i for i, p in enumerate(["▁", "▁a", "a", "b", "ab", "ba", "▁ab", "bab", "c"])})
    rng = np.random.default_rng(1)
    chances = rng.uniform(0.01, 0.2, (10, 3))
    return PieceModel(vocabulary, ["x", "y", "z"], chances)


def brute(model, word):
    marked, total = "▁" + word, np.zeros(len(model.languages))
    for cuts in itertools.product([0, 1], repeat=len(marked) - 1):
        ends = [i + 1 for i, c in enumerate(cuts) if c] + [len(marked)]
        parts = [marked[a:b] for a, b in zip([0, *ends], ends)]
        known = model.vocabulary.pieces
        if all(p in known or len(p) == 1 for p in parts):
            total += np.prod([model.chances[known.get(p, model.vocabulary.unknown)] for p in parts], axis=0)
    return np.log(total)


@pytest.mark.parametrize("word", ["a", "b", "ab", "abab", "bababab", "axb", "cc", "qq", "aabbab"])
def test_sums_all_segmentations(word):
    model = tiny()
    assert np.allclose(model.score_words([word])[0], brute(model, word))
    assert np.allclose(model._long("▁" + word), brute(model, word))


def test_long_words_go_on_smoothly():
    model = tiny()
    for n in (39, 40, 5000):
        assert np.isfinite(model.score_words(["ab" * n])).all()
    assert np.allclose(model._long("▁" + "ab" * 15), model.score_words(["ab" * 15])[0])


def test_expectations_raise_likelihood(spark):
    counts = {("x", "abab"): 5, ("x", "bab"): 3, ("y", "cc"): 4, ("y", "ca"): 2, ("x", "ca"): 1}
    words = sorted({w for _, w in counts})
    rows = [(w, [float(counts.get((lang, w), 0)) for lang in "xy"]) for w in words]
    table = spark.createDataFrame(rows, "word string, weights array<double>").repartition(3)
    last, chances = -math.inf, np.full((10, 2), 0.1)
    for rounds in (1, 2, 4):
        model = fit_pieces(table, ["x", "y"], tiny().vocabulary, rounds, prior=1e-6)
        total = sum(n * model.score_words([w])[0, model.languages.index(lang)] for (lang, w), n in counts.items())
        assert total > last
        last = total
        assert np.allclose(model.chances.sum(0), 1)
        if rounds == 1:  # the uses summed over every segmentation, one by one
            used = np.zeros((10, 2))
            for (lang, w), n in counts.items():
                marked, known = "▁" + w, tiny().vocabulary.pieces
                ways = []
                for cuts in itertools.product([0, 1], repeat=len(marked) - 1):
                    ends = [i + 1 for i, c in enumerate(cuts) if c] + [len(marked)]
                    parts = [marked[i:j] for i, j in zip([0, *ends], ends)]
                    if all(p in known or len(p) == 1 for p in parts):
                        ways.append([known.get(p, 9) for p in parts])
                shares = np.array([np.prod([chances[p, 0] for p in way]) for way in ways])
                for way, share in zip(ways, shares / shares.sum()):
                    for p in way:
                        used[p, "xy".index(lang)] += n * share
            used[9] = 0
            pooled = used.sum(1, keepdims=True) + 0.01
            mixed = used + 1e-6 * pooled / pooled.sum()
            assert np.allclose(model.chances, mixed / mixed.sum(0))


@pytest.fixture(scope="module")
def model(spark):
    return queries.language_model(spark, documents(spark, MEDIUM))


def test_held_out_accuracy(spark, model):
    docs = documents(spark, MEDIUM)
    got = identify(docs, model).withColumn("held", queries.held_out()).join(docs.select("doc_id", "lang"), "doc_id").where("held").collect()
    assert len(got) > 200
    assert sum(r["lang_pred"] == r["lang"] for r in got) >= 0.98 * len(got)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_predicts_from_text_alone(spark, model):
    docs = documents(spark, MEDIUM).limit(100)
    shuffled = docs.withColumn("lang", F.lit("zz")).withColumn("source", F.lit(None).cast("string"))
    one = {r["doc_id"]: tuple(r)[1:] for r in identify(docs, model).collect()}
    assert one == {r["doc_id"]: tuple(r)[1:] for r in identify(shuffled, model).collect()}


def test_edges(spark, model):
    docs = edge_docs(spark, keyed=False)
    got = identify(docs, model).collect()
    assert len(got) == docs.count()
    by_id = {r["doc_id"]: r for r in got}
    for k in (0, 1, 2, 16):
        assert (by_id[k]["lang_pred"], by_id[k]["score"], by_id[k]["fit"]) == ("und", 0.0, None)
    assert by_id[18]["lang_pred"] in model.languages
    assert identify(docs.limit(0), model).collect() == []
    assert {r["lang_pred"] for r in identify(docs, None).collect()} == {"und"}
    kept = keep_languages(docs.withColumn("lang_pred", F.lit("clash")), model)
    assert kept.columns == [*docs.columns, "lang_pred"]
    ids = [r["doc_id"] for r in kept.collect()]
    assert not {0, 1, 2, 16} & set(ids) and {6, 9, 13} <= set(ids) and ids.count(6) == 3


def test_nothing_to_learn_from(spark):
    docs = edge_docs(spark).withColumn("lang", F.lit(None).cast("string"))
    assert language.fit_language_model(docs, tiny().vocabulary) is None


def test_small_and_unsegmented_languages_are_learned(spark):
    rng = random.Random(4)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(rng.randint(2, 8)))
    rows = [("big", " ".join(word("abcdefghij") for _ in range(1000))) for _ in range(220)]
    rows += [("tiny", " ".join(word("qrstuvw") for _ in range(30))) for _ in range(5)]
    rows += [("zz", "".join(rng.choice("一二三人大小天") for _ in range(150))) for _ in range(5)]
    docs = spark.createDataFrame([(i, t, k) for i, (k, t) in enumerate(rows)], "doc_id long, text string, lang string")
    vocabulary = Vocabulary({p: i for i, p in enumerate(["▁", *"abcdefghijqrstuvw", *"一二三人大小天"])})
    model = language.fit_language_model(docs, vocabulary)
    assert model.languages == ["big", "tiny", "zz"]
    new = spark.createDataFrame([(1, "qrs tuv wrs"), (2, "大小天" * 30), (3, "abc hij")], "doc_id long, text string")
    assert {r["doc_id"]: r["lang_pred"] for r in identify(new, model).collect()} == {1: "tiny", 2: "zz", 3: "big"}
    few = language.fit_language_model(docs, vocabulary, max_docs=60)
    assert few.languages == ["big", "tiny", "zz"]


def test_vocabulary_covers_letters_only():
    vocabulary = Vocabulary.from_file(path("piece_bpe_32k.model"))
    assert len(vocabulary.pieces) > 15_000 and "▁the" in vocabulary.pieces
    assert not any(ch.isdigit() for p in vocabulary.pieces for ch in p)
