import itertools
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lexiframe.llm import minhash, simhash
from lexiframe.llm.minhash import drop_near_duplicates

from .cases import MEDIUM, documents, edge_docs, joined, prose


def grams(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate({c: " " for c in range(9, 14)}).split(" ")
    words = [w for w in words if w]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def alike(rows, least=0.8):
    sets = {k: grams(t) for k, t in rows}
    share = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    near = lambda a, b: min(len(a), len(b)) >= least * max(len(a), len(b)) and share(a, b) >= least
    return [(a, b) for a, b in itertools.combinations(sorted(sets), 2) if near(sets[a], sets[b])]


def check(rows, kept):
    """No two rows that are alike stay, and what goes is linked to something that stays."""
    links = alike(rows)
    assert not [p for p in links if set(p) <= kept]
    linked = set(kept)
    while more := {x for p in links if set(p) & linked for x in p} - linked:
        linked |= more
    assert linked == {k for k, _ in rows}
    return links


def planted():
    """Texts and a copy of each, at similarities from 0.8 to 0.98, and one at about 0.7."""
    rng, rows, want = random.Random(5), [], []
    for i in range(60):
        words = prose(i, 400).split(" ")
        changes = 18 if i % 10 == 9 else 1 + i % 7
        copy = list(words)
        for at in rng.sample(range(5, 395), changes):
            copy[at] = "changed"
        a, b = grams(" ".join(words)), grams(" ".join(copy))
        want.append(len(a & b) / len(a | b))
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(copy))]
    return rows, want


def test_stage_drops_planted_copies(spark):
    rows, shares = planted()
    assert min(shares) < 0.8 and max(shares) > 0.97 and sum(0.8 <= s < 0.9 for s in shares) > 10
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r["doc_id"] for r in corpus_pipeline.one_of_each(spark, docs, MEDIUM).collect()}
    assert kept == set(range(0, 120, 2)) | {2 * i + 1 for i, s in enumerate(shares) if s < 0.8}


@pytest.mark.parametrize("direct", [0, 32])
def test_like_all_pairs(spark, direct):
    docs = documents(spark, MEDIUM)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    kept = {r["doc_id"] for r in drop_near_duplicates(docs, direct=direct).collect()}
    assert len(check(rows, kept)) > 5


def test_crowded_group(spark):
    """Many near copies of one text, and many texts that share most of their words with others but are not alike."""
    rng, rows = random.Random(2), []
    base = prose(1, 300).split(" ")
    for i in range(150):
        copy = list(base)
        for at in rng.sample(range(300), 3 if i < 80 else 14):
            copy[at] = f"w{i}"
        rows.append((i, " ".join(copy)))
    kept = {r["doc_id"] for r in drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), direct=4).collect()}
    check(rows, kept)


def test_edges(spark):
    docs = edge_docs(spark, keyed=False)
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert None in ids and ids.count(6) == 3 and not {1, 2, 7, 8, 10} & set(ids) and {0, 9} <= set(ids)
    assert drop_near_duplicates(docs.limit(0)).collect() == []


def test_fingerprints_alone_drop_the_closest_copies(spark, monkeypatch):
    """The stage's SimHash step, without the other: what is at most 2 bits apart and alike goes, by brute force."""
    rows = planted()[0]
    bits = {k: simhash.majority(minhash.shingles(t, 5)) for k, t in rows}
    for _, t in rows[:3]:
        hashes = [int(h) for h in minhash.shingles(t, 5)]
        assert simhash.majority(minhash.shingles(t, 5)) == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    monkeypatch.setattr(minhash, "near_links", lambda sigs, *_: sigs.selectExpr("rep AS a", "rep AS b").limit(0))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r["doc_id"] for r in corpus_pipeline.one_of_each(spark, docs, MEDIUM).collect()}
    want = {b for a, b in alike(rows) if (bits[a] ^ bits[b]).bit_count() <= 2}
    assert want and kept == {k for k, _ in rows} - want
    assert simhash.majority(minhash.shingles(None, 5)) == 0


def components(rows):
    """Smallest key that brute force reaches over links, per key."""
    return joined([k for k, _ in rows], alike(rows))


def chained(n, words, step, seed=3):
    """Texts of which each is the one before with ``step`` words changed: neighbours are alike, farther ones are not."""
    rng, text, rows = random.Random(seed), prose(seed, words).split(" "), []
    for i in range(n):
        rows.append((i, " ".join(text)))
        for at in rng.sample(range(words), step):
            text[at] = f"w{i}x{at}"
    return rows


@pytest.mark.parametrize("direct", [3, 32])
def test_chains_in_a_crowded_bucket_are_followed(spark, monkeypatch, direct):
    """All rows in one bucket: a row linked only to rows that are not alike to the bucket's smallest one goes with them."""
    rows = chained(60, 300, 3) + [(k + 100, t) for k, t in chained(20, 300, 3, seed=9)]
    rng, base = random.Random(2), prose(1, 300).split(" ")
    for i in range(30):
        copy = list(base)
        for at in rng.sample(range(300), 5 + i % 9):
            copy[at] = f"v{i}"
        rows.append((200 + i, " ".join(copy)))
    order = random.Random(4).sample(range(len(rows)), len(rows))
    rows = [(order[n], t) for n, (_, t) in enumerate(rows)]
    signatures = minhash.signatures
    monkeypatch.setattr(minhash, "signatures", lambda *a: signatures(*a).withColumn("bands", F.expr("array(7L)")))
    monkeypatch.setattr(minhash, "print_links", lambda sigs, *_: sigs.selectExpr("rep AS a", "rep AS b").limit(0))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r["doc_id"] for r in drop_near_duplicates(docs, direct=direct).collect()}
    assert kept == set(components(rows).values()) and 2 < len(kept) < 60


def test_similarities_in_slices(monkeypatch):
    rng = random.Random(1)
    sets = [minhash.shingles(" ".join(rng.choice("abcd") for _ in range(rng.choice([0, 3, 200, 900]))), 5) for _ in range(30)]
    want = [[minhash.similarity(a, b) for b in sets] for a in sets]
    assert (minhash.similarities(sets) == want).all()
    monkeypatch.setattr(minhash, "SLICE_SHINGLES", 500)
    monkeypatch.setattr(minhash, "SLICE_COLUMNS", 16)
    assert (minhash.similarities(sets) == want).all()
