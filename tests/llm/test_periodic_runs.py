import hashlib
import random
import zlib

import numpy as np
import pytest

from lexiframe.llm import periodic_runs as pr
from lexiframe.llm.queries import QUERIES, with_planted_runs

from .cases import MEDIUM, documents, edge_docs


def brute(words, least=6, times=4):
    """Every period on its own: stretches in which words a period apart agree, unless a smaller period does as well."""
    n, found = len(words), []
    for p in range(1, n // times + 1):
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            length = j + p - i
            smaller = any(all(words[k] == words[k + q] for k in range(i, i + length - q)) for q in range(1, p))
            if length >= max(least, times * p) and not smaller:
                found.append((i, length, p))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapse(words, found):
    gone = {i for s, length, p in found for i in range(s + p, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_small_alphabets():
    rng = random.Random(3)
    for n in range(400):
        base = [rng.randrange(rng.choice([1, 2, 3])) for _ in range(rng.randrange(1, 14))]
        words = (base * rng.randrange(1, 9))[: rng.randrange(1, 70)] + [rng.randrange(2) for _ in range(rng.randrange(0, 20))]
        words = [rng.randrange(2) for _ in range(rng.randrange(0, 9))] + words
        got = pr.find_runs(np.array(words, np.int64))
        assert list(zip(*map(np.ndarray.tolist, got))) == brute(words), (n, words)
        got = pr.find_runs(np.array(words, np.int64), least=1, times=5)
        assert list(zip(*map(np.ndarray.tolist, got))) == brute(words, 1, 5), (n, words)


def test_fibonacci_and_one_word():
    a, b = [0], [0, 1]
    while len(b) < 400:
        a, b = b, b + a
    assert list(zip(*map(np.ndarray.tolist, pr.find_runs(np.array(b))))) == brute(b)
    assert [c.tolist() for c in pr.find_runs(np.zeros(100_000, int))] == [[0], [100_000], [1]]
    assert [len(c) for c in pr.find_runs(np.zeros(0, int))] == [0, 0, 0]
    with pytest.raises(ValueError):
        pr.find_runs(np.zeros(9, int), times=3)


def check(docs):
    want = {}
    for r in docs.collect():
        words = [w.decode() for w in (r["text"] or "").encode().split()]
        found = brute(words)
        row = (r["doc_id"], tuple(found), collapse(words, found))
        want[row] = want.get(row, 0) + 1
    for r in pr.periodic_runs(docs).collect():
        want[r["doc_id"], tuple(map(tuple, r["runs"])), r["collapsed"]] -= 1
    assert set(want.values()) == {0}
    return want


def test_documents_and_edges(spark):
    small = documents(spark, MEDIUM).where("length(text) < 1500")
    assert any(r[1] for r in check(with_planted_runs(small)))
    check(edge_docs(spark, keyed=False).where("length(text) < 9000 OR text IS NULL"))
    long_text = "one two three " * 200_000 + "end"
    got = pr.periodic_runs(spark.createDataFrame([(1, long_text), (2, " \n\t "), (3, None)], "doc_id int, text string")).collect()
    assert [[tuple(x) for x in r["runs"]] for r in got] == [[(0, 600_000, 3)], [], []]
    assert [r["collapsed"] for r in got] == ["one two three end", "", ""]
    assert pr.periodic_runs(edge_docs(spark).limit(0)).collect() == []


def test_slices_do_not_matter(spark, monkeypatch):
    docs = with_planted_runs(documents(spark))
    whole = sorted(map(str, pr.periodic_runs(docs).collect()))
    parts = pr.text_slices
    import pyarrow as pa

    texts = pa.array([r["text"] for r in docs.collect()])
    cuts = list(parts(texts, 1000))
    assert cuts[0][0] == 0 and cuts[-1][1] == len(texts) and all(a[1] == b[0] for a, b in zip(cuts, cuts[1:])) and len(cuts) > 20
    runs = [r for at, to in cuts for r in zip(*(c.to_pylist() for c in pr._sliced(texts.slice(at, to - at), 6, 4)), strict=True)]
    whole_runs = list(zip(*(c.to_pylist() for c in pr._sliced(texts, 6, 4)), strict=True))
    assert runs == whole_runs and len(whole) == len(runs)


def planted(doc_id, words):
    """The contract's text of a document, word by word."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_query(spark):
    """Against brute force on the shorter documents of the small table, read from the whole result."""
    got = {r["doc_id"]: r for r in QUERIES["op11_periodic_runs"](spark, MEDIUM).collect()}
    docs = documents(spark, MEDIUM).collect()
    assert set(got) == {r["doc_id"] for r in docs}
    for r in docs:
        words = planted(r["doc_id"], [w.decode() for w in (r["text"] or "").encode().split()])
        if len(words) > 400:
            continue
        found, row = brute(words), got[r["doc_id"]]
        assert row["n_runs"] == len(found)
        assert row["runs_sha256"] == sha("".join(f"{s},{n},{p}\n" for s, n, p in found))
        assert row["collapsed_sha256"] == sha(collapse(words, found))
        best = min(found, key=lambda x: (-x[1], x[0], x[2]), default=None)
        want = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        assert (row["start"], row["length"], row["period"], row["exponent_milli"]) == want
