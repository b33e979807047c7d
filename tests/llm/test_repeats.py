import hashlib
import random
import re

import pytest

from lexiframe.llm import repeats
from lexiframe.llm.repeats import SuffixAutomaton, remove_repeats, text_anchors, word_ends, word_hashes

from .cases import MEDIUM, documents, edge_docs, edge_rows


def brute(rows, window=13):
    words = [(k, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for k, t in rows]
    first: dict = {}
    for k, w in words:
        for i in range(len(w) - window + 1):
            gram = tuple(w[i : i + window])
            first[gram] = min(k, first.get(gram, k))
    out = {}
    for k, w in words:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < k:
                gone[i : i + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out[k] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def found(df, **options):
    return {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in remove_repeats(df, **options).collect()}


@pytest.mark.parametrize("frequent", [1000, 1])
def test_like_all_windows(spark, frequent):
    docs = documents(spark, MEDIUM)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert found(docs, frequent=frequent, shard_words=5000) == brute(rows)


@pytest.mark.parametrize("seed", range(3))
def test_few_words_overlap_everywhere(spark, seed):
    rng = random.Random(seed)
    rows = [(i * 7 % 101, " ".join(rng.choice("ab") for _ in range(rng.randint(0, 60)))) for i in range(60)]
    rows = list({k: t for k, t in rows}.items())
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert found(df, window=7, k=4, frequent=5, shard_words=100) == brute(rows, 7)


def test_automaton():
    rng = random.Random(4)
    texts = [[rng.randint(0, 2) for _ in range(rng.randint(1, 40))] for _ in range(12)]
    machine = SuffixAutomaton()
    for owner, t in enumerate(texts):
        machine.add(t, owner)
    machine.finish()
    for t in [*texts, [0, 1, 2, 3, 0, 1, 2, 0, 0, 1]]:
        for n in (1, 3, 5):
            want = []
            for i in range(len(t) - n + 1):
                owners = [o for o, s in enumerate(texts) if any(s[j : j + n] == t[i : i + n] for j in range(len(s)))]
                want.append(min(owners, default=1 << 62))
            assert machine.first_owners(t, n) == want


def test_edges(spark):
    rows = dict((r[0], r[1]) for r in edge_rows() if r[0] is not None)
    docs = edge_docs(spark).dropDuplicates(["doc_id"])
    assert found(docs) == brute(list(rows.items()))
    doubled = remove_repeats(edge_docs(spark, keyed=False), texts=True).collect()
    assert len(doubled) == len(edge_rows())
    assert [r["n_removed"] for r in doubled if r["doc_id"] in (None, 6)] == [0] * 4
    assert [r["kept"] for r in doubled if r["doc_id"] == 7] == [""]
    assert found(docs.limit(0)) == {}


@pytest.mark.parametrize("text", [b"", b" ", b"a", b"  a\tb\n\x0b\x0c\r c ", "\u00a0\u00e9 \u2003x \x1c\x85 \x00".encode()])
def test_word_ends_are_those_of_split(text):
    assert [text[b:e] for b, e in zip(*word_ends(text), strict=True)] == text.split()


def test_word_and_text_numbers():
    """Equal words have equal numbers wherever they stand, others differ; texts beside each other share no window."""
    rng = random.Random(6)
    words = ["".join(rng.choice("ab\u00e9") for _ in range(rng.randint(1, 6))).encode() for _ in range(60_000)]
    raw = b" ".join(words)
    numbers = word_hashes(raw, *word_ends(raw)).tolist()
    assert len(set(zip(words, numbers, strict=True))) == len(set(words)) == len(set(numbers))
    texts = [b" ".join(words[at : at + n]) for at, n in ((0, 40), (0, 12), (5, 0), (0, 13), (20, 300))]
    own, text, sizes = text_anchors(texts, 13, 8)
    assert sizes.tolist() == [40, 12, 0, 13, 300] and {1, 2}.isdisjoint(text.tolist())
    for n in (0, 3, 4):
        alone, _, _ = text_anchors([texts[n]], 13, 8)
        assert own[text == n].tolist() == alone.tolist() and len(alone)
    assert len(text_anchors([b"", b"a b"], 13, 8)[0]) == 0


def test_passages_take_no_more_room_than_their_text(spark, monkeypatch):
    rng = random.Random(3)
    common = [" ".join(rng.choice("alpha beta gamma delta eta iota".split()) for _ in range(40)) for _ in range(30)]
    rows = [(i, f"{i}\t" + " \n ".join(rng.sample(common, 5))) for i in range(200)]
    sizes = {}
    real = repeats.materialize

    def spy(df, name="table"):
        out = real(df, name)
        if "passage" in out.columns:
            longs = 8 * sum(f.dataType.simpleString() == "bigint" for f in out.schema.fields)
            sizes[name] = out.selectExpr("sum(size * 8)", "sum(length(passage))").first()
            assert longs <= 40
        return out

    monkeypatch.setattr(repeats, "materialize", spy)
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)
    assert {"passages", "distinct"} <= set(sizes) and all(t < h for h, t in sizes.values())
