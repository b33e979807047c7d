import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from public_tokenizers import path

from lexiframe.llm import token_files as tf
from lexiframe.llm.elias_fano import EliasFano
from lexiframe.llm.queries import QUERIES
from lexiframe.llm.token_ids import TextEncoder

from .cases import MEDIUM, SMALL, documents, edge_docs
from .test_packing import whole

FILE = path("word_bpe_49k.json")


def test_elias_fano():
    rng = random.Random(1)
    cases = [[], [0], [7], [5] * 300, list(range(1000)), [-(1 << 63), (1 << 63) - 1], [-9, -9, -3, 0, 4]]
    cases += [sorted(rng.randrange(-(10**e), 10**e) for _ in range(n)) for e in (1, 4, 9, 18) for n in (2, 255, 256, 257, 3000)]
    for values in cases:
        code = EliasFano.from_bytes(EliasFano.of(np.array(values, np.int64)).to_bytes())
        assert code.range(0, len(values)).tolist() == values
        for i in random.Random(2).sample(range(len(values)), min(40, len(values))):
            assert code[i] == values[i]
            j = rng.randrange(i, len(values) + 1)
            assert code.range(i, j).tolist() == values[i:j]
            assert code.first_from(values[i]) == values.index(values[i])
        with pytest.raises(IndexError):
            code[len(values)]
    big = np.cumsum(np.random.default_rng(0).integers(1, 2000, 100_000))
    assert len(EliasFano.of(big).to_bytes()) < 100_000 * 13 / 8  # 64-bit offsets take 8 bytes each


def want_rows(rows):
    """Documents in order of their key, those without first; where each starts, its length and checksum."""
    rows = sorted(rows, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0))
    out, start = [], 0
    for r, ids in zip(rows, whole([r["text"] for r in rows]), strict=True):
        raw = np.array(ids, "<u4").tobytes()
        out.append((r["doc_id"], start, len(ids), zlib.crc32(raw), raw))
        start += len(ids)
    return out


def read(df):
    return sorted(((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"], bytes(r["ids"])) for r in df.collect()), key=lambda r: r[1])


def test_round_trip(spark, tmp_path):
    docs = documents(spark, SMALL)
    files = tf.write_token_files(docs, f"{tmp_path}/a", FILE, n_files=5)
    assert files.count() == 5 and files.agg({"n_docs": "sum"}).first()[0] == docs.count()
    want = want_rows(docs.collect())
    for size in (100, 1000, tf.READ_IDS):
        assert read(tf.read_token_files(files, ids=True, read_ids=size)) == want
    first = files.orderBy("part").first()
    with tf.TokenFile(first["file"]) as file:
        for i in (0, 3, first["n_docs"] - 1):
            assert file.key(i) == want[i][0] and file.document(i).tobytes() == want[i][4]
    with open(first["file"], "rb") as raw:
        assert len(raw.read()) == first["bytes"] < 2 * first["n_ids"] + 4 * first["n_docs"] + 200


def test_edges(spark, tmp_path):
    docs = edge_docs(spark, keyed=False)
    got = read(tf.token_table(docs, FILE, ids=True))
    want = want_rows(docs.collect())
    assert sorted(map(str, [(g[0], g[2:]) for g in got])) == sorted(map(str, [(w[0], w[2:]) for w in want]))
    assert [g[0] for g in got] == [w[0] for w in want]
    assert [g[1] for g in got] == np.cumsum([0] + [g[2] for g in got])[:-1].tolist()
    assert tf.token_table(docs.limit(0), FILE).collect() == []
    with pytest.raises(ValueError):
        tf.write_token_files(docs.selectExpr("text AS doc_id", "text"), f"{tmp_path}/b", FILE)
    other = tmp_path / "c.ids"
    other.write_bytes(b"x" * 100)
    with pytest.raises(ValueError):
        tf.TokenFile(str(other))
    small = spark.createDataFrame([(-5, "a"), (-5, "a"), (2**31 - 1, "b " * 300_000)], "doc_id int, text string")
    assert read(tf.token_table(small, FILE, ids=True)) == want_rows(small.collect())


def test_odd_texts_and_full_cache():
    texts = ["don't  stop's 'twas", "<|startoftext|>x. <|endoftext|> <|ENDOFTEXT|>.", "é e ́ ẛ̣", "a b c　d\u0085e\u001cf", "İSTANBUL ΣΑΣ ß",
             "日本語 12345 ½ Å.", "﻿ x", "a" * 3000, "", " \n", None, "Hello, World. U.S.A. x., ,", "K ﬀ. ǅ ŉ",
             "İx. Å, don't. x's, 'd. a.b,\tc.\n\x0b.", "abc. x, y.́ z"]
    for size in (1 << 20, 1):
        encode = TextEncoder(FILE, cached_bytes=size)
        for _ in range(3):
            raw, sizes = encode(pa.array(texts))
            ends = np.cumsum(sizes)
            ids = np.frombuffer(raw, "<u4")
            assert [[*ids[e - n : e].tolist(), 2] for e, n in zip(ends, sizes)] == whole(texts)


def test_query(spark):
    got = {tuple(r) for r in QUERIES["op12_token_files"](spark, MEDIUM).select("doc_id", "start", "n_tokens", "ids_crc32").collect()}
    assert got == {w[:4] for w in want_rows(documents(spark, MEDIUM).collect())}
