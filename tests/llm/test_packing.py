import zlib

import numpy as np
from public_tokenizers import path
from tokenizers import Tokenizer

from lexiframe.llm.packing import binary_lengths, pieces

from .cases import SMALL, documents, edge_docs

FILE = path("word_bpe_49k.json")


def test_lengths():
    for n in range(1, 300):
        cut = binary_lengths(n, 64)
        assert sum(cut) == n and all(x & (x - 1) == 0 and x <= 64 for x in cut) and cut == sorted(cut, reverse=True)


def whole(texts):
    model = Tokenizer.from_file(FILE)
    return [[*model.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]


def check(docs, longest):
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    want = dict(zip(rows, whole(rows.values())))
    got = pieces(docs, FILE, longest=longest, ids=True).collect()
    back: dict = {}
    for r in sorted(got, key=lambda r: r["start"]):
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        have = back.setdefault(r["doc_id"], [])
        assert r["start"] == len(have) and r["length"] == len(ids) and r["offset"] == 0
        assert r["ids_crc32"] == zlib.crc32(bytes(r["ids"])) and r["doc_tokens"] == len(want[r["doc_id"]])
        have += ids
    assert back == want
    numbers = sorted((r["sequence_id"], r["length"]) for r in got)
    assert [n for n, _ in numbers] == list(range(len(got)))
    assert [x for _, x in numbers] == sorted((x for _, x in numbers), reverse=True)


def test_round_trip(spark):
    check(documents(spark, SMALL), 4096)
    check(documents(spark, SMALL).limit(40), 16)


def test_odd_texts(spark):
    texts = ["don't  stop's 'twas", "<|startoftext|>x <|endoftext|>", "é e ́ ẛ̣", "a b c　d\u0085e\u001cf", "İSTANBUL ΣΑΣ ß",
             "\U0001f600 \U0001f468‍\U0001f469", "日本語 12345 ½", "﻿ x", "<|endoftext|", "a" * 3000, None, "", " \n"]
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 64)


def test_edges(spark):
    docs = edge_docs(spark, keyed=False)
    got = pieces(docs, FILE).collect()
    assert sum(r["length"] for r in got if r["start"] == 0) > 0
    assert len([r for r in got if r["start"] == 0]) == docs.count()
    assert len({r["sequence_id"] for r in got}) == len(got)
    assert [r["length"] for r in got if r["doc_id"] == 0] == [1]
    assert pieces(docs.limit(0), FILE).collect() == []
