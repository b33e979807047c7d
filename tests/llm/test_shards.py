import zlib

import pytest

from lexiframe.llm.shards import byte_shards

from .cases import MEDIUM, counted, documents, edge_docs


def brute(rows, n):
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    sizes = [len((t or "").encode()) + 8 for _, t in ordered]
    total, end, out, seen = sum(sizes), 0, [], {}
    for (k, t), s in zip(ordered, sizes):
        end += s
        shard = min(n - 1, (2 * end - s) * n // (2 * total))
        out.append((k, s, zlib.crc32((t or "").encode()), shard, seen.get(shard, 0)))
        seen[shard] = seen.get(shard, 0) + 1
    return out


@pytest.mark.parametrize("n", [1, 3, 24])
def test_like_one_running_sum(spark, n):
    docs = documents(spark, MEDIUM)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = [tuple(r) for r in byte_shards(docs, n).collect()]
    assert counted(got) == counted(brute(rows, n))
    sizes = [sum(r[1] for r in got if r[3] == s) for s in range(n)]
    assert max(sizes) - min(sizes) <= 2 * max(r[1] for r in got)


def test_edges(spark):
    docs = edge_docs(spark, keyed=False)
    got = byte_shards(docs, 4, carry=["n_chars"]).collect()
    assert len(got) == docs.count()
    for s in range(4):
        slots = sorted(r["slot"] for r in got if r["shard"] == s)
        assert slots == list(range(len(slots)))
    keys = [r["doc_id"] for r in sorted(got, key=lambda r: (r["shard"], r["slot"]))]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))
    assert byte_shards(docs.limit(0), 4).collect() == []


def test_one_key_in_most_rows_is_divided(spark):
    docs = spark.range(3000).selectExpr("7L AS doc_id", "'abc' AS text")
    got = byte_shards(docs, 10).groupBy("shard").count().collect()
    assert sorted(r["count"] for r in got) == [300] * 10
