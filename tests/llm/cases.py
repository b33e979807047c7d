"""Shared fixtures: rows with nulls, empty and long texts, ties, repeats, and columns whose names clash."""

from __future__ import annotations

import random

from pyspark.sql import types as T

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"
DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    *[T.StructField(c, T.StringType()) for c in ("shard", "size", "fp", "rep", "hash", "words", "key", "component", "_text", "tokens")],
])


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(["an", "er", "th", "in", "on", "re"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def edge_rows() -> list[tuple]:
    long_text = prose(5, 6000)
    texts = [
        None, "", "   \t\n ", "one", "one two", "One TWO", prose(1, 40), prose(1, 40), prose(1, 40).upper(), long_text, long_text + " end",
        "Überall   ÄPFEL und Birnen 12 km", "\u0000\u0001 odd \u000b chars \u001c here", prose(2, 13), prose(2, 12),
        prose(3, 200) + " " + prose(1, 40), "12 34 .. !!", "Καλημέρα κόσμε Привет мир", "x" * 5000, "a a a a a a a a a a a a a a a a",
    ]
    rows = [(i, t, None if i % 5 == 0 else "en", "s", len(t or "")) + ("clash",) * 10 for i, t in enumerate(texts)]
    return rows + [rows[6], rows[6]] + [(None, "no key at all", None, None, None) + (None,) * 10]


def edge_docs(spark, keyed: bool = True):
    rows = [r for r in edge_rows() if not keyed or r[0] is not None]
    return spark.createDataFrame(rows, DOCS).repartition(3)


def documents(spark, folder: str = SMALL):
    return spark.read.parquet(f"{folder}/documents.parquet")


def counted(rows) -> dict:
    out: dict = {}
    for r in rows:
        out[r] = out.get(r, 0) + 1
    return out


def joined(ids: list, links: list[tuple]) -> dict:
    """Smallest id reachable, by union-find."""
    up = {i: i for i in ids}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}
