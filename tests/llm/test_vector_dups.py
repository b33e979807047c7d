import numpy as np
import pytest

from lexiframe.llm import vector_dups
from lexiframe.llm.vector_dups import near_vectors

from .cases import SMALL, joined


def brute(rows, least=0.9):
    ok = [(k, np.array(v, float)) for k, v in rows if v is not None and None not in v and np.isfinite(v).all() and np.any(v)]
    links = []
    for i, (a, x) in enumerate(ok):
        for b, y in ok[i + 1 :]:
            if len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= least:
                links.append((a, b))
    roots = joined([k for k, _ in rows], links)
    return {k: (sum(k in p for p in links), roots[k], roots[k] == k) for k, _ in rows}


def crowd(n=900, size=16):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, size))
    rows = [c + rng.normal(scale=s, size=size) for c in centres for s in rng.uniform(0.02, 0.12, n // 12)]
    rows += list(rng.normal(size=(n - len(rows), size)))
    return [(i * 3, [float(x) for x in r]) for i, r in enumerate(rows)]


@pytest.mark.parametrize("block", [8, 512])
def test_like_all_pairs(spark, block, monkeypatch):
    monkeypatch.setattr(vector_dups, "BLOCK", block)
    rows = crowd() + [(10_000 + i, [1.0] * 16) for i in range(20)] + [(20_000, [2.0] * 16), (20_001, [-1.0] * 16)]
    got = near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), tables=40).collect()
    want = brute(rows)
    have = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got}
    assert sum(have[k][0] for k in have) >= 0.99 * sum(w[0] for w in want.values())
    close = brute(rows, 0.93)  # far from the border all links are found
    assert all(close[k][0] <= have[k][0] <= want[k][0] for k in want)
    assert have[10_000][0] >= 20


def test_table(spark):
    df = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in near_vectors(df).collect()}
    assert got == brute(rows)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, None]), (8, []),
            (9, [5.0, 0.1]), (10, [1.0, 0.0, 0.0]), (11, [-1.0, 0.0]), (12, None)]
    df = spark.createDataFrame([(k, v, "clash", 1) for k, v in rows], "vec_id long, embedding array<float>, rep string, size int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in near_vectors(df).collect()}
    assert got == {1: (2, 1, True), 2: (2, 1, False), 9: (2, 1, False)} | {k: (0, k, True) for k in (3, 4, 5, 6, 7, 8, 10, 11, 12)}
    assert near_vectors(df.limit(0)).collect() == []
    assert len(near_vectors(df.where("vec_id = 3")).collect()) == 1
