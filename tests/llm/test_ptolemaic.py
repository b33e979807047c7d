import hashlib
import math

import duckdb
import numpy as np

from lexiframe.llm import ptolemaic as pt
from lexiframe.llm.queries import ORACLES, QUERIES

from .cases import MEDIUM, SMALL


def brute(rows, k=8, rounds=10, dims=64):
    """All distances of all rounds in Python's integers."""
    kept = []
    for key, v in rows:
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v):
            kept.append((key, [math.floor(1024 * x) for x in v]))
    order = sorted((hashlib.sha256(f"3:{key}".encode()).hexdigest(), v) for key, v in kept if key is not None)
    centres = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(centres))

    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        for i in range(len(centres)):
            mine = [v for (_, v), j in zip(kept, own) if i == j]
            if mine:
                centres[i] = [sum(c) // len(mine) for c in zip(*mine)]
    return [(key, *nearest(v)[::-1]) for key, v in kept], centres


def check(spark, rows, rounds=3):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, v string, near int, cluster int").repartition(3)
    got, centroids = pt.ptolemaic_clusters(table, rounds=rounds)
    want, centres = brute([(r["vec_id"], r["embedding"]) for r in table.collect()], rounds=rounds)
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, want))
    found = sorted(centroids.collect())
    assert [r["centroid"] for r in found] == centres
    assert sum(r["n"] for r in found) == len(want)


def vectors(seed, n, spread):
    rng = np.random.default_rng(seed)
    homes = rng.normal(size=(5, 64))
    return [(int(i), (homes[i % 5] + spread * rng.normal(size=64)).astype(np.float32).tolist(), "x", 1, 2) for i in range(n)]


def test_against_all_distances(spark):
    check(spark, vectors(1, 200, 0.2), rounds=10)
    odd = vectors(2, 30, 1.0)
    odd += [odd[3], odd[3], (3, [0.0] * 64, "x", 1, 2), (None, [0.5] * 64, "x", 1, 2), (None, None, "x", 1, 2)]
    odd += [(90, None, "", 0, 0), (91, [], "", 0, 0), (92, [1.0] * 63, "", 0, 0), (93, [1.0] * 65, "", 0, 0)]
    odd += [(94, [1.0] * 63 + [None], "", 0, 0), (95, [math.nan] * 64, "", 0, 0), (96, [math.inf] + [0.0] * 63, "", 0, 0)]
    check(spark, odd)
    check(spark, odd[:5])
    check(spark, [(i, [0.25] * 64, "", 0, 0) for i in range(20)])  # all alike: seven centroids stay empty
    check(spark, [(7, [-1.5] * 64, "", 0, 0)])
    nothing = pt.ptolemaic_clusters(spark.createDataFrame(odd[-3:], "vec_id long, embedding array<float>, v string, near int, cluster int"))
    assert [t.collect() for t in nothing] == [[], []]
    far = [(1, [1e30] * 64, "", 0, 0), (2, [0.5] * 64, "", 0, 0)]  # the first is beyond what a long can hold squared
    rows, _ = pt.ptolemaic_clusters(spark.createDataFrame(far, "vec_id long, embedding array<float>, v string, near int, cluster int"))
    assert [tuple(r) for r in rows.collect()] == [(2, 0, 0)]


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(4)
    for scale in (3, 1000, pt.LIMIT - 1):
        rows, centres = (rng.integers(-scale, scale + 1, (n, 64)) for n in (300, 8))
        rows[:8] = centres
        pivots = pt.Pivots(rows[4:12])
        exact = np.array([[sum(int(a - b) ** 2 for a, b in zip(x, c)) for c in centres] for x in rows], object)
        low = pivots.bounds(pivots.distances(rows), pivots.distances(centres))
        assert all(int(b) <= e for b, e in zip(low.ravel(), exact.ravel()))
        which, best, _ = pt.nearest(rows, pivots.distances(rows), centres, pivots)
        assert [min((e, i) for i, e in enumerate(r)) for r in exact] == list(zip(best.tolist(), which.tolist()))
    homes = rng.integers(-(10**6), 10**6, (8, 64))
    rows = np.repeat(homes, 100, axis=0) + rng.integers(-(10**4), 10**4, (800, 64))
    pivots = pt.Pivots(homes)
    _, _, measured = pt.nearest(rows, pivots.distances(rows), homes + 3, pivots)
    assert measured < 1.1 * len(rows)  # of eight distances a row


def test_query_is_its_sql(spark):
    for folder in (SMALL, MEDIUM):
        con = duckdb.connect()
        con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
        result = con.execute(ORACLES["op13_centroid_clusters"])
        names = [d[0] for d in result.description]
        got = QUERIES["op13_centroid_clusters"](spark, folder).select(names).collect()
        assert sorted(map(tuple, got)) == sorted(result.fetchall()) and len(got) > 100
