import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexiframe.operators import ranking as rk
from lexiframe.operators import selection as sl


def psi(n):
    return sum(1 / j for j in range(1, n)) - 0.5772156649015329


def brute(values, labels, k=3):
    """The estimate from all distances, on the operator's grid."""
    rows = [(v, y) for v, y in zip(values, labels) if v is not None and not math.isnan(v) and y is not None]
    if not rows:
        return 0.0
    lo, hi = min(v for v, _ in rows), max(v for v, _ in rows)
    rows = [(math.floor((v - lo) / (hi - lo) * sl.GRID) if hi > lo else 0, y) for v, y in rows]
    sizes = {y: sum(z == y for _, z in rows) for _, y in rows}
    rows = [(q, y) for q, y in rows if sizes[y] > 1]
    if not rows:
        return 0.0
    total = 0.0
    for i, (q, y) in enumerate(rows):
        gaps = sorted(abs(p - q) for j, (p, z) in enumerate(rows) if z == y and j != i)
        near = min(k, len(gaps))
        r = gaps[near - 1]
        m = sum(abs(p - q) < r for p, _ in rows)
        if r == 0:  # the others equal to it, of the class and of any
            near, m = gaps.count(0), sum(p == q for p, _ in rows) - 1
        total += psi(near) - psi(sizes[y]) - psi(m)
    return max(0.0, psi(len(rows)) + total / len(rows))


def test_against_all_distances(spark):
    rng = random.Random(5)
    labels = [rng.choice([0, 0, 0, 1, 1, 2, None]) for _ in range(150)] + [7]  # class 7 has one row
    columns = {
        "smooth": [rng.gauss(y or 0, 1) for y in labels],
        "steps": [float(rng.randrange(4) + (y or 0)) for y in labels],
        "constant": [3.25] * len(labels),
        "holes": [rng.choice([None, math.nan, rng.random()]) for _ in labels],
        "empty": [None] * len(labels),
        "far": [rng.choice([-1e300, 1e300, 0.0]) for _ in labels],
        "two": [float(y == 1) for y in labels],
    }
    names = list(columns)
    rows = [(i, y, *v) for i, (y, *v) in enumerate(zip(labels, *columns.values()))]
    df = spark.createDataFrame(rows, "id int, label int, " + ", ".join(f"{c} double" for c in names)).repartition(5)
    for k, size in ((3, 4), (1, 1), (5, 4096)):
        got = {r["feature"]: r["score"] for r in sl.neighbour_information(df, names, "label", k, size).collect()}
        for c in names:
            assert got[c] == pytest.approx(brute(columns[c], labels, k), abs=1e-9), (c, k)
    assert got["two"] > got["smooth"] > 0.1 and got["constant"] == got["empty"] == 0
    assert {r["score"] for r in sl.neighbour_information(df.limit(0), names, "label").collect()} == {0.0}


def test_digamma(spark):
    ns = [1, 2, 8, 9, 10, 11, 50, 1000]
    got = spark.createDataFrame([(n,) for n in ns], "n long").select("n", sl.digamma(F.col("n")).alias("y")).collect()
    for r in got:
        assert r["y"] == pytest.approx(psi(r["n"]), abs=1e-12)


def test_prefix_sums(spark):
    rows = [(i % 3, i * 7919 % 101, i % 5) for i in range(500)] + [(9, 1, 4)] * 300
    df = spark.createDataFrame(rows, "g int, o int, v int").repartition(7)
    got = rk.prefix_sums(df, ["g"], ["o"], F.col("v")).collect()
    for g in (0, 1, 2, 9):
        mine = sorted((r["o"], r["upto"]) for r in got if r["g"] == g)
        values = sorted((o, v) for h, o, v in rows if h == g)
        assert [o for o, _ in mine] == [o for o, _ in values]
        ends = {o: t for o, t in zip([o for o, _ in values], np.cumsum([v for _, v in values]))}
        for o, last in ends.items():
            assert max(t for p, t in mine if p == o) == last
