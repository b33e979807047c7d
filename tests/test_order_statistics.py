import random

import numpy as np
import pytest

from lexiframe.operators import ranking as rk

PROBS = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]


def check(spark, columns, monkeypatch, **options):
    """Against numpy, and how many values met for a rank at the most."""
    n = len(next(iter(columns.values())))
    df = spark.createDataFrame([tuple(columns[c][i] for c in columns) for i in range(n)], ", ".join(f"{c} double" for c in columns)).repartition(5)
    met = []
    kept = rk._values_at

    def last(spark_, long, brackets):
        met.extend(b.inside for b in brackets.values() if b.lo != b.hi)
        return kept(spark_, long, brackets)

    monkeypatch.setattr(rk, "_values_at", last)
    got = rk.exact_quantiles(df, list(columns), PROBS, **options)
    monkeypatch.setattr(rk, "_values_at", kept)
    for c, values in columns.items():
        full = [v for v in values if v is not None and v == v]
        if full:
            assert got[c] == pytest.approx(np.quantile(full, PROBS).tolist(), rel=1e-12, abs=1e-12), c
        else:
            assert got[c] == [None] * len(PROBS)
    return max(met, default=0)


def test_any_column_in_bounded_groups(spark, monkeypatch):
    rng = random.Random(2)
    n = 3000
    columns = {
        "same": [7.5] * n,
        "distinct": [rng.gauss(0, 1) for _ in range(n)],
        "ties": [float(rng.choice([0, 0, 0, 1, 2])) for _ in range(n)],
        "holes": [rng.choice([None, float("nan"), rng.random()]) for _ in range(n)],
        "empty": [None] * n,
        "far": [rng.choice([1e300, -1e300, 1e-300, 0.0]) for _ in range(n)],
        "one": [None] * (n - 1) + [4.0],
        "two": [None] * (n - 2) + [4.0, 5.0],
    }
    assert check(spark, columns, monkeypatch) <= rk.MAX_INSIDE
    assert check(spark, {c: columns[c] for c in ("distinct", "ties", "far")}, monkeypatch, most=8, accuracy=100) <= 8


def test_missed_brackets(spark, monkeypatch):
    """Brackets that miss their rank on either side, by a rule that always guesses wrong at first."""
    rng = random.Random(3)
    columns = {"a": [rng.random() for _ in range(500)], "b": [float(i % 3) for i in range(500)]}
    around = rk._around
    calls = []

    def wrong(probs, n, accuracy):
        calls.append(n)
        return [x for p in probs for x in ((0.8, 0.9) if p < 0.5 else (0.1, 0.2))] if len(calls) == 1 else around(probs, n, accuracy)

    monkeypatch.setattr(rk, "_around", wrong)
    assert check(spark, columns, monkeypatch, most=30, accuracy=100) <= 30 and len(calls) > 1
