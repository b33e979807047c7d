"""Feature-table statistics and transformations.

``fit_*`` functions return a small Python mapping, one entry per column, found by one aggregate over the rows
they are given; the matching transformation is then a plain projection with those numbers as constants.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiframe.operators.ranking import exact_quantiles, long_values


def wide(df: DataFrame, vector: str, dims: int, keep: list[str], prefix: str = "f") -> DataFrame:
    """Array column to double columns ``f00, f01, ...``."""
    return df.select(*keep, *[F.col(vector)[i].cast("double").alias(f"{prefix}{i:02d}") for i in range(dims)])


def unpivot(df: DataFrame, keep: list[str], cols: list[str]) -> DataFrame:
    """``keep`` columns with one row per ``(feature, value)``."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast("double").alias("value")) for c in cols])
    return df.select(*keep, F.inline(pairs))


def _replaced(df: DataFrame, new: dict[str, Column]) -> DataFrame:
    return df.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in df.columns])


def label_histogram(df: DataFrame, label: str, by_count: bool = False) -> DataFrame:
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), label) if by_count else counts.orderBy(label)


def fit_outlier_bounds(df: DataFrame, cols: list[str], factor: float = 2.5) -> dict[str, tuple[float, float]]:
    """Quartiles widened by ``factor`` interquartile ranges."""
    quartiles = exact_quantiles(df, cols, [0.25, 0.75])
    return {c: (q1 - factor * (q3 - q1), q3 + factor * (q3 - q1)) for c, (q1, q3) in quartiles.items() if q1 is not None}


def clipped(value: Column, low: float, high: float) -> Column:
    """Clip that leaves null and NaN alone."""
    return F.when(F.isnan(value), value).when(value < low, F.lit(low)).when(value > high, F.lit(high)).otherwise(value)


def winsorize(df: DataFrame, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    return _replaced(df, {c: clipped(F.col(f"`{c}`").cast("double"), lo, hi) for c, (lo, hi) in bounds.items()})


def clip_columns(df: DataFrame, cols: list[str], bound: float = 5.0) -> DataFrame:
    return winsorize(df, {c: (-bound, bound) for c in cols})


def column_statistics(df: DataFrame, cols: list[str]) -> DataFrame:
    """``(i, n, mean, std_pop, var_samp)`` per column number.

    Columns are turned into rows before the aggregation: a few aggregates over many groups stay inside compiled
    code, while several aggregates for each of hundreds of columns do not.
    """
    return long_values(df, cols).groupBy("i").agg(
        F.count("v").alias("n"),
        F.avg("v").alias("mean"),
        F.stddev_pop("v").alias("std_pop"),
        F.var_samp("v").alias("var_samp"),
    )


def rank_by_variance(df: DataFrame, cols: list[str]) -> DataFrame:
    """``(feature, value)`` by falling sample variance."""
    names = F.array(*[F.lit(c) for c in cols])
    stats = column_statistics(df, cols)
    return stats.select(F.get(names, F.col("i")).alias("feature"), F.col("var_samp").alias("value")).orderBy(
        F.desc("value"), "feature"
    )


def interaction_names(df: DataFrame, cols: list[str], top_n: int = 10) -> list[tuple[str, str]]:
    """Pairs of the ``top_n`` columns of largest variance."""
    return list(combinations([r["feature"] for r in rank_by_variance(df, cols).limit(top_n).collect()], 2))


def with_interactions(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    return df.select("*", *[(F.col(f"`{a}`") * F.col(f"`{b}`")).alias(f"{a}_x_{b}") for a, b in pairs])


def fit_standard(df: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation; a constant column gets a divisor of 1."""
    stats = {r["i"]: r for r in column_statistics(df, cols).collect()}
    return {c: (stats[i]["mean"], stats[i]["std_pop"] or 1.0) if i in stats else (0.0, 1.0) for i, c in enumerate(cols)}


def fit_robust(df: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    """Median and interquartile range; a range of 0 becomes 1."""
    found = exact_quantiles(df, cols, [0.25, 0.5, 0.75])
    return {c: (q2, (q3 - q1) or 1.0) for c, (q1, q2, q3) in found.items() if q2 is not None}


def rescale(df: DataFrame, centres: dict[str, tuple[float, float]]) -> DataFrame:
    return _replaced(df, {c: (F.col(f"`{c}`").cast("double") - m) / s for c, (m, s) in centres.items()})


def plain_names(df: DataFrame, keep: list[str], cols: list[str]) -> DataFrame:
    """The columns under plain names ``c0, c1, ...``, for stages that cannot quote a name."""
    return df.select(*keep, *[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
