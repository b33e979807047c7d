"""Exact order statistics that never gather a whole group in one task.

``exact_quantiles`` brackets every wanted rank with an approximate pass and then counts: all values outside the
brackets collapse to a few counters. Brackets that hold many values are narrowed again, and only a bounded number of values
is ever kept for a rank.

``prefix_sums`` adds up in a global order: rows are dealt into ranges of it, every range is totalled, and a running sum
within the range adds the rest, so no task sees more than a range, whatever a group holds.

``hash_cuts`` finds, per class, the hash value below which exactly the wanted number of rows lie. It counts
hash prefixes and sorts only the rows of the one prefix that holds the cut, so a class that holds most of the
rows is no bottleneck; applying the cuts afterwards is a comparison per row.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiframe.session import lookup_join, materialize

MAX_INSIDE = 10_000  # values that may meet for one rank of a column


def long_values(df: DataFrame, cols: list[str], label: str | None = None) -> DataFrame:
    """``(i, v)``: column number and value, without null and NaN; with ``label``, that column first as ``_y``."""
    values = F.array(*[F.col(f"`{c}`").cast("double") for c in cols])
    kept = [] if label is None else [F.col(label).alias("_y")]
    return df.select(*kept, F.posexplode(values).alias("i", "v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))


@dataclass
class _Bracket:
    """Where the value at a sorted position is sought: ``lo`` to ``hi``, inside ``outer_lo`` to ``outer_hi``, which hold it."""

    at: int
    lo: float
    hi: float
    outer_lo: float
    outer_hi: float
    below: int = 0
    inside: int = 0

    def holds(self) -> bool:
        return self.below <= self.at < self.below + self.inside

    def settled(self, most: int) -> bool:
        return self.holds() and (self.inside <= most or self.lo == self.hi)

    def resized(self) -> None:
        """After a count: the outer bounds become the bracket if it holds the position, else the bracket the side that does."""
        if self.holds():
            self.outer_lo, self.outer_hi = self.lo, self.hi
            return
        if self.at < self.below:
            self.outer_hi = math.nextafter(self.lo, -math.inf)
        else:
            self.outer_lo = math.nextafter(self.hi, math.inf)
        self.lo, self.hi = self.outer_lo, self.outer_hi


def exact_quantiles(
    df: DataFrame, cols: list[str], probs: list[float], accuracy: int = 10_000, most: int = MAX_INSIDE
) -> dict[str, list[float]]:
    """Quantiles with linear interpolation for all columns. The result has one row per column.

    A sketch brackets every wanted rank and a pass counts what lies below and inside. A bracket that holds its rank and more
    than ``most`` values is bracketed again among them, one that misses gives way to the side where the rank lies, and a
    bracket of a single value is done, so any column ends in few passes. At last the values inside are kept, ``most`` for a
    rank at the most, whatever the size or the ties of the column.
    """
    spark = df.sparkSession
    long = long_values(df, cols).withColumn("v", F.col("v") + 0.0)  # no negative zero
    first = long.groupBy("i").agg(
        F.count("v").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"),
        F.percentile_approx("v", _around(probs, df.count(), accuracy), accuracy).alias("near"),
    )
    stats = {r["i"]: r for r in first.collect()}
    open_ = {
        (i, at): _Bracket(at, r["near"][2 * j], r["near"][2 * j + 1], r["low"], r["high"])
        for i, r in stats.items()
        for j, p in enumerate(probs)
        for at in (math.floor((r["n"] - 1) * p), math.ceil((r["n"] - 1) * p))
    }
    done: dict[tuple[int, int], _Bracket] = {}
    while open_:
        _count_inside(spark, long, open_)
        done |= {at: b for at, b in open_.items() if b.settled(most)}
        open_ = {at: b for at, b in open_.items() if at not in done}
        wide = {at: b for at, b in open_.items() if b.holds()}
        for b in open_.values():
            b.resized()
        _narrow(spark, long, wide, accuracy)
    found = _values_at(spark, long, done)

    def interpolated(i: int, p: float) -> float:
        at = (stats[i]["n"] - 1) * p
        low, high = found[i, math.floor(at)], found[i, math.ceil(at)]
        return low + (high - low) * (at - math.floor(at))

    return {c: [interpolated(i, p) if i in stats else None for p in probs] for i, c in enumerate(cols)}


def _around(probs: list[float], n: int, accuracy: int) -> list[float]:
    slack = 2.0 / accuracy + 2.0 / max(n, 1)
    return [x for p in probs for x in (max(0.0, p - slack), min(1.0, p + slack))]


def _table(spark, brackets: dict[tuple[int, int], _Bracket]) -> DataFrame:
    """``(i, edges, brackets)``, one row per column."""
    columns = sorted({i for i, _ in brackets})
    rows = []
    for i in columns:
        own = sorted((at, b) for (c, at), b in brackets.items() if c == i)
        rows.append((i, sorted({e for _, b in own for e in (b.lo, b.hi)}), [(at, b.lo, b.hi) for at, b in own]))
    return spark.createDataFrame(rows, "i int, edges array<double>, brackets array<struct<at: bigint, lo: double, hi: double>>")


def _count_inside(spark, long: DataFrame, brackets: dict[tuple[int, int], _Bracket]) -> None:
    """Sets what lies below and inside every bracket, from counts between and at the edges of all."""
    edges = _table(spark, brackets)
    cells = (
        long.join(F.broadcast(edges), "i")  # one row per column
        .select("i", F.size(F.filter("edges", lambda e: e < F.col("v"))).alias("cell"), F.array_contains("edges", F.col("v")).alias("edge"))
        .groupBy("i", "cell", "edge")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    counts: dict[int, list] = {}
    for r in cells.collect():  # two rows per edge at most
        counts.setdefault(r["i"], []).append((r["cell"], r["edge"], r["n"]))
    at = {r["i"]: {e: k for k, e in enumerate(r["edges"])} for r in edges.collect()}
    for (i, _), b in brackets.items():
        lo, hi = at[i][b.lo], at[i][b.hi]
        # values of cell k lie above edge k - 1, and at edge k or below it, where they are told apart
        b.below = sum(n for cell, edge, n in counts[i] if cell < lo or (cell == lo and not edge))
        b.inside = sum(n for cell, _, n in counts[i] if cell <= hi) - b.below


def _narrow(spark, long: DataFrame, brackets: dict[tuple[int, int], _Bracket], accuracy: int) -> None:
    """Brackets the positions again by sketches of the values inside, or by the least of them where those do not help."""
    if not brackets:
        return
    inside = _inside(spark, long, brackets)
    sketched = inside.groupBy("i", "at").agg(F.percentile_approx("v", [k / 100 for k in range(101)], accuracy).alias("near"))
    for r in sketched.collect():  # a row per bracket
        b = brackets[r["i"], r["at"]]
        low, high = _around([(b.at - b.below) / max(b.inside - 1, 1)], b.inside, accuracy)
        b.lo, b.hi = r["near"][math.floor(100 * low)], r["near"][math.ceil(100 * high)]
        if (b.lo, b.hi) == (b.outer_lo, b.outer_hi):
            b.hi = b.lo


def _inside(spark, long: DataFrame, brackets: dict[tuple[int, int], _Bracket]) -> DataFrame:
    """``(i, at, v)``: the values inside the bracket of each position."""
    own = F.explode(F.filter("brackets", lambda b: (F.col("v") >= b["lo"]) & (F.col("v") <= b["hi"]))).alias("b")
    return long.join(F.broadcast(_table(spark, brackets)), "i").select("i", own, "v").select("i", "b.at", "v")


def _values_at(spark, long: DataFrame, brackets: dict[tuple[int, int], _Bracket]) -> dict:
    """Values at the wanted sorted positions, keyed ``(column, position)``."""
    if not brackets:
        return {}
    counts = _inside(spark, long, brackets).groupBy("i", "at", "v").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("i", "at").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    below = spark.createDataFrame([(i, at, b.below) for (i, at), b in brackets.items()], "i int, at bigint, below bigint")
    running = counts.withColumn("upto", F.sum("n").over(order)).join(F.broadcast(below), ["i", "at"])
    upto = F.col("below") + F.col("upto")
    hit = running.where((upto - F.col("n") <= F.col("at")) & (F.col("at") < upto))
    return {(r["i"], r["at"]): r["v"] for r in hit.select("i", "at", "v").collect()}


def prefix_sums(df: DataFrame, group: list[str], order: list[str], value: Column, name: str = "upto") -> DataFrame:
    """Add the sum of ``value`` (a whole number, not null) over the rows of the group up to this one in ascending ``order``.

    Rows that agree in group and order are told apart by their position, so each has a sum of its own; where only the sum
    before or after all of them is wanted, the order must be unique. The result is stored, so it may be read again.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = df.withColumn("_value", value.cast("bigint")).withColumn("_row", F.monotonically_increasing_id())
    by = [*group, *order, "_row"]
    dealt = materialize(keyed.repartitionByRange(n, *by).withColumn("_range", F.spark_partition_id()), "ranges")
    totals = dealt.groupBy(*group, "_range").agg(F.sum("_value").alias("_total"))  # a row per group and range it lies in
    earlier = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(*group, "_range", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_range", *group).orderBy(*order, "_row").rowsBetween(Window.unboundedPreceding, 0)
    summed = dealt.withColumn("_inside", F.sum("_value").over(inside))
    joined = lookup_join(summed, before, ["_range", *group])
    return materialize(joined.select(*df.columns, (F.col("_before") + F.col("_inside")).alias(name)), "prefix")


def hash_key(row_id: str | Column, seed: int | str = 42) -> Column:
    """Pseudo-random but repeatable order key; equal in every run and on every executor."""
    col = F.col(row_id) if isinstance(row_id, str) else row_id
    return F.md5(F.concat(F.lit(f"{seed}:"), col.cast("string")))


def hash_unit(text: Column, start: int = 1) -> Column:
    """Uniform number in (0, 1) from eight hex digits of an md5."""
    return (F.conv(F.substring(F.md5(text), start, 8), 16, 10).cast("double") + 0.5) / 4294967296.0


def hash_index(text: Column, start: int = 1) -> Column:
    return F.conv(F.substring(F.md5(text), start, 8), 16, 10).cast("bigint")


def hash_cuts(rows: DataFrame, quotas: DataFrame, group: str, key: str = "_h", digits: int = 3) -> DataFrame:
    """Per group and quota name the largest key among the ``quota`` smallest ones; empty for a quota of 0.

    ``rows`` holds ``group`` and the hex ``key``; ``quotas`` holds ``(group, name, quota)``.
    """
    keyed = rows.select(group, key, F.substring(key, 1, digits).alias("_prefix"))
    counts = keyed.groupBy(group, "_prefix").agg(F.count(F.lit(1)).alias("_n"))
    order = Window.partitionBy(group).orderBy("_prefix").rowsBetween(Window.unboundedPreceding, 0)
    running = counts.withColumn("_upto", F.sum("_n").over(order))
    holder = running.join(quotas, group).filter(
        (F.col("_upto") - F.col("_n") < F.col("quota")) & (F.col("quota") <= F.col("_upto"))
    )
    holder = holder.select(group, "_prefix", "name", (F.col("quota") - F.col("_upto") + F.col("_n")).alias("_k"))
    near = lookup_join(keyed, holder, [group, "_prefix"])
    nth = F.row_number().over(Window.partitionBy(group, "name").orderBy(key))
    cut = near.withColumn("_r", nth).filter(F.col("_r") == F.col("_k")).select(group, "name", F.col(key).alias("cut"))
    return quotas.select(group, "name").join(cut, [group, "name"], "left").withColumn("cut", F.coalesce("cut", F.lit("")))
