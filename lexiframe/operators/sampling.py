"""Splits, folds, oversampling, noise and class weights. Every random choice is a hash of the row id and a seed,
so a task that is run again after the loss of an executor makes the same choices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiframe.operators.neighbours import BLOCK_ROWS, nearest
from lexiframe.operators.ranking import hash_cuts, hash_index, hash_key, hash_unit
from lexiframe.session import lookup_join


def class_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def with_quota(counts: DataFrame, size: str, fraction: float, label: str, name: str) -> DataFrame:
    """Share ``ceil(fraction * total)`` rows out to the classes in proportion, by largest remainder.

    The windows run over one row per class.
    """
    everyone = Window.partitionBy(F.lit(1))
    target = F.ceil(F.lit(fraction) * F.sum(size).over(everyone))
    exact = target.cast("double") * F.col(size) / F.sum(size).over(everyone)
    base = counts.withColumn("_exact", exact).withColumn("_base", F.floor("_exact")).withColumn("_target", target)
    order = everyone.orderBy(F.desc(F.col("_exact") - F.col("_base")), F.col(label))
    extra = F.row_number().over(order) <= F.col("_target") - F.sum("_base").over(everyone)
    return base.withColumn(name, F.col("_base") + extra.cast("bigint")).drop("_exact", "_base", "_target")


def stratified_split(
    df: DataFrame,
    label: str,
    row_id: str,
    test_size: float = 0.15,
    val_size: float | None = None,
    seed: int = 42,
    split: str = "split",
) -> DataFrame:
    """Add ``split``: test, val (if asked for) or train, each class in proportion and to the exact row count.

    ``val_size`` is a share of all rows; it is taken from what the test part leaves.
    """
    keyed = df.withColumn("_h", hash_key(row_id, seed))
    sizes = with_quota(class_counts(df, label), "n", test_size, label, "n_test")
    names = [("test", F.col("n_test"))]
    if val_size is not None:
        sizes = sizes.withColumn("n_rest", F.col("n") - F.col("n_test"))
        sizes = with_quota(sizes, "n_rest", val_size / (1 - test_size), label, "n_val")
        names.append(("val", F.col("n_test") + F.col("n_val")))
    quotas = sizes.select(
        label, F.inline(F.array(*[F.struct(F.lit(n).alias("name"), q.cast("bigint").alias("quota")) for n, q in names]))
    )
    cuts = hash_cuts(keyed, quotas, label)
    per_class = cuts.groupBy(label).agg(*[F.max(F.when(F.col("name") == n, F.col("cut"))).alias(f"_{n}") for n, _ in names])
    part = F.when(F.col("_h") <= F.col("_test"), "test")
    if val_size is not None:
        part = part.when(F.col("_h") <= F.col("_val"), "val")
    marked = lookup_join(keyed, per_class, label)
    return marked.select(*[F.col(f"`{c}`") for c in df.columns], part.otherwise("train").alias(split))


def stratified_folds(
    df: DataFrame, label: str, row_id: str, k: int = 5, seed: int = 42, fold: str = "fold"
) -> DataFrame:
    """Add ``fold`` 0 .. k-1; within a class fold sizes differ by one row at most."""
    keyed = df.withColumn("_h", hash_key(row_id, seed))
    step = F.explode(F.sequence(F.lit(1), F.lit(k - 1))).alias("j")
    quotas = class_counts(df, label).select(label, "n", step).select(
        label, F.col("j").cast("string").alias("name"), F.ceil(F.col("j") * F.col("n") / F.lit(float(k))).alias("quota")
    )
    cuts = hash_cuts(keyed, quotas, label).groupBy(label).agg(F.collect_list("cut").alias("_cuts"))
    marked = lookup_join(keyed, cuts, label)
    passed = F.size(F.filter("_cuts", lambda c: c < F.col("_h")))
    return marked.select(*[F.col(f"`{c}`") for c in df.columns], passed.alias(fold))


def oversample(
    df: DataFrame,
    label: str = "label",
    k: int = 3,
    seed: int = 42,
    block_rows: int = BLOCK_ROWS,
    digits: int | None = None,
) -> DataFrame:
    """Grow every class to the size of the largest by rows between a row and one of its near neighbours.

    ``df`` holds ``(id, label, vector array<double>)``. Returns only the new rows ``(source, copy, label,
    neighbour, u, vector)`` with ``vector = x + u * (neighbour - x)``. The missing rows are shared evenly over
    the rows of the class; which rows give one more is decided by hash. A class with one row repeats it.
    """
    keyed = df.select("id", label, "vector").withColumn("_h", hash_key("id", seed))
    largest = F.max("n").over(Window.partitionBy(F.lit(1)))
    need = class_counts(df, label).withColumn("_need", largest - F.col("n")).filter(F.col("_need") > 0)
    need = need.select(label, F.expr("_need div n").alias("_each"), (F.col("_need") % F.col("n")).alias("quota"))
    cuts = hash_cuts(keyed, need.select(label, F.lit("more").alias("name"), "quota"), label)
    plan = need.select(label, "_each").join(cuts.select(label, "cut"), label)
    copies = F.col("_each") + (F.col("_h") <= F.col("cut")).cast("bigint")
    bases = lookup_join(keyed, plan, label).withColumn("_copies", copies).filter(F.col("_copies") > 0)
    near = nearest(bases, keyed, k, group=label, exclude_self=True, block_rows=block_rows, digits=digits)
    lists = near.groupBy("id").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("rank", "neighbour"))), lambda s: s["neighbour"]).alias("_near")
    )
    grown = bases.select("id", label, "vector", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies"))).alias("copy"))
    text = F.concat_ws(":", F.lit(seed), F.col("id"), F.col("copy"))
    drawn = grown.join(lists, "id", "left").select(
        F.col("id").alias("source"),
        "copy",
        label,
        F.col("vector").alias("_x"),
        F.coalesce(
            F.get("_near", (hash_index(text) % F.greatest(F.size("_near"), F.lit(1))).cast("int")), F.col("id")
        ).alias("neighbour"),
        hash_unit(text, 9).alias("u"),
    )
    ends = keyed.select(F.col("id").alias("neighbour"), F.col("vector").alias("_y"))
    between = F.zip_with("_x", "_y", lambda x, y: x + F.col("u") * (y - x))
    return drawn.join(ends, "neighbour").select("source", "copy", label, "neighbour", "u", between.alias("vector"))


def with_noise(df: DataFrame, cols: list[str], row_id: str, sigma: float = 0.1, seed: int = 42) -> DataFrame:
    """Add Gaussian noise of deviation ``sigma`` to the columns, by Box-Muller from hashed uniforms."""

    names = F.array(*[F.lit(c) for c in cols])

    def noisy(value: Column, i: Column) -> Column:
        text = F.concat_ws(":", F.lit(seed), F.col(row_id), F.get(names, i))
        return value + sigma * F.sqrt(-2.0 * F.log(hash_unit(text))) * F.cos(2.0 * F.pi() * hash_unit(text, 9))

    values = F.array(*[F.col(f"`{c}`").cast("double") for c in cols])
    drawn = df.withColumn("_noisy", F.transform(values, noisy))
    return drawn.select(*[F.col("_noisy")[cols.index(c)].alias(c) if c in cols else F.col(f"`{c}`") for c in df.columns])


def with_class_weights(df: DataFrame, label: str, weight: str = "weight") -> DataFrame:
    """Weight N / (K * n_class), so that every class weighs the same in total."""
    counts = class_counts(df, label)
    everyone = Window.partitionBy(F.lit(1))
    weights = counts.select(
        label, (F.sum("n").over(everyone) / (F.count(F.lit(1)).over(everyone) * F.col("n"))).alias(weight)
    )
    return lookup_join(df, weights, label)
