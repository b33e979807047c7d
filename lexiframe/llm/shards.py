"""Contiguous shards of near equal byte size, from prefix sums over per-partition totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexiframe.session import materialize

OVERHEAD = 8


def byte_shards(
    docs: DataFrame,
    n_shards: int = 24,
    key: str = "doc_id",
    text: str = "text",
    overhead: int = OVERHEAD,
    carry: list[str] | None = None,
) -> DataFrame:
    """Every row with its size, text_crc32, shard, slot and the columns ``carry`` asks for.

    Rows are ordered by key (null first, ties by row position). A row's size is the UTF-8 bytes of its text (none
    for null) plus ``overhead``; the shard of a row is the one of ``n_shards`` equal ranges of the total that holds
    the middle of the row, so shards are contiguous in that order and no cut is off its target by more than half
    a row. ``slot`` counts the rows of a shard from 0. Fewer rows than shards leave some empty; an empty table gives
    an empty result.

    Texts are read once and never shuffled. The slim rows are dealt into ranges of the order, every range is totalled,
    the totals (one row per range) are summed up, and a running sum within the range adds the rest, so no task sees
    more than a range. Ranges are split by row position too, so a key that repeats in very many rows is divided.
    """
    slim = docs.select(
        F.col(key),
        *(carry or []),
        (F.coalesce(F.octet_length(text), F.lit(0)) + overhead).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("_row"),
    )
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = slim.repartitionByRange(n, F.col(key).asc_nulls_first(), "_row")
    ranges = materialize(dealt.withColumn("_range", F.spark_partition_id()), "ranges")

    totals = ranges.groupBy("_range").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    earlier = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    everything = W.orderBy("_range").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    starts = materialize(
        totals.select(
            "_range",
            F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("_bytes_before"),
            F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("_rows_before"),
            F.sum("bytes").over(everything).alias("_total"),
        ),
        "starts",
    )
    inside = W.partitionBy("_range").orderBy(F.col(key).asc_nulls_first(), "_row")
    placed = ranges.join(starts, "_range").withColumns({
        "_end": F.col("_bytes_before") + F.sum("size").over(inside.rowsBetween(W.unboundedPreceding, 0)),
        "_nth": F.col("_rows_before") + F.row_number().over(inside) - 1,
    })
    middle = f"least({n_shards - 1}, ((2 * cast(_end AS decimal(38, 0)) - size) * {n_shards}) DIV (2 * _total))"
    placed = materialize(placed.withColumn("shard", F.expr(middle).cast("int")).drop("_total"), "placed")
    first = materialize(placed.groupBy("shard").agg(F.min("_nth").alias("_first")), "first")
    return placed.join(first, "shard").select(
        key, *(carry or []), "size", "text_crc32", "shard", (F.col("_nth") - F.col("_first")).alias("slot")
    )
