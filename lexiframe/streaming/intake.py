"""Take in new text files as a stream: each run reads only files no earlier run has seen."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiframe.functions.cleaning import clean_strict
from lexiframe.sources.readers import with_ids


def text_stream(spark: SparkSession, folder: str, id_pattern: str = r"(\d+)\.txt$") -> DataFrame:
    """Stream of ``(doc_id, text)``, one row per file whose path has an id."""
    files = spark.readStream.option("recursiveFileLookup", "true").option("wholetext", "true").text(folder)
    return with_ids(files, id_pattern)


def take_in(
    spark: SparkSession, folder: str, sink: str, checkpoint: str, clean: Callable[[Column], Column] = clean_strict
) -> None:
    """Clean and append the files that are new since the last run, then stop.

    The checkpoint remembers which files are done, so a run that fails half-way is continued by the next one.
    """
    cleaned = text_stream(spark, folder).select("doc_id", clean(F.col("text")).alias("text"))
    query = (
        cleaned.writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
