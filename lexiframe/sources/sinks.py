"""Writers: texts by id, feature tables, in-place rewrite, fitted models, name lists and result summaries."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiframe.sources.readers import read_texts, spread

NO_ID = "__HIVE_DEFAULT_PARTITION__"  # the folder that Spark's writer gives to rows without a key


def append_texts(texts: DataFrame, path: str, buckets: int = 64) -> None:
    """Append texts not stored yet. Ids are spread over a fixed number of folders, not one folder per id."""
    spark = texts.sparkSession
    new = texts
    if path_exists(spark, path):
        new = texts.join(spark.read.parquet(path).select("doc_id"), "doc_id", "left_anti")
    new.withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(buckets))).write.mode("append").partitionBy(
        "bucket"
    ).parquet(path)


def write_text_files(texts: DataFrame, path: str) -> None:
    """One text file per document and task, below ``doc_id=<id>/``; every row ends with a line feed.

    In a folder of the file system, local or mounted by all machines, tasks with whole-number ids write the files themselves:
    without Hadoop's native library its local file system starts a process or two for every file. They are renamed when a
    task has written all of its own, under names that a repeated task gives again. Elsewhere Spark's writer does it.
    """
    rows = spread(texts.select("doc_id", "text"), "doc_id")
    fs, path_of = _filesystem(texts.sparkSession, path)
    if fs.getUri().getScheme() != "file" or not isinstance(texts.schema["doc_id"].dataType, T.IntegralType):
        rows.write.mode("append").partitionBy("doc_id").text(path)
        return
    folder, job = fs.makeQualified(path_of(path)).toUri().getPath(), uuid.uuid4().hex
    rows = rows.select(F.coalesce(F.col("doc_id").cast("string"), F.lit(NO_ID)), F.coalesce(F.col("text").cast("string"), F.lit("")))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, seen = f"part-{TaskContext.get().partitionId():05d}-{job}", set()
        hidden = f".{name}-{TaskContext.get().taskAttemptId()}"
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                at = f"{folder}/doc_id={key}"
                if key not in seen:
                    os.makedirs(at, exist_ok=True)
                with open(f"{at}/{hidden}", "ab" if key in seen else "wb") as file:
                    file.write(text.encode() + b"\n")
                seen.add(key)
        for key in seen:
            os.replace(f"{folder}/doc_id={key}/{hidden}", f"{folder}/doc_id={key}/{name}.txt")
        yield pa.RecordBatch.from_arrays([pa.array([len(seen)], pa.int64())], names=["n"])

    os.makedirs(folder, exist_ok=True)
    rows.mapInArrow(write, "n long").agg(F.sum("n")).collect()


def read_text_files(spark: SparkSession, path: str) -> DataFrame:
    """Read back ``write_text_files``; the writer ends each file with one line feed."""
    raw = read_texts(spark, path, r"doc_id=(\d+)/")
    return raw.withColumn("text", F.regexp_replace("text", r"\n\z", ""))


def write_feature_table(df: DataFrame, path: str, fmt: str = "csv") -> None:
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.csv(path, header=True, quote='"', escape='"', emptyValue="", ignoreLeadingWhiteSpace=False,
                   ignoreTrailingWhiteSpace=False)
    else:
        writer.parquet(path)


def _filesystem(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), spark._jvm.org.apache.hadoop.fs.Path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, path_of = _filesystem(spark, path)
    return fs.exists(path_of(path))


def rewrite_in_place(df: DataFrame, path: str) -> None:
    """Replace the parquet table at ``path`` by ``df``, which may itself read from ``path``.

    The new table is written next to the old one and swapped in by two renames. A job that fails leaves the old table;
    if the second rename fails, the old table is put back. A table set aside by a run that was killed between the
    renames is put back first, and a left-over copy beside a whole table is deleted.
    """
    spark = df.sparkSession
    fs, path_of = _filesystem(spark, path)
    fresh, old = path + "__new", path + "__old"
    if fs.exists(path_of(old)):
        if fs.exists(path_of(path)):
            fs.delete(path_of(old), True)
        elif not fs.rename(path_of(old), path_of(path)):
            raise OSError(f"cannot put {old} back")
    df.write.mode("overwrite").parquet(fresh)
    if not fs.rename(path_of(path), path_of(old)):
        raise OSError(f"cannot set aside {path}")
    if not _moved(fs, path_of(fresh), path_of(path)):
        fs.rename(path_of(old), path_of(path))
        spark.catalog.refreshByPath(path)
        raise OSError(f"cannot move {fresh} into place")
    fs.delete(path_of(old), True)
    spark.catalog.refreshByPath(path)


def _moved(fs, source, target) -> bool:
    return fs.rename(source, target)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def write_names(df: DataFrame, path: str) -> None:
    """Small ordered list or mapping, such as feature names, class names or cluster labels."""
    df.repartition(1).write.mode("overwrite").parquet(path)


def write_summary(summary: DataFrame, path: str) -> None:
    summary.repartition(1).write.mode("overwrite").json(path)
