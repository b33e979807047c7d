"""Readers: CSV catalogue, feature tables, one-text-per-file folders, and the list of texts still missing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CATALOGUE_SCHEMA = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("movement", T.StringType()),
        T.StructField("doc_id", T.LongType()),
        T.StructField("is_prose", T.BooleanType()),
    ]
)


def read_catalogue(spark: SparkSession, path: str, schema: T.StructType = CATALOGUE_SCHEMA) -> DataFrame:
    """CSV with a header line and doubled quotes inside quoted fields."""
    return spark.read.schema(schema).csv(path, header=True, quote='"', escape='"')


def read_feature_table(spark: SparkSession, path: str) -> DataFrame:
    """CSV feature table whose column types are discovered; parquet keeps its own types."""
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    return spark.read.csv(path, header=True, inferSchema=True, quote='"', escape='"')


def read_texts(spark: SparkSession, path: str, id_pattern: str = r"(\d+)\.txt$") -> DataFrame:
    """One document per file; the id comes from the file path. Undecodable bytes become U+FFFD.

    Files whose path has no id that fits a long are left out; ``stray_files`` lists them.
    """
    # List folders in a few tasks per core; the default is one task per folder.
    setting = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(4 * spark.sparkContext.defaultParallelism))
    try:
        files = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True)
    finally:
        spark.conf.set(setting, before)
    return with_ids(files, id_pattern)


def with_ids(files: DataFrame, id_pattern: str) -> DataFrame:
    """``(doc_id, text)`` of the files whose path gives an id."""
    found = files.select(F.regexp_extract(F.input_file_name(), id_pattern, 1).alias("_id"), F.col("value").alias("text"))
    return found.select(F.expr("try_cast(_id AS bigint)").alias("doc_id"), "text").where("doc_id IS NOT NULL")


def stray_files(spark: SparkSession, path: str, id_pattern: str = r"(\d+)\.txt$") -> DataFrame:
    """``(file)``: the files below ``path`` that ``read_texts`` leaves out. Only names are read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(F.col("path").alias("file"))
    return files.where(F.try_to_number(F.regexp_extract("file", id_pattern, 1), F.lit("9" * 19)).isNull())


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def missing_texts(catalogue: DataFrame, cache: DataFrame, key: str = "doc_id") -> DataFrame:
    """Catalogue rows whose text is not in the cache yet."""
    return catalogue.join(cache.select(key), key, "left_anti")


def cached_or_empty(catalogue: DataFrame, cache: DataFrame, key: str = "doc_id") -> DataFrame:
    """Every catalogue row with its cached text, or with an empty text."""
    return catalogue.join(cache, key, "left").withColumn("text", F.coalesce("text", F.lit("")))


def spread(df: DataFrame, key: str) -> DataFrame:
    """Give a scan that is narrower than the cluster one partition per core; wide scans pass unchanged."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df
