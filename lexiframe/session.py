"""Session defaults, shared scratch space and size-checked lookup joins."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_LOOKUP_ROWS = 200_000
MAX_LOOKUP_BYTES = 16_000_000  # of the written table, which is packed; a broadcast holds a few times that


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the bench. A cluster brings its own session."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("lexiframe")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )


_local_roots: dict[str, str] = {}


def _scratch_root(spark: SparkSession) -> str:
    """The shared folder in ``spark.checkpoint.dir``; a local folder only where it is unset and the master is local."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError(f"set spark.checkpoint.dir to a folder that all machines of {master} share")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="lexiframe-")
    return _local_roots[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a table that a job writes and reads back."""
    path = f"{_scratch_root(spark)}/lexiframe/{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return f"{path}/{name}"


_scopes: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes, at its end, all scratch tables made inside: for a job that writes its result before it ends.

    DataFrames that read those tables cannot be used afterwards.
    """
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def written_bytes(table: DataFrame) -> int:
    """Size of the files a table is read from."""
    spark, total = table.sparkSession, 0
    for file in table.inputFiles():
        path = spark._jvm.org.apache.hadoop.fs.Path(file)
        total += path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).getLen()
    return total


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_end(spark: SparkSession) -> Iterator[None]:
    """What is run inside drops its shuffle files at its end; a version of Spark without the setting keeps them as ever."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write once to shared storage and read back: cuts lineage and survives the loss of executors.

    Once the table is written nothing reads the shuffles that led to it, so their files go.
    """
    path = scratch_path(df.sparkSession, name)
    with _shuffles_end(df.sparkSession):
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Deletes a table that ``materialize`` made, for one that no DataFrame reads any more."""
    spark = table.sparkSession
    root = spark._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark)).toUri().getPath().rstrip("/") + "/lexiframe/"
    for path in {"/".join(file.split("/")[:-2]) for file in table.inputFiles()}:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        if not folder.toUri().getPath().startswith(root):
            raise ValueError(f"{path} is no scratch table")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def packed(df: DataFrame, rows_per_partition: int = 50_000) -> DataFrame:
    """Fewer partitions for a table with few rows, as a fit starts a job per step; never fewer than the rows need."""
    wanted = max(1, -(-df.count() // rows_per_partition))
    return df.coalesce(wanted) if df.rdd.getNumPartitions() > wanted else df


def lookup_join(
    df: DataFrame,
    lookup: DataFrame,
    on: list[str] | str,
    how: str = "inner",
    at_most: int | None = None,
    max_rows: int = MAX_LOOKUP_ROWS,
) -> DataFrame:
    """Join a table with a lookup table, broadcasting the lookup only if its size is known to be small.

    The lookup is worked out once and written to shared storage, its rows are counted and its files measured there,
    and only then is the hint given. A larger lookup is joined without a hint, so Spark picks a shuffle join and
    adaptive execution splits hot keys. ``at_most`` states a bound on the rows that the plan itself guarantees, such as
    a limit; it is for rows of a few short columns.
    """
    if at_most is None:
        lookup = materialize(lookup, "lookup")
        at_most = lookup.count()
        if at_most <= max_rows and written_bytes(lookup) > MAX_LOOKUP_BYTES:
            at_most = max_rows + 1
    return df.join(F.broadcast(lookup) if at_most <= max_rows else lookup, on, how)
