"""Near-duplicate vectors by Euclidean p-stable hashing and exact cosines."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiframe.llm.components import components
from lexiframe.session import materialize

BLOCK = 512


def projections(size: int, tables: int, depth: int, width: float, seed: int = 11) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Normal directions ``(size, tables * depth)``, even offsets in ``[0, width)`` and odd multipliers for the buckets."""
    rng = np.random.default_rng(seed)
    odd = rng.integers(0, 1 << 62, depth, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return rng.normal(size=(size, tables * depth)), rng.uniform(0, width, tables * depth), odd


def buckets(vectors: np.ndarray, tables: int, depth: int, width: float) -> np.ndarray:
    """The bucket of each vector in each table, ``(rows, tables)`` of 32 bits.

    Vectors are normalised and projected; a table's bucket is its ``depth`` projections, shifted and cut to steps of
    ``width``, as one hash. Vectors of different sizes are dealt by directions of their own.
    """
    directions, offsets, odd = projections(vectors.shape[1], tables, depth, width)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    steps = np.floor((unit @ directions + offsets) / width).astype(np.int64).view(np.uint64).reshape(len(vectors), tables, depth)
    total = np.zeros(steps.shape[:2], np.uint64)
    for k in range(depth):
        total = (total ^ steps[:, :, k]) * odd[k]
        total ^= total >> np.uint64(29)
    return (total >> np.uint64(32)).astype(np.uint32).view(np.int32)


def block_links(ids: np.ndarray, copies: np.ndarray, vectors: np.ndarray, keys: np.ndarray, side: np.ndarray, table: int, least: float):
    """Links among the rows of one bucket or between two of its blocks: ``(id, links, root)`` for rows that have any.

    ``side`` is 0 or 1 by block (equal for a block with itself). A pair counts only in the first table whose bucket it
    shares. ``root`` is the smallest id a row reaches over all links seen here.
    """
    order = np.argsort(ids, kind="stable")
    ids, copies, vectors, keys, side = ids[order], copies[order], vectors[order], keys[order], side[order]
    norms = np.linalg.norm(vectors, axis=1)
    linked = vectors @ vectors.T / np.outer(norms, norms) >= least
    if side.any():
        linked &= side[:, None] != side[None, :]
    np.fill_diagonal(linked, False)
    rows, others = np.nonzero(linked)
    if not len(rows):
        return None
    early = np.zeros(len(rows), bool)
    for at in range(0, len(rows), 1 << 15):
        cut = slice(at, at + (1 << 15))
        early[cut] = (keys[rows[cut], :table] == keys[others[cut], :table]).any(1)
    links = np.bincount(rows[~early], copies[others[~early]], len(ids)).astype(np.int64)
    root = np.arange(len(ids))
    while True:
        least_near = root.copy()
        np.minimum.at(least_near, rows, root[others])
        least_near = np.minimum(least_near, least_near[least_near])
        if (least_near == root).all():
            break
        root = least_near
    seen = np.unique(rows)
    return ids[seen], links[seen], ids[root[seen]]


def vector_links(reps: DataFrame, size: int, least: float, tables: int, depth: int, width: float) -> DataFrame:
    """``(rep, links, root)`` rows of all buckets of ``reps (rep, copies, embedding)``, vectors of ``size`` components."""

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                flat = batch.column(2).flatten().to_numpy(zero_copy_only=False)
                keys = buckets(flat.astype(np.float64).reshape(-1, size), tables, depth, width)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array([r.tobytes() for r in flat.reshape(-1, size)]), pa.array([r.tobytes() for r in keys])],
                    names=["rep", "copies", "vector", "keys"],
                )

    item = reps.schema["embedding"].dataType.elementType.simpleString()
    dtype = {"float": np.float32, "double": np.float64}[item]
    rows = materialize(reps.mapInArrow(dealt, "rep long, copies long, vector binary, keys binary"), "keys")
    each = F.expr(f"transform(sequence(0, {tables - 1}), t -> struct(t AS t, substring(keys, 4 * t + 1, 4) AS k))")
    member = rows.select("rep", F.explode(each).alias("x")).select("rep", "x.t", "x.k")
    sizes = materialize(member.groupBy("t", "k").agg(F.count("*").alias("n")).where("n > 1"), "buckets")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("rep"), blocks).cast("int")
    shared = member.join(sizes, ["t", "k"]).select("rep", "t", "k", blocks.alias("nb"), own.alias("b"))
    meets = F.expr("transform(sequence(0, nb - 1), o -> struct(least(b, o) AS lo, greatest(b, o) AS hi))")
    placed = shared.select("rep", "t", "k", "b", F.explode(meets).alias("m"))
    full = placed.select("rep", "t", "k", "m.lo", "m.hi", F.when(F.col("m.lo") == F.col("m.hi"), 0).otherwise((F.col("b") == F.col("m.hi")).cast("int")).alias("side")).join(rows, "rep")
    n_tasks = int(reps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    group = ["t", "k", "lo", "hi"]
    full = full.repartition(n_tasks, *group).sortWithinPartitions(*group)

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([carried, table]) if carried is not None else table
            parts = [table.column(c).to_numpy(zero_copy_only=False) for c in ("t", "lo", "hi")] + [np.array(table.column("k").to_pylist(), dtype=object)]
            change = np.flatnonzero(np.logical_or.reduce([p[1:] != p[:-1] for p in parts])) + 1
            cuts = [0, *change.tolist()]
            yield from found(table, cuts)
            carried = table.slice(cuts[-1])
        if carried is not None:
            yield from found(carried, [0, carried.num_rows])

    def found(table: pa.Table, cuts: list[int]) -> Iterator[pa.RecordBatch]:
        if len(cuts) < 2:
            return
        column = lambda c: table.column(c).to_numpy(zero_copy_only=False)
        ids, copies, side, numbers = column("rep"), column("copies"), column("side"), column("t")
        out = []
        for a, b in zip(cuts, cuts[1:]):
            if b - a < 2:
                continue
            raw, keys = (b"".join(table.column(c).slice(a, b - a).to_pylist()) for c in ("vector", "keys"))
            vectors = np.frombuffer(raw, dtype).reshape(b - a, size).astype(np.float64)
            keys = np.frombuffer(keys, np.int32).reshape(b - a, tables)
            got = block_links(ids[a:b], copies[a:b], vectors, keys, side[a:b], int(numbers[a]), least)
            if got is not None:
                out.append(got)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=["rep", "links", "root"])

    return full.select(*group, "rep", "copies", "side", "vector", "keys").mapInArrow(compared, "rep long, links long, root long")


def near_vectors(
    vectors: DataFrame,
    key: str = "vec_id",
    embedding: str = "embedding",
    least: float = 0.9,
    tables: int = 32,
    depth: int = 10,
    width: float = 2.0,
) -> DataFrame:
    """``(key, n_links, component_id, kept)`` per row: other vectors linked directly, the smallest key reachable over
    links, and whether that is its own.

    Two vectors link if some table puts them in one bucket and their cosine, in double precision, is at least
    ``least``. At the default settings a pair of cosine 0.9 shares a bucket with probability over 0.99, one of 0.95
    with over 0.9999; more ``tables`` raise it, a larger ``depth`` suits larger collections. Null vectors, vectors of
    length 0 and those with null or non-finite components link with nothing; vectors of different sizes never link.
    Rows with a null key are left out, repeated keys count as vectors of their own.

    Equal vectors are one class that keeps its number of copies, so copies are never compared. A bucket of more than
    512 classes is split into blocks and each pair of blocks is a piece of work of its own; pairs leave it as counts and
    a spanning forest, never as rows.
    """
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(embedding).alias("embedding")).where("id IS NOT NULL")
    item = rows.schema["embedding"].dataType.elementType.simpleString()
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")).cast(item)))
    valid = rows.where(F.col("embedding").isNotNull() & finite & F.exists("embedding", lambda x: x != 0))
    classes = valid.groupBy("embedding").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    classes = materialize(classes.withColumn("size", F.size("embedding")), "classes")
    linked = None
    sizes = [r["size"] for r in classes.select("size").distinct().orderBy("size").limit(1001).collect()]
    if len(sizes) > 1000:
        raise ValueError("vectors of more than 1,000 different sizes")
    for size in sizes:
        part = vector_links(classes.where(F.col("size") == size).select("rep", "copies", "embedding"), size, least, tables, depth, width)
        linked = part if linked is None else linked.unionByName(part)
    if linked is None:
        none = F.lit(0).cast("long")
        return rows.select(F.col("id").alias(key), none.alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    linked = materialize(linked, "links")
    joined = components(linked.where("rep <> root").select(F.col("rep").alias("a"), F.col("root").alias("b")))
    counts = linked.groupBy("rep").agg(F.sum("links").alias("links"))
    per_class = classes.join(counts, "rep", "left").join(joined.withColumnRenamed("node", "rep"), "rep", "left")
    per_class = materialize(
        per_class.select(
            "embedding",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        ),
        "per_class",
    )
    found = valid.join(per_class, "embedding").select("id", "n_links", "component_id")
    # what links with nothing
    other = rows.where(~(F.col("embedding").isNotNull() & F.coalesce(finite & F.exists("embedding", lambda x: x != 0), F.lit(False))))
    other = other.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return found.unionByName(other).select(
        F.col("id").alias(key), "n_links", "component_id", (F.col("id") == F.col("component_id")).alias("kept")
    )
