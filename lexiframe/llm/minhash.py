"""Near-duplicates by the similarity of their word shingles: SimHash and minima of hashes find candidates, exact sets decide."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiframe.llm import simhash
from lexiframe.llm.components import components
from lexiframe.session import lookup_join, materialize

SEED = 42
BANDS, ROWS = 25, 5
_rng = np.random.default_rng(SEED)
MIXERS = _rng.integers(1 << 62, size=(BANDS * ROWS, 1), dtype=np.uint64)
ODD = np.uint64(0x9E3779B97F4A7C15)
SLICE_SHINGLES, SLICE_COLUMNS = 2_000_000, 4_096  # of a group worked on at a time


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``width`` words; a shorter text is one run, one without words none."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    rows = zip(*(words[k:] for k in range(width)), strict=False) if len(words) >= width else [words]
    return np.unique(np.array([digest(b" ".join(r), SEED) for r in rows], dtype=np.uint64))


def signature(found: np.ndarray) -> np.ndarray:
    """The upper halves of the least values of ``found`` under each of the mixing functions."""
    least = np.full(len(MIXERS), np.iinfo(np.uint64).max)
    for at in range(0, len(found), 2048):
        x = (found[at : at + 2048] ^ MIXERS) * ODD
        x ^= x >> np.uint64(32)
        x *= ODD
        least = np.minimum(least, x.min(1))
    return (least >> np.uint64(32)).astype("<u4")


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / max(1, len(a) + len(b) - both)


def signatures(docs: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """``(key, same, fp, bands)`` per row: a digest of the set of shingles, its SimHash and a hash of each band of its signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same, fps, bands = [], [], []
            for t in batch.column(1):
                found = shingles(t.as_py(), width)
                same.append(xxhash.xxh3_128_digest(found.tobytes()))
                fps.append(simhash.majority(found))
                bands.append([xxhash.xxh64_intdigest(r.tobytes(), SEED) - (1 << 63) for r in signature(found).reshape(BANDS, ROWS)])
            fp = pa.array(np.array(fps, np.uint64).view(np.int64))
            columns = [pa.array(same, pa.binary()), fp, pa.array(bands, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["_key", "same", "fp", "bands"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("_key"), F.col(text).cast("string"))
    return rows.mapInArrow(run, f"_key {kind}, same binary, fp bigint, bands array<bigint>")


def similarities(sets: list[np.ndarray]) -> np.ndarray:
    """``similarity`` of every two sets: what they share comes from matrix products over the shingles that several hold."""
    n, sizes = len(sets), np.array([len(s) for s in sets])
    both = np.zeros((n, n), np.float32)  # whole numbers far below 2 ** 24
    parts = -(-int(sizes.sum()) // SLICE_SHINGLES)  # sets are sorted, so a range of hashes is a slice of each
    bounds = np.array([(i << 64) // parts for i in range(1, parts)], np.uint64)
    cuts = [np.concatenate([[0], np.searchsorted(s, bounds), [len(s)]]).astype(int) for s in sets]
    for part in range(parts):
        pieces = [s[c[part] : c[part + 1]] for s, c in zip(sets, cuts, strict=True)]
        _, column, uses = np.unique(np.concatenate(pieces), return_inverse=True, return_counts=True)
        shared = uses > 1
        number = np.cumsum(shared) - 1
        row, held = np.repeat(np.arange(n), [len(x) for x in pieces]), shared[column]
        row, column = row[held], number[column[held]]
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        for at in range(0, int(shared.sum()), SLICE_COLUMNS):
            low, high = np.searchsorted(column, [at, at + SLICE_COLUMNS])
            holds = np.zeros((n, SLICE_COLUMNS), np.float32)
            holds[row[low:high], column[low:high] - at] = 1
            both += holds @ holds.T
    both = both.astype(np.float64)
    np.fill_diagonal(both, sizes)
    return both / np.maximum(1, sizes[:, None] + sizes - both)


def forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Links that hold together what the symmetric matrix ``linked`` holds together, one less than members in each part."""
    out, fresh = [], np.ones(len(linked), bool)
    for root in range(len(linked)):
        if fresh[root]:
            fresh[root], waiting = False, [root]
            while waiting:
                at = waiting.pop()
                found = np.flatnonzero(linked[at] & fresh)
                fresh[found] = False
                out += [(at, int(to)) for to in found]
                waiting += found.tolist()
    return out


def _links_of(groups: DataFrame, least: float) -> DataFrame:
    """``(a, b)``: in each group of ``(g, side, rep, set)`` links that hold its linked rows together. Rows of side 0 meet all
    others, rows of sides 1 and 2 only each other."""

    def of(side: np.ndarray, reps: list, sets: list[bytes]) -> tuple[list, list]:
        linked = similarities([np.frombuffer(s, "<u8") for s in sets]) >= least
        linked &= (side[:, None] != side) | (side == 0)
        links = [(reps[i], reps[j]) for i, j in forest(linked) if reps[i] != reps[j]]
        return [max(x) for x in links], [min(x) for x in links]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, waiting = None, []

        def flushed(table: pa.Table) -> pa.RecordBatch:
            side = table["side"].to_numpy()
            a, b = of(side, table["rep"].to_pylist(), table["set"].to_pylist())
            return pa.RecordBatch.from_arrays([pa.array(a, kind), pa.array(b, kind)], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            kind, g = batch.schema.field("rep").type, batch.column("g").to_numpy()
            starts = [0, *(np.flatnonzero(np.diff(g)) + 1).tolist()]
            for at, to in zip(starts, [*starts[1:], len(g)], strict=True):
                if waiting and waiting[-1].column("g")[0].as_py() != g[at]:
                    yield flushed(pa.Table.from_batches(waiting))
                    waiting = []
                waiting.append(batch.slice(at, to - at))
        if waiting:
            yield flushed(pa.Table.from_batches(waiting))

    kind = groups.schema["rep"].dataType.simpleString()
    return groups.repartition("g").sortWithinPartitions("g").mapInArrow(run, f"a {kind}, b {kind}")


def _met(rows: DataFrame, centers: DataFrame) -> DataFrame:
    """``rows (t, k, rep, set)`` with their bucket's center and their similarity to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets, others = ([np.frombuffer(s, "<u8") for s in batch.column(c).to_pylist()] for c in (3, 5))
            share = pa.array([similarity(x, y) for x, y in zip(sets, others, strict=True)], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], share], names=[*batch.schema.names[:5], "share"])

    kind = rows.schema["rep"].dataType.simpleString()
    met = lookup_join(rows, centers, ["t", "k"]).select("t", "k", "rep", "set", "center", "other")
    return met.mapInArrow(run, f"t int, k bigint, rep {kind}, set binary, center {kind}, share double")


def _in_blocks(one: DataFrame, two: DataFrame | None, size: int) -> DataFrame:
    """Groups in which every row ``(t, k, rep, set)`` of a bucket meets every other one, or, of ``one``, every one of ``two``."""
    sides = [one] if two is None else [one, two]
    counts = [x.groupBy("t", "k").agg(F.ceil(F.count("*") / size).cast("int").alias(f"n{i}")) for i, x in enumerate(sides)]
    counts = counts[0] if two is None else counts[0].join(counts[1], ["t", "k"])
    counts = materialize(counts, "blocks")
    out = None
    for i, x in enumerate(sides):
        own = F.pmod(F.xxhash64("rep", "set"), F.col(f"n{i}")).cast("int")
        rows = lookup_join(x, counts, ["t", "k"]).withColumn("own", own)
        others = F.explode(F.sequence(F.lit(0), F.col(f"n{len(sides) - 1 - i}") - 1)).alias("met")
        rows = rows.select("t", "k", "rep", "set", "own", others)
        if two is None:
            ends = [F.least("own", "met"), F.greatest("own", "met")]
            side = F.when(ends[0] == ends[1], 0).when(F.col("own") < F.col("met"), 1).otherwise(2)
        else:
            ends, side = (["own", "met"] if i == 0 else ["met", "own"]), F.lit(i + 1)
        part = rows.select(F.xxhash64("t", "k", *ends, F.lit(two is None)).alias("g"), side.alias("side"), "rep", "set")
        out = part if out is None else out.unionByName(part)
    return out


def _compared(members: DataFrame, texts: DataFrame, width: int, least: float, direct: int, rounds: int = 3) -> DataFrame:
    """Links ``(a, b)`` that hold together all rows of ``members (t, k, rep)`` that share a bucket ``(t, k)`` and are alike.

    Every row brings its set of shingles to its buckets, so a bucket is one group: what its members share comes from matrix
    products, and a spanning forest of the links comes out. A bucket of over ``direct`` members first meets its smallest one.
    Those linked to it are held together by that, so they meet only such others as may be alike to them: Jaccard distances
    obey the triangle inequality, so these lie within twice the distance allowed. The others are a bucket of their own in
    the next round; after the last one blocks of ``direct`` members meet in pairs. So a group of copies is not compared with
    itself, no task holds more than two blocks, and no pair that may be linked goes uncompared.
    """
    direct = max(1, direct)
    counts = materialize(members.groupBy("t", "k").agg(F.count("*").alias("c")).where("c > 1"), "buckets")
    listed = lookup_join(members, counts, ["t", "k"]).groupBy("rep").agg(F.collect_set(F.struct("t", "k", "c")).alias("places"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = pa.array([shingles(t.as_py(), width).astype("<u8").tobytes() for t in batch.column(2)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), sets], names=["rep", "places", "set"])

    kind, places = members.schema["rep"].dataType.simpleString(), "array<struct<t: int, k: bigint, c: bigint>>"
    held = lookup_join(texts, listed, "rep").select("rep", "places", "text").mapInArrow(run, f"rep {kind}, places {places}, set binary")
    held = materialize(held.dropDuplicates(["rep", "set"]), "sets").select("rep", "set", F.inline("places"))
    whole = (F.xxhash64("t", "k").alias("g"), F.lit(0).alias("side"), "rep", "set")
    links = materialize(_links_of(held.where(F.col("c") <= direct).select(*whole), least), "links")
    many = held.where(F.col("c") > direct).select("t", "k", "rep", "set")
    far = 2 * (1 - least) + 1e-9
    for _ in range(rounds):
        first = many.groupBy("t", "k").agg(F.min(F.struct("rep", "set")).alias("x"), F.count("*").alias("c"))
        first = materialize(first.select("t", "k", F.col("x.rep").alias("center"), F.col("x.set").alias("other"), "c").where("c > 1"), "centers")
        if first.isEmpty():
            return links
        crowded = first.where(F.col("c") > direct).drop("c")
        met = materialize(_met(many, crowded), "met")
        tied, rest = met.where(F.col("share") >= least), met.where(F.col("share") < least)
        found = tied.where("rep <> center").select(F.greatest("rep", "center").alias("a"), F.least("rep", "center").alias("b"))
        small = first.where(F.col("c") <= direct).select("t", "k")
        groups = _in_blocks(rest.where(1 - F.col("share") <= far), tied, direct)
        groups = groups.unionByName(lookup_join(many, small, ["t", "k"], "left_semi").select(*whole))
        links = links.unionByName(found).unionByName(materialize(_links_of(groups, least), "links"))
        many = rest.select("t", "k", "rep", "set")
    return links.unionByName(materialize(_links_of(_in_blocks(many, None, direct), least), "links"))


def print_links(sigs: DataFrame, texts: DataFrame, width: int, least: float, direct: int, radius: int = 2) -> DataFrame:
    """Links ``(a, b)`` that hold together the rows of ``sigs (rep, fp)`` whose fingerprints differ in at most ``radius`` bits, as
    ``simhash.near_links`` finds them, and whose sets of shingles are alike. Equal fingerprints are a bucket, and so are the
    smallest rows of those near one."""
    classes = materialize(sigs.groupBy("fp").agg(F.min("rep").alias("rep")), "prints")
    close = simhash.near_links(classes, radius, min(direct, 32)).select("a", "b")
    around = close.select("b", F.explode(F.array("a", "b")).alias("rep")).distinct()
    stars = around.select(F.lit(1).alias("t"), F.xxhash64("b").alias("k"), "rep")
    equal = sigs.select(F.lit(0).alias("t"), F.col("fp").alias("k"), "rep").distinct()
    return _compared(materialize(equal.unionByName(stars), "members"), texts, width, least, direct)


def near_links(sigs: DataFrame, texts: DataFrame, width: int, least: float, direct: int) -> DataFrame:
    """Links ``(a, b)`` that hold together the rows of ``sigs (rep, bands)`` that agree in a band and are alike. Rows that agree
    in a band share a bucket, and all that do are compared."""
    rows = sigs.select("rep", F.posexplode("bands").alias("t", "k")).select("t", "k", "rep")
    return _compared(rows, texts, width, least, direct)


def drop_near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, least: float = 0.8, direct: int = 512
) -> DataFrame:
    """``docs`` without the rows linked to one of a smaller key, at once or over other links; all columns unchanged.

    Two texts are linked if the Jaccard similarity of their sets of ``width``-word shingles (ASCII letters lower-cased,
    words between ASCII blanks) is ``least`` or more. Links are sought by SimHash of the shingles, at most 2 of 64 bits
    apart, which finds the closest copies, and by 25 bands of 5 minima: a pair of
    similarity 0.8 meets with a chance of 0.99995, one of 0.9 with a miss in 10**9. Rows that meet are all compared. Texts
    without words are one group. What stays is the smallest key of everything held together by links.
    Repeated rows of one key are kept or dropped together; rows with a null key are kept.
    """
    keyed = docs.where(F.col(key).isNotNull())
    prints = materialize(signatures(keyed, key, text, width), "signatures")
    # rows with equal sets have equal fingerprints and bands
    reps = prints.groupBy("same").agg(F.min("_key").alias("rep"), F.first("fp").alias("fp"), F.first("bands").alias("bands"))
    reps = materialize(reps, "classes")
    texts = keyed.select(F.col(key).alias("rep"), F.col(text).cast("string").alias("text"))
    links = print_links(reps, texts, width, least, direct).unionByName(near_links(reps, texts, width, least, direct))
    joined = components(links)
    linked = joined.where("node <> component").select(F.col("node").alias("rep"))
    linked = materialize(linked, "linked").withColumn("out", F.lit(True))
    classes = materialize(reps.select("same", "rep").join(linked, "rep", "left"), "joined")
    gone = prints.select("same", "_key").join(classes, "same").where((F.col("_key") != F.col("rep")) | F.col("out"))
    gone = gone.select(F.col("_key").alias(key)).distinct()
    return docs.join(materialize(gone, "dropped"), key, "left_anti").select(*[f"`{c}`" for c in docs.columns])
