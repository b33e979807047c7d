"""Near-duplicates by SimHash: fingerprints of word shingles, linked through covering bit masks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiframe.llm.components import components
from lexiframe.session import materialize

BITS = 64
SEED = 42


def covering_masks(radius: int) -> list[int]:
    """Bit masks such that any two fingerprints with at most ``radius`` differing bits agree under one of them.

    Every bit position gets a nonzero vector of ``radius + 1`` bits, dealt in turn; the mask of a nonzero vector
    ``v`` holds the positions whose vector has odd overlap with ``v``. The vectors of ``radius`` positions span less
    than the whole space, so some ``v`` is orthogonal to all of them and its mask holds none of those positions.
    """
    size = 2 ** (radius + 1) - 1
    return [
        sum(1 << i for i in range(BITS) if ((1 + i % size) & v).bit_count() % 2) for v in range(1, size + 1)
    ]


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def fingerprint(text: str | None, width: int) -> int:
    """SimHash of one text as an unsigned number; see ``fingerprints``."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 16):
        part = words[at : min(n, at + (1 << 16)) + width - 1]
        rows = zip(*(part[k:] for k in range(width)), strict=False) if len(words) >= width else [words]
        hashes = np.array([digest(b" ".join(r), SEED) for r in rows], dtype="<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def majority(hashes: np.ndarray) -> int:
    """SimHash of 64-bit hashes, as an unsigned number: a bit is set where over half of them set it; 0 without any."""
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].astype("<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """``(key, fp)`` per row: the 64-bit SimHash of the text's word shingles, as a signed long.

    ASCII letters are lower-cased, words are what ASCII blanks separate, shingles are ``width`` words with one
    blank between, repeats included; a shorter text is one shingle. Shingles are hashed by XXH64 with seed 42 and a
    bit is set where over half the hashes set it. A null or empty text, or one of blanks only, has fingerprint 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [_signed(fingerprint(t.as_py(), width)) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.int64())], names=[key, "fp"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, F.col(text).cast("string")).mapInArrow(run, f"`{key}` {kind}, fp long")


def near_links(prints: DataFrame, radius: int = 2, direct: int = 32) -> DataFrame:
    """Links ``(a, b)`` between rows of ``prints (fp, rep)``, distinct fingerprints, whose transitive closure equals
    that of all pairs with at most ``radius`` differing bits.

    One table per covering mask; a bucket holds the fingerprints that agree under the mask. A bucket with up to
    ``direct`` members is compared pair by pair. In a larger one the pairs would outnumber the rows, so its members
    meet at common neighbours instead: each goes to all fingerprints within ``radius // 2`` flipped bits outside the
    mask, members at one neighbour differ in at most ``radius`` bits, and for an even ``radius`` any two that are so
    close, and agree under the mask, have such a neighbour. Both ways are exact; ``direct`` only sets the cheaper.
    """
    if radius % 2 or not 0 < radius <= 4:
        raise ValueError("radius must be 2 or 4")
    masks = covering_masks(radius)
    rows = prints.select(
        "fp",
        "rep",
        F.explode(
            F.array(*[
                F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("k"))
                for t, m in enumerate(masks)
            ])
        ).alias("x"),
    ).select("fp", "rep", "x.t", "x.k")
    shared = materialize(rows.groupBy("t", "k").agg(F.count("*").alias("c")).where("c > 1"), "buckets")
    members = materialize(rows.join(shared, ["t", "k"]), "members")

    few = members.where(F.col("c") <= direct)
    right = few.select("t", "k", F.col("fp").alias("fp2"), F.col("rep").alias("rep2"))
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("fp2"))) <= radius
    pairs = few.join(right, ["t", "k"]).where("fp < fp2").where(near)
    pairs = pairs.select(F.col("rep").alias("a"), F.col("rep2").alias("b"))

    spots = F.lit(None)
    for t, m in enumerate(masks):
        flips = [0] + [1 << i for i in range(BITS) if not m >> i & 1]
        if radius == 4:
            flips += [x | y for i, x in enumerate(flips[1:]) for y in flips[i + 2 :]]
        spots = F.when(F.col("t") == t, F.array(*[F.lit(_signed(x)) for x in flips])).otherwise(spots)
    at = members.where(F.col("c") > direct).select("fp", "rep", F.explode(spots).alias("flip"))
    at = at.select("rep", F.col("fp").bitwiseXOR(F.col("flip")).alias("spot"))
    # a spot gathers distinct fingerprints within radius // 2 bits of it: a fixed number at most
    met = at.groupBy("spot").agg(F.collect_set("rep").alias("reps")).where(F.size("reps") > 1)
    met = met.select(F.explode("reps").alias("a"), F.array_min("reps").alias("b")).where("a <> b")
    return pairs.unionByName(met).distinct()


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3, radius: int = 2, direct: int = 32
) -> DataFrame:
    """``(key, fp, component)`` per row: its fingerprint and the smallest key reachable over links of at most
    ``radius`` differing bits, its own included.

    Equal fingerprints are one class from the start, so copies never meet each other. Rows whose key is null are
    left out. Repeated keys are rows of their own. An empty table gives an empty result.
    """
    prints = materialize(fingerprints(docs.where(F.col(key).isNotNull()), key, text, width), "fingerprints")
    reps = materialize(prints.groupBy("fp").agg(F.min(key).alias("rep")), "classes")
    joined = components(near_links(reps, radius, direct))
    classes = reps.join(joined.withColumnRenamed("node", "rep"), "rep", "left").select(
        "fp", F.coalesce("component", "rep").alias("component")
    )
    return prints.join(materialize(classes, "joined"), "fp").select(key, "fp", "component")


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose key is the smallest of its group of near-duplicates, all columns unchanged.

    Repeated rows of one key are kept or dropped together; rows with a null key are kept.
    """
    found = near_duplicates(docs, key, text, **options)
    gone = found.where(F.col(key) != F.col("component")).select(key).distinct()
    return docs.join(materialize(gone, "dropped"), key, "left_anti").select(*[f"`{c}`" for c in docs.columns])
