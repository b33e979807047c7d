"""Packing of token sequences: every document is cut into pieces whose lengths are powers of two."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexiframe.llm.periodic_runs import text_slices
from lexiframe.llm.token_ids import text_encoder
from lexiframe.session import materialize

END_ID = 2
SLICE_BYTES = 2_000_000  # of text whose pieces are made at a time; a longer text is one alone


def binary_lengths(n: int, longest: int) -> list[int]:
    """The pieces of ``n`` ids, longest first: as many of ``longest`` as fit, then the binary digits of the rest."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << k for k in reversed(range(rest.bit_length())) if rest >> k & 1]


def pieces(
    docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", longest: int = 4096, ids: bool = False
) -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset, and ``ids`` if asked for.

    A document is the ids of its text by the tokenizer in file ``tokenizer`` followed by the end id; a null or
    empty text has the end id alone. Each is cut into powers of two up to ``longest`` (a power of two), and each piece
    is a sequence of its own, so no sequence crosses documents and none is padded. Pieces of one length form a
    bucket: ``sequence_id`` numbers the sequences without gaps, bucket after bucket from the longest on, so a batch
    of equal lengths is a range of numbers. Repeated keys and rows are packed like any other row.

    Tokenizing happens once, into a table in shared storage; numbers come from the counts per task and length.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, start long, length long, ids_crc32 long, doc_tokens long, part int, nth long"
    names = [key, "start", "length", "ids_crc32", "doc_tokens", "part", "nth"] + ["ids"] * ids
    end = END_ID.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, seen, part = text_encoder(tokenizer), Counter(), TaskContext.get().partitionId()
        for whole in batches:
            for at, to in text_slices(whole.column(1), SLICE_BYTES):
                batch = whole.slice(at, to - at)
                keys, rows, raw, last = [], [], [], 0
                coded, sizes = encode(batch.column(1))
                for k, n_ids in zip(batch.column(0).to_pylist(), sizes.tolist(), strict=True):
                    doc, start = coded[last : last + 4 * n_ids] + end, 0
                    last += 4 * n_ids
                    total = n_ids + 1
                    for n in binary_lengths(total, longest):
                        piece = doc[4 * start : 4 * (start + n)]
                        keys.append(k)
                        rows.append((start, n, zlib.crc32(piece), total, part, seen[n]))
                        if ids:
                            raw.append(piece)
                        seen[n] += 1
                        start += n
                yield made(batch, keys, rows, raw)

    def made(batch, keys, rows, raw) -> pa.RecordBatch:
        kinds = [pa.int64()] * 4 + [pa.int32(), pa.int64()]
        columns = [pa.array(keys, batch.schema.field(0).type)]
        columns += [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
        return pa.RecordBatch.from_arrays(columns + [pa.array(raw, pa.binary())] * ids, names=names)

    source = docs.select(key, F.col(text).cast("string").alias("_text"))
    cut = materialize(source.mapInArrow(run, schema + ", ids binary" * ids), "pieces")
    # one row per task and length: tasks times thirteen at most, summed before they meet
    counts = cut.groupBy("length", "part").agg((F.max("nth") + 1).alias("n"))
    before = F.sum("n").over(W.orderBy(F.desc("length"), "part").rowsBetween(W.unboundedPreceding, -1))
    counts = materialize(counts.select("length", "part", F.coalesce(before, F.lit(0)).alias("first")), "counts")
    table = cut.join(counts, ["length", "part"])
    return table.select(
        key,
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        (F.col("first") + F.col("nth")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
        *["ids"] * ids,
    )
