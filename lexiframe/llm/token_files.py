"""Token ids in binary files: one concatenated id array a file, document boundaries as an Elias-Fano code."""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiframe.llm.elias_fano import EliasFano
from lexiframe.llm.token_ids import text_encoder
from lexiframe.session import materialize, scratch_path

END_ID = 2
MAGIC = b"TOKIDS01"
#: bytes of an id, ids, documents, documents without a key, bytes of the boundaries and of the keys, then ``MAGIC``
TAIL = struct.Struct("<BQQQQQ8s")
READ_IDS = 8_000_000  # about so many ids are read by one task at a time
CHUNK_IDS = 1_000_000
FILES = "part int, file string, n_docs long, n_ids long, bytes long, first_id long"


def store(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path within it of a path as Spark names it."""
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


class TokenFileWriter:
    """Appends documents to a file; only their boundaries and keys stay in memory until it is closed.

    The file holds, one after another: the ids of all documents, 2 bytes each if the vocabulary allows, else 4; the
    Elias-Fano code of where each document ends; the Elias-Fano code of the keys, ascending, those without a key first;
    and a tail that says how long each part is. All numbers are little-endian.
    """

    def __init__(self, stream, width: int):
        self.stream, self.width = stream, width
        self.sizes: list[np.ndarray] = []
        self.keys: list[np.ndarray] = []
        self.n_null = self.n_ids = self.n_docs = 0

    def append(self, ids: np.ndarray, sizes: np.ndarray, keys: np.ndarray, n_null: int) -> None:
        """Documents of ``sizes`` ids each; the first ``n_null`` of them have no key, the others ``keys``."""
        self.stream.write(ids.astype(f"<u{self.width}").tobytes())
        self.sizes.append(sizes)
        self.keys.append(keys)
        self.n_null += n_null
        self.n_ids += len(ids)
        self.n_docs += len(sizes)

    def close(self) -> int:
        """Writes the boundaries and the tail; gives the size of the file."""
        ends = EliasFano.of(np.cumsum(np.concatenate(self.sizes))).to_bytes()
        keys = EliasFano.of(np.concatenate(self.keys)).to_bytes()
        tail = TAIL.pack(self.width, self.n_ids, self.n_docs, self.n_null, len(ends), len(keys), MAGIC)
        for part in (ends, keys, tail):
            self.stream.write(part)
        self.stream.close()
        return self.width * self.n_ids + len(ends) + len(keys) + len(tail)


class TokenFile:
    """Documents of one file by their number in it: a select finds where each lies, nothing else is read."""

    def __init__(self, path: str):
        system, inner = store(path)
        self.stream = system.open_input_file(inner)
        size = self.stream.size()
        self.width, self.n_ids, self.n_docs, self.n_null, n_ends, n_keys, magic = TAIL.unpack(self.stream.read_at(TAIL.size, size - TAIL.size))
        if magic != MAGIC:
            raise ValueError(f"{path} is no file of token ids")
        at = self.width * self.n_ids
        self.ends = EliasFano.from_bytes(self.stream.read_at(n_ends, at))
        self.keys = EliasFano.from_bytes(self.stream.read_at(n_keys, at + n_ends))

    def ids(self, first: int, last: int) -> np.ndarray:
        """The ids at places ``first`` up to ``last`` of the file."""
        raw = self.stream.read_at(self.width * (last - first), self.width * first)
        return np.frombuffer(raw, f"<u{self.width}").astype("<u4")

    def key(self, i: int) -> int | None:
        return None if i < self.n_null else self.keys[i - self.n_null]

    def document(self, i: int) -> np.ndarray:
        """The ids of document ``i``."""
        return self.ids(self.ends[i - 1] if i else 0, self.ends[i])

    def close(self) -> None:
        self.stream.close()

    def __enter__(self) -> TokenFile:
        return self

    def __exit__(self, *_) -> None:
        self.close()


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, key: str = "doc_id", text: str = "text", n_files: int | None = None
) -> DataFrame:
    """Writes the ids of all rows in ascending order of ``key`` and gives the files: part, file, n_docs, n_ids, bytes,
    first_id.

    A row is the ids of its text by the tokenizer in file ``tokenizer``, then the end id; a null or empty text has the end
    id alone. ``key`` is of an integer type; rows without one come first, rows of one key in the order they were read.
    ``folder`` is a path that the driver and all executors share. ``first_id`` counts the ids of all files before; no rows
    write no file.

    Rows are dealt into ``n_files`` ranges of the order (as many as Spark shuffles into, unless told), each sorted and
    written by one task as it encodes, so a task holds a batch of texts and 16 bytes a document. A key that repeats in very
    many rows is divided. Every attempt of a task writes a file of its own name, and only those that its rows list, once
    Spark has accepted them, belong to the table: a lost executor's leftovers are never read.
    """
    spark = docs.sparkSession
    if not isinstance(docs.schema[key].dataType, T.IntegralType):
        raise ValueError(f"{key} is no integer: its order cannot be stored in a token file")
    folder = folder.rstrip("/")
    system, inner = store(folder)
    system.create_dir(inner, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, writer, path = text_encoder(tokenizer), TaskContext.get().partitionId(), None, ""
        width = 2 if len(encode.ends) <= 1 << 16 else 4
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                path = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.ids"
                system, inner = store(path)
                writer = TokenFileWriter(system.open_output_stream(inner), width)
            raw, sizes = encode(batch.column(1))
            ids = np.insert(np.frombuffer(raw, "<u4"), np.cumsum(sizes), END_ID)
            known = batch.column(0).drop_null().to_numpy(zero_copy_only=False).astype(np.int64)
            writer.append(ids, sizes + 1, known, batch.num_rows - len(known))
        if writer is not None:
            size = writer.close()
            row = [[part], [path], [writer.n_docs], [writer.n_ids], [size]]
            kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, kinds)], names=["part", "file", "n_docs", "n_ids", "bytes"])

    rows = docs.select(F.col(key), F.col(text).cast("string").alias("_text"), F.monotonically_increasing_id().alias("_row"))
    order = [F.col(key).asc_nulls_first(), F.col("_row")]
    n = n_files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).drop("_row")
    files = materialize(dealt.mapInArrow(run, "part int, file string, n_docs long, n_ids long, bytes long"), "files")
    before = F.sum("n_ids").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))  # one row per file
    return materialize(files.withColumn("first_id", F.coalesce(before, F.lit(0))), "files")


def read_token_files(files: DataFrame, key: str = "doc_id", ids: bool = False, read_ids: int = READ_IDS) -> DataFrame:
    """``(key, start, n_tokens, ids_crc32)`` of every document in the listed files, and its ``ids`` as 32-bit little-endian
    numbers if asked for.

    ``start`` counts the ids of all documents before it, ``ids_crc32`` is the checksum of its own. A file is read in
    stretches of about ``read_ids`` ids by as many tasks: a stretch has the documents that begin in it, which a search over
    selects finds, so a task holds the boundaries of its file, a block of ids and the longest document.
    """
    spark = files.sparkSession
    names = ["part", "start", "n_tokens", "ids_crc32"] + ["ids"] * ids
    schema = f"`{key}` long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * ids
    steps = F.sequence(F.lit(0), F.expr(f"greatest(n_ids - 1, 0) DIV {int(read_ids)}"))
    stretches = files.select("file", "first_id", F.explode(steps).alias("step"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, before, step in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with TokenFile(path) as file:
                    yield from documents(file, before, step)

    def documents(file: TokenFile, before: int, step: int) -> Iterator[pa.RecordBatch]:
        # document i begins where the one before it ends
        first = file.ends.first_from(step * read_ids) + 1 if step else 0
        last = min(file.ends.first_from((step + 1) * read_ids) + 1, file.n_docs)
        if first >= last:
            return
        ends = file.ends.range(first, last)
        starts = np.concatenate([[file.ends[first - 1] if first else 0], ends[:-1]])
        at = 0
        while at < len(ends):
            to = max(at + 1, int(np.searchsorted(ends, starts[at] + CHUNK_IDS, side="right")))
            block = memoryview(file.ids(int(starts[at]), int(ends[to - 1])).tobytes())
            cuts = (4 * (np.concatenate([starts[at : at + 1], ends[at:to]]) - starts[at])).tolist()
            raw = [block[a:b] for a, b in zip(cuts, cuts[1:])]
            n_null = min(max(file.n_null - first - at, 0), to - at)
            known = file.keys.range(max(first + at - file.n_null, 0), max(first + to - file.n_null, 0))
            keys = pa.concat_arrays([pa.nulls(n_null, pa.int64()), pa.array(known)])
            columns = [keys, pa.array(before + starts[at:to]), pa.array(ends[at:to] - starts[at:to])]
            columns += [pa.array(map(zlib.crc32, raw), pa.int64())] + [pa.array(map(bytes, raw), pa.binary())] * ids
            yield pa.RecordBatch.from_arrays(columns, names=[key, *names[1:]])
            at = to

    return stretches.repartition(n, "file", "step").mapInArrow(run, schema)


def token_table(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", ids: bool = False) -> DataFrame:
    """The rows of ``docs`` written as token files to shared storage and read back: see the two functions above."""
    folder = scratch_path(docs.sparkSession, "ids")
    files = write_token_files(docs, folder, tokenizer, key, text)
    kind = docs.schema[key].dataType
    return read_token_files(files, key, ids).withColumn(key, F.col(f"`{key}`").cast(kind))
