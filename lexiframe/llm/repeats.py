"""Repeated passages: suffix automata over reference shards, streamed for matching statistics."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiframe.session import materialize

FACTOR = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(FACTOR), -1, 1 << 64))
BYTE_NUMBERS = np.random.default_rng(42).integers(1 << 64, size=256, dtype=np.uint64)
WHOLE = -1


def word_ends(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a text begin and end, in bytes: the words are those of ``bytes.split``."""
    data = np.frombuffer(raw, np.uint8)
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = (data != 32) & ((data < 9) | (data > 13))
    turns = np.flatnonzero(np.diff(inside))
    return turns[::2], turns[1::2]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that leaves no order."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_sums(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the words' numbers times falling powers, and the powers: two subtractions then hash any run of words."""
    up = np.full(len(hashes) + 1, FACTOR)
    down = np.full(len(hashes) + 1, INVERSE)
    up[0] = down[0] = 1
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * np.cumprod(down)[:-1], out=sums[1:])
    return sums, np.cumprod(up)


def span_hashes(sums: np.ndarray, powers: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """A 64-bit number for each run of the words from ``first`` up to ``last``, the same wherever the run stands."""
    return mixed((sums[last] - sums[first]) * powers[first] + (last - first).astype(np.uint64))


def word_hashes(raw: bytes, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit number per word, from its bytes as a run of words has one from its words; some words at a time."""
    data, out = np.frombuffer(raw, np.uint8), [np.zeros(0, np.uint64)]
    for at in range(0, len(begins), 50_000):
        first, last = begins[at : at + 50_000], ends[at : at + 50_000]
        sums, powers = prefix_sums(BYTE_NUMBERS[data[first[0] : last[-1]]])
        out.append(span_hashes(sums, powers, first - first[0], last - first[0]))
    return np.concatenate(out)


def run_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit number for each run of ``k`` words."""
    first = np.arange(max(0, len(hashes) - k + 1))
    return span_hashes(*prefix_sums(hashes), first, first + k)


def anchors(hashes: np.ndarray, window: int, k: int) -> np.ndarray:
    """For each window, the smallest number among its runs of ``k`` words: equal windows have equal anchors."""
    runs, n = run_hashes(hashes, k), len(hashes) - window + 1
    least = runs[:n].copy()
    for j in range(1, window - k + 1):
        np.minimum(least, runs[j : j + n], out=least)
    return least


def text_anchors(texts: list[bytes], window: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct anchors of each text, the number of its text beside each, and the number of words of every text."""
    raw = b"\n".join(texts)
    begins, ends = word_ends(raw)
    text = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), begins, side="right")
    sizes = np.bincount(text, minlength=len(texts))
    if len(begins) < window:
        return np.zeros(0, np.uint64), text[:0], sizes
    least = anchors(word_hashes(raw, begins, ends), window, k)
    inside = text[: len(least)] == text[window - 1 :]  # other windows run on into the next text
    least, text = least[inside], text[: len(least)][inside]
    new = np.ones(len(least), bool)
    new[1:] = (least[1:] != least[:-1]) | (text[1:] != text[:-1])
    least, text = least[new], text[new]
    order = np.lexsort((least, text))
    least, text = least[order], text[order]
    new = np.ones(len(least), bool)
    new[1:] = (least[1:] != least[:-1]) | (text[1:] != text[:-1])
    return least[new], text[new], sizes


class SuffixAutomaton:
    """All substrings of a set of word sequences, each state with the smallest owner that holds its strings.

    States are lists by number: transitions, suffix link, length of the longest string, smallest owner. A sequence is
    added from the root, reusing states that exist, so equal parts of different sequences share their states.
    """

    def __init__(self):
        self.step: list[dict[int, int]] = [{}]
        self.link, self.size, self.owner = [-1], [0], [1 << 62]

    def _state(self, step: dict[int, int], link: int, size: int, owner: int) -> int:
        self.step.append(step)
        self.link.append(link)
        self.size.append(size)
        self.owner.append(owner)
        return len(self.size) - 1

    def _split(self, at: int, symbol: int, to: int) -> int:
        copy = self._state(dict(self.step[to]), self.link[to], self.size[at] + 1, self.owner[to])
        self.link[to] = copy
        while at >= 0 and self.step[at].get(symbol) == to:
            self.step[at][symbol] = copy
            at = self.link[at]
        return copy

    def add(self, symbols: list[int], owner: int) -> None:
        step, link, size = self.step, self.link, self.size
        last = 0
        for s in symbols:
            to = step[last].get(s)
            if to is not None:
                last = to if size[to] == size[last] + 1 else self._split(last, s, to)
            else:
                new, at = self._state({}, 0, size[last] + 1, 1 << 62), last
                while at >= 0 and s not in step[at]:
                    step[at][s] = new
                    at = link[at]
                if at >= 0:
                    to = step[at][s]
                    link[new] = to if size[to] == size[at] + 1 else self._split(at, s, to)
                last = new
            if owner < self.owner[last]:
                self.owner[last] = owner

    def finish(self) -> None:
        """Hands the smallest owner of every state to those of its suffixes."""
        for state in sorted(range(1, len(self.size)), key=self.size.__getitem__, reverse=True):
            up = self.link[state]
            if self.owner[state] < self.owner[up]:
                self.owner[up] = self.owner[state]

    def first_owners(self, symbols: list[int], window: int) -> list[int]:
        """For each window of the sequence, the smallest owner of an equal one: matching statistics, cut to the window."""
        step, link, size, owner = self.step, self.link, self.size, self.owner
        out, state, length = [], 0, 0
        for n, s in enumerate(symbols):
            to = step[state].get(s)
            while to is None and state:
                state = link[state]
                length = size[state]
                to = step[state].get(s)
            if to is not None:
                state, length = to, length + 1
            while state and size[link[state]] >= window:  # the state of the last ``window`` words alone
                state = link[state]
                length = size[state]
            if n >= window - 1:
                out.append(owner[state] if length >= window else 1 << 62)
        return out


def _removed(n_words: int, starts: list[int], window: int) -> np.ndarray:
    gone = np.zeros(n_words + 1, np.int64)
    np.add.at(gone, starts, 1)
    np.add.at(gone, np.asarray(starts) + window, -1)
    return np.cumsum(gone[:-1]) > 0


def repeated_windows(
    docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = 13, k: int = 8, frequent: int = 1000, shard_words: int = 60_000
) -> DataFrame:
    """``(key, starts, whole)`` for the rows that hold a window of ``window`` words which also starts in a document with
    a smaller key: where such windows start, or ``whole`` if the text is a copy and every window is one.

    1. Every text gives the anchors of its windows, the smallest hash among the runs of ``k`` words in each, and one
       digest of all its words. Shuffled by hash, those of a single document fall out; equal windows have equal anchors.
    2. The others go back to their texts, which are cut into the passages whose windows share such an anchor. A
       passage goes to the reference shard of its anchor; one whose anchor over ``frequent`` documents hold is cut
       into single windows dealt by their own hash, so no anchor gathers many passages. Equal passages become one,
       owned by the smallest key. Passages travel as text, which packs far better than the hashes of its words.
    3. In each shard of about ``shard_words`` words the distinct passages build a suffix automaton, whose states know
       the smallest owner, and are streamed through it: each of their windows gets the smallest key that holds it.
    4. A document's window is repeated if that key is smaller than its own.

    Every step is a join or a grouping by hash; a shard holds distinct passages only. Words are compared by 64-bit hashes.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).cast("string").cast("binary").alias("words"))
    rows = rows.where("doc IS NOT NULL AND words IS NOT NULL")
    n_tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, n_held = [], 0
            for doc, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                held.append((doc, raw.as_py()))
                n_held += len(held[-1][1])
                if n_held > 300_000:
                    yield marks_of(held)
                    held, n_held = [], 0
            if held:
                yield marks_of(held)

    def marks_of(held: list[tuple[int, bytes]]) -> pa.RecordBatch:
        keys = np.array([doc for doc, _ in held])
        own, at, sizes = text_anchors([raw for _, raw in held], window, k)
        long = sizes >= window
        digests = b"".join(hashlib.md5(b" ".join(held[n][1].split())).digest()[:8] for n in np.flatnonzero(long))
        values = np.concatenate([own, np.frombuffer(digests, np.uint64)]).view(np.int64)
        whole = np.arange(len(values)) >= len(own)
        columns = [pa.array(values), pa.array(np.concatenate([keys[at], keys[long]])), pa.array(whole)]
        return pa.RecordBatch.from_arrays(columns, names=["hash", "doc", "whole"])

    # dealt once: grouping and join below both find their rows in place
    marks = rows.mapInArrow(found, "hash long, doc long, whole boolean").repartition(n_tasks, "hash", "whole")
    shared = marks.groupBy("hash", "whole").agg(F.min("doc").alias("least"), F.max("doc").alias("most"), F.count("*").alias("n")).where("least < most")
    held = marks.join(shared, ["hash", "whole"])
    per_doc = held.groupBy("doc").agg(
        F.collect_list(F.when(~F.col("whole"), F.struct("hash", (F.col("n") > frequent).alias("hot")))).alias("marks"),
        F.max(F.col("whole") & (F.col("least") < F.col("doc"))).alias("copy"),
    )
    per_doc = materialize(per_doc, "marks")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, n_held = [], 0
            for doc, raw, marks in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                values = marks.values.field("hash").to_numpy().view(np.uint64)
                hot = values[marks.values.field("hot").to_numpy(zero_copy_only=False)]
                found = passages_of(doc, raw.as_py(), values, hot)
                if found:
                    held.append(found)
                    n_held += len(found[0])
                if n_held > 20_000:
                    yield as_batch(held)
                    held, n_held = [], 0
            if held:
                yield as_batch(held)

    def passages_of(doc: int, raw: bytes, values: np.ndarray, hot: np.ndarray):
        begins, ends = word_ends(raw)
        hashes = word_hashes(raw, begins, ends)
        own = anchors(hashes, window, k)
        starts = np.flatnonzero(np.isin(own, values))
        if not len(starts):
            return None
        single = np.isin(own[starts], hot)
        new = np.ones(len(starts), bool)
        new[1:] = (np.diff(starts) > 1) | (own[starts][1:] != own[starts][:-1]) | single[1:]
        begin = np.flatnonzero(new)
        first, last = starts[begin], starts[np.append(begin[1:], len(starts)) - 1] + window
        sums, powers = prefix_sums(hashes)
        keys = np.where(single[begin], span_hashes(sums, powers, first, first + window), own[first])
        parts = [raw[b:e] for b, e in zip(begins[first].tolist(), ends[last - 1].tolist(), strict=True)]
        return np.full(len(first), doc), first, keys, span_hashes(sums, powers, first, last), last - first, parts

    def as_batch(held: list[tuple]) -> pa.RecordBatch:
        *numbers, parts = zip(*held, strict=True)
        columns = [pa.array(np.concatenate(c).view(np.int64)) for c in numbers]
        passages = pa.array([p for part in parts for p in part], pa.binary())
        return pa.RecordBatch.from_arrays([*columns, passages], names=["doc", "start", "key", "digest", "size", "passage"])

    apart = per_doc.where("NOT copy AND size(marks) > 0").select("doc", "marks")
    texts = rows.join(apart, "doc")
    cut_rows = "doc long, start long, key long, digest long, size long, passage binary"
    passages = materialize(texts.mapInArrow(cut, cut_rows), "passages")
    distinct = passages.groupBy("key", "digest").agg(F.min("doc").alias("owner"), F.first("size").alias("size"), F.first("passage").alias("passage"))
    distinct = materialize(distinct, "distinct")
    words = distinct.agg(F.sum("size")).first()[0] or 0
    n_shards = max(n_tasks, -(-int(words) // shard_words))

    def match(group: pa.Table) -> pa.Table:
        automaton, numbers = SuffixAutomaton(), {}
        lists = [[numbers.setdefault(w, len(numbers)) for w in p.split()] for p in group["passage"].to_pylist()]
        for symbols, owner in zip(lists, group["owner"].to_pylist(), strict=True):
            automaton.add(symbols, owner)
        automaton.finish()
        found = [automaton.first_owners(symbols, window) for symbols in lists]
        offsets = np.cumsum([0, *map(len, found)], dtype=np.int32)
        firsts = pa.ListArray.from_arrays(pa.array(offsets), pa.array(list(chain.from_iterable(found)), pa.int64()))
        return pa.table({"key": group["key"], "digest": group["digest"], "firsts": firsts})

    owned = distinct.drop("size").withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(n_shards)))
    matched = owned.groupBy("shard").applyInArrow(match, "key long, digest long, firsts array<long>")
    # a passage that its owner alone holds, once, says nothing new
    matched = materialize(matched, "matched")
    hits = passages.select("doc", "start", "key", "digest").join(matched, ["key", "digest"])
    hits = hits.select("doc", F.expr("filter(transform(firsts, (f, i) -> if(f < doc, start + i, -1)), x -> x >= 0)").alias("at")).where(F.size("at") > 0)
    starts = hits.groupBy("doc").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("at")))).alias("starts"))
    copies = per_doc.where("copy").select("doc", F.array().cast("array<long>").alias("starts"), F.lit(True).alias("whole"))
    return starts.withColumn("whole", F.lit(False)).unionByName(copies).withColumnRenamed("doc", key)


def remove_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = 13, texts: bool = False, **options
) -> DataFrame:
    """``(key, n_words, n_removed, kept_sha256)`` per row, and ``kept`` (the words left, joined by blanks) if asked for.

    Words are what ASCII blanks separate. Removed are those that any window of ``window`` words covers whose words
    also start in a document with a smaller key; all windows are judged on the input. Null texts and texts of fewer
    words than a window keep what they have. Rows with a null key are kept whole. Repeated keys count as one document
    held twice: their windows do not remove each other, and all their rows lose what any of them repeats only if
    their texts are equal, so keys should be unique.
    """
    found = materialize(repeated_windows(docs, key, text, window, **options), "repeats").withColumnRenamed(key, "_doc")
    kind = docs.schema[key].dataType.simpleString()
    names = [key, "n_words", "n_removed", "kept_sha256"] + ["kept"] * texts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, kept_texts = [], []
            for raw, starts, whole in zip(*(batch.column(c) for c in range(1, 4))):
                words, starts = (raw.as_py() or b"").split(), starts.as_py()
                gone = 0
                kept = words
                if whole.as_py() and len(words) >= window:
                    kept, gone = [], len(words)
                elif starts:
                    mask = _removed(len(words), starts, window)
                    kept, gone = [w for w, g in zip(words, mask.tolist(), strict=True) if not g], int(mask.sum())
                joined = b" ".join(kept)
                rows.append((len(words), gone, hashlib.sha256(joined).hexdigest()))
                if texts:
                    kept_texts.append(joined.decode())
            kinds = [pa.int64(), pa.int64(), pa.string()]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [pa.array([], t) for t in kinds]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns, *[pa.array(kept_texts, pa.string())] * texts], names=names)

    rows = docs.select(key, F.col(text).cast("string").cast("binary").alias("_words"))
    joined = rows.join(found, rows[key] == F.col("_doc"), "left").select(key, "_words", "starts", "whole")
    schema = f"`{key}` {kind}, n_words long, n_removed long, kept_sha256 string" + ", kept string" * texts
    return joined.mapInArrow(run, schema)
