"""Periodic runs of words: a dictionary of basic factors proposes periods, which are extended and told apart."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE_BYTES = 2_000_000  # of text whose factors are named together; a longer text is a slice of its own
RUNS = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))


class BasicFactors:
    """Names of the factors of one length, by position: equal factors have equal names, 0 stands for one that is unique."""

    def __init__(self, length: int, positions: np.ndarray, keys: np.ndarray, n: int):
        """``keys`` tell the factors at the ascending ``positions`` of a sequence of ``n`` symbols apart."""
        self.length = length
        order = np.argsort(keys, kind="stable")
        at, sorted_keys = positions[order], keys[order]
        same = sorted_keys[1:] == sorted_keys[:-1]
        has_next, has_last = np.append(same, False), np.append(False, same)
        repeated = has_next | has_last
        self.names = np.zeros(n, np.int32)
        self.names[at[repeated]] = np.cumsum(~has_last)[repeated]
        #: distance to the next place of the same factor, 0 at the last one
        self.gaps = np.zeros(n, np.int32)
        self.gaps[at[:-1][same]] = np.diff(at)[same]
        self.positions = positions[self.names[positions] > 0]

    def doubled(self) -> BasicFactors | None:
        """The factors of twice the length, each the pair of its halves; None where no factor has a repeated half."""
        n, first = len(self.names), self.positions
        first = first[first + self.length < n]
        second = self.names[first + self.length]
        first, second = first[second > 0], second[second > 0]
        if not len(first):
            return None
        pairs = self.names[first].astype(np.int64) * (n + 1) + second
        return BasicFactors(2 * self.length, first, pairs, n)

    def proposals(self) -> tuple[np.ndarray, np.ndarray]:
        """Places and periods: three places of a factor in arithmetic progression, each the successor of the one before
        within twice the factor's length. Of neighbouring places with one period only the first is given."""
        at = self.positions[self.gaps[self.positions] > 0]
        gap = self.gaps[at]
        near = gap <= 2 * self.length
        at, gap = at[near], gap[near]
        even = self.gaps[at + gap] == gap
        at, gap = at[even], gap[even]
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(at) > 1) | (np.diff(gap) != 0)
        return at[new].astype(np.int64), gap[new].astype(np.int64)


def matched(levels: list[BasicFactors], left: np.ndarray, right: np.ndarray, forward: bool) -> np.ndarray:
    """How many symbols agree from ``left`` and from ``right`` on, or before them: powers of two from the longest down."""
    n, out = len(levels[0].names), np.zeros(len(left), np.int64)
    for level in reversed(levels):
        open_ = np.arange(len(left))
        while len(open_):  # below the longest length a second step never matches
            shift = out[open_] if forward else -out[open_] - level.length
            a, b = left[open_] + shift, right[open_] + shift
            inside = (a >= 0) & (b + level.length <= n)
            open_, a, b = open_[inside], a[inside], b[inside]
            names = level.names[a]
            open_ = open_[(names > 0) & (names == level.names[b])]
            out[open_] += level.length
    return out


def find_runs(symbols: np.ndarray, least: int = 6, times: int = 4) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and smallest period of every run of ``least`` symbols and ``times`` periods or more, by start, then period.

    A run is a stretch that no neighbour extends with its period kept. With ``times`` of 4 or more all are found: for the
    power of two from the period on to below twice it, the factor at the start of the run and the one a period later
    have their successors a period on, as a primitive word is no other rotation of itself.
    """
    if times < 4:
        raise ValueError("runs of fewer than four periods are not found by all progressions")
    n = len(symbols)
    factors: BasicFactors | None = BasicFactors(1, np.arange(n), symbols, n) if n else None
    levels, places, periods = [], [], []
    while factors is not None and len(factors.positions):
        levels.append(factors)
        at, gap = factors.proposals()
        places.append(at)
        periods.append(gap)
        factors.gaps = factors.gaps[:0]  # the names are enough to extend by
        factors = factors.doubled()
    if not levels:
        none = np.zeros(0, np.int64)
        return none, none, none
    at, period = np.concatenate(places), np.concatenate(periods)
    ahead, behind = matched(levels, at, at + period, True), matched(levels, at, at + period, False)
    start, length = at - behind, behind + ahead + period
    long = length >= np.maximum(least, times * period)
    found = np.unique(np.stack([start[long], period[long], length[long]], axis=1), axis=0)
    return found[:, 0], found[:, 2], found[:, 1]


def words_of(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The words of each text between ASCII blanks: where each text's begin and end, and all words one after another."""
    split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    words = split.flatten()
    full = pc.not_equal(pc.binary_length(words), 0)  # blanks at an end of a text leave an empty word
    kept = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
    offsets = split.offsets.to_numpy() - split.offsets[0].as_py()
    return kept[offsets], words.filter(full)


def text_slices(texts: pa.Array, slice_bytes: int) -> Iterator[tuple[int, int]]:
    """First and last rows of stretches of about that many bytes; a longer text is one alone."""
    if not len(texts):
        return
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
    at = 0
    while at < len(texts):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + slice_bytes, side="right")))
        yield at, to
        at = to


def _sliced(texts: pa.Array, least: int, times: int) -> tuple[pa.Array, pa.Array]:
    """For some texts their runs, and their words without what repeats in them."""
    bounds, words = words_of(texts)
    coded = words.dictionary_encode()
    sizes = np.diff(bounds)
    doc = np.repeat(np.arange(len(texts)), sizes)
    # equal words of different texts differ, and a symbol of its own ends each text, so no factor crosses
    n_codes = len(coded.dictionary) + 1
    symbols = np.arange(len(texts), dtype=np.int64).repeat(sizes + 1) * n_codes
    place = np.arange(len(doc)) + doc  # of each word among the symbols
    symbols[place] += coded.indices.to_numpy().astype(np.int64) + 1
    start, length, period = find_runs(symbols, least, times)

    owner = np.searchsorted(bounds + np.arange(len(bounds)), start, side="right") - 1
    counts = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(texts)))]).astype(np.int32)
    own_start = start - owner - bounds[owner]
    found = pa.StructArray.from_arrays([pa.array(c) for c in (own_start, length, period)], names=["start", "length", "period"])

    repeated = np.zeros(len(symbols) + 1, np.int64)
    np.add.at(repeated, start + period, 1)
    np.add.at(repeated, start + length, -1)
    kept = np.cumsum(repeated)[place] == 0
    left = np.concatenate([[0], np.cumsum(kept)])[bounds].astype(np.int32)
    collapsed = pc.binary_join(pa.ListArray.from_arrays(pa.array(left), words.filter(pa.array(kept))), " ")
    return pa.ListArray.from_arrays(pa.array(counts), found), collapsed


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = 6, times: int = 4) -> DataFrame:
    """``(key, runs, collapsed)`` per row: the periodic runs of the text's words, and the text with each of them once.

    Words are what ASCII blanks separate, numbered from 0. ``runs`` lists ``(start, length, period)`` of every maximal
    stretch of at least ``least`` words and ``times`` smallest periods, by start, then period. ``collapsed`` is the words
    joined by one blank without those that a run holds after its first period. A null, empty or blank text has no runs and
    collapses to nothing; repeated keys and rows count as rows of their own.

    A text is judged on its own row, so nothing is shuffled. Texts are taken in slices of bounded size, whose factors of
    each power-of-two length are named together by one sort; only factors that occur again in their text are doubled, so
    prose costs a few sorts. Memory grows with the slice, or with the longest text.
    """
    kind = docs.schema[key].dataType
    schema = T.StructType([T.StructField(key, kind), T.StructField("runs", RUNS), T.StructField("collapsed", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to in text_slices(batch.column(1), SLICE_BYTES):
                part = batch.slice(at, to - at)
                yield pa.RecordBatch.from_arrays([part.column(0), *_sliced(part.column(1), least, times)], names=schema.names)

    return docs.select(key, F.col(text).cast("string").alias("_text")).mapInArrow(run, schema)
