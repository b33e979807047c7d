"""Language identification by unigrams over a fixed piece vocabulary, summed over all segmentations."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import compress

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiframe.llm.worker_cache import only_cache
from lexiframe.session import lookup_join, materialize

UNDETERMINED = "und"
START = "▁"
LETTERS = regex.compile(r"\p{L}+")
SHORT = 40
CACHED_BYTES = 64_000_000
WORD_BYTES = 200  # what a word takes in the cache besides its letters and scores


@dataclass
class Vocabulary:
    """Pieces and their numbers; one more number stands for any single character that no piece covers."""

    pieces: dict[str, int]
    known: dict[str, int] = field(default_factory=dict)  # every beginning of a piece: its number, or -1 if it is none itself
    longest: int = 0

    def __post_init__(self):
        self.known = dict.fromkeys((p[:k] for p in self.pieces for k in range(1, len(p))), -1) | self.pieces
        self.longest = max(map(len, self.pieces), default=1)

    @classmethod
    def from_file(cls, path: str) -> Vocabulary:
        """The pieces of letters, with or without the mark of a word's start, of a sentencepiece model file."""
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        texts = (model.id_to_piece(i) for i in range(model.get_piece_size()))
        kept = sorted({p.lower() for p in texts if p.lstrip(START).isalpha() or p == START})
        return cls({p: i for i, p in enumerate(kept)})

    @property
    def unknown(self) -> int:
        return len(self.pieces)

    def arcs(self, word: str) -> list[tuple[int, int, int]]:
        """``(start, end, piece)`` of every piece in the marked word; characters without any get the unknown piece."""
        out, n, pieces, known = [], len(word), self.pieces, self.known
        for i in range(n):
            found = False
            for j in range(i + 1, min(n, i + self.longest) + 1):
                part = word[i:j]
                if part not in known:
                    break
                if part in pieces:
                    out.append((i, j, pieces[part]))
                    found |= j == i + 1
            if not found:
                out.append((i, i + 1, self.unknown))
        return out


@dataclass
class PieceModel:
    """``chances[p, l]``: probability of piece ``p`` in language ``l``; the last row is the unknown piece's."""

    vocabulary: Vocabulary
    languages: list[str]
    chances: np.ndarray

    def score_words(self, words: list[str]) -> np.ndarray:
        """Log probability of each word in each language: the forward sum over all its segmentations."""
        out = np.zeros((len(words), len(self.languages)))
        by_size: dict[int, list[int]] = {}
        for k, w in enumerate(words):
            if len(w) < SHORT:
                by_size.setdefault(len(w) + 1, []).append(k)
            else:
                out[k] = self._long(START + w)
        for size, rows in by_size.items():
            lattice = _lattice(self.vocabulary, [START + words[k] for k in rows], size)
            out[rows] = np.log(_forward(lattice, self.chances, size)[:, size])
        return out

    def _long(self, word: str) -> np.ndarray:
        """The same sum for a word of any length, scaled at each step."""
        by_end: dict[int, list[tuple[int, int]]] = {}
        for i, j, p in self.vocabulary.arcs(word):
            by_end.setdefault(j, []).append((i, p))
        recent = {0: np.zeros(len(self.languages))}
        logs = np.log(self.chances)
        for j in range(1, len(word) + 1):
            recent[j] = np.logaddexp.reduce([recent[i] + logs[p] for i, p in by_end[j]])
            recent.pop(j - self.vocabulary.longest - 1, None)
        return recent[len(word)]


def _lattice(vocabulary: Vocabulary, words: list[str], size: int) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    """For words of one length: by start and end, the rows that have a piece there and the piece.

    All words advance together, those that no longer begin a piece falling out.
    """
    known, every, out = vocabulary.known, np.arange(len(words)), []
    for i in range(size):
        rows, alive, alone = every, words, np.ones(len(words), bool)
        for j in range(i + 1, min(size, i + vocabulary.longest) + 1):
            found = np.array([known.get(w[i:j], -2) for w in alive], np.int64)
            going = found > -2
            if not going.all():
                rows, found, alive = rows[going], found[going], list(compress(alive, going.tolist()))
            if not len(rows):
                break
            pieces = found >= 0
            if pieces.any():
                out.append((i, j, rows[pieces], found[pieces]))
                if j == i + 1:
                    alone[rows[pieces]] = False
        if alone.any():
            out.append((i, i + 1, every[alone], np.full(int(alone.sum()), vocabulary.unknown)))
    out.sort(key=lambda c: (c[1], c[0]))
    return [*out, (size, size, np.array([], int), every)]


def _forward(lattice, chances: np.ndarray, size: int) -> np.ndarray:
    """Probability of each prefix of each word, by language."""
    sums = np.zeros((len(lattice[-1][3]), size + 1, chances.shape[1]))
    sums[:, 0] = 1.0
    for i, j, rows, found in lattice[:-1]:
        sums[rows, j] += sums[rows, i] * chances[found]
    return sums


def _expected(lattice, chances: np.ndarray, size: int, weights: np.ndarray) -> np.ndarray:
    """Expected uses of each piece over all segmentations of the words, each counted ``weights[word, language]`` times."""
    ahead = _forward(lattice, chances, size)
    back = np.zeros_like(ahead)
    back[:, size] = 1.0
    for i, j, rows, found in sorted(lattice[:-1], key=lambda c: -c[0]):
        back[rows, i] += back[rows, j] * chances[found]
    total = ahead[:, size]
    out = np.zeros_like(chances)
    for i, j, rows, found in lattice[:-1]:
        np.add.at(out, found, ahead[rows, i] * chances[found] * back[rows, j] / total[rows] * weights[rows])
    return out


def _uses(words: list[str], weights: np.ndarray, vocabulary: Vocabulary, chances: np.ndarray) -> np.ndarray:
    """Expected uses of each piece, by language, in words counted ``weights[word, language]`` times."""
    by_size: dict[int, list[int]] = {}
    for k, w in enumerate(words):
        by_size.setdefault(len(w) + 1, []).append(k)
    out = np.zeros_like(chances)
    for size, rows in by_size.items():
        lattice = _lattice(vocabulary, [START + words[k] for k in rows], size)
        out += _expected(lattice, chances, size, weights[rows])
    return out


def _maximised(used: np.ndarray, prior: float) -> np.ndarray:
    """Piece probabilities from expected uses."""
    used = used.copy()
    used[-1] = 0  # what the vocabulary lacks says nothing about a language
    pooled = used.sum(1, keepdims=True) + 0.01
    mixed = used + prior * pooled / pooled.sum()
    return mixed / mixed.sum(0)


def fit_pieces(
    counted: DataFrame, languages: list[str], vocabulary: Vocabulary, rounds: int = 4, prior: float = 200.0
) -> PieceModel:
    """Piece probabilities per language from ``(word, weights)``, its counts in the languages, by expectation-maximisation.

    Every language is smoothed by ``prior`` uses spread like the pooled counts of all languages, and those by a small even
    share, so no piece has probability 0. In each round tasks sum expected uses over their words and Spark adds them up by
    piece; the driver holds a number per piece and language.
    """
    n = vocabulary.unknown + 1
    chances = np.full((n, len(languages)), 1.0 / n)

    def used(chances: np.ndarray) -> np.ndarray:
        shared = counted.sparkSession.sparkContext.broadcast((vocabulary, chances))  # as large as the vocabulary

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            vocabulary, chances = shared.value
            total = np.zeros_like(chances)
            for whole in batches:
                for at in range(0, whole.num_rows, 20_000):
                    part = whole.slice(at, 20_000)
                    weights = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, chances.shape[1])
                    total += _uses(part.column(0).to_pylist(), weights, vocabulary, chances)
            rows = np.flatnonzero(total.any(axis=1))
            columns = [pa.array(rows.astype(np.int32)), pa.array(list(total[rows]), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["piece", "uses"])

        sums = [F.sum(F.col("uses")[j]).alias(f"u{j}") for j in range(len(languages))]
        out = np.zeros_like(chances)
        for r in counted.mapInArrow(run, "piece int, uses array<double>").groupBy("piece").agg(*sums).collect():
            out[r["piece"]] = r[1:]
        shared.unpersist()
        return out

    for _ in range(rounds):
        chances = _maximised(used(chances), prior)
    return PieceModel(vocabulary, languages, chances)


def fit_language_model(
    labelled: DataFrame,
    vocabulary: Vocabulary,
    text: str = "text",
    lang: str = "lang",
    key: str = "doc_id",
    max_docs: int = 3_000,
    rounds: int = 4,
) -> PieceModel | None:
    """A model from rows that have a text and a language; None where there are none.

    A language with more than ``max_docs`` rows is fitted on about that many, chosen by a hash of the key, whatever the
    other languages hold. All words of those rows count; runs of ``SHORT`` letters or more count as shorter runs.
    """
    rows = labelled.select(F.col(key).alias("_key"), F.col(text).alias("_text"), F.col(lang).alias("_lang")).dropna(subset=["_text", "_lang"])
    sizes = rows.groupBy("_lang").agg(F.count("*").alias("_n"))
    share = F.pmod(F.xxhash64(F.col("_key").cast("string")), F.lit(1_000_000)) < F.lit(1_000_000.0 * max_docs) / F.col("_n")
    # a run is cut where the next SHORT - 1 letters would be full, so scripts without blanks are learned too
    runs = F.regexp_extract_all(F.lower("_text"), F.lit(rf"\p{{L}}{{1,{SHORT - 1}}}"), F.lit(0))
    words = lookup_join(rows, sizes, "_lang").where(share).select("_lang", F.explode(runs).alias("word"))
    counted = materialize(words.groupBy("word", "_lang").agg(F.count("*").cast("double").alias("n")), "words")
    languages = sorted(r["_lang"] for r in counted.select("_lang").distinct().collect())  # a row per language
    if not languages:
        return None
    weights = F.array(*[F.sum(F.when(F.col("_lang") == lang, F.col("n")).otherwise(0.0)) for lang in languages])
    return fit_pieces(materialize(counted.groupBy("word").agg(weights.alias("weights")), "weights"), languages, vocabulary, rounds)


class WordScores:
    """Words scored so far by a model, in bounded space: a full table is emptied."""

    def __init__(self, model: PieceModel):
        self.model = model
        self.row_bytes = WORD_BYTES + 8 * len(model.languages)
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.table = np.zeros((1 << 12, len(self.model.languages)))
        self.letters = 0

    def learn(self, words: set[str]) -> None:
        """Scores those of the words that are new."""
        if self.letters + self.row_bytes * len(self.index) > CACHED_BYTES:
            self.forget()
        new = [w for w in words if w not in self.index]
        if not new:
            return
        start, end = len(self.index), len(self.index) + len(new)
        if end > len(self.table):
            grown = np.zeros((max(2 * len(self.table), end), self.table.shape[1]))
            grown[:start] = self.table[:start]
            self.table = grown
        self.table[start:end] = self.model.score_words(new)
        self.index.update(zip(new, range(start, end), strict=True))
        self.letters += sum(map(len, new))


def _judged(docs: DataFrame, model: PieceModel | None, text: str, carry: list[str]) -> DataFrame:
    """The columns ``carry`` of each row, then prediction, score and fit of its text under names of their own."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # as large as the vocabulary, whatever the corpus
    token = uuid.uuid4().hex
    own = max((c for c in carry), key=len, default="") + "_text"  # longer than any name carried, so it clashes with none
    rows = docs.select(F.col(text).cast("string").alias(own), *[F.col(f"`{c}`") for c in carry])
    added = [T.StructField(f"{own}{c}", T.StringType() if c == "pred" else T.DoubleType()) for c in ("pred", "score", "fit")]
    schema = T.StructType([*rows.schema.fields[1:], *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        scores = only_cache(("language", token), lambda: WordScores(model)) if model else None
        for whole in batches:
            for at in range(0, whole.num_rows, 400):
                batch = whole.slice(at, 400)
                words = [LETTERS.findall((t or "").lower()) if model else [] for t in batch.column(0).to_pylist()]
                if model:
                    scores.learn({w for ws in words for w in ws})
                best, score, fit = zip(*[judge(ws, scores) for ws in words], strict=True)
                found = [pa.array(best, pa.string()), pa.array(score, pa.float64()), pa.array(fit, pa.float64())]
                yield pa.RecordBatch.from_arrays(batch.columns[1:] + found, names=schema.names)

    def judge(words, scores) -> tuple[str, float, float | None]:
        if not words:
            return UNDETERMINED, 0.0, None
        total = scores.table[[scores.index[w] for w in words]].sum(0)
        k = int(total.argmax())
        chance = 1.0 / np.exp(np.maximum(total - total[k], -700.0)).sum()
        return scores.model.languages[k], float(chance), float(total[k] / sum(map(len, words)))

    return rows.mapInArrow(run, schema)


def identify(docs: DataFrame, model: PieceModel | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, lang_pred, score, fit)`` per row, from the text alone.

    ``lang_pred`` is the language in which the text's words, each summed over all its segmentations, are most
    probable (the first in order of equals), ``score`` its probability among all languages of the model, each as
    likely beforehand, and ``fit`` the mean log probability per letter in it. A null text, one without any letter, and
    every text if there is no model gets ``und``, score 0 and a null fit. Whole texts are read, nothing is shuffled.
    """
    judged = _judged(docs, model, text, [key])
    pred, score, fit = judged.columns[1:]
    return judged.select(key, F.col(pred).alias("lang_pred"), F.col(score).alias("score"), F.col(fit).alias("fit"))


def keep_languages(docs: DataFrame, model: PieceModel | None, text: str = "text", least_fit: float = -9.0) -> DataFrame:
    """The rows of ``docs`` written in a language the model knows, all columns unchanged.

    Rejected are null texts, texts without a letter and those whose ``fit`` is under ``least_fit``: text in scripts the
    model never saw is under it, any text in its languages far above. Without a model every row is rejected.
    """
    judged = _judged(docs, model, text, docs.columns)
    pred, _, fit = judged.columns[-3:]
    return judged.where((F.col(pred) != UNDETERMINED) & (F.col(fit) >= least_fit)).select(*[f"`{c}`" for c in docs.columns])
