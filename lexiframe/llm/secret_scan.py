"""Secrets in texts: fixed patterns, and a small convolutional network over further candidates."""

from __future__ import annotations

import base64
import hashlib
import random
import re
import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiframe.operators.ranking import prefix_sums
from lexiframe.session import materialize

# The patterns of findings that need no model.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ["assign", "access", "hex", "net"]

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
TOKEN_CHARS, SIDE = 40, 12
WIDTH = TOKEN_CHARS + 2 * SIDE
MAX_SHARDS = 256  # each hands its weights to the driver, 35 KB
PAD, OTHER, CODES = 95, 96, 97  # 0 to 94 are the printable ASCII characters

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Findings of the fixed patterns, leftmost and non-overlapping per kind, by start, then kind."""
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def candidates(text: str, base: list[Span]) -> list[tuple[int, int, bool]]:
    """Runs of at least 20 characters that secrets are made of: start, end, and whether a base finding overlaps."""
    taken: list[list[int]] = []
    for _, start, end in base:
        if taken and start <= taken[-1][1]:
            taken[-1][1] = max(end, taken[-1][1])
        else:
            taken.append([start, end])
    out, k = [], 0
    for m in CANDIDATE.finditer(text):
        while k < len(taken) and taken[k][1] <= m.start():
            k += 1
        out.append((m.start(), m.end(), k < len(taken) and taken[k][0] < m.end()))
    return out


def windows(text: str, start: int, end: int) -> list[str]:
    """What the network reads of a candidate: pieces of 40 of its characters, overlapping by 8, each between the 12
    characters before and after the candidate. A longer candidate has several, so all of it is read."""
    before, after = text[max(0, start - SIDE) : start].rjust(SIDE, "\0"), text[end : end + SIDE].ljust(SIDE, "\0")
    step = TOKEN_CHARS - 8
    starts = range(start, max(start + 1, end - 8), step)
    return [before + text[s : min(end, s + TOKEN_CHARS)].ljust(TOKEN_CHARS, "\0") + after for s in starts]


def codes(rows: list[str]) -> np.ndarray:
    """Character classes of windows, ``(rows, WIDTH)``."""
    flat = np.frombuffer("".join(rows).encode("utf-32-le"), "<u4").reshape(len(rows), WIDTH)
    return np.where(flat == 0, PAD, np.where((flat >= 32) & (flat < 127), flat - 32, OTHER)).astype(np.int64)


@dataclass
class CharNet:
    """Embedding, one convolution, maxima over the token and over its sides, two logits' worth of weights.

    ``slope`` and ``shift`` turn the output into a calibrated probability; ``threshold`` is the one chosen for it.
    """

    embed: np.ndarray  # (CODES, d)
    kernel: np.ndarray  # (k * d, f)
    bias: np.ndarray  # (f,)
    weight: np.ndarray  # (2 f,)
    offset: float
    slope: float = 1.0
    shift: float = 0.0
    threshold: float = 0.5

    @property
    def span(self) -> int:
        return self.kernel.shape[0] // self.embed.shape[1]

    def _layers(self, x: np.ndarray):
        d, k = self.embed.shape[1], self.span
        seen = np.lib.stride_tricks.sliding_window_view(self.embed[x].reshape(len(x), -1), k * d, axis=1)[:, ::d]
        act = np.maximum(seen @ self.kernel + self.bias, 0)  # (n, WIDTH - k + 1, f)
        a, b = SIDE, SIDE + TOKEN_CHARS - k + 1
        sides = np.concatenate([act[:, : a - k + 1], act[:, b + k - 1 :]], axis=1)
        top_in, top_out = act[:, a:b].argmax(1), sides.argmax(1)
        return seen, act, a, b, top_in, top_out, np.take_along_axis(act[:, a:b], top_in[:, None], 1)[:, 0], np.take_along_axis(sides, top_out[:, None], 1)[:, 0]

    def logits(self, x: np.ndarray) -> np.ndarray:
        parts = [self._layers(x[i : i + 512])[-2:] for i in range(0, len(x), 512)]
        return np.concatenate([np.concatenate(p, axis=1) @ self.weight + self.offset for p in parts]) if parts else np.zeros(0)

    def chance(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.logits(x) + self.shift, -50, 50)))


PARTS = ["embed", "kernel", "bias", "weight", "offset"]


@dataclass
class Descent:
    """A network on its way: its weights, the running moments of their gradients (Adam) and the steps made."""

    net: CharNet
    first: dict[str, np.ndarray]
    second: dict[str, np.ndarray]
    step: float = 0.0

    @classmethod
    def start(cls, rng: np.random.Generator, d: int = 8, f: int = 16, k: int = 5) -> Descent:
        net = CharNet(rng.normal(0, 0.3, (CODES, d)), rng.normal(0, (k * d) ** -0.5, (k * d, f)), np.zeros(f), rng.normal(0, 0.2, 2 * f), 0.0)
        first = {n: np.zeros_like(np.asarray(getattr(net, n), float)) for n in PARTS}
        return cls(net, first, {n: v.copy() for n, v in first.items()})

    def numbers(self) -> np.ndarray:
        held = ([getattr(self.net, n), self.first[n], self.second[n]] for n in PARTS)
        return np.concatenate([np.ravel(v) for three in held for v in three] + [[self.step]])

    def with_numbers(self, flat: np.ndarray) -> Descent:
        """The same kind of network with other numbers."""
        at, found = 0, []
        for n in PARTS:
            shape = np.shape(getattr(self.net, n))
            size = int(np.prod(shape))
            found.append([flat[at + i * size : at + (i + 1) * size].reshape(shape) for i in range(3)])
            at += 3 * size
        net = CharNet(*[three[0] if n != "offset" else float(three[0]) for n, three in zip(PARTS, found, strict=True)])
        return Descent(net, *({n: three[i] for n, three in zip(PARTS, found, strict=True)} for i in (1, 2)), float(flat[at]))

    def epoch(self, x: np.ndarray, y: np.ndarray, order: np.ndarray, share: float) -> None:
        """One pass over the rows in ``order`` by steps of 64, on the logistic loss; ``share`` is that of label 1 among all
        rows to learn from, so that both labels weigh alike."""
        net = self.net
        f, d, k = len(net.bias), net.embed.shape[1], net.span
        balance = np.where(y == 1, 0.5 / max(share, 1e-9), 0.5 / max(1 - share, 1e-9))
        for at in range(0, len(x), 64):
            rows = order[at : at + 64]
            xs = x[rows]
            seen, act, a, b, top_in, top_out, inner, outer = net._layers(xs)
            feats = np.concatenate([inner, outer], axis=1)
            p = 1 / (1 + np.exp(-np.clip(feats @ net.weight + net.offset, -50, 50)))
            delta = (p - y[rows]) * balance[rows] / len(rows)
            back = delta[:, None] * net.weight
            where_in = top_in + a
            where_out = np.where(top_out < a - k + 1, top_out, top_out + (b + k - 1) - (a - k + 1))
            d_kernel, d_bias = np.zeros_like(net.kernel), np.zeros_like(net.bias)
            d_embed = np.zeros_like(net.embed)
            for where, top, g in ((where_in, inner, back[:, :f]), (where_out, outer, back[:, f:])):
                g = g * (top > 0)
                patch = seen[np.arange(len(rows))[:, None], where]  # (n, f, k * d)
                d_kernel += np.einsum("nf,nfj->jf", g, patch)
                d_bias += g.sum(0)
                into = np.einsum("nf,jf->nfj", g, net.kernel).reshape(len(rows), f, k, d)
                chars = xs[np.arange(len(rows))[:, None, None], where[:, :, None] + np.arange(k)]
                np.add.at(d_embed, chars, into)
            self.step += 1
            grads = {"embed": d_embed, "kernel": d_kernel, "bias": d_bias, "weight": feats.T @ delta, "offset": delta.sum()}
            for n, g in grads.items():
                self.first[n] = 0.9 * self.first[n] + 0.1 * g
                self.second[n] = 0.999 * self.second[n] + 0.001 * g**2
                move = 0.01 * (self.first[n] / (1 - 0.9**self.step)) / (np.sqrt(self.second[n] / (1 - 0.999**self.step)) + 1e-8)
                setattr(net, n, getattr(net, n) - move)


def fit_net(x: np.ndarray, y: np.ndarray, seed: int = 7, epochs: int = 12, d: int = 8, f: int = 16, k: int = 5) -> CharNet:
    """Gradient descent (Adam) on the logistic loss, both classes weighted alike."""
    rng = np.random.default_rng(seed)
    state = Descent.start(rng, d, f, k)
    for _ in range(epochs):
        state.epoch(x, y, rng.permutation(len(x)), y.mean())
    return state.net


def fit_shards(rows: DataFrame, n: int, share: float, shard_rows: int, seed: int = 7, epochs: int = 12) -> CharNet:
    """The network of ``fit_net`` from the ``n`` rows ``(pos, w, label)``, which stay where they are.

    Rows are dealt into shards of some ``shard_rows``, at most ``MAX_SHARDS``. In every epoch each shard goes on from the same
    weights and moments over all of its rows, and their means, by rows, start the next epoch. The driver sees those numbers
    alone. One shard learns as ``fit_net`` does, all epochs in one job.
    """
    shards = max(1, min(MAX_SHARDS, -(-n // shard_rows)))
    state = Descent.start(np.random.default_rng(seed))
    dealt = materialize(rows.select("pos", "w", "label", F.pmod("pos", F.lit(shards)).cast("int").alias("shard")), "shards")
    rounds = [range(epochs)] if shards == 1 else [range(epoch, epoch + 1) for epoch in range(epochs)]
    for turn in rounds:
        flat = state.numbers()

        def learn(part: pd.DataFrame) -> pd.DataFrame:
            part, shard = part.sort_values("pos"), int(part["shard"].iloc[0])
            rng = np.random.default_rng([seed, shard] if shard else seed)
            here = Descent.start(rng).with_numbers(flat)  # noqa: B023  each epoch's job ends before the next
            x, y = codes(part["w"].tolist()), part["label"].to_numpy()
            for _ in range(turn.start):  # noqa: B023  the orders of earlier epochs
                rng.permutation(len(part))
            for _ in turn:  # noqa: B023
                here.epoch(x, y, rng.permutation(len(part)), share)
            return pd.DataFrame({"shard": [shard], "n": [len(part)], "flat": [here.numbers().tolist()]})

        done = dealt.groupBy("shard").applyInPandas(learn, "shard int, n long, flat array<double>").collect()  # MAX_SHARDS at most
        done.sort(key=lambda r: r["shard"])
        total = sum(r["n"] for r in done)
        state = state.with_numbers(sum(np.array(r["flat"]) * (r["n"] / total) for r in done))
    return state.net


def calibrate(net: CharNet, rows: DataFrame, least_recall: float) -> CharNet:
    """Platt scaling on the held-out rows ``(w, label)``, then the highest threshold whose recall on them is at least
    ``least_recall``. Sums over all of them reach the driver, and the one row that gives the threshold."""

    def judge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                yield pd.DataFrame({"z": net.logits(codes(frame["w"].tolist())), "label": frame["label"]})

    judged = materialize(rows.select("w", "label").mapInPandas(judge, "z double, label int"), "judged")
    n, n_good = judged.agg(F.count("*"), F.sum("label")).first()
    goal = F.when(F.col("label") == 1, (n_good + 1) / (n_good + 2)).otherwise(1 / (n - n_good + 2))

    def sums(at: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """The loss, its gradient and its second derivatives."""
        z, t = F.col("z"), F.col("z") * float(at[0]) + float(at[1])
        p = 1 / (1 + F.exp(-F.greatest(F.least(t, F.lit(50.0)), F.lit(-50.0))))
        w, off = p * (1 - p), p - goal
        loss = F.greatest(t, F.lit(0.0)) + F.log1p(F.exp(-F.abs(t))) - goal * t
        r = judged.agg(*[F.sum(c) for c in (loss, off * z, off, w * z * z, w * z, w)]).first()
        return r[0], np.array([r[1], r[2]]), np.array([[r[3], r[4]], [r[4], r[5]]]) + 1e-6 * np.eye(2)

    at = np.array([1.0, 0.0])
    loss, slopes, bends = sums(at)
    for _ in range(50):
        step = np.linalg.solve(bends, slopes)
        there = sums(at - step)
        while there[0] > loss and np.abs(step).max() > 1e-9:
            step = step / 2
            there = sums(at - step)
        at, (loss, slopes, bends) = at - step, there
        if np.abs(step).max() <= 1e-9:
            break
    net.slope, net.shift = map(float, at)
    ranked = prefix_sums(judged.where("label = 1").select((F.col("z") * net.slope).alias("s"), "z"), [], ["s"], F.lit(1))
    z = ranked.where(F.col("upto") == int(np.floor((1 - least_recall) * n_good)) + 1).first()["z"]
    net.threshold = float(1 / (1 + np.exp(-np.clip(net.slope * z + net.shift, -50, 50))))
    return net


def _number(text: str) -> int:
    return int.from_bytes(hashlib.md5(text.encode("utf-8", "replace")).digest()[:7], "little")


def _variants(window: str, other: str, n: int) -> list[tuple[str, int]]:
    """A labelled finding in other spellings of the same secret, amid the context of a row that holds none."""
    token = window[SIDE : SIDE + TOKEN_CHARS].rstrip("\0")
    coded = base64.b64encode(hashlib.sha256(token.encode()).digest()).decode()
    again = [token.upper(), coded, coded.replace("+", "").replace("/", "").swapcase(), token][n % 4]
    return [(other[:SIDE] + again[:TOKEN_CHARS].ljust(TOKEN_CHARS, "\0") + other[-SIDE:], 1)]


def _like_secrets(good: list[str], bad: list[str], n: int) -> list[str]:
    """``n`` generated secrets in the contexts of labelled findings and, every other one, of rows without any."""
    out = []
    for k in range(n):
        around = bad[k % len(bad)] if bad and k % 2 else good[k % len(good)]
        digest = hashlib.sha256(f"{k} {good[k % len(good)]}".encode()).digest()
        coded = base64.b64encode(digest).decode().rstrip("=")
        token = [digest.hex(), coded, re.sub("[+/]", "x", coded), digest.hex().upper()][k // 2 % 4][: 20 + k % 21]
        out.append(around[:SIDE] + token.ljust(TOKEN_CHARS, "\0") + around[-SIDE:])
    return out


def _like_words(words: list[str], n: int) -> list[str]:
    """``n`` runs of ordinary words amid ordinary words: paths, slugs, names of code and words run together."""
    out, rng = [], random.Random(7)
    for k in range(n):
        by, run = "-/_"[k % 4 : k % 4 + 1], rng.choice(words)
        while len(run) < 20:
            word = rng.choice(words)
            run += by + (word if by else word.capitalize())
        before, after = (" ".join(rng.choice(words) for _ in range(4)) for _ in range(2))
        out += windows(f"{before} {run} {after}", len(before) + 1, len(before) + 1 + len(run))[:1]
    return out


def train_net(
    docs: DataFrame,
    text: str = "text",
    least_recall: float = 0.95,
    least_rows: int = 200,
    shard_rows: int = 16_384,
) -> CharNet | None:
    """A network from labelled findings: candidates that a fixed pattern found, against those none touches.

    All documents are searched, and all distinct windows of all candidates are learned from or held out, in shards
    (``fit_shards``). Findings also count in other spellings, amid the context of
    rows without any, so the network learns how secrets look and not just what the patterns say. A label with fewer
    than ``least_rows`` rows is filled up: with generated secrets in the contexts of findings, or with runs of the
    corpus' own words. A quarter, by a hash of the candidate, is held out for calibration and threshold: windows and spellings
    of one secret lie on one side. None, with a
    warning, if no pattern finds anything, or if there are neither other candidates nor words.
    """
    docs = docs.select(F.col(text).cast("string").alias("_text"))
    spark = docs.sparkSession

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in batch.column(1):
                value = t.as_py() or ""
                base = base_spans(value)
                rows = [(w, int(hit), _number(value[s:e])) for s, e, hit in candidates(value, base) for w in windows(value, s, e)]
                if rows:
                    kinds = (pa.string(), pa.int32(), pa.int64())
                    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, names=["w", "label", "whole"])

    every = docs.select(F.lit(0), "_text").mapInArrow(found, "w string, label int, whole long")
    both = every.groupBy("w").agg(*[F.min(F.when(F.col("label") == v, F.col("whole"))).alias(f"_{v}") for v in (0, 1)])
    # a window of both labels lies on the side of the one without a finding
    label = F.explode(F.filter(F.array(F.when(F.col("_0").isNotNull(), 0), F.when(F.col("_1").isNotNull(), 1)), lambda v: v.isNotNull()))
    rows = both.select("w", label.alias("label"), F.coalesce("_0", "_1").alias("whole"), F.xxhash64("w").alias("h"))
    rows = prefix_sums(rows, ["label"], ["h", "w"], F.lit(1), "n").withColumn("n", F.col("n") - 1)
    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    n_good, n_bad = sizes.get(1, 0), sizes.get(0, 0)
    # the first of each label, for a label that has too few
    good, bad = ([r["w"] for r in rows.where((F.col("label") == v) & (F.col("n") < least_rows)).orderBy("n").collect()] for v in (1, 0))
    made = []
    if good and n_bad < least_rows:
        each = docs.select(F.explode(F.regexp_extract_all("_text", F.lit(r"\b[A-Za-z]{2,15}\b"), F.lit(0))).alias("w")).distinct()
        words = [r["w"] for r in each.orderBy(F.xxhash64("w"), "w").limit(2_000).collect()]
        made += [(w, 0) for w in (_like_words(words, least_rows - n_bad) if words else [])]
    if not good or not bad + made:
        warnings.warn(f"no network for secrets: {n_good} findings and {n_bad} other candidates to learn from", stacklevel=2)
        return None
    made += [(w, 1) for w in _like_secrets(good, bad + [w for w, _ in made], least_rows - n_good)]
    firsts = {0: n_bad, 1: n_good}
    listed = []
    for w, v in made:
        listed.append((w, v, _number(w), firsts[v]))
        firsts[v] += 1
    all_bad, all_good = firsts[0], firsts[1]
    rows = rows.select("w", "label", "whole", "n")
    rows = materialize(rows.unionByName(spark.createDataFrame(listed, "w string, label int, whole long, n long")), "filled")

    def spelled(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            frame["w"] = [_variants(w, other, n)[0][0] for w, other, n in zip(frame["w"], frame["other"], frame["n"], strict=True)]
            yield frame.drop(columns="other")

    around = rows.where("label = 0").select(F.col("n").alias("at"), F.col("w").alias("other"))
    again = rows.where("label = 1").withColumn("at", F.col("n") % all_bad).join(around, "at").select("w", "label", "whole", "n", "other")
    again = again.mapInPandas(spelled, "w string, label int, whole long, n long").withColumn("n", F.col("n") + all_good + all_bad)
    pos = F.when(F.col("label") == 1, F.col("n")).otherwise(F.col("n") + all_good)
    examples = rows.withColumn("n", pos).unionByName(again)
    held = F.col("whole") % 4 == 0
    examples = materialize(examples.select(F.col("n").alias("pos"), "w", "label", held.alias("held")), "examples")
    counts = {(r["held"], r["label"]): r["count"] for r in examples.groupBy("held", "label").count().collect()}
    if len(counts) < 4:
        warnings.warn("no network for secrets: a label has no row to fit or to hold out", stacklevel=2)
        return None
    n = counts[False, 0] + counts[False, 1]
    net = fit_shards(examples.where("NOT held"), n, counts[False, 1] / n, shard_rows)
    return calibrate(net, examples.where("held"), least_recall)


def text_spans(texts: list[str], net: CharNet | None) -> list[list[Span]]:
    """All findings of each text, by start, then kind: the base ones, and candidates that the network gives at least its
    threshold in any of their windows. Every candidate is scored that no base finding covers, also where one touches it."""
    out = [base_spans(t) for t in texts]
    if net is None:
        return out
    asked = []
    for n, t in enumerate(texts):
        covered, at, end = out[n], 0, 0
        for s, e, hit in candidates(t, covered):
            while hit and at < len(covered) and covered[at][1] <= s:
                end = max(end, covered[at][2])
                at += 1
            if not hit or end < e:
                asked += [(n, s, e, w) for w in windows(t, s, e)]
    found = set()
    for at in range(0, len(asked), 4096):
        part = asked[at : at + 4096]
        for (n, s, e, _), p in zip(part, net.chance(codes([a[3] for a in part])), strict=True):
            if p >= net.threshold:
                found.add((n, s, e))
    for n, s, e in found:
        out[n].append(("net", s, e))
    return [sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]))) for spans in out]


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def scan(docs: DataFrame, net: CharNet | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_assign, n_access, n_hex, n_net, base_sha256, spans)`` per row, whole texts read, nothing shuffled.

    ``spans`` joins ``kind:start:end`` (code points, end exclusive) by commas, ``base_sha256`` digests the same string
    of the base findings alone. A null text counts as empty: no findings and the digest of the empty string.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                rows = []
                for spans in text_spans([t or "" for t in batch.column(1).to_pylist()], net):
                    kinds = [s[0] for s in spans]
                    base = joined([s for s in spans if s[0] != "net"])
                    rows.append((*map(kinds.count, KINDS), hashlib.sha256(base.encode()).hexdigest(), joined(spans)))
                kinds = [pa.int64()] * 4 + [pa.string()] * 2
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=names)

    names = [key, *[f"n_{k}" for k in KINDS], "base_sha256", "spans"]
    schema = f"`{key}` {kind}, n_assign long, n_access long, n_hex long, n_net long, base_sha256 string, spans string"
    return docs.select(key, F.col(text).cast("string")).mapInArrow(run, schema)


def redact(docs: DataFrame, net: CharNet | None, text: str = "text", mark: str = "[SECRET]", chars: str | None = None) -> DataFrame:
    """``docs`` with every finding in ``text`` replaced by ``mark``, overlapping ones as one; rows without findings and
    null texts are unchanged. If ``chars`` names a column, it gets the new length where the text changed."""
    names, schema = docs.columns, T.StructType(docs.schema.fields)
    at_text = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                texts = batch.column(at_text).to_pylist()
                new = [blanked(t, s, mark) for t, s in zip(texts, text_spans([t or "" for t in texts], net), strict=True)]
                columns = list(batch.columns)
                columns[at_text] = pa.array(new, batch.schema.field(at_text).type)
                if chars in names:
                    old = columns[names.index(chars)]
                    sizes = [o if t == n else len(n) for t, n, o in zip(texts, new, old.to_pylist(), strict=True)]
                    columns[names.index(chars)] = pa.array(sizes, old.type)
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(run, schema)


def blanked(text: str | None, spans: list[Span], mark: str) -> str | None:
    if not text or not spans:
        return text
    out, at = [], 0
    end = -1
    for _, s, e in spans:
        if s >= end:
            out += [text[at:s], mark]
        end = at = max(end, e)
    return "".join(out) + text[at:]
