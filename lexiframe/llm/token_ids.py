"""Token ids of many texts at once: words are told apart in Arrow, each is encoded once and kept in a bounded cache."""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from lexiframe.llm.periodic_runs import text_slices, words_of
from lexiframe.llm.worker_cache import only_cache

CACHED_BYTES = 64_000_000
WORD_BYTES = 200  # what a word and its ids take in the cache besides their own bytes
SLICE_BYTES = 4_000_000


class TextEncoder:
    """Ids of texts as little-endian 32-bit numbers, through a cache of words whose size in bytes is bounded.

    Holds for tokenizers like ``word_bpe_49k``: blanks are dropped and never joined over, capitals do not count, runs of
    letters are kept apart from punctuation, and the last id of every run ends with the mark of a word's end. Then the
    ids of a text are those of its blank-separated words one after another, and those of ``Word.`` are those of ``word``
    and ``.``. Only ASCII blanks separate here; other blanks stay in their word and are the tokenizer's.
    """

    def __init__(self, path: str, cached_bytes: int = CACHED_BYTES):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.cached_bytes = cached_bytes
        vocabulary = self.model.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        #: words asked for lately, and those of the time before: what is not asked for again goes
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.young_bytes = 0

    def __call__(self, texts: pa.Array) -> tuple[bytes, np.ndarray]:
        """The ids of all texts one after another, and how many each text has; a null text has none."""
        parts = [self._slice(texts.slice(at, to - at)) for at, to in text_slices(texts, SLICE_BYTES)]
        return b"".join(ids for ids, _ in parts), np.concatenate([np.zeros(0, np.int64), *[n for _, n in parts]])

    def _slice(self, texts: pa.Array) -> tuple[bytes, np.ndarray]:
        bounds, words = words_of(self._plain(texts))
        coded = words.dictionary_encode()
        each = pa.array(self._ids(coded.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.binary())
        ids = each.take(coded.indices)
        ends = ids.buffers()[1]
        ends = np.frombuffer(ends, np.int32)[: len(ids) + 1] if ends else np.zeros(1, np.int32)
        data = ids.buffers()[2].to_pybytes() if len(ids) and ids.buffers()[2] else b""
        return data[: ends[-1]], np.diff(ends[bounds].astype(np.int64)) // 4

    @staticmethod
    def _plain(texts: pa.Array) -> pa.Array:
        """Small letters, and a full stop or comma behind a word apart from it: the same ids from fewer different words.

        Texts with the opening mark of special tokens, which are told from other words by their case, stay as they are.
        """
        texts = pc.fill_null(texts, "")
        small = pc.replace_substring_regex(pc.ascii_lower(texts), r"(\pL)([.,])([\x20\t-\r]|$)", r"\1 \2\3")
        return pc.if_else(pc.match_substring(texts, "<|"), texts, small)

    def _ids(self, words: list[str]) -> list[bytes]:
        if self.young_bytes > self.cached_bytes // 2:
            self.old, self.young, self.young_bytes = self.young, {}, 0
        young, old = self.young, self.old
        missing = [w for w in words if w not in young]
        if missing:
            self._keep({w: old[w] for w in missing if w in old})
            self._encode([w for w in missing if w not in old])
        return [young[w] for w in words]

    def _keep(self, found: dict[str, bytes]) -> None:
        self.young.update(found)
        self.young_bytes += sum(map(len, found)) + sum(map(len, found.values())) + WORD_BYTES * len(found)

    def _encode(self, words: list[str]) -> None:
        """Encodes words many at a time: runs of letters as one text, cut where an id ends a word."""
        letters = [w for w in words if w.isalpha()]
        others = [w for w in words if not w.isalpha()]
        found: dict[str, bytes] = {}
        chunks = [letters[at : at + 500] for at in range(0, len(letters), 500)]
        for part, ids in zip(chunks, self._model_ids([" ".join(p) for p in chunks]), strict=True):
            stops = (4 * np.flatnonzero(self.ends[ids]) + 4).tolist()
            if len(stops) != len(part):  # some word has marks among its letters when normalised
                others += part
                continue
            raw = ids.tobytes()
            found.update(zip(part, map(raw.__getitem__, map(slice, [0, *stops], stops)), strict=True))
        found.update((w, ids.tobytes()) for w, ids in zip(others, self._model_ids(others), strict=True))
        self._keep(found)

    def _model_ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]


def text_encoder(path: str) -> TextEncoder:
    """One encoder for a tokenizer file while a Python worker has no other cache."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks run side by side already
    return only_cache(("encoder", path), lambda: TextEncoder(path))
