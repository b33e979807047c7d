"""Elias-Fano code of ascending numbers: near-minimal space, any number by a select on the upper bits."""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np

SAMPLE = 256  # every so manieth set bit has its place noted, so a select reads a bounded stretch
HEAD = struct.Struct("<QQBQQQ")  # numbers, smallest, lower bits of each, and the bytes of lower bits, upper bits, samples


def _packed(values: np.ndarray, bits: int) -> np.ndarray:
    """``bits`` bits of every value, least first, as bytes."""
    if not bits:
        return np.zeros(0, np.uint8)
    out = []
    for at in range(0, len(values), 8 * 4096):  # so many values fill whole bytes
        some = values[at : at + 8 * 4096]
        out.append(np.packbits((some[:, None] >> np.arange(bits, dtype=np.uint64) & np.uint64(1)).astype(np.uint8), bitorder="little"))
    return np.concatenate([np.zeros(0, np.uint8), *out])


def _unpacked(data: np.ndarray, bits: int, first: int, last: int) -> np.ndarray:
    """The packed values from ``first`` up to ``last``."""
    if not bits or first >= last:
        return np.zeros(last - first, np.uint64)
    begin, end = first * bits, last * bits
    flat = np.unpackbits(data[begin // 8 : -(-end // 8)], bitorder="little")[begin % 8 : begin % 8 + end - begin]
    return (flat.reshape(-1, bits).astype(np.uint64) << np.arange(bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


@dataclass
class EliasFano:
    """``n`` ascending numbers, each less the smallest, ``base``: the lower bits of each as they are, and the upper bits
    in unary, number ``i`` as the bit at its upper part plus ``i``. About ``2 + log2(range / n)`` bits a number."""

    n: int
    base: int
    bits: int
    low: np.ndarray
    high: np.ndarray
    samples: np.ndarray

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        """The code of ascending 64-bit integers, repeats allowed."""
        values = np.asarray(values, np.int64)
        if not len(values):
            return cls(0, 0, 0, *np.zeros((2, 0), np.uint8), np.zeros(0, np.uint32))
        base, n = int(values[0]), len(values)
        rest = values.astype(np.uint64) - np.uint64(base % (1 << 64))  # modulo 2^64, so no range overflows
        bits = max(0, (int(rest[-1]) // n).bit_length() - 1)
        places = (rest >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(places[-1]) // 8 + 1, np.uint8)
        np.bitwise_or.at(high, places // 8, (1 << (places % 8)).astype(np.uint8))
        return cls(n, base, bits, _packed(rest, bits), high, places[::SAMPLE].astype(np.uint32))

    def to_bytes(self) -> bytes:
        parts = [p.tobytes() for p in (self.low, self.high, self.samples)]
        return HEAD.pack(self.n, self.base % (1 << 64), self.bits, *map(len, parts)) + b"".join(parts)

    @classmethod
    def from_bytes(cls, raw: bytes) -> EliasFano:
        n, base, bits, *sizes = HEAD.unpack_from(raw)
        cuts = np.cumsum([HEAD.size, *sizes]).tolist()
        low, high, samples = (np.frombuffer(raw[a:b], kind) for a, b, kind in zip(cuts, cuts[1:], (np.uint8, np.uint8, np.uint32)))
        return cls(n, base - (1 << 64) if base >> 63 else base, bits, low, high, samples)

    def select(self, i: int) -> int:
        """Where set bit ``i`` of the upper bits stands: from the nearest sample on, byte counts lead to it."""
        at = int(self.samples[i // SAMPLE])
        wanted = i % SAMPLE
        byte = at // 8
        head = int(self.high[byte]) >> at % 8 << at % 8
        while (held := head.bit_count()) <= wanted:
            wanted -= held
            byte += 1
            head = int(self.high[byte])
        for _ in range(wanted):
            head &= head - 1
        return 8 * byte + (head & -head).bit_length() - 1

    def __getitem__(self, i: int) -> int:
        """Number ``i``."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        upper = self.select(i) - i
        return self.base + (upper << self.bits) + int(_unpacked(self.low, self.bits, i, i + 1)[0])

    def range(self, first: int, last: int) -> np.ndarray:
        """Numbers ``first`` up to ``last``, decoded together."""
        if first >= last:
            return np.zeros(0, np.int64)
        begin, end = self.select(first) // 8, self.select(last - 1) // 8 + 1
        places = 8 * begin + np.flatnonzero(np.unpackbits(self.high[begin:end], bitorder="little"))
        skip = int(np.searchsorted(places, self.select(first)))
        upper = (places[skip : skip + last - first] - np.arange(first, last)).astype(np.uint64)
        rest = (upper << np.uint64(self.bits)) + _unpacked(self.low, self.bits, first, last)
        return (rest + np.uint64(self.base % (1 << 64))).astype(np.int64)

    def first_from(self, value: int) -> int:
        """Index of the first number that is at least ``value``, by halving over selects."""
        low, high = 0, self.n
        while low < high:
            middle = (low + high) // 2
            if self[middle] < value:
                low = middle + 1
            else:
                high = middle
        return low
