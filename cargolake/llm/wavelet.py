"""A wavelet matrix: bit-planes with rank and select, over arrays of small whole numbers.

Plane by plane from the highest bit, the sequence is stored as one bit per
element and then stably split into the elements with a 0 and those with a 1.
All look-ups take arrays and follow the planes with one rank per plane.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard

MAGIC = b"WMX1"
WORD = 64


class BitPlane:
    """Bits in 64-bit words, with the number of ones before each word."""

    def __init__(self, words: np.ndarray, n: int):
        self.words, self.n = words, n
        self.before = np.zeros(len(words) + 1, np.uint32 if n < 1 << 32 else np.uint64)
        np.cumsum(np.bitwise_count(words), out=self.before[1:])

    @classmethod
    def of(cls, bits: np.ndarray) -> BitPlane:
        packed = np.packbits(bits, bitorder="little")
        words = np.zeros(len(bits) // WORD + 1, np.uint64)
        words.view(np.uint8)[: len(packed)] = packed
        return cls(words, len(bits))

    def bits(self) -> np.ndarray:
        return np.unpackbits(self.words.view(np.uint8), count=self.n, bitorder="little").view(bool)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) != 0

    def ones(self, at: np.ndarray) -> np.ndarray:
        """How many ones lie before each position."""
        word = at >> 6
        below = self.words[word] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
        return self.before[word].astype(np.int64) + np.bitwise_count(below)

    def select(self, nth: np.ndarray, one: bool) -> np.ndarray:
        """Position of the n-th (from 0) bit of a kind, by search in the counts and in the word."""
        starts = self.before.astype(np.int64)
        if not one:
            starts = np.arange(len(starts), dtype=np.int64) * WORD - starts
        word = np.searchsorted(starts, nth, side="right") - 1
        left = nth - starts[word]
        rest = self.words[word] if one else ~self.words[word]
        lo, hi = np.zeros(len(nth), np.int64), np.full(len(nth), WORD - 1)
        for _ in range(6):
            mid = (lo + hi) >> 1
            upto = np.bitwise_count(rest & (~np.uint64(0) >> (63 - mid).astype(np.uint64))).astype(np.int64)
            enough = upto > left
            hi, lo = np.where(enough, mid, hi), np.where(enough, lo, mid + 1)
        return word * WORD + lo


class WaveletMatrix:
    """Access, counting and look-up of occurrences over ``planes`` from the highest bit to the lowest."""

    def __init__(self, planes: list[BitPlane], n: int):
        self.planes, self.n = planes, n
        self.zeros = [n - int(p.before[-1]) for p in planes]

    @classmethod
    def of(cls, values: np.ndarray, bits: int | None = None) -> WaveletMatrix:
        n = len(values)
        if bits is None:
            bits = max(1, int(values.max()).bit_length()) if n else 1
        planes = []
        for b in range(bits - 1, -1, -1):
            plane = BitPlane.of((values & values.dtype.type(1 << b)) != 0)
            planes.append(plane)
            if b:  # Arrow filters by packed bits, without a branch per element
                one = pa.BooleanArray.from_buffers(pa.bool_(), n, [None, pa.py_buffer(plane.words)])
                whole = pa.array(values)
                values = np.concatenate([pc.filter(whole, pc.invert(one)).to_numpy(), pc.filter(whole, one).to_numpy()])
        return cls(planes, n)

    def values(self, dtype: type = np.uint16) -> np.ndarray:
        """The whole sequence, undone plane by plane from the lowest."""
        out = np.zeros(self.n, dtype)
        for b, plane in enumerate(reversed(self.planes)):
            one = plane.bits()
            zeros = self.n - int(plane.before[-1])
            merged = np.empty_like(out)
            merged[~one] = out[:zeros]
            merged[one] = out[zeros:] | dtype(1 << b)
            out = merged
        return out

    def access(self, at: np.ndarray) -> np.ndarray:
        at, out = np.asarray(at, np.int64), np.zeros(len(at), np.int64)
        for plane, zeros in zip(self.planes, self.zeros):
            one, ones = plane.get(at), plane.ones(at)
            out = (out << 1) | one
            at = np.where(one, zeros + ones, at - ones)
        return out

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each symbol its first place in the last plane's order, and the place that stands for position ``at``.

        The difference of two places is the number of the symbol's occurrences between the positions.
        """
        symbol, at = np.asarray(symbol, np.int64), np.asarray(at, np.int64)
        first = np.zeros(len(symbol), np.int64)
        for i, (plane, zeros) in enumerate(zip(self.planes, self.zeros)):
            one = (symbol >> (len(self.planes) - 1 - i)) & 1 != 0
            a, f = plane.ones(at), plane.ones(first)
            at, first = np.where(one, zeros + a, at - a), np.where(one, zeros + f, first - f)
        return first, at

    def descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The places in the last plane's order that stand for positions ``at``, one symbol each."""
        for i, (plane, zeros) in enumerate(zip(self.planes, self.zeros)):
            one = (symbol >> (len(self.planes) - 1 - i)) & 1 != 0
            ones = plane.ones(at)
            at = np.where(one, zeros + ones, at - ones)
        return at

    def count(self, symbol: int, start: int = 0, stop: int | None = None) -> int:
        if not 0 <= symbol < 1 << len(self.planes):
            return 0
        _, at = self.rank(np.array([symbol] * 2), np.array([start, self.n if stop is None else stop]))
        return int(at[1] - at[0])

    def occurrences(self, symbol: int) -> np.ndarray:
        """All positions of a symbol, by select from the last plane up."""
        total = self.count(symbol)
        if not total:
            return np.empty(0, np.int64)
        first, _ = self.rank(np.array([symbol]), np.array([0]))
        at = first[0] + np.arange(total)
        for b, (plane, zeros) in enumerate(zip(reversed(self.planes), reversed(self.zeros))):
            one = bool(symbol >> b & 1)
            at = plane.select(at - zeros if one else at, one)
        return at

    def to_bytes(self, level: int = 1) -> bytes:
        packer = zstandard.ZstdCompressor(level=level)
        parts = [packer.compress(p.words.tobytes()) for p in self.planes]
        head = MAGIC + struct.pack("<QI", self.n, len(parts)) + b"".join(struct.pack("<Q", len(p)) for p in parts)
        return head + b"".join(parts)

    @classmethod
    def from_bytes(cls, raw: bytes) -> WaveletMatrix:
        if raw[:4] != MAGIC:
            raise ValueError("not a wavelet matrix")
        n, count = struct.unpack_from("<QI", raw, 4)
        sizes = struct.unpack_from(f"<{count}Q", raw, 16)
        at, planes, unpacker = 16 + 8 * count, [], zstandard.ZstdDecompressor()
        for size in sizes:
            planes.append(BitPlane(np.frombuffer(unpacker.decompress(raw[at : at + size]), np.uint64), n))
            at += size
        return cls(planes, n)
