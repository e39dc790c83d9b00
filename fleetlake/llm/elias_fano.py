"""Ascending integers in about 2 + log2(universe / n) bits each, with random access.

A value's low bits are packed; its high part h, as the i-th value, sets bit h + i of a
bit string.  ``select`` finds the i-th set bit: a binary search over the counts before
each 512-bit block (32 bits a block, that is under a fifth of a bit a value), then byte
counts inside the block, then the byte.  Value i is (select(i) - i) << low bits | its
low bits.  All functions work on numpy arrays of places at once."""

from __future__ import annotations

import struct

import numpy as np

_HEAD = struct.Struct("<QB7xQQQ")  # values, low bits, bytes of low bits, of high bits, of counts
_BLOCK = 64                        # bytes of a block of high bits
_ONES = np.array([bin(b).count("1") for b in range(256)], dtype=np.uint8)
_PLACE = np.array([([i for i in range(8) if b >> i & 1] + [0] * 8)[:8] for b in range(256)], dtype=np.uint8)


class EliasFano:
    """``n`` ascending values, read from bytes as ``encode`` gives them."""

    def __init__(self, data):
        view = memoryview(data)
        self.n, self.low_bits, low, high, counts = _HEAD.unpack_from(view)
        at = _HEAD.size
        self._low = np.frombuffer(view, np.uint8, low, at)
        self._high = np.frombuffer(view, np.uint8, high, at + low)
        self._before = np.frombuffer(view, "<u4", counts // 4, at + low + high)
        self.n_bytes = at + low + high + counts

    @staticmethod
    def encode(values: np.ndarray) -> bytes:
        """``values`` as unsigned 64-bit integers that don't descend."""
        values = values.astype(np.uint64)
        n = len(values)
        universe = int(values[-1]) + 1 if n else 1
        low_bits = max(0, (universe // max(n, 1)).bit_length() - 1)
        bits = (values[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
        low = np.packbits(bits.astype(np.uint8), axis=None, bitorder="little")
        low = np.concatenate([low, np.zeros(-len(low) % 8 + 16, np.uint8)])  # room for whole-word reads
        places = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        size = -(-(int(places[-1]) + 1 if n else 1) // (8 * _BLOCK)) * _BLOCK
        flags = np.zeros(8 * size, dtype=np.uint8)
        flags[places] = 1
        high = np.packbits(flags, bitorder="little")
        ones = _ONES[high].reshape(-1, _BLOCK).sum(axis=1, dtype=np.int64)
        before = (np.cumsum(ones) - ones).astype("<u4")
        return b"".join([_HEAD.pack(n, low_bits, len(low), len(high), 4 * len(before)),
                         low.tobytes(), high.tobytes(), before.tobytes()])

    def select(self, places: np.ndarray) -> np.ndarray:
        """Where the set bits numbered ``places`` (from 0) stand."""
        places = np.asarray(places, dtype=np.int64)
        block = np.searchsorted(self._before, places, side="right") - 1
        left = places - self._before[block]
        window = self._high.reshape(-1, _BLOCK)[block]
        upto = np.cumsum(_ONES[window], axis=1, dtype=np.int64)
        byte = (upto <= left[:, None]).sum(axis=1)
        rows = np.arange(len(places))
        left -= np.where(byte > 0, upto[rows, byte - 1], 0)
        return (block * _BLOCK + byte) * 8 + _PLACE[window[rows, byte], left]

    def get(self, places: np.ndarray) -> np.ndarray:
        """The values numbered ``places``, unsigned 64-bit."""
        places = np.asarray(places, dtype=np.int64)
        high = (self.select(places) - places).astype(np.uint64) << np.uint64(self.low_bits)
        if not self.low_bits:
            return high
        first = places * self.low_bits
        byte, shift = first >> 3, (first & 7).astype(np.uint64)
        words = np.ascontiguousarray(self._low[byte[:, None] + np.arange(8)]).view("<u8")[:, 0] >> shift
        over = shift.astype(np.int64) + self.low_bits > 64  # the ninth byte holds the rest
        rest = self._low[byte + 8].astype(np.uint64) << ((np.uint64(64) - shift) & np.uint64(63))
        words = np.where(over, words | rest, words)
        return high | (words & np.uint64((1 << self.low_bits) - 1))


__all__ = ["EliasFano"]
