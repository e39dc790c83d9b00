"""Vectorised hashes of words and of windows of consecutive words.

Words are the maximal runs without ASCII white space (``[^\\x20\\x09-\\x0D]+`` on the
UTF-8 bytes).  A word's hash is a polynomial of its bytes modulo 2^64, taken from
one running sum over a block of words and finalised; a window's hash is the same
over its word hashes.  Both depend on content alone, not on position."""

from __future__ import annotations

import numpy as np

from fleetlake.llm.common import mix64

_BYTE_BASE = 0x9E3779B97F4A7C15
_WORD_BASE = 0xD6E8FEB86659FD93
#: bytes hashed at once, or one longer word
_BLOCK = 1 << 18
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Powers:
    """Powers of an odd base and of its inverse modulo 2^64, as far as needed."""

    def __init__(self, base: int):
        self.base, self.inverse = np.uint64(base), np.uint64(pow(base, -1, 1 << 64))
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 1 << 16)
            one = np.ones(1, dtype=np.uint64)
            self.up = np.cumprod(np.concatenate([one, np.full(size, self.base)]))
            self.down = np.cumprod(np.concatenate([one, np.full(size, self.inverse)]))
        return self.up, self.down


_BYTES, _WORDS = Powers(_BYTE_BASE), Powers(_WORD_BASE)


def _word_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    up, down = _BYTES.get(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:len(raw)], out=sums[1:])
    return mix64((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


class Words:
    """The words of some texts: their places in ``data``, hashes and owners.

    ``first`` has the index of each text's first word and, at its end, the number
    of all words."""

    def __init__(self, texts: list[str], lower: bool = False):
        parts = [t.encode("utf-8", "surrogatepass") for t in texts]
        self.data = b" ".join(parts) + b" "
        raw = np.frombuffer(self.data, dtype=np.uint8)
        if lower:
            raw = _LOWER[raw]
            self.data = raw.tobytes()
        space = _SPACE[raw]
        change = np.diff(space.astype(np.int8), prepend=np.int8(1))
        self.start = np.nonzero(change == -1)[0]
        self.end = np.nonzero(change == 1)[0]
        if len(self.end) > len(self.start):
            self.end = self.end[-len(self.start):] if len(self.start) else self.end[:0]
        self.hash = np.empty(len(self.start), dtype=np.uint64)
        at = 0
        while at < len(self.start):  # blocks of whole words keep the sums in the cache
            stop = max(at + 1, int(np.searchsorted(self.start, self.start[at] + _BLOCK)))
            low, high = self.start[at], self.end[stop - 1]
            self.hash[at:stop] = _word_hashes(raw[low:high], self.start[at:stop] - low, self.end[at:stop] - low)
            at = stop
        begins = np.cumsum([0, *[len(p) + 1 for p in parts]])
        self.first = np.searchsorted(self.start, begins)

    def windows(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the window of ``length`` words that starts at each word (as far
        as there are so many), and whether it lies within one text."""
        return window_hashes(self.hash, self.first, length)


def window_hashes(hashes: np.ndarray, first: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    n = len(hashes)
    if n < length:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=bool)
    up, down = _WORDS.get(n + 1)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(hashes * up[:n], out=sums[1:])
    out = mix64((sums[length:] - sums[:-length]) * down[:n - length + 1])
    left = np.repeat(first[1:], np.diff(first)) - np.arange(n)
    return out, left[:n - length + 1] >= length


__all__ = ["Words", "window_hashes"]
