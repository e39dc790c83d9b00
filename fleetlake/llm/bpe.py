"""BPE encoding and decoding over a contiguous rank array.

A short word is a row of part ids and a row of the merge ranks of neighbouring
parts.  Each step takes the smallest rank of every row (the leftmost of equal
ones), deletes that boundary and refreshes the two ranks beside it, until no rank
is left.  Rows of words of equal length step together in numpy.  Words longer
than ``LONG_WORD`` parts are merged with a heap, which is not quadratic.

The vocabulary file is a parameter.  The text rules are those the file states:
NFC, runs of white space to one space, lower case, then words; the strings of
special tokens are found before that; ids decode to their tokens joined by
spaces, as the file names no decoder.

Defined cases: a null text is the empty text, which has no tokens and decodes to
the empty text; very long texts and words are processed whole; each row is
encoded by itself, so repeated rows and ties need no rule; other columns are left
out of the result.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from fleetlake.llm.common import id_and_text, record_batch, slices

#: words of more parts than this are merged with a heap
LONG_WORD = 200
#: distinct words that a worker remembers; beyond, it forgets all and starts anew
CACHE_WORDS = 300_000

_NONE = np.int32(2**31 - 1)
_PLAIN = re.compile(r"[\x00-\x7eÀ-ÖØ-öø-ÿ]*")
_PLAIN_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\x09-\x0d\x20a-zß-öø-ÿ0-9]+")
_WORDS = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+", regex.V0)
_SPACES = regex.compile(r"\p{White_Space}+")


def _byte_symbols() -> list[str]:
    """The printable symbol of each byte in byte-level vocabularies: the byte's own
    Latin-1 character where that is visible, else the next free one from U+0100."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class Bpe:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        suffix = model["end_of_word_suffix"] or ""
        symbols = _byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], dtype=np.int32)
        self.last = np.array([vocab[s + suffix] for s in symbols], dtype=np.int32)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token = {i: t for t, i in [*vocab.items(), *self.special.items()]}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], dtype=np.uint64)
        right = np.array([vocab[b] for _, b in pairs], dtype=np.uint64)
        made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int32)
        keys = (left << np.uint64(32)) | right
        keys, first = np.unique(keys, return_index=True)
        self.keys, self.rank, self.made = keys, first.astype(np.int32), made
        self.split = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))))
        self.known: dict[str, tuple[bytes, str]] = {}

    # -- one word -----------------------------------------------------------

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge rank of each pair of ids; none: the largest int."""
        key = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank[at], _NONE)

    def merge_rows(self, ids: np.ndarray) -> list[np.ndarray]:
        """Final ids of each row of ``ids`` (words of equal length)."""
        out: list[np.ndarray] = [None] * len(ids)  # type: ignore[list-item]
        rows = np.arange(len(ids))
        rank = np.full(ids.shape, _NONE, dtype=np.int32)
        if ids.shape[1] > 1:
            rank[:, :-1] = self.ranks(ids[:, :-1], ids[:, 1:])
        while len(rows):
            at = rank.argmin(axis=1)
            best = rank[np.arange(len(rows)), at]
            done = best == _NONE
            if done.any():
                for r, word in zip(rows[done], ids[done], strict=True):
                    out[r] = word
                go = ~done
                rows, ids, rank, at, best = rows[go], ids[go], rank[go], at[go], best[go]
                if not len(rows):
                    break
            n = ids.shape[1]
            each = np.arange(len(rows))
            ids[each, at] = self.made[best]
            step = np.arange(n - 1)[None, :]
            ids = np.take_along_axis(ids, step + (step > at[:, None]), axis=1)
            rank = np.take_along_axis(rank, step + (step >= at[:, None]), axis=1)
            inner = at < n - 2
            rank[each, at] = _NONE
            if inner.any():
                r, a = each[inner], at[inner]
                rank[r, a] = self.ranks(ids[r, a], ids[r, a + 1])
            inner = at > 0
            if inner.any():
                r, a = each[inner], at[inner]
                rank[r, a - 1] = self.ranks(ids[r, a - 1], ids[r, a])
        return out

    def merge_long(self, ids: np.ndarray) -> np.ndarray:
        """The same for one long word: a heap of ranks over linked parts."""
        part, n = ids.tolist(), len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        merge = {}
        heap = []

        def look(i: int) -> None:
            j = after[i]
            if j < n:
                pair = (part[i], part[j])
                if pair not in merge:
                    merge[pair] = int(self.ranks(np.array(pair[:1]), np.array(pair[1:]))[0])
                if merge[pair] != _NONE:
                    heapq.heappush(heap, (merge[pair], i, pair[0], pair[1]))

        for i in range(n - 1):
            look(i)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if part[i] != a or j >= n or part[j] != b:
                continue
            part[i], part[j] = int(self.made[rank]), -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            look(i)
            if before[i] >= 0:
                look(before[i])
        return np.array([p for p in part if p >= 0], dtype=np.int32)

    # -- texts --------------------------------------------------------------

    def words(self, text: str) -> list[str]:
        """The words of a text without special tokens."""
        if _PLAIN.fullmatch(text):
            return _PLAIN_WORDS.findall(text.lower())
        text = _SPACES.sub(" ", unicodedata.normalize("NFC", text))
        # lower case by character: no rule that looks at a letter's neighbours
        return _WORDS.findall(text.replace("Σ", "σ").lower())

    def pieces(self, text: str) -> list[str]:
        """Words and special tokens (kept as they are) in order."""
        if not any(s in text for s in self.special):
            return self.words(text)
        out, at = [], 0
        for m in self.split.finditer(text):
            out += self.words(text[at:m.start()])
            out.append(m[0])
            at = m.end()
        return out + self.words(text[at:])

    def learn(self, words: set[str]) -> None:
        """Encode the words that are not yet known."""
        if len(self.known) + len(words) > CACHE_WORDS:
            self.known = {}
        by_length: dict[int, list[tuple[str, bytes]]] = {}
        for w in words:
            if w in self.special:
                self.known[w] = (np.uint32(self.special[w]).tobytes(), w)
            elif w not in self.known:
                data = w.encode("utf-8", "surrogatepass")
                by_length.setdefault(len(data), []).append((w, data))
        for n, group in by_length.items():
            raw = np.frombuffer(b"".join(d for _, d in group), dtype=np.uint8).reshape(-1, n)
            ids = self.inner[raw]
            ids[:, -1] = self.last[raw[:, -1]]
            merged = self.merge_rows(ids) if n <= LONG_WORD else [self.merge_long(x) for x in ids]
            for (w, _), found in zip(group, merged, strict=True):
                token = self.token
                self.known[w] = (found.astype("<u4").tobytes(),
                                 " ".join([token[i] for i in found.tolist()]))

    def encode_all(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """Ids (little-endian unsigned 32-bit) and decoded text of each text."""
        found = [self.pieces(t) for t in texts]
        self.learn(set().union(*found))
        known = self.known
        out = []
        for words in found:
            both = [known[w] for w in words]
            out.append((b"".join([x[0] for x in both]), " ".join([x[1] for x in both])))
        return out

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_all([text])[0][0], dtype="<u4").tolist()

    def decode(self, ids: list[int]) -> str:
        return " ".join(self.token[i] for i in ids)


@functools.lru_cache(maxsize=2)
def load(path: str) -> Bpe:
    """One encoder for each worker process and file."""
    return Bpe(path)


def bpe_digest(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row's whole text."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()),
                        ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def run(batches):
        model = load(path)
        for ids, texts in slices(batches):
            found = model.encode_all(texts)
            yield record_batch(
                schema, ids, [len(b) // 4 for b, _ in found],
                [hashlib.sha256(b).hexdigest() for b, _ in found],
                [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for _, t in found])

    return id_and_text(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def bpe_encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids array<int>, decoded string`` of every row's whole text."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])

    def run(batches):
        model = load(path)
        for ids, texts in slices(batches):
            found = model.encode_all(texts)
            yield record_batch(schema, ids, [np.frombuffer(b, dtype="<i4") for b, _ in found],
                               [t for _, t in found])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>, decoded string")


__all__ = ["Bpe", "bpe_digest", "bpe_encode", "load"]
