"""Benchmark decontamination by pigeonhole edit matching.

Texts are compared in lower case with everything but letters and digits as single
spaces.  An item of m characters may occur with up to k = floor(m * error_rate)
edits.  It is split into k + 1 pieces; k edits leave at least one piece whole, so
an exact hit of a piece (one Aho-Corasick pass over the document) finds every
occurrence.  Around each hit the item is verified with Myers' bit-parallel
distance, the bits of one Python integer standing for the item's characters.

The items are read in blocks of at most ``block_bytes`` of text; each block is
broadcast and held against all documents, so the size broadcast has a bound that
doesn't depend on the benchmark or the corpus; documents are read once for each block.

Defined cases: a null or empty text matches nothing; an empty item matches
nothing; an item of fewer than ``min_chars`` compared characters is found
without edits, from word boundary to word boundary, if it has ``min_words`` words, else
it must equal the whole document (a short answer occurs everywhere); a null item id is
reported as null; repeated documents or items
are matched one by one; empty tables give an empty result or all documents; other
columns are ignored or passed through.
"""

from __future__ import annotations

import re
import uuid
from collections import defaultdict
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import id_and_text, record_batch, slices

ERROR_RATE = 0.08
MIN_CHARS = 30
MIN_WORDS = 4
BLOCK_BYTES = 8_000_000

_GAPS = re.compile(r"[\W_]+")
_MATCHERS: dict[str, Matcher] = {}


def compared(text: str | None) -> str:
    """The form in which items and documents are compared."""
    return _GAPS.sub(" ", (text or "").lower()).strip()


def pieces(length: int, budget: int) -> list[tuple[int, int]]:
    """(start, end) of budget + 1 pieces of nearly equal length."""
    ends = [length * i // (budget + 1) for i in range(budget + 2)]
    return list(zip(ends, ends[1:]))


def myers_best(masks: dict[str, int], length: int, window: str) -> tuple[int, int]:
    """Least edit distance of the pattern to any part of the window, and the end
    of the first part that has it.  ``masks``: the pattern's positions by character."""
    full, top = (1 << length) - 1, 1 << (length - 1)
    plus, minus, score = full, 0, length
    best, end = length, 0
    get = masks.get
    for at, char in enumerate(window, 1):
        eq = get(char, 0)
        down = eq | minus
        across = (((eq & plus) + plus) ^ plus) | eq
        up = minus | (full & ~(across | plus))
        low = plus & across
        if up & top:
            score += 1
        elif low & top:
            score -= 1
            if score < best:
                best, end = score, at
        up = (up << 1) & full
        plus = ((low << 1) & full) | (full & ~(down | up))
        minus = up & down
    return best, end


class Matcher:
    """The items of one block and the automaton of their pieces."""

    def __init__(self, items: list[tuple[int | None, str]], error_rate: float, min_chars: int, min_words: int = MIN_WORDS):
        self.items, self.whole = [], defaultdict(list)
        places = defaultdict(list)
        for item_id, text in items:
            if len(text) < min_chars:
                if text.count(" ") + 1 >= min_words:  # budget -1: as it is, between boundaries
                    places[text].append((len(self.items), len(text)))
                    self.items.append((item_id, text, -1, {}))
                elif text:
                    self.whole[text].append(item_id)
                continue
            budget = int(len(text) * error_rate)
            masks: dict[str, int] = defaultdict(int)
            for i, c in enumerate(text):
                masks[c] |= 1 << i
            for a, b in pieces(len(text), budget):
                places[text[a:b]].append((len(self.items), b))
            self.items.append((item_id, text, budget, dict(masks)))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, where)
        if places:
            self.automaton.make_automaton()

    def matches(self, text: str | None) -> list[tuple[int, int, int]]:
        """(item id, distance, end in the compared text) of each item found."""
        text = compared(text)
        found = [(item_id, 0, len(text)) for item_id in self.whole.get(text, ())]
        starts = defaultdict(set)
        if self.items and text:
            for end, where in self.automaton.iter(text):
                for item, offset in where:
                    starts[item].add(end + 1 - offset)
        for item, at in sorted(starts.items()):
            item_id, pattern, budget, masks = self.items[item]
            if budget < 0:
                ends = [s + len(pattern) for s in sorted(at) if self._apart(text, s, s + len(pattern))]
                found += [(item_id, 0, ends[0])] if ends else []
                continue
            best = (budget + 1, 0)
            for low, high in self._windows(sorted(at), len(pattern), budget):
                low = max(low, 0)
                exact = text.find(pattern, low, high)
                if exact >= 0:
                    best = (0, exact + len(pattern))
                    break
                distance, end = myers_best(masks, len(pattern), text[low:high])
                best = min(best, (distance, low + end))
            if best[0] <= budget:
                found.append((item_id, *best))
        return found

    @staticmethod
    def _apart(text: str, start: int, end: int) -> bool:
        return (not start or text[start - 1] == " ") and (end == len(text) or text[end] == " ")

    @staticmethod
    def _windows(starts: list[int], length: int, budget: int) -> list[tuple[int, int]]:
        """Parts of the text that hold any occurrence at these starts; starts that
        lie close together share one."""
        out: list[list[int]] = []
        for s in starts:
            low, high = s - budget, s + length + budget
            if out and low <= out[-1][0] + 2 * budget + 64:
                out[-1][1] = high
            else:
                out.append([low, high])
        return [(a, b) for a, b in out]


def _matcher(block: Broadcast, name: str, error_rate: float, min_chars: int, min_words: int) -> Matcher:
    """One automaton for each worker process and block."""
    if name not in _MATCHERS:
        _MATCHERS.clear()
        _MATCHERS[name] = Matcher(block.value, error_rate, min_chars, min_words)
    return _MATCHERS[name]


def item_blocks(items: DataFrame, block_bytes: int, id_col: str, text_col: str):
    """The items (id, compared text) in blocks of about ``block_bytes`` each."""
    rows = items.select(items[id_col].cast("long").alias("item_id"),
                        F.coalesce(items[text_col].cast("string"), F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    for k in range(n):
        found = [(r["item_id"], compared(r["text"])) for r in rows.filter(block == k).collect()]
        yield sorted(found, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def benchmark_matches(docs: DataFrame, items: DataFrame, error_rate: float = ERROR_RATE,
                      min_chars: int = MIN_CHARS, block_bytes: int = BLOCK_BYTES, min_words: int = MIN_WORDS,
                      id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
                      item_text_col: str = "text") -> DataFrame:
    """``doc_id, item_id, distance, end_char`` of each item found in a document;
    ``end_char`` counts the characters of the compared text."""
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()),
                        ("distance", pa.int32()), ("end_char", pa.int32())])
    texts = id_and_text(docs, id_col, text_col)
    sc = docs.sparkSession.sparkContext
    parts = []
    for block in item_blocks(items, block_bytes, item_id_col, item_text_col):
        sent = sc.broadcast(block)

        def run(batches, sent=sent, name=uuid.uuid4().hex):
            matcher = _matcher(sent, name, error_rate, min_chars, min_words)
            for ids, found in slices(batches):
                rows = [(i, *m) for i, t in zip(ids, found, strict=True) for m in matcher.matches(t)]
                yield record_batch(schema, *(zip(*rows, strict=True) if rows else ([], [], [], [])))

        parts.append(texts.mapInArrow(run, "doc_id long, item_id long, distance int, end_char int"))
    return reduce(DataFrame.union, parts)


def without_benchmark(docs: DataFrame, items: DataFrame, error_rate: float = ERROR_RATE,
                      min_chars: int = MIN_CHARS, block_bytes: int = BLOCK_BYTES, min_words: int = MIN_WORDS,
                      text_col: str = "text", item_id_col: str = "item_id",
                      item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no item is found, with all their columns."""
    sc = docs.sparkSession.sparkContext
    at = docs.columns.index(text_col)
    for block in item_blocks(items, block_bytes, item_id_col, item_text_col):
        sent = sc.broadcast(block)

        def run(batches, sent=sent, name=uuid.uuid4().hex):
            matcher = _matcher(sent, name, error_rate, min_chars, min_words)
            for batch in batches:
                clean = [not matcher.matches(t.as_py()) for t in batch.column(at)]
                yield batch.filter(pa.array(clean, type=pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


__all__ = ["Matcher", "benchmark_matches", "compared", "myers_best", "without_benchmark"]
