"""Context-triggered piecewise hashing (CTPH) of whole texts.

A rolling hash of the last seven bytes decides where pieces end: where it is
-1 modulo the block size.  Every piece becomes one of 64 characters.  A
fingerprint is ``block:signature:signature of twice the block``; the block size
is the smallest 3 * 2^k that gives at most ``MOST_PIECES`` pieces, so no piece is
cut off or merged.  Because block sizes double, the ends for a block are among the
ends for half of it, and all sizes come from one pass.

Fingerprints are compared where block sizes are equal or twice each other:
1 - edit distance / longer length, with Myers' bit-parallel distance run on many
pairs at once.  The best compatible signature pair counts, weighed down where a
signature is too short to tell.

The next document is found without a global sort of the table on one task: the order
is cut at quantiles of a bounded sample, each range sees its own rows in order plus the
first row of the following range.  Rows that agree in id and text are reduced to one with
their number first: the last copy is followed by the next row, all others by a copy, so
two rows stand for them, and the results are multiplied at the end.

Defined cases: a null text is the empty text (fingerprint ``3::``, alike to an
empty text only); equal ids are ordered by a hash of their text; null ids come first; the last
row's next is the first row, a single row's next is itself; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import id_and_text, mix64, record_batch, slices, stored
from fleetlake.llm.copies import measured, multiplied, reduced

WINDOW = 7
#: rows of the sample that bounds a range, about
SAMPLED = 64
#: a signature fits one 64-bit word of the distance
MOST_PIECES = 64
_SMALLEST = 3
_BASE = np.uint64(0x9E3779B97F4A7C15)
_LETTERS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", dtype=np.uint8)


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


class _Powers:
    """Powers of the piece hash's base and of its inverse, as far as needed."""

    up = np.ones(1, dtype=np.uint64)
    down = np.ones(1, dtype=np.uint64)

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, 2 * len(cls.up), 4096)
            cls.up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, _BASE)]).astype(np.uint64))
            inverse = np.uint64(_inverse(int(_BASE)))
            cls.down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, inverse)]).astype(np.uint64))
        return cls.up, cls.down


def rolling(data: np.ndarray) -> np.ndarray:
    """Hash of the last seven bytes at every position, well mixed, 32 bits."""
    h = np.zeros(len(data), dtype=np.uint32)
    wide = data.astype(np.uint32)
    factor = 1
    for back in range(min(WINDOW, len(data))):
        h[back:] += (wide[:len(data) - back] + np.uint32(1)) * np.uint32(factor)
        factor = factor * 0x01000193 & 0xFFFFFFFF
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    return h ^ (h >> np.uint32(13))


def _signature(sums: np.ndarray, ends: np.ndarray, n: int) -> bytes:
    """A character for each piece; pieces end at ``ends`` and at the text's end."""
    cut = np.concatenate([[0], ends + 1, [n]] if not len(ends) or ends[-1] + 1 < n else [[0], ends + 1])
    cut = cut.astype(np.int64)
    _, down = _Powers.get(n + 1)
    piece = (sums[cut[1:]] - sums[cut[:-1]]) * down[cut[:-1]] + np.diff(cut).astype(np.uint64)
    return _LETTERS[(mix64(piece) >> np.uint64(58)).astype(np.int64)].tobytes()


def fingerprint(data: bytes) -> str:
    """``block:signature:signature of twice the block`` of the bytes."""
    n = len(data)
    if not n:
        return f"{_SMALLEST}::"
    raw = np.frombuffer(data, dtype=np.uint8)
    trigger = rolling(raw) + np.uint32(1)
    ends = np.nonzero(trigger % np.uint32(_SMALLEST) == 0)[0]
    hit = trigger[ends].astype(np.int64)
    # the largest k with trigger divisible by 3 * 2^k; a zero is divisible by all
    level = np.where(hit == 0, 32, np.log2(np.maximum(hit & -hit, 1)).astype(np.int64))
    counts = np.cumsum(np.bincount(np.minimum(level, 40), minlength=41)[::-1])[::-1]
    k = int(np.argmax(counts < MOST_PIECES))
    up, _ = _Powers.get(n + 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:n])])
    first = _signature(sums, ends[level >= k], n)
    second = _signature(sums, ends[level >= k + 1], n)
    return f"{_SMALLEST << k}:{first.decode()}:{second.decode()}"


def distances(left: list[str], right: list[str]) -> np.ndarray:
    """Edit distances of pairs of strings of at most 64 characters each, all pairs
    stepping together through Myers' bit-parallel recurrence."""
    n = len(left)
    if not n:
        return np.zeros(0, dtype=np.int64)
    a, b = np.zeros((n, 64), dtype=np.uint8), np.zeros((n, 64), dtype=np.uint8)
    m, length = np.array([len(s) for s in left]), np.array([len(s) for s in right])
    for rows, strings in ((a, left), (b, right)):
        for i, s in enumerate(strings):
            rows[i, :len(s)] = np.frombuffer(s.encode("ascii"), dtype=np.uint8)
    masks = np.zeros((n, 128), dtype=np.uint64)
    each = np.arange(n)
    for j in range(int(m.max(initial=0))):
        on = j < m
        masks[each[on], a[on, j]] |= np.uint64(1 << j)
    one, all_ones = np.uint64(1), np.uint64(2**64 - 1)
    top = one << np.maximum(m - 1, 0).astype(np.uint64)
    plus, minus, score = np.full(n, all_ones), np.zeros(n, dtype=np.uint64), m.astype(np.int64)
    for j in range(int(length.max(initial=0))):
        eq = masks[each, b[:, j]]
        down = eq | minus
        across = (((eq & plus) + plus) ^ plus) | eq
        up = minus | ~(across | plus)
        low = plus & across
        on = j < length
        score += on * ((up & top) != 0)
        score -= on * ((low & top) != 0)
        up = (up << one) | one
        plus, minus = (low << one) | ~(down | up), up & down
    return np.where(m == 0, length, score)


def likeness(left: list[str], right: list[str]) -> np.ndarray:
    """Likeness (0 to 1) of pairs of fingerprints."""
    out = np.array([1.0 if x == y else 0.0 for x, y in zip(left, right, strict=True)])
    row, one, two = [], [], []
    for i, (x, y) in enumerate(zip(left, right, strict=True)):
        if x == y:
            continue
        (bx, x1, x2), (by, y1, y2) = x.split(":"), y.split(":")
        bx, by = int(bx), int(by)
        pairs = [(x1, y1), (x2, y2)] if bx == by else [(x1, y2)] if bx == 2 * by else [(x2, y1)] if by == 2 * bx else []
        for p, q in pairs:
            if p and q:
                row.append(i)
                one.append(p)
                two.append(q)
    if row:
        longest = np.array([max(len(p), len(q)) for p, q in zip(one, two, strict=True)])
        short = np.array([min(len(p), len(q)) for p, q in zip(one, two, strict=True)])
        alike = 1.0 - distances(one, two) / longest
        alike *= np.minimum(1.0, short / 4.0)  # a signature of a few pieces tells little
        np.maximum.at(out, row, np.clip(alike, 0.0, 1.0))
    return out


def order_key(ids, hashes) -> np.ndarray:
    """Ids (null first) and hashes as byte strings of the same order."""
    held = np.array([i is not None for i in ids]) if not isinstance(ids, np.ndarray) else np.ones(len(ids), bool)
    low = np.uint64(1 << 63)
    out = np.zeros((len(held), 17), dtype=np.uint8)
    out[:, 0] = held + 1
    for at, column in ((1, np.array([i or 0 for i in ids], dtype=np.int64) if not isinstance(ids, np.ndarray) else ids), (9, hashes)):
        big = (np.asarray(column, dtype=np.int64).view(np.uint64) ^ low).astype(">u8")
        out[:, at:at + 8] = np.ascontiguousarray(big).view(np.uint8).reshape(-1, 8)
    return out.view("S17")[:, 0]


def with_next(docs: DataFrame, ranges: int) -> DataFrame:
    """Rows ``part, last`` and those of ``docs`` (doc_id, text, others) with ``h`` to be
    read in the order of part, last, id and ``h``: the part's rows by id, at its end
    (``last`` > 0) the first row of what follows."""
    rows = docs.select("*", F.xxhash64("text").alias("h"))
    # bounds are places in the whole order, so rows of one id, or without one, are split
    # as others are; they come from a sample of at most about SAMPLED rows a range
    keys = rows.select("doc_id", "h")
    n = rows.select("doc_id").count()
    some = F.pmod(F.xxhash64("doc_id", "h", F.lit(1)), F.lit(max(1, n // (SAMPLED * ranges)))) == 0
    sample = np.sort(order_key(*zip(*[(r["doc_id"], r["h"]) for r in keys.filter(some).collect()] or [(None, 0)])))
    marks = np.unique(sample[[len(sample) * i // ranges for i in range(1, ranges)]])

    @F.pandas_udf("int")
    def part(ids: pd.Series, hashes: pd.Series) -> pd.Series:
        known = [None if pd.isna(i) else int(i) for i in ids] if ids.hasnans else ids.to_numpy()
        return pd.Series(np.searchsorted(marks, order_key(known, hashes.to_numpy()), side="right").astype(np.int32))

    rows = rows.withColumn("part", part("doc_id", "h"))
    # the first row of each part: a map-side combined minimum of id and hash
    rank = F.struct(F.col("doc_id").isNotNull().alias("has_id"), "doc_id", "h")
    firsts = [r for r in rows.groupBy("part").agg(F.min(rank).alias("r")).select("part", "r.*").collect()]
    firsts.sort(key=lambda r: r["part"])
    heads = []
    for k, r in enumerate(firsts):  # the part before this one, the last part for the first
        heads.append((firsts[k - 1]["part"], r["doc_id"], r["h"]))
    if not heads:
        return rows.select("part", F.lit(0).alias("last"), *docs.columns, "h")
    spark = docs.sparkSession
    head = spark.createDataFrame(heads, "to int, head_id long, head_h long")
    extra = (rows.join(F.broadcast(head), F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("h") == F.col("head_h")))
             .groupBy("to").agg(*[F.first(c).alias(c) for c in docs.columns])
             .select(F.col("to").alias("part"), F.lit(1).alias("last"), *docs.columns, F.lit(0).cast("long").alias("h")))
    return rows.select("part", F.lit(0).alias("last"), *docs.columns, "h").unionByName(extra)


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first ones of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def piecewise_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_chars, fingerprint, edited_sha256, edited_fingerprint,
    near_edited, near_next`` of every row and the row that follows it by id."""
    spark = docs.sparkSession
    ranges = min(10_000, max(2, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    rows = id_and_text(docs, id_col, text_col)
    total, repeated = measured(rows)
    if repeated:
        rows = stored(reduced(rows), "rows", total)
        rows = rows.withColumn("n", F.explode(F.expr("if(n > 1, array(n - 1, 1L), array(n))")))
    else:
        rows = rows.withColumn("n", F.lit(1).cast("long"))
    rows = (with_next(rows, ranges)
            .repartitionByRange(ranges, "part").sortWithinPartitions("part", "last", "doc_id", "h"))
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                        ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                        ("near_edited", pa.float64()), ("near_next", pa.float64()), ("n", pa.int64())])

    def digest(ids: list, ns: list, texts: list, prints: list) -> pa.RecordBatch:
        """Rows of all but the last text, each with the one after it."""
        changed = [edited(a, b).encode("utf-8", "surrogatepass") for a, b in zip(texts, texts[1:])]
        own, after = prints[:-1], [fingerprint(c) for c in changed]
        return record_batch(schema, ids[:-1], [len(t) for t in texts[:-1]],
                            [hashlib.sha256(c).hexdigest() for c in changed], own, after,
                            likeness(own, after), likeness(own, prints[1:]), ns[:-1])

    def run(batches):
        held = None  # the last row seen: part, id, number, text, fingerprint
        for parts, lasts, ids, ns, texts in slices(batches, ("part", "last", "doc_id", "n", "text")):
            prints = [fingerprint(t.encode("utf-8", "surrogatepass")) for t in texts]
            if held is not None:
                parts, lasts = [held[0], *parts], [0, *lasts]
                ids, ns = [held[1], *ids], [held[2], *ns]
                texts, prints = [held[3], *texts], [held[4], *prints]
            held, at = None, 0
            for i, last in enumerate(lasts):
                if last:
                    yield digest(ids[at:i + 1], ns[at:i + 1], texts[at:i + 1], prints[at:i + 1])
                    at = i + 1
            if at < len(ids):
                if len(ids) - at > 1:
                    yield digest(ids[at:], ns[at:], texts[at:], prints[at:])
                held = (parts[-1], ids[-1], ns[-1], texts[-1], prints[-1])

    done = rows.select("part", "last", "doc_id", "n", "text").mapInArrow(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
             "edited_fingerprint string, near_edited double, near_next double, n long")
    return multiplied(done, "doc_id", "edited_sha256") if repeated else done.drop("n")


__all__ = ["distances", "edited", "fingerprint", "likeness", "piecewise_fingerprints"]
