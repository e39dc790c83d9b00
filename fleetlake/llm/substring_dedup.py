"""Substring dedup by level-wise doubling over windows of words.

A window of words repeats if another document holds the same words.  A window
can only repeat if the windows inside it do, so levels double: windows of half the
length are looked at first, and only what repeats there is extended to the next
length, until the length asked for is reached or no candidate survives.  On the
first level not every window is looked at: of the short windows inside each long
one the smallest hash alone is taken, which equal long windows choose alike, so no
repeat is lost; on later levels both halves of a window must repeat.

Rows are dealt into groups of about ``GROUP_BYTES`` by a hash of id and text.  A
level works in two shuffles of packed arrays: groups send the distinct hashes of
their candidates to hash buckets, buckets send back to each group which of them
other groups hold as well (last level: which of them an earlier document holds).
A window that a third of all documents share is thus sent once for each group and
not for each document; what repeats inside a group the group sees by itself.

Shorter windows are compared by 64-bit hashes of their words: one that agrees by chance
is a needless candidate and changes no result.  Windows of the length asked for, which
decide, are compared by 96 bits, two independent hashes: among n different ones about
n * n / 2^97 pairs agree by chance, at 100 TB (some 1.5 * 10^13 windows) 0.0014 in all.
A group is told its windows by the first hash alone; it holds some 3 * 10^5 of them, so
that at 100 TB about 0.1 pairs in all could be taken for each other there.

Rows that agree in id and text are reduced to one before the levels and multiplied at the
end, so no group grows with the copies of a row; where no row repeats, which the job that
measures the text also finds, there is nothing to reduce.

Defined cases: a null or empty text has no words; rows with equal ids are one
document (no row removes words of another one) and each keeps its own words; null
ids, and the largest possible one, are one document that sorts last; a text of fewer words than a window loses
nothing; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import forget, id_and_text, mix64, slices, stored
from fleetlake.llm.words import Words, window_hashes

#: text of a group of documents that one call handles
GROUP_BYTES = 2_000_000
#: text whose candidates a bucket holds, about
BUCKET_BYTES = 16_000_000
#: windows of the first level have at most so many words
FIRST_LENGTH = 7
#: candidates that a task gathers before it sends them off
_GATHER = 1_000_000
_LAST = 2**63 - 1

#: equal rows that one task writes at the end, about
_COPIES = 4096

_SENT = pa.schema([("bucket", pa.int32()), ("g", pa.binary()), ("h", pa.binary()), ("c", pa.binary()),
                   ("lo", pa.binary())])
_SENT_SQL = "bucket int, g binary, h binary, c binary, lo binary"
_BACK = pa.schema([("g", pa.int32()), ("h", pa.binary())])
_BACK_SQL = "g int, h binary"
_OTHER = np.uint64(0xA0761D6478BD642F)


def _packed(x: np.ndarray) -> bytes:
    """The bytes of all numbers by significance: sorted or small ones then compress well."""
    return x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes()


def _cat(column: pa.ChunkedArray, dtype) -> np.ndarray:
    """The numbers of all rows of a packed column."""
    width = np.dtype(dtype).itemsize
    planes = [np.frombuffer(b, dtype=np.uint8).reshape(width, -1) for b in column.to_pylist()]
    if not planes:
        return np.zeros(0, dtype=dtype)
    return np.ascontiguousarray(np.concatenate(planes, axis=1).T).reshape(-1).view(dtype)


def first_in_groups(*keys: np.ndarray) -> np.ndarray:
    """Marks the first of each run of equal keys in sorted arrays."""
    new = np.ones(len(keys[0]), dtype=bool)
    if len(new) > 1:
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return new


def window_checks(words: Words, length: int) -> np.ndarray:
    """A second hash, of 32 bits, of the windows that ``window_hashes`` gives."""
    h, _ = window_hashes(mix64(words.hash ^ _OTHER), words.first, length)
    return (h >> np.uint64(32)).astype(np.uint32)


def _to_buckets(h: np.ndarray, g: np.ndarray, c: np.ndarray | None, lo: np.ndarray | None,
                buckets: int) -> pa.RecordBatch:
    """One row for each bucket with packed arrays; ``h`` is sorted."""
    bucket = ((h >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)
    at = np.nonzero(first_in_groups(bucket))[0] if len(h) else np.zeros(0, dtype=np.int64)
    ends = [*at[1:].tolist(), len(h)]
    cut = [(a, b) for a, b in zip(at.tolist(), ends)]
    return pa.RecordBatch.from_arrays([
        pa.array(bucket[at], type=pa.int32()),
        pa.array([_packed(g[a:b]) for a, b in cut], type=pa.binary()),
        pa.array([_packed(h[a:b]) for a, b in cut], type=pa.binary()),
        pa.array([b"" if c is None else c[a:b].tobytes() for a, b in cut], type=pa.binary()),
        pa.array([b"" if lo is None else _packed(lo[a:b]) for a, b in cut], type=pa.binary()),
    ], schema=_SENT)


def _to_groups(h: np.ndarray, g: np.ndarray) -> pa.Table:
    """One row for each group with its hashes packed."""
    order = np.argsort(g, kind="stable")
    h, g = h[order], g[order]
    at = np.nonzero(first_in_groups(g))[0] if len(g) else np.zeros(0, dtype=np.int64)
    cut = list(zip(at.tolist(), [*at[1:].tolist(), len(g)]))
    return pa.table([pa.array(g[at], type=pa.int32()),
                     pa.array([_packed(h[a:b]) for a, b in cut], type=pa.binary())], schema=_BACK)


def chosen_seeds(words: Words, seed: int, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the short windows, the index of the one chosen for each window of
    ``length`` words, and which of those lie within one text."""
    short, _ = window_hashes(words.hash, words.first, seed)
    _, whole = window_hashes(words.hash, words.first, length)
    n = len(whole)
    if not n:
        return short, np.zeros(0, dtype=np.int64), whole
    inside = np.lib.stride_tricks.sliding_window_view(short, length - seed + 1)[:n]
    return short, inside.argmin(axis=1) + np.arange(n), whole


def _owners(words: Words) -> np.ndarray:
    return np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))


def _shared(h: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Hashes (sorted, distinct) that several documents hold."""
    order = np.lexsort((doc, h))
    h, doc = h[order], doc[order]
    at = np.nonzero(first_in_groups(h))[0] if len(h) else np.zeros(0, dtype=np.int64)
    last = np.concatenate([at[1:], [len(h)]]).astype(np.int64) - 1 if len(at) else at
    return h[at][doc[at] != doc[last]]


def _member(x: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which of ``x`` are in the sorted array ``known``."""
    if not len(known):
        return np.zeros(len(x), dtype=bool)
    return known[np.minimum(np.searchsorted(known, x), len(known) - 1)] == x


def smallest_holder(h: np.ndarray, c: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order of the windows by hashes and holder, the first place of each window in
    it, and for each place the smallest holder of its window."""
    order = np.lexsort((doc, c, h))
    at = np.nonzero(first_in_groups(h[order], c[order]))[0] if len(h) else np.zeros(0, dtype=np.int64)
    return order, at, np.repeat(doc[order][at], np.diff(np.concatenate([at, [len(h)]])))


def seed_level(docs: DataFrame, seed: int, length: int, buckets: int) -> DataFrame:
    """``g, h``: chosen short windows of each group that other groups hold too."""

    def send(batches):
        hashes, groups, size = [], [], 0

        def packed():
            h, g = np.concatenate(hashes), np.concatenate(groups)
            order = np.lexsort((g, h))
            h, g = h[order], g[order]
            new = first_in_groups(h, g)
            return _to_buckets(h[new], g[new], None, None, buckets)

        for group, texts in slices(batches, ("g", "text")):
            words = Words(texts)
            short, at, whole = chosen_seeds(words, seed, length)
            at = np.unique(at[whole])
            if len(at):
                hashes.append(short[at])
                groups.append(np.array(group, dtype=np.int32)[_owners(words)[at]])
                size += len(at)
            if size > _GATHER:
                yield packed()
                hashes, groups, size = [], [], 0
        if size:
            yield packed()

    def back(table: pa.Table) -> pa.Table:
        h, g = _cat(table["h"], np.uint64), _cat(table["g"], np.int32)
        order = np.lexsort((g, h))
        h, g = h[order], g[order]
        at = np.nonzero(first_in_groups(h))[0]
        last = np.concatenate([at[1:], [len(h)]]).astype(np.int64) - 1
        keep = np.repeat(g[at] != g[last], np.diff(np.concatenate([at, [len(h)]])))
        keep &= first_in_groups(h, g)
        return _to_groups(h[keep], g[keep])

    return (docs.select("g", "text").mapInArrow(send, _SENT_SQL)
            .groupBy("bucket").applyInArrow(back, _BACK_SQL))


def lengths(window: int) -> list[int]:
    """Window lengths of the levels: each at most twice the one before, up to ``window``."""
    out = [window]
    while out[0] > FIRST_LENGTH:
        out.insert(0, (out[0] + 1) // 2)
    return out


def _candidates(words: Words, ids: np.ndarray, known: np.ndarray, shorter: int | None, length: int,
                first: bool) -> np.ndarray:
    """Starts of the windows of ``length`` words whose shorter windows all repeat, as far
    as the level before looked at them; ``known`` has the hashes that repeat elsewhere."""
    _, whole = window_hashes(words.hash, words.first, length)
    if shorter is None or not len(whole):
        return np.nonzero(whole)[0]
    if first:  # of the short windows in each long one, the chosen one was looked at
        short, at, _ = chosen_seeds(words, shorter, length)
        mine = np.unique(at[whole])
        here = _shared(short[mine], ids[_owners(words)[mine]])
        return np.nonzero(whole & _member(short[at], np.sort(np.concatenate([known, here]))))[0]
    short, _ = window_hashes(words.hash, words.first, shorter)
    repeats = _member(short, known)
    return np.nonzero(whole & repeats[:len(whole)] & repeats[length - shorter:][:len(whole)])[0]


def window_level(docs: DataFrame, found: DataFrame, shorter: int | None, length: int, buckets: int,
                 first: bool, last: bool) -> DataFrame:
    """``g, h``: windows of each group that repeat.  On the last level only those that a
    document of another group, smaller than all of this group's holders, holds too."""

    def send(key, left: pa.Table, right: pa.Table) -> pa.Table:
        words = Words(left["text"].to_pylist())
        ids = np.array(left["doc_id"].to_pylist(), dtype=np.int64)
        start = _candidates(words, ids, np.sort(_cat(right["h"], np.uint64)), shorter, length, first)
        h, _ = window_hashes(words.hash, words.first, length)
        h, doc = h[start], ids[_owners(words)[start]]
        if last:
            c = window_checks(words, length)[start]
            order, at, lo = smallest_holder(h, c, doc)
            h, c, lo = h[order[at]], c[order[at]], lo[at]
        else:  # whether there are several holders
            order = np.lexsort((doc, h))
            h, doc, c = h[order], doc[order], None
            at = np.nonzero(first_in_groups(h))[0] if len(h) else np.zeros(0, dtype=np.int64)
            end = np.concatenate([at[1:], [len(h)]]).astype(np.int64) - 1 if len(at) else at
            h, lo = h[at], (doc[at] != doc[end]).astype(np.int64)
        g = np.full(len(h), key[0].as_py(), dtype=np.int32)
        return pa.Table.from_batches([_to_buckets(h, g, c, lo, buckets)], schema=_SENT)

    def back(table: pa.Table) -> pa.Table:
        h, g, lo = _cat(table["h"], np.uint64), _cat(table["g"], np.int32), _cat(table["lo"], np.int64)
        if last:  # rows of one id may lie in several groups
            c = np.frombuffer(b"".join(table["c"].to_pylist()), dtype=np.uint32)
            order, _, smallest = smallest_holder(h, c, lo)
            later = order[lo[order] > smallest]
            return _to_groups(h[later], g[later])
        order = np.lexsort((lo, h))
        h, g, lo = h[order], g[order], lo[order]
        at = np.nonzero(first_in_groups(h))[0]
        size = np.diff(np.concatenate([at, [len(h)]]))
        keep = np.repeat((size > 1) | (np.maximum.reduceat(lo, at) > 0), size)
        return _to_groups(h[keep], g[keep])

    return (docs.groupBy("g").cogroup(found.groupBy("g")).applyInArrow(send, _SENT_SQL)
            .groupBy("bucket").applyInArrow(back, _BACK_SQL))


def covered(words: Words, ids: np.ndarray, elsewhere: np.ndarray, length: int) -> np.ndarray:
    """Marks the words that a removed window covers: one that an earlier document
    holds, in another group (``elsewhere``, sorted) or in this one."""
    h, whole = window_hashes(words.hash, words.first, length)
    hit = np.zeros(len(words.hash) + 1, dtype=np.int32)
    start = np.nonzero(whole)[0]
    if len(start):
        h, doc = h[start], ids[_owners(words)[start]]
        c = window_checks(words, length)[start]
        order, _, smallest = smallest_holder(h, c, doc)
        gone = np.empty(len(h), dtype=bool)
        gone[order] = doc[order] > smallest
        gone |= _member(h, elsewhere)
        np.add.at(hit, start[gone], 1)
        np.add.at(hit, start[gone] + length, -1)
    return np.cumsum(hit[:-1]) > 0


def remove_repeats(docs: DataFrame, window: int = 13, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text``: every text without the words
    covered by a window of ``window`` words that a smaller id holds as well; kept
    words are joined by one space."""
    rows = id_and_text(docs, id_col, text_col).select(
        F.coalesce("doc_id", F.lit(_LAST)).alias("doc_id"), "text", F.col("doc_id").alias("own_id"))
    alike = rows.groupBy(F.xxhash64("own_id", F.col("own_id").isNull(), "text").alias("row")).agg(
        F.sum(F.octet_length("text") + 1).alias("size"), F.count("*").alias("n"))
    found = alike.agg(F.sum("size").alias("total"), F.max("n").alias("most")).first()
    total, repeated = found["total"] or 0, (found["most"] or 0) > 1
    if repeated:
        rows = stored(rows.groupBy("doc_id", "own_id", "text").agg(F.count("*").alias("n")), "rows", total)
    else:
        rows = rows.withColumn("n", F.lit(1).cast("long"))
    groups = max(1, -(-total // GROUP_BYTES))
    at_once = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(4 * at_once, -(-total // BUCKET_BYTES))
    rows = rows.withColumn("g", F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)).cast("int"))
    levels = lengths(window)
    nothing = docs.sparkSession.createDataFrame([], _BACK_SQL)

    found, shorter = nothing, None
    if len(levels) > 1:
        shorter = levels[0]
        found = stored(seed_level(rows, shorter, levels[1], buckets), "seeds", total)
    for k, length in enumerate(levels[1:] or levels):
        last = length == window
        longer = stored(window_level(rows, found, shorter, length, buckets, k == 0, last), "windows", total)
        if found is not nothing:
            forget(found)
        found, shorter = longer, length
        if not last and found.isEmpty():
            break  # no candidate survives; what ``found`` is then, is empty as it should be
    earlier = found

    out = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                     ("kept_text", pa.string()), ("n", pa.int64())])

    def keep(left: pa.Table, right: pa.Table) -> pa.Table:
        texts, found = left["text"].to_pylist(), left["doc_id"].to_pylist()
        words = Words(texts)
        gone = covered(words, np.array(found, dtype=np.int64), np.sort(_cat(right["h"], np.uint64)), window)
        first = words.first.tolist()
        lost = np.concatenate([[0], np.cumsum(gone)])
        n_removed = (lost[words.first[1:]] - lost[words.first[:-1]]).tolist()
        kept = []
        for i, text in enumerate(texts):
            own = text.encode("utf-8", "surrogatepass").split()
            if n_removed[i]:
                own = compress(own, (~gone[first[i]:first[i + 1]]).tolist())
            kept.append(b" ".join(own).decode("utf-8", "surrogatepass"))
        return pa.table([left["own_id"].combine_chunks(),
                         pa.array(np.diff(words.first), type=pa.int64()),
                         pa.array(n_removed, type=pa.int64()), pa.array(kept, type=pa.string()),
                         left["n"].combine_chunks()], schema=out)

    done = (rows.groupBy("g").cogroup(earlier.groupBy("g"))
            .applyInArrow(keep, "doc_id long, n_words long, n_removed long, kept_text string, n long"))
    return _multiplied(done) if repeated else done.drop("n")


def _multiplied(rows: DataFrame) -> DataFrame:
    """Every row ``n`` times; the copies of a row are dealt to tasks in parts."""
    parts = rows.withColumn("part", F.explode(F.expr(f"sequence(0L, (n - 1) div {_COPIES})")))
    parts = parts.repartition(F.xxhash64("doc_id", "kept_text"), "part")
    copies = F.least(F.lit(_COPIES), F.col("n") - F.col("part") * _COPIES)
    return parts.withColumn("copy", F.explode(F.sequence(F.lit(1), copies.cast("int")))).drop("n", "part", "copy")


__all__ = ["remove_repeats"]
