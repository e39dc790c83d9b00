"""Interpolated modified Kneser-Ney n-gram model, counted in Spark (``order`` words, 2 by default).

Counting works on packed arrays.  Tasks gather the distinct n-grams of many documents
and send them, with counts, to buckets of their context (the words before the last);
n-grams of very frequent contexts are dealt by the n-gram instead, so no bucket holds
all followers of one context.  A bucket sums its n-grams and writes them as a sorted
hash array.  Its distinct n-grams, shortened by their first word, are the rows of the
next lower order, whose counts are numbers of distinct words before; so it goes down to
pairs.  What a bucket knows of words and contexts (tokens, distinct left neighbours; a
context's total and its n-grams seen once, twice and more often) leaves it as plain
rows, which Spark sums by key with partial sums in every task, and which are written as
sorted arrays in buckets sized by the number of keys.  The arrays grow with the corpus
and never pass through the driver, which gets one row of totals (counts of counts).

The arrays are files in the shared folder of ``spark.checkpoint.dir``; scoring
tasks map them into memory, a bounded number at a time, and search them for the sorted
distinct n-grams of some documents.  Mapping needs that folder to be mounted at every
worker.

Probability of word w after context v, v' without its first word, for counts c of
the highest order and numbers of distinct left neighbours below it (V known words and
one unknown, N1+ distinct neighbours):

    P(w|v) = max(c(v w) - D(c), 0) / c(v)  +  (D1 n1 + D2 n2 + D3 n3) / c(v) * P(w|v')
    P(w)   = max(N1+(. w) - D(N1+), 0) / N1+(. .)  +  gamma / (V + 1)

with discounts from the counts of counts of each order.  Texts begin after begin
marks and close with an end token, which counts as a token.

Defined cases: a null or empty text is the end token alone; rows are counted and
scored one by one, so repeated rows count as often as they occur; a null id trains;
without training rows every token is unknown; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import mmap
import os
import uuid
from collections import OrderedDict
from functools import reduce
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.llm.common import forget, id_and_text, mix64, record_batch, slices, stored
from fleetlake.llm.words import Words
from fleetlake.session import scratch_path

#: text whose n-grams a bucket holds, about
BUCKET_BYTES = 16_000_000
#: n-grams gathered before they are sent off
_GATHER = 1_000_000
#: text scored at once
_ROUND_CHARS = 4_000_000
#: at most so many frequent contexts are dealt by n-gram; one document in 64 finds them
#: (which these are changes the balance only, not the counts)
HOT_WORDS = 20_000

_BEGIN, _END = np.uint64(0x5BD1E995A4093822), np.uint64(0x27D4EB2F165667C5)
_GRAM_SQL = "bucket int, first binary, runs binary, second binary, n binary, below binary"
_SUMS = [f"s{i}" for i in range(6)]
_FLAT = pa.schema([("kind", pa.int32()), ("key", pa.int64()), *[(c, pa.int64()) for c in _SUMS]])
_FLAT_SQL = "kind int, key long, " + ", ".join(f"{c} long" for c in _SUMS)
_MIXED = pa.schema([*_FLAT, ("bucket", pa.int32()), *[(c, pa.binary()) for c in ("first", "runs", "second", "n", "below")]])
#: kinds of flat rows: 1 words (tokens, left neighbours, then as context: total, pairs seen
#: 1, 2, 3+ times), k > 2 contexts of order k (the last four), -k the totals of order k
_WORD = 1
#: bytes of a table's bucket, about, and of one of its rows
TABLE_BYTES, _KEY_BYTES = 8 << 20, 40
#: files that a worker holds mapped
MAPS = 1_000


def grams(words: Words, order: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The tokens (words and ends) and, for 1 to order - 1 words before them, the hash of
    these words; begin marks stand before a text."""
    at = np.insert(words.hash, words.first[1:], _END)
    begin = words.first[:-1] + np.arange(len(words.first) - 1)
    since = np.arange(len(at)) - np.repeat(begin, np.diff(np.append(begin, len(at))))  # place within the text
    contexts: list[np.ndarray] = []
    for k in range(1, order):
        before = np.full(len(at), _BEGIN, dtype=np.uint64)
        reach = np.nonzero(since >= k)[0]
        before[reach] = at[reach - k]
        contexts.append(pair_hash(before, contexts[-1]) if contexts else before)
    return at, contexts


def pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix64(first * np.uint64(0x9FB21C651E98DF25) + mix64(second + np.uint64(0x165667B19E3779F9)))


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)


def pair_bucket(first: np.ndarray, second: np.ndarray, hot: np.ndarray, buckets: int) -> np.ndarray:
    """By the first word; by the pair for the frequent words in the sorted ``hot``."""
    out = _bucket(first, buckets)
    if len(hot):
        often = hot[np.minimum(np.searchsorted(hot, first), len(hot) - 1)] == first
        out[often] = _bucket(pair_hash(first[often], second[often]), buckets)
    return out


def _starts(*keys: np.ndarray) -> np.ndarray:
    if not len(keys[0]):
        return np.zeros(0, dtype=np.int64)
    new = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.concatenate([[0], np.nonzero(new)[0] + 1]).astype(np.int64)


def _lengths(starts: np.ndarray, n: int) -> np.ndarray:
    return np.diff(np.concatenate([starts, [n]])).astype(np.int64)


def _folder(uri: str) -> str:
    """Path of a shared folder that workers can map files from."""
    parsed = urlparse(uri)
    if parsed.scheme not in ("", "file"):
        raise ValueError(f"the model's arrays are memory-mapped: {uri} must be a mounted folder")
    return unquote(parsed.path)


def _write(path: str, *arrays: np.ndarray) -> None:
    """All or nothing: a task that runs twice writes the same file again."""
    part = f"{path}.{uuid.uuid4().hex}"
    with open(part, "wb") as f:
        for a in arrays:
            f.write(np.ascontiguousarray(a).tobytes())
    os.replace(part, path)


def _file(folder: str, kind: str, bucket: int) -> str:
    return f"{folder}/{kind}-{bucket % 64:02d}/{bucket}"


def frequent_contexts(texts: DataFrame, order: int, buckets: int) -> dict[int, np.ndarray]:
    """For each order, sorted hashes of contexts that make up a sixteenth of a bucket or
    more in one document of 64; at most ``HOT_WORDS``."""
    schema = pa.schema([("level", pa.int32()), ("context", pa.int64()), ("n", pa.int64())])

    def count(batches):
        for (found,) in slices(batches, ("text",)):
            for k, contexts in enumerate(grams(Words(found, lower=True), order)[1], 2):
                context, n = np.unique(contexts, return_counts=True)
                yield record_batch(schema, np.full(len(n), k, np.int32), context.view(np.int64), n.astype(np.int64))

    some = texts.filter(F.pmod(F.xxhash64("doc_id"), F.lit(64)) == 0).select("text")
    counts = some.mapInArrow(count, "level int, context long, n long").groupBy("level", "context").agg(F.sum("n").alias("n"))
    counts = stored(counts, "frequent", 0)
    total = (counts.agg(F.sum("n")).first()[0] or 0) // (order - 1)
    hot = {}
    for k in range(2, order + 1):
        top = (counts.filter((F.col("level") == k) & (F.col("n") * (16 * buckets) >= total))
               .orderBy(F.desc("n"), "context").limit(HOT_WORDS).collect())
        hot[k] = np.sort(np.array([r["context"] for r in top], dtype=np.int64).view(np.uint64))
    forget(counts)
    return hot


def _summed(order_keys: tuple, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of equal keys in sorted arrays, and sums of the values (by row)."""
    at = _starts(*order_keys)
    return at, np.add.reduceat(values, at, axis=0) if len(at) else values[:0]


def _packed(rows: tuple, level: int, hot: np.ndarray, buckets: int) -> list[list]:
    """Rows for the buckets: their distinct n-grams by context, with counts.

    ``rows`` are contexts, words, counts and, from 3 words on, an array with a row of
    shorter contexts for each n-gram."""
    a, b, n, below = rows
    bucket = pair_bucket(a, b, hot, buckets)
    order = np.lexsort((b, a, bucket))
    a, b, n, bucket, below = a[order], b[order], n[order], bucket[order], below[order]
    at, n = _summed((bucket, a, b), n)
    a, b, bucket, below = a[at], b[at], bucket[at], below[at]
    cut = _starts(bucket)
    out: list[list] = [[] for _ in range(6)]
    for s, e in zip(cut.tolist(), [*cut[1:].tolist(), len(a)]):
        run = _starts(a[s:e])
        for column, x in zip(out, (int(bucket[s]), a[s:e][run].tobytes(), _lengths(run, e - s).astype(np.uint32).tobytes(),
                                   b[s:e].tobytes(), n[s:e].astype(np.uint32).tobytes(), below[s:e][run].tobytes())):
            column.append(x)
    return out


def _unpacked(table: pa.Table, level: int) -> tuple:
    """The n-grams of a bucket in order, equal ones summed: contexts, words, counts and the
    shorter contexts of each."""
    join = lambda name, dtype: np.frombuffer(b"".join(table[name].to_pylist()), dtype=dtype)
    runs = join("runs", np.uint32)
    a = np.repeat(join("first", np.uint64), runs)
    below = np.repeat(join("below", np.uint64).reshape(len(runs), level - 2), runs, axis=0)
    b, n = join("second", np.uint64), join("n", np.uint32).astype(np.int64)
    order = np.lexsort((b, a))
    a, b, n, below = a[order], b[order], n[order], below[order]
    at, n = _summed((a, b), n)
    return a[at], b[at], n, below[at]


def _flat(kind: int, keys: np.ndarray, **sums: np.ndarray) -> pa.RecordBatch:
    n = len(keys)
    zero = np.zeros(n, dtype=np.int64)
    return record_batch(_FLAT, np.full(n, kind, np.int32), keys.view(np.int64), *[sums.get(c, zero) for c in _SUMS])


def _by_key(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    order = np.argsort(keys, kind="stable")
    at, sums = _summed((keys[order],), np.stack(values, axis=1)[order])
    return keys[order][at], list(sums.T.astype(np.int64))


def _sums_of(level: int, top: bool, folder: str, bucket: int, grams_: tuple) -> list[pa.RecordBatch]:
    """Write a bucket's n-grams; rows of what it knows of words, contexts and totals."""
    a, b, n, _ = grams_
    h = pair_hash(a, b)
    by_hash = np.argsort(h)
    once = n[by_hash] == 1
    h, more = h[by_hash], n[by_hash][~once]
    _write(_file(folder, f"grams{level}", bucket), np.array([once.sum(), len(more)], dtype=np.int64), h[once], h[~once], more)
    out = []
    as_first, (total, n1, n2, n3) = _by_key(a, n, n == 1, n == 2, n > 2)
    out.append(_flat(_WORD if level == 2 else level, as_first, s2=total, s3=n1, s4=n2, s5=n3))
    if level == 2 or top:  # tokens are counted by the highest order, left neighbours by the pairs
        words, (tokens, left) = _by_key(b, n if top else np.zeros_like(n), np.full_like(n, level == 2))
        out.append(_flat(_WORD, words, s0=tokens, s1=left))
    counts = np.array([(n == k).sum() for k in (1, 2, 3, 4)], dtype=np.int64)[:, None]
    out.append(_flat(-level, np.zeros(1, np.int64), **{f"s{i}": c for i, c in enumerate(counts)}))
    return out


def _gathered(order: int, buckets: int, hot: np.ndarray):
    """Texts → rows for the buckets of the highest order."""
    def send(batches):
        parts, size = [], 0

        def packed():
            a, b, below = (np.concatenate(x) for x in zip(*parts))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int32() if i == 0 else pa.binary())
                 for i, c in enumerate(_packed((a, b, np.ones(len(a), np.int64), below), order, hot, buckets))],
                names=["bucket", "first", "runs", "second", "n", "below"])

        for (found,) in slices(batches, ("text",)):
            at, contexts = grams(Words(found, lower=True), order)
            parts.append((contexts[-1], at, np.stack(contexts[:-1], axis=1) if order > 2 else np.zeros((len(at), 0), np.uint64)))
            size += len(at)
            if size > _GATHER:
                yield packed()
                parts, size = [], 0
        if size:
            yield packed()
    return send


def count_grams(texts: DataFrame, folder: str, order: int, buckets: int, hot: dict[int, np.ndarray]) -> DataFrame:
    """Count all orders, write the n-grams under ``folder`` and return the sums by key."""
    sc = texts.sparkSession.sparkContext
    sent = sc.broadcast(hot)  # at most HOT_WORDS hashes for each order
    rows = texts.select("text").mapInArrow(lambda batches: _gathered(order, buckets, sent.value[order])(batches), _GRAM_SQL)

    def summed(level: int, shorter: bool):
        def sums(key, table):
            found = _unpacked(table, level)
            flat = pa.Table.from_batches(_sums_of(level, level == order, folder, key[0].as_py(), found), _FLAT)
            if not shorter:
                return flat
            # each n-gram once, as a left neighbour of the one without its first word
            a, b, n, below = found
            down = _packed((below[:, -1], b, np.ones_like(n), below[:, :-1]), level - 1, sent.value[level - 1], buckets)
            rest = list(_MIXED)[len(_FLAT):]
            flat = [*flat.columns, *[pa.nulls(flat.num_rows, f.type) for f in rest]]
            own = [pa.array([0] * len(down[0]), pa.int32()), *[pa.nulls(len(down[0]), f.type) for f in list(_FLAT)[1:]],
                   *[pa.array(c, f.type) for c, f in zip(down, rest)]]
            return pa.concat_tables([pa.Table.from_arrays(flat, schema=_MIXED), pa.Table.from_arrays(own, schema=_MIXED)])
        return sums

    flat = []
    for level in range(order, 1, -1):
        for k in range(64):
            os.makedirs(f"{folder}/grams{level}-{k:02d}", exist_ok=True)
        groups = rows.groupBy("bucket")
        if level == 2:
            flat.append(groups.applyInArrow(summed(level, False), _FLAT_SQL))
        else:
            mixed = stored(groups.applyInArrow(summed(level, True), f"{_FLAT_SQL}, {_GRAM_SQL}"), f"order-{level}")
            flat.append(mixed.filter("kind <> 0").select(*_FLAT.names))
            rows = mixed.filter("kind = 0").select("bucket", "first", "runs", "second", "n", "below")
    return reduce(DataFrame.unionByName, flat).groupBy("kind", "key").agg(*[F.sum(c).alias(c) for c in _SUMS])


def write_tables(sums: DataFrame, folder: str, order: int) -> dict[int, int]:
    """Sorted arrays of words and of the contexts of each higher order; returns the number
    of buckets of each, which follows from the number of its keys."""
    counts = {r["kind"]: r["n"] for r in sums.filter("kind > 0").groupBy("kind").agg(F.count("*").alias("n")).collect()}
    buckets = {}

    def written(kind: int):
        def write(key, table):
            table = table.sort_by("order")
            column = lambda name, dtype: table[name].to_numpy().astype(dtype)
            _write(_file(folder, f"table{kind}", key[0].as_py()), np.array([table.num_rows], dtype=np.int64),
                   table["key"].to_numpy().view(np.uint64), column("s0", np.int64), column("s2", np.int64),
                   *[column(c, np.uint32) for c in ("s1", "s3", "s4", "s5")])
            return pa.table({"n": pa.array([table.num_rows], pa.int64())})
        return write

    for kind in [_WORD, *range(3, order + 1)]:
        n = buckets[kind] = max(1, -(-counts.get(kind, 0) * _KEY_BYTES // TABLE_BYTES))
        for k in range(64):
            os.makedirs(f"{folder}/table{kind}-{k:02d}", exist_ok=True)

        high = F.shiftrightunsigned("key", 32)
        rows = sums.filter(F.col("kind") == kind).select(
            F.shiftright(high * n, 32).cast("int").alias("bucket"),
            F.col("key").bitwiseXOR(F.lit(-2**63)).alias("order"), "key", *_SUMS)  # signed order of unsigned keys
        rows.groupBy("bucket").applyInArrow(written(kind), "n long").agg(F.sum("n")).first()
    return buckets


def totals_of(sums: DataFrame, order: int) -> dict:
    """V, N, counts of counts of each order and of the words' left neighbours."""
    left, word = F.col("s1"), F.col("kind") == _WORD
    row = sums.agg(F.count_if(word & (F.col("s0") > 0)).alias("V"), F.sum(F.when(word, F.col("s0"))).alias("N"),
                   F.sum(F.when(word, left)).alias("types"),
                   *[F.count_if(word & (left == k)).alias(f"u{k}") for k in (1, 2, 3, 4)],
                   F.count_if(word & (left > 2)).alias("u3up"),
                   *[F.sum(F.when(F.col("kind") == -k, F.col(f"s{i}"))).alias(f"b{k}_{i + 1}")
                     for k in range(2, order + 1) for i in range(4)]).first()
    return {k: int(v or 0) for k, v in row.asDict().items()}


def discounts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    """Discounts of counts 0, 1, 2 and 3 or more."""
    if not n1 or not n2:
        return np.array([0.0, 0.5, 1.0, 1.5])
    y = n1 / (n1 + 2.0 * n2)
    d = [0.0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return np.array([0.0, *[min(max(x, 0.05), k) for k, x in enumerate(d[1:], 1)]])


class Model:
    """Mapped arrays and totals; looks up and scores in a worker."""

    def __init__(self, folder: str, order: int, buckets: int, tables: dict[int, int], hot: dict[int, np.ndarray], totals: dict):
        self.folder, self.order, self.buckets, self.tables = folder, order, buckets, tables
        self.hot, self.totals = hot, totals
        t = totals
        self.d_gram = {k: discounts(*[t[f"b{k}_{i}"] for i in (1, 2, 3, 4)]) for k in range(2, order + 1)}
        self.d_word = discounts(t["u1"], t["u2"], t["u3"], t["u4"])
        self.types = max(1, t["types"])
        self.gamma = (self.d_word[1] * t["u1"] + self.d_word[2] * t["u2"] + self.d_word[3] * t["u3up"]) / self.types
        self.maps: OrderedDict[tuple[str, int], mmap.mmap | bytes] = OrderedDict()

    def __getstate__(self):
        return {**self.__dict__, "maps": OrderedDict()}

    def mapped(self, kind: str, bucket: int):
        """The file's bytes; the ``MAPS`` used last stay mapped."""
        found = self.maps.get((kind, bucket))
        if found is None:
            path = _file(self.folder, kind, bucket)
            if not os.path.exists(path):  # nothing fell into it
                found = b"\0" * 16
            else:
                with open(path, "rb") as f:
                    found = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ, trackfd=False)
            self.maps[kind, bucket] = found
            if len(self.maps) > MAPS:
                self.maps.popitem(last=False)  # unmapped when no array looks at it any more
        else:
            self.maps.move_to_end((kind, bucket))
        return found

    @staticmethod
    def _find(known: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(known):
            return np.zeros(len(x), dtype=np.int64), np.zeros(len(x), dtype=bool)
        at = np.minimum(np.searchsorted(known, x), len(known) - 1)
        return at, known[at] == x

    def key_sums(self, kind: int, h: np.ndarray) -> np.ndarray:
        """Sums (tokens, context total, left neighbours, n1, n2, n3) of sorted hashes."""
        out = np.zeros((len(h), len(_SUMS)), dtype=np.float64)
        bucket = _bucket(h, self.tables[kind])
        cut = _starts(bucket)
        for s, e in zip(cut.tolist(), [*cut[1:].tolist(), len(h)]):
            data = self.mapped(f"table{kind}", int(bucket[s]))
            n = int(np.frombuffer(data, np.int64, 1)[0])
            if not n:
                continue
            at, hit = self._find(np.frombuffer(data, np.uint64, n, 8), h[s:e])
            at, rows = at[hit], np.arange(s, e)[hit]
            for k in range(2):
                out[rows, k] = np.frombuffer(data, np.int64, n, 8 + 8 * n * (k + 1))[at]
            for k in range(4):
                out[rows, 2 + k] = np.frombuffer(data, np.uint32, n, 8 + 24 * n + 4 * n * k)[at]
        return out

    def gram_counts(self, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Counts of the n-grams of a context and a word."""
        bucket, h = pair_bucket(a, b, self.hot[level], self.buckets), pair_hash(a, b)
        order = np.lexsort((h, bucket))
        bucket, h = bucket[order], h[order]
        found = np.zeros(len(h), dtype=np.float64)
        cut = _starts(bucket)
        for s, e in zip(cut.tolist(), [*cut[1:].tolist(), len(h)]):
            data = self.mapped(f"grams{level}", int(bucket[s]))
            once, more = np.frombuffer(data, np.int64, 2).tolist()
            x = h[s:e]
            _, hit = self._find(np.frombuffer(data, np.uint64, once, 16), x)
            found[s:e][hit] = 1.0
            at, hit = self._find(np.frombuffer(data, np.uint64, more, 16 + 8 * once), x)
            if more:
                found[s:e][hit] = np.frombuffer(data, np.int64, more, 16 + 8 * (once + more))[at[hit]]
        out = np.empty_like(found)
        out[order] = found
        return out

    def unigram(self, left: np.ndarray) -> np.ndarray:
        """P(w) of words with so many left neighbours."""
        return (np.maximum(left - self.d_word[np.minimum(left, 3).astype(int)], 0.0) / self.types
                + (self.gamma if self.totals["types"] else 1.0) / (self.totals["V"] + 1))

    def step(self, level: int, n: np.ndarray, context: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """P of one order from counts, the contexts' sums and P of the order below."""
        d, total = self.d_gram[level], context[:, 1]
        rest = np.where(total > 0, context[:, 3:] @ d[1:] / np.maximum(total, 1), 1.0)
        return np.maximum(n - d[np.minimum(n, 3).astype(int)], 0.0) / np.maximum(total, 1) + rest * lower

    def score(self, texts: list[str]) -> tuple[np.ndarray, ...]:
        """Tokens, known tokens, base score and score of each text."""
        words, t = Words(texts, lower=True), self.totals
        tokens, contexts = grams(words, self.order)
        known, where = np.unique(np.concatenate([tokens, [_BEGIN, _END]]), return_inverse=True)
        sums, token = self.key_sums(_WORD, known), where[:-2]
        count = sums[:, 0]
        base = np.log10((count + 0.5) / (t["N"] + 0.5 * (t["V"] + 1)))
        p = self.unigram(sums[:, 2])[token]
        for level, context in enumerate(contexts, 2):
            if level == 2:
                held, held_sums = known, sums
                of = np.searchsorted(known, context)  # begin marks and words are all there
            else:
                held, of = np.unique(context, return_inverse=True)
                held_sums = self.key_sums(level, held)
            code, first, which = np.unique(of.astype(np.int64) * len(known) + token, return_index=True, return_inverse=True)
            n = self.gram_counts(level, context[first], tokens[first])
            p = self.step(level, n[which], held_sums[of], p)
        begin = words.first[:-1] + np.arange(len(texts))
        return (np.diff(words.first) + 1, np.add.reduceat((count > 0)[token].astype(np.int64), begin),
                np.add.reduceat(base[token], begin), np.add.reduceat(np.log10(p), begin))


def train(docs: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text", order: int = 2) -> Model:
    """Model of the rows for which ``usable`` (a condition on ``doc_id``) holds, over
    n-grams of ``order`` (2 or more) words."""
    spark: SparkSession = docs.sparkSession
    texts = id_and_text(docs, id_col, text_col).filter(usable)
    size = texts.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    buckets = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    folder = _folder(scratch_path(spark, "kneser-ney"))
    hot = frequent_contexts(texts, order, buckets)
    # written once, as totals and tables both read them
    sums = stored(count_grams(texts, folder, order, buckets, hot), "word-sums", size // 8)
    model = Model(folder, order, buckets, write_tables(sums, folder, order), hot, totals_of(sums, order))
    forget(sums)
    return model


def kneser_ney_scores(docs: DataFrame, model: Model, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score, perplexity``."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                        ("train_tokens", pa.int64()), ("base_score", pa.float64()),
                        ("score", pa.float64()), ("perplexity", pa.float64())])
    sent = docs.sparkSession.sparkContext.broadcast(model)  # names, totals and HOT_WORDS hashes

    def run(batches):
        model = sent.value
        ids, texts, size = [], [], 0

        def rows():
            n, known, base, score = model.score(texts)
            return record_batch(schema, ids, n, known, np.full(len(ids), model.totals["N"]), base, score,
                                10.0 ** np.minimum(-score / n, 300.0))

        for some, found in slices(batches):
            if size + sum(map(len, found)) > _ROUND_CHARS and ids:
                yield rows()
                ids, texts, size = [], [], 0
            ids, texts, size = ids + some, texts + found, size + sum(map(len, found))
        if ids:
            yield rows()

    return id_and_text(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, "
             "score double, perplexity double")


__all__ = ["Model", "discounts", "kneser_ney_scores", "train"]
