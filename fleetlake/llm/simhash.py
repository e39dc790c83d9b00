"""SimHash near-dedup over a byte-position inverted index with count filtering.

A 64-bit fingerprint is eight positional bytes.  Two fingerprints that differ in
at most ``max_bits`` bits differ in at most that many bytes, so they share at
least ``8 - max_bits`` positional bytes; for two bits, at least six.  The index
is read at four positions at once: with the bytes taken in four neighbouring
couples, two differing bytes spoil at most two couples, so any linked pair meets
in at least one of the six lists of two whole couples.  Within a list the shared
positional bytes of a pair are tallied, pairs below the guaranteed minimum are
left out, and the rest is verified by its differing bits.

Only different fingerprints enter the index: copies share one entry.  A list of
more than ``list_bound`` fingerprints isn't paired up.  There, fingerprints
within two bits of each other share a neighbour that is at most one bit away
from both; these groups hold at most 33 fingerprints and link to their smallest
one.  That is exact as well, and its rows grow with the list, not its square.

Defined cases: a null or empty text has fingerprint zero and links like any
other; repeated rows share a fingerprint; a null id joins its class but never
names it (a class of null ids only has a null component); an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import id_and_text, record_batch, scanned_bytes, slices, stored
from fleetlake.llm.graph import components

_SEED = 42
_COUPLES = list(combinations(range(4), 2))


def fingerprint(text: str, shingle: int = 3) -> int:
    """The SimHash of a text's word shingles, as a signed 64-bit integer."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # both ASCII only, on bytes
    if not words:
        return 0
    line = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:-1]]
    size = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b - 1], _SEED) for a, b in zip(starts, ends[size - 1:])],
                      dtype=">u8")
    count = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 65_536):
        part = hashes[at:at + 65_536].view(np.uint8).reshape(-1, 8)
        count += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(count * 2 > len(hashes))
    return int(bits.view(">i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id, text_hash, fp`` of every row's whole text."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("fp", pa.int64())])

    def run(batches):
        for ids, hashes, texts in slices(batches, ("doc_id", "text_hash", "text")):
            yield record_batch(schema, ids, hashes, [fingerprint(t, shingle) for t in texts])

    rows = id_and_text(docs, id_col, text_col)
    return rows.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        run, "doc_id long, text_hash long, fp long")


def _couple(i: int) -> Column:
    return F.shiftrightunsigned("fp", 16 * i).bitwiseAND(F.lit(0xFFFF))


def _rest_flips(couples: tuple[int, int]) -> list[int]:
    """The fingerprint itself and the single bits outside the list's positions."""
    bits = [1 << b for b in range(64) if b // 16 not in couples]
    return [0, *[m - (1 << 64) if m >> 63 else m for m in bits]]


def links(fps: DataFrame, max_bits: int = 2, list_bound: int = 32, n_bytes: int | None = None) -> DataFrame:
    """``a, b``: linked pairs of different fingerprints; together they connect
    every two fingerprints that differ in at most ``max_bits`` bits."""
    if max_bits != 2:
        raise ValueError("the index and the neighbours of long lists are made for two differing bits")
    lists = F.array(*[
        F.struct(F.lit(k).alias("c"), F.shiftleft(_couple(i), 16).bitwiseOR(_couple(j)).alias("bytes"))
        for k, (i, j) in enumerate(_COUPLES)])
    index = fps.select("fp", F.explode(lists).alias("l")).select("fp", "l.c", "l.bytes")
    sizes = index.groupBy("c", "bytes").agg(F.count("*").alias("n"))
    index = stored(index.join(sizes.filter("n > 1"), ["c", "bytes"]), "index", n_bytes)

    short = index.filter(F.col("n") <= list_bound)
    x, y = short.select("c", "bytes", F.col("fp").alias("a")), short.select("c", "bytes", F.col("fp").alias("b"))
    differ = F.col("a").bitwiseXOR(F.col("b"))
    shared = reduce(lambda s, t: s + t, [
        (F.shiftrightunsigned(differ, 8 * i).bitwiseAND(F.lit(255)) == 0).cast("int") for i in range(8)])
    pairs = (x.join(y, ["c", "bytes"])
             .filter((F.col("a") < F.col("b")) & (shared >= 8 - max_bits) & (F.bit_count(differ) <= max_bits))
             .select("a", "b"))

    flips = F.lit(None)
    for k, couples in enumerate(_COUPLES):
        flips = F.when(F.col("c") == k, F.array(*[F.lit(m).cast("long") for m in _rest_flips(couples)])).otherwise(flips)
    near = (index.filter(F.col("n") > list_bound)
            .select("fp", "c", "bytes", F.explode(F.transform(flips, lambda m: F.col("fp").bitwiseXOR(m))).alias("near"))
            .groupBy("c", "bytes", "near").agg(F.collect_set("fp").alias("fps"))
            .filter(F.size("fps") > 1)
            .select(F.array_min("fps").alias("a"), F.explode("fps").alias("b"))
            .filter("a <> b"))
    return pairs.union(near).distinct()


def simhash_classes(docs: DataFrame, shingle: int = 3, max_bits: int = 2, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``doc_id, text_hash, fp, root, component_id`` of every row: ``root`` is the
    smallest fingerprint of its class, ``component_id`` the smallest id."""
    n_bytes = scanned_bytes(docs.select(text_col))  # more than any of the tables takes
    marked = stored(fingerprints(docs, shingle, id_col, text_col), "fingerprints", 8 * n_bytes)  # the text is read: many tasks
    fps = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct", n_bytes)
    roots = components(links(fps, max_bits, n_bytes=n_bytes), n_bytes=n_bytes).select(F.col("node").alias("fp"), "root")
    rooted = stored(fps.join(roots, "fp", "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")), "rooted", n_bytes)
    first = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = rooted.join(first, "root").select("fp", "root", "component_id")
    return marked.join(classes, "fp").select(
        "doc_id", "text_hash", "fp", "root", "component_id")


def one_of_each_class(docs: DataFrame, shingle: int = 3, max_bits: int = 2, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with the smallest id of each class (ids that aren't null
    first, equal ids by text hash, a repeated row once), with all their columns."""
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    stay = (simhash_classes(docs, shingle, max_bits, id_col, text_col)
            .groupBy("root").agg(F.min(rank).alias("r"))
            .select(F.col("r.doc_id").alias("id"), F.col("r.text_hash").alias("h")))
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"),
                       docs[id_col].cast("long").alias("id"),
                       F.xxhash64(F.coalesce(docs[text_col].cast("string"), F.lit(""))).alias("h"))
    stay = stay.alias("s")
    found = rows.alias("d").join(
        stay, F.col("d.id").eqNullSafe(F.col("s.id")) & (F.col("d.h") == F.col("s.h")), "left_semi")
    return found.groupBy("id", "h").agg(F.first("doc").alias("doc")).select("doc.*")


__all__ = ["fingerprint", "fingerprints", "links", "one_of_each_class", "simhash_classes"]
