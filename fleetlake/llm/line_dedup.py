"""Line dedup (native): repeated lines stay only in the smallest document holding them.

Lines are exploded, normalised and hashed, distinct documents are counted per
hash, lines over the threshold are dropped and the rest is reassembled by
position.  DataFrame functions only.

Skew: the count goes through (hash, document) first, so a line that a third of
all documents hold is combined on the map side and spread over partitions; the
join that brings the verdict back carries 40-byte rows and no text, and AQE can
split it.  The hashed lines are written once to the shared folder, as both read
them, in files sized by bytes.  Text is shuffled once, for the reassembly.

Defined cases: a null or empty text is one empty line; rows with equal ids are
one document when documents are counted, each row is reassembled from its own
text; null ids together are one document that sorts last; an empty table gives
an empty result; columns of any name pass through inside ``doc``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import ASCII_SPACE, scanned_bytes, stored

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def line_key(line: Column) -> Column:
    """The line without ASCII white space at both ends, A-Z in lower case.

    ``trim`` with a set and ``translate`` go through a line character by
    character, so they run only on lines that need them."""
    at_an_end = reduce(lambda a, b: a | b, [
        test(line, F.lit(c)) for c in ASCII_SPACE for test in (F.startswith, F.endswith)])
    bare = F.when(at_an_end, F.trim(line, F.lit(ASCII_SPACE))).otherwise(line)
    ascii_only = F.octet_length(line) == F.char_length(line)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, _UPPER, _UPPER.lower()))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               min_chars: int = 10, min_docs: int = 2) -> DataFrame:
    """``doc`` (the input row as a struct), ``n_lines``, ``n_dropped``, ``kept_text``.

    A key of at least ``min_chars`` code points found in at least ``min_docs``
    documents keeps its lines only in the smallest document that holds it."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    n_bytes = scanned_bytes(docs.select(text_col))  # the hashed lines take about as much, or less
    # null ids sort last, after every id
    ident = [docs[id_col].isNull().alias("no_id"), F.coalesce(docs[id_col].cast("long"), F.lit(0)).alias("id")]
    whole_id = F.struct("no_id", "id")
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("doc"),
        *ident, F.xxhash64(text).alias("text_hash"))
    lines = docs.select(
        *ident, F.xxhash64(text).alias("text_hash"),
        F.posexplode(F.split(text, "\n", -1)).alias("pos", "line"),
    ).select("no_id", "id", "text_hash", "pos", line_key(F.col("line")).alias("key"))
    lines = stored(lines.filter(F.length("key") >= min_chars).select(
        "no_id", "id", "text_hash", "pos", F.unhex(F.md5("key")).alias("key")), "lines", n_bytes)

    holders = lines.groupBy("key", "no_id", "id").agg(F.lit(1).alias("one"))
    # written before it is joined: AQE splits a hot key only between two plain exchanges
    repeated = stored(holders.groupBy("key").agg(F.count("*").alias("n_docs"), F.min(whole_id).alias("first_id"))
                      .filter(F.col("n_docs") >= min_docs).select("key", "first_id"), "repeated", n_bytes // 4)
    dropped = (lines.join(repeated, "key").filter(whole_id != F.col("first_id"))
               .groupBy("no_id", "id", "text_hash").agg(F.collect_set("pos").alias("gone")))

    parts = F.split(F.coalesce(F.col("doc")[text_col], F.lit("")), "\n", -1)
    # array_except is one hash pass, so a document of very many lines stays linear
    kept = F.array_except(F.sequence(F.lit(0), F.size("parts") - 1), F.col("gone"))
    return (rows.join(dropped, ["no_id", "id", "text_hash"], "left")
            .select("doc", "gone", parts.alias("parts"))
            .select(
                "doc", F.size("parts").cast("long").alias("n_lines"),
                F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
                F.when(F.col("gone").isNull(), F.coalesce(F.col("doc")[text_col], F.lit("")))
                 .otherwise(F.array_join(F.transform(kept, lambda i: F.col("parts")[i]), "\n"))
                 .alias("kept_text")))


__all__ = ["line_dedup", "line_key"]
