"""Corpus pipeline: toxicity, line dedup, SimHash near-dedup, benchmark
decontamination, BPE.

Each stage works on what its predecessor kept; its rows are written as Parquet to
the shared folder and read again for the next one, so a lost executor costs at
most the stage that is running.  All stages but the last return the columns of
``documents``; the last returns the token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.llm.bpe import bpe_encode
from fleetlake.llm.common import crc_bucket, read_table, ready, stored
from fleetlake.llm.decontaminate import without_benchmark
from fleetlake.llm.line_dedup import line_dedup
from fleetlake.llm.queries import vocabulary
from fleetlake.llm.simhash import one_of_each_class
from fleetlake.llm.toxicity import train, without_toxic
from fleetlake.session import discard, scratch_paths


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go; null and empty texts stay."""
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = train(docs.select("doc_id", "text"), labels, crc_bucket("doc_id", 4) != 2)
    return without_toxic(docs, model)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines stay in the smallest document that holds them; every document
    stays, also one that lost all its lines.  ``n_chars`` follows the text."""
    found = line_dedup(docs)
    changed = F.col("n_dropped") > 0
    new = {"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast("long")}
    return found.select(*[
        F.when(changed, new[c]).otherwise(F.col("doc")[c]).alias(c) if c in new else F.col("doc")[c].alias(c)
        for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays."""
    return one_of_each_class(docs, shingle=3, max_bits=2)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return without_benchmark(docs, read_table(spark, sf_dir, "benchmark").select("item_id", "text"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` of every document that is left."""
    found = bpe_encode(docs, vocabulary())
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [("toxicity", toxicity), ("line_dedup", lines), ("simhash_near_dedup", near_duplicates),
          ("benchmark_decontamination", benchmark), ("bpe", tokens)]

#: the stages' models and the tokenizer have no SQL form; tests/llm holds the rows
#: against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table ``documents``."""
    docs = read_table(ready(spark), sf_dir, "documents")
    older = scratch_paths()
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
        for path in scratch_paths() - older - {docs.scratch}:
            discard(path)  # what the stage needed, and its input
    return STAGES[-1][1](spark, docs, sf_dir)
