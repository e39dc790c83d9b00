"""Registered queries of the training-data operators and their DuckDB forms."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.llm.bpe import bpe_digest
from fleetlake.llm.common import crc_bucket, read_table, ready
from fleetlake.llm.conversation_repair import damaged, repair_conversations
from fleetlake.llm.decontaminate import benchmark_matches
from fleetlake.llm import kneser_ney, language_id, merkle
from fleetlake.llm.line_dedup import line_dedup
from fleetlake.llm.piecewise import piecewise_fingerprints
from fleetlake.llm.sharding import minimax_shards
from fleetlake.llm.simhash import simhash_classes
from fleetlake.llm.substring_dedup import remove_repeats
from fleetlake.llm.token_files import read_token_files, write_token_files
from fleetlake.llm.toxicity import THRESHOLD, toxicity_scores, train
from fleetlake.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; ids with crc32 remainder 0 are held out."""
    docs = read_table(ready(spark), sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(crc_bucket("doc_id", 5) == 0, F.lit(False))
    model = language_id.train(docs, ~held_out)
    return language_id.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@_query
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words covered by a 13-word window that a smaller doc_id holds as well go."""
    docs = read_table(ready(spark), sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs, window=13).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


@_query
def op3_piecewise_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piecewise fingerprints of every document and of its edited text, and their likeness."""
    docs = read_table(ready(spark), sf_dir, "documents").select("doc_id", "text")
    return piecewise_fingerprints(docs)


@_query
def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash of 3-word shingles; classes of fingerprints within two bits."""
    docs = read_table(ready(spark), sf_dir, "documents").select("doc_id", "text")
    return simhash_classes(docs, shingle=3, max_bits=2).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@_query
def op5_minimax_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of near equal bytes; equal texts stay together."""
    docs = read_table(ready(spark), sf_dir, "documents").select("doc_id", "text")
    return minimax_shards(docs, 40).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@_query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; labels with crc32 remainder 2 are held out."""
    docs = read_table(ready(spark), sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = train(docs, labels, crc_bucket("doc_id", 4) != 2)
    return toxicity_scores(docs, model).select(
        "doc_id", F.coalesce(crc_bucket("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


@_query
def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) in which the item occurs within its error budget."""
    docs = read_table(ready(spark), sf_dir, "documents").select("doc_id", "text")
    items = read_table(spark, sf_dir, "benchmark").select("item_id", "text")
    return benchmark_matches(docs, items)


@_query
def op8_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document under a Kneser-Ney model and an add-half
    unigram base; ids with crc32 remainder 1 are held out."""
    docs = read_table(ready(spark), sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(crc_bucket("doc_id", 5) == 1, F.lit(False))
    model = kneser_ney.train(docs, ~held_out)
    return kneser_ney.kneser_ney_scores(docs, model).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """Place of a vocabulary file of the installed public tokenizers."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


@_query
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded with the 49k word BPE and decoded again."""
    docs = read_table(ready(spark), sf_dir, "documents").select("doc_id", "text")
    return bpe_digest(docs, vocabulary())


@_query
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines repeated in two documents or more stay in the smallest one only."""
    docs = read_table(ready(spark), sf_dir, "documents").select("doc_id", "text")
    return line_dedup(docs).select(
        F.col("doc.doc_id").alias("doc_id"), "n_lines", "n_dropped",
        F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


@_query
def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents written in files with Elias-Fano boundaries and read back."""
    docs = read_table(ready(spark), sf_dir, "documents").select("doc_id", "text")
    root = scratch_path(spark, "token-files")
    write_token_files(docs, root, vocabulary("byte_bpe_50k.json"))
    return read_token_files(spark, root)


@_query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation after damage by checksum."""
    rows = read_table(ready(spark), sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repair_conversations(damaged(rows), rows.select("conv_id"))


@_query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, proof and folded root of every document; every seventh id by crc32 is
    tampered with (one more character claimed) before its root is folded."""
    docs = read_table(ready(spark), sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    tampered = F.when((crc_bucket("doc_id", 7) == 0) & F.col("n_chars").isNotNull(), merkle.leaf(
        F.col("doc_id"), F.col("source"), F.col("lang"), more.cast("decimal(20,0)"), F.col("text")))
    found = merkle.merkle_proofs(docs, carry={"tampered": tampered})
    folded = merkle.fold(F.coalesce("tampered", "leaf"), F.col("path"))
    return (found.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root",
                         merkle.proof_digest(F.col("path")).alias("proof_sha256"), folded.alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))


ORACLES["op13_merkle_manifest"] = r"""
WITH RECURSIVE fields AS (
  SELECT doc_id, lang, n_chars,
         coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-') AS head,
         coalesce(strlen(text) || ':' || text, '-') AS tail FROM documents
), leaves AS (
  SELECT doc_id, lang, sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
         CASE WHEN n_chars IS NOT NULL AND xor(4294967295::BIGINT,
                   list_reduce([4294967295::BIGINT] || flatten(list_transform(string_split(doc_id::VARCHAR, ''),
                     lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
                   lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384::BIGINT)
                                     ELSE a // 2 END)) % 7 = 0
              THEN sha256(head || strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1) || tail) END AS tampered
  FROM fields
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS spot,
         count(*) OVER (PARTITION BY lang) AS n FROM leaves
), nodes(lang, level, spot, n, hash) AS (
  SELECT lang, 0, spot, n, leaf FROM placed
  UNION ALL
  SELECT lang, level + 1, spot // 2, (n + 1) // 2, sha256(string_agg(hash, '' ORDER BY spot)) FROM nodes WHERE n > 1
  GROUP BY lang, level, spot // 2, n
), subroots AS (
  SELECT lang, hash AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS spot, count(*) OVER () AS n
  FROM nodes WHERE n = 1
), tops(level, spot, n, hash) AS (
  SELECT 0, spot, n, subroot FROM subroots
  UNION ALL
  SELECT level + 1, spot // 2, (n + 1) // 2, sha256(string_agg(hash, '' ORDER BY spot)) FROM tops WHERE n > 1
  GROUP BY level, spot // 2, n
), folds(doc, lang, spot, n, level, top, acc, proof) AS (
  SELECT row_number() OVER (ORDER BY lang NULLS FIRST, spot), lang, spot, n, 0, FALSE, coalesce(tampered, leaf), ''
  FROM placed
  UNION ALL
  SELECT f.doc, f.lang,
         CASE WHEN f.n > 1 THEN f.spot // 2 ELSE s.spot END, CASE WHEN f.n > 1 THEN (f.n + 1) // 2 ELSE s.n END,
         CASE WHEN f.n > 1 THEN f.level + 1 ELSE 0 END, f.n = 1 OR f.top,
         CASE WHEN f.n = 1 THEN f.acc WHEN f.spot % 2 = 1 THEN sha256(coalesce(b.hash, t.hash) || f.acc)
              ELSE sha256(f.acc || coalesce(b.hash, t.hash, '')) END,
         f.proof || CASE WHEN f.n = 1 THEN '' ELSE coalesce(b.hash, t.hash, '') END
  FROM folds f
  LEFT JOIN nodes b ON NOT f.top AND b.lang IS NOT DISTINCT FROM f.lang AND b.level = f.level AND b.spot = xor(f.spot, 1)
  LEFT JOIN tops t ON f.top AND t.level = f.level AND t.spot = xor(f.spot, 1)
  LEFT JOIN subroots s ON s.lang IS NOT DISTINCT FROM f.lang
  WHERE f.n > 1 OR NOT f.top
), numbered AS (
  SELECT *, row_number() OVER (ORDER BY lang NULLS FIRST, spot) AS doc FROM placed
)
SELECT p.doc_id, p.leaf, s.subroot, r.hash AS root, sha256(f.proof) AS proof_sha256, f.acc AS folded_root,
       f.acc = r.hash AS verified
FROM numbered p JOIN subroots s ON s.lang IS NOT DISTINCT FROM p.lang
JOIN folds f ON f.doc = p.doc AND f.top AND f.n = 1
CROSS JOIN (SELECT hash FROM tops WHERE n = 1) r
"""

ORACLES["op2_substring_dedup"] = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), windows AS (
  SELECT doc_id, p, array_to_string(ws[p:p + 12], ' ') AS seq
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS p FROM docs)
), firsts AS (
  SELECT seq, min(doc_id) AS first_id FROM windows GROUP BY seq
), gone AS (
  SELECT w.doc_id, w.p FROM windows w JOIN firsts f ON w.seq = f.seq WHERE f.first_id < w.doc_id
), words AS (
  SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM docs
), marked AS (
  SELECT w.doc_id, w.p, w.word,
         count(g.p) OVER (PARTITION BY w.doc_id ORDER BY w.p ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) > 0 AS out
  FROM words w LEFT JOIN gone g ON g.doc_id = w.doc_id AND g.p = w.p
)
SELECT d.doc_id, len(d.ws) AS n_words, count(*) FILTER (m.out) AS n_removed,
       sha256(coalesce(string_agg(m.word, ' ' ORDER BY m.p) FILTER (NOT m.out), '')) AS kept_sha256
FROM docs d LEFT JOIN marked m ON m.doc_id = d.doc_id GROUP BY d.doc_id, d.ws
"""

ORACLES["op10_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, u.i AS pos, u.line AS line,
         translate(trim(u.line, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(list_transform(string_split(coalesce(text, ''), chr(10)),
               lambda x, i: {'line': x, 'i': i})) AS u FROM documents)
), firsts AS (
  SELECT key, min(doc_id) AS first_id FROM lines WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), marked AS (
  SELECT l.doc_id, l.pos, l.line, f.key IS NOT NULL AND f.first_id <> l.doc_id AS gone
  FROM lines l LEFT JOIN firsts f ON l.key = f.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
