"""The pipeline and the registered queries over a small folder of tables."""

import random

import brute
import numpy as np
import pytest
from llm_tables import make_words, odd_rows
from pyspark.sql import functions as F
from test_operators import toxic_table

import __spark_entry__ as entry
import corpus_pipeline
from fleetlake.llm import decontaminate, queries, toxicity
from fleetlake.llm.common import crc_bucket

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """(folder, documents, items): odd rows, toxic rows, planted items and copies."""
    rng = random.Random(21)
    items = [(k, " ".join(make_words(rng, 25))) for k in range(5)]
    toxic, marks = toxic_table(300)
    rows = odd_rows() + [(1000 + i, t) for i, t in toxic]
    for k in range(10):
        rows.append((2000 + k, " ".join(make_words(rng, 15)) + " " + items[k % 5][1] + " the end"))
        rows.append((3000 + k, rows[k % 4 + 60][1]))
    folder = str(tmp_path_factory.mktemp("tables"))
    docs = [(i, t, "en" if k % 3 else "de", f"src{k % 4}", None if t is None else len(t)) for k, (i, t) in enumerate(rows)]
    spark.createDataFrame(docs, COLUMNS).repartition(2).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1000 + i, 1, m) for i, m in marks], "doc_id long, quality int, toxic int") \
        .write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, items


def test_pipeline_equals_plain_python(spark, tables):
    folder, rows, items = tables
    library = pytest.importorskip("tokenizers").Tokenizer.from_file(queries.vocabulary())
    read = lambda name: spark.read.parquet(f"{folder}/{name}.parquet")
    model = toxicity.train(read("documents"), read("labels"), crc_bucket("doc_id", 4) != 2)
    left = [(i, t) for i, t in rows if model.score(t or "") < toxicity.THRESHOLD]
    assert 40 < len(rows) - len(left) < 80
    left = [(i, kept) for i, _, _, kept in brute.line_dedup(left)]
    cls, stay = brute.classes([brute.simhash(t) for _, t in left]), {}
    for c, row in zip(cls, left):
        stay[c] = min(stay.get(c, row), row, key=lambda r: (r[0] is None, r[0] or 0))
    keys = [(decontaminate.compared(t), len(t)) for _, t in items]
    budget = lambda item: int(len(item) * decontaminate.ERROR_RATE)
    left = [(i, t) for i, t in stay.values()
            if len(t) > 9000 or all(brute.edit_distance(item, decontaminate.compared(t), True) > budget(item) for item, _ in keys)]
    want = sorted(((i if i is not None else -1), library.encode(t, add_special_tokens=False).ids) for i, t in left)
    found = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["ids"]) for r in corpus_pipeline.run(spark, folder).collect())
    assert found == want
    assert not {i for i, _ in found} & {2000 + k for k in range(10)}


def test_stages_return_the_columns_of_documents(spark, tables):
    folder, rows, _ = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumn("gone", F.lit("x")).withColumn("id", F.lit(1))
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "bpe"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, folder)
        assert found.columns == docs.columns and found.dtypes == docs.dtypes, name
        assert stage(spark, docs.limit(0), folder).count() == 0


CONTRACT = {
    "op1_": ["doc_id", "held_out", "lang_pred", "score"],
    "op2_": ["doc_id", "n_words", "n_removed", "kept_sha256"],
    "op3_": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    "op4_": ["doc_id", "fingerprint", "component_id"],
    "op5_": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op6_": ["doc_id", "held_out", "score", "predicted"],
    "op7_": ["doc_id", "item_id", "distance"],
    "op8_": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op9_": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op10_": ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
}


@pytest.mark.parametrize("prefix", CONTRACT)
def test_contract_columns(spark, tables, prefix):
    folder, rows, _ = tables
    found = entry.queries()
    name, = [q for q in found if q.startswith(prefix)]
    df = found[name](spark, folder)
    assert set(CONTRACT[prefix]) <= set(df.columns)
    out = df.collect()
    if prefix == "op7_":
        assert {2000 + k for k in range(10)} <= {r["doc_id"] for r in out}
    else:
        assert len(out) == len(rows)
    if prefix == "op4_":
        assert all(len(r["fingerprint"]) == 16 for r in out)
    if prefix == "op8_":
        assert all(np.isfinite(r["score"]) and r["score"] < 0 for r in out)
