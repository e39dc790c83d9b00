"""The Merkle manifest against a plain tree, on odd rows, ties and empty tables."""

import hashlib
import random
import zlib

import pytest
from llm_tables import SCHEMA, as_docs, no_docs, odd, odd_docs  # noqa: F401 - fixtures
from pyspark.sql import functions as F

from fleetlake.llm import merkle

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def plain_tree(leaves):
    """The last node and, for each leaf, its (left, right) siblings level by level."""
    paths, at, nodes = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(nodes) > 1:
        for path, k in zip(paths, range(len(leaves))):
            pair = [nodes[i] if i < len(nodes) and i != at[k] else "" for i in (at[k] // 2 * 2, at[k] // 2 * 2 + 1)]
            path.append(tuple(pair))
            at[k] //= 2
        nodes = [sha(*nodes[i:i + 2]) for i in range(0, len(nodes), 2)]
    return nodes[0], paths


def plain_proofs(rows):
    """(doc_id, leaf, subroot, root, path) of rows (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    sides, subs = {}, {}
    for g in names:
        sides[g] = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r)))
        subs[g] = plain_tree([plain_leaf(r) for r in sides[g]])
    root, upper = plain_tree([subs[g][0] for g in names])
    return [(r[0], plain_leaf(r), subs[g][0], root, path + above)
            for g, above in zip(names, upper) for r, path in zip(sides[g], subs[g][1])]


def compare(docs):
    rows = [tuple(r) for r in docs.select(*FIELDS).collect()]
    found = merkle.merkle_proofs(docs).select(
        "id", "leaf", "subroot", "root", "path", merkle.proof_digest(F.col("path")).alias("proof"),
        merkle.fold(F.col("leaf"), F.col("path")).alias("folded")).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    got = sorted([(*r[:4], [tuple(s) for s in r["path"]]) for r in found], key=key)
    assert got == sorted(plain_proofs(rows), key=key)
    assert all(r["folded"] == r["root"] for r in found)
    assert all(r["proof"] == sha(*[a + b for a, b in r["path"]]) for r in found)


def test_odd_rows(odd_docs):
    """Nulls, empty and long texts, repeated rows, ties of ids and clashing columns."""
    compare(odd_docs)


@pytest.mark.parametrize("n, langs", [(1, 1), (2, 1), (255, 1), (256, 2), (257, 1), (1500, 3), (300, 300)])
def test_sizes(spark, n, langs):
    """Blocks that are full, short and single; groups of one; trees of different heights."""
    rng = random.Random(n)
    rows = [(i, f"text {i}", None if i % langs == 0 else f"l{min(rng.randrange(langs), i % langs):03d}", "s", i, "k", "g", i)
            for i in range(n)]
    compare(spark.createDataFrame(rows, SCHEMA).repartition(5))


def test_blocks_of_blocks(spark, monkeypatch):
    """Small blocks give several levels of them."""
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", 2)
    rows = [(i, f"t{i}", "a" if i % 3 else "b", "s", i, "k", "g", i) for i in range(150)]
    compare(spark.createDataFrame(rows, SCHEMA))


def test_equal_rows_and_one_id(spark):
    """A third of the rows share an id, some are equal in every field."""
    rows = [(7 if i % 3 == 0 else i, f"t{i % 40}", "a", "s", 2, "k", "g", i) for i in range(600)]
    compare(spark.createDataFrame(rows, SCHEMA).repartition(4))


def test_empty(no_docs):
    assert merkle.merkle_proofs(no_docs).count() == 0


def test_query(spark, tmp_path):
    """Tampering with a row's length shows in its folded root and nowhere else."""
    from fleetlake.llm.queries import QUERIES

    rows = [(i if i != 4 else None, f"text {i}", ["en", "fr", None][i % 3], "s", None if i % 14 == 0 else i, "k", "g", i)
            for i in range(400)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    found = QUERIES["op13_merkle_manifest"](spark, str(tmp_path)).collect()
    assert len(found) == len(rows)
    lengths = {r[0]: r[4] for r in rows}
    for r in found:
        hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0 and lengths[r["doc_id"]] is not None
        assert r["verified"] == (not hit) == (r["folded_root"] == r["root"])
    assert 20 < sum(not r["verified"] for r in found) < 120
