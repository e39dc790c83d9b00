"""Merkle manifest: a hash tree over each group's rows, one over the groups, and a proof for every row.

A row's leaf is the SHA-256 of its fields.  Within a group leaves ascend by id; every
two consecutive nodes become the hash of their digests until one is left, the
subroot.  Subroots, ordered by group, likewise give the root.

The tree is built as a rollup of nested structs.  A row's rank has a binary digit for
every level; inside a block of 256 rows the digit columns are grouped away one after
another, and the parent struct holds its children.  Blocks are partitioned by group
and block number once, which serves all eight aggregations.  The blocks' hashes are
the rows of the next eight levels.  On the way back a block's struct is opened by
``transform`` and one ``explode``, each node handing its path and its sibling down, so
a row never looks its siblings up.  Only whole blocks, one for 256 rows, meet the
path above them by an equi-join.  No group's rows meet in one task: ranks come from
range partitions.  DataFrame functions only.

Defined cases: a null field counts as ``-``; the null group is one of its own and comes
first; null ids come first in their group; rows that tie in group and id are ordered by
their leaf, so equal rows are leaves of their own; a group of one row has its leaf as
subroot, a single group's subroot is the root; an empty table gives an empty result;
columns that aren't named are left out, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import scanned_bytes, stored
from fleetlake.llm.ranges import in_order, with_rank

#: levels of one block: 256 rows
BLOCK_LEVELS = 8
#: about the bytes of a row in a block: its leaf, its share of the inner nodes, what it carries
_ROW_BYTES = 300

_PATH = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the concatenated texts."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return digest(*[field(v) for v in values])


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings, level by level, give."""
    return F.aggregate(path, start, lambda node, step: digest(step["left"], node, step["right"]))


def proof_digest(path: Column) -> Column:
    """SHA-256 of the siblings, level by level."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""))


def _height(n: Column) -> Column:
    """Levels over ``n`` nodes: the binary digits of n - 1."""
    return F.when(n > 1, F.length(F.bin(n - 1))).otherwise(0)


def _nested(nodes: DataFrame, base: int) -> DataFrame:
    """``key, height, block, node`` from ``key, height, rank, node``: the digits of the
    rank within the block are grouped away, the lowest first."""
    digits = [f"d{i}" for i in range(BLOCK_LEVELS)]
    rows = nodes.select(
        "key", "height", F.shiftright("rank", BLOCK_LEVELS).alias("block"), "node",
        *[F.shiftright("rank", i).bitwiseAND(1).alias(d) for i, d in enumerate(digits)])
    rows = rows.repartition("key", "block")
    for i, digit in enumerate(digits):
        kids = F.sort_array(F.collect_list(F.struct(digit, "node")))
        rows = rows.groupBy("key", "height", "block", *digits[i + 1:]).agg(
            F.transform(kids, lambda kid: kid["node"]).alias("kids"))
        first, second = F.get("kids", F.lit(0))["hash"], F.get("kids", F.lit(1))["hash"]
        joined = digest(first, F.coalesce(second, F.lit("")))
        # a tree that has ended lower hands its root up as it is
        node = F.struct(F.when(F.col("height") > base + i, joined).otherwise(first).alias("hash"), "kids")
        rows = rows.select("key", "height", "block", *digits[i + 1:], node.alias("node"))
    return rows


def _children(level: int) -> Callable[[Column], Column]:
    """A node with its path → its children with theirs."""
    def children(parent):
        kids = parent["node"]["kids"]
        first, second = F.get(kids, F.lit(0))["hash"], F.coalesce(F.get(kids, F.lit(1))["hash"], F.lit(""))

        def child(kid, at):
            beside = F.struct(F.when(at == 1, first).otherwise("").alias("left"),
                              F.when(at == 0, second).otherwise("").alias("right"))
            path = F.when(F.col("height") > level, F.concat(F.array(beside), parent["path"]))
            return F.struct(kid.alias("node"), path.otherwise(parent["path"]).alias("path"))
        return F.transform(kids, child)
    return children


def _opened(blocks: DataFrame, base: int) -> DataFrame:
    """A row for every lowest node of the blocks with its path; ``path`` is the block's."""
    held = F.array(F.struct("node", "path"))
    keep = [c for c in blocks.columns if c not in ("node", "path", "block", "height")]
    rows = blocks.select("height", held.alias("held"), *keep)
    for level in reversed(range(base, base + BLOCK_LEVELS)):
        rows = rows.select("height", F.flatten(F.transform("held", _children(level))).alias("held"), *keep)
    # no array is empty; without _outer a filter would compute them all once more
    rows = rows.select(F.explode_outer("held").alias("held"), *keep)
    return rows.select(*keep, F.col("held.node.item").alias("item"), F.col("held.path").alias("path"))


def _paths(nodes: DataFrame, base: int, height: int, n_rows: int,
           finish: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``key, item, subroot, root, path`` of every node of ``key, height, rank, node``.

    ``finish`` gives ``key, subroot, root, path`` for the keys' last nodes."""
    blocks = stored(_nested(nodes, base), "merkle-blocks", n_rows * _ROW_BYTES)
    if base + BLOCK_LEVELS >= height:
        above = finish(blocks.select("key", F.col("node.hash").alias("hash")))
        return _opened(blocks.join(above, "key"), base)
    upper = blocks.select("key", "height", F.col("block").alias("rank"),
                          F.struct(F.col("node.hash").alias("hash"), F.struct("block").alias("item")).alias("node"))
    above = _paths(upper, base + BLOCK_LEVELS, height, -(-n_rows >> BLOCK_LEVELS), finish)
    above = above.select("key", F.col("item.block").alias("block"), "subroot", "root", "path")
    return _opened(blocks.join(above, ["key", "block"]), base)


def _tree(nodes: DataFrame, order: list[str], name: str, n_bytes: int,
          finish: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``_paths`` of ``key, hash, item`` rows; the leaves of a key are ranked by ``order``."""
    ordered = in_order(nodes, ["key", *order], name, n_bytes)
    sizes = ordered.groupBy("key").agg(F.count("*").alias("n")).agg(F.sum("n").alias("all"), F.max("n").alias("most")).first()
    height = ((sizes["most"] or 1) - 1).bit_length()
    ranked = with_rank(ordered, "key")
    return _paths(ranked.select("key", _height(F.col("total")).alias("height"), "rank",
                                F.struct("hash", "item").alias("node")), 0, height, sizes["all"] or 0, finish)


def _groups_tree(tops: DataFrame) -> DataFrame:
    """The tree over the groups' subroots."""
    rows = tops.select(F.lit("").alias("key"), "hash", F.struct(F.col("key").alias("group"), "hash").alias("item"))
    over = _tree(rows.withColumn("group", F.col("item.group")), ["group"], "merkle-groups", 0, _alone)
    return over.select(F.col("item.group").alias("key"), F.col("item.hash").alias("subroot"), "root", "path")


def _alone(tops: DataFrame) -> DataFrame:
    return tops.select("key", F.col("hash").alias("subroot"), F.col("hash").alias("root"),
                       F.array().cast(_PATH).alias("path"))


def merkle_proofs(docs: DataFrame, fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
                  id_col: str = "doc_id", group_col: str = "lang", carry: dict[str, Column] | None = None) -> DataFrame:
    """``id, leaf, <carry>, subroot, root, path`` of every row.

    ``path`` has a step for each level from the leaf to the root: the digest on the
    left or on the right of the node, empty where there is none; ``fold`` recomputes
    the root from it.  ``carry`` are further columns over the input (small ones:
    they travel with the leaf)."""
    text = group_col and F.col(group_col).cast("string")
    rows = docs.select(
        F.coalesce(F.concat(F.lit("="), text), F.lit("")).alias("key"),  # the null group sorts before all others
        leaf(*[docs[c] for c in fields]).alias("hash"), docs[id_col].alias("id"),
        *[c.alias(f"carry_{name}") for name, c in (carry or {}).items()])
    n_bytes = scanned_bytes(docs.select(*fields)) // 8
    rows = stored(rows, "merkle-leaves", n_bytes)
    carried = [F.col(f"carry_{name}").alias(name) for name in (carry or {})]
    # equal leaves are ordered by their place in the written table, so that many of them
    # are dealt to many range partitions
    nodes = rows.select("key", "hash", "id", F.monotonically_increasing_id().alias("place"),
                        F.struct("id", F.col("hash").alias("leaf"), *carried).alias("item"))
    found = _tree(nodes, ["id", "hash", "place"], "merkle-order", n_bytes, _groups_tree)
    return found.select("item.*", "subroot", "root", "path")


__all__ = ["BLOCK_LEVELS", "digest", "field", "fold", "leaf", "merkle_proofs", "proof_digest"]
