"""Conversation structure repair: cheapest edits that give every conversation legal roles.

Rows of a conversation become symbols, one for each pair of role initial and fault, and
conversations become strings of them.  Equal strings are kept once.  Re-Pair replaces
the most frequent pairs of symbols in all strings by new symbols, round by round; the
pairs of a round share no inner symbol, so their order doesn't matter.  A symbol stands
for a transfer matrix over the four states of ``(s?(ua)+)?``: the least cost from state
to state, and the audit that reaches it as a rope of its parts' audits.  A rule's
matrix is the min-plus product of its two symbols', made once, bottom up, and shared by
all conversations; a string's is the product over what is left of it.

    state 0 nothing yet, 1 after s, 2 after u (an a is due), 3 after a; 0 and 3 accept

In a matrix inserts come before their row's edit, so no audit of one cell is the
beginning of another, and the ASCII-least audit of a product is made of least parts.

A conversation may hold a third of all rows: rows are sorted over range partitions, its
string is cut into chunks of at most 512 symbols, and chunk matrices are multiplied in
groups of 32, level by level.  Only its text passes one task, row by row in order, for
the one SHA-256 that the repaired conversation has.

Defined cases: null roles and texts count as one space, null turns come first, rows of
one turn are ordered by role and then by a hash of role and text (equal rows are
interchangeable); null conversation ids are one conversation; a role without initial
s, u or a, the empty one included, can't be kept; an empty table gives an empty
result; further columns are left out.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlake.llm.common import ASCII_SPACE, forget, record_batch, scanned_bytes, slices, stored
from fleetlake.llm.ranges import in_order, with_rank

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5  # costs; the last for a truncated row that stays

CHUNK_BITS = 9      # symbols of a chunk: 512
GROUP_BITS = 5      # chunks multiplied at once: 32
BATCH = 128         # rules of a round, at most
MAX_RULES = 1024    # rules of the grammar; what is left of a string is multiplied symbol by symbol
LEAST_SAVING = 0.01  # a round that saves a smaller share of the symbols isn't worth its jobs

_ROLES = "sua"
_FINE, _CUT, _BLANK, _AGAIN = range(4)  # faults of a row
_N_SYMBOLS = 16
_FIRST_RULE = 0x100
_NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_ACCEPTS = (0, 3)

Cell = tuple[int, object] | None   # cost and rope: a text or a pair of ropes
Matrix = list[list[Cell]]


def text_of(rope) -> str:
    parts, stack = [], [rope]
    while stack:
        rope = stack.pop()
        if isinstance(rope, str):
            parts.append(rope)
        else:
            stack += rope[::-1]
    return "".join(parts)


def _less(a: Cell, b: Cell) -> bool:
    """Whether ``a`` is cheaper, or as cheap with the smaller audit."""
    if b is None or a is None:
        return a is not None
    return a[0] < b[0] or a[0] == b[0] and text_of(a[1]) < text_of(b[1])


def product(left: Matrix, right: Matrix) -> Matrix:
    out: Matrix = [[None] * 4 for _ in range(4)]
    for i in range(4):
        for j in range(4):
            for k in range(4):
                if left[i][k] is not None and right[k][j] is not None:
                    cell = (left[i][k][0] + right[k][j][0], (left[i][k][1], right[k][j][1]))
                    if _less(cell, out[i][j]):
                        out[i][j] = cell
    return out


def _inserts(state: int) -> list[tuple[int, str]]:
    """States reached by inserts alone; more than two lead nowhere new."""
    due = lambda s: 3 if s == 2 else 2
    return [(state, ""), (due(state), "I"), (due(due(state)), "II")]


def row_matrix(symbol: str) -> Matrix:
    """Edits of one row, with the inserts before it."""
    role, fault = divmod(ord(symbol) - ord("A"), 4)
    out: Matrix = [[None] * 4 for _ in range(4)]
    for i in range(4):
        for state, inserted in _inserts(i):
            edits = [(state, DELETE, "D")]
            if fault in (_FINE, _CUT):
                extra = TRUNCATED if fault == _CUT else 0
                if role < 3 and (state, _ROLES[role]) in _NEXT:
                    edits.append((_NEXT[state, _ROLES[role]], KEEP + extra, "K"))
                edits += [(_NEXT[state, r], REROLE + extra, "R") for r in "ua" if (state, r) in _NEXT]
            for j, cost, letter in edits:
                cell = (cost + INSERT * len(inserted), inserted + letter)
                if _less(cell, out[i][j]):
                    out[i][j] = cell
    return out


UNIT: Matrix = [[(0, "") if i == j else None for j in range(4)] for i in range(4)]


def finished(matrix: Matrix) -> tuple[int, str]:
    """Least cost and audit from the start to an accepting state, inserts at the end included."""
    best: Cell = None
    for state in range(4):
        for j, inserted in _inserts(state):
            if matrix[0][state] is not None and j in _ACCEPTS:
                cell = (matrix[0][state][0] + INSERT * len(inserted), (matrix[0][state][1], inserted))
                if _less(cell, best):
                    best = cell
    return best[0], text_of(best[1])


class Grammar:
    """Rules (pairs of symbols, in the order they were made) and the matrices of all symbols."""

    def __init__(self, rules: list[str]):
        self.matrices = {chr(ord("A") + i): row_matrix(chr(ord("A") + i)) for i in range(_N_SYMBOLS)}
        for i, (left, right) in enumerate(rules):
            self.matrices[chr(_FIRST_RULE + i)] = product(self.matrices[left], self.matrices[right])

    def matrix(self, packed: str) -> Matrix:
        return reduce(product, [self.matrices[c] for c in packed]) if packed else UNIT


def _cells(matrix: Matrix) -> list[dict | None]:
    return [None if c is None else {"cost": c[0], "audit": text_of(c[1])} for row in matrix for c in row]


def _matrix(cells: list[dict | None]) -> Matrix:
    flat = [None if c is None else (c["cost"], c["audit"]) for c in cells]
    return [flat[4 * i:4 * i + 4] for i in range(4)]


def _initials(seq: str) -> str:
    return "".join((_ROLES + "-")[(ord(c) - ord("A")) // 4] for c in seq)


def _illegal(initials: str) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


_STATS = ("blank", "duplicate", "truncated", "illegal")
_CELLS = pa.list_(pa.struct([("cost", pa.int64()), ("audit", pa.string())]))
_SEQUENCE = pa.schema([("seq", pa.string()), ("cells", _CELLS), ("cost", pa.int64()), ("audit", pa.string()),
                       *[(s, pa.int64()) for s in _STATS], ("first", pa.string()), ("last", pa.string())])
_PART = pa.schema([("conv", pa.string()), ("rank", pa.int64()), *list(_SEQUENCE)[1:]])
_DDL = {pa.string(): "string", pa.int64(): "long", _CELLS: "array<struct<cost:long,audit:string>>"}


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"`{f.name}` {_DDL[f.type]}" for f in schema)


def re_pair(seqs: DataFrame) -> tuple[DataFrame, list[str]]:
    """``seq, packed`` and the rules; ``seqs`` holds the distinct strings ``seq``.

    A round counts all pairs in all strings; the driver gets the most frequent ones."""
    packed, rules = stored(seqs.select("seq", F.col("seq").alias("packed")), "sequences", 0), []
    while len(rules) < MAX_RULES:
        long = packed.filter(F.length("packed") > 1)
        pairs = long.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("packed") - 1),
                                                  lambda i: F.substring("packed", i, F.lit(2)))).alias("pair"))
        counts = pairs.groupBy("pair").agg(F.count("*").alias("n"))
        # the window is over the counts: at most the square of the symbols
        found = counts.select("pair", "n", F.sum("n").over(Window.partitionBy()).alias("all")) \
            .orderBy(F.desc("n"), "pair").limit(4 * BATCH).collect()
        chosen, heads, tails = [], set(), set()
        for row in found:
            head, tail = row["pair"]
            alone = head == tail  # runs of one symbol pair up from the left
            if row["n"] < 2 or len(chosen) == BATCH or len(rules) + len(chosen) == MAX_RULES:
                break
            if head in tails or tail in heads or alone and (head in heads or tail in tails):
                continue
            chosen.append(row)
            heads.add(head)
            tails.add(tail)
        if not chosen or sum(r["n"] for r in chosen) < LEAST_SAVING * found[0]["all"]:
            break
        smaller = F.col("packed")
        for row in chosen:
            smaller = F.replace(smaller, F.lit(row["pair"]), F.lit(chr(_FIRST_RULE + len(rules))))
            rules.append(row["pair"])
        before, packed = packed, stored(packed.select("seq", smaller.alias("packed")), "sequences", 0)
        forget(before)
    return packed, rules


def _evaluated(packed: DataFrame, rules: list[str]) -> DataFrame:
    def evaluate(batches):
        grammar = Grammar(rules)
        for seqs, strings in slices(batches, ("seq", "packed")):
            rows = []
            for seq, string in zip(seqs, strings):
                matrix, initials = grammar.matrix(string), _initials(seq)
                faults = [sum(seq.count(chr(ord("A") + 4 * r + f)) for r in range(4)) for f in (_BLANK, _AGAIN, _CUT)]
                rows.append((seq, _cells(matrix), *finished(matrix), *faults, _illegal(initials), initials[0], initials[-1]))
            yield record_batch(_SEQUENCE, *zip(*rows))

    return packed.mapInArrow(evaluate, _ddl(_SEQUENCE))


def _multiplied(key, table):
    """The chunks of one group, by rank, as one."""
    rows = sorted(table.to_pylist(), key=lambda r: r["rank"])
    matrix = reduce(product, [_matrix(r["cells"]) for r in rows])
    matrix = [[c and (c[0], text_of(c[1])) for c in row] for row in matrix]
    stats = {s: sum(r[s] for r in rows) for s in _STATS}
    stats["illegal"] += sum(_illegal(a["last"] + b["first"]) for a, b in zip(rows, rows[1:]))
    cost, audit = finished(matrix)
    one = {"conv": rows[0]["conv"], "rank": key[1].as_py(), "cells": _cells(matrix), "cost": cost,
           "audit": audit, **stats, "first": rows[0]["first"], "last": rows[-1]["last"]}
    return pa.Table.from_pylist([one], schema=_PART)


def _whole(chunks: DataFrame) -> DataFrame:
    """``conv, cost, audit, <stats>`` from the evaluated chunks."""
    keep = ["conv", "cost", "audit", *_STATS]
    sizes = chunks.groupBy("conv").agg(F.count("*").alias("n"))
    split = stored(sizes.filter("n > 1").select("conv"), "conversations", 0)
    single = chunks.join(split, "conv", "left_anti").select(*keep)
    several = with_rank(chunks.join(split, "conv", "left_semi").withColumnRenamed("block", "mid"), "conv")
    parts = stored(several.select(*_PART.names), "chunks", 0)
    while (parts.agg(F.max("rank")).first()[0] or 0) > 0:
        groups = parts.groupBy("conv", F.shiftright("rank", GROUP_BITS).alias("group"))
        before, parts = parts, stored(groups.applyInArrow(_multiplied, _ddl(_PART)), "chunks", 0)
        forget(before)
    return single.unionByName(parts.select(*keep))


def _symbols(rows: DataFrame) -> DataFrame:
    """``conv, turn, role, ident, code``: what the order and the faults need of a row."""
    bare = F.rtrim("text", F.lit(ASCII_SPACE))
    initial = F.substring("role", 1, 1)
    role = reduce(lambda c, r: c.when(initial == r, 4 * _ROLES.index(r)), _ROLES[1:], F.when(initial == _ROLES[0], 0))
    fault = F.when(bare == "", _BLANK).when(F.right(bare, F.lit(1)).isin(".", "!", "?"), _FINE).otherwise(_CUT)
    return rows.select("conv", "turn", "role", _ident().alias("ident"), (role.otherwise(12) + fault).alias("code"))


def _ident() -> Column:
    """Tells rows of a conversation apart by role and text."""
    return F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256))


def _chunks(rows: DataFrame, n_bytes: int) -> DataFrame:
    """``conv, pid, block, seq``: strings of at most 512 symbols, in the order of block."""
    ordered = in_order(_symbols(rows), ["conv", "turn", "role", "ident"], "turns", n_bytes)
    fault = F.col("code") % 4
    again = ordered.filter(fault != _BLANK).groupBy("conv", "ident").agg(F.min("mid").alias("first_mid"), F.count("*").alias("n"))
    # written before it is joined: AQE splits a hot key only between two plain exchanges
    again = stored(again.filter("n > 1").select("conv", "ident", "first_mid"), "repeated-turns", n_bytes)
    code = F.when((fault != _BLANK) & (F.col("mid") > F.col("first_mid")), F.col("code") - fault + _AGAIN).otherwise(F.col("code"))
    marked = ordered.join(again, ["conv", "ident"], "left").select(
        "conv", "pid", "mid", F.shiftright("mid", CHUNK_BITS).alias("block"), F.char(code + ord("A")).alias("symbol"))
    symbols = F.array_sort(F.collect_list(F.struct("mid", "symbol")))
    return marked.groupBy("conv", "pid", "block").agg(
        F.array_join(F.transform(symbols, lambda s: s["symbol"]), "").alias("seq"))


def _gaps(rows: DataFrame) -> DataFrame:
    """Turns missing between a conversation's first and last."""
    turns = rows.filter("turn IS NOT NULL").select("conv", "turn").distinct()
    wide = F.col("turn").cast("decimal(20,0)")
    span = F.max(wide) - F.min(wide) + 1 - F.count("*")
    return turns.groupBy("conv").agg(span.try_cast("long").alias("gaps"))


_RESULT = pa.schema([("conv", pa.string()), ("gaps", pa.int64()), *[(s, pa.int64()) for s in _STATS],
                     ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())])


class _Repair:
    """Applies one conversation's audit to its rows as they come."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.sha, self.empty = audit, 0, 0, hashlib.sha256(), True

    def _add(self, role: str, text: str) -> None:
        self.state = _NEXT[self.state, role[0]]
        self.sha.update(("" if self.empty else "\n").encode() + f"{role}:{text}".encode("utf-8", "surrogatepass"))
        self.empty = False

    def _due(self) -> str:
        return "assistant" if self.state == 2 else "user"

    def _insert(self) -> None:
        while self.audit[self.at:self.at + 1] == "I":
            self._add(self._due(), "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self._insert()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            self._add(role if edit == "K" else self._due(), text)

    def digest(self) -> str:
        self._insert()
        return self.sha.hexdigest()


def _repaired(heads: DataFrame, rows: DataFrame) -> DataFrame:
    """The heads with the digest of their repaired rows, which stream past in order."""
    numbers = ["gaps", *_STATS, "cost"]
    head = heads.select("conv", F.lit(0).alias("kind"), *numbers, "audit", *[F.lit(None).cast(t).alias(c) for c, t in
                        (("turn", "long"), ("role", "string"), ("ident", "binary"), ("text", "string"))])
    body = rows.select("conv", F.lit(1).alias("kind"), *[F.lit(None).cast("long").alias(c) for c in numbers],
                       F.lit(None).cast("string").alias("audit"), "turn", "role", _ident().alias("ident"), "text")
    order = ["conv", "kind", F.col("turn").asc_nulls_first(), "role", "ident"]
    stream = head.unionByName(body).repartition("conv").sortWithinPartitions(*order).drop("turn", "ident")

    def repair(batches):
        held = None
        for part in slices(batches, ("conv", *numbers, "audit", "kind", "role", "text")):
            done = []
            for conv, *stats, audit, kind, role, text in zip(*part):
                if kind == 0:
                    if held:
                        done.append((*held[0], held[1].digest()))
                    held = (conv, *stats, audit), _Repair(audit)
                else:
                    held[1].row(role, text)
            if done:
                yield record_batch(_RESULT, *zip(*done))
        if held:
            yield record_batch(_RESULT, *zip((*held[0], held[1].digest())))

    return stream.mapInArrow(repair, _ddl(_RESULT))


def repair_conversations(rows: DataFrame, every: DataFrame | None = None) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``
    of each conversation of ``rows`` (conv_id, turn, role, text).

    ``every`` (conv_id) may name further conversations, which have no rows."""
    conv = F.coalesce(F.col("conv_id").cast("string"), F.lit(""))
    n_bytes = scanned_bytes(rows)
    rows = rows.select(conv.alias("conv"), F.col("turn").cast("long").alias("turn"),
                       F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    chunks = stored(_chunks(rows, n_bytes), "turn-strings", n_bytes // 4)
    packed, rules = re_pair(chunks.select("seq").distinct())
    values = stored(_evaluated(packed, rules), "matrices", 0)
    found = _whole(chunks.join(values, "seq").drop("seq"))
    heads = found.join(_gaps(rows), "conv", "left")
    if every is not None:
        heads = every.select(conv.alias("conv")).distinct().join(heads, "conv", "left")
    numbers = ["gaps", *_STATS, "cost"]
    heads = heads.select("conv", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers],
                         F.coalesce("audit", F.lit("")).alias("audit"))
    out = _repaired(heads, rows)
    return out.select(F.nullif("conv", F.lit("")).cast("long").alias("conv_id"), *out.columns[1:])


def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with faults put in by the checksum of ``conv_id:turn``
    modulo 20: 0 drops a row, 1 empties it, 2 takes its end marks, 3 repeats it, 4 makes it
    the user's."""
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                    F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(name.cast("binary")) % 20
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    return rows.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1))).alias("copy"), kind.alias("kind")) \
        .filter("kind <> 0").drop("copy", "kind")


__all__ = ["Grammar", "damaged", "finished", "product", "re_pair", "repair_conversations", "row_matrix", "text_of"]
