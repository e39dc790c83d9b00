"""Sharding (native): minimax contiguous partition of atomic groups of equal texts.

Groups (equal texts) are ordered by the SHA-256 of their text.  The smallest
shard capacity that still fits all groups into the shards, filled greedily in
that order, is found by binary search; each cut is made where that capacity
allows it, at the latest where the greedy fill cuts and before that at the even
share, so that the last shards are not left short.  A group of at least a fair share of what is left gets a
shard of its own first, so one huge group doesn't leave other shards empty.

The order is not collected.  The driver sees a bounded summary: the summed
sizes of 4,096 ranges of the hash, and finer ones of ranges that the cuts of some
capacities between the bounds may fall into; one job refines them all, whatever their
lengths.  A fill with cuts at known ends of ranges, and one that
runs to the end of the range it stops in, bound the true fill; ranges are refined
until both agree whether the probed capacity fits.  When the summary has grown to
its limit the finer ranges are forgotten and the probe goes on from the first cuts to the last, so the
driver's share doesn't grow with the groups, and the capacity is exact.
DataFrame functions only.

Defined cases: a null text counts as the empty text (size = the overhead, crc32
0); repeated rows are rows of their own in the same group; a null id takes a
slot like any other; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_right
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlake.llm.common import scanned_bytes, stored

_HEX = 3          # hex digits of the first summary: 4,096 ranges
_WIDTH = 16       # ranges refined at either end of what is open for a cut
_ROUND = 1_250    # ranges refined by one job, unless one capacity alone opens more
_MOST = 100_000   # ranges at which finer ones are forgotten
_SLOT_ROWS = 200_000  # rows numbered by one task, about
_EQUAL_ROWS = 4096      # equal rows numbered together


class _Summary:
    """Ordered items (hash prefix, size, single) and the greedy fill over them."""

    def __init__(self, items: list[tuple[str, int, bool]]):
        self.items = items
        self.ends = [0, *accumulate(size for _, size, _ in items)]

    def upto(self, at: int, capacity: int) -> int:
        """Last item boundary that a shard from boundary ``at`` on reaches."""
        return bisect_right(self.ends, self.ends[at] + capacity) - 1

    def exact(self, at: int, capacity: int, end: int) -> bool:
        """No group inside item ``end`` could be added to the shard."""
        return end == len(self.items) or self.items[end][2] or self.ends[end] == self.ends[at] + capacity

    def fill(self, capacity: int, shards: int) -> list[tuple[int, int, int]]:
        """For each shard the earliest and the latest boundary at which the greedy
        fill may end it, and the last item that may hold this cut."""
        found, early, late = [], 0, 0
        for _ in range(shards):
            early, end = self.upto(early, capacity), self.upto(late, capacity)
            late = end if self.exact(late, capacity, end) else end + 1
            found.append((early, late, end))
        return found

    def smallest(self, low: int, high: int, shards: int, sure: bool) -> int:
        """Smallest capacity from ``low`` to ``high`` that fits for sure, or may fit."""
        while low < high:
            mid = (low + high) // 2
            if self.fill(mid, shards)[-1][0 if sure else 1] < len(self.items):
                low = mid + 1
            else:
                high = mid
        return low

    def opened(self, fill: list[tuple[int, int, int]]) -> list[int]:
        """Items to refine, in the order of the cuts: those at either end of what is
        open for a cut."""
        out: dict[int, None] = {}
        for early, late, end in fill:
            if early == late:
                continue
            held = range(early, min(end + 1, len(self.items)))
            near = held if len(held) <= 2 * _WIDTH else [*held[:_WIDTH], *held[-_WIDTH:]]
            out.update(dict.fromkeys(i for i in near if not self.items[i][2]))
        return list(out)

    def balanced(self, capacity: int, shards: int) -> tuple[list[int], list[int]]:
        """Cuts under the same capacity, each as near to its even share as the
        capacity and the rest allow (the greedy cut is the latest allowed one), and
        the items to refine before these are exact."""
        n = len(self.items)
        back = _Summary(self.items[::-1])
        fill = back.fill(capacity, shards - 1)  # from the end: the earliest cuts whose rest fits
        opened = [n - 1 - i for i in back.opened(fill)]
        nearest = []
        for shard in range(1, shards):
            even = self.ends[-1] * shard / shards
            near = bisect_right(self.ends, even) - 1
            if near < n and self.ends[near] < even and not self.items[near][2]:
                opened.append(near)
            elif near < n and even - self.ends[near] > self.ends[near + 1] - even:
                near += 1
            nearest.append(near)
        found, at = [], 0
        for shard in range(1, shards if not opened else 0):
            latest, wanted = self.upto(at, capacity), max(nearest[shard - 1], at, n - fill[shards - shard - 1][0])
            if wanted > latest and not self.exact(at, capacity, latest):
                return [], [latest]
            at = min(wanted, latest)
            found.append(at)
        return [x for x in found if x < n], list(dict.fromkeys(opened))


def _summed(groups: DataFrame, prefixes: list[str]) -> list[tuple[str, int, bool]]:
    """The ranges one digit finer than ``prefixes``, of any lengths, in one job.
    Their number is bounded by ``_MOST``, so they are collected at once."""
    by_digits: dict[int, list[str]] = {}
    for prefix in prefixes:
        by_digits.setdefault(len(prefix), []).append(prefix)
    finer = F.coalesce(*[
        F.when(F.substring("sha", 1, digits).isin(held), F.substring("sha", 1, digits + 1))
        for digits, held in sorted(by_digits.items())])
    rows = (groups.select(finer.alias("prefix"), "sha", "size").filter(F.col("prefix").isNotNull())
            .groupBy("prefix").agg(F.sum("size").alias("size"), F.count("*").alias("n"), F.min("sha").alias("sha"))
            .select("size", "n", F.when(F.col("n") == 1, F.col("sha")).otherwise(F.col("prefix")).alias("prefix")))
    return [(r["prefix"], r["size"], r["n"] == 1) for r in rows.collect()]


class _Ranges:
    """The summary of ``groups`` that the driver holds."""

    def __init__(self, groups: DataFrame):
        self.groups = groups
        self.first = self.now = _Summary(sorted(_summed(groups, [f"{i:0{_HEX - 1}x}" for i in range(16 ** (_HEX - 1))])))
        self.wide = True

    def refine(self, opened: list[int]) -> None:
        if self.wide and len(self.now.items) + 16 * len(opened) > _MOST:
            self.now, self.wide = self.first, False  # from here on, as far as there is room
            return
        chosen = set(opened if self.wide else opened[:max(1, (_MOST - len(self.now.items)) // 32)])
        items = [x for i, x in enumerate(self.now.items) if i not in chosen]
        items += _summed(self.groups, [self.now.items[i][0] for i in sorted(chosen)])
        self.now = _Summary(sorted(items))

    def around(self, low: int, high: int, shards: int) -> list[int]:
        """Items that keep capacities spread over the bracket undecided, those of its
        middle first, as many as there is room for."""
        wanted: dict[int, None] = {}
        for step in (4, 2, 6, 1, 7, 3, 5):
            opened = self.now.opened(self.now.fill(low + (high - low) * step // 8, shards))
            if wanted and len(wanted) + len(opened) > _ROUND:
                break
            wanted.update(dict.fromkeys(opened))
            if not self.wide:
                break
        return list(wanted)

    def decided(self) -> None:
        """The next probe starts afresh if this one had to forget."""
        if not self.wide:
            self.now, self.wide = self.first, True


def minimax_cuts(groups: DataFrame, shards: int, total: int, largest: int) -> tuple[int, list[str]]:
    """Smallest capacity and the hash prefix at which each further shard starts,
    for ``groups`` (sha, size) in the order of sha."""
    ranges = _Ranges(groups)
    low, high = max(-(-total // shards), largest), max(total, largest)
    while True:
        high = ranges.now.smallest(low, high, shards, sure=True)
        low = ranges.now.smallest(low, high, shards, sure=False)
        if low == high:
            break
        if ranges.wide:
            opened = ranges.around(low, high, shards)  # one job narrows the bracket from several capacities
            if opened:
                ranges.refine(opened)
                continue
        mid = (low + high) // 2
        while low <= mid < high:
            fill = ranges.now.fill(mid, shards)
            if fill[-1][0] == len(ranges.now.items):
                high = mid
            elif fill[-1][1] < len(ranges.now.items):
                low = mid + 1
            else:
                ranges.refine(ranges.now.opened(fill))
        ranges.decided()
    while True:
        cuts, opened = ranges.now.balanced(high, shards)
        if not opened:
            return high, [ranges.now.items[i][0] for i in cuts]
        ranges.refine(opened)


def minimax_shards(docs: DataFrame, n_shards: int, overhead: int = 16, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, text_sha256, shard, slot`` of every row.

    ``size`` is the text's UTF-8 bytes plus ``overhead``; ``slot`` numbers a
    shard's rows from 0 without gaps."""
    data = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(
        docs[id_col].cast("long").alias("doc_id"),
        (F.length(data) + overhead).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"), F.sha2(data, 256).alias("sha"))
    # a row of 90 bytes for each document: no more than a tenth of the text
    n_bytes = scanned_bytes(docs.select(text_col)) // 10
    # rows that agree in id and text are one row with their number
    rows = stored(rows.groupBy("doc_id", "sha").agg(
        F.first("size").alias("size"), F.first("text_crc32").alias("text_crc32"), F.count("*").alias("n")), "sized", n_bytes)
    groups = stored(rows.groupBy("sha").agg(F.sum(F.col("size") * F.col("n")).alias("size"), F.sum("n").alias("n")),
                    "groups", n_bytes)

    whole = groups.agg(F.sum("size"), F.sum("n")).first()
    total, n_rows = whole[0] or 0, whole[1] or 0
    top = [(r["sha"], r["size"]) for r in groups.orderBy(F.desc("size"), "sha").limit(n_shards).collect()]
    alone: list[str] = []
    left = total
    for sha, size in top:
        if len(alone) == n_shards - 1 or size * (n_shards - len(alone)) < left or size == left:
            break
        alone.append(sha)
        left -= size
    largest = top[len(alone)][1] if len(alone) < len(top) else 0
    rest = groups.filter(~F.col("sha").isin(alone)) if alone else groups
    _, starts = minimax_cuts(rest, n_shards - len(alone), left, largest) if left else (0, [])

    shard = reduce(lambda a, b: a + b, [(F.col("sha") >= s).cast("int") for s in starts], F.lit(0))
    for k, sha in enumerate(alone):
        shard = F.when(F.col("sha") == sha, F.lit(n_shards - 1 - k)).otherwise(shard)

    # slots: rows, and parts of many equal ones, are dealt to cells within their shard by
    # a hash, so a group of a third of all rows is numbered by many tasks
    cells = max(1, -(-n_rows // (_SLOT_ROWS * n_shards)), 8 if n_rows > 20_000 else 1)
    parts = rows.select("*", F.explode(F.expr(f"sequence(0L, (n - 1) div {_EQUAL_ROWS})")).alias("part"))
    placed = parts.select("doc_id", "size", "text_crc32", F.col("sha").alias("text_sha256"), "part",
                          F.least(F.lit(_EQUAL_ROWS), F.col("n") - F.col("part") * _EQUAL_ROWS).alias("n"),
                          shard.cast("int").alias("shard"),
                          F.pmod(F.xxhash64("doc_id", "sha", "part"), F.lit(cells)).cast("int").alias("cell"))
    counts = placed.groupBy("shard", "cell").agg(F.sum("n").alias("n"))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts_at = counts.select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = (Window.partitionBy("shard", "cell").orderBy("doc_id", "text_sha256", "part")
              .rowsBetween(Window.unboundedPreceding, -1))
    numbered = placed.withColumn("k", F.coalesce(F.sum("n").over(within), F.lit(0)))
    first = F.col("base") + F.col("k")
    return (numbered.join(starts_at, ["shard", "cell"])
            .select("doc_id", "size", "text_crc32", "text_sha256", "shard",
                    F.explode(F.sequence(first, first + F.col("n") - 1)).alias("slot")))


__all__ = ["minimax_cuts", "minimax_shards"]
