"""Dimension lookups.

A lookup is declared, not hinted: file statistics at planning time and AQE's
measured sizes at run time decide between a broadcast and a shuffle join, and AQE
splits skewed keys of the latter.  Nothing is counted and no job is started here.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def lookup_join(left: DataFrame, dim: DataFrame, on, how: str = "left", null_safe: bool = False) -> DataFrame:
    """``left ⟕ dim`` on the ``on`` columns (same names on both sides).

    ``null_safe`` matches NULL keys to each other (``<=>``), which the default
    star-schema build uses so that an unknown member gets its own key (D1).
    """
    on = [on] if isinstance(on, str) else list(on)
    if not null_safe:
        return left.join(dim, on, how)
    renamed = dim.select(*[F.col(c).alias(f"_k_{c}") if c in on else F.col(c) for c in dim.columns])
    cond = reduce(lambda a, b: a & b, [left[c].eqNullSafe(renamed[f"_k_{c}"]) for c in on])
    return left.join(renamed, cond, how).drop(*[f"_k_{c}" for c in on])
