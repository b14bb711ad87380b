"""Lookups and per-group values, left to Spark's own skew handling.

Any key may hold a third of all rows.  The rules here are: aggregate before a
join (a hot key is one row per map task then), join on plain equality with
both sides dealt by Spark itself, so that adaptive execution can split a
partition that a hot key makes large, and let Spark broadcast a side only by
its measured size.  There is one path at every size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup_join(big: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "left",
                null_safe: bool = False) -> DataFrame:
    """Join ``big`` to ``small``, which has at most one row per key.

    ``how`` is left, inner, left_semi or left_anti; ``null_safe`` matches null
    keys.  Columns: those of ``big``, then the other columns of ``small``.
    """
    keys = list(keys)
    side = small.select(*[F.col(f"`{c}`").alias(f"_r_{c}") if c in keys else F.col(f"`{c}`") for c in small.columns])
    on = [F.col(f"`{k}`").eqNullSafe(F.col(f"`_r_{k}`")) if null_safe else F.col(f"`{k}`") == F.col(f"`_r_{k}`")
          for k in keys]
    out = big.join(side, on, how)
    if how in ("left_semi", "left_anti"):
        return out
    return out.drop(*[f"_r_{k}" for k in keys])


def attach_group_aggs(df: DataFrame, keys: Sequence[str], aggs: Sequence[Column],
                      null_safe: bool = False) -> DataFrame:
    """Each row with aggregates of its group: ``agg(...) over (partition by keys)`` without a skewed window."""
    return lookup_join(df, df.groupBy(*keys).agg(*aggs), keys, "left", null_safe)
