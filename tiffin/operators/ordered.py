"""Global order without a single-partition window.

``row_number() over (order by k)`` without PARTITION BY moves every row into
one task.  Instead the rows are sorted globally (range partitioning) and
written to a reliable checkpoint, which freezes the partition layout; running
values are computed within each partition and offset by what the partitions
before it hold, a frame of one row per partition.  There is one path at every
size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiffin.session import cut_lineage

_LOW33 = (1 << 33) - 1
EXACT = "decimal(38,0)"


def sorted_partitions(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """``df`` globally sorted and frozen, with ``_pid`` and the 1-based ``_lpos`` within the partition."""
    frozen = cut_lineage(df.orderBy(*order))
    return (frozen.withColumn("_pid", F.spark_partition_id())
            .withColumn("_lpos", F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW33)) + 1))


def _before(per_partition: DataFrame, value: str, out: str) -> DataFrame:
    """(_pid, out): sum of ``value`` over the partitions before; one row per partition."""
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    return per_partition.select("_pid", F.coalesce(F.sum(value).over(w), F.lit(0)).alias(out))


def with_position(df: DataFrame, order: Sequence[Column | str], pos_col: str = "pos") -> DataFrame:
    """Add the 1-based global position of each row in ``order``.

    ``order`` must be a total order (add tie-breakers), otherwise ties are
    numbered in an arbitrary but fixed order.
    """
    local = sorted_partitions(df, order)
    offsets = _before(local.groupBy("_pid").agg(F.max("_lpos").alias("n")), "n", "_off")
    return (local.join(F.broadcast(offsets), "_pid")
            .withColumn(pos_col, (F.col("_off") + F.col("_lpos")).cast("long"))
            .drop("_pid", "_lpos", "_off"))


def dense_ids(df: DataFrame, order: Sequence[Column | str], id_col: str) -> DataFrame:
    """Surrogate key 1..N following ``order`` (a scalable ``row_number``)."""
    return with_position(df, order, id_col)


def with_prefix_sum(df: DataFrame, order: Sequence[Column | str], value: str, out_col: str = "cum") -> DataFrame:
    """Inclusive running sum of the integral column ``value`` in ``order``, exact as decimal(38,0)."""
    local = sorted_partitions(df.withColumn(value, F.col(value).cast(EXACT)), order)
    within = Window.partitionBy("_pid").orderBy("_lpos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = _before(local.groupBy("_pid").agg(F.sum(value).alias("n")), "n", "_off")
    return (local.withColumn("_cum", F.sum(value).over(within)).join(F.broadcast(offsets), "_pid")
            .withColumn(out_col, (F.coalesce(F.col("_cum"), F.lit(0)) + F.col("_off")).cast(EXACT))
            .drop("_pid", "_lpos", "_off", "_cum"))


def exact_median(df: DataFrame, value: str) -> DataFrame:
    """One-row frame with the exact (interpolated) median of the non-null values.

    From a histogram of the distinct values: equal values are one row, so a
    value that most rows share costs nothing.
    """
    counts = (df.select(F.col(value).alias("_v")).where(F.col("_v").isNotNull())
              .groupBy("_v").agg(F.count(F.lit(1)).alias("_n")))
    ranked = with_prefix_sum(counts, ["_v"], "_n", "_upto")
    n = ranked.select(F.max("_upto")).scalar()
    first = F.col("_upto") - F.col("_n")
    at = [F.floor((n + 1) / 2), F.floor(n / 2) + 1]
    pick = [F.when((first < k) & (F.col("_upto") >= k), F.col("_v")).alias(f"m{i}") for i, k in enumerate(at)]
    return ranked.select(*pick).agg(((F.max("m0") + F.max("m1")) / 2).alias("median"))
