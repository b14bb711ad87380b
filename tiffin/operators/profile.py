"""Profiling of a raw table (P1-P6), each result a DataFrame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def shape(df: DataFrame, exclude: Sequence[str] = ("seq",)) -> DataFrame:
    """Rows, number of columns and the column list."""
    cols = [c for c in df.columns if c not in exclude]
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows", F.lit(len(cols)).alias("columns"), F.lit(", ".join(cols)).alias("column_names"))


def null_counts(df: DataFrame, exclude: Sequence[str] = ("seq",)) -> DataFrame:
    """(column_name, nulls) — one pass, then unpivot."""
    cols = [c for c in df.columns if c not in exclude]
    wide = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"c{i}") for i, c in enumerate(cols)])
    stack = ", ".join(f"'{c}', c{i}" for i, c in enumerate(cols))
    return wide.selectExpr(f"stack({len(cols)}, {stack}) as (column_name, nulls)")


def duplicate_count(df: DataFrame, key: str) -> DataFrame:
    """Occurrences after the first (NULL keys count as one value). P6 guard."""
    if key not in df.columns:
        return df.sparkSession.createDataFrame([], "column_name string, duplicates long")
    c = F.col(f"`{key}`")
    agg = df.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(c).alias("d"),
                 F.max(c.isNull().cast("int")).alias("has_null"))
    return agg.select(F.lit(key).alias("column_name"),
                      (F.col("n") - F.col("d") - F.coalesce(F.col("has_null"), F.lit(0))).cast("long").alias("duplicates"))


def distinct_samples(df: DataFrame, columns: dict[str, int], seq: str = "seq") -> DataFrame:
    """The first n distinct non-null values of each column, in first-seen order.

    Per column: distinct values with their first position (partial
    aggregation), then a per-column top-n (Spark plans a partial
    WindowGroupLimit before the shuffle, so each task ships at most n rows
    per column).
    """
    frames = []
    for c, n in columns.items():
        if c not in df.columns:        # P6: column-presence guard
            continue
        v = (df.where(F.col(f"`{c}`").isNotNull()).groupBy(F.col(f"`{c}`").cast("string").alias("value"))
             .agg(F.min(seq).alias("_first")))
        w = Window.orderBy("_first")
        frames.append(v.withColumn("sample_rank", F.row_number().over(w)).where(F.col("sample_rank") <= n)
                      .select(F.lit(c).alias("column_name"), "sample_rank", "value"))
    out = df.sparkSession.createDataFrame([], "column_name string, sample_rank int, value string")
    for f in frames:
        out = out.unionByName(f)
    return out
