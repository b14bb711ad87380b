"""What several operators share: tables, staged intermediate results, words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.session import shared_dir

#: A word by the whitespace contract: a run of anything but ASCII whitespace.
SPACE_WORD = r"[^\x20\x09-\x0D]+"

BATCH_CONF, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder (``spark.checkpoint.dir``) and read back.

    Cuts the lineage so that a lost executor costs one stage, and freezes what
    several later branches read.
    """
    spark = df.sparkSession
    path = shared_dir(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def in_batches(df: DataFrame) -> DataFrame:
    """``df``, with its session dealing Arrow batches of at most ``BATCH_BYTES`` (or one row) to Python.

    Spark's default of 64 MB a batch is held several times over by each task;
    a session that has another setting keeps it.
    """
    conf = df.sparkSession.conf
    if conf.get(BATCH_CONF) == "67108864b":
        conf.set(BATCH_CONF, BATCH_BYTES)
    return df


def text_or_empty(col: str) -> Column:
    return F.coalesce(F.col(f"`{col}`").cast("string"), F.lit(""))


def keep_rows(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` whose id is in the one-column frame ``ids``; null matches null.

    All columns of ``docs`` stay as they are, whatever their names.
    """
    return docs.join(*_by_id(docs, ids, id_col), "left_semi")


def drop_rows(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` whose id is not in the one-column frame ``ids``; null matches null."""
    return docs.join(*_by_id(docs, ids, id_col), "left_anti")


def _by_id(docs: DataFrame, ids: DataFrame, id_col: str) -> tuple[DataFrame, Column]:
    """Both sides are dealt by id at every size, so a plan seen on little data holds on much."""
    mark = "id"
    while mark in docs.columns:
        mark += "_"
    marked = ids.select(F.col(f"`{ids.columns[0]}`").alias(mark)).distinct().hint("merge")
    return marked, F.col(f"`{id_col}`").eqNullSafe(F.col(mark))
