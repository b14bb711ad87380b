"""Exact dedup: a tree merge of sorted digest runs.

Every scan partition becomes one run of (digest, length, check hash) entries,
written sorted by digest.  Runs then meet in rounds as in a binomial
reduction, ``fan_in`` neighbouring runs at a time; every round merges equal
entries and retains the identifier to keep and the number of copies.  After
the last round there is one run, dealt by digest over all tasks.

A digest entry is SHA-256 of the whole text together with its byte length and
an independent 64-bit hash; entries merge only if all three agree, which is
the verification at each level.  Equal entries combine before each exchange,
so that a text which makes up a third of the corpus is one entry per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiffin.llm.common import drop_rows, keep_rows, staged, text_or_empty

ENTRY = ["digest", "n_bytes", "check"]


def digest_runs(docs: DataFrame, text: Column, id_col: str = "doc_id") -> DataFrame:
    """One row per document with its entry and run; each file is a run sorted by digest."""
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.monotonically_increasing_id().alias("row"),
        F.spark_partition_id().alias("run"),
        text.alias("t"))
    rows = rows.select(
        "doc_id", "row", "run",
        F.unhex(F.sha2(F.col("t"), 256)).alias("digest"),
        F.octet_length("t").alias("n_bytes"),
        F.xxhash64("t").alias("check"))
    return staged(rows.sortWithinPartitions("digest"), "digest-runs")


def merge_runs(runs: DataFrame, keep: str = "max", fan_in: int = 8) -> DataFrame:
    """Merge the runs round by round: one row per distinct text with the row to keep and its copies.

    ``keep`` is ``max`` or ``min`` of (doc_id, row).  The number of rounds is
    the logarithm of the number of runs to the base ``fan_in``.
    """
    best = F.max if keep == "max" else F.min
    last_run = runs.agg(F.max("run")).first()[0] or 0
    level = runs.groupBy("run", *ENTRY).agg(
        best(F.struct("doc_id", "row")).alias("keeper"), F.count(F.lit(1)).alias("copies"))
    while last_run > 0:
        last_run //= fan_in
        level = (level.withColumn("run", F.floor(F.col("run") / fan_in).cast("int"))
                 .groupBy("run", *ENTRY)
                 .agg(best("keeper").alias("keeper"), F.sum("copies").alias("copies")))
    return level.drop("run")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     keep: str = "max", normalise=None, fan_in: int = 8) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    ``normalise`` maps the text column to the text that is compared (default:
    no change).  Null texts count as empty and are copies of one another.  Of
    rows that tie on the kept doc_id (repeated rows) exactly one has
    ``kept``.  A null doc_id is smaller than any other.  An empty table gives
    an empty result; further columns of the input are not read.
    """
    text = text_or_empty(text_col)
    runs = digest_runs(docs, normalise(text) if normalise else text, id_col)
    groups = merge_runs(runs, keep, fan_in).where("copies > 1")
    groups = groups.select(*[F.col(c).alias(f"g_{c}") for c in ENTRY], "keeper", "copies")
    same = [F.col(c) == F.col(f"g_{c}") for c in ENTRY]
    joined = runs.join(groups, same, "left").select("doc_id", "row", "digest", "keeper", "copies")
    single = F.col("keeper").isNull()
    return joined.select(
        "doc_id",
        F.when(single, F.col("doc_id")).otherwise(F.col("keeper.doc_id")).alias("keep_id"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("group_size"),
        (single | (F.col("row") == F.col("keeper.row"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          keep: str = "max") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rows are filtered by doc_id.  Of rows that share a doc_id those with a
    kept text stay, one for each text.
    """
    found = staged(exact_duplicates(docs, id_col, text_col, keep), "exact-found")
    repeated = staged(found.groupBy("doc_id").count().where("count > 1").select("doc_id"), "exact-repeated")
    if repeated.isEmpty():
        return keep_rows(docs, found.where("kept").select("doc_id"), id_col)
    # ids that several rows share: of these rows the ones with a kept text, once each
    single = drop_rows(found.where("kept").select("doc_id"), repeated)
    again = keep_rows(docs, repeated, id_col)
    mark = "kept_text"
    while any(c.startswith(mark) for c in docs.columns):
        mark += "_"
    again = again.withColumn(mark, F.sha2(text_or_empty(text_col), 256))
    texts = keep_rows(found.where("kept"), repeated).select(
        F.col("text_sha256").alias(mark + "_of"), F.col("doc_id").alias(mark + "_id"))
    again = again.join(texts, (F.col(mark) == F.col(mark + "_of"))
                       & F.col(f"`{id_col}`").eqNullSafe(F.col(mark + "_id")), "left_semi")
    again = again.dropDuplicates([mark]).drop(mark)
    return keep_rows(docs, single, id_col).unionByName(again)
