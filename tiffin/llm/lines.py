"""Line dedup by overlapping windows of three lines.

Every three consecutive lines of a document are hashed; a window that occurs
more than once in the corpus stays where it occurs first, by (doc_id,
position), and the lines covered by its later occurrences are removed.
Covered stretches that overlap merge.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiffin.llm.common import staged, text_or_empty

WINDOW = 3


def line_array(text: Column) -> Column:
    return F.split(text, "\n", -1)


def window_hashes(lines: Column, width: int) -> Column:
    """The 128-bit hash of every ``width`` consecutive lines, in order; none for fewer lines."""
    def one(i):
        parts = [F.get(lines, i + j) for j in range(width)]
        return F.struct(F.xxhash64(*parts).alias("a"),
                        F.xxhash64(F.lit(width), *reversed(parts)).alias("b"))
    return F.when(F.size(lines) >= width,
                  F.transform(F.sequence(F.lit(0), F.size(lines) - width), one))


def window_table(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """One row per window: doc_id, check (hash of the text), pos, a, b."""
    text = text_or_empty(text_col)
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.xxhash64(text).alias("check"),
                       line_array(text).alias("lines"))
    # outer, as otherwise a filter on the array's size would hash everything twice
    return (rows.select("doc_id", "check", F.posexplode_outer(window_hashes(F.col("lines"), width)).alias("pos", "w"))
            .where(F.col("pos").isNotNull()).select("doc_id", "check", "pos", "w.a", "w.b"))


def later_windows(windows: DataFrame) -> DataFrame:
    """Per document the positions of windows that occur earlier: doc_id, check, later (sorted)."""
    first = (windows.groupBy("a", "b")
             .agg(F.min(F.struct("doc_id", "check", "pos")).alias("first"), F.count(F.lit(1)).alias("n"))
             .where("n > 1").drop("n"))
    w, f = windows.alias("w"), first.alias("f")
    later = w.join(f, F.expr("w.a = f.a AND w.b = f.b")).where(
        "NOT (w.doc_id <=> f.first.doc_id AND w.check = f.first.check AND w.pos = f.first.pos)")
    return (later.groupBy("w.doc_id", "w.check")
            .agg(F.sort_array(F.collect_set("w.pos")).alias("later")))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                width: int = WINDOW) -> DataFrame:
    """One row per input row: doc_id, text without the removed lines, n_lines, n_removed.

    Lines end at a line feed and are compared as they are.  A document of
    fewer than ``width`` lines has no window and stays; null counts as empty
    (one empty line).  Rows that repeat both doc_id and text are one document
    (each gets the same result); a null doc_id comes first.  A very long text
    costs time in proportion to its lines.  An empty table gives an empty
    result.  Other columns are not read.
    """
    later = staged(later_windows(staged(window_table(docs, id_col, text_col, width), "line-windows")),
                   "line-later")
    text = text_or_empty(text_col)
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("text"),
                       F.xxhash64(text).alias("check"))
    # dealt by key at every size: the texts move once, nothing depends on what would fit a broadcast
    r, g = rows.alias("r"), later.hint("merge").alias("g")
    got = r.join(g, F.expr("r.doc_id <=> g.doc_id AND r.check = g.check"), "left").select(
        "r.doc_id", "r.text", line_array(F.col("r.text")).alias("lines"), "g.later")
    covered = F.array_distinct(F.flatten(F.transform(
        "later", lambda p: F.sequence(p, p + F.lit(width - 1)))))
    got = got.withColumn("covered", F.when(F.col("later").isNotNull(), covered))
    # positions left by one hash set, as a search for each line would be quadratic in a document's lines
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("covered"))
    left = F.array_join(F.transform(kept, lambda i: F.get("lines", i)), "\n")
    return got.select(
        "doc_id",
        F.when(F.col("covered").isNull(), F.col("text")).otherwise(left).alias("text"),
        F.size("lines").cast("long").alias("n_lines"),
        F.when(F.col("covered").isNull(), F.lit(0)).otherwise(F.size("covered")).cast("long").alias("n_removed"))
