"""Mixing sources to target weights by hash-threshold histograms.

Sizes are summed by source and hash bucket.  A source's budget is a whole
number of full passes over it plus a part of one; the part is the documents
whose hash lies below a threshold.  The histogram's running sums show the
bucket in which the budget ends; only that bucket is refined, level by level,
until it is one hash value.  Taking the documents is a filter on their hash:
nothing is sorted, thresholds for smaller budgets are nested in larger ones,
and a rerun draws the same documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiffin.llm.common import SPACE_WORD, staged, text_or_empty

#: Bits of the hash and bits resolved by one histogram level.
HASH_BITS = 48
LEVEL_BITS = 12


def hash_of(id_col: Column, text: Column) -> Column:
    """A 48-bit hash of a document's id and text (leading bits of MD5)."""
    key = F.concat_ws("\n", F.coalesce(id_col.cast("string"), F.lit("")), text)
    return F.conv(F.substring(F.md5(key), 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: list[float], share: float, cap: float) -> DataFrame:
    """Targets of sources from (source, source_size): one row per source.

    Sources in code-point order, null last, weigh ``weights`` in turn and
    share ``share`` times the whole size by weight; none gets more than
    ``cap`` times its own size, and what one leaves the others share by
    weight.  That is target = min(cap * size, level * weight) for one water
    level, found from running sums over the sources ordered by the level at
    which each is full.  The frame has one row per source, already summed.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    full = F.col("source_size") * F.lit(float(cap))
    ranked = sizes.withColumn("weight", w).withColumn("full_at", full / F.col("weight"))
    by_level = Window.orderBy("full_at", F.col("source").isNull(), "source")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    after = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(1))
    # the level if all sources before this one are full and this and later ones are not
    level = ((F.sum("source_size").over(everything) * F.lit(float(share))
              - F.coalesce(F.sum(full).over(before), F.lit(0.0))) / F.sum("weight").over(after))
    tried = ranked.withColumn("level", level)
    # past the right one the levels only fall, before it none fits: the largest that fits is the level
    final = F.max(F.when(F.col("level") <= F.col("full_at"), F.col("level"))).over(everything)
    return tried.withColumn("final", final).select(
        "source", "source_size", "weight",
        F.when(F.col("final").isNull(), full)
        .otherwise(F.least(full, F.col("final") * F.col("weight"))).alias("target"))


def thresholds(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source: full passes and the hash below which one more copy is taken.

    ``rows`` has (source, hash, size).  Each level sums sizes by source and
    bucket of the boundary's next bits, at most 4096 rows a source, and
    descends into the bucket where the running sum passes what is left of the
    budget.  At one hash value the nearer of its two sides is taken.
    """
    bound = targets.select(
        "source", "source_size", "target",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
        .otherwise(F.lit(0)).cast("long").alias("passes"))
    bound = bound.select("source", "source_size", "target", "passes",
                         (F.col("target") - F.col("passes") * F.col("source_size")).alias("left"),
                         F.lit(0).cast("long").alias("prefix"))
    bound = staged(bound, "mix-bound")
    for shift in range(HASH_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        b = bound.select(F.col("source").alias("s"), "prefix")
        inside = rows.join(b,
                           rows["source"].eqNullSafe(b["s"])
                           & (F.shiftright(rows["hash"], shift + LEVEL_BITS) == b["prefix"])
                           ).select("source", F.shiftright("hash", shift).alias("bucket"), "size")
        hist = inside.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
        run = Window.partitionBy("source").orderBy("bucket")
        hist = hist.select("source", "bucket", "words", F.sum("words").over(run).alias("upto"))
        h = hist.alias("h")
        past = (bound.alias("b").join(h, F.expr("b.source <=> h.source AND h.upto > b.left"), "left")
                .groupBy("b.source", "b.source_size", "b.target", "b.passes", "b.left", "b.prefix")
                .agg(F.min(F.struct("h.bucket", "h.words", "h.upto")).alias("at")))
        # a source whose budget the bucket's rows never pass keeps all of it: threshold behind the bucket
        none = F.col("at.bucket").isNull()
        past = past.select(
            "source", "source_size", "target", "passes",
            F.when(none, F.lit(-1.0))
            .otherwise(F.col("left") - (F.col("at.upto") - F.col("at.words"))).alias("left"),
            F.when(none, F.shiftleft(F.col("prefix") + 1, LEVEL_BITS))
            .otherwise(F.col("at.bucket")).alias("prefix"),
            F.col("at.words").alias("words"))
        bound = staged(past, "mix-bound")
    nearer = (F.col("left") * 2 >= F.col("words")).cast("long")
    return bound.select("source", "source_size", "target", "passes",
                        (F.col("prefix") + F.coalesce(nearer, F.lit(0))).alias("threshold"))


def mix(docs: DataFrame, weights: list[float], share: float, cap: float = 2.0,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken.

    ``taken`` is ``copies * size``: the words the mix takes, repeats counted;
    ``copies`` is at most ``ceil(cap)``.  A null text has no words, a null
    source is a source of its own, an empty table gives an empty result.
    Rows that repeat id and text share a hash and are taken together.  Other
    columns are not read.
    """
    text = text_or_empty(text_col)
    rows = staged(docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").alias("source"),
        F.regexp_count(text, F.lit(SPACE_WORD)).cast("long").alias("size"),
        hash_of(F.col(f"`{id_col}`"), text).alias("hash")), "mix-rows")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    cut = thresholds(rows, source_targets(sizes, weights, share, cap))
    c = cut.withColumnRenamed("source", "of")
    copies = F.col("passes") + (F.col("hash") < F.col("threshold")).cast("long")
    return rows.join(c, rows["source"].eqNullSafe(c["of"])).select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"),
        (copies * F.col("size")).alias("taken"))
