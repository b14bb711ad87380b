"""Deterministic data operators from the order simulator.

The simulator itself is not rebuilt; its reusable cores are: imputation with
global statistics, popularity weights, weighted choice of a parent (a range
join of draw points), anchored amounts, residual allocation that
makes lines sum exactly to a total, and status-filtered children.  Weights,
sums and draw points are integers, so nothing depends on partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiffin.functions.numeric import cents, idiv
from tiffin.operators.joins import lookup_join
from tiffin.operators.ordered import EXACT, exact_median, with_prefix_sum
from tiffin.session import cut_lineage

# Fixed values of the draw: points modulo a prime 2^61 - 1, and the multiplier that spreads the keys.
POINT_MODULUS = (1 << 61) - 1
POINT_FACTOR = 1_181_783_497_276_652_981
#: Weights are taken to so many parts of one.
WEIGHT_SCALE = 1_000_000
#: Ranges of points that one array lists.
RANGES_AT_ONCE = 4096


def draw_point(key: Column, total: Column) -> Column:
    """A deterministic, evenly spread integer in [0, total) from an integer key."""
    part = F.pmod(key.cast(EXACT) * F.lit(POINT_FACTOR).cast(EXACT), F.lit(POINT_MODULUS).cast(EXACT)).cast("decimal(19,0)")
    return idiv(part * total.cast("decimal(19,0)"), F.lit(POINT_MODULUS))


def impute_stats(clean_restaurants: DataFrame) -> DataFrame:
    """G1: global mean rating and exact median cost (one row)."""
    mean = clean_restaurants.agg(F.avg("rating").alias("rating_mean"))
    med = exact_median(clean_restaurants, "avg_cost_for_two")
    return mean.select(F.round("rating_mean", 6).alias("rating_mean"),
                       med.select("median").scalar().alias("cost_median"))


def impute(clean_restaurants: DataFrame) -> DataFrame:
    """G1 + G2: fill missing rating/cost with the global mean/median; weight = (votes + 1) * rating."""
    stats = impute_stats(clean_restaurants)
    mean = stats.select("rating_mean").scalar()
    median = stats.select("cost_median").scalar()
    r = (clean_restaurants
         .withColumn("rating_filled", F.coalesce(F.col("rating"), mean))
         .withColumn("cost_filled", F.coalesce(F.col("avg_cost_for_two"), median)))
    return r.withColumn("weight", (F.coalesce(F.col("vote_count"), F.lit(0)) + 1) * F.col("rating_filled"))


def weighted_assignment(parents: DataFrame, children: DataFrame, parent_key: str, weight: str,
                        child_key: str) -> DataFrame:
    """Give each child one parent with probability proportional to weight.

    A parent owns the stretch of points from where the weights before it end
    (exact integer prefix sums) on; a child draws a point below the total.
    Points are dealt into as many equal ranges as there are parents, and a
    parent goes to each range that its stretch meets, so parents take at most
    twice their rows.  Drawn points are spread evenly, so no range is hot on
    the children's side, and a child is shuffled once, neither sorted globally
    nor written.
    """
    units = F.round(F.col(weight).cast("double") * WEIGHT_SCALE).cast(EXACT)
    p = parents.select(F.col(parent_key).alias("_pk"), units.alias("_w")).where(F.col("_w") > 0)
    cum = with_prefix_sum(p, ["_pk"], "_w", "_end")
    # one row: as values in the plan they are worked out once, and not by a subquery at each use
    end, n = cum.agg(F.max("_end"), F.count(F.lit(1))).first()
    total, ranges = (F.lit(int(x or 0)).cast("decimal(19,0)") for x in (end, n))

    def range_of(point: Column) -> Column:
        return idiv(point.cast("decimal(19,0)") * ranges, total).cast("long")
    owned = cum.select("_pk", (F.col("_end") - F.col("_w")).alias("_from"), "_end",
                       range_of(F.col("_end") - F.col("_w")).alias("_first"), range_of(F.col("_end") - 1).alias("_last"))
    # in two steps, as a heavy parent's stretch meets any number of ranges
    owned = owned.withColumn("_start", F.explode(F.sequence("_first", "_last", F.lit(RANGES_AT_ONCE).cast("long"))))
    owned = owned.select("_pk", "_from", "_end", F.explode(F.sequence(
        "_start", F.least(F.col("_last"), F.col("_start") + (RANGES_AT_ONCE - 1)))).alias("_range"))
    points = children.select(child_key, draw_point(F.col(child_key), total).alias("_at"))
    points = points.withColumn("_range", range_of(F.col("_at")))
    found = points.join(owned, (points["_range"] == owned["_range"]) & (F.col("_from") <= F.col("_at")) & (F.col("_at") < F.col("_end")))
    return found.select(points[child_key], F.col("_pk").alias(parent_key))


def anchored_amount_cents(cost: Column, party_size: Column, key: Column) -> Column:
    """cost/2 * party_size * factor, factor = (80 + key % 41) / 100, in whole cents (half up)."""
    factor_pct = F.lit(80) + F.pmod(key, F.lit(41))
    in_cents = F.round(cost.cast("decimal(20,6)"), 2)
    return idiv(cents(in_cents) * party_size * factor_pct + 100, F.lit(200)).cast("long")


def allocate_residual(lines: DataFrame, group: str, line: str, weight: str, total_cents: str) -> DataFrame:
    """Split each group's total across its lines in proportion to weight.

    Every line but the last gets floor(total * w / W) cents; the last line
    gets the remainder, so the lines sum exactly to the total.  A group whose
    weights sum to zero is split evenly.  The lines are written once; both
    group sums are aggregations joined back.
    """
    lines = cut_lineage(lines)
    sums = lines.groupBy(group).agg(F.sum(weight).alias("_W"), F.max(line).alias("_last"), F.count(F.lit(1)).alias("_n"))
    g = lookup_join(lines, sums, [group])
    zero = F.col("_W") == 0
    share = idiv(F.col(total_cents).cast(EXACT) * F.when(zero, F.lit(1)).otherwise(F.col(weight)),
                 F.when(zero, F.col("_n")).otherwise(F.col("_W")))
    g = cut_lineage(g.withColumn("_share", F.when(F.col(line) != F.col("_last"), share))
                    .select(*lines.columns, "_last", "_share"))
    g = lookup_join(g, g.groupBy(group).agg(F.sum("_share").alias("_others")), [group])
    alloc = F.when(F.col(line) == F.col("_last"),
                   F.col(total_cents) - F.coalesce(F.col("_others"), F.lit(0))).otherwise(F.col("_share"))
    return g.select(group, line, weight, (alloc / 100).cast("decimal(18,2)").alias("allocated"))


def status_children(parents: DataFrame, status_col: str, excluded: str, minutes: Column,
                    floor_minutes: int = 10) -> DataFrame:
    """Children only for parents not in ``excluded`` status; minutes floored."""
    return parents.where(F.col(status_col) != excluded) \
                  .withColumn("delivery_time_minutes", F.greatest(F.lit(floor_minutes), minutes).cast("int"))
