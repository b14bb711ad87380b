"""Pipeline-health views (Q24-Q30) over the run-metadata tables.

``validation_runs``: run_at, total_valid, total_rejected, rejection_rate.
``test_runs``:       run_at, total_tests, passed_tests.
Both are append-only tables (S11); these queries only read them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiffin.functions.numeric import round_ratio
from tiffin.operators import dq
from tiffin.operators.joins import lookup_join
from tiffin.operators.validate import REJECTION_RATE_THRESHOLD
from tiffin.session import cut_lineage

# Fixed value: display format of a run time in the recent-runs table.
RUN_FORMAT = "MMM dd, HH:mm"


def latest(runs: DataFrame) -> DataFrame:
    """Q24: the row with the latest run_at (one row)."""
    return runs.orderBy(F.desc("run_at")).limit(1)


def validation_trend(runs: DataFrame) -> DataFrame:
    """Q25: rate per run plus rows ingested (valid + rejected)."""
    return (runs.select("run_at", "total_valid", "total_rejected", "rejection_rate",
                        (F.col("total_valid") + F.col("total_rejected")).alias("ingested"))
            .orderBy("run_at"))


def test_trend(runs: DataFrame) -> DataFrame:
    """Q26: total and passed tests per run."""
    return runs.select("run_at", "total_tests", "passed_tests").orderBy("run_at")


def health_kpis(validation_runs: DataFrame, test_runs: DataFrame,
                healthy_below: float = REJECTION_RATE_THRESHOLD) -> DataFrame:
    """Q27, Q29, Q30: headline numbers of the latest runs (one row).

    Both inputs are reduced to one row with ``max_by`` (a global aggregate,
    partial per task) and combined as scalars.  pass_rate is 0 without tests;
    healthy compares the latest *overall* rate (strictly below the threshold).
    """
    v = validation_runs.agg(
        F.max("run_at").alias("run_at"),
        F.max_by("total_valid", "run_at").alias("v"),
        F.max_by("total_rejected", "run_at").alias("r"),
        F.max_by("rejection_rate", "run_at").alias("rate"))
    t = test_runs.agg(F.max_by("total_tests", "run_at").alias("tt"),
                      F.max_by("passed_tests", "run_at").alias("pt"))
    tt = F.coalesce(t.select("tt").scalar(), F.lit(0)).cast("long")
    pt = F.coalesce(t.select("pt").scalar(), F.lit(0)).cast("long")
    return v.select(
        "run_at",
        (F.coalesce(F.col("v"), F.lit(0)) + F.coalesce(F.col("r"), F.lit(0))).cast("long").alias("rows_ingested"),
        F.coalesce(F.col("r"), F.lit(0)).cast("long").alias("rejected_rows"),
        F.coalesce(F.col("rate"), F.lit(0.0)).cast("double").alias("rejection_rate"),
        tt.alias("total_tests"), pt.alias("passed_tests"),
        (tt - pt).alias("failed_tests"),
        F.coalesce(round_ratio(pt, tt, 2, scale=100), F.lit(0.0)).alias("pass_rate_pct"),
        (F.coalesce(F.col("rate"), F.lit(0.0)) < F.lit(healthy_below)).alias("healthy"),
    )


def recent_runs(runs: DataFrame, n: int = 8) -> DataFrame:
    """Q28: the last n validation runs as display rows."""
    top = runs.orderBy(F.desc("run_at")).limit(n)
    total = F.col("total_valid") + F.col("total_rejected")
    pct = round_ratio("total_rejected", total, 2, scale=100)
    return top.select(
        F.date_format("run_at", RUN_FORMAT).alias("run"),
        F.col("total_valid").alias("valid"),
        F.col("total_rejected").alias("rejected"),
        F.concat(F.coalesce(pct, F.lit(0.0)).cast("string"), F.lit("%")).alias("rejection_pct"),
        "run_at",
    )


# ------------------------------------------------------------- run logs
def _run_at() -> Column:
    return F.make_timestamp_ntz(F.col("y") + 1, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)).alias("run_at")


def order_years(raw_orders: DataFrame) -> DataFrame:
    """(order_id, y): the year of each order, by its first date."""
    return (raw_orders.where(F.col("order_id").isNotNull())
            .groupBy("order_id").agg(F.year(F.min("order_date")).alias("y")))


def validation_runs_by_year(masters: dict[str, DataFrame], by_order: DataFrame, raw_orders: DataFrame,
                            reason_col: str = "reject_reason") -> DataFrame:
    """A validation-run log derived from data: one run per order year, over all six entities.

    ``masters`` are the outcomes of ``validate.master_outcomes``, ``by_order``
    those of ``validate.order_outcomes``.  Orders, items, payments and
    deliveries belong to the year of their order; rows without a year are part
    of the first run.  Restaurants and customers are master data and count in
    every run.  run_at is 1 January of the following year.  (The pipeline
    appends real runs.)
    """
    good = F.col(reason_col).isNull()
    sums = [F.coalesce(F.sum(F.when(good, F.col("rows"))), F.lit(0)).alias("valid"),
            F.coalesce(F.sum(F.when(~good, F.col("rows"))), F.lit(0)).alias("rejected")]
    first = raw_orders.select(F.min(F.year("order_date"))).scalar()
    own = F.when(F.col("order_id").isNotNull(), F.year("first_date"))
    runs = by_order.groupBy(F.coalesce(own, first).alias("y")).agg(
        F.sum("valid").alias("valid"), F.sum("rejected").alias("rejected"))
    masters = reduce(DataFrame.unionByName, [df.agg(*sums) for df in masters.values()])
    ok, bad = masters.select(F.sum("valid")).scalar(), masters.select(F.sum("rejected")).scalar()
    runs = runs.select("y", (F.col("valid") + ok).alias("total_valid"), (F.col("rejected") + bad).alias("total_rejected"))
    return runs.select(_run_at(), "total_valid", "total_rejected",
                       (F.col("total_rejected") / (F.col("total_valid") + F.col("total_rejected"))).alias("rejection_rate"))


def test_runs_by_year(star: dict[str, DataFrame], raw_orders: DataFrame) -> DataFrame:
    """A test-run log derived from data: all tests over the star, one run per order year.

    Facts of orders carry the year of their order, and a test of theirs fails
    in the runs whose rows break it; tests of other models fail in every run
    or in none.
    """
    years = order_years(raw_orders)
    dated = {}
    for name, df in star.items():
        if name == "fact_orders":
            dated[name] = df.withColumn("y", F.year("date_id"))
        elif name in ("fact_order_items", "fact_payments", "fact_deliveries"):
            dated[name] = lookup_join(df, years, ["order_id"])
        else:
            dated[name] = df.withColumn("y", F.lit(None).cast("int"))
    tests = dq.star_tests()
    broken = cut_lineage(dq.failing_rows(dated, tests, by=["y"]).groupBy("test_name", "y").agg(F.count(F.lit(1)).alias("n")))
    always = broken.where("y IS NULL").select("test_name")
    own = (broken.where("y IS NOT NULL").join(always, "test_name", "left_anti")
           .groupBy("y").agg(F.count_distinct("test_name").alias("own")))
    n_always = always.select(F.count(F.lit(1))).scalar()
    runs = raw_orders.where(F.col("order_date").isNotNull()).select(F.year("order_date").alias("y")).distinct()
    passed = F.lit(len(tests)) - n_always - F.coalesce(F.col("own"), F.lit(0))
    return runs.join(own, "y", "left").select(
        _run_at(), F.lit(len(tests)).cast("long").alias("total_tests"), passed.cast("long").alias("passed_tests"))
