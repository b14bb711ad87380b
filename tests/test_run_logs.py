"""Run logs by order year: counted by order without a join, in small shuffle partitions."""

import datetime as dt

from tests.conftest import SF001
from tiffin.operators import validate as V
from tiffin.plans import health
from tiffin.plans.queries import Ctx
from tiffin.session import PARTITION_BYTES, PARTITION_CONF


def day(y):
    return dt.date(y, 5, 1) if y else None


def raw_and_tagged(spark):
    """Orders with a repeated, a null and a rejected id, one without a date; children with and without a valid order."""
    orders = spark.createDataFrame(
        [(1, day(2001), None), (1, day(2000), "duplicate_order_id"), (2, day(2001), "orphan_customer_id"), (3, None, None),
         (None, day(2002), None), (4, day(2002), None)], "order_id long, order_date date, reject_reason string")
    items = spark.createDataFrame(
        [(1, 1, 5.0), (2, 1, -1.0), (3, 2, 5.0), (4, 2, -1.0), (5, None, 5.0), (6, 9, 5.0), (7, 3, None), (8, 4, 0.0), (9, 4, 0.0)],
        "order_item_id long, order_id long, item_price double")
    payments = spark.createDataFrame([(1, 1, 0.0), (2, 4, 3.0), (3, None, 0.0)], "payment_id long, order_id long, amount double")
    deliveries = spark.createDataFrame([(1, 4, 10), (2, 4, 0)], "delivery_id long, order_id long, delivery_time_minutes int")
    return {"orders": orders, "order_items": items, "payments": payments, "deliveries": deliveries}, orders


def test_orders_with_their_children(spark):
    raw, tagged = raw_and_tagged(spark)
    got = {r["order_id"]: (r["first_date"], r["valid"], r["rejected"]) for r in V.order_outcomes(raw, tagged).collect()}
    assert got == {1: (day(2000), 2, 3), 2: (day(2001), 0, 3), 3: (None, 2, 0), 4: (day(2002), 5, 1), 9: (None, 0, 1),
                   None: (day(2002), 1, 2)}
    # the same from the tagged rows
    orders = V.valid(tagged).select("order_id")
    rows = [tagged, V.validate_order_items(raw["order_items"], orders), V.validate_payments(raw["payments"], orders),
            V.validate_deliveries(raw["deliveries"], orders)]
    assert sum(V.valid(df).count() for df in rows) == sum(v for _, v, _ in got.values())
    assert sum(V.rejected(df).count() for df in rows) == sum(r for _, _, r in got.values())


def test_run_log_joins_and_sorts_nothing(spark):
    raw, tagged = raw_and_tagged(spark)
    masters = {"restaurants": spark.createDataFrame([(None, 7), ("missing_url", 1)], "reject_reason string, rows long"),
               "customers": spark.createDataFrame([(None, 3)], "reject_reason string, rows long")}
    runs = health.validation_runs_by_year(masters, V.order_outcomes(raw, tagged), raw["orders"])
    # rows without a year are part of the first run
    assert sorted((r["run_at"].year, r["total_valid"], r["total_rejected"]) for r in runs.collect()) == [
        (2001, 10 + 2 + 2 + 1, 1 + 3 + 0 + 1 + 2), (2002, 10, 1 + 3), (2003, 10 + 5, 1 + 1)]
    plan = runs._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Sort" not in plan and "Window" not in plan


def test_run_log_without_rows(spark):
    raw, tagged = raw_and_tagged(spark)
    none = V.order_outcomes({n: df.limit(0) for n, df in raw.items()}, tagged.limit(0))
    masters = {"restaurants": spark.createDataFrame([(None, 7)], "reject_reason string, rows long")}
    assert health.validation_runs_by_year(masters, none, raw["orders"].limit(0)).count() == 0


def test_partitions_of_a_session_at_sparks_default(spark):
    own = spark.newSession()
    own.conf.unset(PARTITION_CONF)
    Ctx(own, SF001)
    assert own.conf.get(PARTITION_CONF) == PARTITION_BYTES
    own.conf.set(PARTITION_CONF, "32m")
    Ctx(own, SF001)
    assert own.conf.get(PARTITION_CONF) == "32m"
