import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from tiffin.plans import daily_sums, kpi
from tiffin.plans.queries import FIXTURE_TIERS, KPI_DIMENSIONS, Ctx

SF = "/root/testdata/sf0.001"
ORDERS = "order_id long, customer_id long, restaurant_id long, date_id date, hour_id int, order_total decimal(18,2), order_status string"
LOADED = dt.date(2024, 2, 1)


def orders(spark, *rows):
    return spark.createDataFrame([(i, c, r, d, h, t, s) for i, c, r, d, h, t, s in rows], ORDERS)


def fresh(spark):
    root = tempfile.mkdtemp(prefix="tiffin-sums-")
    daily_sums.create(spark, root)
    return root


def rows(df):
    return sorted(map(str, df.collect()))


def test_a_late_day_a_repeated_load_and_nulls(spark):
    from decimal import Decimal as D
    d1, d2, d3 = dt.date(2024, 1, 30), dt.date(2024, 2, 1), dt.date(2024, 1, 29)
    first = orders(spark, (1, 7, 1, d1, 9, D("10.10"), "Delivered"), (2, 8, 2, d1, 9, D("5.00"), "Cancelled"))
    second = orders(spark, (3, 7, 1, d2, None, None, "Delivered"), (4, None, None, None, 23, D("1.01"), "Delivered"))
    late = orders(spark, (5, 7, 2, d3, 9, D("0.05"), "Delivered"), (6, 9, 1, d1, 9, D("3.33"), None))
    dc = spark.createDataFrame([(7,), (8,), (9,)], "customer_id long")
    root = fresh(spark)
    for batch, load in ((0, first), (1, second), (1, second), (2, late), (0, first)):
        daily_sums.add(spark, root, batch, {"fact_orders": load}, LOADED)
    facts = {"fact_orders": first.union(second).union(late), "dim_customer": dc}
    for fn, kw in ((kpi.kpi_business, {}), (kpi.revenue_trend, {}), (kpi.orders_by_hour, {}),
                   (kpi.value_tiers, {"tiers": (("some", 10),), "with_share": True})):
        sums = daily_sums.read(spark, root) | {"dim_customer": dc}
        assert rows(fn(sums, **kw)) == rows(fn(facts, **kw)), fn.__name__
    assert daily_sums.compact(spark, root, max_folders=1) > 0
    assert rows(kpi.revenue_trend(daily_sums.read(spark, root))) == rows(kpi.revenue_trend(facts))
    # a load is replaced by its own number, also after a compaction only by new numbers
    daily_sums.add(spark, root, 3, {"fact_orders": first}, LOADED)
    twice = {"fact_orders": facts["fact_orders"].union(first)}
    assert rows(kpi.kpi_business(daily_sums.read(spark, root))) == rows(kpi.kpi_business(twice))


def test_no_loads(spark):
    root, none = fresh(spark), {"fact_orders": orders(spark)}
    sums = daily_sums.read(spark, root)
    assert rows(kpi.kpi_business(sums)) == rows(kpi.kpi_business(none))
    assert rows(kpi.revenue_trend(sums)) == [] == rows(kpi.orders_by_hour(sums)) == rows(kpi.partner_leaderboard(
        sums | {"dim_delivery_partner": spark.createDataFrame([], "delivery_partner_id long, delivery_partner_name string")}))


@pytest.mark.parametrize("fn, kw", [
    (kpi.kpi_business, {}), (kpi.revenue_trend, {}), (kpi.orders_by_area, {}), (kpi.top_cuisines, {}), (kpi.top_restaurants, {"by": "id"}),
    (kpi.value_tiers, {"tiers": FIXTURE_TIERS}), (kpi.orders_by_payment_method, {}), (kpi.kpi_delivery, {}), (kpi.orders_by_hour, {}),
    (kpi.delivery_time_buckets, {}), (kpi.partner_leaderboard, {"by": "id"}), (kpi.online_vs_offline, {})])
def test_kpis_read_no_fact(spark, summed_star, fn, kw):
    facts, sums = summed_star
    assert rows(fn(sums, **kw)) == rows(fn(facts, **kw)) != []


@pytest.fixture(scope="module")
def summed_star(spark):
    """The fixture's facts, and dimensions with sums of two loads in their place."""
    star = Ctx(spark, SF).star
    names = ("fact_orders", "fact_deliveries", "fact_payments")
    facts = {n: star[n] for n in (*names, *KPI_DIMENSIONS)}
    root = fresh(spark)
    for batch in range(2):
        daily_sums.add(spark, root, batch, {n: star[n].where(F.col("order_id") % 2 == batch) for n in names}, LOADED)
    return facts, {n: star[n] for n in KPI_DIMENSIONS} | daily_sums.read(spark, root)
