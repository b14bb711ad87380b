"""Dashboard KPIs (Q1-Q23) over the star.

Every query aggregates the big fact first (partial + final hash
aggregation) and joins dimensions to the *aggregated* rows, so the
join and the many-to-many bridge fan-out work on one row per restaurant /
partner / customer instead of one row per order.  Counting semantics are
unchanged because every dimension is unique on its key.

A star may hold the tables of ``daily_sums`` (order_sums, customer_sums,
hour_sums, partner_sums, minute_sums, method_sums).  Where it does, a KPI
merges these and reads no fact.

Rounded figures use exact integer arithmetic (``round_ratio`` /
``money_avg``), so they do not depend on summation order.  Top-N lists carry
a tie-breaker (the label, ascending) so the result is deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiffin.functions.numeric import cents, money_avg, money_sum, round_ratio
from tiffin.operators.joins import lookup_join

# Order / delivery status labels.
DELIVERED = "Delivered"
CANCELLED = "Cancelled"
# Customer value tiers (label, minimum lifetime spend), checked top-down,
# and the label for customers without delivered spend.
DEFAULT_TIERS = (("High value", 5000), ("Mid value", 1500))
LOW_TIER = "Low value"
NO_ORDERS = "No orders"
# Delivery-time histogram buckets (label, exclusive upper bound) and the last label.
DELIVERY_BUCKETS = (("< 20 min", 20), ("20–30 min", 30), ("30–45 min", 45))
LAST_BUCKET = "45+ min"


def _delivered(fo: DataFrame) -> DataFrame:
    return fo.where(F.col("order_status") == DELIVERED)


def _merged(col: str) -> Column:
    """The sum of partial counts; 0 without any."""
    return F.coalesce(F.sum(col), F.lit(0)).cast("long")


# ------------------------------------------------------- business overview
def kpi_business(star: dict[str, DataFrame]) -> DataFrame:
    """Q1-Q4: delivered orders, revenue, average order value, active restaurants."""
    if "order_sums" in star:
        agg = star["order_sums"].agg(
            _merged("delivered").alias("total_orders"), F.sum(cents("revenue")).alias("_rev_cents"),
            _merged("valued").alias("_n_rev"), money_sum("revenue").alias("total_revenue"),
            F.count_distinct("restaurant_id").alias("active_restaurants"))
    else:
        d = F.col("order_status") == DELIVERED
        agg = star["fact_orders"].agg(
            F.count_if(d).alias("total_orders"),
            F.sum(F.when(d, cents("order_total"))).alias("_rev_cents"),
            F.count_if(d & F.col("order_total").isNotNull()).alias("_n_rev"),
            F.sum(F.when(d, F.col("order_total"))).cast("decimal(38,2)").alias("total_revenue"),
            F.count_distinct("restaurant_id").alias("active_restaurants"),
        )
    return agg.select(
        "total_orders",
        F.coalesce(F.col("total_revenue"), F.lit(0).cast("decimal(38,2)")).alias("total_revenue"),
        F.coalesce(money_avg("_rev_cents", "_n_rev"), F.lit(0).cast("decimal(18,2)")).alias("avg_order_value"),
        "active_restaurants",
    )


def revenue_trend(star: dict[str, DataFrame]) -> DataFrame:
    """Q5: delivered revenue per date."""
    if "order_sums" in star:
        rows, value = star["order_sums"].where("delivered > 0"), "revenue"
    else:
        rows, value = _delivered(star["fact_orders"]), "order_total"
    return (rows.groupBy(F.col("date_id").alias("order_date")).agg(money_sum(value).alias("revenue")).orderBy("order_date"))


def _per_restaurant(star: dict[str, DataFrame], delivered: bool = False) -> DataFrame:
    """Per restaurant with (delivered) orders: ``_orders``, ``_valued`` with a total, ``_rev`` their revenue."""
    if "order_sums" in star:
        n = "delivered" if delivered else "orders"
        return (star["order_sums"].where(F.col(n) > 0).groupBy("restaurant_id")
                .agg(F.sum(n).alias("_orders"), F.sum("valued").alias("_valued"), money_sum("revenue").alias("_rev")))
    fo = _delivered(star["fact_orders"]) if delivered else star["fact_orders"]
    return fo.groupBy("restaurant_id").agg(F.count(F.lit(1)).alias("_orders"), F.count("order_total").alias("_valued"),
                                           money_sum("order_total").alias("_rev"))


def orders_by_area(star: dict[str, DataFrame], n: int = 10) -> DataFrame:
    """Q6: orders (any status) by the restaurant's area, top n.

    Orders of restaurants without a location drop out (inner joins).
    """
    per_r = _per_restaurant(star)
    rl = star["dim_restaurant"].select("restaurant_id", "location_id").where(F.col("location_id").isNotNull())
    j = lookup_join(per_r, rl, ["restaurant_id"], "inner")
    j = lookup_join(j, star["dim_location"], ["location_id"], "inner")
    return (j.groupBy("area").agg(F.sum("_orders").cast("long").alias("orders"))
            .orderBy(F.desc("orders"), F.asc("area")).limit(n))


def top_cuisines(star: dict[str, DataFrame], n: int = 10) -> DataFrame:
    """Q7: orders by cuisine through the m:n bridge (an order counts once per cuisine)."""
    per_r = _per_restaurant(star)
    b = star["bridge_restaurant_cuisine"]
    j = per_r.join(b, "restaurant_id")          # fan-out on aggregated rows only
    j = lookup_join(j, star["dim_cuisine"], ["cuisine_id"], "inner")
    return (j.groupBy("cuisine").agg(F.sum("_orders").cast("long").alias("orders"))
            .orderBy(F.desc("orders"), F.asc("cuisine")).limit(n))


def top_restaurants(star: dict[str, DataFrame], n: int = 10, by: str = "name") -> DataFrame:
    """Q8: delivered orders and revenue by restaurant *name* (branches merge), top n by revenue.

    ``by="id"`` ranks individual restaurants instead (names are not keys).
    """
    per_r = _per_restaurant(star, delivered=True)
    names = star["dim_restaurant"].select("restaurant_id", "restaurant_name")
    j = lookup_join(per_r, names, ["restaurant_id"], "inner")
    keys = [F.col("restaurant_name").alias("restaurant")] + ([F.col("restaurant_id")] if by == "id" else [])
    return (j.groupBy(*keys)
            .agg(F.sum("_orders").cast("long").alias("orders"), F.sum("_rev").cast("decimal(38,2)").alias("revenue"))
            .orderBy(F.desc("revenue"), F.asc("restaurant"), *([F.asc("restaurant_id")] if by == "id" else []))
            .limit(n))


# ------------------------------------------------------- customer insights
def kpi_customers(star: dict[str, DataFrame], as_of: Column, window_days: int = 30) -> DataFrame:
    """Q9-Q12: customers, new in the trailing window, repeat rate %, orders per buyer."""
    dc = star["dim_customer"]
    cnt = F.col("customer_order_count")
    agg = dc.agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.count_if(F.col("signup_date") >= F.date_sub(as_of, window_days)).alias("new_customers"),
        F.count_if(cnt > 1).alias("_repeat"),
        F.count_if(cnt >= 1).alias("_buyers"),
        F.sum(F.when(cnt >= 1, cnt)).alias("_orders"),
    )
    return agg.select(
        "total_customers", "new_customers",
        F.coalesce(round_ratio("_repeat", "_buyers", 1, scale=100), F.lit(0.0)).alias("repeat_rate_pct"),
        F.coalesce(round_ratio("_orders", "_buyers", 2), F.lit(0.0)).alias("avg_orders_per_buyer"),
    )


def value_tiers(star: dict[str, DataFrame], tiers=DEFAULT_TIERS, with_share: bool = False) -> DataFrame:
    """Q13: customers and revenue per lifetime-spend tier.

    Spend counts delivered orders only (the status filter sits in the join
    condition, so customers with only cancelled orders are "No orders").
    """
    if "customer_sums" in star:
        spend = star["customer_sums"].groupBy("customer_id").agg(F.sum("spend").alias("_spend"))
    else:
        spend = _delivered(star["fact_orders"]).groupBy("customer_id").agg(F.sum("order_total").alias("_spend"))
    per_c = (star["dim_customer"].select("customer_id").join(spend, "customer_id", "left")
             .withColumn("lifetime_spend", F.coalesce(F.col("_spend"), F.lit(0)).cast("decimal(38,2)")))
    ls = F.col("lifetime_spend")
    tier = F.when(ls == 0, F.lit(NO_ORDERS))
    for label, lo in tiers:
        tier = tier.when(ls >= lo, F.lit(label))
    tier = tier.otherwise(F.lit(LOW_TIER))
    out = (per_c.groupBy(tier.alias("value_tier"))
           .agg(F.count(F.lit(1)).alias("customers"), F.sum("lifetime_spend").cast("decimal(38,2)").alias("tier_revenue")))
    if with_share:
        from pyspark.sql import Window
        # the window spans the tier rows only (at most len(tiers) + 2 rows)
        total = F.sum(cents("tier_revenue")).over(Window.partitionBy())
        out = out.withColumn("revenue_share_pct", round_ratio(cents("tier_revenue"), total, 2, scale=100))
    return out


def orders_by_payment_method(star: dict[str, DataFrame]) -> DataFrame:
    """Q14: payments per method, most used first."""
    sums = "method_sums" in star
    return (star["method_sums" if sums else "fact_payments"].groupBy("payment_method")
            .agg((_merged("payments") if sums else F.count(F.lit(1))).alias("orders"))
            .orderBy(F.desc("orders"), F.asc("payment_method")))


def new_customers_by_day(star: dict[str, DataFrame], as_of: Column, window_days: int = 30) -> DataFrame:
    """Q15: signups per day in the trailing window (days without signups absent)."""
    dc = star["dim_customer"].where(F.col("signup_date") >= F.date_sub(as_of, window_days))
    return dc.groupBy("signup_date").agg(F.count(F.lit(1)).alias("new_customers")).orderBy("signup_date")


# ------------------------------------------------------ delivery & operations
def kpi_delivery(star: dict[str, DataFrame]) -> DataFrame:
    """Q16-Q19: avg minutes (1 dp), cancellation % (2 dp), avg rating (2 dp), on-time % (1 dp)."""
    if "partner_sums" in star:
        fd = star["partner_sums"].agg(F.sum("minutes").alias("_min"), _merged("timed").alias("_n_min"),
                                      _merged("on_time").alias("_on_time"), _merged("deliveries").alias("_n_del"))
    else:
        fd = star["fact_deliveries"].agg(
            F.sum("delivery_time_minutes").alias("_min"), F.count("delivery_time_minutes").alias("_n_min"),
            F.count_if(F.col("delivery_status") == DELIVERED).alias("_on_time"), F.count(F.lit(1)).alias("_n_del"))
    if "order_sums" in star:
        fo = star["order_sums"].agg(_merged("cancelled").alias("_cancel"), _merged("orders").alias("_n_ord"))
    else:
        fo = star["fact_orders"].agg(F.count_if(F.col("order_status") == CANCELLED).alias("_cancel"),
                                     F.count(F.lit(1)).alias("_n_ord"))
    dr = star["dim_restaurant"].agg(F.sum(F.round(F.col("rating") * 10).cast("long")).alias("_r10"),
                                    F.count("rating").alias("_n_r"))
    # three one-row aggregates combined as scalars (no join of data-sized frames)
    return fd.select(
        F.coalesce(round_ratio("_min", "_n_min", 1), F.lit(0.0)).alias("avg_delivery_minutes"),
        F.coalesce(round_ratio(fo.select("_cancel").scalar(), fo.select("_n_ord").scalar(), 2, scale=100),
                   F.lit(0.0)).alias("cancellation_rate_pct"),
        F.coalesce(round_ratio(dr.select("_r10").scalar(), dr.select(F.col("_n_r") * 10).scalar(), 2),
                   F.lit(0.0)).alias("avg_rating"),
        F.coalesce(round_ratio("_on_time", "_n_del", 1, scale=100), F.lit(0.0)).alias("on_time_pct"),
    )


def orders_by_hour(star: dict[str, DataFrame]) -> DataFrame:
    """Q20: orders per hour of day (hours without orders absent)."""
    if "hour_sums" in star:
        return star["hour_sums"].groupBy("hour_id").agg(_merged("orders").alias("orders")).orderBy("hour_id")
    return star["fact_orders"].groupBy("hour_id").agg(F.count(F.lit(1)).alias("orders")).orderBy("hour_id")


def delivery_bucket(minutes: Column) -> tuple[Column, Column]:
    label, order = None, None
    for i, (name, hi) in enumerate(DELIVERY_BUCKETS):
        cond = minutes < hi
        label = F.when(cond, F.lit(name)) if label is None else label.when(cond, F.lit(name))
        order = F.when(cond, F.lit(i + 1)) if order is None else order.when(cond, F.lit(i + 1))
    return label.otherwise(F.lit(LAST_BUCKET)), order.otherwise(F.lit(len(DELIVERY_BUCKETS) + 1))


def delivery_time_buckets(star: dict[str, DataFrame]) -> DataFrame:
    """Q21: deliveries per time bucket (NULL minutes fall in the last bucket).

    ``bucket_order`` gives the numeric order (sorting by label would put
    "< 20 min" last).
    """
    label, order = delivery_bucket(F.col("delivery_time_minutes"))
    sums = "minute_sums" in star
    return (star["minute_sums" if sums else "fact_deliveries"].groupBy(label.alias("bucket"), order.alias("bucket_order"))
            .agg((_merged("deliveries") if sums else F.count(F.lit(1))).alias("deliveries")).orderBy("bucket_order"))


def partner_leaderboard(star: dict[str, DataFrame], n: int = 10, by: str = "name") -> DataFrame:
    """Q22: deliveries and avg minutes (1 dp) by partner *name*, top n by deliveries.

    ``by="id"`` ranks individual partners instead (two partners may share a name).
    """
    if "partner_sums" in star:
        per_p = star["partner_sums"].groupBy("delivery_partner_id").agg(
            F.sum("deliveries").alias("_n"), F.sum("minutes").alias("_min"), F.sum("timed").alias("_n_min"))
    else:
        per_p = (star["fact_deliveries"].groupBy("delivery_partner_id")
                 .agg(F.count(F.lit(1)).alias("_n"), F.sum("delivery_time_minutes").alias("_min"),
                      F.count("delivery_time_minutes").alias("_n_min")))
    j = lookup_join(per_p, star["dim_delivery_partner"], ["delivery_partner_id"], "inner")
    keys = [F.col("delivery_partner_name").alias("partner")] + ([F.col("delivery_partner_id")] if by == "id" else [])
    agg = (j.groupBy(*keys)
           .agg(F.sum("_n").cast("long").alias("deliveries"), F.sum("_min").alias("_min"), F.sum("_n_min").alias("_n_min")))
    cols = ["partner"] + (["delivery_partner_id"] if by == "id" else [])
    return (agg.select(*cols, "deliveries", round_ratio("_min", "_n_min", 1).alias("avg_minutes"))
            .orderBy(F.desc("deliveries"), *[F.asc(c) for c in cols]).limit(n))


def online_vs_offline(star: dict[str, DataFrame]) -> DataFrame:
    """Q23: delivered AOV (2 dp) and orders by the restaurant's online-order flag."""
    per_r = _per_restaurant(star, delivered=True).select(
        "restaurant_id", F.col("_orders").alias("_n"), cents("_rev").alias("_c"), F.col("_valued").alias("_n_tot"))
    flags = star["dim_restaurant"].select("restaurant_id", "online_order_enabled")
    j = lookup_join(per_r, flags, ["restaurant_id"], "inner")
    agg = j.groupBy("online_order_enabled").agg(F.sum("_n").cast("long").alias("orders"),
                                                F.sum("_c").alias("_c"), F.sum("_n_tot").alias("_n_tot"))
    return agg.select("online_order_enabled", money_avg("_c", "_n_tot").alias("avg_order_value"), "orders")
