"""Star schema: dimensions, bridge and facts.

Surrogate keys are dense 1..N in the natural order of the key, computed
with the scalable ``dense_ids`` (range-sorted partitions + offsets), never a
single-partition ``row_number() over (order by ...)``.

Dimension lookups are plain joins: Spark broadcasts a dimension by its
measured size, else adaptive execution splits hot keys (facts such as orders
are skewed on their dimension keys).  Facts keep
every row (left joins), so a missing dimension member yields a NULL key that
the relationship tests report.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.operators.ordered import dense_ids
from tiffin.operators.joins import lookup_join

# Hour-of-day bands of dim_time (inclusive bounds) and the fallback band.
TIME_BANDS = [
    (6, 10, "Breakfast"),
    (11, 15, "Lunch"),
    (16, 18, "Evening Snacks"),
    (19, 22, "Dinner"),
]
OTHER_BAND = "Late Night"


def dim_location(clean_restaurants: DataFrame) -> DataFrame:
    """M1: distinct non-null areas, location_id dense in alphabetical order."""
    areas = clean_restaurants.select("area").where(F.col("area").isNotNull()).distinct()
    return dense_ids(areas, ["area"], "location_id").select("location_id", "area")


def dim_cuisine(restaurant_cuisines: DataFrame) -> DataFrame:
    """M2: distinct cuisines, cuisine_id dense in alphabetical order."""
    c = restaurant_cuisines.select("cuisine").where(F.col("cuisine").isNotNull()).distinct()
    return dense_ids(c, ["cuisine"], "cuisine_id").select("cuisine_id", "cuisine")


def dim_restaurant(clean_restaurants: DataFrame, dim_loc: DataFrame) -> DataFrame:
    """M3: restaurants with the location key (NULL area -> NULL key)."""
    j = lookup_join(clean_restaurants, dim_loc, ["area"], "left")
    return j.select("restaurant_id", "restaurant_name", "url", "address", "location_id",
                    "restaurant_type", "meal_type", "rating", "vote_count", "avg_cost_for_two",
                    "online_order_enabled", "table_booking_enabled")


def bridge_restaurant_cuisine(restaurant_cuisines: DataFrame, dim_cui: DataFrame) -> DataFrame:
    """M4: (restaurant_id, cuisine_id) pairs — inner join on the cuisine name."""
    return lookup_join(restaurant_cuisines, dim_cui, ["cuisine"], "inner") \
        .select("restaurant_id", "cuisine_id")


def dim_customer(clean_customers: DataFrame) -> DataFrame:
    """M5: customer projection."""
    return clean_customers.select("customer_id", "name", "email", "phone", "signup_date", "customer_order_count")


def dim_delivery_partner(deliveries: DataFrame) -> DataFrame:
    """M6: distinct (id, name) with a non-null id (an id with two names -> two rows)."""
    return (deliveries.where(F.col("delivery_partner_id").isNotNull())
            .select("delivery_partner_id", "delivery_partner_name").distinct())


def dim_date(clean_orders: DataFrame, pad_names: bool = False) -> DataFrame:
    """M7: one row per observed order date.

    day_of_week is ISO (Monday = 1 ... Sunday = 7), weekend = 6 or 7.
    ``pad_names`` blank-pads month/day names to 9 characters (the warehouse
    that first produced these names did so).
    """
    d = clean_orders.select(F.col("order_date").alias("date_id")).where(F.col("date_id").isNotNull()).distinct()
    iso_dow = (F.weekday("date_id") + 1).cast("int")
    month_name = F.date_format("date_id", "MMMM")
    day_name = F.date_format("date_id", "EEEE")
    if pad_names:
        month_name, day_name = F.rpad(month_name, 9, " "), F.rpad(day_name, 9, " ")
    return d.select(
        "date_id",
        F.col("date_id").alias("full_date"),
        F.year("date_id").alias("year"),
        F.quarter("date_id").alias("quarter"),
        F.month("date_id").alias("month"),
        month_name.alias("month_name"),
        F.dayofmonth("date_id").alias("day"),
        iso_dow.alias("day_of_week"),
        day_name.alias("day_name"),
        iso_dow.isin(6, 7).alias("is_weekend"),
    )


def time_period(hour_col) -> F.Column:
    expr = None
    for lo, hi, name in TIME_BANDS:
        cond = hour_col.between(lo, hi)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(OTHER_BAND))


def dim_time(spark: SparkSession) -> DataFrame:
    """M8: hours 0-23 with their meal band."""
    h = spark.range(0, 24).select(F.col("id").cast("int").alias("hour"))
    return h.select(F.col("hour").alias("hour_id"), F.col("hour").alias("hour_of_day"),
                    time_period(F.col("hour")).alias("time_period"))


def fact_orders(clean_orders: DataFrame, dim_rest: DataFrame) -> DataFrame:
    """orders with the restaurant's location key.

    restaurant_id is typically skewed (popular restaurants); see ``joins``.
    """
    locs = dim_rest.select("restaurant_id", "location_id")
    j = lookup_join(clean_orders, locs, ["restaurant_id"], "left")
    return j.select("order_id", "customer_id", "restaurant_id", "location_id",
                    F.col("order_date").alias("date_id"), F.col("order_hour").alias("hour_id"),
                    "party_size", "order_total", "order_status")


def unlocated_orders(clean_orders: DataFrame) -> DataFrame:
    """F1 without the location key, for questions that don't ask for it: a projection, no lookup."""
    return clean_orders.select("order_id", "customer_id", "restaurant_id", F.col("order_date").alias("date_id"),
                               F.col("order_hour").alias("hour_id"), "party_size", "order_total", "order_status")


def fact_order_items(items: DataFrame) -> DataFrame:
    """F2."""
    return items.select("order_item_id", "order_id", "item_name", "item_price")


def fact_payments(payments: DataFrame) -> DataFrame:
    """F3."""
    return payments.select("payment_id", "order_id", "payment_method", "amount", "payment_status")


def fact_deliveries(deliveries: DataFrame) -> DataFrame:
    """the partner name lives in dim_delivery_partner."""
    return deliveries.select("delivery_id", "order_id", "delivery_partner_id", "delivery_time_minutes",
                             "delivery_status")


def fact_reviews(parsed_reviews: DataFrame) -> DataFrame:
    """review_id dense in (restaurant_id, position in the list) order."""
    ids = dense_ids(parsed_reviews, ["restaurant_id", "review_pos"], "review_id")
    return ids.select("review_id", "restaurant_id", "review_rating", "review_text")


#: Models that other models look up, in their order.
SHARED_DIMS = ("dim_location", "dim_cuisine", "dim_restaurant")


def shared_dim(name: str, have: dict[str, DataFrame]) -> DataFrame:
    """One of ``SHARED_DIMS`` from the staging frames and the ones before it."""
    if name == "dim_location":
        return dim_location(have["restaurants"])
    if name == "dim_cuisine":
        return dim_cuisine(have["restaurant_cuisines"])
    return dim_restaurant(have["restaurants"], have["dim_location"])


def build_star(staging: dict[str, DataFrame], spark: SparkSession) -> dict[str, DataFrame]:
    """all models in dependency order from the staging frames.

    ``staging`` keys: restaurants, restaurant_cuisines, customers, orders,
    order_items, payments, deliveries, reviews (parsed rows); and those of
    ``SHARED_DIMS`` that are written already, which the others then read.
    """
    dims = dict(staging)
    for name in SHARED_DIMS:
        dims.setdefault(name, shared_dim(name, dims))
    loc, cui, rest = (dims[name] for name in SHARED_DIMS)
    star = {
        "dim_location": loc,
        "dim_cuisine": cui,
        "dim_restaurant": rest,
        "bridge_restaurant_cuisine": bridge_restaurant_cuisine(staging["restaurant_cuisines"], cui),
        "dim_customer": dim_customer(staging["customers"]),
        "dim_delivery_partner": dim_delivery_partner(staging["deliveries"]),
        "dim_date": dim_date(staging["orders"]),
        "dim_time": dim_time(spark),
        "fact_orders": fact_orders(staging["orders"], rest),
        "fact_order_items": fact_order_items(staging["order_items"]),
        "fact_payments": fact_payments(staging["payments"]),
        "fact_deliveries": fact_deliveries(staging["deliveries"]),
    }
    if "reviews" in staging:
        star["fact_reviews"] = fact_reviews(staging["reviews"])
    return star
