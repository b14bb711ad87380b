"""Cleaning and derivation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffin.functions import parse as P
from tiffin.functions.numeric import money

COST_COL = "approx_cost(for two people)"
MEAL_TYPE_COL = "listed_in(type)"


def clean_restaurants(df: DataFrame) -> DataFrame:
    """Typed restaurant projection (12 columns)."""
    return df.select(
        F.col("restaurant_id").cast("long").alias("restaurant_id"),
        P.trimmed("name").alias("restaurant_name"),
        F.col("url"),
        F.col("address"),
        F.col("location").alias("area"),
        P.primary_value("rest_type").alias("restaurant_type"),
        F.col(f"`{MEAL_TYPE_COL}`").alias("meal_type"),
        P.rating("rate").alias("rating"),
        P.coerce(df, "votes", "int").alias("vote_count"),
        P.cost(F.col(f"`{COST_COL}`")).alias("avg_cost_for_two"),
        P.yes_no("online_order").alias("online_order_enabled"),
        P.yes_no("book_table").alias("table_booking_enabled"),
    )


def restaurant_cuisines(df: DataFrame) -> DataFrame:
    """One row per (restaurant, listed cuisine); NULL list -> no rows.

    Not de-duplicated: a cuisine listed twice yields two rows.
    """
    listed = F.transform(F.split("cuisines", P.LIST_SPLIT_PATTERN), lambda c: F.trim(c))
    return df.select(F.col("restaurant_id").cast("long").alias("restaurant_id"),
                     F.explode(F.filter(listed, lambda c: c != "")).alias("cuisine"))


def clean_customers(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Customers + number of orders of any status (0 when none).

    The per-customer count is a partial aggregation, so a customer with a
    third of all orders costs one row per map task; both join sides are then
    one row per customer.
    """
    counts = orders.groupBy("customer_id").agg(F.count(F.lit(1)).alias("customer_order_count"))
    cols = [c for c in ("customer_id", "name", "email", "phone", "signup_date") if c in customers.columns]
    base = customers.select(*cols)
    if "signup_date" in cols:
        base = base.withColumn("signup_date", P.coerce(customers, "signup_date", "date"))
    return (base.join(counts, "customer_id", "left")
            .withColumn("customer_order_count", F.coalesce(F.col("customer_order_count"), F.lit(0)).cast("long")))


def clean_orders(df: DataFrame) -> DataFrame:
    """Typed orders + order_hour."""
    return df.select(
        F.col("order_id"), F.col("customer_id"), F.col("restaurant_id"),
        P.coerce(df, "order_date", "date").alias("order_date"),
        F.col("order_time"),
        P.hour_of("order_time").alias("order_hour"),
        P.coerce(df, "party_size", "int").alias("party_size"),
        money(P.coerce(df, "order_total", "decimal(18,2)")).alias("order_total"),
        F.col("order_status"),
    )


def clean_order_items(df: DataFrame) -> DataFrame:
    """Item price as money."""
    return df.select("order_item_id", "order_id", "item_name",
                     money(P.coerce(df, "item_price", "decimal(18,2)")).alias("item_price"))


def clean_payments(df: DataFrame) -> DataFrame:
    """Amount as money."""
    return df.select("payment_id", "order_id", "payment_method",
                     money(P.coerce(df, "amount", "decimal(18,2)")).alias("amount"), "payment_status")


def clean_deliveries(df: DataFrame) -> DataFrame:
    """Minutes as int."""
    cols = ["delivery_id", "order_id", "delivery_partner_id"]
    if "delivery_partner_name" in df.columns:
        cols.append("delivery_partner_name")
    return df.select(*cols, P.coerce(df, "delivery_time_minutes", "int").alias("delivery_time_minutes"),
                     "delivery_status")
