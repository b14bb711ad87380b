"""Role views: the driver's TPC-H-ish tables playing the reference's entities.

Each function takes a table loader ``t(name) -> DataFrame`` and returns the
raw (or dirty) entity frame.  Everything is derived by Spark from the given
tables, so the work grows with the scale factor.  Derivation rules are
documented in FIXTURES.md part C; the dirty variants add the rule
violations the validators must catch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Loader = Callable[[str], DataFrame]


def loader(spark: SparkSession, sf_dir: str) -> Loader:
    def t(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return t


def _s(c: Column) -> Column:
    return c.cast("string")


def _lpad(c: Column, n: int) -> Column:
    return F.lpad(_s(c), n, "0")


# ---------------------------------------------------------------- restaurants
def restaurants(t: Loader) -> DataFrame:
    """fx_restaurants: one restaurant per part, raw text columns."""
    p = t("part")
    k = F.col("p_partkey")
    size = F.col("p_size")
    price = F.floor(F.col("p_retailprice")).cast("long")
    rate = (F.when(k % 10 == 0, F.lit("NEW"))
            .when(k % 10 == 1, F.lit("-"))
            .otherwise(F.concat(_s(F.floor(size / 10).cast("long")), F.lit("."), _s(size % 10), F.lit("/5"))))
    cost = F.when(price >= 1000, F.concat(_s(F.floor(price / 1000).cast("long")), F.lit(","), _lpad(price % 1000, 3))) \
        .otherwise(_s(price))
    return p.select(
        k.alias("restaurant_id"),
        F.concat(F.lit("r/"), _s(k)).alias("url"),
        F.concat(_s(k), F.lit(" "), F.col("p_name"), F.lit(" road")).alias("address"),
        F.concat(F.lit(" "), F.col("p_brand"), F.lit(" "), F.col("p_type"), F.lit(" ")).alias("name"),
        F.when(k % 2 == 0, F.lit("Yes")).otherwise(F.lit("No")).alias("online_order"),
        F.when(size >= 25, F.lit("Yes")).otherwise(F.lit("No")).alias("book_table"),
        rate.alias("rate"),
        _s(size * 7).alias("votes"),
        F.col("p_brand").alias("location"),
        F.concat(F.col("p_type"), F.lit(", "), F.col("p_brand")).alias("rest_type"),
        F.replace(F.col("p_name"), F.lit(" "), F.lit(", ")).alias("cuisines"),
        cost.alias("approx_cost(for two people)"),
        F.when(k % 3 == 0, F.lit("Delivery")).otherwise(F.lit("Dine-out")).alias("listed_in(type)"),
        (k * 2).alias("seq"),
    )


def restaurants_dirty(t: Loader) -> DataFrame:
    """Restaurants with missing urls / names and negative votes (V1 precedence)."""
    r = restaurants(t)
    k = F.col("restaurant_id")
    return (r.withColumn("url", F.when(k % 53 == 0, F.lit(None).cast("string"))
                         .when(k % 53 == 1, F.lit("")).otherwise(F.col("url")))
             .withColumn("name", F.when(k % 59 == 0, F.lit("")).otherwise(F.col("name")))
             .withColumn("votes", F.when(k % 61 == 0, F.lit("-5")).otherwise(F.col("votes"))))


# ------------------------------------------------------------------ customers
def customers(t: Loader) -> DataFrame:
    c = t("customer")
    k = F.col("c_custkey")
    return c.select(
        k.alias("customer_id"),
        F.col("c_name").alias("name"),
        F.concat(F.lit("c"), _s(k), F.lit("@example.com")).alias("email"),
        F.concat(F.lit("+91-"), _lpad(k, 10)).alias("phone"),
        F.date_add(F.lit("1995-01-01").cast("date"), ((k * 37) % 2400).cast("int")).alias("signup_date"),
        (k * 2).alias("seq"),
    )


def customers_dirty(t: Loader) -> DataFrame:
    """Null ids and repeated ids (copies of every 40th customer, later in order)."""
    c = customers(t)
    k = F.col("customer_id")
    base = c.withColumn("customer_id", F.when(k % 97 == 5, F.lit(None).cast("long")).otherwise(k))
    dups = c.where(k % 40 == 0).withColumn("seq", F.col("seq") + 1)
    return base.unionByName(dups)


# --------------------------------------------------------------------- orders
def _n_restaurants(t: Loader) -> Column:
    return t("part").select(F.count(F.lit(1))).scalar()


def orders(t: Loader) -> DataFrame:
    """fx_orders: restaurant_id = ((k % n) * (k % n)) % n — deliberately skewed."""
    o = t("orders")
    k = F.col("o_orderkey")
    n = _n_restaurants(t)
    m = k % n
    return o.select(
        k.alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        ((m * m) % n).cast("long").alias("restaurant_id"),
        F.to_date(F.col("o_orderdate")).alias("order_date"),
        F.concat(_lpad((k * 5) % 24, 2), F.lit(":"), _lpad((k * 7) % 60, 2)).alias("order_time"),
        (k % 4 + 1).cast("int").alias("party_size"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("order_total"),
        F.when(F.col("o_orderstatus") == "P", F.lit("Cancelled")).otherwise(F.lit("Delivered")).alias("order_status"),
        (k * 2).alias("seq"),
    )


def orders_dirty(t: Loader) -> DataFrame:
    o = orders(t)
    k = F.col("order_id")
    dirty = (o.withColumn("customer_id", F.when(k % 89 == 0, F.lit(-1).cast("long"))
                          .when(k % 83 == 0, F.lit(None).cast("long")).otherwise(F.col("customer_id")))
              .withColumn("restaurant_id", F.when(k % 79 == 0, F.lit(-1).cast("long")).otherwise(F.col("restaurant_id")))
              .withColumn("order_total", F.when(k % 97 == 0, -F.col("order_total"))
                          .when(k % 101 == 0, F.lit(None).cast("decimal(18,2)")).otherwise(F.col("order_total"))))
    copies = o.where(k % 50 == 0).withColumn("seq", F.col("seq") + 1)
    return dirty.unionByName(copies)


# ---------------------------------------------------------------- order items
def order_items_raw(t: Loader) -> DataFrame:
    """fx_order_items raw: (l_orderkey, l_linenumber) repeats, so ids repeat."""
    li = t("lineitem")
    return li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.concat(F.lit("item "), _s(F.col("l_linenumber"))).alias("item_name"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("item_price"),
    )


def order_items_dirty(t: Loader) -> DataFrame:
    i = order_items_raw(t)
    return i.withColumn("item_price", F.when((F.col("order_id") % 71 == 0) & (F.col("order_item_id") % 10 == 1),
                                             -F.col("item_price")).otherwise(F.col("item_price")))


def order_items(t: Loader) -> DataFrame:
    """Clean items: one row per id, the highest price."""
    return (order_items_raw(t).groupBy("order_item_id", "order_id", "item_name")
            .agg(F.max("item_price").alias("item_price")))


# ------------------------------------------------------------------- payments
def payments(t: Loader) -> DataFrame:
    o = t("orders")
    s = F.col("o_orderstatus")
    return o.select(
        F.col("o_orderkey").alias("payment_id"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderpriority").alias("payment_method"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
        F.when(s == "F", F.lit("Success")).when(s == "O", F.lit("Failed")).otherwise(F.lit("Refunded")).alias("payment_status"),
    )


def payments_dirty(t: Loader) -> DataFrame:
    p = payments(t)
    return p.withColumn("amount", F.when(F.col("order_id") % 67 == 0, F.lit(0).cast("decimal(18,2)"))
                        .otherwise(F.col("amount")))


# ----------------------------------------------------------------- deliveries
def deliveries(t: Loader) -> DataFrame:
    """Star deliveries: non-cancelled orders, partner from supplier."""
    o = t("orders").where(F.col("o_orderstatus") != "P")
    sup = t("supplier")
    n_sup = sup.select(F.count(F.lit(1))).scalar()
    k = F.col("o_orderkey")
    s = F.col("o_orderstatus")
    d = o.select(
        k.alias("delivery_id"),
        k.alias("order_id"),
        ((k * 31) % n_sup).cast("long").alias("delivery_partner_id"),
        (F.greatest(F.lit(10), F.lit(10) + (k * 13) % 50)).cast("int").alias("delivery_time_minutes"),
        F.when(s == "F", F.lit("Delivered")).otherwise(F.lit("Delayed")).alias("delivery_status"),
    )
    names = sup.select(F.col("s_suppkey").alias("delivery_partner_id"), F.col("s_name").alias("delivery_partner_name"))
    # supplier is a dimension table; its size is checked before broadcasting
    from tiffin.operators.joins import lookup_join
    return lookup_join(d, names, ["delivery_partner_id"], "left")


def deliveries_dirty(t: Loader) -> DataFrame:
    d = deliveries(t)
    return d.withColumn("delivery_time_minutes", F.when(F.col("order_id") % 73 == 0, F.lit(0))
                        .otherwise(F.col("delivery_time_minutes")))


def deliveries_at_scale(t: Loader) -> DataFrame:
    """KPI-scale deliveries: one per lineitem (minutes = quantity)."""
    li = t("lineitem")
    sup = t("supplier")
    d = li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("delivery_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_suppkey").alias("delivery_partner_id"),
        F.col("l_quantity").cast("int").alias("delivery_time_minutes"),
        F.when(F.col("l_linestatus") == "F", F.lit("Delivered")).otherwise(F.lit("Delayed")).alias("delivery_status"),
    )
    names = sup.select(F.col("s_suppkey").alias("delivery_partner_id"), F.col("s_name").alias("delivery_partner_name"))
    from tiffin.operators.joins import lookup_join
    return lookup_join(d, names, ["delivery_partner_id"], "left")


# -------------------------------------------------------------------- reviews
def reviews_raw(t: Loader) -> DataFrame:
    """fx_reviews_raw: conversations rendered as stringified review lists.

    One row per conversation (restaurant); each turn becomes a
    ``('Rated r.0', 'RATED\\n  text')`` tuple in turn order.  conv_id % 37 = 3
    is unparseable, conv_id % 41 = 1 is an empty field.
    """
    c = t("conversations")

    def lit_str(x: Column) -> Column:
        esc = F.replace(F.replace(F.replace(F.replace(x, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'")),
                                  F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))
        return F.concat(F.lit("'"), esc, F.lit("'"))

    tup = F.concat(F.lit("("), lit_str(F.concat(F.lit("Rated "), _s(F.col("turn") % 5 + 1), F.lit(".0"))),
                   F.lit(", "), lit_str(F.concat(F.lit("RATED\n  "), F.col("text"))), F.lit(")"))
    per_conv = (c.select("conv_id", "turn", tup.alias("tup"))
                .groupBy("conv_id")
                .agg(F.sort_array(F.collect_list(F.struct("turn", "tup"))).alias("ts")))
    body = F.concat(F.lit("["), F.array_join(F.transform("ts", lambda s: s["tup"]), ", "), F.lit("]"))
    k = F.col("conv_id")
    return per_conv.select(
        k.alias("restaurant_id"),
        F.when(k % 37 == 3, F.lit("[(broken")).when(k % 41 == 1, F.lit("")).otherwise(body).alias("reviews_list"),
    )


def as_of(t: Loader) -> Column:
    """Report date: the last order date in the data (never the wall clock)."""
    return orders(t).select(F.max("order_date")).scalar()
