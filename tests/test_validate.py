from pyspark.sql import functions as F

from tiffin.operators import validate as V
from tiffin.sources import fixtures as fx


def counts(df):
    return {r["reject_reason"]: r["count"] for r in df.groupBy("reject_reason").count().collect()}


def test_orders_golden_against_unfiltered_parents(t01):
    # golden values of FIXTURES.md at sf0.01
    o = V.validate_orders(fx.orders_dirty(t01), fx.restaurants(t01), fx.customers(t01))
    c = counts(o)
    assert c[None] == 14317
    assert c["duplicate_order_id"] == 300
    assert c["non_positive_order_total"] == 155
    assert c["orphan_customer_id"] == 344
    assert c["orphan_restaurant_id"] == 184
    rep = V.rejection_summary(V.rejection_report({"orders": o})).first()
    assert rep["gate_failed"] and abs(rep["worst_rate"] - 983 / 15300) < 1e-12


def test_restaurant_precedence_last_rule_wins(spark):
    df = spark.createDataFrame(
        [(1, None, "", "-5"), (2, "", "x", "3"), (3, "u", "", "1"), (4, "u", "n", "4.0"), (5, "u", "n", None)],
        "restaurant_id long, url string, name string, votes string")
    got = {r["restaurant_id"]: r["reject_reason"] for r in V.validate_restaurants(df).collect()}
    assert got == {1: "negative_votes", 2: "missing_url", 3: "missing_name", 4: None, 5: None}


def test_duplicates_count_rejected_first_occurrence(spark):
    # the first copy of id 7 is rejected (total <= 0); the later copy is still a duplicate
    orders = spark.createDataFrame(
        [(7, 1, 1, -5.0, 0), (7, 1, 1, 10.0, 1), (8, 1, 1, None, 2), (None, 1, 1, 3.0, 3), (None, 1, 1, 3.0, 4)],
        "order_id long, customer_id long, restaurant_id long, order_total double, seq long")
    parents = spark.createDataFrame([(1,)], "k long")
    o = V.validate_orders(orders, parents.withColumnRenamed("k", "restaurant_id"),
                          parents.withColumnRenamed("k", "customer_id"))
    got = sorted((r["seq"], r["reject_reason"]) for r in o.collect())
    # NULL total passes (three-valued logic); NULL ids group together like pandas
    assert got == [(0, "non_positive_order_total"), (1, "duplicate_order_id"), (2, None), (3, None),
                   (4, "duplicate_order_id")]


def test_null_fk_is_orphan(spark):
    items = spark.createDataFrame([(1, None, 5.0), (2, 9, 5.0), (3, 10, -1.0), (4, 10, 0.0)],
                                  "order_item_id long, order_id long, item_price double")
    vo = spark.createDataFrame([(10,)], "order_id long")
    got = {r["order_item_id"]: r["reject_reason"] for r in V.validate_order_items(items, vo).collect()}
    assert got == {1: "orphan_order_id", 2: "orphan_order_id", 3: "negative_item_price", 4: None}


def test_valid_plus_rejected_is_input(t01):
    tagged = V.validate_all({
        "restaurants": fx.restaurants_dirty(t01), "customers": fx.customers_dirty(t01),
        "orders": fx.orders_dirty(t01), "order_items": fx.order_items_dirty(t01),
        "payments": fx.payments_dirty(t01), "deliveries": fx.deliveries_dirty(t01)})
    for name, df in tagged.items():
        n = df.count()
        assert V.valid(df).count() + V.rejected(df).count() == n, name


def test_lookup_join_keeps_rows_nulls_and_column_order(spark):
    from tiffin.operators.joins import attach_group_aggs, lookup_join
    big = spark.createDataFrame([(i, 1 if i < 200 else None if i < 300 else i) for i in range(400)], "id long, k long")
    small = spark.createDataFrame([(1, "one"), (350, "x"), (None, "nul")], "k long, v string")
    left = {r["id"]: r["v"] for r in lookup_join(big, small, ["k"]).collect()}
    assert len(left) == 400 and left[0] == "one" and left[250] is None and left[350] == "x"
    assert lookup_join(big, small, ["k"], "inner").columns == ["id", "k", "v"]
    assert lookup_join(big, small, ["k"], "left_anti").count() == 199
    safe = {r["id"]: r["v"] for r in lookup_join(big, small, ["k"], null_safe=True).collect()}
    assert safe[250] == "nul"
    n = {r["k"]: r["n"] for r in attach_group_aggs(big, ["k"], [F.count(F.lit(1)).alias("n")], null_safe=True).collect()}
    assert n[1] == 200 and n[None] == 100


def test_hot_keys_at_default_settings(spark):
    """One customer and the null customer hold two thirds of the orders."""
    rows = [(i, None if i % 3 == 0 else 7 if i % 3 == 1 else i, 5, "10.50" if i % 4 else "-1", i) for i in range(3_000)]
    orders = spark.createDataFrame(rows + [(1, 7, 5, "1", 9_000)],
                                   "order_id long, customer_id long, restaurant_id long, order_total string, seq long")
    restaurants, customers = spark.createDataFrame([(5,)], "restaurant_id long"), spark.createDataFrame([(7,)], "customer_id long")
    got = V.validate_orders(orders, restaurants, customers).groupBy("reject_reason").count().collect()
    assert {r[0]: r[1] for r in got} == {"non_positive_order_total": 750, "orphan_customer_id": 1_500,
                                         None: 750, "duplicate_order_id": 1}


def test_text_numbers_and_equal_seq(spark):
    orders = spark.createDataFrame([(1, "0"), (2, "10.50"), (3, "abc"), (4, None)], "order_id long, order_total string")
    df = orders.select("order_id", F.lit(1).alias("customer_id"), F.lit(1).alias("restaurant_id"), "order_total", F.lit(0).alias("seq"))
    one = lambda c: spark.createDataFrame([(1,)], f"{c} long")
    got = {r["order_id"]: r["reject_reason"] for r in V.validate_orders(df, one("restaurant_id"), one("customer_id")).collect()}
    assert got == {1: "non_positive_order_total", 2: None, 3: None, 4: None}
    same = spark.createDataFrame([(1, "a", 0), (1, "b", 0)], "customer_id long, name string, seq long")
    assert V.validate_customers(same).where("reject_reason = 'duplicate_customer_id'").count() == 1


def test_report_and_tags_agree_on_rows_equal_throughout(spark):
    df = spark.createDataFrame([(1, "a", 0), (1, "a", 0), (1, "a", 1), (2, "b", 2), (None, "c", 3), (None, "c", 3)],
                               "customer_id long, name string, seq long")
    tagged = V.tagged_outcomes(V.validate_customers(df)).collect()
    counted = V.customer_outcomes(df).collect()
    want = {None: 3, "duplicate_customer_id": 1, "missing_customer_id": 2}
    assert {r.reject_reason: r["rows"] for r in tagged} == want == {r.reject_reason: r["rows"] for r in counted}
