import pytest
from pyspark.sql import functions as F

from tiffin.operators import generate, model, ordered, reviews, transform
from tiffin.sources import fixtures as fx


def test_review_list_edge_cases(spark):
    fields = {None: [], "": [], "[]": [], "[(broken": None, "[('Rated 3.0', 'a', 'extra')]": None, "{'a': 1}": None,
              "('ab', 'cd')": None, "[('Rated 4.0', 'RATED\\n  Great food ')]": [(4.0, "Great food")],
              "[('no rating', 'RATED ok RATED')]": [(None, "ok RATED")], "[(None, 5), ['Rated 2', '\\x1c a\\u2003']]":
              [(None, ""), (2.0, "a")]}
    df = spark.createDataFrame(list(enumerate(fields)), "restaurant_id long, reviews_list string")
    parsed = reviews.with_parsed(df)
    bad = {r["restaurant_id"] for r in reviews.rejected_reviews(parsed).collect()}
    assert bad == {i for i, want in enumerate(fields.values()) if want is None}
    got = {}
    for r in reviews.parsed_reviews(parsed).orderBy("review_pos").collect():
        got.setdefault(r["restaurant_id"], []).append((r["review_rating"], r["review_text"]))
    assert got == {i: want for i, want in enumerate(fields.values()) if want}


def test_review_round_trip(spark, t01):
    parsed = reviews.with_parsed(fx.reviews_raw(t01))
    rows = reviews.parsed_reviews(parsed)
    assert rows.count() == 496
    bad = sorted(r["restaurant_id"] for r in reviews.rejected_reviews(parsed).collect())
    assert bad == [3, 40, 77]


def test_cleaning_expressions(spark):
    df = spark.createDataFrame(
        [(1, " A b ", "Cafe, Bar", "4.1/5", "4.0", "Yes", "No", "1,200", "x", "Delivery", "u", "a")],
        "restaurant_id long, name string, rest_type string, rate string, votes string, online_order string, "
        "book_table string, `approx_cost(for two people)` string, location string, `listed_in(type)` string, "
        "url string, address string")
    r = transform.clean_restaurants(df).first()
    assert (r["restaurant_name"], r["restaurant_type"], r["rating"], r["vote_count"]) == ("A b", "Cafe", 4.1, 4)
    assert (r["online_order_enabled"], r["table_booking_enabled"], r["avg_cost_for_two"]) == (True, False, 1200.0)
    bad = df.withColumn("rate", F.lit("NEW")).withColumn("votes", F.lit("")).first()
    r2 = transform.clean_restaurants(spark.createDataFrame([bad], df.schema)).first()
    assert r2["rating"] is None and r2["vote_count"] is None


def test_dense_ids_distributed_path_is_gapless(spark, t01):
    li = t01("lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    ids = ordered.dense_ids(li, ["l_orderkey", "l_linenumber", "l_partkey"], "rid")
    agg = ids.agg(F.min("rid"), F.max("rid"), F.count_distinct("rid"), F.count(F.lit(1))).first()
    assert tuple(agg) == (1, 60000, 60000, 60000)
    from pyspark.sql import Window
    ref = li.withColumn("rid", F.row_number().over(Window.orderBy("l_orderkey", "l_linenumber", "l_partkey")))
    assert ids.exceptAll(ref.select(*ids.columns)).count() == 0


def test_exact_median(spark):
    df = spark.createDataFrame([(float(x),) for x in [5, 1, 3, 2, 4, 6]], "v double")
    assert ordered.exact_median(df, "v").first()["median"] == 3.5
    assert ordered.exact_median(df.where("v < 6"), "v").first()["median"] == 3.0


def test_residual_allocation_sums_exactly(spark, t01):
    from tiffin.functions.numeric import cents
    items = fx.order_items(t01).select("order_id", "order_item_id", cents("item_price").alias("w"))
    tot = fx.orders(t01).select("order_id", cents("order_total").alias("total_cents"))
    alloc = generate.allocate_residual(items.join(tot, "order_id"), "order_id", "order_item_id", "w", "total_cents")
    s = alloc.groupBy("order_id").agg(F.sum("allocated").alias("s")).join(
        fx.orders(t01).select("order_id", "order_total"), "order_id")
    assert s.where(F.col("s") != F.col("order_total")).count() == 0


def test_weighted_assignment_every_child_once(spark, t01):
    r = generate.impute(transform.clean_restaurants(fx.restaurants(t01))).select("restaurant_id", "weight")
    o = fx.orders(t01).select("order_id")
    a = generate.weighted_assignment(r, o, "restaurant_id", "weight", "order_id")
    assert a.count() == o.count() == a.select("order_id").distinct().count()


def test_dim_time_and_date(spark, t01):
    dt = {r["hour_id"]: r["time_period"] for r in model.dim_time(spark).collect()}
    assert dt[6] == "Breakfast" and dt[15] == "Lunch" and dt[18] == "Evening Snacks" and dt[22] == "Dinner"
    assert dt[23] == dt[5] == "Late Night" and len(dt) == 24
    orders = spark.createDataFrame([("2024-01-06",), ("2024-01-08",)], "order_date string") \
        .select(F.to_date("order_date").alias("order_date"))
    d = {str(r["date_id"]): (r["day_of_week"], r["is_weekend"], r["day_name"]) for r in model.dim_date(orders).collect()}
    assert d == {"2024-01-06": (6, True, "Saturday"), "2024-01-08": (1, False, "Monday")}


@pytest.mark.parametrize("minutes,bucket", [(5, "< 20 min"), (20, "20–30 min"), (44, "30–45 min"), (None, "45+ min")])
def test_delivery_buckets(spark, minutes, bucket):
    from tiffin.plans import kpi
    df = spark.createDataFrame([(minutes,)], "delivery_time_minutes int")
    assert kpi.delivery_time_buckets({"fact_deliveries": df}).first()["bucket"] == bucket


def test_leaderboards_by_id_split_shared_names(spark):
    from tiffin.plans import kpi
    fo = spark.createDataFrame([(1, 10, "Delivered", 5.0), (2, 11, "Delivered", 7.0), (3, 11, "Cancelled", 1.0)],
                               "order_id long, restaurant_id long, order_status string, order_total double")
    dr = spark.createDataFrame([(10, "Twin"), (11, "Twin")], "restaurant_id long, restaurant_name string")
    star = {"fact_orders": fo, "dim_restaurant": dr}
    assert [(r["restaurant"], r["orders"]) for r in kpi.top_restaurants(star).collect()] == [("Twin", 2)]
    by_id = [(r["restaurant_id"], r["orders"]) for r in kpi.top_restaurants(star, by="id").collect()]
    assert by_id == [(11, 1), (10, 1)]


def test_median_of_a_value_most_rows_share(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 10 < 9, F.lit(300.0)).otherwise(F.col("id").cast("double")).alias("v"))
    assert ordered.exact_median(df, "v").first()["median"] == 300.0


def test_weighted_choice_of_many_light_parents(spark):
    parents = spark.range(50_003).select(F.col("id").alias("p"), F.lit(0.1).alias("w"))
    children = spark.range(20_000).select(F.col("id").alias("c"))
    got = generate.weighted_assignment(parents, children, "p", "w", "c")
    agg = got.agg(F.count(F.lit(1)), F.count_distinct("c"), F.count_distinct("p"), F.max("p")).first()
    assert agg[0] == agg[1] == 20_000 and agg[2] > 16_000 and agg[3] > 49_000


def test_weights_steer_the_choice(spark):
    parents = spark.createDataFrame([(1, 1.0), (2, 3.0), (3, 0.0), (4, None)], "p long, w double")
    got = generate.weighted_assignment(parents, spark.range(8_000).select(F.col("id").alias("c")), "p", "w", "c")
    n = {r["p"]: r["count"] for r in got.groupBy("p").count().collect()}
    assert set(n) == {1, 2} and abs(n[2] - 6_000) < 200


def test_weighted_choice_with_a_heavy_parent_against_bisection(spark):
    """A parent with a third of all weight meets more ranges than one array lists; two have none between them."""
    from bisect import bisect_right
    weights = {i: 0.25 for i in range(30_000)} | {30_000: 3_750.0, 30_001: 0.0, 30_002: 0.25}
    parents = spark.createDataFrame(list(weights.items()), "p long, w double")
    children = spark.range(3_000).select(F.when(F.col("id") != 7, F.col("id")).alias("c"))
    got = {r["c"]: r["p"] for r in generate.weighted_assignment(parents, children, "p", "w", "c").collect()}
    begins, owner, total = [], [], 0
    for k in sorted(weights):
        if weights[k]:
            begins.append(total)
            owner.append(k)
            total += int(weights[k] * generate.WEIGHT_SCALE)
    point = {c: c * generate.POINT_FACTOR % generate.POINT_MODULUS * total // generate.POINT_MODULUS
             for c in range(3_000) if c != 7}
    assert got == {c: owner[bisect_right(begins, at) - 1] for c, at in point.items()}
    assert generate.RANGES_AT_ONCE < 30_000 / 3
    nobody = spark.createDataFrame([(1, 0.0)], "p long, w double")
    assert generate.weighted_assignment(nobody, children, "p", "w", "c").count() == 0


def test_exact_arithmetic(spark):
    from tiffin.functions.numeric import idiv, money_avg, round_ratio
    row = spark.range(1).select(
        idiv(F.lit(1999999999), F.lit(1000000000)), round_ratio(F.lit(12449999999), F.lit(10 ** 12), 2, 100),
        idiv(F.lit(7), F.lit(0)), round_ratio(F.lit(-5), F.lit(1000), 2), money_avg(F.lit(1), F.lit(2)),
        generate.anchored_amount_cents(F.lit(550.5), F.lit(1), F.lit(20))).first()
    assert (int(row[0]), row[1], row[2], row[3], float(row[4]), row[5]) == (1, 1.24, None, -0.01, 0.01, 27525)


def test_free_items_share_evenly(spark):
    df = spark.createDataFrame([(1, 1, 0, 100), (1, 2, 0, 100), (1, 3, 0, 100), (2, 4, 5, 11)],
                               "g long, l long, w long, total long")
    got = {r["l"]: float(r["allocated"]) for r in generate.allocate_residual(df, "g", "l", "w", "total").collect()}
    assert got == {1: 0.33, 2: 0.33, 3: 0.34, 4: 0.11}


def test_hour_outside_the_day_fails_its_test(spark):
    from tiffin.operators import dq
    star = {"dim_time": model.dim_time(spark), "fact_orders": spark.createDataFrame([(1, 25), (2, 3)], "order_id long, hour_id int")}
    tests = [t for t in dq.star_tests() if t.model == "fact_orders" and t.column == "hour_id"]
    assert [r["failures"] for r in dq.run_tests(star, tests).collect()] == [1]


def test_profile_without_the_columns(spark):
    from tiffin.operators import profile
    assert profile.distinct_samples(spark.range(3), {"rate": 20}).count() == 0


def test_nan_is_missing(spark):
    from tiffin.functions.fmt import format_report
    assert format_report(spark.createDataFrame([(float("nan"),), (2.5,)], "x double")).collect()[0][0] == "—"


def test_cuisines_keep_their_digits_and_lose_outer_spaces(spark):
    df = spark.createDataFrame([(1, " 0 Zero ,1 One 1, ,2"), (2, None)], "restaurant_id long, cuisines string")
    assert [r["cuisine"] for r in transform.restaurant_cuisines(df).collect()] == ["0 Zero", "1 One 1", "2"]
