import datetime as dt
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tiffin.plans import pipeline
from tiffin.sources import fixtures as fx
from tiffin.sources import io

SF = "/root/testdata/sf0.001"


def _root():
    return tempfile.mkdtemp(prefix="tiffin-test-")


def _clean_raw(t):
    return {"restaurants": fx.restaurants(t), "customers": fx.customers(t), "orders": fx.orders(t),
            "order_items": fx.order_items(t).withColumn("seq", F.lit(0)), "payments": fx.payments(t),
            "deliveries": fx.deliveries(t)}


def test_pipeline_clean_run_publishes(spark):
    t = fx.loader(spark, SF)
    root = _root()
    res = pipeline.run(spark, _clean_raw(t), root, dt.datetime(2024, 1, 2), reviews_raw=fx.reviews_raw(t))
    assert res.worst_rate == 0.0 and res.tests_total == 37 and res.tests_passed == 37
    assert res.published["fact_orders"] == t("orders").count()
    runs = spark.read.parquet(f"{root}/meta/validation_runs").collect()
    assert len(runs) == 1 and runs[0]["total_rejected"] == 0
    # warehouse copy is bucketed by key
    assert spark.table("wh_fact_orders").count() == res.published["fact_orders"]
    assert [r["passed_tests"] for r in spark.read.parquet(f"{root}/meta/test_runs").collect()] == [37]


def test_pipeline_gate_trips_after_recording(spark):
    t = fx.loader(spark, SF)
    raw = _clean_raw(t)
    raw["orders"] = fx.orders_dirty(t)
    root = _root()
    with pytest.raises(pipeline.GateFailed):
        pipeline.run(spark, raw, root, dt.datetime(2024, 1, 3))
    # quarantine and the health row exist, nothing was published
    assert spark.read.parquet(f"{root}/validated/orders/outcome=rejected").count() > 0
    assert spark.read.parquet(f"{root}/meta/validation_runs").count() == 1
    assert not os.path.exists(f"{root}/warehouse")
    # the test-run row is written all the same
    assert [r["total_tests"] for r in spark.read.parquet(f"{root}/meta/test_runs").collect()] == [0]


def test_csv_multiline_round_trip(spark):
    root = _root()
    rows = [("1", 'say "hi"\nthen leave', "a, b"), ("2", "", None), ("1", "x", "y")]
    df = spark.createDataFrame(rows, "customer_id string, name string, email string")
    io.write_csv(df.coalesce(1), f"{root}/csv")
    back = io.read_csv(spark, f"{root}/csv", ["customer_id", "name", "email"])
    got = sorted((r["customer_id"], r["name"], r["email"]) for r in back.collect())
    assert got == sorted([("1", 'say "hi"\nthen leave', "a, b"), ("2", None, None), ("1", "x", "y")])
    # file order is kept: the second "1" is the duplicate
    from tiffin.operators import validate as V
    tagged = V.validate_customers(back.withColumn("customer_id", F.col("customer_id").cast("long")))
    assert tagged.where(F.col("reject_reason") == "duplicate_customer_id").first()["name"] == "x"


def test_append_partition_is_idempotent(spark):
    root = _root()
    day = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-01")], "id int, d string")
    io.append_partition(day, f"{root}/t", "d")
    io.append_partition(day, f"{root}/t", "d")
    io.append_partition(day.withColumn("d", F.lit("2024-01-02")), f"{root}/t", "d")
    assert spark.read.parquet(f"{root}/t").count() == 4


def test_json_artifact_summary(spark):
    from tiffin.operators import dq
    root = _root()
    with open(f"{root}/run_results.json", "w") as f:
        json.dump({"results": [{"status": "pass"}, {"status": "fail"}, {"status": "pass"}]}, f)
    s = dq.summarize_json(io.read_test_artifact(spark, f"{root}/run_results.json")).first()
    assert (s["total_tests"], s["passed_tests"]) == (3, 2)


def test_seed_if_absent_and_metadata_append(spark):
    root = _root()
    a = spark.createDataFrame([(1,)], "x int")
    io.seed_if_absent(a, f"{root}/seed")
    io.seed_if_absent(a.union(a), f"{root}/seed")
    assert spark.read.parquet(f"{root}/seed").count() == 1
    for i in range(2):
        io.append_row(spark, f"{root}/runs", {"run_at": dt.datetime(2024, 1, 1 + i), "total_tests": 37,
                                              "passed_tests": 37}, pipeline.TEST_RUNS_SCHEMA)
    assert spark.read.parquet(f"{root}/runs").count() == 2


def test_streaming_daily_feed(spark):
    from tiffin.streaming import daily_feed
    t = fx.loader(spark, SF)
    root = _root()
    fx.restaurants(t).write.parquet(f"{root}/restaurants")
    fx.customers(t).write.parquet(f"{root}/customers")
    orders = fx.orders_dirty(t)
    schema = orders.schema.simpleString()[len("struct<"):-1].replace(":", " ")
    years = [r[0] for r in orders.select(F.year("order_date")).distinct().orderBy(F.col("year(order_date)")).collect()][:2]
    for y in years:   # two daily drops
        orders.where(F.year("order_date") == y).write.parquet(f"{root}/landing/drop={y}")
    q = daily_feed.ingest_orders(spark, f"{root}/landing/*", schema, f"{root}/restaurants",
                                 f"{root}/customers", f"{root}/out", f"{root}/ckpt")
    q.awaitTermination(300)
    c = daily_feed.daily_counts(spark, f"{root}/out", schema).agg(F.sum("valid"), F.sum("rejected")).first()
    assert c[0] + c[1] == orders.where(F.year("order_date").isin(years)).count()


def test_two_drops_of_one_day_keep_all_orders_and_later_copies_are_rejected(spark):
    from tiffin.streaming import daily_feed
    t = fx.loader(spark, SF)
    root = _root()
    fx.restaurants(t).write.parquet(f"{root}/restaurants")
    fx.customers(t).write.parquet(f"{root}/customers")
    day = fx.orders(t).limit(26).withColumn("order_date", F.lit("2024-01-01").cast("date"))
    day = spark.createDataFrame(day.collect(), day.schema)
    schema = day.schema.simpleString()[len("struct<"):-1].replace(":", " ")
    first, second = day.limit(15), day.exceptAll(day.limit(15))
    drops = [first, second, day.withColumn("order_date", F.lit("2024-01-02").cast("date"))]
    for i, drop in enumerate(drops):
        drop.write.parquet(f"{root}/landing/drop={i}")
        daily_feed.ingest_orders(spark, f"{root}/landing/*", schema, f"{root}/restaurants",
                                 f"{root}/customers", f"{root}/out", f"{root}/ckpt").awaitTermination(300)
    feed = daily_feed.Feed(spark, f"{root}/out", schema)
    valid = feed.read(spark, "valid_orders")
    assert valid.count() == 26 == valid.select("order_id").distinct().count()
    rejected = feed.read(spark, "rejected_orders").groupBy("reject_reason").count().collect()
    assert [tuple(r) for r in rejected] == [("duplicate_order_id", 26)]


def _write_raw_csvs(spark, root, t, names):
    restaurants = fx.restaurants(t).orderBy("restaurant_id")
    reviews = fx.reviews_raw(t)
    restaurants = restaurants.join(reviews, "restaurant_id", "left").orderBy("restaurant_id")
    frames = {"restaurants": restaurants.select(
        *[F.col(f"`{c}`") if c in restaurants.columns else F.lit("x").alias(c) for c in io.RAW_COLUMNS["restaurants"]][::-1],
        F.lit(1).alias("unasked")),
        "customers": fx.customers(t), "orders": fx.orders(t), "order_items": fx.order_items(t),
        "payments": fx.payments(t), "deliveries": fx.deliveries(t)}
    first = restaurants.agg(F.min("restaurant_id")).first()[0]
    # orders refer to positions in the restaurant file
    frames["orders"] = frames["orders"].withColumn("restaurant_id", F.greatest(F.lit(0), F.col("restaurant_id") - first))
    for n, df in frames.items():
        cols = sorted(c for c in df.columns if c != "seq") if n != "restaurants" else df.columns  # not in the usual order
        io.write_csv(df.select(*[F.col(f"`{c}`") for c in cols]).coalesce(1), f"{root}/raw_{n}.csv")


def test_raw_files_to_published_star(spark):
    t = fx.loader(spark, SF)
    root = _root()
    _write_raw_csvs(spark, root, t, None)
    res = pipeline.run_files(spark, root, f"{root}/run", dt.datetime(2024, 1, 4), threshold=0.5)
    assert (res.tests_total, res.tests_passed) == (37, 37)
    assert res.published["fact_orders"] == t("orders").count() and res.published["fact_reviews"] > 0
    assert {r["entity"]: r["total"] for r in res.report}["restaurants"] == t("part").count()
    ids = spark.table("wh_dim_restaurant").agg(F.min("restaurant_id"), F.max("restaurant_id")).first()
    assert tuple(ids) == (0, t("part").count() - 1)


def test_reviews_of_a_rejected_restaurant_stay_out(spark):
    t = fx.loader(spark, SF)
    raw = _clean_raw(t)
    bad = t("conversations").agg(F.max("conv_id")).first()[0]
    raw["restaurants"] = raw["restaurants"].withColumn("name", F.when(F.col("restaurant_id") == bad, "").otherwise(F.col("name")))
    raw["orders"] = raw["orders"].where(F.col("restaurant_id") != bad)
    keep = raw["orders"].select("order_id")
    for n in ("order_items", "payments", "deliveries"):
        raw[n] = raw[n].join(keep, "order_id", "left_semi")
    root = _root()
    res = pipeline.run(spark, raw, root, dt.datetime(2024, 1, 5), threshold=0.5, reviews_raw=fx.reviews_raw(t))
    assert res.tests_passed == 37
    assert spark.table("wh_fact_reviews").where(F.col("restaurant_id") == bad).count() == 0


def test_a_failure_in_the_fifth_table_leaves_the_old_set_live(spark, monkeypatch):
    t = fx.loader(spark, SF)
    root = _root()
    res = pipeline.run(spark, _clean_raw(t), root, dt.datetime(2024, 1, 6), reviews_raw=fx.reviews_raw(t))
    live = io.current(spark, f"{root}/warehouse_current"), io.current(spark, f"{root}/staging_current")
    write, seen = io.publish_bucketed, []

    def failing(*a, **k):
        seen.append(a)
        if len(seen) == 5:
            raise RuntimeError("disk")
        return write(*a, **k)
    monkeypatch.setattr(io, "publish_bucketed", failing)
    with pytest.raises(RuntimeError, match="disk"):
        pipeline.run(spark, _clean_raw(t), root, dt.datetime(2024, 1, 7), reviews_raw=fx.reviews_raw(t))
    assert io.current(spark, f"{root}/warehouse_current") == live[0] != io.current(spark, f"{root}/staging_current")
    assert spark.table("wh_fact_orders").count() == res.published["fact_orders"]


def test_failing_model_still_writes_a_test_row(spark, monkeypatch):
    from tiffin.operators import model
    t = fx.loader(spark, SF)
    root = _root()
    monkeypatch.setattr(model, "build_star", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        pipeline.run(spark, _clean_raw(t), root, dt.datetime(2024, 1, 8))
    assert spark.read.parquet(f"{root}/meta/test_runs").count() == 1


def test_broken_data_tests_withhold_the_publish(spark, monkeypatch):
    from tiffin.operators import model
    t = fx.loader(spark, SF)
    root = _root()
    build = model.build_star
    monkeypatch.setattr(model, "build_star", lambda st, s: build(st, s) | {"dim_time": model.dim_time(s).where("hour_id > 3")})
    with pytest.raises(pipeline.GateFailed, match="data tests"):
        pipeline.run(spark, _clean_raw(t), root, dt.datetime(2024, 1, 9))
    assert io.current(spark, f"{root}/warehouse_current") is None
    assert [r["passed_tests"] for r in spark.read.parquet(f"{root}/meta/test_runs").collect()] == [33]  # of 34: no reviews here


def test_csv_columns_go_by_the_header(spark):
    root = _root()
    spark.createDataFrame([("Ann", "7")], "name string, customer_id string").coalesce(1).write.option("header", True).csv(f"{root}/c")
    assert io.read_csv(spark, f"{root}/c", ["customer_id", "name"]).drop("seq").first().asDict() == {"customer_id": "7", "name": "Ann"}
    with pytest.raises(ValueError, match="email"):
        io.read_csv(spark, f"{root}/c", ["email"])
