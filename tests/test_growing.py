import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tiffin.sources import growing, io
from tiffin.streaming import daily_feed

SCHEMA, KEY = "order_id long, d string", "d"


def table(spark, batches):
    path = tempfile.mkdtemp(prefix="tiffin-growing-") + "/t"
    growing.create(spark, path, SCHEMA, KEY)
    for nr, rows in enumerate(batches):
        growing.append(spark.createDataFrame(rows, SCHEMA), path, KEY, nr)
    return path


def held(spark, path):
    return sorted(map(tuple, growing.read(spark, path, SCHEMA, KEY).select("order_id", "d", "batch_id").collect()))


def spread(spark, path):
    return {r.d: r.folders for r in growing.folders(spark, path, SCHEMA, KEY).collect()}


def test_compaction_keeps_rows_and_bounds_folders(spark):
    path = table(spark, [[(i, "a"), (10 + i, "b")] for i in range(4)] + [[(99, "c")]])
    rows = held(spark, path)
    assert len(rows) == 9 and spread(spark, path) == {"a": 4, "b": 4, "c": 1}
    assert growing.compact(spark, path, SCHEMA, KEY, max_folders=2) == 2
    assert held(spark, path) == rows and spread(spark, path) == {"a": 1, "b": 1, "c": 1}
    # nothing is spread any more
    assert growing.compact(spark, path, SCHEMA, KEY, max_folders=2) == 0
    # later batches of one key: only that key is merged again, the other stays under its version
    for nr in (5, 6):
        growing.append(spark.createDataFrame([(100 + nr, "a")], SCHEMA), path, KEY, nr)
    assert growing.compact(spark, path, SCHEMA, KEY, max_folders=2) == 1
    assert held(spark, path) == sorted(rows + [(105, "a", 5), (106, "a", 6)])
    versions = {(r.key, r.version) for r in growing._covered(spark, path).collect()}
    assert versions == {("a", 2), ("b", 1)}
    # replaced folders go: 4 + 2 of a, 4 of b, and the first merge of a
    assert growing.vacuum(spark, path, SCHEMA, KEY) == 11
    assert held(spark, path) == sorted(rows + [(105, "a", 5), (106, "a", 6)])
    assert growing.vacuum(spark, path, SCHEMA, KEY) == 0


def test_a_failure_before_the_switch_changes_nothing(spark, monkeypatch):
    path = table(spark, [[(i, "a")] for i in range(3)])
    rows = held(spark, path)
    real = io.point_to

    def fails(*_):
        raise RuntimeError("lost")
    monkeypatch.setattr(io, "point_to", fails)
    with pytest.raises(RuntimeError, match="lost"):
        growing.compact(spark, path, SCHEMA, KEY, max_folders=1)
    # merged rows are there, but no reader follows them
    assert os.path.isdir(f"{path}/merged/version=1") and held(spark, path) == rows and spread(spark, path) == {"a": 3}
    monkeypatch.setattr(io, "point_to", real)
    assert growing.compact(spark, path, SCHEMA, KEY, max_folders=1) == 1
    assert held(spark, path) == rows and spread(spark, path) == {"a": 1}


def test_a_replayed_batch_after_its_compaction(spark):
    path = table(spark, [[(1, "a")], [(2, "a")]])
    growing.compact(spark, path, SCHEMA, KEY, max_folders=1)
    growing.append(spark.createDataFrame([(2, "a")], SCHEMA), path, KEY, 1)
    assert held(spark, path) == [(1, "a", 0), (2, "a", 1)]


def test_a_batch_reads_only_the_buckets_of_its_ids(spark):
    root = tempfile.mkdtemp(prefix="tiffin-feed-")
    schema = "order_id long, customer_id long, restaurant_id long, order_date date, order_total double, seq long"
    feed = daily_feed.Feed(spark, root, schema)
    feed.create(spark)
    parents = spark.createDataFrame([(1,)], "k long")
    restaurants, customers = parents.withColumnRenamed("k", "restaurant_id"), parents.withColumnRenamed("k", "customer_id")
    rows = spark.range(400).select(F.col("id").alias("order_id"), F.lit(1).cast("long").alias("customer_id"),
                                   F.lit(1).cast("long").alias("restaurant_id"), F.lit("2024-01-01").cast("date").alias("order_date"),
                                   F.lit(5.0).alias("order_total"), F.col("id").alias("seq"))
    feed.ingest(rows, 0, restaurants, customers)
    few = rows.where("order_id IN (3, 7)").unionByName(rows.where("order_id = 3").withColumn("order_id", F.lit(1000).cast("long")))
    files = feed.seen(few, 1).inputFiles()
    read = {f.split("bucket=")[1].split("/")[0] for f in files if "bucket=" in f}
    assert all("/order_ids/" in f for f in files) and sorted(r[0] for r in feed.seen(few, 1).collect() if r[0] in (3, 7, 1000)) == [3, 7]
    plan = feed.seen(few, 1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "bucket" in plan.split("PartitionFilters")[1][:200] and read
    feed.ingest(few, 1, restaurants, customers)
    feed.ingest(few, 1, restaurants, customers)  # a replay
    got = sorted((r.order_id, r.reject_reason) for r in feed.read(spark, "rejected_orders").collect())
    assert got == [(3, "duplicate_order_id"), (7, "duplicate_order_id")]
    assert feed.read(spark, "valid_orders").count() == 401
    assert feed.compact(spark, max_folders=1) > 0
    assert feed.read(spark, "valid_orders").count() == 401 and feed.seen(few, 2).count() >= 3


def test_pointers_are_numbered(spark):
    path = tempfile.mkdtemp(prefix="tiffin-pointer-") + "/p"
    assert io.current(spark, path) is None
    for v in ("b", "a", "c", "a"):
        io.point_to(spark, path, v)
        assert io.current(spark, path) == v
