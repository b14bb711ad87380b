"""Sources and sinks as queries: each writes to the shared folder and returns what is read back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.functions.numeric import money, money_sum
from tiffin.operators import dq, validate
from tiffin.plans import daily_sums, pipeline
from tiffin.session import shared_dir
from tiffin.sources import growing, io
from tiffin.streaming import daily_feed


def csv_payments(spark: SparkSession, payments: DataFrame, valid_orders: DataFrame) -> DataFrame:
    """Payments as CSV, in another column order, read by the header and validated as text."""
    path = shared_dir(spark, "csv")
    io.write_csv(payments.select(*sorted(payments.columns, reverse=True)), path)
    raw = io.read_csv(spark, path, io.RAW_COLUMNS["payments"])
    keys = valid_orders.select(F.col("order_id").cast("string").alias("order_id"))
    return validate.validate_payments(raw, keys).select(
        F.col("payment_id").try_cast("long").alias("payment_id"), F.col("order_id").try_cast("long").alias("order_id"),
        F.col("amount").try_cast("double").alias("amount"), "reject_reason")


def csv_mixed_headers(spark: SparkSession, payments: DataFrame) -> DataFrame:
    """Payments in three layouts of one folder, read by each file's header.

    Columns in the usual order; in reverse; one column less and one more,
    whose values run over two lines.
    """
    path = shared_dir(spark, "layouts")
    text = payments.select(*[F.col(c).cast("string").alias(c) for c in io.RAW_COLUMNS["payments"]])
    part = [text.where(F.col("payment_id").cast("long") % 3 == i) for i in range(3)]
    layouts = [part[0], part[1].select(*reversed(text.columns)),
               part[2].drop("payment_status").withColumn("note", F.concat(F.lit('said "'), "payment_id", F.lit('",\nthen left')))]
    for df in layouts:
        df.write.mode("append").option("header", True).option("escape", '"').csv(path)
    got = io.read_csv(spark, path, io.RAW_COLUMNS["payments"], missing="null")
    return got.select(F.col("payment_id").try_cast("long").alias("payment_id"), F.col("order_id").try_cast("long").alias("order_id"),
                      "payment_method", F.col("amount").try_cast("double").alias("amount"), "payment_status")


def csv_malformed(spark: SparkSession, payments: DataFrame) -> DataFrame:
    """Payments of which some records are short, long or never closed: (outcome, records, payments, left)."""
    path = shared_dir(spark, "malformed")
    k = F.col("payment_id")
    short = F.concat_ws(",", *[F.col(c).cast("string") for c in io.RAW_COLUMNS["payments"][:-1]])
    line = F.concat_ws(",", short, F.when(k % 11 != 0, F.col("payment_status")), F.when(k % 13 == 0, F.lit("x")))
    last = payments.select(F.max("payment_id")).scalar()
    lines = payments.select(k, line.alias(",".join(io.RAW_COLUMNS["payments"])), short.alias("short"))
    raw = lines.columns[1]
    # a record as one field of a writer that knows neither separator nor quote
    whole = {"header": True, "sep": "\x01", "quote": "\x00", "escapeQuotes": False}
    lines.where(k != last).select(f"`{raw}`").write.mode("append").options(**whole).csv(path)
    lines.where(k == last).select(F.concat("short", F.lit(',"open')).alias(raw)).write.mode("append").options(**whole).csv(path)
    good, bad, n = io.land_csv(spark, path, io.RAW_COLUMNS["payments"], shared_dir(spark, "landed"))
    total = F.coalesce(F.sum(F.col("payment_id").try_cast("long")), F.lit(0))
    sides = [good.agg(F.count(F.lit(1)).alias("records"), total.alias("payments")).select(F.lit("fits").alias("outcome"), "records", "payments"),
             bad.withColumn("payment_id", F.substring_index("raw_record", ",", 1)).groupBy(F.col("malformed").alias("outcome"))
             .agg(F.count(F.lit(1)).alias("records"), total.alias("payments"))]
    return sides[0].union(sides[1]).withColumn("quarantined", F.lit(n).cast("long"))


def appended_years(spark: SparkSession, orders: DataFrame) -> DataFrame:
    """S3: every year's orders appended, half of the years a second time: (y, orders)."""
    path = shared_dir(spark, "days")
    rows = orders.select("order_id", F.year("order_date").alias("y"))
    io.append_partition(rows, path, "y")
    io.append_partition(rows.where("y % 2 = 0"), path, "y")
    return spark.read.schema("order_id long, y int").parquet(path).groupBy("y").agg(F.count(F.lit(1)).alias("orders"))


def compacted_years(spark: SparkSession, orders: DataFrame) -> DataFrame:
    """S3: every year's orders in four batches, merged, and a fifth batch after that: (y, orders, folders, merged)."""
    path, schema, key = shared_dir(spark, "growing"), "order_id long, y int", "y"
    growing.create(spark, path, schema, key)
    rows = orders.select("order_id", F.year("order_date").alias("y"))
    for batch in range(4):
        growing.append(rows.where(F.col("order_id") % 5 == batch), path, key, batch)
    merged = growing.compact(spark, path, schema, key, max_folders=3)
    growing.vacuum(spark, path, schema, key)
    growing.append(rows.where(F.col("order_id") % 5 == 4), path, key, 4)
    counts = growing.read(spark, path, schema, key).groupBy("y").agg(F.count(F.lit(1)).alias("orders"))
    return counts.join(growing.folders(spark, path, schema, key), "y").withColumn("merged", F.lit(merged).cast("long"))


def indexed_duplicates(spark: SparkSession, orders: DataFrame, restaurants: DataFrame, customers: DataFrame) -> DataFrame:
    """S3, V7: orders with even ids in a first batch, all orders in a second: (batch_id, reject_reason, orders).

    Orders count for the first day of their month here, which makes fewer folders.
    """
    orders = orders.withColumn("order_date", F.trunc("order_date", "month"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in orders.schema.fields)
    feed = daily_feed.Feed(spark, shared_dir(spark, "feed"), schema, buckets=16)
    feed.create(spark)
    for batch_id, rows in enumerate((orders.where("order_id % 2 = 0"), orders)):
        feed.ingest(rows, batch_id, restaurants, customers)
    stored = feed.read(spark, "valid_orders").unionByName(feed.read(spark, "rejected_orders"))
    return stored.groupBy("batch_id", "reject_reason").agg(F.count(F.lit(1)).alias("orders"))


def quarantine(spark: SparkSession, tagged: DataFrame) -> DataFrame:
    """Rows of both sinks, and as observed while writing: (side, rows, observed)."""
    good, bad, *seen = io.write_split(tagged, shared_dir(spark, "split"))
    sides = [df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(side).alias("side"), "rows", F.lit(n).cast("long").alias("observed"))
        for side, df, n in zip((io.VALID, io.REJECTED), (good, bad), seen)]
    return sides[0].union(sides[1])


def staged_orders(spark: SparkSession, orders: DataFrame) -> DataFrame:
    """Two versions of a staging table, the pointer on the second: revenue by status of what is current."""
    root = shared_dir(spark, "staging")
    for version, rows in (("v1", orders.limit(0)), ("v2", orders)):
        io.write_table(rows, f"{root}/{version}/orders")
        io.point_to(spark, f"{root}/current", version)
    now = spark.read.parquet(f"{root}/{io.current(spark, f'{root}/current')}/orders")
    return now.groupBy("order_status").agg(F.count(F.lit(1)).alias("orders"), money_sum("order_total").alias("revenue"))


def published_orders(spark: SparkSession, fact_orders: DataFrame) -> DataFrame:
    """The bucketed copy, read back as a table: (rows, observed, revenue)."""
    path = shared_dir(spark, "published")
    table = "wh_" + path.rstrip("/").rpartition("/")[2].replace("-", "_")
    seen = io.publish_bucketed(fact_orders, table, "order_id", path)
    return spark.table(table).agg(F.count(F.lit(1)).alias("rows"), F.lit(seen).cast("long").alias("observed"),
                                  money_sum(money("order_total")).alias("revenue"))


def bucketed_join(spark: SparkSession, fact_orders: DataFrame, fact_order_items: DataFrame) -> DataFrame:
    """Published orders and items joined on their buckets: neither side is dealt again."""
    tables = []
    for df in (fact_orders, fact_order_items):
        path = shared_dir(spark, "published")
        tables.append("wh_" + path.rstrip("/").rpartition("/")[2].replace("-", "_"))
        io.publish_bucketed(df, tables[-1], "order_id", path)
    orders, items = map(spark.table, tables)
    per_order = items.groupBy("order_id").agg(F.count(F.lit(1)).alias("items"), money_sum("item_price").alias("price"))
    joined = orders.hint("merge").join(per_order, "order_id")
    return joined.groupBy("order_status").agg(F.count(F.lit(1)).alias("orders"), F.sum("items").alias("items"),
                                              money_sum(money("price")).alias("item_revenue"))


def job_run(spark: SparkSession, raw: dict[str, DataFrame], reviews_raw: DataFrame, run_at: dt.datetime) -> DataFrame:
    """One run for a logical time, as its tables tell: its health row, its test row, what was published."""
    root = shared_dir(spark, "run")
    res = pipeline.run(spark, raw, root, run_at, threshold=1.0, reviews_raw=reviews_raw)
    rates = spark.read.schema(pipeline.VALIDATION_RUNS_SCHEMA).parquet(f"{root}/meta/validation_runs")
    tests = spark.read.schema(pipeline.TEST_RUNS_SCHEMA).parquet(f"{root}/meta/test_runs")
    stages = spark.read.schema(pipeline.LEDGER_SCHEMA).parquet(f"{root}/meta/ledger").groupBy("run_at").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("nr", "stage"))), lambda s: s["stage"]), ",").alias("stages"))
    orders = spark.table("wh_fact_orders").agg(F.count(F.lit(1)).alias("published_orders"))
    return rates.join(tests, "run_at").join(stages, "run_at").select(
        "*", F.lit(orders.first()[0]).cast("long").alias("published_orders"),
        F.lit(res.published["fact_orders"]).cast("long").alias("written_orders"))


def summed(spark: SparkSession, star: dict[str, DataFrame], tables: tuple[str, ...]) -> dict[str, DataFrame]:
    """Sums of the facts in three loads: the second repeated, all days of the third late."""
    root, day = shared_dir(spark, "sums"), dt.date(2024, 1, 1)
    daily_sums.create(spark, root, tables)
    # the facts are written once, as the daily job does
    facts = {f: io.land(star[f], shared_dir(spark, f)) for f in {daily_sums.fact_of(t) for t in tables}}
    late, odd = F.col("order_id") % 9 == 0, F.col("order_id") % 2 == 1

    def load(batch: int, which) -> None:
        daily_sums.add(spark, root, batch, {f: df.where(which) for f, df in facts.items()}, day, tables)
    load(0, ~late & ~odd)
    load(1, ~late & odd)
    load(1, ~late & odd)
    load(2, late)
    return daily_sums.read(spark, root, tables)


def run_log(spark: SparkSession, runs: DataFrame) -> DataFrame:
    """A log seeded once, seeded again in vain and appended to: (runs, rows, last_run)."""
    path = shared_dir(spark, "log")
    log = runs.select("run_at", F.col("total_valid").cast("long"), F.col("total_rejected").cast("long"), "rejection_rate")
    io.seed_if_absent(log, path)
    io.seed_if_absent(log.limit(0), path)
    schema = "run_at timestamp_ntz, total_valid long, total_rejected long, rejection_rate double"
    io.append_row(spark, path, {"run_at": dt.datetime(2100, 1, 1), "total_valid": 1, "total_rejected": 0,
                                "rejection_rate": 0.0}, schema)
    return spark.read.schema(schema).parquet(path).agg(
        F.count(F.lit(1)).alias("runs"), F.sum(F.col("total_valid") + F.col("total_rejected")).alias("rows"),
        F.max("run_at").alias("last_run"))


def test_artifact(spark: SparkSession, results: DataFrame) -> DataFrame:
    """The test results as one JSON document, read back and summarised."""
    path = shared_dir(spark, "artifact")
    results.agg(F.collect_list(F.struct("test_name", "status", "failures")).alias("results")).write.json(path)
    return dq.summarize_json(io.read_test_artifact(spark, path))
