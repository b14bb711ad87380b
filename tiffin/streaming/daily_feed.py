"""Incremental daily ingestion with Structured Streaming (S3 + V, per day).

The batch job receives new raw files at a time.  Expressed as a stream over
the landing folder, each new file set becomes one micro-batch
(``trigger(availableNow=True)`` processes whatever arrived and stops, so a
scheduler can run it like a batch job).  A micro-batch is validated against
the parent keys already published and the orders stored by other batches, and
added to growing tables (``sources.growing``) by order date: a day may arrive
in several drops, and a replayed batch (after a crash, the checkpoint decides
what is replayed) replaces its own rows instead of duplicating them.

The ids of stored orders are a table of their own, dealt into hash buckets.  A
batch reads the buckets that its own ids fall into, and adds to these; no batch
reads stored orders again.  ``compact_feed`` keeps days and buckets in few
folders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.operators import validate
from tiffin.operators.joins import lookup_join
from tiffin.sources import growing, io

SINKS = ("valid_orders", "rejected_orders")
#: Hash buckets of the index of stored order ids; a feed keeps the number it began with.
BUCKETS = 256
DAY, BUCKET = "order_date", "bucket"


class Feed:
    """The tables of a feed: valid and rejected orders by day, and the index of order ids by bucket."""

    def __init__(self, spark: SparkSession, root: str, schema: str, buckets: int = BUCKETS):
        self.root, self.buckets = root, buckets
        kinds = spark.createDataFrame([], schema).schema
        rows = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kinds.fields)
        self.ids = (f"order_id {kinds['order_id'].dataType.simpleString()}, {BUCKET} int", BUCKET)
        self.orders = (f"{rows}, reject_reason string", DAY)

    def create(self, spark: SparkSession) -> None:
        for name in SINKS:
            growing.create(spark, f"{self.root}/{name}", *self.orders)
        growing.create(spark, f"{self.root}/order_ids", *self.ids)

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64("order_id"), F.lit(self.buckets)).cast("int")

    def seen(self, df: DataFrame, batch_id: int) -> DataFrame:
        """Ids of ``df`` that other batches stored (order_id), from the buckets that ``df`` touches."""
        spark = df.sparkSession
        touched = [r[0] for r in df.select(self.bucket()).distinct().collect()]  # one row a bucket
        stored = growing.read(spark, f"{self.root}/order_ids", *self.ids)
        return stored.where(F.col(BUCKET).isin(*touched) & (F.col("batch_id") != batch_id)).select("order_id").distinct()

    def ingest(self, df: DataFrame, batch_id: int, restaurants: DataFrame, customers: DataFrame) -> None:
        """Validate a batch and add it; again with the same number replaces it."""
        before = self.seen(df, batch_id).withColumn("_seen", F.lit(True))
        tagged = lookup_join(validate.validate_orders(df, restaurants, customers), before, ["order_id"], null_safe=True)
        reason = F.coalesce("reject_reason", F.when(F.col("_seen"), validate.DUPLICATE_ORDER_ID))
        tagged = io.land(tagged.withColumn("reject_reason", reason).drop("_seen"), f"{self.root}/batches/batch_{batch_id}")
        bad = F.col("reject_reason").isNotNull()
        for name, rows in zip(SINKS, (tagged.where(~bad), tagged.where(bad))):
            growing.append(rows, f"{self.root}/{name}", DAY, batch_id)
        # last, so that a batch which fails half way has not marked its own ids
        ids = tagged.select("order_id", self.bucket().alias(BUCKET)).distinct()
        growing.append(ids, f"{self.root}/order_ids", BUCKET, batch_id)

    def read(self, spark: SparkSession, sink: str) -> DataFrame:
        return growing.read(spark, f"{self.root}/{sink}", *self.orders)

    def compact(self, spark: SparkSession, max_folders: int = 8) -> int:
        """Keys (days and buckets) rewritten because they were spread over more folders."""
        tables = [(name, self.orders) for name in SINKS] + [("order_ids", self.ids)]
        return sum(growing.compact(spark, f"{self.root}/{name}", *of, max_folders=max_folders) for name, of in tables)


def ingest_orders(spark: SparkSession, landing: str, schema: str, restaurants_path: str,
                  customers_path: str, out_root: str, checkpoint: str):
    """Stream raw order files from ``landing`` into valid / rejected tables.

    ``schema`` is the DDL of the landed parquet files (streams need it up front).
    Returns the started query (``availableNow``; call ``awaitTermination``).
    """
    feed = Feed(spark, out_root, schema)
    feed.create(spark)

    def batch(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        feed.ingest(df, batch_id, spark.read.parquet(restaurants_path).select("restaurant_id"),
                    spark.read.parquet(customers_path).select("customer_id"))

    stream = spark.readStream.schema(schema).parquet(landing)
    return (stream.writeStream.foreachBatch(batch)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def daily_counts(spark: SparkSession, out_root: str, schema: str) -> DataFrame:
    """Valid and rejected orders per day across everything ingested so far."""
    feed = Feed(spark, out_root, schema)
    v, r = (feed.read(spark, sink).groupBy(DAY).agg(F.count(F.lit(1)).alias(name)) for sink, name in zip(SINKS, ("valid", "rejected")))
    return v.join(r, DAY, "full").na.fill(0)
