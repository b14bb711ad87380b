"""Sources and sinks (S1-S13) on plain Spark readers and writers.

Every path is a folder under a shared location (the caller passes it; the
pipeline derives it from ``spark.checkpoint.dir`` when not given).  Writers
are parallel (no ``coalesce(1)``, no driver collect).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tiffin.sources.csv_files import MALFORMED, RAW, positions, read_csv, scan_csv  # noqa: F401  (S1, S2, S9)

POINTER = "nr long, version string"
OUTCOME, VALID, REJECTED = "outcome", "valid", "rejected"
# Raw column lists of each entity (header order of the raw files).
RAW_COLUMNS = {
    "restaurants": ["url", "address", "name", "online_order", "book_table", "rate", "votes", "phone",
                    "location", "rest_type", "dish_liked", "cuisines", "approx_cost(for two people)",
                    "reviews_list", "menu_item", "listed_in(type)", "listed_in(city)"],
    "customers": ["customer_id", "name", "email", "phone", "signup_date"],
    "orders": ["order_id", "customer_id", "restaurant_id", "order_date", "order_time", "party_size",
               "order_total", "order_status"],
    "order_items": ["order_item_id", "order_id", "item_name", "item_price"],
    "payments": ["payment_id", "order_id", "payment_method", "amount", "payment_status"],
    "deliveries": ["delivery_id", "order_id", "delivery_partner_id", "delivery_partner_name",
                   "delivery_time_minutes", "delivery_status"],
}


def land(df: DataFrame, path: str) -> DataFrame:
    """Write once to parquet and read back (cuts lineage, splittable, columnar)."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def land_csv(spark: SparkSession, path: str, columns: list[str], to: str, missing: str = "error",
             na_tokens: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame, int]:
    """Land the CSV files at ``path``, in one pass and one write.

    Returns the records that fit, the malformed ones with their file and
    record number, and how many these are (observed during the write).
    """
    seen = Observation()
    rows = scan_csv(spark, path, columns, missing=missing, na_tokens=na_tokens)
    bad = F.col(MALFORMED).isNotNull()
    rows.observe(seen, F.count_if(bad).alias("bad")).withColumn("fits", ~bad).write.mode("overwrite").partitionBy("fits").parquet(to)
    rows = spark.read.schema(rows.withColumn("fits", ~bad).schema).parquet(to)
    fit = rows.where("fits").drop("fits", MALFORMED, RAW)
    return fit, positions(rows.where("NOT fits"), rows), int(seen.get["bad"])


def write_csv(df: DataFrame, path: str) -> None:
    """Parallel CSV export; quotes doubled (RFC 4180), header per part."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_split(tagged: DataFrame, path: str, reason_col: str = "reject_reason") -> tuple[DataFrame, DataFrame, int, int]:
    """Valid rows and quarantine as the two partitions of one sink, ``<path>/outcome=valid`` and ``=rejected``.

    Rows are evaluated and written once.  Both partitions are there after
    every write, empty ones too, so that a reader of one never meets rows of
    an earlier run.  Returns both sides, the valid one without the reason, and
    their numbers of rows, observed during the write.
    """
    spark, seen = tagged.sparkSession, Observation()
    bad = F.col(reason_col).isNotNull()
    (tagged.observe(seen, F.count_if(~bad).alias("valid"), F.count_if(bad).alias("rejected"))
     .withColumn(OUTCOME, F.when(bad, REJECTED).otherwise(VALID))
     .write.mode("overwrite").partitionBy(OUTCOME).parquet(path))
    counts = int(seen.get["valid"]), int(seen.get["rejected"])
    for outcome, n in zip((VALID, REJECTED), counts):
        if not n:
            tagged.limit(0).write.mode("overwrite").parquet(f"{path}/{OUTCOME}={outcome}")
    return valid_side(spark, path, tagged.drop(reason_col).schema), rejected_side(spark, path, tagged.schema), *counts


def valid_side(spark: SparkSession, path: str, schema=None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(f"{path}/{OUTCOME}={VALID}")


def rejected_side(spark: SparkSession, path: str, schema=None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(f"{path}/{OUTCOME}={REJECTED}")


def append_partition(df: DataFrame, path: str, *partition_cols: str) -> None:
    """S3: add one day to a growing table — dynamic partition overwrite, so a re-run is idempotent."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_cols).parquet(path))


def write_table(df: DataFrame, path: str) -> None:
    """Full refresh of a staging table (columns selected by name, S9)."""
    df.write.mode("overwrite").parquet(path)


def publish_bucketed(df: DataFrame, table: str, key: str, path: str, buckets: int | None = None) -> int:
    """Write a model bucketed + sorted by its key (co-located joins later).

    ``buckets`` defaults to the session's number of shuffle partitions.
    Returns the number of rows written, observed during the write itself.
    """
    seen = Observation()
    n = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").format("parquet").option("path", path)
     .bucketBy(n, key).sortBy(key).saveAsTable(table))
    return int(seen.get["rows"])


def point_to(spark: SparkSession, path: str, version: str) -> None:
    """Make a complete set of tables the current one: a numbered pointer row, appended after the last table is written."""
    last = _pointers(spark, path)
    append_row(spark, path, {"nr": (last["nr"] if last else 0) + 1, "version": version}, POINTER)


def current(spark: SparkSession, path: str) -> str | None:
    """The version that the last pointer names; None before the first."""
    last = _pointers(spark, path)
    return last["version"] if last else None


def _pointers(spark: SparkSession, path: str):
    """The pointer with the largest number (of two writers' with one number: the larger name)."""
    try:
        last = spark.read.schema(POINTER).parquet(path).select(F.max(F.struct("nr", "version")).alias("p")).first()
    except AnalysisException:
        return None
    return last["p"]


def append_row(spark: SparkSession, path: str, row: dict, schema: str) -> None:
    """Append one run-metadata row (the table is created by the first append)."""
    spark.createDataFrame([row], schema).write.mode("append").parquet(path)


def read_test_artifact(spark: SparkSession, path: str) -> DataFrame:
    """A JSON test artefact ``{"results": [{"status": ...}, ...]}``."""
    return spark.read.option("multiLine", True).json(path)


def seed_if_absent(df: DataFrame, path: str) -> None:
    """Write only when nothing is there yet."""
    df.write.mode("ignore").parquet(path)
