"""Tables that grow by batches, with compaction under a manifest (S3).

Layout under the table's folder::

    data/<key>=.../batch_id=...         what each batch added; a replay rewrites its own folders
    merged/version=.../<key>=.../       batches of a key rewritten as one folder
    manifest/<version>                  (key, batch_id, version): which batches of a key that version holds
    current                             pointer to the manifest that readers follow

A compaction writes its merged folders and a manifest first and moves the
pointer last; whatever happens before, readers see the table as it was.
Folders that the manifest has replaced stay until ``vacuum``, for readers that
still have them open.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.sources import io

COVERED = "key string, batch_id long, version long"


def create(spark: SparkSession, path: str, schema: str, key: str) -> None:
    """An empty table, unless there is one; ``schema`` is the DDL of the rows, the key included."""
    empty = spark.createDataFrame([], schema).withColumn("batch_id", F.lit(0).cast("long"))
    empty.write.mode("ignore").partitionBy(key, "batch_id").parquet(f"{path}/data")


def append(df: DataFrame, path: str, key: str, batch_id: int) -> None:
    """Add the rows of a batch; adding it again replaces it."""
    # dealt by key, so that a key is few files; adaptive execution splits a large one
    rows = df.withColumn("batch_id", F.lit(batch_id).cast("long")).hint("rebalance", key)
    io.append_partition(rows, f"{path}/data", key, "batch_id")


def read(spark: SparkSession, path: str, schema: str, key: str) -> DataFrame:
    """All rows with their ``batch_id``: merged folders, and the batches that no merge holds yet."""
    return _placed(spark, path, schema, key).drop("_folder")


def _files(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table's rows with the folder that holds them."""
    folder = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "")
    return spark.read.schema(schema).parquet(path).select("*", folder.alias("_folder"))


def _placed(spark: SparkSession, path: str, schema: str, key: str) -> DataFrame:
    covered = _covered(spark, path)
    data = _files(spark, f"{path}/data", f"{schema}, batch_id long")
    if covered is None:
        return data
    pair = (F.col(key).cast("string").eqNullSafe(F.col("_k"))) & (F.col("batch_id") == F.col("_b"))
    data = data.join(covered.select(F.col("key").alias("_k"), F.col("batch_id").alias("_b")), pair, "left_anti")
    merged = _files(spark, f"{path}/merged", f"{schema}, batch_id long, version long")
    live = covered.select(F.col("key").alias("_k"), F.col("version").alias("_v")).distinct()
    merged = merged.join(live, F.col(key).cast("string").eqNullSafe(F.col("_k")) & (F.col("version") == F.col("_v")), "left_semi")
    return data.unionByName(merged.drop("version"))


def folders(spark: SparkSession, path: str, schema: str, key: str) -> DataFrame:
    """(key, folders): how many folders a reader of a key opens."""
    return _placed(spark, path, schema, key).groupBy(key).agg(F.count_distinct("_folder").alias("folders"))


def compact(spark: SparkSession, path: str, schema: str, key: str, max_folders: int = 8) -> int:
    """Rewrite every key that is spread over more than ``max_folders`` folders as one; returns how many were.

    Only the rows of these keys are read and written.
    """
    covered, before = _covered(spark, path), io.current(spark, f"{path}/current")
    spread = folders(spark, path, schema, key).where(F.col("folders") > max_folders).select(F.col(key).alias("_k"))
    spread = io.land(spread, f"{path}/compacting")
    n = spread.count()
    if not n:
        return 0
    version = int(before or 0) + 1
    rows = read(spark, path, schema, key).join(spread, F.col(key).eqNullSafe(F.col("_k")), "left_semi")
    rows = rows.withColumn("version", F.lit(version).cast("long"))
    rows.hint("rebalance", key).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "version", key).parquet(f"{path}/merged")
    done = spark.read.schema(f"{schema}, batch_id long, version long").parquet(f"{path}/merged").where(F.col("version") == version)
    held = done.select(F.col(key).cast("string").alias("key"), "batch_id", "version").distinct()
    if covered is not None:  # keys that were not rewritten stay where they are
        held = held.unionByName(covered.join(held.select(F.col("key").alias("_k")).distinct(), F.col("key").eqNullSafe(F.col("_k")), "left_anti"))
    held.write.mode("overwrite").parquet(f"{path}/manifest/{version}")
    io.point_to(spark, f"{path}/current", str(version))
    return n


def vacuum(spark: SparkSession, path: str, schema: str, key: str) -> int:
    """Delete folders that the current manifest has replaced; returns how many.  Readers of older manifests must be done."""
    covered = _covered(spark, path)
    if covered is None:
        return 0
    gone = []
    for part, number, how in (("data", "batch_id", "left_semi"), ("merged", "version", "left_anti")):
        held = _files(spark, f"{path}/{part}", f"{schema}, {number} long").select(
            F.col(key).cast("string").alias("k"), F.col(number).alias("nr"), "_folder").distinct()
        held = held.join(covered, F.col("k").eqNullSafe(F.col("key")) & (F.col("nr") == F.col(number)), how)
        gone += [r["_folder"] for r in held.select("_folder").distinct().collect()]  # a row per folder
    hadoop, jvm = spark._jsc.hadoopConfiguration(), spark._jvm
    for f in gone:
        at = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI.create(f))
        at.getFileSystem(hadoop).delete(at, True)
    return len(gone)


def _covered(spark: SparkSession, path: str) -> DataFrame | None:
    version = io.current(spark, f"{path}/current")
    return None if version is None else spark.read.schema(COVERED).parquet(f"{path}/manifest/{version}")
