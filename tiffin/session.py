"""Session construction and the shared scratch location.

The cluster names a shared folder in ``spark.checkpoint.dir``; lineage cuts
and intermediate tables go there.  Only where that setting is absent and all
runs in one process (unit tests, a laptop) is a fresh directory under /tmp
taken instead; on a cluster its absence is an error.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Fixed value: what adaptive execution aims at for a shuffle partition, as it is written.  Rows here are a few numbers,
# which compress to a tenth of what a sort or a hash table holds of them: Spark's 64 MB are some six million rows a task.
PARTITION_CONF, PARTITION_BYTES = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "8m"

DEFAULT_CONF = {
    PARTITION_CONF: PARTITION_BYTES,
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, app: str = "tiffin",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def in_partitions(spark: SparkSession) -> SparkSession:
    """``spark``, aiming at shuffle partitions of ``PARTITION_BYTES`` where it has Spark's default; another setting stays."""
    if spark.conf.get(PARTITION_CONF) == "67108864b":
        spark.conf.set(PARTITION_CONF, PARTITION_BYTES)
    return spark


def shared_dir(spark: SparkSession, sub: str | None = None) -> str:
    """The shared folder for lineage cuts (``spark.checkpoint.dir``).

    Reads the session setting; sets a private one only when it is unset.
    With ``sub`` returns a fresh, unique child path under it.
    """
    sc = spark.sparkContext
    base = sc.getCheckpointDir()
    if not base:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if sc.master.split("[")[0] != "local":
                raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
            base = tempfile.mkdtemp(prefix="tiffin-ckpt-")
            spark.conf.set("spark.checkpoint.dir", base)
        sc.setCheckpointDir(base)
        base = sc.getCheckpointDir()
    if sub is None:
        return base
    return base.rstrip("/") + f"/{sub}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df):
    """Reliable checkpoint into the shared folder (never a local checkpoint)."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
