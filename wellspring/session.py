"""Session construction, shared scratch folders and lineage cuts."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the library relies on.  They are applied only when a session is
# built here; a session handed in by a cluster keeps its own values.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Sizing for ~100 TB inputs on a large cluster (profile="cluster").  The
# initial shuffle width of 400 000 is 100 TB / 256 MB: AQE merges small
# partitions of an exchange but does not split large ones.  Scans split at 256 MB; partitions 5x above
# the median and above 512 MB count as skewed and are split by the skew
# join; broadcasts stay below 64 MB.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "400000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(64 << 20),
    "spark.sql.files.maxPartitionBytes": str(256 << 20),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 << 20),
    "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    "spark.sql.parquet.compression.codec": "zstd",
}


def get_session(
    app_name: str = "wellspring",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra_conf: dict | None = None,
    profile: str = "local",
) -> SparkSession:
    """Build (or reuse) a session with AQE, UTC and ANSI mode switched on.

    ``profile="cluster"`` adds ``CLUSTER_CONF`` (partition and broadcast
    sizing for ~100 TB inputs); settings given by the cluster still win
    where a session already exists.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if profile == "cluster":
        conf.update(CLUSTER_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``.  Only a session on a
    ``local[...]`` master, where driver and executors are one process, gets a
    private folder if nothing is configured; any other master raises, since
    executors could not see a folder of the driver's machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            configured = None
    if not configured:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError(f"spark.checkpoint.dir must name a shared folder on master {sc.master!r}")
        configured = tempfile.mkdtemp(prefix="wellspring-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path below the shared checkpoint folder."""
    root = checkpoint_root(spark)
    return os.path.join(root, "wellspring", f"{name}-{uuid.uuid4().hex}")


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete one table below the shared checkpoint folder once nothing reads it any more."""
    if not path.startswith(os.path.join(checkpoint_root(spark), "wellspring", "")):
        raise ValueError(f"not a scratch table: {path!r}")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` over all of ``spark.sql.shuffle.partitions``.

    For aggregations by (at least) ``keys`` that merge few rows.  Without it they first sort or hash a whole
    input split, and AQE then merges what they shuffle to one partition a core or 64 MB packed, ten
    times that in the memory of a task.  A named number of partitions is not merged.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def free_shuffles(spark: SparkSession) -> None:
    """Shuffle files of jobs that have ended are given back now.  Spark deletes them once the driver's JVM
    has collected the plans that wrote them; a driver with little to do collects them late or never."""
    spark._jvm.System.gc()


def cut_lineage(df: DataFrame, free: bool = False) -> DataFrame:
    """Materialise ``df`` as a parquet table in the shared checkpoint folder
    and continue from that table.

    Used where later steps must see exactly the same rows and stamps
    (partition ids, row ids stored as columns) even when a lost executor
    forces recomputation, and where several branches read one intermediate.
    Parquet is columnar and compressed -- much cheaper to write and read than
    an RDD checkpoint of Java-serialised rows -- and it survives executor loss
    like a reliable checkpoint (never ``localCheckpoint``).  With ``free`` the shuffle
    files of what was written are given back at once, for large tables that later steps shuffle again.
    """
    return cut_at(df, scratch_path(df.sparkSession, "cut"), free)


def cut_at(df: DataFrame, path: str, free: bool = False) -> DataFrame:
    """``cut_lineage`` to a ``scratch_path`` that the caller drops."""
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(path)
    if free:
        free_shuffles(spark)
    # The schema is known: no footer-inference job on read-back.
    return spark.read.schema(df.schema).parquet(path)
