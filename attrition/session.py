"""Spark session and shared-folder helpers.

Everything here is configuration a Spark user would write by hand: sane
shuffle sizing, AQE on, UTC session time, Arrow on for the few pandas paths,
and a lineage-cutting folder taken from ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: The JVM compiles no method of more bytes; Spark's default lets whole stages run interpreted beyond them.
CODE_LIMIT, CODE_BYTES = "spark.sql.codegen.hugeMethodLimit", "8000"


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "attrition") -> SparkSession:
    """Create (or reuse) a session tuned for this library.

    On a cluster the master and most settings come from ``spark-submit``;
    the values below are only applied when nothing else set them.
    """
    from pyspark import SparkConf
    given = SparkConf()   # what spark-submit / spark-defaults already set
    builder = SparkSession.builder.appName(app_name)
    if master and not given.contains("spark.master"):
        builder = builder.master(master)
    parts = shuffle_partitions or os.environ.get("ATTRITION_SHUFFLE_PARTITIONS")
    if not parts and (master or given.get("spark.master", "")).startswith("local"):
        parts = os.cpu_count() or 8   # one machine; a cluster keeps its own setting
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        CODE_LIMIT: CODE_BYTES,
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # checkpoint files of unreachable data are removed from the shared folder
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("ATTRITION_DRIVER_MEMORY", "16g"),
    }
    if parts:
        defaults["spark.sql.shuffle.partitions"] = str(parts)
    for k, v in defaults.items():
        if not given.contains(k):
            builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def is_local(master: str) -> bool:
    """Whether driver and executors are one process (``local``, ``local[4]``; not ``local-cluster``)."""
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the session.

    The cluster names a shared folder in ``spark.checkpoint.dir``; we read it
    and never override it. Only on a local master (one machine, as in tests)
    an unset one is replaced by a fresh folder of our own: on a cluster no
    executor could read a folder of the driver, so that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not is_local(sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="attrition-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def keep_compiled(spark: SparkSession) -> None:
    """Have wide projections evaluated by small generated methods, unless the session has its own limit.

    One method of a whole stage over some thirty encoded columns is beyond what the JVM compiles."""
    if spark.conf.get(CODE_LIMIT) == "65535":
        spark.conf.set(CODE_LIMIT, CODE_BYTES)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint directory.

    Used for stage outputs written by sinks (tables, CSV, JSON). Each call
    gets a new sub-folder, so repeated runs never append to old data.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder of this library that is no longer read."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner remove shuffle and checkpoint files of frames that nothing refers to any more.

    The cleaner learns of them when the driver collects its garbage, which a driver
    with little work seldom does; loops of many small jobs ask for it."""
    gc.collect()
    spark._jvm.System.gc()


#: Bytes of scanned files (or at least one checkpointed partition) per range part.
PART_BYTES = 64 << 20


def parts_for(df: DataFrame) -> int:
    """Number of parts to range-partition ``df`` into: one per ``PART_BYTES``
    of the files it scans or per partition of a checkpoint it reads, and at
    least the session's shuffle partitions. Plan metadata only, no job."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    scanned = 0
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        kind = leaf.getClass().getSimpleName()
        if kind == "LogicalRelation":
            scanned += int(str(leaf.stats().sizeInBytes()))
        elif kind == "LogicalRDD":
            n = max(n, leaf.rdd().getNumPartitions())
    return max(n, -(-scanned // PART_BYTES))


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)
