"""Readers and writers for stage outputs and the four warehouse tables.

Writes go to folders under the shared checkpoint directory (or a caller's
path) as Parquet / CSV / JSON with ``overwrite`` or ``append``; tables are
plain Parquet folders registered with ``CREATE TABLE ... USING parquet``.
Warehouse tables are partitioned by run (``pipeline_run_id``), so the newest
batch is a partition and an append's row count is that partition's footers.
Row counts are read back from the written files (Parquet footers, no data
scan); the input is never computed twice. (``Observation`` is not
used: once a session has used one, Spark ML models that keep a training
summary can no longer be serialized into tasks in that session.)
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S

CSV_OPTIONS = {"header": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


# -- sources -------------------------------------------------------------------

def read_raw(spark: SparkSession, path: str, schema: T.StructType = S.RAW_SCHEMA) -> DataFrame:
    """Headered CSV with an explicit schema (no inference pass)."""
    return spark.read.schema(schema).options(**CSV_OPTIONS).csv(path)


def read_features(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Feature parquet; selecting columns prunes the scan."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(jpath)


def read_or_else(spark: SparkSession, primary: str, secondary: str, fmt: str = "parquet",
                 schema: T.StructType | None = None) -> DataFrame:
    """Read the primary table when it exists, else the fallback file.

    The existence check is a metadata call at plan time, not a job.
    """
    for path in (primary, secondary):
        if path and path_exists(spark, path):
            reader = spark.read.schema(schema) if schema is not None else spark.read
            if fmt == "csv":
                return reader.options(**CSV_OPTIONS).csv(path)
            return reader.format(fmt).load(path)
    raise FileNotFoundError(f"neither {primary} nor {secondary} exists")


# -- sinks ---------------------------------------------------------------------

def write_stage(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] = (), sort_within: Sequence[str] = (),
                count: bool = True) -> int | None:
    """Write one stage output; returns rows written when ``count``
    (overwrites only: an append's rows cannot be told from earlier ones)."""
    if mode == "append" and count:
        raise ValueError("appends are counted by append_with_lineage, by run")
    out = df.sortWithinPartitions(*sort_within) if sort_within else df
    w = out.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.options(**CSV_OPTIONS).csv(path)
    elif fmt == "json":
        w.json(path)
    else:
        w.format(fmt).save(path)
    if not count:
        return None
    spark = df.sparkSession
    if fmt == "csv":
        return spark.read.options(**CSV_OPTIONS).csv(path).count()
    if fmt == "json":
        return spark.read.text(path).count()
    return spark.read.format(fmt).load(path).count()


def stamp(df: DataFrame, run_id: str, code_version: str | None = None,
          ingested_at: Column | None = None) -> DataFrame:
    """Add ``ingested_at``, ``pipeline_run_id`` and, for processed
    tables, ``dvc_commit_hash`` when absent."""
    out = df
    if "ingested_at" not in df.columns:
        out = out.withColumn("ingested_at", ingested_at if ingested_at is not None else F.current_timestamp())
    if "pipeline_run_id" not in df.columns:
        out = out.withColumn("pipeline_run_id", F.lit(run_id))
    if code_version is not None and "dvc_commit_hash" not in df.columns:
        out = out.withColumn("dvc_commit_hash", F.lit(code_version))
    return out


def append_with_lineage(df: DataFrame, table_path: str, table: str, run_id: str,
                        code_version: str = "", ingested_at: Column | None = None) -> int:
    """Append to a warehouse table with lineage columns; returns rows inserted.

    The table is partitioned by ``pipeline_run_id``; the rows of the run are
    counted from its files before and after, so ``df`` runs once.
    """
    spark = df.sparkSession
    schema = S.TABLE_SCHEMAS.get(table)
    out = stamp(df, run_id, code_version if "processed" in table else None, ingested_at)
    if schema is not None:
        out = out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) if f.name in out.columns
                           else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
    before = _rows_of_run(spark, table_path, run_id)
    write_stage(out, table_path, "parquet", "append", partition_by=[RUN_COLUMN], count=False)
    return _rows_of_run(spark, table_path, run_id) - before


RUN_COLUMN = "pipeline_run_id"


def _rows_of_run(spark: SparkSession, table_path: str, run_id: str) -> int:
    """Rows of one run: the scan is pruned to its partition and reads footers
    only (an empty run id is stored as null)."""
    if not path_exists(spark, table_path):
        return 0
    run = F.col(RUN_COLUMN) == run_id if run_id else F.col(RUN_COLUMN).isNull()
    return spark.read.schema(f"{RUN_COLUMN} string").parquet(table_path).filter(run).count()


def read_table(spark: SparkSession, table_path: str, table: str) -> DataFrame:
    """A warehouse table by path with its declared types (run ids stay strings)."""
    return spark.read.schema(S.TABLE_SCHEMAS[table]).parquet(table_path)


def log_predictions(scored: DataFrame, table_path: str, run_id: str = "") -> int:
    """Append scored rows to the predictions log."""
    return append_with_lineage(scored.select(*prediction_log_columns(scored)), table_path, "churn_predictions", run_id)


def prediction_log_columns(scored: DataFrame) -> list[Column]:
    """The log's columns; the request time is now where there is none."""
    now = F.current_timestamp()
    time = F.coalesce(F.col("request_timestamp").cast("timestamp"), now) if "request_timestamp" in scored.columns else now
    given = ["prediction_id", "customerID", "churn_probability", "churn_prediction", "model_name", "model_version"]
    return [*map(F.col, given), time.alias("request_timestamp"), F.col("latency_ms")]


def metrics_long(wide: DataFrame, run_id: str, model_name: str, metric_cols: Sequence[str],
                 event_flags: Sequence[str] = (), recorded_at: Column | None = None) -> DataFrame:
    """Named metrics as long ``(run_id, model_name, metric_name,
    metric_value)`` rows; each boolean ``event_flags`` column adds a row
    with value 1.0 only when it is true."""
    casted = wide.select(*[F.col(c).cast("double").alias(c) for c in metric_cols],
                         *[F.when(F.col(c), F.lit(1.0)).alias(c) for c in event_flags])
    out = (casted.unpivot([], list(metric_cols) + list(event_flags), "metric_name", "metric_value")
                 .filter(F.col("metric_value").isNotNull())
                 .select(F.lit(run_id).alias("run_id"), F.lit(model_name).alias("model_name"),
                         "metric_name", "metric_value"))
    if recorded_at is not None:
        out = out.withColumn("recorded_at", recorded_at)
    return out


def ensure_tables(spark: SparkSession, base: str, tables: Sequence[str] | None = None,
                  database: str | None = None) -> dict[str, str]:
    """Create the warehouse tables if missing (Parquet folders under
    ``base``, registered in the session catalog, optionally in ``database``;
    partitioned by run where they have a run id: after an append by path,
    ``spark.catalog.recoverPartitions`` shows the new run). Returns name -> path."""
    prefix = ""
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{base.rstrip('/')}'")
        prefix = f"{database}."
    paths = {}
    for name in tables or S.TABLE_SCHEMAS:
        path = f"{base.rstrip('/')}/{name}"
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in S.TABLE_SCHEMAS[name].fields)
        by = f"PARTITIONED BY ({RUN_COLUMN}) " if RUN_COLUMN in S.TABLE_SCHEMAS[name].fieldNames() else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {prefix}{name} ({ddl}) USING parquet {by}LOCATION '{path}'")
        paths[name] = path
    return paths
