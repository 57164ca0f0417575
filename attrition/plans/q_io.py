"""Queries for sources, sinks, tables and lineage.

Each sink query writes the whole input to a fresh folder under the shared
checkpoint directory and returns the data read back, so the oracle checks
the round trip.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import aggregate as A
from ..operators import clean as P
from ..operators import lineage as L
from ..session import scratch_path
from ..sources import sinks as K
from . import inputs as I
from .catalog import query
from .oracle_sql import with_views

FIXED_TS = "2024-01-01 00:00:00"
RUN_ID = "run-0001"
CODE_VERSION = "0123abcd"


def _ts():
    return F.lit(FIXED_TS).cast("timestamp")


@query("scan_csv", "S1", with_views("SELECT * FROM customer_raw", "customer_raw"))
def q_scan_csv(spark, sf):
    path = scratch_path(spark, "raw-csv")
    K.write_stage(I.raw(spark, sf), path, "csv")
    return K.read_raw(spark, path)


@query("scan_parquet", "S2", with_views(
    "SELECT customerID, tenure, Churn FROM customer_features WHERE tenure > 12", "customer_features"))
def q_scan_parquet(spark, sf):
    path = scratch_path(spark, "features-parquet")
    K.write_stage(I.features(spark, sf), path, "parquet")
    return K.read_features(spark, path, ["customerID", "tenure", "Churn"]).filter(F.col("tenure") > 12)


@query("sink_csv", "S3", with_views("SELECT * FROM customer_features", "customer_features"))
def q_sink_csv(spark, sf):
    path = scratch_path(spark, "features-csv")
    K.write_stage(I.features(spark, sf), path, "csv")
    return K.read_raw(spark, path, S.FEATURE_SCHEMA)


@query("sink_parquet", "S4", with_views(
    f"SELECT *, TIMESTAMP '{FIXED_TS}' AS event_timestamp, TIMESTAMP '{FIXED_TS}' AS created_timestamp "
    "FROM customer_features", "customer_features"))
def q_sink_parquet(spark, sf):
    path = scratch_path(spark, "feature-store")
    df = I.features(spark, sf).withColumn("event_timestamp", _ts()).withColumn("created_timestamp", _ts())
    K.write_stage(df, path, "parquet", partition_by=["tenure_group"], sort_within=["customerID"])
    return K.read_features(spark, path)


_SUMMARY_JSON = ("n_rows long, n_columns long, churn_rate double, tenure_min int, tenure_max int, "
                 "monthly_mean double")


@query("sink_json", "S5", with_views(
    "SELECT count(*) AS n_rows, CAST(21 AS BIGINT) AS n_columns, "
    "round(avg(CASE WHEN Churn = 'Yes' THEN 1.0 ELSE 0.0 END), 6) AS churn_rate, "
    "min(tenure) AS tenure_min, max(tenure) AS tenure_max, round(avg(MonthlyCharges), 6) AS monthly_mean "
    "FROM customer_clean", "customer_clean"))
def q_sink_json(spark, sf):
    path = scratch_path(spark, "summary-json")
    K.write_stage(A.dataset_summary(I.cleaned(spark, sf)), path, "json")
    return spark.read.schema(_SUMMARY_JSON).json(path)


@query("append_with_lineage", "S6", with_views(
    f"SELECT * REPLACE (CAST(SeniorCitizen AS TINYINT) AS SeniorCitizen), TIMESTAMP '{FIXED_TS}' AS ingested_at, "
    f"'{RUN_ID}' AS pipeline_run_id FROM customer_clean", "customer_clean"))
def q_append(spark, sf):
    path = scratch_path(spark, "churn_validated")
    n = K.append_with_lineage(I.cleaned(spark, sf), path, "churn_validated", RUN_ID, ingested_at=_ts())
    out = K.read_table(spark, path, "churn_validated")
    assert n == out.count()
    return out


@query("sink_predictions", "S7", with_views(
    "SELECT prediction_id, customerID, churn_probability, churn_prediction, model_name, model_version, "
    f"request_timestamp, latency_ms, '{RUN_ID}' AS pipeline_run_id FROM predictions", "predictions"))
def q_sink_predictions(spark, sf):
    path = scratch_path(spark, "churn_predictions")
    K.log_predictions(I.predictions(spark, sf), path, RUN_ID)
    return K.read_table(spark, path, "churn_predictions")


@query("table_ddl", "S9", with_views(
    "SELECT 'churn_validated' AS table_name, count(*) AS row_count FROM customer_clean UNION ALL "
    "SELECT 'churn_processed', count(*) FROM customer_features UNION ALL "
    "SELECT 'churn_predictions', 0 UNION ALL SELECT 'model_metrics', 0", "customer_features"))
def q_table_ddl(spark, sf):
    db = f"attrition_{uuid.uuid4().hex[:10]}"
    base = scratch_path(spark, "warehouse")
    paths = K.ensure_tables(spark, base, database=db)
    K.append_with_lineage(I.cleaned(spark, sf), paths["churn_validated"], "churn_validated", RUN_ID)
    K.append_with_lineage(I.features(spark, sf), paths["churn_processed"], "churn_processed", RUN_ID, CODE_VERSION)
    spark.catalog.recoverPartitions(f"{db}.churn_validated")
    spark.catalog.recoverPartitions(f"{db}.churn_processed")
    return A.table_stats({t: spark.table(f"{db}.{t}") for t in S.TABLE_SCHEMAS})


@query("scan_with_fallback", "S10", with_views("SELECT * FROM customer_features", "customer_features"))
def q_fallback(spark, sf):
    path = scratch_path(spark, "processed-fallback")
    K.write_stage(I.features(spark, sf), path, "parquet")
    return K.read_or_else(spark, scratch_path(spark, "missing-table"), path)


_LINEAGE_STAGES = [("ingest", S.RAW_COLUMNS, "customer_clean"), ("validate", S.RAW_COLUMNS, "customer_clean"),
                   ("preprocess", S.FEATURE_TABLE_COLUMNS, "customer_features")]


@query("lineage_events", "L1", with_views(" UNION ALL ".join(
    f"SELECT '{RUN_ID}' AS run_id, '{job}' AS job, '{state}' AS state, 1 AS n_inputs, 1 AS n_outputs, "
    f"'{','.join(cols)}' AS fields, true AS has_time, {n} AS row_count"
    for job, cols, view in _LINEAGE_STAGES
    for state, n in (("START", "CAST(NULL AS BIGINT)"), ("COMPLETE", f"(SELECT count(*) FROM {view})"))), "customer_features"))
def q_lineage(spark, sf):
    """Events of three written stages: each reads what the one before wrote."""
    events, src = None, f"{sf.rstrip('/')}/customer.parquet"
    steps = {"ingest": lambda _: I.cleaned(spark, sf), "validate": lambda df: P.cast_narrow(df, ["SeniorCitizen"]),
             "preprocess": P.build_features}
    df = None
    for job, step in steps.items():
        df, out = step(df), scratch_path(spark, f"lineage-{job}")
        start = L.lineage_event(spark, df, job, RUN_ID, "START", [src], [out])
        rows = K.write_stage(df, out, "parquet")
        done = L.lineage_event(spark, df, job, RUN_ID, "COMPLETE", [src], [out], row_count=rows)
        events = start.unionByName(done) if events is None else events.unionByName(start).unionByName(done)
        df, src = spark.read.parquet(out), out
    return events.select(
        "run_id", "job", "state", F.size("inputs").alias("n_inputs"), F.size("outputs").alias("n_outputs"),
        F.array_join(F.transform("schema_fields", lambda f: f["name"]), ",").alias("fields"),
        F.col("event_time").isNotNull().alias("has_time"), "row_count")


_FP_COLS = S.FEATURE_TABLE_COLUMNS
_FP_TEXT = " || ".join(f"coalesce('V' || length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), 'N')" for c in _FP_COLS)
_FP_HALF = "CAST(sum(CAST('0x' || substr(md5({t}), {i}, 16) AS UBIGINT)) AS VARCHAR)"


@query("dataset_fingerprint", "L2", with_views(
    "SELECT count(*) AS row_count, CAST(sum(CAST('0x' || substr(md5("
    + " || ".join(f"coalesce('V' || length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), 'N')" for c in _FP_COLS)
    + "), 1, 8) AS BIGINT)) AS VARCHAR) AS md5_sum FROM customer_features", "customer_features"))
def q_fingerprint(spark, sf):
    return L.fingerprint(I.features(spark, sf), _FP_COLS)


@query("fingerprint_by_partition", "L2", with_views(
    f"SELECT Contract_OneYear, count(*) AS row_count, {_FP_HALF.format(t=_FP_TEXT, i=1)} AS high_sum, "
    f"{_FP_HALF.format(t=_FP_TEXT, i=17)} AS low_sum FROM customer_features GROUP BY Contract_OneYear", "customer_features"))
def q_fingerprint_states(spark, sf):
    """Two appends, each adding its own states; merged, they are those of the whole table."""
    path, features = scratch_path(spark, "fingerprint-states"), I.features(spark, sf)
    churned = F.coalesce(F.col("Churn") == 1, F.lit(False))
    for part in (churned, ~churned):
        L.fingerprint_states(features.filter(part), "Contract_OneYear", _FP_COLS).write.mode("append").parquet(path)
    merged = L.merge_states(spark.read.parquet(path), "Contract_OneYear")
    return merged.withColumns({c: F.col(c).cast("string") for c in ("high_sum", "low_sum")})


@query("run_stamp", "L3", with_views(
    f"SELECT *, TIMESTAMP '{FIXED_TS}' AS ingested_at, '{RUN_ID}' AS pipeline_run_id, "
    f"'{CODE_VERSION}' AS dvc_commit_hash FROM customer_features", "customer_features"))
def q_stamp(spark, sf):
    return K.stamp(I.features(spark, sf), RUN_ID, CODE_VERSION, _ts())
