"""Queries for summaries, counters, histograms and top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import aggregate as A
from ..sources.views import read_table
from . import inputs as I
from .catalog import query
from .oracle_sql import with_views


@query("dataset_summary", "A1", with_views(
    "SELECT count(*) AS n_rows, CAST(21 AS BIGINT) AS n_columns, "
    "round(avg(CASE WHEN Churn = 'Yes' THEN 1.0 ELSE 0.0 END), 6) AS churn_rate, "
    "min(tenure) AS tenure_min, max(tenure) AS tenure_max, round(avg(MonthlyCharges), 6) AS monthly_mean "
    "FROM customer_clean", "customer_clean"))
def q_dataset_summary(spark, sf):
    return A.dataset_summary(I.cleaned(spark, sf))


@query("value_counts", "A2", with_views(
    "SELECT Contract, count(*) AS n, round(count(*) / (SELECT count(*) FROM customer_clean), 6) AS share "
    "FROM customer_clean GROUP BY Contract", "customer_clean"))
def q_value_counts(spark, sf):
    return A.value_counts(I.cleaned(spark, sf), "Contract", normalize=True)


@query("preprocess_summary", "A3", with_views(
    "SELECT count(*) AS n_rows, CAST(28 AS BIGINT) AS n_features, round(avg(CAST(Churn AS DOUBLE)), 6) AS churn_rate, "
    "round(avg(CAST(num_services AS DOUBLE)), 6) AS avg_services FROM customer_features", "customer_features"))
def q_preprocess_summary(spark, sf):
    return A.preprocess_summary(I.features(spark, sf))


_STAT_TABLES = ["customer", "orders", "lineitem", "events"]


@query("table_stats", "A4", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in _STAT_TABLES))
def q_table_stats(spark, sf):
    return A.table_stats({t: read_table(spark, sf, t) for t in _STAT_TABLES})


@query("batch_summary", "A5", with_views(
    "SELECT pipeline_run_id, count(*) AS total_customers, CAST(sum(churn_prediction) AS BIGINT) AS churn_count, "
    "round_even(sum(churn_prediction) / count(*) * 10000, 0) / 10000 AS churn_rate "
    "FROM predictions GROUP BY pipeline_run_id", "predictions"))
def q_batch_summary(spark, sf):
    return A.batch_summary(I.predictions(spark, sf), by=["pipeline_run_id"])


@query("history_summary", "A6", with_views(
    "SELECT count(*) AS total, CAST(sum(churn_prediction) AS BIGINT) AS predicted_churn, "
    "round(avg(churn_probability) * 100, 1) AS avg_probability_pct, round(avg(latency_ms), 1) AS avg_latency_ms "
    "FROM (SELECT * FROM predictions ORDER BY request_timestamp DESC, prediction_id DESC LIMIT 100)",
    "predictions"))
def q_history_summary(spark, sf):
    return A.history_summary(I.predictions(spark, sf), n=100)


@query("counter_by_label", "A7", with_views(
    "SELECT model_name, CASE WHEN churn_prediction = 1 THEN 'churn' ELSE 'no_churn' END AS prediction_result, "
    "count(*) AS count FROM predictions GROUP BY 1, 2", "predictions"))
def q_counter(spark, sf):
    df = I.predictions(spark, sf)
    result = F.when(F.col("churn_prediction") == 1, "churn").otherwise("no_churn").alias("prediction_result")
    return A.counter(df, ["model_name", result])


def _hist_sql(name: str, expr: str, edges, by: str | None = None) -> str:
    g = f"{by}, " if by else ""
    gb = f" GROUP BY {by}" if by else ""
    parts = [f"SELECT {g}'{float(e)!r}' AS le, CAST({float(e)!r} AS DOUBLE) AS le_value, "
             f"CAST(sum(CASE WHEN {expr} <= {float(e)!r} THEN 1 ELSE 0 END) AS BIGINT) AS bucket_count, "
             f"round(sum({expr}), 6) AS sum, count({expr}) AS count, '{name}' AS histogram FROM predictions{gb}"
             for e in edges]
    parts.append(f"SELECT {g}'+Inf' AS le, CAST(NULL AS DOUBLE) AS le_value, count({expr}) AS bucket_count, "
                 f"round(sum({expr}), 6) AS sum, count({expr}) AS count, '{name}' AS histogram FROM predictions{gb}")
    return "\nUNION ALL\n".join(parts)


def _histograms(spark, sf):
    df = I.predictions(spark, sf).withColumn("latency_s", F.col("latency_ms") / 1000)
    lat = A.histogram_le(df, "latency_s", S.LATENCY_EDGES, name="latency_seconds")
    prob = A.histogram_le(df, "churn_probability", S.PROBABILITY_EDGES, name="churn_probability")
    return lat.unionByName(prob).withColumn("sum", F.round("sum", 6))


@query("histogram_le", "A8", with_views(
    _hist_sql("latency_seconds", "latency_ms / 1000", S.LATENCY_EDGES) + "\nUNION ALL\n"
    + _hist_sql("churn_probability", "churn_probability", S.PROBABILITY_EDGES), "predictions"))
def q_histogram(spark, sf):
    return _histograms(spark, sf)


_QUANTILE_SQL = with_views(f"""
, h AS ({_hist_sql("latency_seconds", "latency_ms / 1000", S.LATENCY_EDGES, by="model_name")}),
o AS (SELECT model_name, le_value, bucket_count,
        lag(le_value) OVER (PARTITION BY model_name ORDER BY le_value NULLS LAST) AS prev_le,
        coalesce(lag(bucket_count) OVER (PARTITION BY model_name ORDER BY le_value NULLS LAST), 0) AS prev_count,
        0.95 * max(bucket_count) OVER (PARTITION BY model_name) AS rnk,
        max(bucket_count) OVER (PARTITION BY model_name) AS total FROM h),
f AS (SELECT * FROM o WHERE bucket_count >= rnk AND total > 0
      QUALIFY row_number() OVER (PARTITION BY model_name ORDER BY le_value NULLS LAST) = 1)
SELECT g.model_name, round(CASE WHEN f.le_value IS NULL THEN f.prev_le
       ELSE coalesce(f.prev_le, 0) + (f.le_value - coalesce(f.prev_le, 0)) * ((f.rnk - f.prev_count) / (f.bucket_count - f.prev_count)) END, 6)
       AS quantile
FROM (SELECT DISTINCT model_name FROM predictions) g LEFT JOIN f ON g.model_name = f.model_name
""", "predictions")


@query("histogram_quantile", "A9", _QUANTILE_SQL)
def q_quantile(spark, sf):
    df = I.predictions(spark, sf).withColumn("latency_s", F.col("latency_ms") / 1000)
    hist = A.histogram_le(df, "latency_s", S.LATENCY_EDGES, by=["model_name"])
    return A.histogram_quantile(hist, 0.95, by=["model_name"]).withColumn("quantile", F.round("quantile", 6))


@query("metric_gauge_latest", "A10", with_views(
    "SELECT metric_name, recorded_at, metric_value, run_id, model_name, "
    "CASE WHEN metric_value >= 0.2 THEN 'critical' WHEN metric_value >= 0.1 THEN 'warning' ELSE 'ok' END AS band "
    "FROM model_metrics QUALIFY row_number() OVER (PARTITION BY metric_name "
    "ORDER BY recorded_at DESC, run_id DESC, model_name DESC) = 1", "model_metrics"))
def q_gauge(spark, sf):
    latest = A.latest_value(I.metrics(spark, sf), ["metric_name"], "recorded_at",
                            ["metric_value", "run_id", "model_name"], tie=["run_id", "model_name"])
    return A.gauge_bands(latest)


@query("recent_predictions", "T1", with_views(
    "SELECT * FROM predictions ORDER BY request_timestamp DESC, prediction_id DESC LIMIT 50", "predictions"))
def q_recent(spark, sf):
    return A.top_n(I.predictions(spark, sf), "request_timestamp", 50, True, ["prediction_id"])


@query("recent_features", "T2", with_views(
    "SELECT * FROM feature_snapshots ORDER BY event_timestamp DESC, snapshot_id DESC LIMIT 10000",
    "feature_snapshots"))
def q_recent_features(spark, sf):
    return A.top_n(I.snapshots(spark, sf), "event_timestamp", 10000, True, ["snapshot_id"])


@query("oldest_reference", "T3", with_views(
    "SELECT * FROM feature_snapshots ORDER BY event_timestamp ASC, snapshot_id ASC LIMIT 1000",
    "feature_snapshots"))
def q_oldest(spark, sf):
    return A.top_n(I.snapshots(spark, sf), "event_timestamp", 1000, False, ["snapshot_id"])


@query("rank_models", "T5", with_views(
    "SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY metric_value DESC, recorded_at ASC, model_name ASC) "
    "AS rank, row_number() OVER (PARTITION BY run_id ORDER BY metric_value DESC, recorded_at ASC, model_name ASC) = 1 "
    "AS is_best "
    "FROM model_metrics WHERE metric_name = 'val_roc_auc'", "model_metrics"))
def q_rank(spark, sf):
    return A.rank_models(I.metrics(spark, sf), "val_roc_auc", by=["run_id"])


@query("latest_drift", "T6", with_views(
    "SELECT recorded_at, run_id, model_name, metric_value AS drift_score FROM model_metrics "
    "WHERE metric_name = 'drift_score' ORDER BY recorded_at DESC, run_id DESC, model_name DESC LIMIT 1",
    "model_metrics"))
def q_latest_drift(spark, sf):
    df = I.metrics(spark, sf).filter(F.col("metric_name") == "drift_score") \
        .withColumnRenamed("metric_value", "drift_score")
    return A.latest_value(df, [], "recorded_at", ["run_id", "model_name", "drift_score"],
                          tie=["run_id", "model_name"])
