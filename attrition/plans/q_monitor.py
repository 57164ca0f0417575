"""Queries for windowed monitoring and alerts."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import monitor as W
from . import inputs as I
from .catalog import query
from .oracle_sql import with_views

_WIN = """w AS (SELECT p.*, time_bucket(INTERVAL 1 MINUTE, request_timestamp) - to_minutes(r.k) AS window_start
       FROM predictions p, range(0, 5) r(k))"""


def _preds(spark, sf):
    return I.predictions(spark, sf).withColumn("latency_s", F.col("latency_ms") / 1000)


@query("rate_5m", "W1", with_views(f"""
, {_WIN}
SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, count(*) AS events,
       round(count(*) / 300.0, 6) AS rate FROM w GROUP BY window_start""", "predictions"))
def q_rate(spark, sf):
    return W.windowed_rate(I.predictions(spark, sf), "request_timestamp")


@query("rate_by_result_5m", "W2", with_views(f"""
, {_WIN}
SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, count(*) AS events,
       CAST(sum(churn_prediction) AS BIGINT) AS flagged, round(count(*) / 300.0, 6) AS rate,
       round(sum(churn_prediction) / 300.0, 6) AS flagged_rate, round(sum(churn_prediction) / count(*), 6) AS flagged_share,
       round(sum(churn_prediction) / 300.0, 6) > 0.5 AS rate_alert, round(sum(churn_prediction) / count(*), 6) > 0.5 AS share_alert
FROM w GROUP BY window_start""", "predictions"))
def q_rate_result(spark, sf):
    out = W.windowed_rate(I.predictions(spark, sf), "request_timestamp", flag="churn_prediction")
    return (out.withColumn("rate_alert", F.col("flagged_rate") > 0.5)
               .withColumn("share_alert", F.col("flagged_share") > 0.5))


def _quantile_sql(cond: str | None = None) -> str:
    edges = [float(e) for e in S.LATENCY_EDGES]
    parts = [f"SELECT window_start, {e!r} AS le_value, sum(CASE WHEN latency_ms / 1000 <= {e!r} THEN 1 ELSE 0 END) "
             f"AS bucket_count FROM w GROUP BY window_start" for e in edges]
    parts.append("SELECT window_start, CAST(NULL AS DOUBLE), count(latency_ms) FROM w GROUP BY window_start")
    return f"""
, {_WIN},
h AS ({' UNION ALL '.join(parts)}),
o AS (SELECT window_start, le_value, bucket_count,
        lag(le_value) OVER (PARTITION BY window_start ORDER BY le_value NULLS LAST) AS prev_le,
        coalesce(lag(bucket_count) OVER (PARTITION BY window_start ORDER BY le_value NULLS LAST), 0) AS prev_count,
        0.95 * max(bucket_count) OVER (PARTITION BY window_start) AS rnk,
        max(bucket_count) OVER (PARTITION BY window_start) AS total FROM h),
f AS (SELECT * FROM o WHERE bucket_count >= rnk AND total > 0
      QUALIFY row_number() OVER (PARTITION BY window_start ORDER BY le_value NULLS LAST) = 1),
q AS (SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end,
       round(CASE WHEN le_value IS NULL THEN prev_le
       ELSE coalesce(prev_le, 0) + (le_value - coalesce(prev_le, 0)) * ((rnk - prev_count) / (bucket_count - prev_count)) END, 6)
       AS quantile FROM f)
"""


@query("latency_p95_5m", "W3", with_views(_quantile_sql() + "SELECT *, quantile > 1.0 AS alert_condition FROM q",
                                          "predictions"))
def q_p95(spark, sf):
    q = W.windowed_quantile(_preds(spark, sf), "request_timestamp", "latency_s", S.LATENCY_EDGES, 0.95)
    q = q.withColumn("quantile", F.round("quantile", 6))
    return q.withColumn("alert_condition", F.col("quantile") > 1.0)


@query("alert_for", "W4", with_views(_quantile_sql() + """,
hot AS (SELECT *, CAST(epoch(window_end) AS BIGINT) AS t FROM q WHERE quantile > 1.0),
isl AS (SELECT *, floor(t / 60) - row_number() OVER (ORDER BY t) AS island FROM hot),
st AS (SELECT *, min(t) OVER (PARTITION BY island) AS t0 FROM isl)
SELECT window_start, window_end, quantile, t - t0 AS active_seconds, make_timestamp(t0 * 1000000) AS active_since
FROM st WHERE t - t0 >= 120""", "predictions"))
def q_alert_for(spark, sf):
    q = W.windowed_quantile(_preds(spark, sf), "request_timestamp", "latency_s", S.LATENCY_EDGES, 0.95)
    q = q.withColumn("quantile", F.round("quantile", 6))
    return W.alert_for(q, F.col("quantile") > 1.0, "2 minutes")


DRIFT_ALERT_SQL = with_views("""
, d AS (SELECT recorded_at AS ts, coalesce(metric_value > 0.2, false) AS c FROM model_metrics
        WHERE metric_name = 'drift_score' AND recorded_at IS NOT NULL),
g AS (SELECT ts, sum(CASE WHEN c THEN 0 ELSE 1 END) AS nf, sum(CASE WHEN c THEN 1 ELSE 0 END) AS nt
      FROM d GROUP BY ts),
k AS (SELECT *, sum(nf) OVER (ORDER BY ts) - nf AS before FROM g),
ep AS (SELECT before, min(ts) AS active_since FROM k WHERE nt > 0 GROUP BY before),
e AS (SELECT before, ts AS resolved_at FROM k WHERE nf > 0)
SELECT active_since, active_since + INTERVAL 300 SECOND AS fired_at, resolved_at
FROM ep LEFT JOIN e USING (before)
WHERE resolved_at IS NULL OR resolved_at >= active_since + INTERVAL 300 SECOND""", "model_metrics")


@query("drift_alert", "W5", DRIFT_ALERT_SQL)
def q_drift_alert(spark, sf):
    m = I.metrics(spark, sf).filter(F.col("metric_name") == "drift_score")
    return W.alert_on_samples(m, "recorded_at", F.col("metric_value") > S.DRIFT_THRESHOLD, "5 minutes")


@query("absence_alert", "W6", with_views("""
, s AS (SELECT DISTINCT CAST(floor(epoch(request_timestamp) / 60) AS BIGINT) AS slot FROM predictions),
g AS (SELECT range AS slot FROM range((SELECT min(slot) FROM s), (SELECT max(slot) FROM s) + 1))
SELECT make_timestamp(slot * 60 * 1000000) AS slot_start, make_timestamp((slot + 1) * 60 * 1000000) AS slot_end
FROM g WHERE slot NOT IN (SELECT slot FROM s)""", "predictions"))
def q_absence(spark, sf):
    return W.absence_alert(I.predictions(spark, sf), "request_timestamp", "1 minute")
