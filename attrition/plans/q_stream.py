"""Streaming queries: each runs a Structured Streaming job over
all available input (``availableNow``) into a fresh Parquet sink with its
own checkpoint and returns the sink contents.

Append mode emits a window once the watermark (max event time - 10 min)
passes its end, so the oracle is the batch twin restricted to closed windows.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas as S
from ..session import scratch_path
from ..sources.views import table_path
from ..streaming import monitor as SM
from . import inputs as I
from . import q_ml
from .catalog import query
from .oracle_sql import with_views
from .q_monitor import DRIFT_ALERT_SQL

_WIN = """w AS (SELECT p.*, time_bucket(INTERVAL 1 MINUTE, request_timestamp) - to_minutes(r.k) AS window_start
       FROM predictions p, range(0, 5) r(k))"""
_CLOSED = "window_start + INTERVAL 5 MINUTE <= (SELECT max(request_timestamp) FROM predictions) - INTERVAL 10 MINUTE"


@query("stream_rate_5m", "W1", with_views(f"""
, {_WIN}
SELECT * FROM (SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, count(*) AS events,
       round(count(*) / 300.0, 6) AS rate FROM w GROUP BY window_start) WHERE {_CLOSED}""", "predictions"))
def q_stream_rate(spark, sf):
    s = SM.view_stream(spark, table_path(sf, "events"), "predictions")
    return SM.run_to_completion(spark, SM.windowed_rate_stream(s, "request_timestamp"), "stream-rate")


@query("stream_rate_by_result_5m", "W2", with_views(f"""
, {_WIN}
SELECT * FROM (SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, count(*) AS events,
       CAST(sum(churn_prediction) AS BIGINT) AS flagged, round(count(*) / 300.0, 6) AS rate,
       round(sum(churn_prediction) / 300.0, 6) AS flagged_rate, round(sum(churn_prediction) / count(*), 6) AS flagged_share
FROM w GROUP BY window_start) WHERE {_CLOSED}""", "predictions"))
def q_stream_rate_result(spark, sf):
    s = SM.view_stream(spark, table_path(sf, "events"), "predictions")
    out = SM.windowed_rate_stream(s, "request_timestamp", flag="churn_prediction")
    return SM.run_to_completion(spark, out, "stream-rate-result")


@query("stream_score", "W7", with_views(q_ml.REQUEST_SQL.replace("SELECT CAST(request_id AS BIGINT) AS request_id",
       "SELECT CAST(request_id AS VARCHAR) AS prediction_id"), "score_requests"))
def q_stream_score(spark, sf):
    names = ["random_forest", "xgboost", "lightgbm"]
    s = SM.view_stream(spark, table_path(sf, "events"), "score_requests")
    sink = scratch_path(spark, "stream-score-sink")
    q = SM.stream_score(s, q_ml.models(spark, sf), sink, scratch_path(spark, "stream-score-ckpt"),
                        vote=names)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    out = spark.read.parquet(sink)
    consistent = F.when(F.col("status") == "scored", F.col("churn_probability").between(0, 1) & F.col("churn_prediction").isNotNull()) \
        .otherwise(F.col("churn_probability").isNull() & F.col("churn_prediction").isNull()) & F.col("request_timestamp").isNotNull()
    return out.select("prediction_id", "customerID", "status", F.array_join("violations", ",").alias("violations"),
                      F.coalesce(consistent, F.lit(False)).alias("result_matches"))


def _stream_quantile_sql() -> str:
    from .q_monitor import _quantile_sql
    body = _quantile_sql()
    return with_views(body + f"SELECT * FROM q WHERE window_end <= (SELECT max(request_timestamp) FROM predictions) "
                             "- INTERVAL 10 MINUTE", "predictions")


@query("stream_latency_p95_5m", "W3", _stream_quantile_sql())
def q_stream_p95(spark, sf):
    s = SM.view_stream(spark, table_path(sf, "events"), "predictions").withColumn(
        "latency_s", F.col("latency_ms") / 1000)
    out = SM.windowed_quantile_stream(s, "request_timestamp", "latency_s", S.LATENCY_EDGES, 0.95)
    return SM.run_to_completion(spark, out, "stream-p95").withColumn("quantile", F.round("quantile", 6))


def _stream_alert_sql() -> str:
    from .q_monitor import _quantile_sql
    return with_views(_quantile_sql() + """,
qc AS (SELECT * FROM q WHERE window_end <= (SELECT max(request_timestamp) FROM predictions) - INTERVAL 10 MINUTE),
hot AS (SELECT *, CAST(epoch(window_end) AS BIGINT) AS t FROM qc WHERE quantile > 1.0),
isl AS (SELECT *, floor(t / 60) - row_number() OVER (ORDER BY t) AS island FROM hot),
st AS (SELECT *, min(t) OVER (PARTITION BY island) AS t0 FROM isl)
SELECT window_start, window_end, quantile, t - t0 AS active_seconds, make_timestamp(t0 * 1000000) AS active_since
FROM st WHERE t - t0 >= 120""", "predictions")


@query("stream_alert_for", "W4", _stream_alert_sql())
def q_stream_alert(spark, sf):
    own = SM.state_session(spark)
    s = SM.view_stream(own, table_path(sf, "events"), "predictions").withColumn(
        "latency_s", F.col("latency_ms") / 1000)
    q = SM.windowed_quantile_stream(s, "request_timestamp", "latency_s", S.LATENCY_EDGES, 0.95) \
        .withColumn("quantile", F.round("quantile", 6))
    out = SM.alert_for_stream(q, F.col("quantile") > 1.0, "2 minutes")
    return SM.run_to_completion(spark, out, "stream-alert")


@query("stream_drift_alert", "W5", DRIFT_ALERT_SQL)
def q_stream_drift_alert(spark, sf):
    own = SM.state_session(spark)
    s = SM.view_stream(own, table_path(sf, "events"), "model_metrics").filter("metric_name = 'drift_score'")
    # the clock goes on until the last sample can have fired and its watermark has passed
    beats = replayed_clock(own, I.metrics(spark, sf), "recorded_at", ahead=(5 + 10 + 1) * 60)
    out = SM.alert_on_samples_stream(s, "recorded_at", F.col("metric_value") > S.DRIFT_THRESHOLD, "5 minutes", heartbeats=beats)
    return SM.alert_episodes(SM.run_to_completion(own, out, "stream-drift-alert"))


@query("stream_absence_alert", "W6", with_views("""
, s AS (SELECT DISTINCT CAST(floor(epoch(request_timestamp) / 60) AS BIGINT) AS slot FROM predictions),
g AS (SELECT range AS slot FROM range((SELECT min(slot) FROM s), (SELECT max(slot) FROM s) + 1))
SELECT make_timestamp(slot * 60 * 1000000) AS slot_start, make_timestamp((slot + 1) * 60 * 1000000) AS slot_end
FROM g WHERE slot NOT IN (SELECT slot FROM s) AND make_timestamp((slot + 1) * 60 * 1000000)
      <= (SELECT max(request_timestamp) FROM predictions) - INTERVAL 10 MINUTE""", "predictions"))
def q_stream_absence(spark, sf):
    s = SM.view_stream(spark, table_path(sf, "events"), "predictions")
    beats = replayed_clock(spark, I.predictions(spark, sf), "request_timestamp")
    return SM.run_to_completion(spark, SM.absence_stream(s, "request_timestamp", beats), "stream-absence")


def replayed_clock(spark, df, ts, seconds=60, ahead=0):
    """The heartbeats of a backfill: one per slot of the time that ``df`` spans and ``ahead`` seconds more, as a stream."""
    t = F.floor(F.unix_seconds(F.col(ts).cast("timestamp")) / seconds)
    lo, hi = df.agg(F.min(t), F.max(t)).first()
    path = scratch_path(spark, "clock")
    slots = spark.range(int(lo or 0), int(hi or -1) + 1 + ahead // seconds)
    slots.select(F.timestamp_seconds(F.col("id") * seconds).alias(ts)).write.parquet(path)
    return spark.readStream.schema(f"{ts} timestamp").parquet(path)
