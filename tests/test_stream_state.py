"""Streaming alert state across micro-batches equals the batch twin."""
import datetime as dt
import time

import pytest

import check_oracle as CO
from pyspark.sql import functions as F

from attrition import schemas as S
from attrition.operators import monitor as W
from attrition.plans import inputs as I
from attrition.session import scratch_path
from attrition.sources.views import table_path
from attrition.streaming import monitor as SM


def test_hold_time_alert_across_batches(spark, sf):
    events = spark.read.parquet(table_path(sf, "events"))
    lo, hi = events.agg(F.min("ts"), F.max("ts")).first()
    folder = scratch_path(spark, "events-split")
    step = (hi - lo) / 5
    for i in range(5):   # five files written in time order -> five micro-batches
        a, b = lo + step * i, lo + step * (i + 1)
        part = events.filter((F.col("ts") >= a) & ((F.col("ts") < b) if i < 4 else F.lit(True)))
        part.coalesce(1).write.mode("append").parquet(folder)
    before = spark.conf.get(SM.STATE_STORE, None)
    own = SM.state_session(spark)
    s = SM.view_stream(own, folder, "predictions", max_files=1).withColumn("latency_s", F.col("latency_ms") / 1000)
    q = SM.windowed_quantile_stream(s, "request_timestamp", "latency_s", S.LATENCY_EDGES, 0.95) \
        .withColumn("quantile", F.round("quantile", 6))
    got = SM.run_to_completion(spark, SM.alert_for_stream(q, F.col("quantile") > 1.0, "2 minutes"), "alert-split")

    preds = I.predictions(spark, sf).withColumn("latency_s", F.col("latency_ms") / 1000)
    mx = preds.agg(F.max("request_timestamp")).first()[0]
    wq = W.windowed_quantile(preds, "request_timestamp", "latency_s", S.LATENCY_EDGES, 0.95) \
        .withColumn("quantile", F.round("quantile", 6))
    closed = wq.filter(F.col("window_end") <= F.lit(mx) - F.expr("INTERVAL 10 MINUTES"))
    want = W.alert_for(closed, F.col("quantile") > 1.0, "2 minutes")
    assert got.count() > 0
    assert CO.compare(got.toPandas(), want.select(*got.columns).toPandas()) == "ok"
    assert spark.conf.get(SM.STATE_STORE, None) == before


def _write_batches(spark, rows, schema, folder, n, ts):
    """``rows`` in time order as n files, one per micro-batch."""
    rows = sorted(rows, key=lambda r: r[0])
    for i in range(n):
        part = rows[len(rows) * i // n:len(rows) * (i + 1) // n]
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder)
        time.sleep(0.05)   # files are taken by modification time


def test_hold_time_alert_keeps_series_apart(spark):
    """Two series with the same window ends, alternating: each keeps its own run."""
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for m in range(40):
        rows.append((t0 + dt.timedelta(minutes=m, seconds=5), "a", 9.0 if m % 10 < 7 else 0.0))
        rows.append((t0 + dt.timedelta(minutes=m, seconds=9), "b", 9.0 if m >= 5 else 0.0))
    folder = scratch_path(spark, "two-series")
    _write_batches(spark, rows, "ts timestamp, series string, v double", folder, 4, "ts")
    own = SM.state_session(spark)
    raw = own.readStream.schema("ts timestamp, series string, v double").option("maxFilesPerTrigger", 1).parquet(folder)
    windows = (raw.withWatermark("ts", "1 minute").groupBy(F.window("ts", "1 minute").alias("w"), "series")
               .agg(F.max("v").alias("v")).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "series", "v"))
    got = SM.run_to_completion(own, SM.alert_for_stream(windows, F.col("v") > 1, "2 minutes", by=["series"]), "by-series")
    batch = spark.createDataFrame(rows, "ts timestamp, series string, v double")
    batch = (batch.groupBy(F.window("ts", "1 minute").alias("w"), "series").agg(F.max("v").alias("v"))
             .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "series", "v")
             .filter(F.col("window_end") <= F.lit(rows[-1][0] - dt.timedelta(minutes=1))))
    want = W.alert_for(batch, F.col("v") > 1, "2 minutes", by=["series"])
    assert {r.series for r in got.collect()} == {"a", "b"}
    assert CO.compare(got.toPandas(), want.select(*got.columns).toPandas()) == "ok"


def test_alert_needs_the_state_store(spark):
    s = spark.readStream.format("rate").load().select(F.col("timestamp").alias("window_end"), "value")
    plain = spark.newSession().readStream.format("rate").load().select(F.col("timestamp").alias("window_end"), "value")
    with pytest.raises(ValueError):
        SM.alert_for_stream(plain, F.lit(True), "1 minute")
    assert s.isStreaming


def test_absence_fires_though_no_event_ever_arrives_again(spark):
    """Events end at minute 20; the clock goes on to minute 60."""
    t0 = dt.datetime(2024, 1, 1)
    seen = [m for m in range(20) if m not in (4, 5, 11)]
    events, clock = scratch_path(spark, "outage-events"), scratch_path(spark, "outage-clock")
    _write_batches(spark, [(t0 + dt.timedelta(minutes=m, seconds=7),) for m in seen] + [(t0 + dt.timedelta(minutes=19, seconds=9),)] * 3,
                   "ts timestamp", events, 4, "ts")
    beats = [(t0 + dt.timedelta(minutes=m),) for m in range(61)]
    # the clock of the first batches keeps step with the events, then runs on alone
    _write_batches(spark, beats[:20], "ts timestamp", clock, 4, "ts")
    _write_batches(spark, beats[20:], "ts timestamp", clock, 2, "ts")
    read = lambda p: spark.readStream.schema("ts timestamp").option("maxFilesPerTrigger", 1).parquet(p)
    out = SM.run_to_completion(spark, SM.absence_stream(read(events), "ts", read(clock)), "outage")
    got = sorted(int((r.slot_start - t0).total_seconds()) // 60 for r in out.collect())
    assert got == [4, 5, 11] + list(range(20, 50))   # closed slots: the clock's minute 60 less the 10 minutes of delay


GAUGE = "ts timestamp, series string, v double"


def _gauge_changes(spark, rows, beats, n, watermark="1 minute"):
    folder, clock = scratch_path(spark, "gauge"), scratch_path(spark, "gauge-clock")
    _write_batches(spark, rows, GAUGE, folder, n, "ts")
    _write_batches(spark, [(b,) for b in beats], "ts timestamp", clock, n, "ts")
    own = SM.state_session(spark)
    read = lambda p, s: own.readStream.schema(s).option("maxFilesPerTrigger", 1).parquet(p)
    out = SM.alert_on_samples_stream(read(folder, GAUGE), "ts", F.col("v") > 1, "5 minutes", by=["series"],
                                     heartbeats=read(clock, "ts timestamp"), watermark=watermark)
    return SM.run_to_completion(own, out, "gauge-out")


def test_gauge_alert_fires_though_the_rising_sample_is_the_last(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(t0, "a", 0.0), (t0 + dt.timedelta(minutes=3), "a", 5.0)]
    got = _gauge_changes(spark, rows, [t0 + dt.timedelta(minutes=m) for m in range(20)], 2).collect()
    assert [(r.series, r.state, r.active_since, r.fired_at, r.resolved_at) for r in got] == \
        [("a", "firing", rows[1][0], rows[1][0] + dt.timedelta(minutes=5), None)]


def test_gauge_alert_stream_equals_batch(spark):
    """Series of runs, ties of true and false at one instant, ends exactly at the firing time, nulls, in 4 batches."""
    t0 = dt.datetime(2024, 1, 1)
    at = lambda m, us=0: t0 + dt.timedelta(minutes=m, microseconds=us)
    rows = []
    for m in range(0, 120, 2):
        rows.append((at(m, 7), "a", 9.0 if m % 20 < 12 else 0.0))
        rows.append((at(m, m), "b", None if m % 34 == 0 else 9.0))
    rows += [(at(5), "c", 9.0), (at(10), "c", 0.0), (at(30), "c", 9.0), (at(34), "c", 9.0), (at(34), "c", 0.0),
             (at(50), "c", 9.0), (at(70), "c", 9.0), (at(70), "c", 0.0), (at(71), "c", 9.0), (at(74), None, 9.0)]
    changes = _gauge_changes(spark, rows, [at(m) for m in range(140)], 4, "10 minutes")
    got = SM.alert_episodes(changes, ["series"])
    want = W.alert_on_samples(spark.createDataFrame(rows, GAUGE), "ts", F.col("v") > 1, "5 minutes", by=["series"])
    assert want.count() > 10
    assert CO.compare(got.toPandas(), want.select(*got.columns).toPandas()) == "ok"
    # each episode fires and resolves once
    assert changes.groupBy("series", "active_since", "state").count().filter("count > 1").isEmpty()
