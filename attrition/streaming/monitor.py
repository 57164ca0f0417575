"""Structured Streaming versions of the monitoring and scoring operators.

A file stream of prediction events (or score requests) feeds watermarked
sliding-window aggregates written in append mode (a window is emitted once
the watermark passes its end, so state stays bounded), and a stateless
scoring stream. Every sink has its own checkpoint folder under the shared
checkpoint directory, so a restarted query resumes exactly where it stopped.
"""

from __future__ import annotations

from typing import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators import ml as M
from ..operators.monitor import _seconds, quantile_from_buckets
from ..session import scratch_path
from ..sources import sinks as K
from ..sources.views import VIEWS


def view_stream(spark: SparkSession, folder_or_file: str, view: str, max_files: int | None = None) -> DataFrame:
    """Stream a driver table through one of the derived-view projections.

    ``max_files`` bounds the files of a micro-batch (default: all there are,
    so a backfill runs in parallel)."""
    table, cols = VIEWS[view]
    schema = spark.read.parquet(folder_or_file).schema
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if folder_or_file.rstrip("/").endswith(".parquet"):
        # a single file: stream its folder, filtered to that file name
        folder, _, name = folder_or_file.rstrip("/").rpartition("/")
        raw = reader.option("pathGlobFilter", name).parquet(folder)
    else:
        raw = reader.parquet(folder_or_file)
    return raw.selectExpr(*[f"{e} AS {c}" for c, e in cols])


def windowed_rate_stream(stream: DataFrame, ts: str, width: str = "5 minutes", slide: str = "1 minute",
                         watermark: str = "10 minutes", flag: str | None = None,
                         by: Sequence[str] = ()) -> DataFrame:
    """W1/W2 (stream): watermarked sliding-window counts and rates."""
    secs = float(_seconds(width))
    aggs = [F.count(F.lit(1)).alias("events")]
    if flag:
        aggs.append(F.sum(F.col(flag).cast("long")).alias("flagged"))
    out = (stream.withColumn("__et", F.col(ts).cast("timestamp"))
                 .withWatermark("__et", watermark)
                 .groupBy(F.window("__et", width, slide).alias("w"), *by).agg(*aggs)
                 .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by,
                         "events", *(["flagged"] if flag else []))
                 .withColumn("rate", F.round(F.col("events") / secs, 6)))
    if flag:
        out = (out.withColumn("flagged_rate", F.round(F.col("flagged") / secs, 6))
                  .withColumn("flagged_share", F.round(F.col("flagged") / F.col("events"), 6)))
    return out


def windowed_quantile_stream(stream: DataFrame, ts: str, col: str, edges: Sequence[float], q: float,
                             width: str = "5 minutes", slide: str = "1 minute",
                             watermark: str = "10 minutes") -> DataFrame:
    """W3 (stream): per watermarked sliding window, cumulative bucket counts
    in one aggregate, then the quantile as a per-row expression."""
    x = F.col(col)
    aggs = [F.sum((x <= F.lit(float(e))).cast("long")).alias(f"b{i}") for i, e in enumerate(edges)]
    aggs.append(F.count(x).alias("b_inf"))
    return (stream.withColumn("__et", F.col(ts).cast("timestamp"))
                  .withWatermark("__et", watermark)
                  .groupBy(F.window("__et", width, slide).alias("w")).agg(*aggs)
                  .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                          quantile_from_buckets(edges, q).alias("quantile")))


class HoldTimeAlert(StatefulProcessor):
    """``for:`` hold time across micro-batches (W4, stream).

    Input per key: the windows whose condition is true, as they close.
    State: start and last evaluation time (seconds) of the current run of
    consecutive steps. A window fires when its run has lasted ``hold``. The
    runs of a micro-batch are found by array operations and the firing
    windows leave in chunks.
    """

    CHUNK = 10_000

    def __init__(self, hold_s: int, step_s: int, keep: Sequence[str]):
        self.hold_s, self.step_s, self.keep = hold_s, step_s, list(keep)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.run = handle.getValueState("run", "start long, last long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat([r[self.keep] for r in rows], ignore_index=True).sort_values("window_end", ignore_index=True)
        t = pd.to_datetime(pdf["window_end"]).to_numpy().astype("datetime64[s]").astype(np.int64)
        start, last = self.run.get() if self.run.exists() else (int(t[0]), int(t[0]) - self.step_s)
        fresh = np.diff(t, prepend=last) != self.step_s      # a run begins at this window
        at = np.maximum.accumulate(np.where(fresh, np.arange(len(t)), -1))
        since = np.where(at < 0, start, t[np.maximum(at, 0)])
        self.run.update((int(since[-1]), int(t[-1])))
        fired = t - since >= self.hold_s
        out = pdf[fired].assign(active_seconds=(t - since)[fired], active_since=pd.to_datetime(since[fired], unit="s"))
        for i in range(0, max(1, len(out)), self.CHUNK):
            yield out.iloc[i:i + self.CHUNK]

    def close(self) -> None:
        pass


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def state_session(spark: SparkSession) -> SparkSession:
    """A session beside ``spark`` (same context) whose state store is RocksDB,
    as the stateful alerts need; the caller's own session is left as it is."""
    own = spark.newSession()
    for k in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions"):
        own.conf.set(k, spark.conf.get(k))
    own.conf.set(STATE_STORE, ROCKSDB)
    return own


def alert_for_stream(windows: DataFrame, condition: Column, hold: str, step: str = "1 minute",
                     by: Sequence[str] = ()) -> DataFrame:
    """W4 (stream): firing windows of a watermarked window stream whose
    ``condition`` held at every step for ``hold``, per series ``by``. One
    state row per series; the windows a micro-batch closes are bounded by its
    time span. ``windows`` must come from a session with the RocksDB state
    store (:func:`state_session`)."""
    if windows.sparkSession.conf.get(STATE_STORE, "") != ROCKSDB:
        raise ValueError(f"set {STATE_STORE} to {ROCKSDB}, or read the stream in state_session(spark)")
    keep = [c for c in windows.columns]
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in windows.schema.fields)
    hot = windows.filter(F.coalesce(condition, F.lit(False)))
    if not by:
        hot = hot.withColumn("__alert", F.lit("alert"))
    return hot.groupBy(*(by or ["__alert"])).transformWithStateInPandas(
        HoldTimeAlert(_seconds(hold), _seconds(step), keep),
        f"{fields}, active_seconds long, active_since timestamp", "Append", "None")


class GaugeAlert(StatefulProcessor):
    """``for:`` hold time of a gauge that keeps its last value (W5, stream).

    Input per key: the instants with samples, as the watermark closes them
    (``et_us``, false and true samples ``nf``, ``nt``). State: start
    (microseconds) of the running episode and whether it has fired. An
    episode that is still true fires from an event-time timer set to its
    start plus the hold time, so no further sample of the series is needed.
    """

    CHUNK = 10_000
    COLUMNS = ["state", "active_us", "fired_us", "resolved_us"]

    def __init__(self, hold_s: int, by: Sequence[str]):
        self.hold_us, self.by = hold_s * 1_000_000, list(by)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.episode = handle.getValueState("episode", "start_us long, fired boolean")

    def _timer(self, start_us: int) -> int:
        """The first millisecond of the watermark that closes the episode's firing time."""
        return -((start_us + self.hold_us) // -1000)

    def _rows(self, key, rows: list[tuple]) -> Iterator[pd.DataFrame]:
        out = pd.DataFrame(rows, columns=self.COLUMNS).astype({"active_us": "Int64", "fired_us": "Int64", "resolved_us": "Int64"})
        for name, value in zip(self.by, key):
            out[name] = [value] * len(out)
        for i in range(0, max(1, len(out)), self.CHUNK):
            yield out.iloc[i:i + self.CHUNK][[*self.by, *self.COLUMNS]]

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat([r[["et_us", "nf", "nt"]] for r in rows], ignore_index=True).sort_values("et_us")
        t, false, true = (pdf[c].to_numpy(np.int64) for c in ("et_us", "nf", "nt"))
        # an episode is named by the instants with false samples before it
        name = np.cumsum(false > 0) - (false > 0)
        first = pd.Series(t[true > 0]).groupby(name[true > 0]).min().to_dict()
        ends = dict(zip(name[false > 0].tolist(), t[false > 0].tolist()))
        fired = False
        if self.episode.exists():
            start, fired = self.episode.get()
            first[0] = int(start)
            if not fired:
                self.handle.deleteTimer(self._timer(int(start)))
            self.episode.clear()
        out = []
        for k in sorted(first):
            start, end = int(first[k]), ends.get(k)
            fire, before = start + self.hold_us, fired and k == 0
            due = self._timer(start) <= timerValues.getCurrentWatermarkInMs() if end is None else end >= fire
            if due and not before:
                out.append(("firing", start, fire, None))
            if end is not None and due:
                out.append(("resolved", start, fire, end))
            if end is None:
                self.episode.update((start, bool(due or before)))
                if not (due or before):
                    self.handle.registerTimer(self._timer(start))
        yield from self._rows(key, out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        out = []
        if self.episode.exists():
            start, fired = self.episode.get()
            if not fired and self._timer(int(start)) <= expiredTimerInfo.getExpiryTimeInMs():
                self.episode.update((int(start), True))
                out.append(("firing", int(start), int(start) + self.hold_us, None))
        yield from self._rows(key, out)

    def close(self) -> None:
        pass


def alert_on_samples_stream(samples: DataFrame, ts: str, condition: Column, hold: str, by: Sequence[str] = (),
                            heartbeats: DataFrame | None = None, watermark: str = "10 minutes") -> DataFrame:
    """W5 (stream): the changes of a gauge alert, as event time closes them.

    A row ``state = 'firing'`` leaves once the condition has held for ``hold``
    since the sample that made it true, whether or not a sample comes after
    it, and a row ``'resolved'`` at the first false sample after that.
    :func:`alert_episodes` folds them to the rows of the batch twin.

    Samples are counted per series and instant in a watermarked aggregate
    (spread by instant, false and true apart), so the alert sees closed
    instants only and keeps one state row per series. ``heartbeats`` (a stream
    with the column ``ts``) are instants without samples: they make event time
    go on while no sample arrives. Rows without a time have no place.
    ``samples`` must come from a session with the RocksDB state store
    (:func:`state_session`)."""
    if samples.sparkSession.conf.get(STATE_STORE, "") != ROCKSDB:
        raise ValueError(f"set {STATE_STORE} to {ROCKSDB}, or read the stream in state_session(spark)")
    c = F.coalesce(condition, F.lit(False))
    rows = samples.select(*by, F.col(ts).cast("timestamp").alias("__et"),
                          F.when(c, 0).otherwise(1).alias("__f"), F.when(c, 1).otherwise(0).alias("__t"))
    if heartbeats is not None:
        beats = heartbeats.select(F.col(ts).cast("timestamp").alias("__et"), F.lit(0).alias("__f"), F.lit(0).alias("__t"))
        rows = rows.unionByName(beats, allowMissingColumns=True)
    instants = (rows.filter(F.col("__et").isNotNull()).withWatermark("__et", watermark)
                    .groupBy("__et", *by).agg(F.sum("__f").alias("nf"), F.sum("__t").alias("nt"))
                    .filter("nf + nt > 0").withColumn("et_us", F.unix_micros("__et")))
    if not by:
        instants = instants.withColumn("__alert", F.lit("alert"))
    types = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in samples.select(*by).schema.fields) if by else ""
    out = instants.groupBy(*(by or ["__alert"])).transformWithStateInPandas(
        GaugeAlert(_seconds(hold), by), f"{types}state string, active_us long, fired_us long, resolved_us long",
        "Append", "EventTime")
    at = lambda n: F.timestamp_micros(f"{n}_us")
    return out.select(*by, "state", at("active").alias("active_since"), at("fired").alias("fired_at"),
                      at("resolved").alias("resolved_at"))


def alert_episodes(changes: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per fired episode from the written changes of :func:`alert_on_samples_stream`."""
    return changes.groupBy(*by, "active_since", "fired_at").agg(F.max("resolved_at").alias("resolved_at"))


def heartbeat_stream(spark: SparkSession, ts: str) -> DataFrame:
    """One row a second with the current time: what makes event time go on
    while no event arrives."""
    return spark.readStream.format("rate").option("rowsPerSecond", 1).load().select(F.col("timestamp").alias(ts))


def absence_stream(stream: DataFrame, ts: str, heartbeats: DataFrame, gap: str = "1 minute",
                   watermark: str = "10 minutes") -> DataFrame:
    """W6 (stream): ``gap``-wide slots without events, as they close.

    ``heartbeats`` (a stream with the column ``ts``, at least one row per
    slot: :func:`heartbeat_stream`, or the replayed clock of a backfill) are
    counted as zero events in the same watermarked aggregate, so an empty slot
    is a group of its own and leaves as soon as the watermark passes it,
    whether or not an event ever arrives again. No custom state, and the work
    is spread by slot."""
    events = stream.select(F.col(ts).cast("timestamp").alias("__et"), F.lit(1).alias("__n"))
    beats = heartbeats.select(F.col(ts).cast("timestamp").alias("__et"), F.lit(0).alias("__n"))
    return (events.unionByName(beats).withWatermark("__et", watermark)
            .groupBy(F.window("__et", gap).alias("w")).agg(F.sum("__n").alias("events"))
            .filter("events = 0").select(F.col("w.start").alias("slot_start"), F.col("w.end").alias("slot_end")))


def start_parquet_sink(df: DataFrame, path: str, checkpoint: str, mode: str = "append",
                       available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    w = df.writeStream.format("parquet").outputMode(mode).option("path", path) \
          .option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "1 minute")
    return w.start()


def score_log_rows(scored: DataFrame) -> DataFrame:
    """Rows of the predictions log from :func:`ml.score_all`, with the status
    and violations of each request: scored and rejected alike."""
    latency = F.col("latency_ms") if "latency_ms" in scored.columns else F.lit(None).cast("double")
    log = scored.withColumns({"prediction_id": F.col("request_id").cast("string"), "latency_ms": latency})
    log = log.select("status", "violations", *K.prediction_log_columns(log))
    return log


def stream_score(stream: DataFrame, models: dict, sink: str, checkpoint: str,
                 vote: Sequence[str] | None = None, features: Sequence[str] | None = None,
                 store: DataFrame | None = None, run_id: str = "", available_now: bool = True) -> StreamingQuery:
    """Score request rows as they arrive (stateless, exactly-once via the
    checkpoint): every request is written once, in the columns of the
    predictions log plus ``status`` and ``violations``."""
    from .. import schemas as S
    scored = M.score_all(stream, models, features or S.MODEL_FEATURES, store=store, vote=vote,
                         model_name="voting_ensemble" if vote else list(models)[0])
    out = score_log_rows(scored).withColumn("pipeline_run_id", F.lit(run_id))
    return start_parquet_sink(out, sink, checkpoint, "append", available_now)


def run_to_completion(spark: SparkSession, df: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Run a streaming frame over all available input (``availableNow``)
    into a fresh Parquet sink; return the sink read back as a batch frame."""
    sink = scratch_path(spark, f"{name}-sink")
    ckpt = scratch_path(spark, f"{name}-checkpoint")
    q = start_parquet_sink(df, sink, ckpt, mode, available_now=True)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return spark.read.schema(df.schema).parquet(sink)
