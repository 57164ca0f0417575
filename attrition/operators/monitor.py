"""Windowed monitoring over the prediction log (batch twins of the stream).

The maths of the original dashboards and alert rules (rates over 5-minute
ranges, histogram quantiles, ``for:`` hold times, absence) re-expressed as
DataFrame operators over event time. Sliding windows come from Spark's
``window()`` (each event lands in width/slide windows, aggregated with a
partial hash aggregate); hold-time logic runs on the per-window rows, which
are bounded by the time range, not by the data volume.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def event_time(df: DataFrame, ts: str, out: str = "event_time") -> DataFrame:
    """Cast to ``timestamp`` (``timestamp_ntz`` is rejected by watermarks)."""
    return df.withColumn(out, F.col(ts).cast("timestamp"))


def _seconds(width: str) -> int:
    n, unit = width.split()
    return int(n) * {"second": 1, "seconds": 1, "minute": 60, "minutes": 60, "hour": 3600, "hours": 3600}[unit]


def sliding_sums(df: DataFrame, ts: str, sums: dict, width: str = "5 minutes", slide: str = "1 minute",
                 by: Sequence[str | Column] = ()) -> DataFrame:
    """Sums of the ``sums`` expressions per sliding window (as ``window(ts,
    width, slide)``: windows start on multiples of ``slide``, only windows
    with rows appear), plus ``window_start`` / ``window_end``.

    Pre-aggregated: every row is summed once into its ``slide``-wide slot
    (a partial aggregate), and only the slot rows are copied into the
    ``width / slide`` windows that hold them and summed again, so the copy
    and the second shuffle grow with the time range, not with the events.
    Falls back to ``window()`` when ``width`` is not a multiple of ``slide``.
    """
    w_s, s_s = _seconds(width), _seconds(slide)
    t = F.col(ts).cast("timestamp")
    if w_s % s_s:
        return (df.groupBy(F.window(t, width, slide).alias("w"), *by)
                  .agg(*[F.sum(e).alias(n) for n, e in sums.items()])
                  .withColumn("window_start", F.col("w.start")).withColumn("window_end", F.col("w.end"))
                  .drop("w"))
    k = w_s // s_s
    slot_us = s_s * 1_000_000
    slots = (df.filter(t.isNotNull())
               .groupBy(F.floor(F.unix_micros(t) / F.lit(slot_us)).alias("__slot"), *by)
               .agg(*[F.sum(e).alias(n) for n, e in sums.items()]))
    by_names = slots.columns[1:1 + len(by)]
    wins = (slots.withColumn("__i", F.explode(F.sequence(F.col("__slot") - F.lit(k - 1), F.col("__slot"))))
                 .groupBy(*by_names, "__i").agg(*[F.sum(n).alias(n) for n in sums]))
    start_us = F.col("__i") * F.lit(slot_us)
    return (wins.withColumn("window_start", F.timestamp_micros(start_us))
                .withColumn("window_end", F.timestamp_micros(start_us + F.lit(w_s * 1_000_000)))
                .drop("__i"))


def windowed_rate(df: DataFrame, ts: str, width: str = "5 minutes", slide: str = "1 minute",
                  by: Sequence[str | Column] = (), flag: str | None = None) -> DataFrame:
    """Events per second in sliding windows (``count / width``), and
    for a 0/1 ``flag`` column also the flagged rate and share."""
    secs = float(_seconds(width))
    sums = {"events": F.lit(1).cast("long")}
    if flag:
        sums["flagged"] = F.col(flag).cast("long")
    out = sliding_sums(df, ts, sums, width, slide, by).withColumn("rate", F.round(F.col("events") / secs, 6))
    if flag:
        out = (out.withColumn("flagged_rate", F.round(F.col("flagged") / secs, 6))
                  .withColumn("flagged_share", F.round(F.col("flagged") / F.col("events"), 6)))
    return out


def windowed_quantile(df: DataFrame, ts: str, col: str, edges: Sequence[float], q: float,
                      width: str = "5 minutes", slide: str = "1 minute", by: Sequence[str] = ()) -> DataFrame:
    """Histogram-quantile of ``col`` per sliding window: cumulative
    bucket counts per window (pre-aggregated per slot, :func:`sliding_sums`),
    then the interpolation as a per-row expression (:func:`quantile_from_buckets`)."""
    x = F.col(col)
    sums = {f"b{i}": (x <= F.lit(float(e))).cast("long") for i, e in enumerate(edges)}
    sums["b_inf"] = x.isNotNull().cast("long")
    return (sliding_sums(df, ts, sums, width, slide, by)
              .select("window_start", "window_end", *by, quantile_from_buckets(edges, q).alias("quantile")))


def quantile_from_buckets(edges: Sequence[float], q: float, prefix: str = "b", inf_col: str = "b_inf") -> Column:
    """Histogram quantile as one expression over cumulative bucket columns
    ``b0..b{n-1}`` (``<= edges[i]``) and ``b_inf`` (all observations).

    Same rule as :func:`aggregate.histogram_quantile` (linear interpolation in
    the bucket where the rank falls, the first bucket starts at 0, the +Inf
    bucket returns the last finite edge, no observations gives null), but
    without window functions, so it also runs on a streaming aggregate.
    """
    total = F.col(inf_col)
    rank = F.lit(float(q)) * total
    expr = None
    prev_le, prev_cnt = F.lit(0.0), F.lit(0).cast("long")
    for i, e in enumerate(edges):
        cnt = F.col(f"{prefix}{i}")
        val = prev_le + (F.lit(float(e)) - prev_le) * ((rank - prev_cnt) / (cnt - prev_cnt))
        cond = cnt >= rank
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
        prev_le, prev_cnt = F.lit(float(e)), cnt
    return F.when(total > 0, expr.otherwise(F.lit(float(edges[-1]))))


def alert_for(windows: DataFrame, condition: Column, hold: str, time_col: str = "window_end",
              step: str = "1 minute", by: Sequence[str] = ()) -> DataFrame:
    """Rows where ``condition`` has held at every evaluation step for at
    least ``hold`` (Prometheus ``for:``). Evaluations are the rows of
    ``windows`` at ``time_col``, one per ``step``; a missing step breaks the run.

    Returns the firing rows with ``active_since`` and ``active_seconds``.

    A run starts at a true step whose previous step is not true (an equi
    anti-join); the run number of every true step is the count of starts up
    to it, a distributed prefix sum (:mod:`prefix`), so no window spans a
    whole series.
    """
    from .prefix import join_on, ordered_cumsum
    step_s = _seconds(step)
    hold_s = _seconds(hold)
    hot = (windows.filter(F.coalesce(condition, F.lit(False)) & F.col(time_col).isNotNull())
                  .withColumn("__t", F.unix_seconds(F.col(time_col))))
    steps = hot.select(*by, "__t").distinct()
    prev = steps.select(*by, (F.col("__t") + F.lit(step_s)).alias("__t")).withColumn("__prev", F.lit(1))
    steps = (join_on(steps, prev, [*by, "__t"], "left")
                  .withColumn("__start", F.when(F.col("__prev").isNull(), 1).otherwise(0)).drop("__prev"))
    runs = ordered_cumsum(steps, "__t", ["__start"], by=by).withColumnRenamed("cum___start", "__run")
    starts = runs.filter(F.col("__start") == 1).select(*by, "__run", F.col("__t").alias("__since"))
    since = join_on(runs, starts, [*by, "__run"]).select(*by, "__t", "__since")
    return (join_on(hot, since, [*by, "__t"])
               .withColumn("active_seconds", (F.col("__t") - F.col("__since")).cast("long"))
               .filter(F.col("active_seconds") >= hold_s)
               .withColumn("active_since", F.timestamp_seconds("__since"))
               .select(*windows.columns, "active_seconds", "active_since"))


def gauge_per_step(samples: DataFrame, ts: str, value: str, step: str = "1 minute",
                   by: Sequence[str] = ()) -> DataFrame:
    """Latest sample value in every step (one row per step that has samples)."""
    s = F.window(F.col(ts).cast("timestamp"), step)
    return (samples.groupBy(s.alias("w"), *by)
                   .agg(F.max_by(F.col(value), F.struct(F.col(ts), F.col(value))).alias(value))
                   .withColumn("window_start", F.col("w.start")).withColumn("window_end", F.col("w.end"))
                   .drop("w"))


def alert_on_samples(samples: DataFrame, ts: str, condition: Column, hold: str,
                     by: Sequence[str] = ()) -> DataFrame:
    """A gauge that keeps its last sampled value; the alert fires when
    the condition has stayed true for ``hold`` since the sample that made it
    true. One row per fired episode: ``active_since``, ``fired_at``,
    ``resolved_at`` (first sample that made it false, null if still active).

    An episode is a maximal run of true samples; it is named by the number of
    false samples before it (a false sample at the same instant ends it).
    That count is a distributed prefix sum over the per-instant counts
    (:mod:`prefix`), so no window ever holds more than one bucket of distinct
    instants, however many samples one series has. The false sample that
    ends episode ``k`` is the one with ``k`` false samples before it: an
    equi-join.
    """
    from .prefix import join_on, ordered_cumsum
    hold_s = _seconds(hold)
    c = F.coalesce(condition, F.lit(False))
    per_instant = (samples.select(*by, F.col(ts).cast("timestamp").alias("__ts"), c.alias("__c"))
                          .filter(F.col("__ts").isNotNull())     # a sample without time has no place
                          .groupBy(*by, "__ts")
                          .agg(F.sum(F.when(F.col("__c"), 0).otherwise(1)).alias("__nf"),
                               F.sum(F.when(F.col("__c"), 1).otherwise(0)).alias("__nt"))
                          .withColumn("__us", F.unix_micros("__ts")))
    cum = ordered_cumsum(per_instant, "__us", ["__nf"], by=by)
    cum = cum.withColumn("__before", F.col("cum___nf") - F.col("__nf"))
    ep = (cum.filter(F.col("__nt") > 0)
             .groupBy(*by, "__before").agg(F.min("__ts").alias("active_since")))
    ends = cum.filter(F.col("__nf") > 0).select(*by, "__before", F.col("__ts").alias("resolved_at"))
    fire = F.col("active_since") + F.expr(f"INTERVAL {hold_s} SECONDS")
    return (join_on(ep, ends, [*by, "__before"], "left")
              .withColumn("fired_at", fire)
              .filter(F.col("resolved_at").isNull() | (F.col("resolved_at") >= fire))
              .select(*by, "active_since", "fired_at", "resolved_at"))


def absence_alert(df: DataFrame, ts: str, gap: str = "1 minute") -> DataFrame:
    """Every ``gap``-wide slot between the first and last event with no
    event at all (stand-in for ``up == 0``). The slot grid is a distributed
    ``spark.range`` over the time range (its size depends on the range, not
    on the data volume), anti-joined with the slots that saw events."""
    secs = _seconds(gap)
    t = F.unix_seconds(F.col(ts).cast("timestamp"))
    slot = F.floor(t / secs)
    seen = df.select(slot.alias("slot")).distinct()
    lo, hi = df.agg(F.min(slot), F.max(slot)).first()
    if lo is None:
        return df.sparkSession.createDataFrame([], "slot_start timestamp, slot_end timestamp")
    grid = df.sparkSession.range(int(lo), int(hi) + 1).withColumnRenamed("id", "slot")
    return (grid.join(seen, "slot", "left_anti")
                .select(F.timestamp_seconds(F.col("slot") * secs).alias("slot_start"),
                        F.timestamp_seconds((F.col("slot") + 1) * secs).alias("slot_end")))
