"""Summaries, counters, histograms, latest values and top-k.

Every global figure is one ``agg`` (partial aggregation on the map side, one
row shuffled per task). Shares use a scalar subquery (``DataFrame.scalar``)
for the denominator instead of a window over all rows or a cross join.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import columns as C


def _r(c: Column, scale: int | None) -> Column:
    return F.round(c, scale) if scale is not None else c


def summary(df: DataFrame, spec: Mapping[str, Column]) -> DataFrame:
    """A1/A3: one-row global summary; ``spec`` maps output name to aggregate."""
    return df.agg(*[expr.alias(name) for name, expr in spec.items()])


def dataset_summary(df: DataFrame, label: str = "Churn", positive="Yes", scale: int = 6) -> DataFrame:
    """A1: rows, columns, churn rate, tenure range and mean monthly charge."""
    return summary(df, {
        "n_rows": F.count(F.lit(1)),
        "n_columns": F.lit(len(df.columns)).cast("long"),
        "churn_rate": _r(F.avg((F.col(label) == F.lit(positive)).cast("double")), scale),
        "tenure_min": F.min("tenure"),
        "tenure_max": F.max("tenure"),
        "monthly_mean": _r(F.avg("MonthlyCharges"), scale),
    })


def preprocess_summary(df: DataFrame, label: str = "Churn", scale: int = 6) -> DataFrame:
    """A3: rows, feature count, churn rate, average services."""
    return summary(df, {
        "n_rows": F.count(F.lit(1)),
        "n_features": F.lit(len(df.columns) - 1).cast("long"),
        "churn_rate": _r(F.avg(F.col(label).cast("double")), scale),
        "avg_services": _r(F.avg(F.col("num_services").cast("double")), scale),
    })


def value_counts(df: DataFrame, col: str, normalize: bool = True, scale: int = 6) -> DataFrame:
    """A2: count per category plus its share of all rows.

    The denominator is a scalar subquery, so no single task sees all groups.
    """
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    if not normalize:
        return counts
    # the total is summed from the grouped rows: the subquery reuses the same exchange
    total = counts.select(F.sum("n")).scalar()
    return counts.withColumn("share", _r(F.col("n") / total, scale))


def rate_by_group(df: DataFrame, by: Sequence[str], label: str, scale: int = 6) -> DataFrame:
    """Group size, positives, positive rate and share of all rows."""
    grouped = (df.groupBy(*by)
                 .agg(F.count(F.lit(1)).alias("n"),
                      F.sum(F.col(label).cast("long")).alias("positives")))
    # a count(*) subquery: Catalyst prunes every column, so it is a metadata-light
    # scan plus one tiny exchange (summing the grouped rows would redo the grouping,
    # since the pruned subquery plan no longer matches the main exchange)
    total = df.select(F.count(F.lit(1))).scalar()
    return (grouped.withColumn("rate", _r(F.col("positives") / F.col("n"), scale))
                   .withColumn("share", _r(F.col("n") / total, scale)))


def table_stats(tables: Mapping[str, DataFrame]) -> DataFrame:
    """A4: row count per table as one long frame."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def batch_summary(scored: DataFrame, by: Sequence[str] = (), pred: str = "churn_prediction",
                  scale: int = 4) -> DataFrame:
    """A5: total, churn count, churn rate; an empty batch gives a null rate."""
    g = scored.groupBy(*by) if by else scored.groupBy()
    return (g.agg(F.count(F.lit(1)).alias("total_customers"),
                  F.coalesce(F.sum(F.col(pred).cast("long")), F.lit(0).cast("long")).alias("churn_count"))
             .withColumn("churn_rate", C.round_half_even(
                 F.try_divide(F.col("churn_count").cast("double"), F.col("total_customers")), scale)))


def top_n(df: DataFrame, ts: str, n: int, desc: bool = True, tie: Sequence[str] = ()) -> DataFrame:
    """newest/oldest ``n`` rows with a deterministic tie-break.

    ``orderBy(...).limit(n)`` plans as TakeOrderedAndProject: each task keeps
    its own top ``n`` and only ``n`` rows per task reach the final merge.
    """
    order = [F.col(ts).desc() if desc else F.col(ts).asc()]
    order += [F.col(t).desc() if desc else F.col(t).asc() for t in tie]
    return df.orderBy(*order).limit(n)


def history_summary(predictions: DataFrame, n: int = 100, ts: str = "request_timestamp",
                    tie: Sequence[str] = ("prediction_id",)) -> DataFrame:
    """Over the newest ``n`` predictions: totals, churn, mean % and latency."""
    recent = top_n(predictions, ts, n, True, tie)
    return recent.agg(
        F.count(F.lit(1)).alias("total"),
        F.sum(F.col("churn_prediction").cast("long")).alias("predicted_churn"),
        F.round(F.avg("churn_probability") * 100, 1).alias("avg_probability_pct"),
        F.round(F.avg("latency_ms"), 1).alias("avg_latency_ms"),
    )


def counter(df: DataFrame, labels: Sequence[str | Column]) -> DataFrame:
    """Event counter by label set (what a Prometheus counter holds)."""
    return df.groupBy(*labels).agg(F.count(F.lit(1)).alias("count"))


def _edge_label(e: float) -> str:
    return repr(float(e))


def histogram_le(df: DataFrame, col: str | Column, edges: Sequence[float], by: Sequence[str] = (),
                 name: str = "value") -> DataFrame:
    """Cumulative ``le`` buckets plus sum and count, in one aggregate.

    Output (long): ``by..., le (text, '+Inf' last), le_value (null for +Inf),
    bucket_count, sum, count``.
    """
    x = C.col_(col)
    aggs = [F.sum((x <= F.lit(float(e))).cast("long")).alias(f"b{i}") for i, e in enumerate(edges)]
    aggs += [F.count(x).alias("b_inf"), F.sum(x).alias("sum"), F.count(x).alias("count")]
    g = df.groupBy(*by) if by else df.groupBy()
    wide = g.agg(*aggs)
    stack_args = ", ".join([f"'{_edge_label(e)}', CAST({float(e)!r} AS DOUBLE), b{i}" for i, e in enumerate(edges)]
                           + ["'+Inf', CAST(NULL AS DOUBLE), b_inf"])
    n = len(edges) + 1
    return wide.select(*by, F.expr(f"stack({n}, {stack_args}) AS (le, le_value, bucket_count)"),
                       "sum", "count").withColumn("histogram", F.lit(name))


def histogram_quantile(hist: DataFrame, q: float, by: Sequence[str] = ()) -> DataFrame:
    """Prometheus-style quantile from cumulative buckets.

    Linear interpolation inside the bucket where the rank falls; the first
    bucket starts at 0; a rank in the +Inf bucket returns the last finite
    edge; no observations gives null. The window runs over the histogram
    (a few rows per group), never over raw data.
    """
    w = Window.partitionBy(*by).orderBy(F.col("le_value").asc_nulls_last())
    h = (hist.withColumn("prev_le", F.lag("le_value").over(w))
             .withColumn("prev_count", F.coalesce(F.lag("bucket_count").over(w), F.lit(0)))
             .withColumn("total", F.max("bucket_count").over(Window.partitionBy(*by)))
             .withColumn("rank", F.lit(float(q)) * F.col("total")))
    hit = h.filter((F.col("bucket_count") >= F.col("rank")) & (F.col("total") > 0))
    first = hit.groupBy(*by).agg(F.min_by(F.struct("le_value", "prev_le", "prev_count", "bucket_count", "rank"),
                                          F.coalesce(F.col("le_value"), F.lit(float("inf")))).alias("b"))
    start = F.coalesce(F.col("b.prev_le"), F.lit(0.0))
    inside = start + (F.col("b.le_value") - start) * (
        (F.col("b.rank") - F.col("b.prev_count")) / (F.col("b.bucket_count") - F.col("b.prev_count")))
    value = F.when(F.col("b.le_value").isNull(), F.col("b.prev_le")).otherwise(inside)
    groups = hist.select(*by).distinct() if by else hist.sparkSession.range(1).select()
    res = first.select(*by, value.alias("quantile"))
    return groups.join(res, list(by), "left") if by else res


def latest_value(df: DataFrame, keys: Sequence[str], ts: str, value_cols: Sequence[str],
                 tie: Sequence[str] = ()) -> DataFrame:
    """Newest row per key (by ``ts`` then tie-break columns).

    ``max_by`` is a partial aggregate, so a hot key is combined map-side.
    """
    order = F.struct(F.col(ts), *[F.col(t) for t in tie])
    payload = F.struct(*[F.col(c) for c in [ts, *value_cols]])
    g = df.groupBy(*keys) if keys else df.groupBy()
    return g.agg(F.max_by(payload, order).alias("_l")).select(*keys, "_l.*")


def gauge_bands(df: DataFrame, value: str = "metric_value", warn: float = 0.1, crit: float = 0.2) -> DataFrame:
    """Display band of a gauge: ok < warn <= warning < crit <= critical."""
    v = F.col(value)
    return df.withColumn("band", F.when(v >= crit, "critical").when(v >= warn, "warning").otherwise("ok"))


def rank_models(metrics: DataFrame, metric: str, by: Sequence[str] = ("run_id",),
                value: str = "metric_value", name: str = "model_name",
                tie: Sequence[str] = ("recorded_at",)) -> DataFrame:
    """T5: order models by a metric within each run; mark the best.

    First wins ties: equal values are ordered by ``tie`` (first recorded, or
    a training-order column), then by model name. The rank is a distributed row number over
    range parts (:func:`prefix.ordered_row_number`), so a run with a third
    of all rows still spreads over many tasks.
    """
    from .prefix import ordered_row_number
    order = [F.col(value).desc(), *[F.col(t).asc() for t in tie], F.col(name).asc()]
    ranked = ordered_row_number(metrics.filter(F.col("metric_name") == metric), order, by=by, out="rank")
    return ranked.withColumn("is_best", F.col("rank") == 1)
