"""Distributed ordered prefix sums (cumulative distributions).

ROC/PR curves, exact AUC and two-sample KS/Wasserstein statistics all need
running sums in score order. A ``Window.orderBy`` without a partition would
pull every row into one task, so instead:

1. ties are collapsed first (``groupBy(by, value)``), so a hot value is one
   row, not a third of the data;
2. the distinct values are range-partitioned on (group, value): Spark
   samples the bounds, so parts hold about equally many distinct values
   whatever the value distribution, and a large group spans many parts.
   The part number is pinned with a reliable checkpoint;
3. running sums are taken inside each (group, part) window, and the part
   offsets come from a per-(group, part) total table of at most ``parts``
   rows per group.

The result is exact whatever the part boundaries are; they only spread
the work.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, parts_for


def join_on(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``on`` where null keys match null keys (``<=>``; Spark
    still plans it as a hash or sort-merge join). The key columns appear once."""
    r = right.select(*[F.col(c).alias(f"__r_{c}") if c in on else F.col(c) for c in right.columns])
    cond = [left[c].eqNullSafe(r[f"__r_{c}"]) for c in on]
    return left.join(r, cond, how).drop(*[f"__r_{c}" for c in on])


def collapse(df: DataFrame, value: str, sums: dict, by: Sequence[str] = ()) -> DataFrame:
    """``groupBy(by, value)`` with the given named sum expressions."""
    return df.groupBy(*by, value).agg(*[F.sum(expr).alias(name) for name, expr in sums.items()])


def range_parts(df: DataFrame, value: str, by: Sequence[str] = (), descending: bool = False,
                parts: int | None = None) -> DataFrame:
    """``df`` range-partitioned on (by, value) and pinned by a reliable
    checkpoint, with the sort key ``__o`` and the part number ``__bucket``:
    the input of :func:`ordered_cumsum` with ``pinned=True``, and free to be
    read by other branches of the same plan."""
    keys = list(by) or ["__g"]
    o = (-F.col(value).cast("double")) if descending else F.col(value).cast("double")
    d = df.withColumn("__o", o)
    if not by:
        d = d.withColumn("__g", F.lit(0))
    n = parts or parts_for(df)
    return cut_lineage(d.repartitionByRange(n, *keys, "__o").withColumn("__bucket", F.spark_partition_id()))


def ordered_cumsum(df: DataFrame, value: str, sum_cols: Sequence[str], by: Sequence[str] = (),
                   descending: bool = False, parts: int | None = None, prefix: str = "cum_",
                   with_next: bool = False, pinned: bool = False, next_cols: Sequence[str] = ()) -> DataFrame:
    """Add inclusive running sums ``cum_<c>`` over ``value`` order within ``by``.

    ``df`` must hold one row per (by, value) — use :func:`collapse` first.
    ``with_next`` also adds ``next_value``: the following distinct value in
    the same order (null for the last one), and ``next_cols`` adds
    ``next_<c>``: these columns of the following row, across part borders too.

    ``parts`` (default: from the input size) is the number of range parts;
    the result is exact for any number. With ``pinned``, ``df`` is the result
    of :func:`range_parts` with the same order.
    """
    keys = list(by) or ["__g"]
    d = df if pinned else range_parts(df, value, by, descending, parts)
    w_local = (Window.partitionBy(*keys, "__bucket").orderBy("__o")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    for c in sum_cols:
        d = d.withColumn(f"__l_{c}", F.sum(c).over(w_local))
    extra_aggs = []
    following = {**({"next_value": value} if with_next else {}), **{f"next_{c}": c for c in next_cols}}
    if following:
        row = F.struct(*[F.col(c).alias(name) for name, c in following.items()])
        d = d.withColumn("__lead", F.lead(row).over(Window.partitionBy(*keys, "__bucket").orderBy("__o")))
        extra_aggs = [F.min_by(row, F.col("__o")).alias("__first")]
    totals = d.groupBy(*keys, "__bucket").agg(*[F.sum(c).alias(f"__t_{c}") for c in sum_cols], *extra_aggs)
    # at most `parts` rows per group
    w_off = (Window.partitionBy(*keys).orderBy("__bucket")
             .rowsBetween(Window.unboundedPreceding, -1))
    for c in sum_cols:
        totals = totals.withColumn(f"__off_{c}", F.coalesce(F.sum(f"__t_{c}").over(w_off), F.lit(0)))
    keep = [f"__off_{c}" for c in sum_cols]
    if following:
        totals = totals.withColumn("__next_b", F.lead("__first").over(Window.partitionBy(*keys).orderBy("__bucket")))
        keep.append("__next_b")
    totals = totals.select(*keys, "__bucket", *keep)
    out = join_on(d, totals, [*keys, "__bucket"])
    for c in sum_cols:
        out = out.withColumn(f"{prefix}{c}", F.col(f"__off_{c}") + F.col(f"__l_{c}"))
    if following:
        after = F.coalesce(F.col("__lead"), F.col("__next_b"))
        out = out.withColumns({name: after.getField(name) for name in following}).drop("__lead", "__next_b")
    drop = ["__o", "__bucket", *[f"__l_{c}" for c in sum_cols], *[f"__off_{c}" for c in sum_cols]]
    if not by:
        drop.append("__g")
    return out.drop(*drop)


def ordered_row_number(df: DataFrame, order: Sequence[Column], by: Sequence[str] = (), out: str = "row_number",
                       parts: int | None = None) -> DataFrame:
    """``row_number() OVER (PARTITION BY by ORDER BY order)`` without a
    window over a whole group: rows are range-partitioned on (by, order), the
    part number is pinned with a reliable checkpoint, row numbers are taken
    per (group, part) and offset by the row counts of earlier parts (a table
    of at most ``parts`` rows per group). A hot group spans many parts, even
    when its rows are all equal on ``order`` (they are numbered in any order).
    """
    keys = list(by) or ["__g"]
    cols = df.columns
    d = df if by else df.withColumn("__g", F.lit(0))
    n = parts or parts_for(df)
    # a row id as last sort key makes every range key distinct, so even a run of
    # identical rows is split over parts; the checkpoint pins ids and parts
    d = d.withColumn("__id", F.monotonically_increasing_id())
    full = [*order, F.col("__id")]
    d = cut_lineage(d.repartitionByRange(n, *[F.col(k) for k in keys], *full)
                     .withColumn("__part", F.spark_partition_id()))
    d = d.withColumn("__local", F.row_number().over(Window.partitionBy(*keys, "__part").orderBy(*full)))
    w_off = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offs = (d.groupBy(*keys, "__part").agg(F.count(F.lit(1)).alias("__c"))
             .withColumn("__off", F.coalesce(F.sum("__c").over(w_off), F.lit(0)))
             .select(*keys, "__part", "__off"))
    return (join_on(d, offs, [*keys, "__part"])
             .select(*[F.col(c) for c in cols], (F.col("__off") + F.col("__local")).cast("long").alias(out)))
