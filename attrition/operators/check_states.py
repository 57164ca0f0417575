"""Mergeable states of the quality rules (Q1-Q12).

A run's rows are read once, when they arrive: :func:`check_states` reduces
them to one row per run and rule (counts, a sum, bin counts, a sketch of
distinct values). The states are kept as a table beside the data. A report
over any set of runs (:func:`report_from_states`) adds states up and never
reads the rows again; :func:`merge_check_states` folds old runs into fewer rows.

Every rule but uniqueness merges exactly: the report equals the one that
:func:`quality.run_rules` gives over all rows. Whether a value of one run is
found in another cannot be told from counts, so ``unique`` and ``unique_ratio``
use a HyperLogLog sketch. Their rows state an ``error``: three relative
standard errors of the sketch, in the unit of ``observed``. A ``unique`` rule
passes unless the sketch shows repeats beyond that error, so a pass means
"no more than ``error`` repeats"; the exact answer needs the rows
(:func:`quality.run_rules`).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quality import Rule, _cnt, _fail_cond, bin_index

#: log2 of a sketch's registers: 16,384 of them, a relative standard error of 0.8 %.
LG_K = 14


def _state(df: DataFrame, r: Rule, lg_k: int) -> dict[str, Column]:
    """What one rule keeps of a group of rows: ``base`` the rows it judges, ``bad`` those
    that break it (for a rate: those that count), ``total`` the sum of the values."""
    rows = F.count(F.lit(1))
    if r.kind == "row_count":
        return {"base": rows}
    if r.kind == "columns_match":
        return {"base": rows, "bad": F.lit(0 if list(df.columns) == list(r.args["columns"]) else 1)}
    c = F.col(r.column)
    given = F.count(c)
    if r.kind == "not_null":
        return {"base": rows, "bad": rows - given}
    if r.kind in ("in_set", "between", "length_equal"):
        return {"base": rows if r.args.get("nulls_fail", False) else given, "bad": _cnt(_fail_cond(r))}
    if r.kind == "mean_between":
        return {"base": F.count(c.cast("double")), "total": F.sum(c.cast("double"))}
    if r.kind == "rate":
        return {"base": rows, "bad": _cnt(F.coalesce(c == F.lit(r.args["value"]), F.lit(False)))}
    if r.kind in ("unique", "unique_ratio"):
        return {"base": given, "sketch": F.hll_sketch_agg(c.cast("string"), lg_k)}
    if r.kind == "kl":
        b = F.when(c.isNotNull(), bin_index(c, r.args["edges"]))
        return {"base": given, "bins": F.array(*[_cnt(F.coalesce(b == i, F.lit(False)))
                                                 for i in range(-1, len(r.args["edges"]))])}
    raise ValueError(f"unknown rule kind {r.kind}")


def check_states(df: DataFrame, rules: Sequence[Rule], by: str | None = None, lg_k: int = LG_K) -> DataFrame:
    """One state row per rule and run ``by`` (without it: of all rows).

    One aggregate for all rules: partial, so a hot run is one row per task
    in the shuffle. Without ``by``, an empty table still gives its states
    (0 rows). Labels of the rules must differ: they name the states.
    """
    labels = [r.label for r in rules]
    if len(set(labels)) != len(labels):
        raise ValueError("two rules have the same label")
    types = {"base": "long", "bad": "long", "total": "double", "bins": "array<long>", "sketch": "binary"}
    body = df.drop(by) if by and not any(r.column == by for r in rules) else df
    kept = [_state(body, r, lg_k) for r in rules]
    aggs = [expr.alias(f"__s{i}_{name}") for i, state in enumerate(kept) for name, expr in state.items()]
    wide = df.groupBy(*([by] if by else [])).agg(F.count(F.lit(1)).alias("__rows"), *aggs)
    structs = [F.struct(F.lit(r.label).alias("rule"), F.lit(r.kind).alias("kind"), F.lit(r.column).cast("string").alias("column"),
                        F.col("__rows").alias("rows"),
                        *[(F.col(f"__s{i}_{n}") if n in state else F.lit(None)).cast(t).alias(n) for n, t in types.items()])
               for i, (r, state) in enumerate(zip(rules, kept))]
    return wide.select(*([by] if by else []), F.inline(F.array(*structs)))


def merge_check_states(states: DataFrame, rules: Sequence[Rule], by: str | None = None) -> DataFrame:
    """The states of each rule added up, over all runs or by another key ``by`` (a day, a source).

    One partial aggregate over rows of states; bin counts are added place by place.
    """
    places = max((len(r.args["edges"]) + 1 for r in rules if r.kind == "kl"), default=0)
    add = [F.sum(c).alias(c) for c in ("rows", "base", "bad", "total")]
    bins = F.filter(F.array(*[F.sum(F.get("bins", F.lit(i))) for i in range(places)]).cast("array<long>"), lambda n: n.isNotNull())
    return (states.filter(F.col("rule").isin([r.label for r in rules]))
                  .groupBy(*([by] if by else []), "rule", "kind", "column")
                  .agg(*add, F.when(F.count("bins") > 0, bins).alias("bins"),
                       F.when(F.count("sketch") > 0, F.hll_union_agg("sketch")).alias("sketch")))


def report_from_states(states: DataFrame, rules: Sequence[Rule], by: str | None = None,
                       reference: DataFrame | None = None, lg_k: int = LG_K) -> DataFrame:
    """The long report over all the states, or one per ``by``: the columns of
    :func:`quality.run_rules` and ``error`` (null where the answer is exact).

    Reads states only. ``reference`` gives the states of the reference rows of
    ``kl`` rules. ``rules`` may have other bounds than when the states were
    taken; a rule without a state gives no row, and the sets, ranges, lengths
    and edges that decide a row are those of the states.
    """
    m = merge_check_states(states, rules, by)
    if reference is not None:
        ref = merge_check_states(reference, rules).select("rule", F.col("bins").alias("ref_bins"))
        m = m.join(ref, "rule", "left")
    elif any(r.kind == "kl" for r in rules):
        raise ValueError("kl rule needs the states of a reference table")
    else:
        m = m.withColumn("ref_bins", F.lit(None).cast("array<long>"))
    rse = 1.04 / (2 ** lg_k) ** 0.5
    observed = success = error = None
    for r in rules:
        mine, (obs, ok, err) = F.col("rule") == r.label, _verdict(r, rse)
        put = lambda chain, v: F.when(mine, v) if chain is None else chain.when(mine, v)  # noqa: E731, B023
        observed, success, error = put(observed, obs.cast("double")), put(success, ok), put(error, err.cast("double"))
    return m.select(*([by] if by else []), "rule", "kind", "column", observed.alias("observed"), success.alias("success"),
                    error.alias("error"))


def _verdict(r: Rule, rse: float) -> tuple[Column, Column, Column]:
    """(observed, success, error) of a rule over its merged state."""
    n, base = F.col("rows"), F.col("base")
    bad, exact = F.coalesce(F.col("bad"), F.lit(0)), F.lit(None).cast("double")

    def within(v: Column, otherwise: bool = False) -> Column:
        ok = F.lit(True)
        if r.args.get("min") is not None:
            ok = ok & (v >= F.lit(r.args["min"]))
        if r.args.get("max") is not None:
            ok = ok & (v <= F.lit(r.args["max"]))
        return F.coalesce(ok, F.lit(otherwise))

    if r.kind == "row_count":
        return n, within(n), exact
    if r.kind == "columns_match":
        return F.when(bad == 0, 1.0).otherwise(0.0), bad == 0, exact
    if r.kind in ("not_null", "in_set", "between", "length_equal"):
        mostly = r.args.get("mostly", 1.0)
        return bad, (bad == 0) if mostly >= 1.0 else (bad <= F.lit(1 - mostly) * base), exact
    if r.kind in ("mean_between", "rate"):
        v = F.try_divide(F.col("total") if r.kind == "mean_between" else bad.cast("double"), base)
        return F.round(v, 6), within(v), exact
    if r.kind == "kl":
        return _kl_verdict(r)
    distinct = F.least(F.coalesce(F.hll_sketch_estimate("sketch"), F.lit(0)), base).cast("double")
    if r.kind == "unique_ratio":
        v = F.try_divide(distinct, base)
        return F.round(v, 6), within(F.round(v, 6)), F.round(3 * rse * v, 6)
    spread = F.ceil(3 * rse * distinct)
    surplus = base - distinct
    if r.args.get("nulls_fail", False):   # a null breaks it, and that is known exactly
        return n - distinct, (n == base) & (surplus <= spread), spread
    return surplus, surplus <= spread, spread


def _kl_verdict(r: Rule) -> tuple[Column, Column, Column]:
    """KL(reference || current) from two arrays of bin counts, as :func:`quality.kl_divergence` has it."""
    cur, ref = F.col("bins"), F.col("ref_bins")
    add = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + x)
    t_cur, t_ref = add(cur), add(ref)
    terms = F.zip_with(ref, cur, lambda p, q: F.when(p == 0, F.lit(0.0)).when(q == 0, F.lit(float("inf")))
                       .otherwise(p * F.log(p / q)))
    s = F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)
    kl = (F.when(t_ref + t_cur == 0, F.lit(None).cast("double")).when(t_ref == 0, F.lit(0.0))
           .when(F.isnotnull(s) & (s == float("inf")), F.lit(float("inf"))).otherwise(F.try_divide(s, t_ref) + F.log(t_cur / t_ref)))
    kl = F.round(kl, 6)
    return kl, F.coalesce(kl < F.lit(r.args["threshold"]), F.lit(False)), F.lit(None).cast("double")
