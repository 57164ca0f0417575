"""Data-quality rules compiled into one pass.

``run_rules`` turns a list of ``Rule``s into a single ``agg`` over the table
(every rule contributes a couple of conditional sums), plus one
``groupBy(col)`` per uniqueness-style rule, which is the only kind that needs a
shuffle. The result is a long frame ``rule, kind, column, observed,
success``.

Null semantics follow the two styles of the original pipeline:
``nulls_fail=True`` is the gate style (a null value fails a membership or
range check, like pandas comparisons with NaN); ``nulls_fail=False`` is the
expectation-suite style (nulls are ignored by every rule but ``not_null``).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S

REPORT_COLUMNS = ["rule", "kind", "column", "observed", "success"]


@dataclass(frozen=True)
class Rule:
    kind: str
    column: str | None = None
    name: str | None = None
    args: dict = field(default_factory=dict)

    @property
    def label(self) -> str:
        return self.name or f"{self.kind}:{self.column or '*'}"


def rule(kind: str, column: str | None = None, name: str | None = None, **args) -> Rule:
    return Rule(kind, column, name, args)


def _fail_cond(r: Rule) -> Column:
    """Row-level 'unexpected' predicate for row-wise rule kinds (never null)."""
    c = F.col(r.column)
    nulls_fail = r.args.get("nulls_fail", False)
    if r.kind == "in_set":
        bad = ~c.isin(list(r.args["values"]))
    elif r.kind == "between":
        lo, hi = r.args.get("min"), r.args.get("max")
        parts = []
        if lo is not None:
            parts.append(c < F.lit(lo))
        if hi is not None:
            parts.append(c > F.lit(hi))
        bad = parts[0] if len(parts) == 1 else (parts[0] | parts[1])
    elif r.kind == "length_equal":
        bad = F.length(c) != F.lit(r.args["length"])
    else:
        raise ValueError(r.kind)
    # a null comparison is null: it fails only in the gate style
    return F.coalesce(bad, F.lit(bool(nulls_fail)))


def _cnt(cond: Column) -> Column:
    return F.sum(cond.cast("long"))


def run_rules(df: DataFrame, rules: Sequence[Rule], reference: DataFrame | None = None) -> DataFrame:
    """Evaluate all rules; return the long report (one row per rule)."""
    spark = df.sparkSession
    aggs: list[Column] = [F.count(F.lit(1)).alias("__n")]
    rows: list[tuple[Rule, Column, Column]] = []  # (rule, observed, success) over the agg row
    extra: list[DataFrame] = []
    n = F.col("__n")
    for i, r in enumerate(rules):
        k = f"__r{i}"
        if r.kind == "not_null":
            aggs.append(_cnt(F.col(r.column).isNull()).alias(k))
            mostly = r.args.get("mostly", 1.0)
            rows.append((r, F.col(k).cast("double"), F.coalesce(F.col(k) <= (1 - mostly) * n, F.lit(True))))
        elif r.kind in ("in_set", "between", "length_equal"):
            aggs.append(_cnt(_fail_cond(r)).alias(k))
            nulls_fail = r.args.get("nulls_fail", False)
            base = n if nulls_fail else F.col(f"{k}_nn")
            if not nulls_fail:
                aggs.append(F.count(F.col(r.column)).alias(f"{k}_nn"))
            mostly = r.args.get("mostly", 1.0)
            ok = (F.col(k) == 0) if mostly >= 1.0 else (F.col(k) <= F.lit(1 - mostly) * base)
            rows.append((r, F.col(k).cast("double"), F.coalesce(ok, F.lit(True))))
        elif r.kind == "mean_between":
            aggs.append(F.avg(F.col(r.column).cast("double")).alias(k))
            ok = (F.col(k) >= F.lit(r.args["min"])) & (F.col(k) <= F.lit(r.args["max"]))
            rows.append((r, F.round(F.col(k), 6), F.coalesce(ok, F.lit(False))))
        elif r.kind == "row_count":
            lo, hi = r.args.get("min"), r.args.get("max")
            ok = F.lit(True)
            if lo is not None:
                ok = ok & (n >= F.lit(lo))
            if hi is not None:
                ok = ok & (n <= F.lit(hi))
            rows.append((r, n.cast("double"), ok))
        elif r.kind == "rate":
            cond = F.coalesce(F.col(r.column) == F.lit(r.args["value"]), F.lit(False))
            aggs.append(F.avg(cond.cast("double")).alias(k))
            ok = (F.col(k) >= F.lit(r.args["min"])) & (F.col(k) <= F.lit(r.args["max"]))
            rows.append((r, F.round(F.col(k), 6), F.coalesce(ok, F.lit(False))))
        elif r.kind == "columns_match":
            ok = list(df.columns) == list(r.args["columns"])
            rows.append((r, F.lit(1.0 if ok else 0.0), F.lit(ok)))
        elif r.kind in ("unique", "unique_ratio"):
            extra.append(_unique_rows(df, r))
        elif r.kind == "kl":
            if reference is None:
                raise ValueError("kl rule needs a reference table")
            extra.append(_kl_rows(df, reference, r))
        else:
            raise ValueError(f"unknown rule kind {r.kind}")
    agg = df.agg(*aggs)
    report = None
    if rows:
        structs = [F.struct(F.lit(r.label).alias("rule"), F.lit(r.kind).alias("kind"),
                            F.lit(r.column).cast("string").alias("column"),
                            obs.cast("double").alias("observed"), ok.alias("success"))
                   for r, obs, ok in rows]
        report = agg.select(F.inline(F.array(*structs)))
    for e in extra:
        report = e if report is None else report.unionByName(e)
    if report is None:
        report = spark.createDataFrame([], "rule string, kind string, column string, observed double, success boolean")
    return report.select(*REPORT_COLUMNS)


def _unique_rows(df: DataFrame, r: Rule) -> DataFrame:
    """Uniqueness via ``groupBy(col).count()`` (spillable, partial-aggregated)."""
    c = r.column
    groups = df.groupBy(c).agg(F.count(F.lit(1)).alias("cnt"))
    stats = groups.agg(
        F.sum("cnt").alias("n"),
        F.sum(F.when(F.col(c).isNull(), F.col("cnt"))).alias("n_null"),
        F.count(F.col(c)).alias("n_distinct"),
        F.sum(F.when(F.col(c).isNotNull() & (F.col("cnt") > 1), F.col("cnt"))).alias("dup_rows"),
    )
    n_null = F.coalesce(F.col("n_null"), F.lit(0))
    if r.kind == "unique":
        dup = F.coalesce(F.col("dup_rows"), F.lit(0))
        if r.args.get("nulls_fail", False):
            # pandas form: nunique() == len(df) (a null breaks it)
            observed = F.coalesce(F.col("n"), F.lit(0)) - F.col("n_distinct")
        else:
            observed = dup
        ok = observed == 0
    else:
        nn = F.coalesce(F.col("n"), F.lit(0)) - n_null
        observed = F.round(F.try_divide(F.col("n_distinct").cast("double"), nn), 6)
        ok = F.coalesce((observed >= F.lit(r.args["min"])) & (observed <= F.lit(r.args["max"])), F.lit(False))
    return stats.select(F.lit(r.label).alias("rule"), F.lit(r.kind).alias("kind"), F.lit(c).alias("column"),
                        observed.cast("double").alias("observed"), ok.alias("success"))


def duplicate_values(df: DataFrame, col: str) -> DataFrame:
    """Q2 (expectation form): every repeated non-null value and its count."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
              .filter(F.col("n") > 1))


def bin_index(col: Column, edges: Sequence[float]) -> Column:
    """The left-closed bin ``[e_i, e_{i+1})`` of a value; out-of-range values
    go to the open tail bins ``-1`` and ``len(edges)-1``."""
    x = col.cast("double")
    b = F.when(x < F.lit(edges[0]), F.lit(-1))
    for i in range(1, len(edges)):
        b = b.when(x < F.lit(edges[i]), F.lit(i - 1))
    return b.otherwise(F.lit(len(edges) - 1))


def binned_shares(df: DataFrame, col: str, edges: Sequence[float]) -> DataFrame:
    """The bin (:func:`bin_index`) of every row with a value."""
    return df.filter(F.col(col).isNotNull()).select(bin_index(F.col(col), edges).alias("bin"))


def kl_divergence(current: DataFrame, reference: DataFrame, col: str, edges: Sequence[float]) -> DataFrame:
    """KL(reference || current) over shared bins: sum p * ln(p / q).

    Both sides are binned and counted in one ``groupBy(bin)`` over their union
    (at most ``len(edges)+1`` groups); a bin with p > 0 and q = 0 gives +inf.
    """
    both = (binned_shares(reference, col, edges).withColumn("ref", F.lit(1)).withColumn("cur", F.lit(0))
            .unionByName(binned_shares(current, col, edges).withColumn("ref", F.lit(0)).withColumn("cur", F.lit(1))))
    counts = both.groupBy("bin").agg(F.sum("ref").alias("n_ref"), F.sum("cur").alias("n_cur"))
    # one aggregate over the (at most len(edges)+1 row) bin table: with
    # sum(n_ref) = T_ref, sum p ln(p/q) = S / T_ref + ln(T_cur / T_ref) where
    # S = sum n_ref ln(n_ref / n_cur); a bin with p > 0 and q = 0 gives +inf
    n_ref, n_cur = F.col("n_ref"), F.col("n_cur")
    t_ref, t_cur = F.sum(n_ref), F.sum(n_cur)
    s = F.sum(F.when((n_ref > 0) & (n_cur > 0), n_ref * F.log(n_ref / n_cur)))
    unseen = F.bool_or((n_ref > 0) & (n_cur == 0))
    kl = (F.when(unseen, F.lit(float("inf")))
           .when(t_ref > 0, F.try_divide(s, t_ref) + F.log(t_cur / t_ref))
           .when(F.count(F.lit(1)) > 0, F.lit(0.0)))
    return counts.agg(F.round(kl, 6).alias("kl"))


def _kl_rows(df: DataFrame, reference: DataFrame, r: Rule) -> DataFrame:
    kl = kl_divergence(df, reference, r.column, r.args["edges"])
    ok = F.coalesce(F.col("kl") < F.lit(r.args["threshold"]), F.lit(False))
    return kl.select(F.lit(r.label).alias("rule"), F.lit("kl").alias("kind"), F.lit(r.column).alias("column"),
                     F.col("kl").alias("observed"), ok.alias("success"))


def null_profile(df: DataFrame) -> DataFrame:
    """Q14: null count of every column (one aggregate, then unpivot)."""
    wide = df.agg(*[F.sum(F.col(f"`{c}`").isNull().cast("long")).alias(c) for c in df.columns])
    return wide.unpivot([], df.columns, "column", "null_count")


def validation_summary(report: DataFrame) -> DataFrame:
    """Totals of a report: evaluated, passed, success rate, overall success."""
    return report.agg(
        F.count(F.lit(1)).alias("evaluated"),
        F.sum(F.col("success").cast("long")).alias("passed"),
        F.round(F.sum(F.col("success").cast("double")) / F.count(F.lit(1)), 6).alias("success_rate"),
        F.bool_and(F.coalesce(F.col("success"), F.lit(False))).alias("success"),
    )


class ValidationError(ValueError):
    pass


def failed_checks(report: DataFrame) -> list[str]:
    """Names of the failed checks (one small action: a row per rule)."""
    return [r["rule"] for r in report.filter(~F.coalesce(F.col("success"), F.lit(False))).select("rule").collect()]


def assert_valid(report: DataFrame) -> None:
    """Q13: raise with the names of the failed checks."""
    failed = failed_checks(report)
    if failed:
        raise ValidationError(f"Data validation FAILED. Failed checks: {failed}")


def gate(df: DataFrame, report: DataFrame, write, quarantine=None, write_on_fail: bool = False) -> bool:
    """Q13: the validation gate of a stage. ``write(df)`` runs when the report
    passes, or when ``write_on_fail`` is set. Otherwise the batch goes to
    ``quarantine(df)`` (when given), nothing is written to the stage's own
    output, and :class:`ValidationError` is raised. Returns whether it passed."""
    failed = failed_checks(report)
    if failed and not write_on_fail:
        if quarantine is not None:
            quarantine(df)
        raise ValidationError(f"Data validation FAILED. Failed checks: {failed}")
    write(df)
    return not failed


# -- the two rule sets of the churn configuration ------------------------------

def gate_rules(min_rows: int = S.ROW_COUNT_MIN) -> list[Rule]:
    """The 12 named checks of the validate stage (gate style: nulls fail)."""
    nf = dict(nulls_fail=True)
    return [
        rule("not_null", "customerID", "no_null_customerID"),
        rule("unique", "customerID", "unique_customerID", **nf),
        rule("in_set", "gender", "valid_gender", values=S.GENDER_VALUES, **nf),
        rule("in_set", "Churn", "valid_churn", values=S.YES_NO_VALUES, **nf),
        rule("between", "tenure", "valid_tenure", min=0, max=120, **nf),
        rule("between", "MonthlyCharges", "valid_monthly_charges", min=0, max=200, **nf),
        rule("between", "TotalCharges", "valid_total_charges", min=0, **nf),
        rule("in_set", "Contract", "valid_contract", values=S.CONTRACT_VALUES, **nf),
        rule("in_set", "InternetService", "valid_internet", values=S.INTERNET_VALUES, **nf),
        rule("in_set", "PaymentMethod", "valid_payment", values=S.PAYMENT_VALUES, **nf),
        rule("row_count", None, "row_count_ok", min=min_rows),
        rule("rate", "Churn", "churn_rate_reasonable", value="Yes",
             min=S.CHURN_RATE_BOUNDS[0], max=S.CHURN_RATE_BOUNDS[1]),
    ]


def suite_rules(tenure_edges: Sequence[float] | None = None, kl_threshold: float | None = None,
                min_rows: int | None = S.ROW_COUNT_MIN, max_rows: int | None = S.ROW_COUNT_MAX) -> list[Rule]:
    """The expectation suite (nulls ignored except by ``not_null``). The row
    count bounds are those of the original's file; pass others (or None for
    no bound) for a larger table."""
    rs = [
        rule("columns_match", None, "columns_match", columns=S.RAW_COLUMNS),
        rule("row_count", None, "row_count_between", min=min_rows, max=max_rows),
        rule("not_null", "customerID"), rule("unique", "customerID"),
        rule("length_equal", "customerID", length=10),
        rule("not_null", "gender"), rule("in_set", "gender", values=S.GENDER_VALUES),
        rule("not_null", "SeniorCitizen"), rule("in_set", "SeniorCitizen", values=[0, 1]),
    ]
    for c in ("Partner", "Dependents", "PhoneService", "PaperlessBilling"):
        rs += [rule("not_null", c), rule("in_set", c, values=S.YES_NO_VALUES)]
    rs += [
        rule("not_null", "tenure"), rule("between", "tenure", min=0, max=120),
        rule("mean_between", "tenure", min=S.TENURE_MEAN_BOUNDS[0], max=S.TENURE_MEAN_BOUNDS[1]),
        rule("not_null", "MonthlyCharges"), rule("between", "MonthlyCharges", min=0, max=200),
        rule("mean_between", "MonthlyCharges", min=S.MONTHLY_MEAN_BOUNDS[0], max=S.MONTHLY_MEAN_BOUNDS[1]),
        rule("between", "TotalCharges", min=0, max=10000, mostly=0.99),
        rule("not_null", "InternetService"), rule("in_set", "InternetService", values=S.INTERNET_VALUES),
        rule("not_null", "Contract"), rule("in_set", "Contract", values=S.CONTRACT_VALUES),
        rule("not_null", "PaymentMethod"), rule("in_set", "PaymentMethod", values=S.PAYMENT_VALUES),
        rule("in_set", "MultipleLines", values=S.MULTIPLE_LINES_VALUES),
        rule("not_null", "Churn"), rule("in_set", "Churn", values=S.YES_NO_VALUES),
        rule("unique_ratio", "Churn", min=0.0, max=0.5),
    ]
    if tenure_edges is not None:
        rs.append(rule("kl", "tenure", edges=list(tenure_edges), threshold=kl_threshold))
    return rs
