"""Queries for the data-quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import check_states as CS
from ..operators import clean as P
from ..operators import quality as Q
from ..session import scratch_path
from . import inputs as I
from .catalog import query
from .oracle_sql import with_views

TENURE_EDGES = [0, 6, 12, 24, 36, 48, 60, 73]
KL_THRESHOLD = 0.1


# -- independent SQL for a rule list ---------------------------------------------

def _lit(v) -> str:
    return f"'{v}'" if isinstance(v, str) else repr(v)


def _rule_sql(table: str, r: Q.Rule, columns: list[str] | None = None) -> str:
    head = f"SELECT '{r.label}' AS rule, '{r.kind}' AS kind, {_lit(r.column) if r.column else 'CAST(NULL AS VARCHAR)'} AS \"column\", "
    c = r.column
    nf = r.args.get("nulls_fail", False)
    if r.kind == "not_null":
        return head + f"CAST(count(*) - count({c}) AS DOUBLE) AS observed, count(*) - count({c}) = 0 AS success FROM {table}"
    if r.kind in ("in_set", "between", "length_equal"):
        if r.kind == "in_set":
            bad = f"NOT ({c} IN ({', '.join(_lit(v) for v in r.args['values'])}))"
        elif r.kind == "length_equal":
            bad = f"length({c}) <> {r.args['length']}"
        else:
            parts = []
            if r.args.get("min") is not None:
                parts.append(f"{c} < {r.args['min']}")
            if r.args.get("max") is not None:
                parts.append(f"{c} > {r.args['max']}")
            bad = " OR ".join(parts)
        cnt = f"sum(CASE WHEN coalesce({bad}, {'true' if nf else 'false'}) THEN 1 ELSE 0 END)"
        mostly = r.args.get("mostly", 1.0)
        base = "count(*)" if nf else f"count({c})"
        ok = f"coalesce({cnt}, 0) = 0" if mostly >= 1.0 else f"coalesce({cnt} <= {1 - mostly!r} * {base}, true)"
        return head + f"CAST(coalesce({cnt}, 0) AS DOUBLE) AS observed, {ok} AS success FROM {table}"
    if r.kind == "mean_between":
        m = f"avg(CAST({c} AS DOUBLE))"
        return head + (f"round({m}, 6) AS observed, coalesce({m} >= {r.args['min']} AND {m} <= {r.args['max']}, false) "
                       f"AS success FROM {table}")
    if r.kind == "row_count":
        cond = []
        if r.args.get("min") is not None:
            cond.append(f"count(*) >= {r.args['min']}")
        if r.args.get("max") is not None:
            cond.append(f"count(*) <= {r.args['max']}")
        return head + f"CAST(count(*) AS DOUBLE) AS observed, {' AND '.join(cond) or 'true'} AS success FROM {table}"
    if r.kind == "rate":
        m = f"avg(CASE WHEN coalesce({c} = {_lit(r.args['value'])}, false) THEN 1.0 ELSE 0.0 END)"
        return head + (f"round({m}, 6) AS observed, coalesce({m} >= {r.args['min']} AND {m} <= {r.args['max']}, false) "
                       f"AS success FROM {table}")
    if r.kind == "columns_match":
        ok = columns == list(r.args["columns"])
        return head + f"{1.0 if ok else 0.0} AS observed, {str(ok).lower()} AS success"
    if r.kind == "unique":
        if nf:
            obs = f"count(*) - count(DISTINCT {c})"
        else:
            obs = f"coalesce((SELECT sum(n) FROM (SELECT count(*) AS n FROM {table} WHERE {c} IS NOT NULL GROUP BY {c}) WHERE n > 1), 0)"
        src = f" FROM {table}" if nf else ""
        return head + f"CAST({obs} AS DOUBLE) AS observed, {obs} = 0 AS success{src}"
    if r.kind == "unique_ratio":
        obs = f"round(count(DISTINCT {c}) / count({c}), 6)"
        return head + f"{obs} AS observed, coalesce({obs} >= {r.args['min']} AND {obs} <= {r.args['max']}, false) AS success FROM {table}"
    raise ValueError(r.kind)


def rules_sql(table: str, rules, columns=None) -> str:
    return "\nUNION ALL\n".join(_rule_sql(table, r, columns) for r in rules)


def _kl_sql(cur: str, ref: str, col: str, edges, threshold, label: str) -> str:
    b = f"CASE WHEN {col} < {edges[0]} THEN -1 " + " ".join(
        f"WHEN {col} < {edges[i]} THEN {i - 1}" for i in range(1, len(edges))) + f" ELSE {len(edges) - 1} END"
    return f"""
SELECT '{label}' AS rule, 'kl' AS kind, '{col}' AS "column", kl AS observed, coalesce(kl < {threshold}, false) AS success FROM (
  SELECT round(sum(CASE WHEN n_ref = 0 THEN 0.0 WHEN n_cur = 0 THEN 'inf'::DOUBLE
                   ELSE (n_ref / t_ref) * ln((n_ref / t_ref) / (n_cur / t_cur)) END), 6) AS kl
  FROM (SELECT bin, sum(r) AS n_ref, sum(c) AS n_cur, sum(sum(r)) OVER () AS t_ref, sum(sum(c)) OVER () AS t_cur
        FROM (SELECT {b} AS bin, 1 AS r, 0 AS c FROM {ref} WHERE {col} IS NOT NULL
              UNION ALL SELECT {b} AS bin, 0 AS r, 1 AS c FROM {cur} WHERE {col} IS NOT NULL) GROUP BY bin))"""


# the two cohorts that the KL rule compares, whole
KL_REF_SQL = "(SELECT * FROM customer_clean WHERE SeniorCitizen = 0)"
KL_CUR_SQL = "(SELECT * FROM customer_clean WHERE SeniorCitizen = 1)"


def _report(df, rules, reference=None):
    return Q.run_rules(df, rules, reference)


_NOT_NULL = [Q.rule("not_null", c) for c in ("customerID", "gender", "tenure", "MonthlyCharges", "Churn")]
_UNIQUE = [Q.rule("unique", "customerID", "unique_customerID", nulls_fail=True), Q.rule("unique", "customerID")]
_IN_SET = [r for r in Q.suite_rules() if r.kind == "in_set"] + [r for r in Q.gate_rules() if r.kind == "in_set"]
_BETWEEN = [r for r in Q.suite_rules() if r.kind == "between"] + [r for r in Q.gate_rules() if r.kind == "between"]
_MEAN = [r for r in Q.suite_rules() if r.kind == "mean_between"]
_LENGTH = [r for r in Q.suite_rules() if r.kind == "length_equal"]
_ROWS = [Q.rule("row_count", None, "row_count_ok", min=S.ROW_COUNT_MIN),
         Q.rule("row_count", None, "row_count_between", min=S.ROW_COUNT_MIN, max=S.ROW_COUNT_MAX)]
_COLUMNS = [Q.rule("columns_match", None, "columns_match", columns=S.RAW_COLUMNS)]
_RATIO = [Q.rule("unique_ratio", "Churn", min=0.0, max=0.5), Q.rule("unique_ratio", "tenure", min=0.0, max=0.5)]
_RATE = [r for r in Q.gate_rules() if r.kind == "rate"]


def _clean_sql(rules) -> str:
    return with_views(rules_sql("customer_clean", rules, S.RAW_COLUMNS), "customer_clean")


@query("check_not_null", "Q1", _clean_sql(_NOT_NULL))
def q_not_null(spark, sf):
    return _report(I.cleaned(spark, sf), _NOT_NULL)


@query("check_unique", "Q2", with_views(
    rules_sql("customer_clean", _UNIQUE) + "\nUNION ALL\n"
    + rules_sql("predictions", [Q.rule("unique", "customerID", "unique_prediction_customer")]),
    "customer_clean", "predictions"))
def q_unique(spark, sf):
    a = _report(I.cleaned(spark, sf), _UNIQUE)
    b = _report(I.predictions(spark, sf), [Q.rule("unique", "customerID", "unique_prediction_customer")])
    return a.unionByName(b)


@query("unique_offenders", "Q2", with_views(
    "SELECT customerID, count(*) AS n FROM predictions WHERE customerID IS NOT NULL GROUP BY customerID "
    "HAVING count(*) > 1", "predictions"))
def q_offenders(spark, sf):
    return Q.duplicate_values(I.predictions(spark, sf), "customerID")


@query("check_in_set", "Q3", _clean_sql(_IN_SET))
def q_in_set(spark, sf):
    return _report(I.cleaned(spark, sf), _IN_SET)


@query("check_between", "Q4", _clean_sql(_BETWEEN))
def q_between(spark, sf):
    return _report(I.cleaned(spark, sf), _BETWEEN)


@query("check_mean_between", "Q5", _clean_sql(_MEAN))
def q_mean(spark, sf):
    return _report(I.cleaned(spark, sf), _MEAN)


@query("check_length", "Q6", _clean_sql(_LENGTH))
def q_length(spark, sf):
    return _report(I.cleaned(spark, sf), _LENGTH)


@query("check_row_count", "Q7", _clean_sql(_ROWS))
def q_rows(spark, sf):
    return _report(I.cleaned(spark, sf), _ROWS)


@query("check_columns", "Q8", _clean_sql(_COLUMNS))
def q_columns(spark, sf):
    return _report(I.cleaned(spark, sf), _COLUMNS)


@query("check_unique_ratio", "Q9", _clean_sql(_RATIO))
def q_ratio(spark, sf):
    return _report(I.cleaned(spark, sf), _RATIO)


@query("check_rate", "Q10", _clean_sql(_RATE))
def q_rate(spark, sf):
    return _report(I.cleaned(spark, sf), _RATE)


_KL = [Q.rule("kl", "tenure", edges=TENURE_EDGES, threshold=KL_THRESHOLD)]


def _kl_report(clean):
    return Q.run_rules(clean.filter("SeniorCitizen = 1"), _KL, reference=clean.filter("SeniorCitizen = 0"))


@query("check_kl", "Q11", with_views(
    _kl_sql(KL_CUR_SQL, KL_REF_SQL, "tenure", TENURE_EDGES, KL_THRESHOLD, "kl:tenure"),
    "customer_clean"))
def q_kl(spark, sf):
    return _kl_report(I.cleaned(spark, sf))


@query("validation_report", "Q12", _clean_sql(Q.gate_rules()))
def q_report(spark, sf):
    return _report(I.cleaned(spark, sf), Q.gate_rules())


_SUITE = Q.suite_rules()


@query("validation_suite", "Q12", with_views(
    rules_sql("customer_clean", _SUITE, S.RAW_COLUMNS) + "\nUNION ALL\n"
    + _kl_sql(KL_CUR_SQL, KL_REF_SQL, "tenure", TENURE_EDGES, KL_THRESHOLD, "kl:tenure"),
    "customer_clean"))
def q_suite(spark, sf):
    whole = I.cleaned(spark, sf)
    return Q.run_rules(whole, Q.suite_rules()).unionByName(_kl_report(whole))


# the rules whose states merge exactly; the runs are the contracts, so one is far larger than the others
_MERGED = [r for r in _SUITE if r.kind not in ("unique", "unique_ratio")] + [r for r in Q.gate_rules() if r.kind != "unique"]


@query("validation_merged", "Q12", with_views(
    rules_sql("customer_clean", _MERGED, S.RAW_COLUMNS) + "\nUNION ALL\n"
    + _kl_sql(KL_CUR_SQL, KL_REF_SQL, "tenure", TENURE_EDGES, KL_THRESHOLD, "kl:tenure"), "customer_clean"))
def q_merged(spark, sf):
    """Each run appends its states; the report over all runs reads only them."""
    clean = I.cleaned(spark, sf)
    folder, cohorts = scratch_path(spark, "check-states"), scratch_path(spark, "cohort-states")
    for churn in ("Yes", "No"):   # two appends, each of several runs
        run = clean.filter(F.col("Churn").eqNullSafe(churn) if churn == "Yes" else ~F.col("Churn").eqNullSafe("Yes"))
        CS.check_states(run.withColumn("run", F.col("Contract")), _MERGED, "run").write.mode("append").parquet(folder)
    CS.check_states(clean.withColumn("senior", F.col("SeniorCitizen")), _KL, "senior").write.parquet(cohorts)
    states, cohort = spark.read.parquet(folder), spark.read.parquet(cohorts)
    kl = CS.report_from_states(cohort.filter("senior = 1"), _KL, reference=cohort.filter("senior = 0"))
    return CS.report_from_states(states, _MERGED).unionByName(kl).drop("error")


@query("validation_summary", "Q12", with_views(
    "SELECT count(*) AS evaluated, CAST(sum(CAST(success AS INT)) AS BIGINT) AS passed, "
    "round(sum(CAST(success AS DOUBLE)) / count(*), 6) AS success_rate, bool_and(success) AS success FROM ("
    + rules_sql("customer_clean", Q.gate_rules()) + ")", "customer_clean"))
def q_summary(spark, sf):
    return Q.validation_summary(_report(I.cleaned(spark, sf), Q.gate_rules()))


@query("validation_gate", "Q13", with_views(
    "SELECT * REPLACE (CAST(SeniorCitizen AS TINYINT) AS SeniorCitizen) FROM customer_clean", "customer_clean"))
def q_gate(spark, sf):
    df = P.cast_narrow(I.cleaned(spark, sf), ["SeniorCitizen"])
    Q.assert_valid(Q.run_rules(df, Q.gate_rules()))
    return df


@query("null_profile", "Q14", with_views(
    "UNPIVOT (SELECT " + ", ".join(f"CAST(count(*) - count({c}) AS BIGINT) AS {c}" for c in S.RAW_COLUMNS)
    + " FROM (SELECT * REPLACE (TRY_CAST(regexp_replace(TotalCharges, '^\\s+|\\s+$', '', 'g') AS DOUBLE) "
      "AS TotalCharges) FROM customer_raw)) ON COLUMNS(*) INTO NAME \"column\" VALUE null_count", "customer_raw"))
def q_nulls(spark, sf):
    df = P.coerce_numeric(P.trim_strings(I.raw(spark, sf)), ["TotalCharges"])
    return Q.null_profile(df)
