"""Queries for drift statistics and the retrain rule."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import drift as D
from ..sources import sinks as K
from . import inputs as I
from .catalog import query
from .oracle_sql import with_views

LINE_NUMERIC = ["quantity", "extendedprice", "discount"]
LINE_CATEGORICAL = ["returnflag", "linestatus"]
REF_LINES = "(SELECT * FROM drift_lines WHERE side = 'reference')"
CUR_LINES = "(SELECT * FROM drift_lines WHERE side = 'current')"
# two whole cohorts of the feature table
REF_FEATURES = "(SELECT * FROM customer_features WHERE SeniorCitizen = 0)"
CUR_FEATURES = "(SELECT * FROM customer_features WHERE SeniorCitizen = 1)"


SPLIT_DATE = "1998-06-01"


def _lines(spark, sf):
    """Reference / current samples; the split is stated on the raw ship date
    (same rows as the view's ``side``) so it is pushed to the Parquet scan."""
    d = I.drift_lines(spark, sf)
    cut = F.lit(SPLIT_DATE).cast(d.schema["ship_date"].dataType)
    ref = d.filter(F.col("ship_date") < cut)
    cur = d.filter((F.col("ship_date") >= cut) | F.col("ship_date").isNull())
    return ref.drop("side", "ship_date"), cur.drop("side", "ship_date")


def _features_pair(spark, sf):
    all_ = I.features(spark, sf)
    return all_.filter("SeniorCitizen = 0"), all_.filter("SeniorCitizen = 1")


# -- independent SQL -----------------------------------------------------------

def _long_sql(ref: str, cur: str, cols, dtype: str) -> str:
    parts = []
    for c in cols:
        for src, flag in ((ref, 1), (cur, 0)):
            parts.append(f"SELECT '{c}' AS \"column\", CAST({c} AS {dtype}) AS value, {flag} AS is_ref FROM {src}")
    return "(" + " UNION ALL ".join(parts) + ")"


def numeric_sql(ref: str, cur: str, cols) -> str:
    return f""", lng AS (SELECT * FROM {_long_sql(ref, cur, cols, 'DOUBLE')} WHERE value IS NOT NULL),
c AS (SELECT "column", value, sum(is_ref) AS n_ref, sum(1 - is_ref) AS n_cur FROM lng GROUP BY 1, 2),
t AS (SELECT "column", sum(n_ref) AS tot_ref, sum(n_cur) AS tot_cur FROM c GROUP BY 1),
cu AS (SELECT c."column", c.value, t.tot_ref, t.tot_cur,
         abs(sum(c.n_ref) OVER w / t.tot_ref - sum(c.n_cur) OVER w / t.tot_cur) AS gap,
         lead(c.value) OVER (PARTITION BY c."column" ORDER BY c.value) AS next_value
       FROM c JOIN t ON c."column" = t."column"
       WINDOW w AS (PARTITION BY c."column" ORDER BY c.value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
ks AS (SELECT "column", CAST(max(tot_ref) AS BIGINT) AS n_ref, CAST(max(tot_cur) AS BIGINT) AS n_cur,
         max(gap) AS ks_stat, sum(gap * coalesce(next_value - value, 0.0)) AS wass FROM cu GROUP BY 1),
rs AS (SELECT "column", stddev_pop(value) AS sd, min(value) AS mn, max(value) AS mx FROM lng WHERE is_ref = 1 GROUP BY 1),
pb AS (SELECT l."column", CASE WHEN rs.mx > rs.mn THEN least(greatest(floor((l.value - rs.mn) / (rs.mx - rs.mn) * 10), 0), 9)
              ELSE 0 END AS bin, sum(is_ref) AS nr, sum(1 - is_ref) AS nc
       FROM lng l JOIN rs ON l."column" = rs."column" GROUP BY 1, 2),
psi AS (SELECT pb."column", sum((CASE WHEN nc = 0 THEN {D.PSI_EPS} ELSE nc / tot_cur END - CASE WHEN nr = 0 THEN {D.PSI_EPS} ELSE nr / tot_ref END)
          * ln(CASE WHEN nc = 0 THEN {D.PSI_EPS} ELSE nc / tot_cur END / CASE WHEN nr = 0 THEN {D.PSI_EPS} ELSE nr / tot_ref END)) AS psi
        FROM pb JOIN t ON pb."column" = t."column" GROUP BY 1),
st AS (SELECT ks.*, rs.sd, psi.psi,
         (sqrt(CAST(n_ref AS DOUBLE) * n_cur / (n_ref + n_cur)) + 0.12 + 0.11 / sqrt(CAST(n_ref AS DOUBLE) * n_cur / (n_ref + n_cur))) * ks_stat AS lam
       FROM ks JOIN rs ON ks."column" = rs."column" JOIN psi ON ks."column" = psi."column"),
fin AS (SELECT "column", n_ref, n_cur, round(ks_stat, 6) AS ks_stat,
         round(CASE WHEN lam < 0.2 THEN 1.0 ELSE greatest(least(2.0 * list_sum(list_transform(range(1, 101),
               lambda j: pow(-1.0, j - 1) * exp(-2.0 * j * j * lam * lam))), 1.0), 0.0) END, 6) AS ks_pvalue,
         round(wass, 6) AS wasserstein, round(CASE WHEN sd > 0 THEN wass / sd END, 6) AS wasserstein_norm,
         round(psi, 6) AS psi FROM st)
SELECT *, 'wasserstein' AS stat_test, wasserstein_norm AS statistic,
       coalesce(wasserstein_norm >= {D.DISTANCE_THRESHOLD}, false) AS drifted FROM fin"""


def categorical_sql(ref: str, cur: str, cols) -> str:
    return f""", lng AS (SELECT * FROM {_long_sql(ref, cur, cols, 'VARCHAR')} WHERE value IS NOT NULL),
c AS (SELECT "column", value, sum(is_ref) AS nr, sum(1 - is_ref) AS nc FROM lng GROUP BY 1, 2),
t AS (SELECT "column", sum(nr) AS N_ref, sum(nc) AS N_cur FROM c GROUP BY 1),
x AS (SELECT c.*, t.N_ref, t.N_cur, nr / t.N_ref AS p, nc / t.N_cur AS q FROM c JOIN t ON c."column" = t."column"),
st AS (SELECT "column", CAST(max(N_ref) AS BIGINT) AS n_ref, CAST(max(N_cur) AS BIGINT) AS n_cur,
         CAST(sum(CASE WHEN nr > 0 THEN 1 ELSE 0 END) - 1 AS INTEGER) AS dof,
         bool_or(nr = 0 AND nc > 0) AS unseen,
         sum(CASE WHEN nr > 0 THEN (nc - p * N_cur) * (nc - p * N_cur) / (p * N_cur) END) AS chi2_raw,
         sum(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) END) AS kl_pm,
         sum(CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) END) AS kl_qm,
         sum((CASE WHEN nc = 0 THEN {D.PSI_EPS} ELSE q END - CASE WHEN nr = 0 THEN {D.PSI_EPS} ELSE p END)
             * ln(CASE WHEN nc = 0 THEN {D.PSI_EPS} ELSE q END / CASE WHEN nr = 0 THEN {D.PSI_EPS} ELSE p END)) AS psi_raw
       FROM x GROUP BY 1),
fin AS (SELECT "column", n_ref, n_cur,
         round(CASE WHEN unseen THEN 'inf'::DOUBLE ELSE coalesce(chi2_raw, 0.0) END, 6) AS chi2, dof,
         round(sqrt(greatest(0.0, 0.5 * coalesce(kl_pm, 0.0) + 0.5 * coalesce(kl_qm, 0.0))), 6) AS js_distance,
         round(psi_raw, 6) AS psi FROM st)
SELECT "column", n_ref, n_cur, chi2, dof,
       -- survival function of the chi-square distribution, term by term through log-gamma
       round(CASE WHEN dof <= 0 OR chi2 <= 0 THEN 1.0 WHEN chi2 > dof + 40 * sqrt(dof / 2.0) + 400 THEN 0.0
             ELSE greatest(0.0, least(1.0, 1 - list_sum(list_transform(range(0, CAST(chi2 / 2 + 12 * sqrt(chi2 / 2) + 80 AS BIGINT)),
                  lambda n: exp((dof / 2.0 + n) * ln(chi2 / 2) - chi2 / 2 - lgamma(dof / 2.0 + n + 1)))))) END, 6) AS chi2_pvalue,
       js_distance, psi, 'jensenshannon' AS stat_test, js_distance AS statistic,
       coalesce(js_distance >= {D.DISTANCE_THRESHOLD}, false) AS drifted FROM fin"""


def summary_cte(ref: str, cur: str, num_cols, cat_cols) -> str:
    num = numeric_sql(ref, cur, num_cols).lstrip(", ").replace("\n", "\n  ")
    cat = categorical_sql(ref, cur, cat_cols).lstrip(", ").replace("\n", "\n  ")
    return f""", dn AS (WITH {num}),
dc AS (WITH {cat}),
u AS (SELECT "column", drifted FROM dn UNION ALL SELECT "column", drifted FROM dc),
summ AS (SELECT CAST(sum(CAST(drifted AS INT)) AS BIGINT) AS drifted_features, count(*) AS total_features,
       round(sum(CAST(drifted AS INT)) / count(*), 6) AS drift_score,
       round(sum(CAST(drifted AS INT)) / count(*), 6) >= {S.DRIFT_THRESHOLD} AS drift_detected,
       {S.DRIFT_THRESHOLD} AS drift_threshold,
       (SELECT count(*) FROM {ref}) AS reference_rows, (SELECT count(*) FROM {cur}) AS current_rows FROM u)
"""


_SUMM = summary_cte(REF_LINES, CUR_LINES, LINE_NUMERIC, LINE_CATEGORICAL)


def _summary(spark, sf):
    ref, cur = _lines(spark, sf)
    return D.drift_summary(D.drift_numeric(ref, cur, LINE_NUMERIC), D.drift_categorical(ref, cur, LINE_CATEGORICAL),
                           ref.select(F.count(F.lit(1))).scalar(), cur.select(F.count(F.lit(1))).scalar())


@query("drift_numeric", "D1", with_views(numeric_sql(REF_LINES, CUR_LINES, LINE_NUMERIC), "drift_lines"))
def q_drift_numeric(spark, sf):
    ref, cur = _lines(spark, sf)
    return D.drift_numeric(ref, cur, LINE_NUMERIC)


@query("drift_categorical", "D2", with_views(categorical_sql(REF_LINES, CUR_LINES, LINE_CATEGORICAL), "drift_lines"))
def q_drift_categorical(spark, sf):
    ref, cur = _lines(spark, sf)
    return D.drift_categorical(ref, cur, LINE_CATEGORICAL)


@query("drift_numeric_features", "D1", with_views(numeric_sql(REF_FEATURES, CUR_FEATURES, S.DRIFT_NUMERIC),
                                                    "customer_features"))
def q_drift_numeric_features(spark, sf):
    ref, cur = _features_pair(spark, sf)
    return D.drift_numeric(ref, cur, S.DRIFT_NUMERIC)


@query("drift_categorical_features", "D2", with_views(
    categorical_sql(REF_FEATURES, CUR_FEATURES, S.DRIFT_CATEGORICAL), "customer_features"))
def q_drift_categorical_features(spark, sf):
    ref, cur = _features_pair(spark, sf)
    return D.drift_categorical(ref, cur, S.DRIFT_CATEGORICAL)


@query("drift_summary", "D3", with_views(_SUMM + "SELECT * FROM summ", "drift_lines"))
def q_drift_summary(spark, sf):
    return _summary(spark, sf)


@query("missing_compare", "D4", with_views(
    "SELECT r.\"column\", r.reference_missing, c.current_missing FROM "
    "(UNPIVOT (SELECT " + ", ".join(f"CAST(count(*) - count({c}) AS BIGINT) AS {c}" for c in LINE_NUMERIC + LINE_CATEGORICAL)
    + f" FROM {REF_LINES}) ON COLUMNS(*) INTO NAME \"column\" VALUE reference_missing) r JOIN "
    "(UNPIVOT (SELECT " + ", ".join(f"CAST(count(*) - count({c}) AS BIGINT) AS {c}" for c in LINE_NUMERIC + LINE_CATEGORICAL)
    + f" FROM {CUR_LINES}) ON COLUMNS(*) INTO NAME \"column\" VALUE current_missing) c ON r.\"column\" = c.\"column\"",
    "drift_lines"))
def q_missing(spark, sf):
    ref, cur = _lines(spark, sf)
    return D.missing_compare(ref, cur)


@query("retrain_decision", "D5", with_views(
    _SUMM + f"SELECT drift_score, drift_score >= {S.DRIFT_THRESHOLD} AND {str(S.AUTO_RETRAIN).lower()} AS retraining_triggered, "
    f"CASE WHEN drift_score < {S.DRIFT_THRESHOLD} THEN 'drift below threshold' "
    f"WHEN {str(S.AUTO_RETRAIN).lower()} THEN 'drift score at or above threshold' "
    "ELSE 'drift detected but automatic retraining is disabled' END AS reason FROM summ", "drift_lines"))
def q_retrain(spark, sf):
    return D.retrain_decision(_summary(spark, sf), S.DRIFT_THRESHOLD, S.AUTO_RETRAIN)


@query("metrics_unpivot", "S8", with_views(
    _SUMM + "SELECT 'drift-run' AS run_id, 'churn_classifier' AS model_name, metric_name, metric_value FROM "
    "(UNPIVOT (SELECT CAST(drift_score AS DOUBLE) AS drift_score, CAST(drifted_features AS DOUBLE) AS drifted_features, "
    "CAST(total_features AS DOUBLE) AS total_features, "
    f"CASE WHEN drift_score >= {S.DRIFT_THRESHOLD} AND {str(S.AUTO_RETRAIN).lower()} THEN 1.0 END AS retraining_triggered "
    "FROM summ) ON COLUMNS(*) INTO NAME metric_name VALUE metric_value) WHERE metric_value IS NOT NULL", "drift_lines"))
def q_metrics_unpivot(spark, sf):
    wide = D.retrain_decision(_summary(spark, sf), keep=["drifted_features", "total_features"])
    return K.metrics_long(wide, "drift-run", "churn_classifier",
                          ["drift_score", "drifted_features", "total_features"],
                          event_flags=["retraining_triggered"])
