"""Queries for cleaning, encoding and feature derivation."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import aggregate as A
from ..operators import clean as P
from ..sources.views import VIEWS
from . import inputs as I
from .catalog import query
from .oracle_sql import with_views

_STR_RAW = [c for c in S.RAW_COLUMNS if c not in ("SeniorCitizen", "tenure", "MonthlyCharges")]


def _sel(*cols: str) -> str:
    return ", ".join(cols)


# -- flagship: the minimum slice (raw -> clean -> features -> churn by group)

FLAGSHIP_SQL = with_views("""
SELECT tenure_group, count(*) AS n, CAST(sum(Churn) AS BIGINT) AS positives,
       round(sum(Churn) / count(*), 6) AS rate,
       round(count(*) / (SELECT count(*) FROM customer_features), 6) AS share
FROM customer_features GROUP BY tenure_group
""", "customer_features")


@query("tenure_group_churn", "P1-P12+A2", FLAGSHIP_SQL)
def tenure_group_churn(spark, sf):
    return A.rate_by_group(I.features(spark, sf), ["tenure_group"], "Churn")


@query("trim_strings", "P1", with_views(
    "SELECT " + ", ".join(
        [f"regexp_replace({c}, '^\\s+|\\s+$', '', 'g') AS {c}" if c in _STR_RAW else c for c in S.RAW_COLUMNS])
    + " FROM customer_raw", "customer_raw"))
def q_trim(spark, sf):
    return P.trim_strings(I.raw(spark, sf))


@query("coerce_numeric", "P2", with_views(
    "SELECT customerID, tenure, TRY_CAST(regexp_replace(TotalCharges, '^\\s+|\\s+$', '', 'g') AS DOUBLE) "
    "AS TotalCharges FROM customer_raw", "customer_raw"))
def q_coerce(spark, sf):
    df = P.coerce_numeric(P.trim_strings(I.raw(spark, sf)), ["TotalCharges"])
    return df.select("customerID", "tenure", "TotalCharges")


@query("fill_null", "P3", with_views("SELECT * FROM customer_clean", "customer_clean"))
def q_fill(spark, sf):
    return I.cleaned(spark, sf)


@query("cast_narrow", "P4", with_views(
    "SELECT customerID, CAST(SeniorCitizen AS TINYINT) AS SeniorCitizen, tenure FROM customer_clean",
    "customer_clean"))
def q_cast(spark, sf):
    return P.cast_narrow(I.cleaned(spark, sf), ["SeniorCitizen"]).select("customerID", "SeniorCitizen", "tenure")


@query("yes_no_encode", "P5", with_views(
    "SELECT customerID, " + _sel(*S.BINARY_COLUMNS) + " FROM customer_features", "customer_features"))
def q_yes_no(spark, sf):
    return P.yes_no_encode(I.cleaned(spark, sf), S.BINARY_COLUMNS).select("customerID", *S.BINARY_COLUMNS)


@query("target_encode", "P6", with_views("SELECT customerID, Churn FROM customer_features", "customer_features"))
def q_target(spark, sf):
    return P.target_encode(I.cleaned(spark, sf)).select("customerID", "Churn")


_ONEHOT = [n for n, _, _ in S.ONE_HOT_SPEC]


@query("one_hot", "P7", with_views("SELECT customerID, " + _sel(*_ONEHOT) + " FROM customer_features",
                                   "customer_features"))
def q_one_hot(spark, sf):
    return P.one_hot(I.cleaned(spark, sf)).select("customerID", *_ONEHOT)


@query("tenure_bucket", "P8", with_views("SELECT customerID, tenure, tenure_group FROM customer_features",
                                         "customer_features"))
def q_bucket(spark, sf):
    return P.tenure_bucket(I.cleaned(spark, sf)).select("customerID", "tenure", "tenure_group")


@query("charges_per_month", "P9", with_views("SELECT customerID, charges_per_month FROM customer_features",
                                             "customer_features"))
def q_cpm(spark, sf):
    return P.charges_per_month(I.cleaned(spark, sf)).select("customerID", "charges_per_month")


@query("has_internet", "P10", with_views("SELECT customerID, has_internet FROM customer_features",
                                         "customer_features"))
def q_has_internet(spark, sf):
    return P.has_internet(P.one_hot(I.cleaned(spark, sf))).select("customerID", "has_internet")


@query("num_services", "P11", with_views("SELECT customerID, num_services FROM customer_features",
                                         "customer_features"))
def q_num_services(spark, sf):
    df = P.yes_no_encode(I.cleaned(spark, sf), S.BINARY_COLUMNS)
    return P.num_services(df).select("customerID", "num_services")


@query("feature_projection", "P12", with_views("SELECT * FROM customer_features", "customer_features"))
def q_features(spark, sf):
    return I.features(spark, sf)


_ALIGN_GIVEN = S.MODEL_FEATURES[:20]


@query("align_columns", "P13", with_views(
    "SELECT customerID, " + ", ".join(c if c in _ALIGN_GIVEN else f"0 AS {c}" for c in S.MODEL_FEATURES)
    + " FROM score_requests", "score_requests"))
def q_align(spark, sf):
    given = I.requests(spark, sf).select("customerID", "request_id", *_ALIGN_GIVEN)
    return P.align_columns(given, S.MODEL_FEATURES, fill=0, keep=("customerID",))


_REQ_COLS = [c for c, _ in VIEWS["score_requests"][1]]
_DERIVE_SQL = {
    "charges_per_month": ("coalesce(charges_per_month, CASE WHEN tenure > 0 THEN TotalCharges / tenure "
                          "WHEN tenure IS NOT NULL THEN MonthlyCharges END)"),
    "has_internet": "coalesce(has_internet, 1 - coalesce(InternetService_No, 0))",
    "num_services": "coalesce(num_services, " + " + ".join(f"coalesce({c}, 0)" for c in S.SERVICE_COLUMNS) + ")",
}


@query("derive_missing", "P14", with_views(
    "SELECT " + ", ".join(f"{_DERIVE_SQL[c]} AS {c}" if c in _DERIVE_SQL else c for c in _REQ_COLS)
    + " FROM score_requests", "score_requests"))
def q_derive(spark, sf):
    return P.derive_missing(I.requests(spark, sf))


@query("risk_level", "P15", with_views(
    "SELECT prediction_id, churn_probability, CASE WHEN churn_probability < 0.3 THEN 'LOW' "
    "WHEN churn_probability < 0.5 THEN 'MEDIUM' WHEN churn_probability < 0.7 THEN 'HIGH' "
    "ELSE 'CRITICAL' END AS risk_level FROM predictions", "predictions"))
def q_risk(spark, sf):
    return P.with_risk_level(I.predictions(spark, sf)).select("prediction_id", "churn_probability", "risk_level")


@query("decide_label", "P16", with_views(
    "SELECT prediction_id, CAST(churn_probability >= 0.5 AS TINYINT) AS churn_prediction, "
    "CASE WHEN churn_probability >= 0.5 THEN 'Churn' ELSE 'No Churn' END AS churn_label, "
    "round_even(churn_probability * 10000, 0) / 10000 AS churn_probability_rounded FROM predictions",
    "predictions"))
def q_decide(spark, sf):
    df = I.predictions(spark, sf).drop("churn_prediction")
    return P.decide_label(df).select("prediction_id", "churn_prediction", "churn_label",
                                     "churn_probability_rounded")


def _violation_sql() -> str:
    parts = ["CASE WHEN customerID IS NULL THEN 'customerID:required' END"]
    for c, (lo, hi) in S.REQUEST_BOUNDS.items():
        if lo is not None:
            parts.append(f"CASE WHEN {c} < {lo} THEN '{c}:min' END")
        if hi is not None:
            parts.append(f"CASE WHEN {c} > {hi} THEN '{c}:max' END")
    return "concat_ws(',', " + ", ".join(parts) + ")"


@query("range_quarantine", "P17", with_views(
    f"SELECT request_id, customerID, violations FROM (SELECT request_id, customerID, {_violation_sql()} "
    "AS violations FROM score_requests) WHERE violations <> ''", "score_requests"))
def q_quarantine(spark, sf):
    _, bad = P.range_quarantine(I.requests(spark, sf))
    return bad.select("request_id", "customerID", F.array_join("violations", ",").alias("violations"))
