import pytest
from pyspark.sql import functions as F

from attrition import schemas as S
from attrition.operators import clean as P


def _raw(spark, rows):
    return spark.createDataFrame(rows, S.RAW_SCHEMA)


def _row(cid="0000000001", tenure=1, total="10.5", churn="Yes", internet="DSL", contract="One year",
         payment="Mailed check", gender="Male", lines="No", svc="Yes"):
    return (cid, gender, 0, "Yes", "No", tenure, "Yes", lines, internet, svc, svc, svc, svc, svc, svc,
            contract, "Yes", payment, 50.0, total, churn)


def test_tenure_bucket_edges(spark):
    rows = [_row(cid=f"{i:010d}", tenure=t) for i, t in enumerate([0, 12, 13, 24, 25, 48, 49, None])]
    out = P.tenure_bucket(_raw(spark, rows)).select("tenure", "tenure_group").collect()
    got = {r["tenure"]: r["tenure_group"] for r in out}
    assert got == {0: "new", 12: "new", 13: "developing", 24: "developing", 25: "mature", 48: "mature",
                   49: "loyal", None: "loyal"}


def test_ingest_clean_blank_and_garbage_totals(spark):
    rows = [_row(cid="0000000001", total=" "), _row(cid="0000000002", total="x"),
            _row(cid="0000000003", total=None), _row(cid=" 0000000004\t", total=" 12.25 ")]
    out = sorted(P.ingest_clean(_raw(spark, rows)).collect(), key=lambda r: r["customerID"])
    assert [r["TotalCharges"] for r in out] == [0.0, 0.0, 0.0, 12.25]
    assert out[3]["customerID"] == "0000000004"
    assert P.null_counts(P.ingest_coerced(_raw(spark, rows)), ["TotalCharges"]).first()[0] == 3


def test_unknown_category_fails_and_null_fails(spark):
    df = P.ingest_clean(_raw(spark, [_row(churn="Maybe")]))
    with pytest.raises(Exception):
        P.target_encode(df).collect()
    df = P.ingest_clean(_raw(spark, [_row(churn=None)]))
    with pytest.raises(Exception):
        P.target_encode(df).collect()
    # 'null' mode instead yields null
    assert P.target_encode(df, on_unknown="null").first()["Churn"] is None


def test_one_hot_unknown_all_zero(spark):
    df = P.ingest_clean(_raw(spark, [_row(internet="Satellite", contract="Weekly", payment="Cash")]))
    r = P.one_hot(df).first()
    assert all(r[n] == 0 for n, _, _ in S.ONE_HOT_SPEC if n != "gender_Male")
    assert "InternetService" not in P.one_hot(df).columns


def test_features_schema_and_values(spark):
    rows = [_row(cid="0000000001", tenure=0, total=" "), _row(cid="0000000002", tenure=3, total="100")]
    f = P.build_features(P.ingest_clean(_raw(spark, rows))).orderBy("customerID").collect()
    assert len(f[0]) == 29
    assert f[0]["charges_per_month"] == 50.0          # tenure 0 -> monthly
    assert f[1]["charges_per_month"] == 33.3333       # 100/3 rounded half-even to 4 places
    assert f[1]["num_services"] == 6 and f[1]["has_internet"] == 1


def test_derive_missing_null_tenure_is_null(spark):
    df = spark.createDataFrame([(None, 10.0, 20.0, None, None, None, 1, 0, 1, 0, 1, 0, 0)],
                               "tenure int, MonthlyCharges double, TotalCharges double, charges_per_month double, "
                               "has_internet int, num_services int, OnlineSecurity int, OnlineBackup int, "
                               "DeviceProtection int, TechSupport int, StreamingTV int, StreamingMovies int, "
                               "InternetService_No int")
    r = P.derive_missing(df).first()
    assert r["charges_per_month"] is None and r["has_internet"] == 1 and r["num_services"] == 3


def test_range_quarantine(spark):
    df = spark.createDataFrame([("a", 130, 10.0), (None, 5, 250.0), ("c", None, None)],
                               "customerID string, tenure int, MonthlyCharges double")
    ok, bad = P.range_quarantine(df, {"tenure": (0, 120), "MonthlyCharges": (0, 200)})
    assert [r["customerID"] for r in ok.collect()] == ["c"]
    v = {r["tenure"]: r["violations"] for r in bad.collect()}
    assert v[130] == ["tenure:max"] and v[5] == ["customerID:required", "MonthlyCharges:max"]


def test_risk_and_decision_edges(spark):
    df = spark.createDataFrame([(p,) for p in [0.0, 0.2999, 0.3, 0.5, 0.7, 1.0]], "churn_probability double")
    out = P.decide_label(P.with_risk_level(df)).orderBy("churn_probability").collect()
    assert [r["risk_level"] for r in out] == ["LOW", "LOW", "MEDIUM", "HIGH", "CRITICAL", "CRITICAL"]
    assert [r["churn_prediction"] for r in out] == [0, 0, 0, 1, 1, 1]
