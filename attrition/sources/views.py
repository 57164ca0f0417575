"""Input views derived from the driver's generated tables.

The churn pipeline's real input (a customer CSV, a prediction log, feature
snapshots, ...) is not shipped, so each input is a projection of one driver
table. Every mapping is a list of SQL expressions that both Spark SQL and
DuckDB accept, so the oracle sees the very same input rows. All of them are
narrow projections: no shuffle, and Catalyst prunes unused columns down to
the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_K = "c_custkey"
_CENTS = "(CAST(floor((c_acctbal+1000)/110*100) AS BIGINT)+2000)"
_TENURE = f"CAST(({_K}*7)%73 AS INT)"


def _service(m: int, r: int) -> str:
    return (f"CASE WHEN c_mktsegment = 'FURNITURE' THEN 'No internet service' "
            f"WHEN ({_K}*{m})%7 < {r} THEN 'Yes' ELSE 'No' END")


def _flag(cond: str) -> str:
    return f"CASE WHEN {cond} THEN 1 ELSE 0 END"


# view name -> (driver table, [(column, expression)])
VIEWS: dict[str, tuple[str, list[tuple[str, str]]]] = {
    # 21-column raw customer file.
    "customer_raw": ("customer", [
        ("customerID", f"lpad(CAST({_K} AS STRING),10,'0')"),
        ("gender", f"CASE WHEN {_K}%2=0 THEN 'Male' ELSE 'Female' END"),
        ("SeniorCitizen", _flag(f"{_K}%6=0")),
        ("Partner", f"CASE WHEN {_K}%3=0 THEN 'Yes' ELSE 'No' END"),
        ("Dependents", f"CASE WHEN {_K}%5=0 THEN 'Yes' ELSE 'No' END"),
        ("tenure", _TENURE),
        ("PhoneService", f"CASE WHEN {_K}%10<>0 THEN 'Yes' ELSE 'No' END"),
        ("MultipleLines", f"CASE WHEN {_K}%10=0 THEN 'No phone service' "
                          f"WHEN {_K}%4=1 THEN 'Yes' ELSE 'No' END"),
        ("InternetService", "CASE WHEN c_mktsegment IN ('AUTOMOBILE','BUILDING') THEN 'Fiber optic' "
                            "WHEN c_mktsegment = 'FURNITURE' THEN 'No' ELSE 'DSL' END"),
        ("OnlineSecurity", _service(3, 3)),
        ("OnlineBackup", _service(5, 3)),
        ("DeviceProtection", _service(11, 3)),
        ("TechSupport", _service(13, 2)),
        ("StreamingTV", _service(17, 4)),
        ("StreamingMovies", _service(19, 4)),
        ("Contract", "CASE c_nationkey%3 WHEN 0 THEN 'Two year' WHEN 1 THEN 'One year' "
                     "ELSE 'Month-to-month' END"),
        ("PaperlessBilling", f"CASE WHEN {_K}%8<5 THEN 'Yes' ELSE 'No' END"),
        ("PaymentMethod", "CASE c_nationkey%4 WHEN 0 THEN 'Electronic check' "
                          "WHEN 1 THEN 'Mailed check' WHEN 2 THEN 'Bank transfer (automatic)' "
                          "ELSE 'Credit card (automatic)' END"),
        ("MonthlyCharges", f"{_CENTS}/CAST(100 AS DOUBLE)"),
        ("TotalCharges", f"CASE WHEN {_TENURE}=0 THEN ' ' ELSE "
                         f"CAST(({_TENURE}*{_CENTS}+{_K}%1700)/CAST(100 AS DOUBLE) AS STRING) END"),
        ("Churn", f"CASE WHEN c_nationkey%3=2 AND ({_K}*31)%100<65 THEN 'Yes' "
                  f"WHEN ({_K}*31)%100<12 THEN 'Yes' ELSE 'No' END"),
    ]),
    # Prediction log (churn_predictions) from the events stream.
    "predictions": ("events", [
        ("prediction_id", "CAST(event_id AS STRING)"),
        ("customerID", "lpad(CAST(user_id AS STRING),10,'0')"),
        ("churn_probability", "least(value/200, CAST(1 AS DOUBLE))"),
        ("churn_prediction", "CAST(CASE WHEN value/200 >= 0.5 THEN 1 ELSE 0 END AS TINYINT)"),
        ("model_name", "event_type"),
        ("model_version", "'1'"),
        ("request_timestamp", "CAST(ts AS TIMESTAMP)"),
        ("latency_ms", "value*10"),
        ("pipeline_run_id", "'run-' || CAST(CAST(ts AS DATE) AS STRING)"),
    ]),
    # Long metrics table (model_metrics) from the events stream.
    "model_metrics": ("events", [
        ("run_id", "'run-' || CAST(user_id AS STRING)"),
        ("model_name", "event_type"),
        ("metric_name", "CASE event_id%3 WHEN 0 THEN 'val_roc_auc' WHEN 1 THEN 'drift_score' "
                        "ELSE 'val_f1' END"),
        ("metric_value", "value/500"),
        ("recorded_at", "CAST(ts AS TIMESTAMP)"),
    ]),
    # Feature snapshots with event / created time, from orders.
    "feature_snapshots": ("orders", [
        ("customerID", "lpad(CAST(o_custkey AS STRING),10,'0')"),
        ("snapshot_id", "o_orderkey"),
        ("event_timestamp", "o_orderdate"),
        ("created_timestamp", "o_orderdate"),
        ("total_price", "o_totalprice"),
        ("priority", "o_orderpriority"),
        ("status", "o_orderstatus"),
    ]),
    # Label (prediction) times per customer for point-in-time joins.
    "label_times": ("customer", [
        ("customerID", f"lpad(CAST({_K} AS STRING),10,'0')"),
        ("label_timestamp", f"CAST(DATE '1995-06-01' + CAST(({_K}*37)%2200 AS INT) AS TIMESTAMP)"),
    ]),
    # Two-sample drift pair: reference / current split by ship date.
    "drift_lines": ("lineitem", [
        ("side", "CASE WHEN l_shipdate < TIMESTAMP '1998-06-01' THEN 'reference' ELSE 'current' END"),
        ("ship_date", "l_shipdate"),
        ("quantity", "l_quantity"),
        ("extendedprice", "l_extendedprice"),
        ("discount", "l_discount"),
        ("returnflag", "l_returnflag"),
        ("linestatus", "l_linestatus"),
    ]),
    # Score / label pairs from lineitem (many tied scores).
    "scored_lines": ("lineitem", [
        ("line_id", "l_orderkey*10+l_linenumber"),
        ("score", "l_discount*10"),
        ("label", "CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS TINYINT)"),
    ]),
    # Sparse scoring requests (26 optional features) from the events stream.
    "score_requests": ("events", [
        ("request_id", "event_id"),
        ("customerID", "lpad(CAST(user_id AS STRING),10,'0')"),
        ("request_timestamp", "CAST(ts AS TIMESTAMP)"),
        ("tenure", "CASE WHEN event_id%7=0 THEN NULL ELSE CAST(event_id%130 AS INT) END"),
        ("MonthlyCharges", "CASE WHEN event_id%7=0 THEN NULL ELSE value/2 END"),
        ("TotalCharges", "CASE WHEN event_id%7=0 OR event_id%11=0 THEN NULL "
                         "ELSE value/2*(event_id%130)-10 END"),
        ("SeniorCitizen", "CASE WHEN event_id%7=0 THEN NULL ELSE CAST(event_id%2 AS INT) END"),
        ("Partner", "CASE WHEN event_id%7=0 THEN NULL ELSE CAST(event_id%3 AS INT) END"),
        ("Dependents", "CASE WHEN event_id%7=0 THEN NULL WHEN event_id%5=0 THEN 1 ELSE 0 END"),
        ("PhoneService", "CASE WHEN event_id%7=0 THEN NULL WHEN event_id%10<>0 THEN 1 ELSE 0 END"),
        ("MultipleLines", "CASE WHEN event_id%7=0 THEN NULL WHEN event_id%4=1 THEN 1 ELSE 0 END"),
        ("OnlineSecurity", "CASE WHEN event_id%7=0 THEN NULL WHEN (event_id*3)%7<3 THEN 1 ELSE 0 END"),
        ("OnlineBackup", "CASE WHEN event_id%7=0 THEN NULL WHEN (event_id*5)%7<3 THEN 1 ELSE 0 END"),
        ("DeviceProtection", "CASE WHEN event_id%7=0 THEN NULL WHEN (event_id*11)%7<3 THEN 1 ELSE 0 END"),
        ("TechSupport", "CASE WHEN event_id%7=0 THEN NULL WHEN (event_id*13)%7<2 THEN 1 ELSE 0 END"),
        ("StreamingTV", "CASE WHEN event_id%7=0 THEN NULL WHEN (event_id*17)%7<4 THEN 1 ELSE 0 END"),
        ("StreamingMovies", "CASE WHEN event_id%7=0 THEN NULL WHEN (event_id*19)%7<4 THEN 1 ELSE 0 END"),
        ("PaperlessBilling", "CASE WHEN event_id%7=0 THEN NULL WHEN event_id%8<5 THEN 1 ELSE 0 END"),
        ("gender_Male", "CASE WHEN event_id%7=0 THEN NULL WHEN user_id%2=0 THEN 1 ELSE 0 END"),
        ("InternetService_Fiber", "CASE WHEN event_id%7=0 THEN NULL WHEN event_type IN ('click','view') "
                                  "THEN 1 ELSE 0 END"),
        ("InternetService_No", "CASE WHEN event_id%7=0 THEN NULL WHEN event_type = 'purchase' "
                               "THEN 1 ELSE 0 END"),
        ("Contract_OneYear", "CASE WHEN event_id%7=0 THEN NULL WHEN user_id%3=1 THEN 1 ELSE 0 END"),
        ("Contract_TwoYear", "CASE WHEN event_id%7=0 THEN NULL WHEN user_id%3=0 THEN 1 ELSE 0 END"),
        ("PaymentMethod_CreditCard", "CASE WHEN event_id%7=0 THEN NULL WHEN user_id%4=3 THEN 1 ELSE 0 END"),
        ("PaymentMethod_ElecCheck", "CASE WHEN event_id%7=0 THEN NULL WHEN user_id%4=0 THEN 1 ELSE 0 END"),
        ("PaymentMethod_MailedCheck", "CASE WHEN event_id%7=0 THEN NULL WHEN user_id%4=1 THEN 1 ELSE 0 END"),
        ("charges_per_month", "CASE WHEN event_id%5=0 AND event_id%7<>0 THEN value/3 ELSE NULL END"),
        ("has_internet", "CAST(NULL AS INT)"),
        ("num_services", "CASE WHEN event_id%13=0 AND event_id%7<>0 THEN 11 ELSE NULL END"),
    ]),
}


def view_select_sql(name: str) -> str:
    """``SELECT <exprs> FROM <table>`` text for one view (both dialects)."""
    table, cols = VIEWS[name]
    body = ",\n  ".join(f"{expr} AS {col}" for col, expr in cols)
    return f"SELECT\n  {body}\nFROM {table}"


def table_path(sf_dir: str, table: str) -> str:
    return f"{sf_dir.rstrip('/')}/{table}.parquet"


def read_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, table))


def load_view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One derived input view as a lazy DataFrame."""
    return view_of(read_table(spark, sf_dir, VIEWS[name][0]), name)


def view_of(table: DataFrame, name: str) -> DataFrame:
    """The view over the rows of its driver table."""
    return table.selectExpr(*[f"{e} AS {c}" for c, e in VIEWS[name][1]])


def register_views(spark: SparkSession, sf_dir: str, names=None) -> None:
    """Register the driver tables and derived views as temp views."""
    for table in sorted({t for t, _ in VIEWS.values()}):
        read_table(spark, sf_dir, table).createOrReplaceTempView(table)
    for name in names or VIEWS:
        load_view(spark, sf_dir, name).createOrReplaceTempView(name)
