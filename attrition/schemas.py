"""Schemas and the fixed values the churn configuration depends on.

Operators in this package are parametric (they take columns, maps and edges
as arguments); the constants below are the one configuration that must agree
with the original churn pipeline for results to be right.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the original pipeline's for right results)
# ---------------------------------------------------------------------------

# Raw customer file: column order.
RAW_COLUMNS = [
    "customerID", "gender", "SeniorCitizen", "Partner", "Dependents", "tenure",
    "PhoneService", "MultipleLines", "InternetService", "OnlineSecurity",
    "OnlineBackup", "DeviceProtection", "TechSupport", "StreamingTV",
    "StreamingMovies", "Contract", "PaperlessBilling", "PaymentMethod",
    "MonthlyCharges", "TotalCharges", "Churn",
]

# Yes/No style encodings.
TARGET_MAP = {"Yes": 1, "No": 0}
BINARY_MAP = {"Yes": 1, "No": 0, "No phone service": 0, "No internet service": 0}
BINARY_COLUMNS = [
    "Partner", "Dependents", "PhoneService", "PaperlessBilling", "MultipleLines",
    "OnlineSecurity", "OnlineBackup", "DeviceProtection", "TechSupport",
    "StreamingTV", "StreamingMovies",
]

# One-hot indicators: (new column, source column, value); source dropped.
ONE_HOT_SPEC = [
    ("gender_Male", "gender", "Male"),
    ("InternetService_Fiber", "InternetService", "Fiber optic"),
    ("InternetService_No", "InternetService", "No"),
    ("Contract_OneYear", "Contract", "One year"),
    ("Contract_TwoYear", "Contract", "Two year"),
    ("PaymentMethod_CreditCard", "PaymentMethod", "Credit card (automatic)"),
    ("PaymentMethod_ElecCheck", "PaymentMethod", "Electronic check"),
    ("PaymentMethod_MailedCheck", "PaymentMethod", "Mailed check"),
]

# Tenure groups: right-closed upper edges, then the label of the rest.
TENURE_EDGES = [12, 24, 48]
TENURE_LABELS = ["new", "developing", "mature", "loyal"]

SERVICE_COLUMNS = [
    "OnlineSecurity", "OnlineBackup", "DeviceProtection", "TechSupport",
    "StreamingTV", "StreamingMovies",
]

# Final processed-table column order.
FEATURE_TABLE_COLUMNS = [
    "customerID", "tenure", "MonthlyCharges", "TotalCharges", "SeniorCitizen",
    "Partner", "Dependents", "PhoneService", "MultipleLines", "OnlineSecurity",
    "OnlineBackup", "DeviceProtection", "TechSupport", "StreamingTV",
    "StreamingMovies", "PaperlessBilling", "gender_Male", "InternetService_Fiber",
    "InternetService_No", "Contract_OneYear", "Contract_TwoYear",
    "PaymentMethod_CreditCard", "PaymentMethod_ElecCheck",
    "PaymentMethod_MailedCheck", "tenure_group", "charges_per_month",
    "has_internet", "num_services", "Churn",
]
NON_MODEL_COLUMNS = ["customerID", "Churn", "tenure_group"]
MODEL_FEATURES = [c for c in FEATURE_TABLE_COLUMNS if c not in NON_MODEL_COLUMNS]

# Allowed values of the raw categorical columns.
GENDER_VALUES = ["Male", "Female"]
YES_NO_VALUES = ["Yes", "No"]
MULTIPLE_LINES_VALUES = ["Yes", "No", "No phone service"]
INTERNET_VALUES = ["DSL", "Fiber optic", "No"]
CONTRACT_VALUES = ["Month-to-month", "One year", "Two year"]
PAYMENT_VALUES = [
    "Electronic check", "Mailed check", "Bank transfer (automatic)",
    "Credit card (automatic)",
]

# Feature views of the feature store (entity key customerID, ttl 365 days).
ENTITY_KEY = "customerID"
FEATURE_TTL_DAYS = 365
FEATURE_VIEWS = {
    "customer_demographics": [
        "tenure", "SeniorCitizen", "Partner", "Dependents", "gender_Male",
        "tenure_group",
    ],
    "customer_services": [
        "PhoneService", "MultipleLines", "InternetService_Fiber",
        "InternetService_No", "OnlineSecurity", "OnlineBackup",
        "DeviceProtection", "TechSupport", "StreamingTV", "StreamingMovies",
        "has_internet", "num_services",
    ],
    "customer_billing": [
        "MonthlyCharges", "TotalCharges", "charges_per_month", "PaperlessBilling",
        "Contract_OneYear", "Contract_TwoYear", "PaymentMethod_CreditCard",
        "PaymentMethod_ElecCheck", "PaymentMethod_MailedCheck",
    ],
}

# Drift features.
DRIFT_NUMERIC = ["tenure", "MonthlyCharges", "TotalCharges", "charges_per_month", "num_services"]
DRIFT_CATEGORICAL = [
    "SeniorCitizen", "Partner", "Dependents", "PhoneService", "MultipleLines",
    "OnlineSecurity", "OnlineBackup", "DeviceProtection", "TechSupport",
    "StreamingTV", "StreamingMovies", "PaperlessBilling", "gender_Male",
    "InternetService_Fiber", "InternetService_No", "Contract_OneYear",
    "Contract_TwoYear", "PaymentMethod_CreditCard", "PaymentMethod_ElecCheck",
    "PaymentMethod_MailedCheck", "has_internet",
]
DRIFT_THRESHOLD = 0.2
AUTO_RETRAIN = True

# Scoring.
DECISION_THRESHOLD = 0.5
RISK_BANDS = [(0.3, "LOW"), (0.5, "MEDIUM"), (0.7, "HIGH")]
RISK_TOP = "CRITICAL"
CHURN_LABELS = ("Churn", "No Churn")

# Request constraints: column -> (min, max); None = open.
REQUEST_BOUNDS = {
    "tenure": (0, 120), "MonthlyCharges": (0, 200), "TotalCharges": (0, None),
    "SeniorCitizen": (0, 1), "Partner": (0, 1), "Dependents": (0, 1),
    "PhoneService": (0, 1), "MultipleLines": (0, 1), "OnlineSecurity": (0, 1),
    "OnlineBackup": (0, 1), "DeviceProtection": (0, 1), "TechSupport": (0, 1),
    "StreamingTV": (0, 1), "StreamingMovies": (0, 1), "PaperlessBilling": (0, 1),
    "gender_Male": (0, 1), "InternetService_Fiber": (0, 1),
    "InternetService_No": (0, 1), "Contract_OneYear": (0, 1),
    "Contract_TwoYear": (0, 1), "PaymentMethod_CreditCard": (0, 1),
    "PaymentMethod_ElecCheck": (0, 1), "PaymentMethod_MailedCheck": (0, 1),
    "has_internet": (0, 1), "num_services": (0, 10),
}

# Monitoring histograms (Prometheus-style upper bounds; +Inf implied).
LATENCY_EDGES = [0.01, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5]
PROBABILITY_EDGES = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]

# Data-quality gate bounds.
ROW_COUNT_MIN, ROW_COUNT_MAX = 1000, 100000
CHURN_RATE_BOUNDS = (0.10, 0.60)
TENURE_MEAN_BOUNDS = (10, 50)
MONTHLY_MEAN_BOUNDS = (30, 100)

# Training parameters.
SEED = 42
TEST_SIZE = 0.2
VAL_SIZE = 0.1
CV_FOLDS = 5
SMOTE_RATIO = 0.7
SMOTE_K = 5
REFERENCE_SAMPLE = 1000
RF_PARAMS = dict(n_estimators=200, max_depth=10, min_samples_split=5, min_samples_leaf=2)
XGB_PARAMS = dict(n_estimators=200, max_depth=6, learning_rate=0.05, subsample=0.8,
                  colsample_bytree=0.8, scale_pos_weight=3)
LGBM_PARAMS = dict(n_estimators=200, max_depth=6, learning_rate=0.05, num_leaves=31)

# ---------------------------------------------------------------------------
# Spark schemas
# ---------------------------------------------------------------------------

RAW_SCHEMA = T.StructType(
    [T.StructField("customerID", T.StringType(), True),
     T.StructField("gender", T.StringType(), True),
     T.StructField("SeniorCitizen", T.IntegerType(), True)]
    + [T.StructField(c, T.StringType(), True) for c in ("Partner", "Dependents")]
    + [T.StructField("tenure", T.IntegerType(), True)]
    + [T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS[6:18]]
    + [T.StructField("MonthlyCharges", T.DoubleType(), True),
       T.StructField("TotalCharges", T.StringType(), True),
       T.StructField("Churn", T.StringType(), True)]
)

VALIDATED_SCHEMA = T.StructType(
    [f if f.name not in ("TotalCharges", "SeniorCitizen") else
     T.StructField(f.name, T.DoubleType() if f.name == "TotalCharges" else T.ByteType(), True)
     for f in RAW_SCHEMA.fields]
    + [T.StructField("ingested_at", T.TimestampType(), True),
       T.StructField("pipeline_run_id", T.StringType(), True)]
)


def _feature_field(name: str) -> T.StructField:
    if name in ("customerID", "tenure_group"):
        return T.StructField(name, T.StringType(), True)
    if name == "tenure":
        return T.StructField(name, T.IntegerType(), True)
    if name in ("MonthlyCharges", "TotalCharges", "charges_per_month"):
        return T.StructField(name, T.DoubleType(), True)
    return T.StructField(name, T.ByteType(), True)


FEATURE_SCHEMA = T.StructType([_feature_field(c) for c in FEATURE_TABLE_COLUMNS])
PROCESSED_SCHEMA = T.StructType(
    FEATURE_SCHEMA.fields
    + [T.StructField("ingested_at", T.TimestampType(), True),
       T.StructField("pipeline_run_id", T.StringType(), True),
       T.StructField("dvc_commit_hash", T.StringType(), True)]
)

PREDICTIONS_SCHEMA = T.StructType([
    T.StructField("prediction_id", T.StringType(), True),
    T.StructField("customerID", T.StringType(), True),
    T.StructField("churn_probability", T.DoubleType(), True),
    T.StructField("churn_prediction", T.ByteType(), True),
    T.StructField("model_name", T.StringType(), True),
    T.StructField("model_version", T.StringType(), True),
    T.StructField("request_timestamp", T.TimestampType(), True),
    T.StructField("latency_ms", T.DoubleType(), True),
    T.StructField("pipeline_run_id", T.StringType(), True),
])

METRICS_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType(), True),
    T.StructField("model_name", T.StringType(), True),
    T.StructField("metric_name", T.StringType(), True),
    T.StructField("metric_value", T.DoubleType(), True),
    T.StructField("recorded_at", T.TimestampType(), True),
])

TABLE_SCHEMAS = {
    "churn_validated": VALIDATED_SCHEMA,
    "churn_processed": PROCESSED_SCHEMA,
    "churn_predictions": PREDICTIONS_SCHEMA,
    "model_metrics": METRICS_SCHEMA,
}
