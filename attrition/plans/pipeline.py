"""The batch churn pipeline as one Spark application.

Stages follow the original ingest -> validate -> preprocess -> feature store
-> train -> evaluate -> drift -> retrain order. Each stage's output is
written under ``base`` (a folder in the shared checkpoint directory by
default) and the next stage reads it back, so the written tables are the
stage boundaries (and cut lineage); within a stage everything is one lazy
plan. Nothing is launched outside Spark: the retrain decision is a row.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import clean as P
from ..operators import drift as D
from ..operators import evaluate as E
from ..operators import lineage as L
from ..operators import ml as M
from ..operators import quality as Q
from ..operators import sampling as R
from ..operators import smote as SM
from ..operators import store as J
from ..session import scratch_path
from ..sources import sinks as K
from ..sources.views import load_view


@dataclass
class PipelineResult:
    base: str
    run_id: str
    rows: dict = field(default_factory=dict)
    best_model: str | None = None
    drift: dict = field(default_factory=dict)


def _lineage(spark, base, df, job, run_id, state, inputs, outputs, rows=None):
    ev = L.lineage_event(spark, df, job, run_id, state, inputs, outputs, row_count=rows)
    K.write_stage(ev, f"{base}/lineage", "parquet", "append", count=False)


def run_batch_pipeline(spark: SparkSession, sf_dir: str, base: str | None = None, run_id: str | None = None,
                       code_version: str = "", raw: DataFrame | None = None, min_rows: int = S.ROW_COUNT_MIN,
                       overrides: dict | None = None, cv_folds: int = S.CV_FOLDS,
                       write_on_fail: bool = False) -> PipelineResult:
    base = (base or scratch_path(spark, "pipeline")).rstrip("/")
    run_id = run_id or uuid.uuid4().hex
    res = PipelineResult(base, run_id)
    tables = K.ensure_tables(spark, f"{base}/warehouse", database=f"attrition_{uuid.uuid4().hex[:10]}")

    # 1. ingest: clean the raw file, write the stage
    raw = raw if raw is not None else load_view(spark, sf_dir, "customer_raw")
    _lineage(spark, base, raw, "ingest", run_id, "START", [sf_dir], [f"{base}/raw"])
    res.rows["ingested"] = K.write_stage(P.ingest_clean(raw), f"{base}/raw", "parquet")
    ingested = spark.read.parquet(f"{base}/raw")
    _lineage(spark, base, ingested, "ingest", run_id, "COMPLETE", [sf_dir], [f"{base}/raw"], res.rows["ingested"])

    # 2. validate: the report is always written; a batch that fails the gate goes to
    # quarantine and the run stops (with write_on_fail it goes on)
    validated = P.cast_narrow(ingested, ["SeniorCitizen"])
    paths = [f"{base}/raw"], [f"{base}/validated"]
    _lineage(spark, base, validated, "validate", run_id, "START", *paths)
    K.write_stage(Q.run_rules(validated, Q.gate_rules(min_rows)), f"{base}/validation_report", "json", count=False)
    report = spark.read.schema("rule string, kind string, column string, observed double, success boolean").json(
        f"{base}/validation_report")

    def accept(df: DataFrame) -> None:
        res.rows["validated"] = K.write_stage(df, f"{base}/validated", "parquet")
        K.append_with_lineage(spark.read.parquet(f"{base}/validated"), tables["churn_validated"], "churn_validated", run_id)

    def reject(df: DataFrame) -> None:
        res.rows["quarantined"] = K.write_stage(df, f"{base}/quarantine", "parquet")

    try:
        passed = Q.gate(validated, report, accept, reject, write_on_fail)
    except Q.ValidationError:
        _lineage(spark, base, validated, "validate", run_id, "FAIL", [f"{base}/raw"], [f"{base}/quarantine"], res.rows["quarantined"])
        raise
    _lineage(spark, base, validated, "validate", run_id, "COMPLETE" if passed else "FAIL", *paths, res.rows["validated"])

    # 3. preprocess: features, reference sample, processed table
    features = P.build_features(spark.read.parquet(f"{base}/validated"))
    paths = [f"{base}/validated"], [f"{base}/processed", f"{base}/reference"]
    _lineage(spark, base, features, "preprocess", run_id, "START", *paths)
    res.rows["processed"] = K.write_stage(features, f"{base}/processed", "parquet")
    processed = spark.read.parquet(f"{base}/processed")
    K.write_stage(R.hash_sample(processed, "customerID", S.REFERENCE_SAMPLE), f"{base}/reference", "parquet")
    K.append_with_lineage(processed, tables["churn_processed"], "churn_processed", run_id, code_version)
    _lineage(spark, base, processed, "preprocess", run_id, "COMPLETE", *paths, res.rows["processed"])

    # 4. feature store: stamped snapshot + latest row per entity
    snap = processed.withColumn("event_timestamp", F.current_timestamp()) \
        .withColumn("created_timestamp", F.current_timestamp())
    K.write_stage(snap, f"{base}/feature_store", "parquet")
    latest = J.latest_per_entity(spark.read.parquet(f"{base}/feature_store"), S.ENTITY_KEY,
                                 "event_timestamp", "created_timestamp", tie=["customerID"])
    res.rows["online_features"] = K.write_stage(latest, f"{base}/online_features", "parquet")

    # 5. train: exact stratified split, SMOTE on train, three learners + vote
    split = R.stratified_split(processed, "Churn", "customerID")
    K.write_stage(split, f"{base}/split", "parquet")
    parts = R.split_frames(spark.read.parquet(f"{base}/split"))
    train = SM.smote(parts["train"], "Churn", S.MODEL_FEATURES, "customerID").drop("is_synthetic")
    K.write_stage(train, f"{base}/train_resampled", "parquet")
    trained = M.train_all(spark.read.parquet(f"{base}/train_resampled"), parts["val"], parts["test"],
                          run_id=run_id, overrides=overrides, save_to=f"{base}/models", cv_folds=cv_folds)
    res.best_model = trained.best
    K.write_stage(trained.reports, f"{base}/model_reports", "json", count=False)
    top = [(n, i + 1, f, v) for n, vals in trained.importances.items() for i, (f, v) in enumerate(vals)]
    K.write_stage(spark.createDataFrame(top, "model_name string, rank int, feature string, importance double"),
                  f"{base}/model_importances", "json", count=False)
    metrics = trained.metrics.withColumn("recorded_at", F.current_timestamp())
    K.write_stage(metrics, tables["model_metrics"], "parquet", "append", count=False)

    # 6. evaluate the chosen model on the test split: metrics and curves
    names = ["random_forest", "xgboost", "lightgbm"]
    test = M.score_with({n: trained.models[n] for n in names}, M.assembler(S.MODEL_FEATURES).transform(parts["test"]),
                        vote=names)
    p = "p_vote" if trained.best == "voting_ensemble" else f"p_{trained.best}"
    test = test.withColumn("pred", (F.col(p) >= S.DECISION_THRESHOLD).cast("int"))
    K.write_stage(E.confusion_metrics(test, "Churn", "pred", scale=None), f"{base}/eval_metrics", "json", count=False)
    K.write_stage(E.classification_report(test, "Churn", "pred"), f"{base}/classification_report", "json", count=False)
    K.write_stage(E.roc_curve(test, "Churn", p), f"{base}/roc_curve", "csv", count=False)
    K.write_stage(E.pr_curve(test, "Churn", p), f"{base}/pr_curve", "csv", count=False)

    # 7. drift: reference sample vs the latest processed batch, summary, retrain rule
    current = J.latest_batch(K.read_table(spark, tables["churn_processed"], "churn_processed"), "ingested_at",
                             by_run="pipeline_run_id")
    ref = spark.read.parquet(f"{base}/reference")
    num_cols = P.common_columns(ref, current, S.DRIFT_NUMERIC)
    cat_cols = P.common_columns(ref, current, S.DRIFT_CATEGORICAL)
    num, cat = D.drift_numeric(ref, current, num_cols), D.drift_categorical(ref, current, cat_cols)
    summary = D.drift_summary(num, cat, ref.select(F.count(F.lit(1))).scalar(),
                              current.select(F.count(F.lit(1))).scalar())
    decision = D.retrain_decision(summary, keep=["drifted_features", "total_features"])
    row = decision.first()
    res.drift = row.asDict()
    drift_metrics = K.metrics_long(decision, run_id, "churn_classifier",
                                   ["drift_score", "drifted_features", "total_features"],
                                   event_flags=["retraining_triggered"], recorded_at=F.current_timestamp())
    K.write_stage(drift_metrics, tables["model_metrics"], "parquet", "append", count=False)
    return res

