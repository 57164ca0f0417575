from pyspark.sql import functions as F

from attrition.plans.pipeline import run_batch_pipeline


def test_batch_pipeline_end_to_end(spark):
    small = {"random_forest": {"numTrees": 5, "maxDepth": 4}, "xgboost": {"maxIter": 3},
             "lightgbm": {"maxIter": 3}}
    res = run_batch_pipeline(spark, "/root/testdata/sf0.01", run_id="test-run", code_version="abc",
                             overrides=small, cv_folds=2)
    assert res.rows["ingested"] == res.rows["validated"] == res.rows["processed"] == 1500
    assert res.rows["online_features"] == 1500
    assert res.best_model in {"random_forest", "xgboost", "lightgbm", "voting_ensemble"}
    assert 0 <= res.drift["drift_score"] <= 1
    metrics = spark.read.parquet(f"{res.base}/warehouse/model_metrics")
    assert metrics.filter(F.col("metric_name") == "drift_score").count() == 1
    assert metrics.filter(F.col("metric_name") == "val_roc_auc").count() == 4
    lineage = spark.read.parquet(f"{res.base}/lineage")
    assert sorted((r["job"], r["state"]) for r in lineage.collect()) == [
        (j, s) for j in ("ingest", "preprocess", "validate") for s in ("COMPLETE", "START")]
    cv = metrics.filter(F.col("metric_name").isin("cv_auc_mean", "cv_auc_std")).collect()
    assert len(cv) == 8 and all(0 <= r["metric_value"] <= 1 for r in cv)
    record = spark.read.json(f"{res.base}/models/record").first()
    assert record["best_model"] == res.best_model and len(record["features"]) == 26
    reports = spark.read.json(f"{res.base}/model_reports")
    assert reports.select("model_name").distinct().count() == 4
    assert spark.read.json(f"{res.base}/model_importances").groupBy("model_name").count().filter("count = 20").count() == 3
    processed = spark.read.parquet(f"{res.base}/warehouse/churn_processed")
    assert [r[0] for r in processed.select("pipeline_run_id").distinct().collect()] == ["test-run"]
    assert spark.read.csv(f"{res.base}/roc_curve", header=True).count() > 1


def test_a_failed_gate_quarantines_the_batch_and_stops(spark, sf):
    import os
    import pathlib
    import pytest
    from attrition.operators.quality import ValidationError
    from attrition.session import scratch_path
    base = scratch_path(spark, "failing").removeprefix("file:")
    with pytest.raises(ValidationError, match="row_count_ok"):
        run_batch_pipeline(spark, sf, base=base, run_id="bad", min_rows=10**9)
    assert spark.read.parquet(f"{base}/quarantine").count() > 0
    assert not os.path.exists(f"{base}/validated")
    assert not list(pathlib.Path(base, "warehouse", "churn_validated").rglob("*.parquet"))
    states = {(r["job"], r["state"]) for r in spark.read.parquet(f"{base}/lineage").collect()}
    assert ("validate", "FAIL") in states and ("preprocess", "START") not in states


def test_write_on_fail_goes_on(spark):
    from attrition.operators import quality as Q
    df = spark.createDataFrame([(1,), (None,)], "x int")
    report = Q.run_rules(df, [Q.rule("not_null", "x")])
    wrote = []
    assert Q.gate(df, report, wrote.append, write_on_fail=True) is False and len(wrote) == 1
    assert Q.gate(df, Q.run_rules(df, [Q.rule("row_count", None, min=1)]), wrote.append) is True
