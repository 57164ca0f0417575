"""Plan checks: no operator funnels a whole table into one task.

For every registered query that builds without training a model, the
physical plan must not contain a single-partition exchange feeding a Window
or a Sort (a global window or a global sort of raw rows), a nested-loop or
cartesian join, or a Python UDF evaluation. Single-partition exchanges that
feed the final step of a global aggregate (one partial row per task) are fine.
"""

import re

import pytest

from attrition.plans.catalog import load_all

MODEL_OR_STREAM = {"learned_cv", "learned_probabilities", "learned_metrics", "learned_importances", "learned_segments",
                   "gbt_first_tree", "gbt_balanced_first_tree", "rf_train", "gbt_train", "gbt_balanced_train", "cross_validate", "train_pipeline",
                   "score_batch", "top_importances", "feature_importance", "segment_eval", "stream_score",
                   "stream_rate_5m", "stream_rate_by_result_5m", "stream_latency_p95_5m", "stream_alert_for",
                   "stream_absence_alert", "stream_drift_alert",
                   "validation_gate"}
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


def _depth(line: str) -> int:
    m = re.search(r"[+:]- ", line)
    return m.start() if m else len(line) - len(line.lstrip())


def _single_partition_parents(plan: str) -> list[str]:
    lines = plan.split("\n")
    out = []
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" not in line:
            continue
        d = _depth(line)
        for j in range(i - 1, -1, -1):
            if _depth(lines[j]) < d:
                out.append(re.sub(r"^[\s:+|-]*", "", lines[j]).split(" ")[0].split("(")[0])
                break
    return out


@pytest.mark.parametrize("key", sorted(k for k in load_all() if k not in MODEL_OR_STREAM))
def test_no_single_task_funnel(spark, sf, key):
    df = load_all()[key].fn(spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [t for t in FORBIDDEN if t in plan], plan
    parents = _single_partition_parents(plan)
    assert not [p for p in parents if p in ("Window", "Sort")], (parents, plan)


def test_smote_search_plans_no_pairs_of_everything(spark, sf):
    """The neighbour search joins on cells and never by nested loops or in one task."""
    from attrition import schemas as S
    from attrition.operators.smote import collapse_points, knn_exact
    from attrition.plans import inputs as I
    points = collapse_points(I.features(spark, sf).filter("Churn = 1"), S.MODEL_FEATURES)
    plan = knn_exact(points, 5, len(S.MODEL_FEATURES))._jdf.queryExecution().executedPlan().toString()
    assert not [t for t in FORBIDDEN if t in plan], plan
    assert not [p for p in _single_partition_parents(plan) if p in ("Window", "Sort")], plan


def test_the_newest_batch_prunes_by_run(spark):
    from attrition.operators import store as J
    from attrition.session import scratch_path
    from attrition.sources import sinks as K
    path = scratch_path(spark, "by-run")
    rows = spark.createDataFrame([("p1", "c", 0.5)], "prediction_id string, customerID string, churn_probability double")
    full = rows.selectExpr("*", "CAST(1 AS TINYINT) churn_prediction", "'m' model_name", "'1' model_version", "1.0D latency_ms")
    for run, time in (("run-1", "2024-01-01"), ("run-2", "2024-02-01")):
        from pyspark.sql import functions as F
        n = K.log_predictions(full.withColumn("request_timestamp", F.lit(time).cast("timestamp")), path, run)
        assert n == 1
    assert K.log_predictions(full, path, "run-3") == 1
    table = K.read_table(spark, path, "churn_predictions")
    assert table.filter("request_timestamp IS NULL").count() == 0
    newest = J.latest_batch(table, "request_timestamp", by_run="pipeline_run_id")
    assert [r.pipeline_run_id for r in newest.collect()] == ["run-3"]
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(pipeline_run_id" in plan
