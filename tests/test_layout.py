"""Results must not depend on the partitioning (1 vs 7 shuffle partitions)."""
import pytest

import check_oracle as CO
from attrition.plans.catalog import load_all

KEYS = ["stratified_split", "kfold_assign", "reference_sample", "point_in_time_join", "latest_per_entity",
        "roc_curve", "roc_auc", "drift_numeric", "drift_categorical", "histogram_quantile", "rank_models",
        "alert_for", "drift_alert", "check_unique", "validation_suite"]


@pytest.mark.parametrize("key", KEYS)
def test_same_result_at_1_and_7_partitions(spark, sf, key):
    fn = load_all()[key].fn
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        out = []
        for n in (1, 7):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            out.append(fn(spark, sf).toPandas())
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert CO.compare(out[0], out[1]) == "ok"
