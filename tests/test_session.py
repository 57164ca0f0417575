"""Cluster defaults, fingerprints, ranking and model choice."""

import pytest
from pyspark.sql import functions as F

from attrition import session
from attrition.operators import aggregate as A
from attrition.operators import lineage as L
from attrition.operators import ml as M


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value or default

    def set(self, key, value):
        self.value = value


class _Context:
    def __init__(self, master):
        self.master, self.dir = master, None

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, path):
        self.dir = path


class _Session:
    def __init__(self, master, folder=None):
        self.sparkContext, self.conf = _Context(master), _Conf(folder)


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "k8s://x", "local-cluster[2,1,1024]"])
def test_a_cluster_needs_a_shared_folder(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(_Session(master))
    assert session.ensure_checkpoint_dir(_Session(master, "hdfs://x/ckpt")) == "hdfs://x/ckpt"


def test_a_local_session_gets_a_folder():
    assert session.ensure_checkpoint_dir(_Session("local[4]")).startswith("/tmp/attrition-ckpt-")


def test_parts_follow_the_input_size(spark, sf, monkeypatch):
    df = spark.read.parquet(f"{sf}/lineitem.parquet")
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert session.parts_for(df) == least
    monkeypatch.setattr(session, "PART_BYTES", 1000)
    assert session.parts_for(df) > 20 * least
    assert session.parts_for(session.cut_lineage(df.repartition(37))) >= 37


def test_fingerprints_tell_rows_apart(spark):
    one = lambda a, b: L.fingerprint(spark.createDataFrame([(a, b)], "a string, b string")).first().md5_sum
    texts = [("x|y", "z"), ("x", "y|z"), (None, "N"), ("N", None), ("\\N", "N"), ("", None), (None, ""), ("V1:x", "y")]
    assert len({one(*t) for t in texts}) == len(texts)
    many = spark.range(1000).select(F.col("id").cast("string").alias("a"))
    assert L.fingerprint(many).first() == L.fingerprint(many.repartition(7)).first()


def test_first_recorded_wins_ties(spark):
    rows = [("r", "zeta", "m", 0.9, 1), ("r", "alpha", "m", 0.9, 2), ("r", "mid", "m", 0.5, 0)]
    df = spark.createDataFrame(rows, "run_id string, model_name string, metric_name string, metric_value double, recorded_at int")
    ranked = A.rank_models(df, "m")
    assert [r.model_name for r in ranked.orderBy("rank").collect()] == ["zeta", "alpha", "mid"]
    assert dict(ranked.dtypes)["rank"] == "bigint"


def test_first_trained_wins_equal_validation_auc(spark):
    """Constant features: every learner scores every row alike, all AUCs are one half."""
    rows = [(f"c{i}", i % 2, 1.0) for i in range(60)]
    df = spark.createDataFrame(rows, "customerID string, Churn int, x double")
    small = {"random_forest": {"numTrees": 2, "maxDepth": 2}, "xgboost": {"maxIter": 1}, "lightgbm": {"maxIter": 1}}
    res = M.train_all(df, df, df, features=["x"], overrides=small)
    auc = {r.model_name: r.metric_value for r in res.metrics.filter("metric_name = 'val_roc_auc'").collect()}
    assert set(auc.values()) == {0.5} and res.best == "random_forest"
    assert res.reports.select("model_name").distinct().count() == 4 and set(res.importances) == set(M.LEARNERS)


def test_states_of_appends_add_up_and_name_what_changed(spark):
    rows = [(p, i % 7, None if i % 5 == 0 else f"v{i}") for i in range(90) for p in ("a", "b", None)]
    make = lambda r: spark.createDataFrame(r, "p string, n int, v string")
    whole = L.fingerprint_states(make(rows), "p")
    parts = L.fingerprint_states(make(rows[:100]), "p").unionByName(L.fingerprint_states(make(rows[100:]).repartition(5), "p"))
    merged = L.merge_states(parts, "p")
    assert merged.dtypes == whole.dtypes
    assert L.changed_partitions(whole, merged, "p").count() == 0
    assert L.merge_states(parts).first() == L.merge_states(whole).first()
    # one value differs in b, c is new, a is gone, the null partition is the same
    other = [r for r in rows if r[0] != "a"] + [("c", 1, "x")]
    other[other.index(("b", 1, "v1"))] = ("b", 1, "v1 ")
    got = L.changed_partitions(merged, L.fingerprint_states(make(other), "p"), "p").collect()
    assert {(r.p, r.change) for r in got} == {("a", "removed"), ("b", "changed"), ("c", "added")}


def test_wide_projections_are_not_one_huge_method(spark, sf):
    from attrition.plans import inputs as I
    from attrition.session import CODE_BYTES, CODE_LIMIT
    old = spark.conf.get(CODE_LIMIT)
    try:
        spark.conf.set(CODE_LIMIT, "65535")
        I.features(spark, sf)
        assert spark.conf.get(CODE_LIMIT) == CODE_BYTES
        spark.conf.set(CODE_LIMIT, "20000")   # the session's own choice stays
        I.features(spark, sf)
        assert spark.conf.get(CODE_LIMIT) == "20000"
    finally:
        spark.conf.set(CODE_LIMIT, old)


def test_features_are_built_by_as_many_tasks_as_there_are_cores(spark, sf):
    from attrition.plans import inputs as I
    spread, plain = I.spread_features(spark, sf), I.features(spark, sf)
    assert spread.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert spread.exceptAll(plain).count() == 0 and spread.count() == plain.count()
