import importlib

from pyspark.sql import functions as F

from attrition import schemas as S
from attrition.operators import ml as M
from attrition.operators import sampling as R
from attrition.plans import inputs as I
from attrition.plans.catalog import load_all


def test_entry_contract(spark):
    entry = importlib.import_module("__spark_entry__")
    df = entry.entry(spark)
    assert df.count() > 0 and set(df.columns) >= {"tenure_group", "rate"}
    qs, oracle = entry.queries(), entry.oracle_sql()
    assert set(oracle) <= set(qs)
    assert len(qs) >= 90


def test_stream_rate_equals_closed_batch_windows(spark, sf):
    reg = load_all()
    stream = reg["stream_rate_5m"].fn(spark, sf)
    batch = reg["rate_5m"].fn(spark, sf)
    mx = I.predictions(spark, sf).agg(F.max("request_timestamp")).first()[0]
    closed = batch.filter(F.col("window_end") <= F.lit(mx) - F.expr("INTERVAL 10 MINUTES"))
    assert stream.count() == closed.count()
    assert stream.exceptAll(closed.select(*stream.columns)).count() == 0


def test_train_and_score_small(spark, sf):
    df = R.stratified_split(I.features(spark, sf), "Churn", "customerID")
    sp = R.split_frames(df)
    small = {"random_forest": {"numTrees": 5, "maxDepth": 4}, "xgboost": {"maxIter": 3},
             "lightgbm": {"maxIter": 3}}
    res = M.train_all(sp["train"], sp["val"], sp["test"], overrides=small)
    assert res.best in {"random_forest", "xgboost", "lightgbm", "voting_ensemble"}
    m = res.metrics.toPandas()
    assert len(m) == 4 * 3 * 5 and m.metric_value.between(0, 1).all()
    names = ["random_forest", "xgboost", "lightgbm"]
    scored, bad = M.score(I.requests(spark, sf), {n: res.models[n] for n in names},
                          store=I.features(spark, sf), vote=names)
    p = scored.toPandas()
    assert p.churn_probability.between(0, 1).all()
    assert len(p) + bad.count() == I.requests(spark, sf).count()
    imp = M.importances(res.models["random_forest"], S.MODEL_FEATURES)
    assert len(imp) == 20 and imp[0][1] >= imp[-1][1]


def test_balanced_weights_sum(spark, sf):
    w = M.balanced_weights(I.features(spark, sf), "Churn").groupBy("Churn").agg(F.sum("weight").alias("s"))
    vals = [r["s"] for r in w.collect()]
    assert abs(vals[0] - vals[1]) < 1e-6


def test_cross_validation_fits_the_production_parameters(spark, sf, monkeypatch):
    from attrition.plans import q_ml
    seen = []

    def fits(df, features, k, overrides):
        seen.append(overrides)
        rows = [(n, f, 0.75 + f / 100) for n in [*M.LEARNERS, "voting_ensemble"] for f in range(k)]
        return spark.createDataFrame(rows, "model_name string, fold int, roc_auc double")

    monkeypatch.setattr(q_ml, "_REGISTRY", {})
    monkeypatch.setattr(q_ml.M, "cross_validate", fits)
    out = load_all()["cross_validate"].fn(spark, sf)
    assert out.count() == 20 and out.filter("auc_in_range").count() == 20
    assert seen == [None] and M.random_forest().getNumTrees() == 200
    assert M.boost_params("xgboost").rounds == 200 and M.boost_params("lightgbm").max_leaves == 31
    learned = load_all()["learned_cv"].fn(spark, sf).collect()
    assert len(learned) == 4 and {(r["auc_mean"], r["auc_std"]) for r in learned} == {(0.77, 0.0141)}
    assert len(seen) == 1 and learned[0]["fold_aucs"] == [0.75, 0.76, 0.77, 0.78, 0.79]


def test_learned_values_are_results(spark, sf, monkeypatch):
    from attrition.plans import q_ml
    monkeypatch.setattr(q_ml, "_REGISTRY", {})
    monkeypatch.setattr(q_ml, "TRAIN_FIT", {"random_forest": {"numTrees": 3, "maxDepth": 3}, "xgboost": {"maxIter": 3}, "lightgbm": {"maxIter": 3}})
    reg = load_all()
    fitted = []
    fit = M.fit_learner
    monkeypatch.setattr(M, "fit_learner", lambda name, *a, **k: (fitted.append(name), fit(name, *a, **k))[1])
    top = reg["top_importances"].fn(spark, sf)
    assert top.count() == 20 and fitted == ["random_forest"]   # and no other learner
    forest = q_ml.models(spark, sf, ["random_forest"])["random_forest"]
    every = reg["learned_importances"].fn(spark, sf).toPandas()
    own = every[every.model_name == "random_forest"].set_index("feature").importance
    for f, v in zip(S.MODEL_FEATURES, forest.featureImportances.toArray()):
        assert abs(own[f] - v) < 1e-5
    boosted = q_ml.models(spark, sf)
    splits = every[every.model_name == "lightgbm"].set_index("feature").importance
    counts = boosted["lightgbm"].nodes.query("feature >= 0").groupby("name").size()
    assert splits.sum() == counts.sum() and all(splits[f] == n for f, n in counts.items())
    gains = boosted["xgboost"].nodes.query("feature >= 0").groupby("name").gain.mean()
    share = every[every.model_name == "xgboost"].set_index("feature").importance
    assert all(abs(share[f] - g / gains.sum()) < 1e-5 for f, g in gains.items()) and len(every) == 78
    p = reg["learned_probabilities"].fn(spark, sf).toPandas()
    assert ((p.p_random_forest + p.p_xgboost + p.p_lightgbm) / 3 - p.p_vote).abs().max() < 1e-5 and p.p_xgboost.between(0, 1).all()
    segments = reg["learned_segments"].fn(spark, sf).toPandas()
    assert (segments.passed <= segments["rows"]).all() and len(fitted) == 3


def test_kept_models_follow_the_input_files(spark, sf, tmp_path, monkeypatch):
    from attrition.plans import q_ml
    monkeypatch.setattr(q_ml, "_REGISTRY", {})
    spark.read.parquet(f"{sf}/customer.parquet").write.parquet(f"{tmp_path}/customer.parquet")
    made = []
    make = lambda: made.append(1) or len(made)
    assert [q_ml._kept(spark, str(tmp_path), "x", make) for _ in range(2)] == [1, 1]
    spark.read.parquet(f"{sf}/customer.parquet").limit(5).write.mode("append").parquet(f"{tmp_path}/customer.parquet")
    assert q_ml._kept(spark, str(tmp_path), "x", make) == 2


def test_cross_validation_scores_every_row_once_out_of_fold(spark, sf):
    sp = R.split_frames(R.stratified_split(I.features(spark, sf), "Churn", "customerID"))
    small = {"random_forest": {"numTrees": 3, "maxDepth": 3}, "xgboost": {"maxIter": 2}, "lightgbm": {"maxIter": 2}}
    aucs = M.cross_validate(sp["train"], S.MODEL_FEATURES, k=3, overrides=small)
    rows = aucs.collect()
    assert len(rows) == 12 and all(0 <= r["roc_auc"] <= 1 for r in rows)
    means = {r["model_name"]: r["auc_mean"] for r in M.cv_summary(aucs).collect()}
    assert set(means) == {*M.LEARNERS, "voting_ensemble"}
