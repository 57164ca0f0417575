"""Histogram boosting: trees against plain growth and DuckDB, sampling, folds, missing values."""

from dataclasses import replace

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import check_oracle as CO
from attrition import schemas as S
from attrition.operators import boost as B
from attrition.operators import ml as M
from attrition.plans import q_ml

FEATURES = ["a", "b", "c"]


def _table(spark, n=400, seed=1, missing=False):
    rng = np.random.default_rng(seed)
    a, b, c = rng.integers(0, 12, n), rng.integers(0, 2, n), rng.integers(0, 30, n)
    y = (rng.random(n) < 1 / (1 + np.exp(-(0.5 * a - 3 + 2 * b * (c > 14))))).astype(int)
    rows = [(i, [float(v) if not (missing and v == 3) else None for v in x], int(t), float(1 + t), int(i % 4))
            for i, (x, t) in enumerate(zip(zip(a, b, c), y))]
    return spark.createDataFrame(rows, "id bigint, x array<double>, y int, w double, fold int")


def _plain_tree(x, g, h, p):
    """One tree, one best split at a time; lists of (path, feature, threshold) in the order of the splits."""
    leaves, out = {"": np.arange(len(x))}, []
    lam, limit = p.l2 * B.SCALE, p.max_leaves or 10 ** 9

    def best(rows):
        top, gt, ht = None, g[rows].sum(), h[rows].sum()
        for f in range(x.shape[1]):
            for v in np.unique(x[rows, f]):
                left = x[rows, f] <= v
                n, gl, hl = left.sum(), g[rows][left].sum(), h[rows][left].sum()
                if min(n, len(rows) - n) < max(1, p.min_rows) or min(hl, ht - hl) < p.min_hessian * B.SCALE:
                    continue
                gain = float(gl) ** 2 / (hl + lam) + float(gt - gl) ** 2 / (ht - hl + lam) - float(gt) ** 2 / (ht + lam)
                if gain > 0 and (top is None or gain > top[0]):
                    top = (gain, f, v)
        return top

    found = {"": best(leaves[""])}
    while len(leaves) < limit:
        able = [(s[0], path) for path, s in found.items() if s and len(path) < p.max_depth]
        if not able:
            break
        path = max(able)[1]
        _, f, v = found.pop(path)
        rows = leaves.pop(path)
        left = x[rows, f] <= v
        out.append((path, f, v))
        for k, part in (("l", rows[left]), ("r", rows[~left])):
            leaves[path + k] = part
            found[path + k] = best(part)
    return out


def _paths(nodes):
    paths, out = {0: ""}, []
    for r in nodes.itertuples():
        if r.feature >= 0:
            paths[r.left], paths[r.right] = paths[r.node] + "l", paths[r.node] + "r"
            out.append((paths[r.node], r.feature, r.threshold))
    return out


@pytest.mark.parametrize("params", [
    B.BoostParams(rounds=1, max_depth=4), B.BoostParams(rounds=1, max_depth=5, max_leaves=6, l2=0.0, min_rows=10, min_hessian=1e-3),
    B.BoostParams(rounds=1, max_depth=9, max_leaves=11, l2=0.0, min_rows=3), B.BoostParams(rounds=1, max_depth=1),
    B.BoostParams(rounds=1, max_depth=3, min_rows=500)])
def test_first_tree_equals_plain_growth(spark, params):
    df = _table(spark)
    model = B.fit_together(df, "x", FEATURES, "y", [B.Fit("m", params, "w")]).models["m"]
    pdf = df.orderBy("id").toPandas()
    x, y, w = np.array(pdf.x.tolist()), pdf.y.to_numpy(), pdf.w.to_numpy()
    p = 1 / (1 + np.exp(-model.start))
    g, h = np.rint((p - y) * w * B.SCALE).astype(np.int64), np.rint(np.full(len(y), p * (1 - p)) * w * B.SCALE).astype(np.int64)
    assert sorted(_paths(model.nodes)) == sorted(_plain_tree(x, g, h, params))
    leaves = model.nodes[model.nodes.feature < 0]
    assert leaves["rows"].sum() == len(y) and (not params.max_leaves or len(leaves) <= params.max_leaves)


def test_fits_do_not_depend_on_partitions_or_company(spark, monkeypatch):
    monkeypatch.setattr(B, "REFRESH", 2)
    df, p = _table(spark), B.BoostParams(rounds=5, max_depth=3, row_share=0.7, column_share=0.7)
    q = replace(p, max_leaves=5, min_rows=7, column_share=1.0)
    both = B.fit_together(df.repartition(5), "x", FEATURES, "y", [B.Fit("p", p, "w"), B.Fit("q", q, "w")], F.xxhash64("id"))
    monkeypatch.setattr(B, "PART_ROWS", 90)
    one = B.fit_together(df.repartition(7), "x", FEATURES, "y", [B.Fit("p", p, "w")], F.xxhash64("id"))
    assert both.models["p"].nodes.equals(one.models["p"].nodes) and both.models["q"].nodes.tree.max() == 4


def test_a_pass_is_one_job_of_one_stage(spark, monkeypatch):
    monkeypatch.setattr(B, "PART_ROWS", 90)
    run, tracker, seen = B.Booster._pass, spark.sparkContext.statusTracker(), []

    def counted(self, growers):
        group = f"boost-pass-{len(seen)}"
        spark.sparkContext.setJobGroup(group, "")
        out = run(self, growers)
        seen.append([len(tracker.getJobInfo(j).stageIds) for j in tracker.getJobIdsForGroup(group)])
        return out

    monkeypatch.setattr(B.Booster, "_pass", counted)
    try:
        B.fit_together(_table(spark), "x", FEATURES, "y", [B.Fit("m", B.BoostParams(rounds=4, max_depth=3), "w")])
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(seen) == 12 and all(jobs == [1] for jobs in seen[1:])   # the first one makes and checkpoints the blocks


def test_features_counted_as_one_give_the_same_trees(spark, monkeypatch):
    df, p = _table(spark, missing=True), B.BoostParams(rounds=3, max_depth=4)
    assert B.feature_groups([13, 3, 31, 256, 3, 256]) == [[1, 4, 0], [2], [3], [5]]
    trees = []
    for most in (1, 1024, 1 << 15):
        monkeypatch.setattr(B, "GROUP_BINS", most)
        trees.append(B.fit_together(df, "x", FEATURES, "y", [B.Fit("m", p, "w")]).models["m"].nodes)
    assert trees[0].equals(trees[1]) and trees[0].equals(trees[2])


def test_training_rows_are_dealt_evenly_and_alike(spark, monkeypatch):
    monkeypatch.setattr(M, "PART_ROWS", 100)
    df = _table(spark, 1000)
    one, two = (M.dealt(d).withColumn("part", F.spark_partition_id()).toPandas() for d in (df.coalesce(1), df.repartition(7)))
    assert one.astype(str).equals(two.astype(str)) and len(one) == 1000
    assert one.groupby("part").size().between(50, 150).all() and one.part.nunique() == 10


def test_held_folds_are_not_learned_from_and_margins_are_out_of_fold(spark):
    df, p = _table(spark), B.BoostParams(rounds=3, max_depth=3)
    cv = B.fit_together(df, "x", FEATURES, "y", [B.Fit(f"f{k}", p, "w", k) for k in range(4)], F.xxhash64("id"), "fold", "id")
    margins = cv.margins().toPandas().sort_values("key")
    x = np.array(df.orderBy("id").toPandas().x.tolist())
    for k in range(4):
        alone = B.fit_together(df.filter(F.col("fold") != k), "x", FEATURES, "y", [B.Fit("m", p, "w")], F.xxhash64("id")).models["m"]
        assert np.allclose(alone.margin(x), cv.models[f"f{k}"].margin(x))   # few values: the same bins
        assert np.allclose(margins[f"f{k}"], alone.margin(x))


def test_rows_and_columns_are_sampled_anew_for_each_tree():
    p = B.BoostParams(row_share=0.8, column_share=0.8)
    keys = np.arange(20_000).astype(np.uint64)
    rows = [B.sampled_rows(keys, p, t) for t in range(4)]
    assert all(abs(r.mean() - 0.8) < 0.01 for r in rows) and abs((rows[0] & rows[1]).mean() - 0.64) < 0.01
    columns = [B.sampled_columns(26, p, t) for t in range(50)]
    assert {int(c.sum()) for c in columns} == {20} and len({tuple(c) for c in columns}) > 20
    assert B.sampled_rows(keys, B.BoostParams(), 0).all()


def test_grown_trees_use_their_samples(spark):
    df, p = _table(spark), B.BoostParams(rounds=6, max_depth=2, row_share=0.5, column_share=0.34)
    model = B.fit_together(df, "x", FEATURES, "y", [B.Fit("m", p, "w")], F.col("id")).models["m"]
    for t, nodes in model.nodes.groupby("tree"):
        assert nodes["rows"].iloc[0] == B.sampled_rows(np.arange(400).astype(np.uint64), p, t).sum()
        used = set(nodes.feature[nodes.feature >= 0])
        assert used <= set(np.flatnonzero(B.sampled_columns(3, p, t)).tolist()) and len(used) <= 1


def test_missing_values_learn_their_side(spark):
    rows = [(i, [None if i % 3 == 0 else float(i % 3)], int(i % 3 != 1)) for i in range(300)]   # missing goes with 2
    df = spark.createDataFrame(rows, "id bigint, x array<double>, y int").withColumn("w", F.lit(1.0))
    model = B.fit_together(df, "x", ["a"], "y", [B.Fit("m", B.BoostParams(rounds=1, max_depth=1), "w")]).models["m"]
    root = model.nodes.iloc[0]
    assert root.threshold == 1.0 and not root.missing_left
    m = model.margin(np.array([[np.nan], [1.0], [2.0]]))
    assert m[0] == m[2] > m[1]
    turned = df.withColumn("y", (F.col("id") % 3 == 2).cast("int"))
    root = B.fit_together(turned, "x", ["a"], "y", [B.Fit("m", B.BoostParams(rounds=1, max_depth=1), "w")]).models["m"].nodes.iloc[0]
    assert root.threshold == 1.0 and root.missing_left


def test_bins_are_weighted_quantiles(spark):
    df = spark.range(1000).select(F.array(F.col("id").cast("double"), F.lit(1.0), F.lit(None).cast("double")).alias("x"),
                                  F.when(F.col("id") < 100, 9.0).otherwise(1.0).alias("w"))
    edges = B.bin_edges(df, "x", 3, F.col("w"), 10)
    assert [len(e) for e in edges] == [10, 1, 0]
    below = np.array([9 * min(v + 1, 100) + max(0, v - 99) for v in edges[0]])
    assert np.abs(np.diff(np.concatenate(([0], below))) - 180).max() <= 9
    assert (B.binned(np.array([[0.0, 1.0, np.nan], [5000.0, 2.0, 1.0]]), edges) == [[1, 1, 0], [10, 1, 0]]).all()


def test_saved_models_score_alike(spark, tmp_path):
    df = _table(spark, missing=True)
    model = B.fit_together(df, "x", FEATURES, "y", [B.Fit("m", B.BoostParams(rounds=4, max_leaves=6, min_rows=5), "w")]).models["m"]
    model.save(spark, str(tmp_path / "m"))
    again = B.BoostedTrees.load(spark, str(tmp_path / "m"))
    one, two = (m.score(df, F.col("x"), "p").orderBy("id").toPandas().p for m in (model, again))
    assert (one == two).all() and one.between(0, 1).all() and again.kind == "splits"
    counts = {r["feature"]: r["importance"] for r in B.importances(again.node_table(spark), "splits").collect()}
    assert sum(counts.values()) == (model.nodes.feature >= 0).sum()


@pytest.mark.parametrize("rows", [[], [(1, [1.0], 1, 1.0)], [(i, [1.0], 0, 1.0) for i in range(5)], [(i, [None], i % 2, 1.0) for i in range(6)]])
def test_odd_tables(spark, rows):
    df = spark.createDataFrame(rows, "id bigint, x array<double>, y int, w double")
    model = B.fit_together(df, "x", ["a"], "y", [B.Fit("m", B.BoostParams(rounds=2), "w")]).models["m"]
    assert np.isfinite(model.margin(np.array([[1.0], [np.nan]]))).all() and (model.nodes.feature < 0).all()


@pytest.mark.parametrize("leaves", [4, 9, 31])
def test_best_first_tree_equals_duckdb(spark, sf, leaves, monkeypatch):
    params = replace(M.boost_params("lightgbm"), max_leaves=leaves, min_rows=3)
    monkeypatch.setattr(q_ml.M, "boost_params", lambda name: params)
    con = duckdb.connect()
    for t in CO.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    want = con.execute(q_ml._tree_sql(leaves, params.max_depth, params.l2, params.min_rows, params.min_hessian, q_ml.WEIGHT_SQL)).df()
    got = q_ml._first_tree(spark, sf, "lightgbm").toPandas()
    assert CO.compare(got, want) == "ok" and len(got) <= leaves - 1


def test_boosting_ranks_as_well_as_first_order_trees(spark):
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector
    from attrition.operators import evaluate as E
    train, test = _table(spark, 1500, 2), _table(spark, 1500, 3)
    fits = [B.Fit("level", B.BoostParams(rounds=20, step=0.1, max_depth=5), "w"),
            B.Fit("leaf", B.BoostParams(rounds=20, step=0.1, max_depth=6, max_leaves=31, l2=0.0, min_rows=20), "w")]
    models = B.fit_together(train, "x", FEATURES, "y", fits).models
    vec = lambda d: d.withColumn("v", array_to_vector("x"))
    first = GBTClassifier(labelCol="y", featuresCol="v", maxIter=20, maxDepth=5, stepSize=0.1, weightCol="w").fit(vec(train)).transform(vec(test))
    base = E.roc_auc(first.withColumn("p", M.vector_to_array("probability")[1]), "y", "p").first()["roc_auc"]
    for m in models.values():
        assert E.roc_auc(m.score(test, F.col("x"), "p"), "y", "p").first()["roc_auc"] > base - 0.01


def test_churn_features_fit_the_bins():
    assert len(S.MODEL_FEATURES) == 26 and B.MAX_BINS < 256


def test_boosters_of_different_cuts_share_their_passes(spark, monkeypatch):
    from attrition.operators.ml import boost_fits, fit_learners, with_training_weights, assembler
    rows = [(f"c{i}", i % 400, float(i * 7 % 330), int(i * 31 % 100 < 30 + i % 40)) for i in range(900)]
    df = spark.createDataFrame(rows, "id string, a int, b double, y int")
    passes, run = [], B.Booster._pass
    monkeypatch.setattr(B.Booster, "_pass", lambda self, growers: passes.append([f.name for f in self.fits]) or run(self, growers))
    few, names = {"maxIter": 3}, ["xgboost", "lightgbm"]
    both = fit_learners(df, ["a", "b"], "y", {n: few for n in names}, names=names, id_col="id")
    assert len(passes) <= 18 and all(p == names for p in passes)
    data = assembler(["a", "b"]).transform(with_training_weights(df, "y"))
    for n in names:
        own = boost_fits(data, [n], ["a", "b"], "y", overrides={n: few}, row_key=F.xxhash64("id", M.vector_to_array(M.VEC)))
        assert own.models[n].nodes.equals(both[n].nodes)


def _walked(model, x):
    out = np.full(len(x), model.start)
    for _, t in model.nodes.groupby("tree"):
        rows = t.set_index("node").to_dict("index")
        for i, v in enumerate(x):
            r = rows[0]
            while r["feature"] >= 0:
                at = v[int(r["feature"])]
                left = bool(r["missing_left"]) if np.isnan(at) else at <= r["threshold"]
                r = rows[r["left"] if left else r["right"]]
            out[i] += r["value"]
    return out


@pytest.mark.parametrize("params", [B.BoostParams(rounds=4, max_depth=5), B.BoostParams(rounds=3, max_depth=9, min_hessian=0.0, l2=0.1)])
def test_margins_are_those_of_walked_trees(spark, params):
    """Of small trees (by bits of their leaves) and of trees of more than 64 leaves, with missing and unseen values."""
    df = _table(spark, 900, missing=True)
    done = B.fit_together(df, "x", FEATURES, "y", [B.Fit("m", params, "w")], key="id")
    model = done.models["m"]
    assert (model.nodes[model.nodes.feature < 0].groupby("tree").size().max() > 64) == (params.max_depth > 6)
    x = np.array(df.orderBy("id").toPandas().x.map(list).tolist(), float)
    odd = np.vstack([x, [[-1.0, 0.5, 99.0], [np.nan] * 3, [4.5, np.nan, 14.5]]])
    assert (model.margin(odd) == _walked(model, odd)).all()
    assert (done.margins().toPandas().sort_values("key")["m"].to_numpy() == model.margin(x)).all()


def test_blocks_hold_little_more_than_codes_and_margins(spark):
    loop = B.Booster(_table(spark), "x", FEATURES, "y", [B.Fit("m", B.BoostParams(), "w")], fold="fold")
    b = loop.blocks.first()
    assert b.key is None and b.row is None and b.kind.itemsize == 1 and b.kinds.shape[1] == 8   # two labels by four folds
    assert sum(c.itemsize for c in b.codes[0]) <= 3


def test_class_weights_are_joined_without_a_shuffle_by_class(spark):
    df = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(90)], "id int, y int").checkpoint()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = M.balanced_weights(df, "y")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_the_forest_has_few_large_parts(spark, monkeypatch):
    monkeypatch.setattr(M, "PART_ROWS", 10)
    monkeypatch.setattr(M, "MORE_ROWS", 60)
    parts = [M.dealt(spark.range(n)).rdd.getNumPartitions() for n in (100, 200, 900, 1200)]
    assert parts == [10, 16, 16, 20]


def test_splits_are_ranked_once(spark, sf, monkeypatch):
    calls, run = [], q_ml.R.stratified_split
    monkeypatch.setattr(q_ml, "_REGISTRY", {})
    monkeypatch.setattr(q_ml.R, "stratified_split", lambda *a, **k: calls.append(1) or run(*a, **k))
    one, two = q_ml.splits(spark, sf), q_ml.splits(spark, sf)
    assert len(calls) == 1 and one["test"].exceptAll(two["test"]).count() == 0
    want = run(q_ml.I.features(spark, sf), "Churn", "customerID", S.TEST_SIZE, S.VAL_SIZE, S.SEED)
    got = one["train"].unionByName(one["val"]).unionByName(one["test"])
    assert got.exceptAll(want.drop("split")).count() == 0 and got.count() == want.count()
