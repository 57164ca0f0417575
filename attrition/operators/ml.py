"""Training, voting, cross-validation, scoring and importances.

Of the three learners of the original pipeline the random forest is Spark ML's; the two
boosters are histogram gradient boosting (:mod:`attrition.operators.boost`),
level by level and leaf by leaf. Class balancing is a weight column; the soft vote
averages class-1 probabilities; scoring is one set-based plan (quarantine ->
store fill -> derive -> align -> assemble -> score -> decide).
"""

from __future__ import annotations

from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Sequence

from pyspark.ml import Model
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..session import cut_lineage, scratch_path
from . import boost as B
from . import clean as P
from . import evaluate as E
from . import sampling as R
from . import store as J

VEC = "features_vec"
#: Rows of a part of the training rows, at least, and at least from ``FEW_PARTS`` parts on: the forest's passes have a
#: task for each part, and each task sends sums for every node of every tree.
PART_ROWS, FEW_PARTS, MORE_ROWS = 10_000, 16, 60_000


def balanced_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """M4: ``n / (k * n_class)`` per row (the 'balanced' class weight).

    The class-count table has one row per class and is broadcast: a shuffle by class would make a task for each class.
    """
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("__nc"))
    n = df.select(F.count(F.lit(1))).scalar()
    k = counts.select(F.count(F.lit(1))).scalar()
    return (df.join(F.broadcast(counts), label).withColumn(out, n / (k * F.col("__nc"))).drop("__nc"))


def positive_weight(df: DataFrame, label: str, weight: float, out: str = "weight") -> DataFrame:
    """Weight ``weight`` on positives, 1 on negatives (``scale_pos_weight``)."""
    return df.withColumn(out, F.when(F.col(label) == 1, F.lit(float(weight))).otherwise(F.lit(1.0)))


def dealt(df: DataFrame) -> DataFrame:
    """More rows than ``PART_ROWS`` in even parts, in an order that only their values give; fewer as they are.

    The forest samples and counts its rows part by part, so a part with most of the rows is a task with
    most of the work; and its samples depend on the parts, which are the same on any cluster."""
    n = df.count()
    parts = min(-(-n // PART_ROWS), max(FEW_PARTS, -(-n // MORE_ROWS)))
    if parts <= 1:
        return df
    keyed = df.withColumn("__h", F.xxhash64(*df.columns))
    return keyed.repartition(parts, "__h").sortWithinPartitions("__h", *df.columns).drop("__h")


def assembler(features: Sequence[str], out: str = VEC) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep")


def random_forest(label: str = "Churn", features_col: str = VEC, seed: int = S.SEED, overrides: dict | None = None):
    """M1: 200 trees, depth 10, at least 2 rows per leaf, balanced weights."""
    o = overrides or {}
    return RandomForestClassifier(
        labelCol=label, featuresCol=features_col, weightCol="w_balanced", probabilityCol="prob_random_forest",
        rawPredictionCol="raw_random_forest", predictionCol="pred_random_forest",
        numTrees=o.get("numTrees", S.RF_PARAMS["n_estimators"]), maxDepth=o.get("maxDepth", S.RF_PARAMS["max_depth"]),
        minInstancesPerNode=S.RF_PARAMS["min_samples_leaf"], featureSubsetStrategy="sqrt", seed=seed)


def boost_params(name: str, overrides: dict | None = None, seed: int = S.SEED) -> B.BoostParams:
    """M2, M3: the boosters' hyper-parameters; what the original leaves open has its libraries' defaults.

    xgboost: 200 rounds, depth 6, step 0.05, rows and columns sampled at 0.8 for each
    tree. lightgbm: 200 rounds, step 0.05, best-first growth to 31 leaves within depth 6."""
    if name == "xgboost":
        x = S.XGB_PARAMS
        p = B.BoostParams(x["n_estimators"], x["learning_rate"], x["max_depth"], row_share=x["subsample"],
                          column_share=x["colsample_bytree"], l2=1.0, min_rows=1, min_hessian=1.0, seed=seed)
    elif name == "lightgbm":
        x = S.LGBM_PARAMS
        p = B.BoostParams(x["n_estimators"], x["learning_rate"], x["max_depth"], x["num_leaves"], l2=0.0, min_rows=20,
                          min_hessian=1e-3, seed=seed)
    else:
        raise ValueError(name)
    return B.with_rounds(p, overrides)


#: The weight column of each booster: positives count three times; classes weigh alike.
BOOST_WEIGHT = {"xgboost": "w_pos", "lightgbm": "w_balanced"}


def boost_fits(df: DataFrame, names: Sequence[str], features: Sequence[str], label: str, folds: Sequence[int | None] = (None,),
               overrides: dict | None = None, row_key: Column | None = None, fold: str | None = None,
               key: str | None = None) -> B.Training:
    """The named boosters' fits, each without one of ``folds`` (None: on all rows), in one training loop.

    The second-order booster cuts its bins by the hessian, the other by rows."""
    fits = [B.Fit(n if f is None else f"{n}_{f}", boost_params(n, (overrides or {}).get(n)), BOOST_WEIGHT[n], f,
                  BOOST_WEIGHT[n] if n == "xgboost" else None) for n in names for f in folds]
    return B.fit_together(df.withColumn("__x", vector_to_array(VEC)), "__x", features, label, fits, row_key, fold, key)


def fit_learner(name: str, df: DataFrame, features: Sequence[str], label: str = "Churn", overrides: dict | None = None,
                id_col: str | None = None, together: Future | None = None):
    """Fit one learner on assembled and weighted rows, or take it from the loop that fits the boosters ``together``."""
    if name == "random_forest":
        return random_forest(label, overrides=overrides).fit(df)
    if together is not None:
        return together.result().models[name]
    row_key = F.xxhash64(id_col, vector_to_array(VEC)) if id_col else None
    return boost_fits(df, [name], features, label, overrides={name: overrides}, row_key=row_key).models[name]


def with_training_weights(df: DataFrame, label: str = "Churn") -> DataFrame:
    return positive_weight(balanced_weights(df, label, "w_balanced"), label, S.XGB_PARAMS["scale_pos_weight"], "w_pos")


def p1(name: str) -> Column:
    """Class-1 probability of a named model's output."""
    return vector_to_array(F.col(f"prob_{name}")).getItem(1)


def soft_vote(df: DataFrame, cols: Sequence[str], out: str = "p_vote") -> DataFrame:
    """M5: the mean of the given class-1 probabilities."""
    return df.withColumn(out, sum(F.col(c) for c in cols) / F.lit(float(len(cols))))


def score_with(models: dict, df: DataFrame, vote: Sequence[str] | None = None) -> DataFrame:
    """Apply fitted models in turn; adds ``p_<name>`` and, when ``vote`` is
    given, ``p_vote`` = mean of their class-1 probabilities (M5)."""
    out = df
    for name, m in models.items():
        if isinstance(m, B.BoostedTrees):
            out = m.score(out, vector_to_array(F.col(VEC)), f"p_{name}")
        else:
            out = m.transform(out).withColumn(f"p_{name}", p1(name)).drop(f"prob_{name}", f"raw_{name}", f"pred_{name}")
    return soft_vote(out, [f"p_{n}" for n in vote]) if vote else out


def split_metrics(scored: DataFrame, label: str, p: str, prefix: str, scale: int | None = 4) -> DataFrame:
    """AUC, accuracy, F1, precision, recall of one split, rounded to ``scale``
    places (as logged) or, with None, in full precision."""
    d = scored.withColumn("__pred", (F.col(p) >= S.DECISION_THRESHOLD).cast("int"))
    cm = E.confusion_metrics(d, label, "__pred", scale=scale)
    auc = E.roc_auc(d, label, p, scale=scale).select("roc_auc").scalar()
    cols = ["roc_auc", "accuracy", "f1", "precision", "recall"]
    wide = cm.select("accuracy", "f1", "precision", "recall", auc.alias("roc_auc"))
    return wide.select(*[F.col(c).cast("double").alias(f"{prefix}_{c}") for c in cols])


def cross_validate(df: DataFrame, features: Sequence[str], label: str = "Churn", id_col: str = "customerID",
                   k: int = S.CV_FOLDS, overrides: dict | None = None) -> DataFrame:
    """M6: model_name, fold, roc_auc of k stratified folds, for each learner and their soft vote.

    Each booster's k fits share one training loop, in which a row's margin under the fit that
    has not seen it is its out-of-fold score; the forest's fits and the two loops run side by side. The
    AUCs are exact, all of them from one prefix sum with learner and fold as groups."""
    data = assembler(features).transform(dealt(with_training_weights(R.assign_folds(df, label, id_col, k), label)))
    data = cut_lineage(data.select(id_col, label, "fold", "w_balanced", "w_pos", VEC)
                       .withColumn("__key", F.monotonically_increasing_id()))
    folds = range(k)

    def forest() -> DataFrame:
        out = None
        for f in folds:
            m = random_forest(label, overrides=(overrides or {}).get("random_forest")).fit(data.filter(F.col("fold") != f))
            part = m.transform(data.filter(F.col("fold") == f)).select("__key", p1("random_forest").alias("p_random_forest"))
            out = part if out is None else out.unionAll(part)
        return cut_lineage(out)

    def boosters() -> DataFrame:
        names = [n for n in LEARNERS if n in BOOST_WEIGHT]
        done = boost_fits(data, names, features, label, list(folds), overrides,
                          F.xxhash64(id_col, vector_to_array(VEC)), "fold", "__key").margins()
        own = {n: F.coalesce(*[F.when(F.col("fold") == f, F.col(f"{n}_{f}")) for f in folds]) for n in names}
        return done.select(F.col("key").alias("__key"), *[(1 / (1 + F.exp(-m))).alias(f"p_{n}") for n, m in own.items()])

    with ThreadPoolExecutor(max_workers=2) as pool:
        parts = [x.result() for x in [pool.submit(forest), pool.submit(boosters)]]
    scored = data.select("__key", "fold", label)
    for part in parts:
        scored = scored.join(part, "__key")
    scored = soft_vote(scored, [f"p_{n}" for n in LEARNERS], "p_voting_ensemble")
    names = [*LEARNERS, "voting_ensemble"]
    long = scored.select("fold", label, F.explode(F.array(*[
        F.struct(F.lit(n).alias("model_name"), F.col(f"p_{n}").alias("p")) for n in names])).alias("s")) \
        .select("fold", label, "s.*")
    return E.roc_auc(long, label, "p", scale=None, by=["model_name", "fold"]).select("model_name", "fold", "roc_auc")


def cv_summary(aucs: DataFrame, scale: int = 4) -> DataFrame:
    """model_name, auc_mean, auc_std (population) over the folds."""
    return aucs.groupBy("model_name").agg(F.round(F.avg("roc_auc"), scale).alias("auc_mean"),
                                          F.round(F.stddev_pop("roc_auc"), scale).alias("auc_std"))


def forest_nodes(spark, path: str, names: Sequence[str]) -> DataFrame:
    """tree, node, name, gain and weighted rows of the inner nodes of a saved forest."""
    n = F.col("nodeData")
    nodes = spark.read.parquet(f"{path}/data").filter(n["split"]["featureIndex"] >= 0)
    count = F.aggregate(n["impurityStats"], F.lit(0.0), lambda a, x: a + x)
    return nodes.select(F.col("treeID").alias("tree"), n["id"].alias("node"), n["split"]["featureIndex"].alias("feature"),
                        F.array(*map(F.lit, names))[n["split"]["featureIndex"]].alias("name"),
                        n["gain"].alias("gain"), count.alias("cover"))


def importance_table(model, names: Sequence[str], spark, saved: str | None = None) -> DataFrame:
    """Feature, importance of every feature, aggregated from the model's node table.

    The forest: each tree's impurity decrease by feature (gain x rows) as a share, averaged over trees. The
    second-order booster: the share of the mean gain of a feature's splits. The leaf-wise
    booster: the number of its splits."""
    if isinstance(model, B.BoostedTrees):
        found = B.importances(model.node_table(spark), model.kind)
    else:
        if saved is None:
            saved = scratch_path(spark, "forest")
            model.write().overwrite().save(saved)
        nodes = forest_nodes(spark, saved, names).groupBy("tree", "name").agg(F.sum(F.col("gain") * F.col("cover")).alias("g"))
        totals = nodes.groupBy("tree").agg(F.sum("g").alias("t"))
        share = nodes.join(totals, "tree").filter("t > 0").groupBy(F.col("name").alias("feature")).agg(
            F.sum(F.col("g") / F.col("t")).alias("s"))
        found = share.select("feature", (F.col("s") / share.agg(F.sum("s")).scalar()).alias("importance"))
    every = spark.createDataFrame([(n,) for n in names], "feature string")
    return every.join(found, "feature", "left").select("feature", F.coalesce("importance", F.lit(0.0)).alias("importance"))


def importances(model, names: Sequence[str], n: int | None = 20, scale: int = 6, spark=None, saved: str | None = None) -> list:
    """T4: (feature, importance) of a tree model, descending, top ``n``; with
    ``n=None`` every feature (E6). One row per feature at most (bounded by the schema)."""
    from pyspark.sql import SparkSession
    table = importance_table(model, names, spark or SparkSession.active(), saved)
    top = table.select("feature", F.round("importance", scale).alias("importance")).orderBy(F.desc("importance"), "feature")
    return [tuple(r) for r in (top.limit(n) if n else top).collect()]


def persist_model(model, path: str, spark=None):
    """Save a fitted model (Spark ML persistence, or the booster's node table) and return the reloaded copy."""
    if isinstance(model, B.BoostedTrees):
        from pyspark.sql import SparkSession
        spark = spark or SparkSession.active()
        model.save(spark, path)
        return B.BoostedTrees.load(spark, path)
    model.write().overwrite().save(path)
    return type(model).load(path)


@dataclass
class TrainResult:
    models: dict
    metrics: DataFrame
    best: str
    features: list = field(default_factory=list)
    reports: DataFrame | None = None        # classification report per model (test split)
    importances: dict = field(default_factory=dict)   # top 20 per learner


#: The learners in training order; the first trained wins ties.
LEARNERS = ["random_forest", "xgboost", "lightgbm"]


def fit_learners(train: DataFrame, features: Sequence[str], label: str = "Churn", overrides: dict | None = None,
                 save_to: str | None = None, names: Sequence[str] = tuple(LEARNERS), id_col: str | None = None) -> dict:
    """Fit the named learners, the forest beside one loop of all boosters (small jobs, bound by their latency);
    with ``save_to`` they are saved there and the reloaded copies are returned."""
    spark = train.sparkSession
    id_col = id_col if id_col in train.columns else None
    rows = with_training_weights(train, label)
    tr = assembler(features).transform(dealt(rows) if "random_forest" in names else rows).cache()

    boosted = [n for n in names if n in BOOST_WEIGHT]
    row_key = F.xxhash64(id_col, vector_to_array(VEC)) if id_col else None
    with ThreadPoolExecutor(max_workers=len(names) + 1) as pool:
        loop = pool.submit(boost_fits, tr, boosted, features, label, overrides=overrides, row_key=row_key) if boosted else None

        def fit(n: str):
            m = fit_learner(n, tr, features, label, (overrides or {}).get(n), id_col, loop)
            return persist_model(m, f"{save_to.rstrip('/')}/{n}", spark) if save_to else m

        models = dict(zip(names, pool.map(fit, names)))
    tr.unpersist()
    return models


def train_all(train: DataFrame, val: DataFrame, test: DataFrame, features: Sequence[str] = S.MODEL_FEATURES,
              label: str = "Churn", run_id: str = "train", overrides: dict | None = None,
              save_to: str | None = None, cv_folds: int = 0, cv_overrides: dict | None = None,
              id_col: str = "customerID", models: dict | None = None) -> TrainResult:
    """M7: fit the three learners, score every split, log metrics long,
    add the soft vote, pick the best model by validation AUC (full precision;
    the first trained wins ties). Classification reports (test split) and the
    top 20 importances come per model. With ``cv_folds`` the stratified
    cross-validation of every learner and the vote on the training split is
    logged as ``cv_auc_mean`` / ``cv_auc_std``; ``cv_overrides`` are its
    hyper-parameters (default: those of the fit). ``models`` are fits that exist already.

    With ``save_to`` every model is saved with Spark ML persistence and the
    reloaded copy is used (it carries no training summary, so it holds no
    reference to the session); the feature list and the name of the best model
    are written beside them."""
    asm, names = assembler(features), LEARNERS
    if models is None:
        models = fit_learners(train, features, label, overrides, save_to, id_col=id_col)
    # five metrics per model and split and a report per model: a few rows each
    spark = train.sparkSession
    rows, reports, val_auc = [], [], {}
    for split_name, df in (("train", train), ("val", val), ("test", test)):
        scored = score_with(models, asm.transform(df), vote=names).cache()
        for n in [*names, "vote"]:
            name = "voting_ensemble" if n == "vote" else n
            m = split_metrics(scored, label, f"p_{n}", split_name, scale=None).first().asDict()
            rows += [(run_id, name, k, None if v is None else round(v, 4)) for k, v in m.items()]
            if split_name == "val":
                val_auc[name] = m["val_roc_auc"] if m["val_roc_auc"] is not None else -1.0
            if split_name == "test":
                pred = scored.withColumn("__pred", (F.col(f"p_{n}") >= S.DECISION_THRESHOLD).cast("int"))
                report = E.classification_report(pred, label, "__pred")
                columns = ["model_name", *report.columns]
                reports += [(name, *r) for r in report.collect()]
                report_schema = "model_name string, " + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in report.schema)
        scored.unpersist()
    if cv_folds:
        for r in cv_summary(cross_validate(train, features, label, id_col, cv_folds, cv_overrides or overrides)).collect():
            rows += [(run_id, r["model_name"], "cv_auc_mean", r["auc_mean"]), (run_id, r["model_name"], "cv_auc_std", r["auc_std"])]
    metrics = spark.createDataFrame(rows, "run_id string, model_name string, metric_name string, metric_value double")
    best = max(val_auc, key=val_auc.get)   # in training order: the first of equal ones
    if save_to:
        record = spark.createDataFrame([(best, list(features))], "best_model string, features array<string>")
        record.coalesce(1).write.mode("overwrite").json(f"{save_to.rstrip('/')}/record")
    return TrainResult(models, metrics, best, list(features), spark.createDataFrame(reports, report_schema).select(*columns),
                       {n: importances(models[n], features, spark=spark, saved=f"{save_to.rstrip('/')}/{n}" if save_to else None)
                        for n in names})


def score_all(requests: DataFrame, models: dict, features: Sequence[str] = S.MODEL_FEATURES,
              store: DataFrame | None = None, vote: Sequence[str] | None = None, model_name: str = "churn_classifier",
              model_version: str = "1", key: str = "customerID") -> DataFrame:
    """M8: every request comes back: the columns it has besides the features,
    ``status`` (scored or rejected), ``violations`` (the rules a rejected one
    breaks, else empty) and the result columns (null where rejected). One
    pass over the requests, so it also runs on a stream."""
    rejected = P.is_rejected()
    tagged = requests.withColumns({
        "status": F.when(rejected, F.lit("rejected")).otherwise(F.lit("scored")),
        "violations": F.when(rejected, P.violations()).otherwise(F.array().cast("array<string>"))})
    if store is not None:
        tagged = J.fill_from_store(tagged, store, key, features)
    tagged = P.derive_missing(tagged)
    ready = P.align_columns(tagged, features, fill=0, keep=[c for c in tagged.columns if c not in features])
    scored = score_with(models, assembler(features).transform(ready), vote=vote)
    pcol = "p_vote" if vote else f"p_{list(models)[0]}"
    out = (scored.withColumn("churn_probability", F.when(F.col("status") == "scored", F.col(pcol)))
                 .transform(P.with_risk_level)
                 .transform(P.decide_label)
                 .withColumn("model_name", F.lit(model_name))
                 .withColumn("model_version", F.lit(model_version)))
    results = ["churn_probability", "churn_probability_rounded", "churn_prediction", "churn_label", "risk_level"]
    keep = [c for c in requests.columns if c not in features]
    return out.select(*keep, "status", "violations",
                      *[F.when(F.col("status") == "scored", F.col(c)).alias(c) for c in results],
                      "model_name", "model_version")


def score(requests: DataFrame, models: dict, features: Sequence[str] = S.MODEL_FEATURES,
          store: DataFrame | None = None, vote: Sequence[str] | None = None, model_name: str = "churn_classifier",
          model_version: str = "1", key: str = "customerID") -> tuple[DataFrame, DataFrame]:
    """M8 in two frames: (scored, rejected with ``violations``)."""
    every = score_all(requests, models, features, store, vote, model_name, model_version, key)
    return every.filter("status = 'scored'").drop("status", "violations"), P.range_quarantine(requests)[1]
