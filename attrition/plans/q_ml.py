"""Queries for training, scoring and model reports.

Model fitting is deterministic at a fixed seed. Each learner is fitted and
kept on its own, so a query fits only the learners it needs; kept models are
known by application and by the files of the input table, so a changed table
is trained on anew.

A model's numbers depend on its learner, which SQL does not have. So the
queries with an oracle return, for every row or metric, what SQL can decide
(which rows are in the split, which requests are rejected and why, how many
rows a segment has, the AUC of a fixed rule that the learner must beat) beside
checks of the model's output that must all be true. What was learned comes from the
``learned_*`` queries (probabilities, fold AUCs with mean and deviation,
importances, passed counts, metrics), which have no oracle. ``*_first_tree`` grow
one tree on the training split, which DuckDB grows too, node by node.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import boost as B
from ..operators import clean as P
from ..operators import evaluate as E
from ..operators import ml as M
from ..operators import sampling as R
from ..operators import smote as SM
from ..session import cut_lineage, scratch_path
from ..sources.views import table_path
from . import inputs as I
from .catalog import query
from .oracle_sql import with_views

_REGISTRY: dict[tuple, object] = {}
#: Hyper-parameters of the training run other than the original's (none; tests fit fewer rounds).
TRAIN_FIT: dict | None = None
#: The same for the cross-validation.
CV_FIT: dict | None = None


def _kept(spark, sf, what, make):
    """``make()``, kept while the files of the customer table stay the same."""
    files = F.xxhash64("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
    state = spark.read.parquet(table_path(sf, "customer")).select(files.alias("f")).distinct().agg(F.bit_xor("f")).first()[0]
    key = (spark.sparkContext.applicationId, what, sf, state, repr(TRAIN_FIT), repr(CV_FIT))
    if key not in _REGISTRY:
        _REGISTRY[key] = make()
    return _REGISTRY[key]


def made_features(spark, sf):
    """The feature table, made once and kept: splits, store lookups and segments read it."""
    return _kept(spark, sf, "features", lambda: cut_lineage(I.spread_features(spark, sf)))


def splits(spark, sf):
    """The three splits, ranked once."""
    return R.split_frames(_kept(spark, sf, "split", lambda: cut_lineage(R.stratified_split(
        made_features(spark, sf), "Churn", "customerID", S.TEST_SIZE, S.VAL_SIZE, S.SEED))))


def resampled(spark, sf):
    """Training split plus SMOTE rows (minority to 0.7 x majority), as the
    original trains; the resampled set is written once to the shared
    checkpoint folder so training reads a fixed input."""
    def make():
        tr = splits(spark, sf)["train"]
        return SM.smote(tr, "Churn", S.MODEL_FEATURES, "customerID", S.SMOTE_RATIO, S.SMOTE_K, S.SEED).checkpoint(eager=True)
    return _kept(spark, sf, "smote", make)


def models(spark, sf, names=tuple(M.LEARNERS)) -> dict:
    """The named learners, fitted on the resampled training split; those not kept yet are fitted side by side."""
    folder = _kept(spark, sf, "folder", lambda: scratch_path(spark, "models"))
    known = _kept(spark, sf, "models", dict)
    new = [n for n in names if n not in known]
    if new:
        train = resampled(spark, sf).drop("is_synthetic")
        known.update(M.fit_learners(train, S.MODEL_FEATURES, overrides=TRAIN_FIT, save_to=folder, names=new, id_col="customerID"))
    return {n: known[n] for n in names}


def trained(spark, sf) -> M.TrainResult:
    def make():
        sp = splits(spark, sf)
        return M.train_all(resampled(spark, sf).drop("is_synthetic"), sp["val"], sp["test"], run_id="train-run",
                           models=models(spark, sf))
    return _kept(spark, sf, "train_all", make)


def test_scores(spark, sf, names, vote=None):
    """The test split with the named learners' probabilities."""
    test = M.assembler(S.MODEL_FEATURES).transform(splits(spark, sf)["test"])
    return M.score_with(models(spark, sf, names), test, vote=vote)


def _checked_scores(spark, sf, name):
    """The test rows, checks of their scores, and the AUC of a fixed rule (the charges alone), which the learner must beat."""
    p = f"p_{name}"
    decided = P.decide_label(test_scores(spark, sf, [name]).withColumn("churn_probability", F.col(p)))
    decided = cut_lineage(decided.select("customerID", "Churn", "MonthlyCharges", p, "churn_prediction"))
    rule = E.roc_auc(decided, "Churn", "MonthlyCharges").select("roc_auc").scalar()
    own = E.roc_auc(decided, "Churn", p).select("roc_auc").scalar()
    return decided.select("customerID", "Churn", F.col(p).between(0, 1).alias("probability_in_range"),
                          (F.col("churn_prediction") == (F.col(p) >= S.DECISION_THRESHOLD).cast("int")).alias("decision_matches"),
                          rule.alias("rule_auc"), (own > rule).alias("beats_rule"))


# the test split, ranked in plain SQL
_RANKED = """, r AS (SELECT customerID, Churn,
  row_number() OVER (PARTITION BY Churn ORDER BY md5('42:' || customerID), customerID) AS rk,
  count(*) OVER (PARTITION BY Churn) AS nc FROM customer_features),
split AS (SELECT customerID, Churn, CASE WHEN rk <= round(nc * 0.2) THEN 'test'
  WHEN rk <= round(nc * 0.2) + round((nc - round(nc * 0.2)) * 0.1) THEN 'val' ELSE 'train' END AS split FROM r)
"""
_RULE_SQL = """, t AS (SELECT s.*, MonthlyCharges FROM split s JOIN customer_features USING (customerID) WHERE split = 'test'),
auc AS (SELECT round(sum(CASE WHEN a.MonthlyCharges > b.MonthlyCharges THEN 1.0 WHEN a.MonthlyCharges = b.MonthlyCharges
  THEN 0.5 ELSE 0 END) / count(*), 6) AS rule_auc FROM t a JOIN t b ON a.Churn = 1 AND b.Churn = 0)
"""
_TEST_SQL = with_views(_RANKED + _RULE_SQL + "SELECT customerID, Churn, true AS probability_in_range, true AS decision_matches, "
                       "rule_auc, true AS beats_rule FROM t, auc", "customer_features")
_MODELS_SQL = "(SELECT unnest(['random_forest', 'xgboost', 'lightgbm', 'voting_ensemble']) AS model_name)"


@query("balanced_weights", "M4", with_views(
    "SELECT customerID, Churn, round(count(*) OVER () / (2.0 * count(*) OVER (PARTITION BY Churn)), 6) AS weight "
    "FROM customer_features", "customer_features"))
def q_weights(spark, sf):
    return M.balanced_weights(I.features(spark, sf).select("customerID", "Churn"), "Churn") \
        .withColumn("weight", F.round("weight", 6))


@query("rf_train", "M1", _TEST_SQL)
def q_rf(spark, sf):
    return _checked_scores(spark, sf, "random_forest")


@query("gbt_train", "M2", _TEST_SQL)
def q_gbt(spark, sf):
    return _checked_scores(spark, sf, "xgboost")


@query("gbt_balanced_train", "M3", _TEST_SQL)
def q_gbt_bal(spark, sf):
    return _checked_scores(spark, sf, "lightgbm")


@query("soft_vote", "M5", with_views(
    "SELECT line_id, round((score + score * score + (1 - score)) / 3, 6) AS p_vote, "
    "CAST(CASE WHEN (score + score * score + (1 - score)) / 3 >= 0.5 THEN 1 ELSE 0 END AS TINYINT) AS prediction "
    "FROM scored_lines", "scored_lines"))
def q_vote(spark, sf):
    """The vote over three given scores per line (of the trained learners: ``rf_train`` and its twins, ``score_batch``)."""
    given = I.scored_lines(spark, sf).withColumns({
        "p_a": F.col("score"), "p_b": F.col("score") * F.col("score"), "p_c": 1 - F.col("score")})
    return M.soft_vote(given, ["p_a", "p_b", "p_c"]).select(
        "line_id", F.round("p_vote", 6).alias("p_vote"), (F.col("p_vote") >= 0.5).cast("tinyint").alias("prediction"))


def fold_aucs(spark, sf):
    """model_name, fold, roc_auc of the cross-validation at the production parameters."""
    return _kept(spark, sf, "cv", lambda: cut_lineage(
        M.cross_validate(splits(spark, sf)["train"], S.MODEL_FEATURES, k=S.CV_FOLDS, overrides=CV_FIT)))


@query("cross_validate", "M6", with_views(_RANKED + f""", f AS (
  SELECT s.*, MonthlyCharges, (row_number() OVER (PARTITION BY s.Churn ORDER BY md5('42:' || customerID), customerID) - 1) % 5 AS fold
  FROM split s JOIN customer_features USING (customerID) WHERE split = 'train'),
auc AS (SELECT a.fold, sum(CASE WHEN a.MonthlyCharges > b.MonthlyCharges THEN 1.0 WHEN a.MonthlyCharges = b.MonthlyCharges
  THEN 0.5 ELSE 0 END) / count(*) AS auc FROM f a JOIN f b ON a.fold = b.fold AND a.Churn = 1 AND b.Churn = 0 GROUP BY 1)
SELECT m.model_name, CAST(fold AS INTEGER) AS fold, count(*) AS n_rows, CAST(sum(Churn) AS BIGINT) AS n_positive,
       true AS auc_in_range, round((SELECT avg(auc) FROM auc), 6) AS rule_auc_mean, true AS beats_rule
FROM f, {_MODELS_SQL} m GROUP BY 1, 2""", "customer_features"))
def q_cv(spark, sf):
    """Fold sizes, and whether every fold's AUC is one and their mean beats that of a fixed rule (the charges alone)."""
    done = fold_aucs(spark, sf)
    folds = R.assign_folds(splits(spark, sf)["train"], "Churn", "customerID", S.CV_FOLDS, S.SEED)
    rule = E.roc_auc(folds, "Churn", "MonthlyCharges", scale=None, by=["fold"]).agg(F.avg("roc_auc")).scalar()
    means = done.groupBy(F.col("model_name").alias("m")).agg(F.avg("roc_auc").alias("mean"))
    sizes = folds.groupBy("fold").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("Churn").alias("n_positive"))
    return done.join(means, F.col("model_name") == F.col("m")).join(sizes, "fold").select(
        "model_name", "fold", "n_rows", "n_positive", F.col("roc_auc").between(0, 1).alias("auc_in_range"),
        F.round(rule, 6).alias("rule_auc_mean"), (F.col("mean") > rule).alias("beats_rule"))


@query("learned_cv", "M6")
def q_learned_cv(spark, sf):
    """Mean and population deviation of the fold AUCs, and the folds, for each learner and the vote."""
    done = fold_aucs(spark, sf)
    return M.cv_summary(done).join(done.groupBy("model_name").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("fold", F.round("roc_auc", 4).alias("auc")))), lambda x: x["auc"])
        .alias("fold_aucs")), "model_name")


_METRIC_SQL = ("(SELECT unnest(['train', 'val', 'test']) || '_' || m AS metric_name FROM "
               "(SELECT unnest(['roc_auc', 'accuracy', 'f1', 'precision', 'recall']) AS m))")


@query("train_pipeline", "M7", with_views(
    f"SELECT 'train-run' AS run_id, m.model_name, k.metric_name, true AS in_range, 1 AS best_models, "
    f"(SELECT count(*) FROM customer_features) AS n_rows FROM {_MODELS_SQL} m, {_METRIC_SQL} k", "customer_features"))
def q_train(spark, sf):
    res = trained(spark, sf)
    best = res.metrics.select(F.count_distinct(F.when(F.col("model_name") == res.best, F.col("model_name"))).cast("int")).scalar()
    return res.metrics.select("run_id", "model_name", "metric_name", F.col("metric_value").between(0, 1).alias("in_range"),
                              best.alias("best_models"), I.features(spark, sf).select(F.count(F.lit(1))).scalar().alias("n_rows"))


def _violation_sql() -> str:
    tests = [("customerID IS NULL", "customerID:required")]
    for c, (lo, hi) in S.REQUEST_BOUNDS.items():
        tests += [(f"{c} < {lo}", f"{c}:min")] if lo is not None else []
        tests += [(f"{c} > {hi}", f"{c}:max")] if hi is not None else []
    return "concat_ws(',', " + ", ".join(f"CASE WHEN {t} THEN '{n}' END" for t, n in tests) + ")"


REQUEST_SQL = (f"SELECT CAST(request_id AS BIGINT) AS request_id, customerID, CASE WHEN v = '' THEN 'scored' ELSE 'rejected' END "
               f"AS status, v AS violations, true AS result_matches FROM (SELECT *, {_violation_sql()} AS v FROM score_requests)")


def result_matches():
    """Whether the result columns of a request agree with its status: all
    consistent for a scored one, all null for a rejected one."""
    p = F.col("churn_probability")
    good = p.between(0, 1) & (F.col("churn_prediction") == (p >= S.DECISION_THRESHOLD).cast("int")) & F.col("risk_level").isNotNull()
    return F.coalesce(F.when(F.col("status") == "scored", good).otherwise(
        F.coalesce(p.cast("string"), F.col("churn_prediction").cast("string"), F.col("risk_level")).isNull()), F.lit(False))


def scored_requests(spark, sf):
    return M.score_all(I.requests(spark, sf), models(spark, sf), store=made_features(spark, sf), vote=M.LEARNERS, model_name="voting_ensemble")


@query("score_batch", "M8", with_views(REQUEST_SQL, "score_requests"))
def q_score(spark, sf):
    return scored_requests(spark, sf).select("request_id", "customerID", "status", F.array_join("violations", ",").alias("violations"),
                                             result_matches().alias("result_matches"))


@query("learned_probabilities", "M5")
def q_probabilities(spark, sf):
    """The test split with every learner's probability, the vote, the decision and the risk level."""
    scored = test_scores(spark, sf, M.LEARNERS, vote=M.LEARNERS).withColumn("churn_probability", F.col("p_vote"))
    scored = P.decide_label(P.with_risk_level(scored))
    return scored.select("customerID", "Churn", *[F.round(f"p_{n}", 6).alias(f"p_{n}") for n in [*M.LEARNERS, "vote"]],
                         "churn_prediction", "risk_level")


@query("learned_metrics", "M7")
def q_metrics(spark, sf):
    """The metrics of every model on every split, as logged."""
    return trained(spark, sf).metrics


def _importances(spark, sf, name):
    """model_name, rank, feature, importance of every feature, from the learner's node table."""
    table = _kept(spark, sf, f"importances-{name}", lambda: cut_lineage(M.importance_table(
        models(spark, sf, [name])[name], S.MODEL_FEATURES, spark,
        _kept(spark, sf, "folder", lambda: scratch_path(spark, "models")) + f"/{name}")))
    order = Window.partitionBy("model_name").orderBy(F.desc("importance"), "feature")   # one row per feature
    return table.withColumn("model_name", F.lit(name)).withColumn("rank", F.row_number().over(order))


@query("learned_importances", "E6")
def q_learned_importances(spark, sf):
    """Rank and importance of every feature: impurity shares of the forest, mean gains of the second-order
    booster, split counts of the leaf-wise one."""
    out = None
    models(spark, sf)   # all in one go, not learner after learner
    for n in M.LEARNERS:
        part = _importances(spark, sf, n)
        out = part if out is None else out.unionByName(part)
    return out.select("model_name", "rank", "feature", F.round("importance", 6).alias("importance"))


def _in_order(df):
    """Whether an importance is at least 0 and no larger than the one before, and those of a model add up:
    shares to 1, split counts to a whole number."""
    before = F.lag("importance").over(Window.partitionBy("model_name").orderBy("rank"))
    total = F.sum("importance").over(Window.partitionBy("model_name"))
    whole = F.abs(total - F.round(total)) < 1e-9
    adds = F.when(F.col("model_name") == "lightgbm", whole & (total > 0)).otherwise(F.abs(total - 1) < 1e-9)
    return df.withColumn("in_order", (F.col("importance") >= 0) & F.coalesce(F.col("importance") <= before, F.lit(True)) & adds)


@query("top_importances", "T4", with_views(
    "SELECT 'random_forest' AS model_name, CAST(rank AS INTEGER) AS rank, true AS in_order, "
    "(SELECT count(*) FROM customer_features) AS n_rows FROM range(1, 21) t(rank)", "customer_features"))
def q_top_imp(spark, sf):
    n_rows = I.features(spark, sf).select(F.count(F.lit(1))).scalar()
    return _in_order(_importances(spark, sf, "random_forest")).filter("rank <= 20").select(
        "model_name", "rank", "in_order", n_rows.alias("n_rows"))


_FEATURES_SQL = "(SELECT unnest([" + ", ".join(f"'{f}'" for f in S.MODEL_FEATURES) + "]) AS feature)"


@query("feature_importance", "E6", with_views(
    f"SELECT m.model_name, f.feature, true AS in_order, (SELECT count(*) FROM customer_features) AS n_rows "
    f"FROM {_MODELS_SQL} m, {_FEATURES_SQL} f WHERE m.model_name IN ('xgboost', 'lightgbm')", "customer_features"))
def q_imp(spark, sf):
    """Every feature of both boosted learners."""
    n_rows = I.features(spark, sf).select(F.count(F.lit(1))).scalar()
    models(spark, sf, ["xgboost", "lightgbm"])   # in one loop
    both = _importances(spark, sf, "xgboost").unionByName(_importances(spark, sf, "lightgbm"))
    return _in_order(both).select("model_name", "feature", "in_order", n_rows.alias("n_rows"))


# name -> (segment, assertion); the segment is plain SQL in both dialects
_MONTHLY = "Contract_OneYear = 0 AND Contract_TwoYear = 0"
_NEW = f"tenure <= 6 AND InternetService_Fiber = 1 AND {_MONTHLY}"
_LOYAL = "tenure >= 48 AND Contract_TwoYear = 1"
SEGMENTS = {
    "new_fiber_monthly_probability": (_NEW, "churn_probability > 0.4"),
    "new_fiber_monthly_risk": (_NEW, "risk_level IN ('MEDIUM', 'HIGH', 'CRITICAL')"),
    "loyal_two_year_probability": (_LOYAL, "churn_probability < 0.5"),
    "loyal_two_year_decision": (_LOYAL, "churn_prediction = 0"),
    "required_fields": ("true", "customerID IS NOT NULL AND churn_probability IS NOT NULL AND churn_prediction IS NOT NULL "
                                "AND risk_level IS NOT NULL AND model_name IS NOT NULL"),
    "probability_in_unit_range": ("true", "churn_probability >= 0 AND churn_probability <= 1"),
    "senior_monthly_high_charges": (f"SeniorCitizen = 1 AND MonthlyCharges >= 80 AND {_MONTHLY}", "churn_probability > 0.3"),
}


@query("segment_eval", "E7", with_views(" UNION ALL ".join(
    f"SELECT '{name}' AS segment, (SELECT count(*) FROM customer_features WHERE {seg}) AS rows, true AS counts_agree"
    for name, (seg, _) in SEGMENTS.items()), "customer_features"))
def q_segments(spark, sf):
    out = segments(spark, sf)
    always = F.col("segment").isin("required_fields", "probability_in_unit_range")
    agree = F.col("passed").between(0, F.col("rows")) & (F.col("success") == ((F.col("rows") > 0) & (F.col("passed") == F.col("rows")))) \
        & (~always | F.col("success"))
    return out.select("segment", "rows", agree.alias("counts_agree"))


def segments(spark, sf):
    scored = M.score_with(models(spark, sf), M.assembler(S.MODEL_FEATURES).transform(made_features(spark, sf)), vote=M.LEARNERS)
    scored = P.decide_label(P.with_risk_level(scored.withColumn("churn_probability", F.col("p_vote")))) \
        .withColumn("model_name", F.lit("voting_ensemble"))
    return E.segment_eval(scored, {name: (F.expr(seg), F.expr(check)) for name, (seg, check) in SEGMENTS.items()})


@query("learned_segments", "E7")
def q_learned_segments(spark, sf):
    """Rows, passed rows, pass rate and success of every segment."""
    return segments(spark, sf)


@query("smote", "R4", with_views(_RANKED + """, n AS (SELECT Churn, count(*) AS c FROM split WHERE split = 'train' GROUP BY 1)
SELECT Churn, is_synthetic, n_rows, true AS in_range FROM (
  SELECT Churn, false AS is_synthetic, c AS n_rows FROM n
  UNION ALL SELECT 1, true, CAST(floor(0.7 * (SELECT c FROM n WHERE Churn = 0)) AS BIGINT) - (SELECT c FROM n WHERE Churn = 1))
WHERE n_rows > 0""", "customer_features"))
def q_smote(spark, sf):
    """Rows by class and kind, and whether every synthetic value lies within its class."""
    out = resampled(spark, sf)
    ranges = out.groupBy("Churn", "is_synthetic").agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.min(c).alias(f"min_{c}") for c in S.MODEL_FEATURES],
        *[F.max(c).alias(f"max_{c}") for c in S.MODEL_FEATURES])
    given = ~F.col("is_synthetic")
    bounds = ranges.groupBy("Churn").agg(*[F.min(F.when(given, F.col(f"min_{c}"))).alias(f"lo_{c}") for c in S.MODEL_FEATURES],
                                         *[F.max(F.when(given, F.col(f"max_{c}"))).alias(f"hi_{c}") for c in S.MODEL_FEATURES])
    within = F.lit(True)
    for c in S.MODEL_FEATURES:
        within = within & (F.col(f"min_{c}") >= F.col(f"lo_{c}") - 1e-9) & (F.col(f"max_{c}") <= F.col(f"hi_{c}") + 1e-9)
    return ranges.join(bounds, "Churn").select("Churn", "is_synthetic", "n_rows", F.coalesce(within, F.lit(False)).alias("in_range"))


def _tree_sql(leaves: int, depth: int, l2: float, min_rows: int, min_hessian: float, weight: str) -> str:
    """DuckDB SQL that grows one tree on the training split: all splits level by level; of them the
    best-first ones are the ``leaves - 1`` greatest by the smallest gains on their paths (0: all)."""
    scale = B.SCALE
    lam = l2 * scale
    feats = ", ".join(f"({i}, CAST(\"{f}\" AS DOUBLE))" for i, f in enumerate(S.MODEL_FEATURES))
    sql = _RANKED + f""", tr AS (
  SELECT c.*, {weight} AS wt FROM (SELECT customerID FROM split WHERE split = 'train') JOIN customer_features c USING (customerID)),
b0 AS (SELECT ln(sum(wt * Churn) / (sum(wt) - sum(wt * Churn))) AS m FROM tr),
gh AS (SELECT tr.customerID AS id, CAST(round_even((1 / (1 + exp(-m)) - Churn) * wt * {scale}, 0) AS BIGINT) AS g,
  CAST(round_even((1 / (1 + exp(-m))) * (1 - 1 / (1 + exp(-m))) * wt * {scale}, 0) AS BIGINT) AS h, wt FROM tr, b0),
long0 AS (SELECT customerID AS id, unnest([{", ".join(f'CAST("{f}" AS DOUBLE)' for f in S.MODEL_FEATURES)}]) AS v,
  unnest(range({len(S.MODEL_FEATURES)})) AS f FROM tr),
vals AS (SELECT f, v, sum({'wt' if weight != WEIGHT_SQL else '1'}) AS w FROM long0 JOIN gh USING (id) GROUP BY f, v),
runs AS (SELECT *, sum(w) OVER (PARTITION BY f ORDER BY v) - w AS before, sum(w) OVER (PARTITION BY f) AS total,
  count(*) OVER (PARTITION BY f) AS nv, row_number() OVER (PARTITION BY f ORDER BY v) - 1 AS rn FROM vals),
cut AS (SELECT f, v, max(v) OVER (PARTITION BY f, CASE WHEN nv <= {B.MAX_BINS} THEN rn
  ELSE least(floor(before * {B.MAX_BINS} / total), {B.MAX_BINS - 1}) END) AS edge FROM runs),
bins AS MATERIALIZED (SELECT id, l.f, edge, g, h FROM long0 l JOIN cut USING (f, v) JOIN gh USING (id)),
at0 AS (SELECT id, '' AS path FROM gh), key0 AS (SELECT '' AS path, CAST([] AS DOUBLE[]) AS key)
"""
    for d in range(depth):
        sql += f""", cell{d} AS (SELECT path, f, edge, sum(g) AS g, sum(h) AS h, count(*) AS n FROM bins JOIN at{d} USING (id) GROUP BY ALL),
cum{d} AS (SELECT path, f, edge, sum(g) OVER w AS gl, sum(h) OVER w AS hl, sum(n) OVER w AS nl, sum(g) OVER t AS gt, sum(h) OVER t AS ht,
  sum(n) OVER t AS nt FROM cell{d} WINDOW w AS (PARTITION BY path, f ORDER BY edge), t AS (PARTITION BY path, f)),
gain{d} AS (SELECT path, f, edge, CAST(nt AS BIGINT) AS nt, gl::DOUBLE * gl::DOUBLE / (hl::DOUBLE + {lam}) + (gt - gl)::DOUBLE * (gt - gl)::DOUBLE
  / ((ht - hl)::DOUBLE + {lam}) - gt::DOUBLE * gt::DOUBLE / (ht::DOUBLE + {lam}) AS gain FROM cum{d}
  WHERE nl >= {max(1, min_rows)} AND nt - nl >= {max(1, min_rows)} AND hl >= {min_hessian * scale} AND ht - hl >= {min_hessian * scale}),
best{d} AS MATERIALIZED (SELECT * FROM gain{d} WHERE gain > 0 QUALIFY row_number() OVER (PARTITION BY path ORDER BY gain DESC, f, edge) = 1),
key{d + 1} AS (SELECT b.path, list_append(list_filter(k.key, lambda x: x <= b.gain), b.gain) AS key
  FROM best{d} b JOIN key{d} k ON k.path = left(b.path, greatest(0, length(b.path) - 1))),
at{d + 1} AS (SELECT a.id, a.path || CASE WHEN x.edge <= b.edge THEN 'l' ELSE 'r' END AS path FROM at{d} a JOIN best{d} b USING (path)
  JOIN bins x ON x.id = a.id AND x.f = b.f)
"""
    every = " UNION ALL ".join(f"SELECT {d} AS depth, b.*, k.key FROM best{d} b JOIN key{d + 1} k USING (path)" for d in range(depth))
    names = "[" + ", ".join(f"'{f}'" for f in S.MODEL_FEATURES) + "]"
    keep = f"QUALIFY row_number() OVER (ORDER BY list_append(key, 'inf'::DOUBLE) DESC) <= {leaves - 1}" if leaves else ""
    return with_views(sql + f""", every AS ({every})
SELECT path, CAST(depth AS INTEGER) AS depth, {names}[f + 1] AS feature, edge AS threshold, round(gain / {scale}, 6) AS gain, nt AS rows
FROM every {keep}""", "customer_features")


def _first_tree(spark, sf, name):
    """The inner nodes of the first tree on the training split, without sampling: path from the root (l, r),
    depth, feature, threshold (to the left: at most), gain, rows."""
    data = M.assembler(S.MODEL_FEATURES).transform(M.with_training_weights(splits(spark, sf)["train"], "Churn"))
    p = replace(M.boost_params(name), rounds=1, row_share=1.0, column_share=1.0)
    weight = M.BOOST_WEIGHT[name]
    tree = B.fit_together(data.withColumn("__x", vector_to_array(M.VEC)), "__x", S.MODEL_FEATURES, "Churn", [B.Fit(name, p, weight)],
                          bin_weight=F.col(weight) if name == "xgboost" else None).models[name].nodes
    paths = {0: ""}
    for r in tree.itertuples():
        if r.feature >= 0:
            paths[r.left], paths[r.right] = paths[r.node] + "l", paths[r.node] + "r"
    rows = [(paths[r.node], int(r.depth), r.name, float(r.threshold), round(float(r.gain), 6), int(r.rows))
            for r in tree.itertuples(index=False) if r.feature >= 0]
    return spark.createDataFrame(rows, "path string, depth int, feature string, threshold double, gain double, rows bigint")


WEIGHT_SQL = "(count(*) OVER ()) / (2.0::DOUBLE * (count(*) OVER (PARTITION BY Churn)))"
_X, _L = M.boost_params("xgboost"), M.boost_params("lightgbm")


@query("gbt_first_tree", "M2", _tree_sql(0, _X.max_depth, _X.l2, _X.min_rows, _X.min_hessian,
                                         f"CASE WHEN Churn = 1 THEN {float(S.XGB_PARAMS['scale_pos_weight'])}::DOUBLE ELSE 1.0::DOUBLE END"))
def q_first_tree(spark, sf):
    return _first_tree(spark, sf, "xgboost")


@query("gbt_balanced_first_tree", "M3", _tree_sql(_L.max_leaves, _L.max_depth, _L.l2, _L.min_rows, _L.min_hessian, WEIGHT_SQL))
def q_balanced_first_tree(spark, sf):
    return _first_tree(spark, sf, "lightgbm")
