"""Queries for evaluation metrics on given scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluate as E
from . import inputs as I
from .catalog import query
from .oracle_sql import with_views


def _pred(spark, sf):
    return I.scored_lines(spark, sf).withColumn("pred", (F.col("score") >= 0.5).cast("tinyint"))


_COUNTS = """c AS (SELECT
  sum(CASE WHEN label = 1 AND score >= 0.5 THEN 1 ELSE 0 END) AS tp,
  sum(CASE WHEN label = 0 AND score >= 0.5 THEN 1 ELSE 0 END) AS fp,
  sum(CASE WHEN label = 1 AND score < 0.5 THEN 1 ELSE 0 END) AS fn,
  sum(CASE WHEN label = 0 AND score < 0.5 THEN 1 ELSE 0 END) AS tn FROM scored_lines)"""


def _d(a: str, b: str) -> str:
    return f"(CASE WHEN ({b}) = 0 THEN 0.0 ELSE CAST({a} AS DOUBLE) / ({b}) END)"


@query("confusion_metrics", "E1", with_views(f"""
, {_COUNTS}
SELECT CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(tn AS BIGINT) AS tn,
  round({_d('tp + tn', 'tp + fp + fn + tn')}, 6) AS accuracy, round({_d('tp', 'tp + fp')}, 6) AS precision,
  round({_d('tp', 'tp + fn')}, 6) AS recall, round({_d('2 * tp', '2 * tp + fp + fn')}, 6) AS f1 FROM c
""", "scored_lines"))
def q_confusion(spark, sf):
    return E.confusion_metrics(_pred(spark, sf), "label", "pred")


@query("classification_report", "E2", with_views(f"""
, {_COUNTS},
m AS (SELECT *, {_d('tp', 'tp + fp')} AS p1, {_d('tp', 'tp + fn')} AS r1, {_d('2 * tp', '2 * tp + fp + fn')} AS f1,
             {_d('tn', 'tn + fn')} AS p0, {_d('tn', 'tn + fp')} AS r0, {_d('2 * tn', '2 * tn + fn + fp')} AS f0,
             tp + fn AS s1, tn + fp AS s0, tp + fp + fn + tn AS n FROM c)
SELECT 'No Churn' AS class_name, round(p0, 6) AS precision, round(r0, 6) AS recall, round(f0, 6) AS f1_score,
       CAST(s0 AS BIGINT) AS support FROM m
UNION ALL SELECT 'Churn', round(p1, 6), round(r1, 6), round(f1, 6), CAST(s1 AS BIGINT) FROM m
UNION ALL SELECT 'accuracy', NULL, NULL, round({_d('tp + tn', 'n')}, 6), CAST(n AS BIGINT) FROM m
UNION ALL SELECT 'macro avg', round((p0 + p1) / 2, 6), round((r0 + r1) / 2, 6), round((f0 + f1) / 2, 6),
       CAST(n AS BIGINT) FROM m
UNION ALL SELECT 'weighted avg', round({_d('p0 * s0 + p1 * s1', 'n')}, 6), round({_d('r0 * s0 + r1 * s1', 'n')}, 6),
       round({_d('f0 * s0 + f1 * s1', 'n')}, 6), CAST(n AS BIGINT) FROM m
""", "scored_lines"))
def q_report(spark, sf):
    return E.classification_report(_pred(spark, sf), "label", "pred")


_CUM = """s AS (SELECT score, sum(label) AS pos, count(*) - sum(label) AS neg FROM scored_lines
       WHERE score IS NOT NULL GROUP BY score),
cu AS (SELECT score, pos, neg,
  sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_pos,
  sum(neg) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg FROM s),
t AS (SELECT sum(pos) AS p, sum(neg) AS n FROM s)"""


@query("roc_auc", "E3", with_views(f"""
, {_CUM}
SELECT round(sum(neg * (cum_pos - pos + pos / 2.0)) / ((SELECT p FROM t) * (SELECT n FROM t)), 6) AS roc_auc,
       CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg FROM cu
""", "scored_lines"))
def q_auc(spark, sf):
    return E.roc_auc(I.scored_lines(spark, sf), "label", "score")


@query("roc_curve", "E4", with_views(f"""
, {_CUM}
SELECT CAST(NULL AS DOUBLE) AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr
UNION ALL SELECT CAST(score AS DOUBLE), cum_neg / (SELECT n FROM t), cum_pos / (SELECT p FROM t) FROM cu
""", "scored_lines"))
def q_roc(spark, sf):
    return E.roc_curve(I.scored_lines(spark, sf), "label", "score")


@query("roc_curve_corners", "E4", with_views(f"""
, {_CUM},
x AS (SELECT *, lead(pos) OVER (ORDER BY score DESC) AS next_pos, lead(neg) OVER (ORDER BY score DESC) AS next_neg,
             row_number() OVER (ORDER BY score DESC) AS i FROM cu)
SELECT CAST(NULL AS DOUBLE) AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr
UNION ALL SELECT CAST(score AS DOUBLE), cum_neg / (SELECT n FROM t), cum_pos / (SELECT p FROM t) FROM x
WHERE i = 1 OR next_pos IS NULL OR next_pos <> pos OR next_neg <> neg
""", "scored_lines"))
def q_roc_corners(spark, sf):
    return E.roc_curve(I.scored_lines(spark, sf), "label", "score", drop_collinear=True)


@query("pr_curve", "E5", with_views(f"""
, {_CUM}
SELECT CAST(score AS DOUBLE) AS threshold, cum_pos / (cum_pos + cum_neg) AS precision,
       cum_pos / (SELECT p FROM t) AS recall FROM cu
UNION ALL SELECT CAST(NULL AS DOUBLE), 1.0::DOUBLE, 0.0::DOUBLE
""", "scored_lines"))
def q_pr(spark, sf):
    return E.pr_curve(I.scored_lines(spark, sf), "label", "score")
