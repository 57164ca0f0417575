"""Classification metrics on (label, score / prediction) columns.

Counts are one conditional aggregate; curves and exact AUC use the
distributed prefix sum of :mod:`prefix` over distinct scores.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .prefix import collapse, ordered_cumsum


def _div0(a: Column, b: Column) -> Column:
    """a / b, 0 when b is 0 (the 'zero_division=0' convention)."""
    return F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / b)


def confusion_counts(df: DataFrame, label: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    y, p = F.col(label), F.col(pred)
    g = df.groupBy(*by) if by else df.groupBy()
    return g.agg(
        F.sum(((y == 1) & (p == 1)).cast("long")).alias("tp"),
        F.sum(((y == 0) & (p == 1)).cast("long")).alias("fp"),
        F.sum(((y == 1) & (p == 0)).cast("long")).alias("fn"),
        F.sum(((y == 0) & (p == 0)).cast("long")).alias("tn"),
    )


def confusion_metrics(df: DataFrame, label: str, pred: str, by: Sequence[str] = (),
                      scale: int | None = 6) -> DataFrame:
    """Accuracy, precision, recall, F1 of the positive class (0 when undefined)."""
    c = confusion_counts(df, label, pred, by)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    prec = _div0(tp, tp + fp)
    rec = _div0(tp, tp + fn)
    f1 = _div0(2 * tp, 2 * tp + fp + fn)
    acc = _div0(tp + tn, tp + fp + fn + tn)
    r = (lambda x: F.round(x, scale)) if scale is not None else (lambda x: x)
    return c.select(*by, "tp", "fp", "fn", "tn", r(acc).alias("accuracy"), r(prec).alias("precision"),
                    r(rec).alias("recall"), r(f1).alias("f1"))


def classification_report(df: DataFrame, label: str, pred: str, names=("No Churn", "Churn"),
                          scale: int = 6) -> DataFrame:
    """Per-class precision / recall / F1 / support, accuracy, macro and
    weighted averages, as long rows ``(class_name, precision, recall, f1_score, support)``."""
    c = confusion_counts(df, label, pred)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    total = tp + fp + fn + tn
    # class 1 is the positive; class 0 swaps the roles
    p1, r1, f1_1 = _div0(tp, tp + fp), _div0(tp, tp + fn), _div0(2 * tp, 2 * tp + fp + fn)
    p0, r0, f1_0 = _div0(tn, tn + fn), _div0(tn, tn + fp), _div0(2 * tn, 2 * tn + fn + fp)
    s1, s0 = tp + fn, tn + fp
    acc = _div0(tp + tn, total)

    def row(name, p, r, f, s):
        return F.struct(F.lit(name).alias("class_name"), F.round(p, scale).alias("precision"),
                        F.round(r, scale).alias("recall"), F.round(f, scale).alias("f1_score"),
                        s.cast("long").alias("support"))

    rows = [
        row(names[0], p0, r0, f1_0, s0),
        row(names[1], p1, r1, f1_1, s1),
        row("accuracy", F.lit(None).cast("double"), F.lit(None).cast("double"), acc, total),
        row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f1_0 + f1_1) / 2, total),
        row("weighted avg", _div0(p0 * s0 + p1 * s1, total), _div0(r0 * s0 + r1 * s1, total),
            _div0(f1_0 * s0 + f1_1 * s1, total), total),
    ]
    return c.select(F.inline(F.array(*rows)))


def _score_table(df: DataFrame, label: str, score: str, weight: str | None = None, by: Sequence[str] = (),
                 parts: int | None = None, next_cols: Sequence[str] = ()) -> DataFrame:
    """Distinct scores with positive / negative counts (or sums of an integer
    ``weight``) and descending running sums. The distinct-score table is materialized once, inside
    :func:`prefix.ordered_cumsum` (range parts pinned by a checkpoint); the
    totals are read from it too."""
    y = F.col(label).cast("long")
    w = F.col(weight).cast("long") if weight else F.lit(1)
    col = collapse(df.filter(F.col(score).isNotNull()), score, {"pos": y * w, "neg": (F.lit(1) - y) * w}, by)
    return ordered_cumsum(col, score, ["pos", "neg"], by, descending=True, parts=parts, next_cols=next_cols)


def roc_auc(df: DataFrame, label: str, score: str, scale: int | None = 6, weight: str | None = None,
            by: Sequence[str] = ()) -> DataFrame:
    """Exact ROC AUC, of each group ``by`` in one pass; tied scores count one half (Mann-Whitney).

    AUC = sum over distinct scores of neg * (positives scored higher + pos / 2), over P * N.
    The products are doubles: P * N passes the bigint range at some 3e9 rows each.
    """
    t = _score_table(df, label, score, weight, by)
    num = F.sum(F.col("neg") * (F.col("cum_pos") - F.col("pos") + F.col("pos") / 2.0))
    p, n = F.sum("pos"), F.sum("neg")
    auc = F.when((p > 0) & (n > 0), num / (p.cast("double") * n.cast("double")))
    return t.groupBy(*by).agg((F.round(auc, scale) if scale is not None else auc).alias("roc_auc"),
                              p.alias("n_pos"), n.alias("n_neg"))


def roc_curve(df: DataFrame, label: str, score: str, drop_collinear: bool = False,
              parts: int | None = None) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score, descending, plus
    the (0, 0) start with a null threshold.

    ``drop_collinear`` leaves out the points that the curve can be drawn
    without: those whose step (positives and negatives at the score) equals
    the next one's, by the rule of the usual library. The highest and the
    lowest score always stay. A step is compared with its neighbour across
    the borders of the range parts too, so any number of ``parts`` gives the
    same points.
    """
    t = _score_table(df, label, score, parts=parts, next_cols=["pos", "neg"] if drop_collinear else ())
    P = t.select(F.sum("pos")).scalar()
    N = t.select(F.sum("neg")).scalar()
    kept = t
    if drop_collinear:
        first = (F.col("cum_pos") == F.col("pos")) & (F.col("cum_neg") == F.col("neg"))
        turns = (F.col("next_pos") != F.col("pos")) | (F.col("next_neg") != F.col("neg"))
        kept = t.filter(first | F.col("next_pos").isNull() | turns)
    pts = kept.select(F.col(score).cast("double").alias("threshold"),
                      (F.col("cum_neg") / N).alias("fpr"), (F.col("cum_pos") / P).alias("tpr"))
    start = df.sparkSession.range(1).select(F.lit(None).cast("double").alias("threshold"),
                                            F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return start.unionByName(pts)


def pr_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """E5: (threshold, precision, recall) per distinct score, plus the end
    point precision 1, recall 0."""
    t = _score_table(df, label, score)
    P = t.select(F.sum("pos")).scalar()
    pts = t.select(F.col(score).cast("double").alias("threshold"),
                   (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("precision"),
                   (F.col("cum_pos") / P).alias("recall"))
    end = df.sparkSession.range(1).select(F.lit(None).cast("double").alias("threshold"),
                                          F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return pts.unionByName(end)


def segment_eval(scored: DataFrame, assertions: dict, score: str = "churn_probability") -> DataFrame:
    """Per named segment, rows, rows passing the assertion, pass rate and
    success (every row passes; an empty segment fails).

    ``assertions`` maps name -> (segment predicate, assertion predicate).
    One aggregate computes every segment.
    """
    aggs, rows = [], []
    for i, (name, (seg, check)) in enumerate(assertions.items()):
        aggs += [F.sum(seg.cast("long")).alias(f"n{i}"), F.sum((seg & check).cast("long")).alias(f"p{i}")]
        n, p = F.coalesce(F.col(f"n{i}"), F.lit(0)), F.coalesce(F.col(f"p{i}"), F.lit(0))
        rows.append(F.struct(F.lit(name).alias("segment"), n.alias("rows"), p.alias("passed"),
                             F.round(F.try_divide(p.cast("double"), n), 6).alias("pass_rate"),
                             ((n > 0) & (n == p)).alias("success")))
    return scored.agg(*aggs).select(F.inline(F.array(*rows)))
