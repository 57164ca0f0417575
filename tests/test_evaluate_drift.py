import math
import random
import pandas as pd
import pytest

import numpy as np
from pyspark.sql import functions as F

from attrition.operators import drift as D
from attrition.operators import evaluate as E
from attrition.operators.prefix import collapse, ordered_cumsum


def _auc_brute(labels, scores):
    pos = [s for y, s in zip(labels, scores) if y == 1]
    neg = [s for y, s in zip(labels, scores) if y == 0]
    tot = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


def test_roc_auc_ties_and_symmetry(spark):
    rnd = random.Random(3)
    rows = [(rnd.random() < 0.3 and 1 or 0, round(rnd.random(), 2)) for _ in range(800)]
    df = spark.createDataFrame(rows, "label int, score double")
    got = E.roc_auc(df, "label", "score", scale=None).first()["roc_auc"]
    assert abs(got - _auc_brute(*zip(*rows))) < 1e-12
    neg = E.roc_auc(df.withColumn("score", -F.col("score")), "label", "score", scale=None).first()["roc_auc"]
    assert abs(got + neg - 1) < 1e-12


def test_prefix_sum_any_part_count(spark):
    rnd = random.Random(5)
    # group "a" is hot and its values crowd near zero (a skewed distribution)
    rows = [("a", int(rnd.expovariate(0.05)), 1) if rnd.random() < 0.7 else ("b", rnd.randint(0, 300), 1)
            for _ in range(3000)]
    df = collapse(spark.createDataFrame(rows, "g string, v int, one int"), "v", {"n": F.col("one")}, by=["g"])
    for parts in (1, 7, 16):
        for desc in (False, True):
            out = ordered_cumsum(df, "v", ["n"], by=["g"], parts=parts, descending=desc, with_next=True).toPandas()
            for g, sub in out.groupby("g"):
                sub = sub.sort_values("v", ascending=not desc)
                assert (sub["cum_n"].values == sub["n"].cumsum().values).all(), (parts, desc)
                assert list(sub["next_value"].iloc[:-1]) == list(sub["v"].iloc[1:]), (parts, desc)


def test_confusion_zero_division(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "y int, p int")
    r = E.confusion_metrics(df, "y", "p").first()
    assert r["precision"] == 0.0 and r["recall"] == 0.0 and r["f1"] == 0.0 and r["accuracy"] == 1.0


def _poisson_tail(x, dof):
    """Survival function for even degrees of freedom: a Poisson sum."""
    z = x / 2
    return sum(math.exp(-z + i * math.log(z) - math.lgamma(i + 1)) for i in range(dof // 2))


def test_chi2_pvalues_known_and_closed_form(spark):
    known = [(3.841458820694124, 1, 0.05), (5.991464547107979, 2, 0.05), (18.307038053275146, 10, 0.05),
             (0.0, 3, 1.0), (5.0, 0, 1.0), (math.inf, 4, 0.0), (66600.0, 79, 0.0), (7.814727903251179, 3, 0.05)]
    known += [(x, d, _poisson_tail(x, d)) for d in (2, 64, 66, 200, 2000) for x in (0.5 * d, d, 1.1 * d, 1.5 * d)]
    df = spark.createDataFrame([(float(x), d, p) for x, d, p in known], "x double, d int, p double")
    for r in df.withColumn("got", D.chi2_pvalue(F.col("x"), F.col("d"))).collect():
        assert abs(r.got - r.p) < 1e-9, r


def test_drift_rule_does_not_depend_on_the_reference_size(spark):
    for n in (1000, 1001):
        ref = spark.range(n).select((F.col("id") % 100).cast("double").alias("x"), (F.col("id") % 3).cast("string").alias("c"))
        cur = ref.select((F.col("x") + 40).alias("x"), F.lit("0").alias("c"))
        num = {t: D.drift_numeric(ref, cur, ["x"], test=t).first() for t in ("wasserstein", "ks")}
        assert all(r.stat_test == t and r.drifted for t, r in num.items())
        assert num["ks"].statistic == num["ks"].ks_pvalue and num["wasserstein"].statistic == num["wasserstein"].wasserstein_norm
        cat = {t: D.drift_categorical(ref, cur, ["c"], test=t).first() for t in ("jensenshannon", "chisquare")}
        assert all(r.stat_test == t and r.drifted for t, r in cat.items())
    with pytest.raises(ValueError):
        D.drift_numeric(ref, cur, ["x"], test="auto")


def test_chi_square_has_one_rule_for_any_number_of_categories(spark):
    for k in (64, 65, 66, 80, 200):
        ref = spark.range(k * 20).select((F.col("id") % k).cast("string").alias("c"))
        one = ref.select(F.lit("0").alias("c"))
        assert D.drift_categorical(ref, one, ["c"], test="chisquare").first().drifted
        same = D.drift_categorical(ref, ref, ["c"], test="chisquare").first()
        assert not same.drifted and same.dof == k - 1 and same.chi2_pvalue == 1.0


def test_auc_with_counts_past_the_bigint_product(spark):
    n = 4_000_000_000
    df = spark.createDataFrame([(1, 0.9, n), (0, 0.1, n), (1, 0.1, n), (0, 0.9, n)], "y int, s double, w bigint")
    r = E.roc_auc(df, "y", "s", weight="w").first()
    assert r.roc_auc == 0.5 and r.n_pos == 2 * n
    up = E.roc_auc(df.filter("(y = 1) = (s > 0.5)"), "y", "s", weight="w").first()
    assert up.roc_auc == 1.0


def test_ks_and_wasserstein_vs_numpy(spark):
    rnd = np.random.default_rng(1)
    a, b = rnd.normal(0, 1, 700).round(2), rnd.normal(0.3, 1, 500).round(2)
    ref = spark.createDataFrame([(float(x),) for x in a], "x double")
    cur = spark.createDataFrame([(float(x),) for x in b], "x double")
    r = D.drift_numeric(ref, cur, ["x"], scale=12).first()
    grid = np.union1d(a, b)
    fa = np.searchsorted(np.sort(a), grid, side="right") / len(a)
    fb = np.searchsorted(np.sort(b), grid, side="right") / len(b)
    assert abs(r["ks_stat"] - np.max(np.abs(fa - fb))) < 1e-9
    w = np.sum(np.abs(fa - fb)[:-1] * np.diff(grid))
    assert abs(r["wasserstein"] - w) < 1e-9
    k = D.drift_numeric(ref, cur, ["x"], test="ks").first()
    assert k["stat_test"] == "ks" and k["drifted"] == (k["ks_pvalue"] < 0.05) and k["statistic"] == k["ks_pvalue"]


def test_categorical_unseen_is_inf(spark):
    ref = spark.createDataFrame([("a",)] * 10 + [("b",)] * 10, "c string")
    cur = spark.createDataFrame([("a",)] * 10 + [("z",)] * 5, "c string")
    r = D.drift_categorical(ref, cur, ["c"]).first()
    assert math.isinf(r["chi2"]) and r["drifted"]
    assert r["chi2_pvalue"] == 0.0
    assert D.drift_categorical(ref, ref, ["c"]).first()["chi2_pvalue"] == 1.0


def test_ordered_row_number_hot_group(spark):
    from attrition.operators.prefix import ordered_row_number
    rnd = random.Random(3)
    rows = [("hot" if rnd.random() < 0.6 else f"g{rnd.randint(0, 4)}", rnd.randint(0, 50), i) for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, v int, id int")
    for parts in (1, 6, 13):
        got = ordered_row_number(df, [F.col("v").desc(), F.col("id").asc()], by=["g"], out="rn",
                                 parts=parts).toPandas()
        want = pd.DataFrame(rows, columns=["g", "v", "id"]).sort_values(["g", "v", "id"], ascending=[True, False, True])
        want["rn"] = want.groupby("g").cumcount() + 1
        m = got.merge(want, on=["g", "v", "id"], suffixes=("", "_w"))
        assert len(m) == len(rows) and (m["rn"] == m["rn_w"]).all(), parts


def test_prefix_ops_keep_null_groups(spark):
    from attrition.operators.prefix import ordered_row_number
    rows = [(None, 3, 1), (None, 1, 2), ("a", 2, 3), (None, 2, 4), ("a", 5, 5)]
    df = spark.createDataFrame(rows, "g string, v int, id int")
    rn = {r["id"]: r["rn"] for r in ordered_row_number(df, [F.col("v").asc()], by=["g"], out="rn", parts=3).collect()}
    assert rn == {2: 1, 4: 2, 1: 3, 3: 1, 5: 2}
    c = collapse(df, "v", {"n": F.lit(1)}, by=["g"])
    cum = {(r["g"], r["v"]): r["cum_n"] for r in ordered_cumsum(c, "v", ["n"], by=["g"], parts=2).collect()}
    assert cum == {(None, 1): 1, (None, 2): 2, (None, 3): 3, ("a", 2): 1, ("a", 5): 2}


def test_ordered_row_number_identical_rows(spark):
    from attrition.operators.prefix import ordered_row_number
    rows = [("hot", 1)] * 500 + [("hot", 0)] * 3 + [("cold", 1)] * 2
    df = spark.createDataFrame(rows, "g string, v int")
    got = ordered_row_number(df, [F.col("v").asc()], by=["g"], out="rn", parts=5).toPandas()
    hot = got[got.g == "hot"].sort_values("rn")
    assert list(hot.rn) == list(range(1, 504)) and list(hot.v[:3]) == [0, 0, 0]
    assert sorted(got[got.g == "cold"].rn) == [1, 2]


def test_roc_corners_alike_over_parts(spark):
    rnd = random.Random(3)
    # a third of all rows on one score, runs of equal steps, nulls
    rows = [(rnd.random() < 0.4, 0.5 if rnd.random() < 0.33 else round(rnd.random(), 2)) for _ in range(600)]
    rows += [(True, 1 + i / 10) for i in range(8)] + [(False, -1 - i / 10) for i in range(8)] + [(True, None)]
    df = spark.createDataFrame([(int(y), s) for y, s in rows], "y int, s double")
    steps = {}
    for y, s in rows:
        if s is not None:
            pos, neg = steps.get(s, (0, 0))
            steps[s] = (pos + y, neg + (not y))
    order = sorted(steps, reverse=True)
    keep = {s for i, s in enumerate(order) if i in (0, len(order) - 1) or steps[s] != steps[order[i + 1]]}
    full = {r.threshold: (r.fpr, r.tpr) for r in E.roc_curve(df, "y", "s").collect()}
    for parts in (1, 7):
        got = {r.threshold: (r.fpr, r.tpr) for r in E.roc_curve(df, "y", "s", drop_collinear=True, parts=parts).collect()}
        assert set(got) == keep | {None} and len(keep) < len(order)
        assert all(full[s] == point for s, point in got.items())
    one = spark.createDataFrame([(1, 0.5), (0, 0.5)], "y int, s double")
    assert sorted((r.fpr, r.tpr) for r in E.roc_curve(one, "y", "s", drop_collinear=True).collect()) == [(0.0, 0.0), (1.0, 1.0)]
