"""Two-sample drift statistics per column, drift summary and the retrain rule.

Both samples are unpivoted into long ``(column, value, is_ref)`` rows and
counted per distinct value in one partial-aggregated shuffle; cumulative
distributions come from the distributed prefix sum. Per-column results are a
handful of rows, so the final statistics (p-values, decisions) are plain
column expressions on them.

Tests (the original delegates to a drift library's defaults; we fix
published ones). The test is an argument and never depends on the data:
numeric columns take ``test="wasserstein"`` (Wasserstein-1 distance normed by
the reference standard deviation, drift at >= 0.1) or ``"ks"`` (two-sample
Kolmogorov-Smirnov, asymptotic p < 0.05); categorical columns take
``"jensenshannon"`` (distance, drift at >= 0.1) or ``"chisquare"`` (goodness of
fit of current counts to reference shares, p < 0.05). Every statistic is
reported whatever the test, and PSI for both kinds.
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..session import cut_lineage
from .prefix import collapse, ordered_cumsum, range_parts

ALPHA = 0.05
DISTANCE_THRESHOLD = 0.1
PSI_EPS = 0.0001


# -- p-values as column expressions ---------------------------------------------

def chi2_pvalue(x: Column, dof: Column) -> Column:
    """Survival function of the chi-square distribution for integer degrees of
    freedom: 1 - P(dof/2, x/2) by the power series of the lower incomplete
    gamma function, scaled by the Poisson-like leading term. Far in the upper
    tail (below 1e-80) it is 0."""
    odd = F.pmod(dof, F.lit(2))
    a, z = dof / F.lit(2.0), x / F.lit(2.0)
    half = F.ceil(a).cast("int")   # gamma(a + 1) as a product of integers or half-integers
    log_gamma = F.aggregate(F.sequence(F.lit(1), F.greatest(half, F.lit(1))), odd * F.lit(0.5 * math.log(math.pi)),
                            lambda acc, j: acc + F.log(j - odd * F.lit(0.5)))
    lead = F.exp(a * F.log(z) - z - log_gamma)
    far = z > a + F.lit(20.0) * F.sqrt(a) + F.lit(200.0)
    near_z = F.when(far, F.lit(1.0)).otherwise(z)   # bounds the length of the series
    n = (F.greatest(near_z - a, F.lit(0.0)) + F.lit(12.0) * F.sqrt(near_z) + F.lit(60.0)).cast("int")
    zero = F.struct(lead.alias("term"), lead.alias("total"))
    series = F.aggregate(F.sequence(F.lit(1), n), zero, lambda acc, i: F.struct(
        (acc["term"] * z / (a + i)).alias("term"), (acc["total"] + acc["term"] * z / (a + i)).alias("total")),
        lambda acc: acc["total"])
    return (F.when((dof <= 0) | (x <= 0), F.lit(1.0)).when(far, F.lit(0.0))
            .otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.lit(1.0) - series))))


def ks_pvalue(d: Column, n: Column, m: Column, terms: int = 100) -> Column:
    """Asymptotic two-sample KS p-value (Kolmogorov series with Stephens'
    small-sample correction), as a column expression."""
    en = F.sqrt(n.cast("double") * m.cast("double") / (n + m).cast("double"))
    lam = (en + F.lit(0.12) + F.lit(0.11) / en) * d
    series = F.aggregate(F.sequence(F.lit(1), F.lit(terms)), F.lit(0.0),
                         lambda acc, j: acc + F.pow(F.lit(-1.0), j - 1) * F.exp(F.lit(-2.0) * j * j * lam * lam))
    return F.when(lam < 0.2, F.lit(1.0)).otherwise(F.greatest(F.least(F.lit(2.0) * series, F.lit(1.0)), F.lit(0.0)))


# -- long form -----------------------------------------------------------------

def to_long(ref: DataFrame, cur: DataFrame, cols: Sequence[str], dtype: str = "double") -> DataFrame:
    """``(column, value, is_ref)`` rows of both samples."""
    def one(df: DataFrame, flag: int) -> DataFrame:
        arr = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast(dtype).alias("value")) for c in cols])
        return df.select(F.inline(arr)).withColumn("is_ref", F.lit(flag))
    return one(ref, 1).unionByName(one(cur, 0))


def drift_numeric(ref: DataFrame, cur: DataFrame, cols: Sequence[str], test: str = "wasserstein",
                  psi_bins: int = 10, scale: int = 6) -> DataFrame:
    """Per numeric column: KS statistic and p-value, Wasserstein-1 (raw
    and normed), PSI, the test used, its statistic and the drift flag."""
    if test not in ("wasserstein", "ks"):
        raise ValueError(f"unknown numeric drift test {test}")
    long = to_long(ref, cur, cols).filter(F.col("value").isNotNull())
    c = collapse(long, "value", {"n_ref": F.col("is_ref"), "n_cur": F.lit(1) - F.col("is_ref")}, by=["column"])
    # the distinct-value table feeds six branches: pinned once, in the range parts of the running sums
    c = range_parts(c, "value", by=["column"])
    tot = c.groupBy("column").agg(F.sum("n_ref").alias("tot_ref"), F.sum("n_cur").alias("tot_cur"))
    cu = ordered_cumsum(c, "value", ["n_ref", "n_cur"], by=["column"], with_next=True, pinned=True).join(tot, "column")
    gap = F.abs(F.col("cum_n_ref") / F.col("tot_ref") - F.col("cum_n_cur") / F.col("tot_cur"))
    ks = cu.groupBy("column").agg(
        F.first("tot_ref").alias("n_ref"), F.first("tot_cur").alias("n_cur"), F.max(gap).alias("__ks"),
        F.sum(gap * F.coalesce(F.col("next_value") - F.col("value"), F.lit(0.0))).alias("__w"))
    # reference spread, range and PSI bins from the distinct values (no rescan of the samples)
    refv = c.filter(F.col("n_ref") > 0)
    mom = refv.groupBy("column").agg(F.min("value").alias("mn"), F.max("value").alias("mx"),
                                     (F.sum(F.col("n_ref") * F.col("value")) / F.sum("n_ref")).alias("mean"))
    var = (refv.join(mom, "column")
               .groupBy("column").agg((F.sum(F.col("n_ref") * (F.col("value") - F.col("mean")) ** 2)
                                       / F.sum("n_ref")).alias("var")))
    rs = mom.join(var, "column").select("column", "mn", "mx", F.sqrt("var").alias("sd"))
    # PSI over equal-width bins of the reference range
    raw_bin = F.floor((F.col("value") - F.col("mn")) / (F.col("mx") - F.col("mn")) * psi_bins)
    bin_ = F.when(F.col("mx") > F.col("mn"), F.least(F.greatest(raw_bin, F.lit(0)), F.lit(psi_bins - 1))).otherwise(0)
    pb = c.join(rs, "column").groupBy("column", bin_.alias("bin")).agg(F.sum("n_ref").alias("nr"),
                                                                       F.sum("n_cur").alias("nc"))
    psi = _psi(pb.join(tot, "column"))
    out = ks.join(rs, "column").join(psi.withColumnRenamed("psi", "__psi"), "column")
    r = lambda x: F.round(x, scale)
    ks_stat, wass = r(F.col("__ks")), r(F.col("__w"))
    w_norm = r(F.when(F.col("sd") > 0, F.col("__w") / F.col("sd")))
    ks_p = r(ks_pvalue(F.col("__ks"), F.col("n_ref"), F.col("n_cur")))
    stat = ks_p if test == "ks" else w_norm
    drifted = F.coalesce(stat < ALPHA if test == "ks" else stat >= DISTANCE_THRESHOLD, F.lit(False))
    return out.select("column", "n_ref", "n_cur", ks_stat.alias("ks_stat"), ks_p.alias("ks_pvalue"),
                      wass.alias("wasserstein"), w_norm.alias("wasserstein_norm"), r(F.col("__psi")).alias("psi"),
                      F.lit(test).alias("stat_test"), stat.alias("statistic"), drifted.alias("drifted"))


def _psi(t: DataFrame) -> DataFrame:
    pr = F.when(F.col("nr") == 0, F.lit(PSI_EPS)).otherwise(F.col("nr") / F.col("tot_ref"))
    pc = F.when(F.col("nc") == 0, F.lit(PSI_EPS)).otherwise(F.col("nc") / F.col("tot_cur"))
    return t.groupBy("column").agg(F.sum((pc - pr) * F.log(pc / pr)).alias("psi"))


def drift_categorical(ref: DataFrame, cur: DataFrame, cols: Sequence[str], test: str = "jensenshannon",
                      scale: int = 6) -> DataFrame:
    """Per categorical column: chi-square statistic, degrees of freedom and
    p-value (any number of categories), Jensen-Shannon distance, PSI, the test
    used, its statistic and the drift flag."""
    if test not in ("jensenshannon", "chisquare"):
        raise ValueError(f"unknown categorical drift test {test}")
    long = to_long(ref, cur, cols, "string").filter(F.col("value").isNotNull())
    c = cut_lineage(long.groupBy("column", "value").agg(F.sum("is_ref").alias("nr"),
                                                        F.sum(F.lit(1) - F.col("is_ref")).alias("nc")))
    tot = c.groupBy("column").agg(F.sum("nr").alias("tot_ref"), F.sum("nc").alias("tot_cur"))
    t = c.join(tot, "column")
    p = F.col("nr") / F.col("tot_ref")
    q = F.col("nc") / F.col("tot_cur")
    m = (p + q) / 2
    e = p * F.col("tot_cur")
    stats = t.groupBy("column").agg(
        F.first("tot_ref").alias("n_ref"), F.first("tot_cur").alias("n_cur"),
        F.sum((F.col("nr") > 0).cast("int")).alias("k_ref"),
        F.bool_or((F.col("nr") == 0) & (F.col("nc") > 0)).alias("unseen"),
        F.sum(F.when(F.col("nr") > 0, (F.col("nc") - e) * (F.col("nc") - e) / e)).alias("chi2"),
        F.sum(F.when(p > 0, p * F.log(p / m))).alias("kl_pm"),
        F.sum(F.when(q > 0, q * F.log(q / m))).alias("kl_qm"))
    psi = _psi(t)
    r = lambda x: F.round(x, scale)
    chi2 = r(F.when(F.col("unseen"), F.lit(float("inf"))).otherwise(F.coalesce(F.col("chi2"), F.lit(0.0))))
    dof = (F.col("k_ref") - 1).cast("int")
    js = r(F.sqrt(F.greatest(F.lit(0.0), F.lit(0.5) * F.coalesce(F.col("kl_pm"), F.lit(0.0))
                             + F.lit(0.5) * F.coalesce(F.col("kl_qm"), F.lit(0.0)))))
    joined = stats.join(psi, "column").select(
        "column", "n_ref", "n_cur", chi2.alias("chi2"), dof.alias("dof"), js.alias("js_distance"), r(F.col("psi")).alias("psi"))
    out = joined.withColumn("chi2_pvalue", r(chi2_pvalue(F.col("chi2"), F.col("dof"))))
    stat = F.col("chi2_pvalue") if test == "chisquare" else F.col("js_distance")
    drifted = F.coalesce(stat < ALPHA if test == "chisquare" else stat >= DISTANCE_THRESHOLD, F.lit(False))
    return out.select("column", "n_ref", "n_cur", "chi2", "dof", "chi2_pvalue", "js_distance", "psi",
                      F.lit(test).alias("stat_test"), stat.alias("statistic"), drifted.alias("drifted"))


def drift_summary(num: DataFrame, cat: DataFrame | None, reference_rows: Column, current_rows: Column,
                  threshold: float = S.DRIFT_THRESHOLD) -> DataFrame:
    """D3: drifted columns, columns compared, drift share, dataset drift flag."""
    parts = num.select("column", "drifted")
    if cat is not None:
        parts = parts.unionByName(cat.select("column", "drifted"))
    share = F.sum(F.col("drifted").cast("long")) / F.count(F.lit(1))
    return parts.agg(
        F.sum(F.col("drifted").cast("long")).alias("drifted_features"),
        F.count(F.lit(1)).alias("total_features"),
        F.round(share, 6).alias("drift_score"),
        (F.round(share, 6) >= F.lit(threshold)).alias("drift_detected"),
        F.lit(threshold).alias("drift_threshold"),
        reference_rows.alias("reference_rows"),
        current_rows.alias("current_rows"),
    )


def missing_compare(ref: DataFrame, cur: DataFrame) -> DataFrame:
    """Null count per common column on each side."""
    from .quality import null_profile
    cols = [c for c in ref.columns if c in set(cur.columns)]
    a = null_profile(ref.select(*cols)).withColumnRenamed("null_count", "reference_missing")
    b = null_profile(cur.select(*cols)).withColumnRenamed("null_count", "current_missing")
    return a.join(b, "column")


def retrain_decision(summary: DataFrame, threshold: float = S.DRIFT_THRESHOLD,
                     auto: bool = S.AUTO_RETRAIN, keep: Sequence[str] = ()) -> DataFrame:
    """Trigger when drift score >= threshold and automatic retraining is on."""
    over = F.col("drift_score") >= F.lit(threshold)
    return summary.select(
        "drift_score", *keep,
        (over & F.lit(bool(auto))).alias("retraining_triggered"),
        F.when(~over, F.lit("drift below threshold"))
         .when(F.lit(bool(auto)), F.lit("drift score at or above threshold"))
         .otherwise(F.lit("drift detected but automatic retraining is disabled")).alias("reason"))
