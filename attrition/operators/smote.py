"""SMOTE oversampling with exact k-nearest neighbours, as DataFrame jobs.

Exact kNN without comparing all pairs:

1. identical feature vectors are collapsed into one point with a
   multiplicity (a heavy duplicate is one row, not a hot group);
2. every point is projected on two directions of unit length, ``a`` and
   ``b``: ``|a_i - a_j| <= ||x_i - x_j||`` and likewise for ``b``, so the
   rectangle of ``a_i +- r`` and ``b_i +- r`` holds every neighbour within ``r``;
3. an upper bound ``r_i`` on the k-th neighbour distance comes from the
   points of the neighbouring rank buckets on either direction: runs of a
   fixed number of consecutive points, so each point meets a bounded number
   of others;
4. each direction is cut into slices of equally many points, by rank, so a
   far outlier or a dense stretch makes no large slice; a cell is a pair of
   slices. Each point visits the cells its rectangle touches (equi-join on
   the cell); the rectangle, then the true distance decide, and a window per
   point keeps its k nearest (ties by point id). Slice numbers of the
   rectangle's sides are ranks, from the distributed prefix sum.

Synthetic rows are generated by ``spark.range`` and placed with
md5-derived numbers (base row, neighbour slot, gap), joined by equi-joins. A
point with fewer than k others in its class draws from those it has, and a
class of one row yields copies of it, so the number of rows is always exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.columns import hash_unit
from ..session import cut_lineage
from .prefix import collapse, ordered_cumsum, ordered_row_number
from .sampling import class_ranks

#: Neighbouring rank buckets that one group of the radius search holds.
RUN_BUCKETS = 32


def _dist(a: str, b: str) -> Column:
    sq = F.zip_with(F.col(a), F.col(b), lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(sq, F.lit(0.0), lambda acc, x: acc + x))


def collapse_points(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Distinct feature vectors: ``pk`` (md5 of the vector), ``x`` (array<double>), ``m`` (multiplicity)."""
    x = F.array(*[F.col(c).cast("double") for c in features])
    return (df.select(x.alias("x")).groupBy("x").agg(F.count(F.lit(1)).alias("m"))
              .withColumn("pk", F.md5(F.to_json(F.col("x")))))


def _directions(stats, n_features: int) -> list[Column]:
    """Two orthogonal unit directions, weighted by the spread of each feature."""
    w = [float(stats[f"s{i}"] or 0.0) + 1e-9 * (1 + (i * 0.6180339887) % 1) for i in range(n_features)]
    one = math.sqrt(sum(x * x for x in w))
    v = [x / one for x in w]
    u = [x if i % 2 == 0 else -x for i, x in enumerate(v)]
    along = sum(x * y for x, y in zip(u, v))
    u = [x - along * y for x, y in zip(u, v)]
    two = math.sqrt(sum(x * x for x in u)) or 1.0
    return [F.array(*[F.lit(x) for x in v]), F.array(*[F.lit(x / two) for x in u])]


def _with_slices(pts: DataFrame, col: str, size: int) -> DataFrame:
    """Adds ``<col>_s``: the slice of each point, ``size`` points in ``col``
    order each, and ``<col>_lo`` / ``<col>_hi``: the slices of the first and
    last point within ``r`` of it."""
    sides = pts.withColumns({"__lo": F.col(col) - F.col("r"), "__hi": F.col(col) + F.col("r")})
    values = sides.select(F.inline(F.array(F.struct(F.col(col).alias("v"), F.lit(1).alias("n")),
                                           F.struct(F.col("__lo").alias("v"), F.lit(0).alias("n")),
                                           F.struct(F.col("__hi").alias("v"), F.lit(0).alias("n")))))
    ranks = ordered_cumsum(collapse(values, "v", {"n": F.col("n")}), "v", ["n"])
    first = F.floor((F.col("cum_n") - F.col("n")) / size)     # slice of the first point at or after v
    last = F.floor((F.col("cum_n") - 1) / size)               # slice of the last point at or before v
    own = ranks.select(F.col("v").alias("__v"), first.alias(f"{col}_s"))
    lo = ranks.select(F.col("v").alias("__v"), first.alias(f"{col}_lo"))
    hi = ranks.select(F.col("v").alias("__v"), last.alias(f"{col}_hi"))
    out = sides
    for key, side in ((col, own), ("__lo", lo), ("__hi", hi)):
        out = out.join(side, F.col(key) == F.col("__v")).drop("__v")
    return out.drop("__lo", "__hi")


def candidate_pairs(pts: DataFrame, cell_points: int = 32) -> DataFrame:
    """Step 4 up to the distance: ``pk, x, r, q, xq, mq`` for every ordered
    pair whose rectangles allow ``dist <= r``. ``pts``: pk, x, m, a, b, r."""
    n = pts.count()
    size = max(cell_points, math.isqrt(n * cell_points))      # sqrt(n / cell_points) slices each way
    sliced = cut_lineage(_with_slices(cut_lineage(_with_slices(pts, "a", size)), "b", size))
    cells = sliced.select(F.col("pk").alias("q"), F.col("x").alias("xq"), F.col("m").alias("mq"), F.col("a").alias("aq"),
                          F.col("b").alias("bq"), F.col("a_s").alias("ca"), F.col("b_s").alias("cb"))
    visits = (sliced.select("pk", "x", "a", "b", "r", "b_lo", "b_hi", F.explode(F.sequence("a_lo", "a_hi")).alias("ca"))
              .select("pk", "x", "a", "b", "r", "ca", F.explode(F.sequence("b_lo", "b_hi")).alias("cb")))
    return visits.join(cells, ["ca", "cb"]).filter(
        (F.col("q") != F.col("pk")) & (F.abs(F.col("aq") - F.col("a")) <= F.col("r"))
        & (F.abs(F.col("bq") - F.col("b")) <= F.col("r"))).select("pk", "x", "r", "q", "xq", "mq")


def with_radius(points: DataFrame, k: int, n_features: int, bucket_target: int = 32) -> DataFrame:
    """Steps 2 and 3: ``pk, x, m, a, b, r`` of every collapsed point (``r`` is
    infinite where the whole data hold fewer than k others)."""
    stats = points.agg(*[F.stddev_pop(F.col("x")[i]).alias(f"s{i}") for i in range(n_features)]).first()

    def project(v: Column) -> Column:
        return F.aggregate(F.zip_with(F.col("x"), v, lambda p, q: p * q), F.lit(0.0), lambda acc, z: acc + z)

    v, u = _directions(stats, n_features)
    pts = cut_lineage(points.withColumns({"a": project(v), "b": project(u)}))
    # each point meets at most 3 * size others per direction, and at least k of them when the data has k others
    size = max(bucket_target, k + 1)
    found = []
    for col in ("a", "b"):
        ranked = ordered_row_number(pts.select("pk", "x", "m", col), [F.col(col).asc(), F.col("pk").asc()], out="__r")
        ranked = ranked.withColumn("rb", F.floor((F.col("__r") - 1) / F.lit(size)).cast("long"))
        # a point is in the run of its bucket and, at a run's ends, in the next one
        runs = F.array_distinct(F.transform(F.sequence(F.col("rb") - 1, F.col("rb") + 1),
                                            lambda b: F.floor(b / F.lit(RUN_BUCKETS)).cast("long")))
        found.append(ranked.select("pk", "x", "m", "__r", "rb", F.explode(runs).alias("run")).filter("run >= 0")
                     .groupBy("run").applyInArrow(_kth_of_run(k, n_features), "pk string, r double"))
    # a hair wider than the distance, so that rounding of the projections drops no neighbour
    radius = found[0].union(found[1]).groupBy("pk").agg((F.min("r") * (1 + 1e-9) + 1e-9).alias("r"))
    return cut_lineage(pts.join(radius, "pk", "left").withColumn("r", F.coalesce("r", F.lit(float("inf")))))


def knn_exact(points: DataFrame, k: int, n_features: int, bucket_target: int = 32) -> DataFrame:
    """k nearest neighbours (by multiplicity) of every collapsed point.

    Returns ``pk, nb, dist, slot_lo, slot_hi``: neighbour point ``nb`` fills
    neighbour slots ``[slot_lo, slot_hi)`` of ``pk`` (the point itself fills
    the first ``m-1`` slots when it is duplicated).
    """
    pts = with_radius(points, k, n_features, bucket_target)
    near = candidate_pairs(pts, bucket_target).withColumn("d", _dist("x", "xq")).filter(F.col("d") <= F.col("r"))
    return _slots(near.join(pts.select("pk", "m"), "pk"), pts, k)


def _first_k(cand: DataFrame, k: int) -> DataFrame:
    """The k nearest candidates of every point by (distance, id). Every
    candidate fills at least one slot, so nothing beyond them is needed; the
    ``row_number() <= k`` filter plans as a partial WindowGroupLimit, so a
    point with many candidates ships at most k rows per task to the shuffle."""
    w = Window.partitionBy("pk").orderBy("d", "q")
    return cand.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= k).drop("__rn")


def _kth_of_run(k: int, n_features: int):
    """For a run of rank buckets: ``pk, r`` of the points whose neighbour count (own duplicates first, then
    the points of the own and the two next buckets by distance) reaches k, with ``r`` the distance where it does."""
    def run(key: tuple, t: pa.Table) -> pa.Table:
        t = t.sort_by("__r").combine_chunks()
        x = t["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, n_features)
        m, rb = t["m"].to_numpy(), t["rb"].to_numpy()
        r = np.full(t.num_rows, np.nan)
        for b in np.unique(rb[rb // RUN_BUCKETS == key[0].as_py()]):
            lo, hi = np.searchsorted(rb, (b, b + 1))
            first, last = np.searchsorted(rb, (b - 1, b + 2))
            square = np.zeros((hi - lo, last - first))
            for f in range(n_features):
                apart = x[lo:hi, f, None] - x[None, first:last, f]
                square += apart * apart
            mine = np.arange(hi - lo)
            square[mine, mine + lo - first] = np.nan     # not a neighbour of itself, so the last one
            order = np.argsort(square, 1, kind="stable")
            count = m[lo:hi, None] - 1 + np.cumsum(m[first:last][order], 1)
            at = (count >= k).argmax(1)
            reached = (count[mine, at] >= k) & (at < last - first - 1)
            r[lo:hi] = np.where(m[lo:hi] > k, 0.0, np.where(reached, np.sqrt(square[mine, order[mine, at]]), np.nan))
        known = ~np.isnan(r)
        return pa.table({"pk": t["pk"].filter(pa.array(known)), "r": r[known]})
    return run


def _slots(cand: DataFrame, pts: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("pk").orderBy("d", "q").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    c = (_first_k(cand, k).withColumn("hi", F.sum("mq").over(w) + F.col("m") - 1)
             .withColumn("lo", F.col("hi") - F.col("mq"))
             .filter(F.col("lo") < k)
             .select("pk", F.col("q").alias("nb"), "d", F.col("lo").alias("slot_lo"),
                     F.least(F.col("hi"), F.lit(k)).alias("slot_hi")))
    own = (pts.filter(F.col("m") > 1)
              .select("pk", F.col("pk").alias("nb"), F.lit(0.0).alias("d"), F.lit(0).cast("long").alias("slot_lo"),
                      F.least(F.col("m") - 1, F.lit(k)).cast("long").alias("slot_hi")))
    return own.unionByName(c.withColumn("slot_lo", F.col("slot_lo").cast("long"))
                            .withColumn("slot_hi", F.col("slot_hi").cast("long")))


def smote(df: DataFrame, label: str, features: Sequence[str], id_col: str, ratio: float = S.SMOTE_RATIO,
          k: int = S.SMOTE_K, seed: int = S.SEED, minority=1) -> DataFrame:
    """Add synthetic minority rows until minority = ``int(ratio * majority)``.

    Each synthetic row takes a minority row (uniform), one of its k nearest
    minority neighbours (uniform slot) and a gap in [0, 1):
    ``x + gap * (neighbour - x)``. Returns the original rows (features as
    double) plus the synthetic ones, flagged by ``is_synthetic``.
    """
    counts = {r[0]: r[1] for r in df.groupBy(label).count().collect()}   # one row per class
    n_min = counts.get(minority, 0)
    n_maj = max(v for c, v in counts.items() if c != minority) if len(counts) > 1 else 0
    n_new = int(ratio * n_maj) - n_min
    feats = [F.col(c).cast("double").alias(c) for c in features]
    base = df.select(F.col(id_col).cast("string").alias(id_col), F.col(label), *feats,
                     F.lit(False).alias("is_synthetic"))
    if n_new <= 0 or n_min == 0:
        return base
    # the minority rows feed the kNN, the ranks and the synthesis: materialize once
    mino = cut_lineage(base.filter(F.col(label) == minority))
    pts = collapse_points(mino, features)
    # at most k neighbours per point, as one array; the slots run from 0 without gaps
    nbrs = knn_exact(pts, k, len(features)).groupBy("pk").agg(
        F.collect_list(F.struct("slot_lo", "slot_hi", "nb")).alias("nbs"), F.max("slot_hi").alias("slots"))
    ranked = (class_ranks(mino, label, id_col, seed)
              .select(F.col("__rank").alias("rank"), F.array(*[F.col(c) for c in features]).alias("x")))
    spark = df.sparkSession
    s = spark.range(n_new).select(
        F.col("id").alias("s"),
        (F.floor(hash_unit(seed, F.col("id"), "base") * n_min) + 1).alias("rank"),
        hash_unit(seed, F.col("id"), "slot").alias("u"),
        hash_unit(seed, F.col("id"), "gap").alias("gap"))
    with_base = s.join(ranked, "rank").withColumn("pk", F.md5(F.to_json(F.col("x"))))
    slot = F.floor(F.col("u") * F.col("slots"))
    mine = F.filter("nbs", lambda n: (n["slot_lo"] <= F.col("slot")) & (F.col("slot") < n["slot_hi"]))
    picked = (with_base.join(nbrs, "pk", "left").withColumn("slot", slot)
              .withColumn("nb", F.coalesce(F.get(mine, F.lit(0))["nb"], F.col("pk"))).drop("nbs", "slots"))
    nb_x = pts.select(F.col("pk").alias("nb"), F.col("x").alias("xn"))
    syn = (picked.join(nb_x, "nb")
                 .withColumn("xs", F.zip_with("x", "xn", lambda a, b: a + F.col("gap") * (b - a))))
    syn = syn.select(F.concat(F.lit("syn-"), F.col("s").cast("string")).alias(id_col),
                     F.lit(minority).cast(df.schema[label].dataType).alias(label),
                     *[F.col("xs")[i].alias(c) for i, c in enumerate(features)], F.lit(True).alias("is_synthetic"))
    return base.unionByName(syn)
