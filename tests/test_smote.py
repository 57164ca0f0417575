import numpy as np
from pyspark.sql import functions as F

from attrition.operators.smote import collapse_points, knn_exact, smote


def _brute(points, mult, k):
    out = {}
    for i, p in enumerate(points):
        slots = [(0.0, i)] * (mult[i] - 1)
        others = sorted((float(np.linalg.norm(p - q)), j) for j, q in enumerate(points) if j != i)
        for d, j in others:
            slots += [(d, j)] * mult[j]
        out[i] = sorted(d for d, _ in slots[:k])
    return out


def test_knn_exact_matches_brute_force(spark):
    rng = np.random.default_rng(0)
    base = np.round(rng.normal(0, 1, (120, 3)) * [10, 1, 0.1], 2)
    rows = [tuple(map(float, r)) for r in base] + [tuple(map(float, base[0]))] * 3 + [tuple(map(float, base[5]))]
    df = spark.createDataFrame(rows, "f0 double, f1 double, f2 double")
    pts = collapse_points(df, ["f0", "f1", "f2"])
    nb = knn_exact(pts, 5, 3, bucket_target=4)
    pp = pts.toPandas()
    vecs = [np.array(x) for x in pp.x]
    want = _brute(vecs, list(pp.m), 5)
    key = {pk: i for i, pk in enumerate(pp.pk)}
    got = nb.toPandas()
    for pk, g in got.groupby("pk"):
        i = key[pk]
        d = sorted(sum(([r.d] * int(r.slot_hi - r.slot_lo) for r in g.itertuples()), []))
        assert np.allclose(d, want[i]), (i, d, want[i])
    assert got.groupby("pk").slot_hi.max().eq(5).all()


def test_smote_counts_and_range(spark):
    rng = np.random.default_rng(1)
    rows = [(f"r{i}", int(i % 4 == 0), float(rng.integers(0, 72)), float(rng.normal(60, 20)), float(i % 2))
            for i in range(400)]
    df = spark.createDataFrame(rows, "id string, y int, tenure double, monthly double, flag double")
    out = smote(df, "y", ["tenure", "monthly", "flag"], "id", ratio=0.7, k=5)
    c = {(r["y"], r["is_synthetic"]): r["count"] for r in out.groupBy("y", "is_synthetic").count().collect()}
    assert c[(1, False)] + c[(1, True)] == int(0.7 * 300)
    syn = out.filter("is_synthetic").toPandas()
    mino = df.filter("y = 1").toPandas()
    assert syn.tenure.between(mino.tenure.min(), mino.tenure.max()).all()
    assert syn.flag.between(0, 1).all()
    again = smote(df, "y", ["tenure", "monthly", "flag"], "id", ratio=0.7, k=5).filter("is_synthetic")
    assert again.exceptAll(out.filter("is_synthetic")).count() == 0


def _check_knn(spark, rows, k, bucket_target):
    df = spark.createDataFrame(rows, "f0 double, f1 double, f2 double")
    pts = collapse_points(df, ["f0", "f1", "f2"])
    nb = knn_exact(pts, k, 3, bucket_target=bucket_target)
    pp = pts.toPandas()
    want = _brute([np.array(x) for x in pp.x], list(pp.m), k)
    key = {pk: i for i, pk in enumerate(pp.pk)}
    got = nb.toPandas()
    assert set(got.pk) == set(pp.pk[[len(w) > 0 for w in want.values()]])
    for pk, g in got.groupby("pk"):
        d = sorted(sum(([r.d] * int(r.slot_hi - r.slot_lo) for r in g.itertuples()), []))
        assert np.allclose(d, want[key[pk]]), (pk, d, want[key[pk]])


def test_knn_exact_dense_cluster_and_tiny_data(spark):
    rng = np.random.default_rng(4)
    dense = np.round(rng.normal(0, 0.01, (60, 3)), 4)          # a third of the points in one tight spot
    spread = np.round(rng.normal(0, 5, (120, 3)), 3)
    rows = [tuple(map(float, r)) for r in np.vstack([dense, spread])]
    _check_knn(spark, rows, 5, 8)
    _check_knn(spark, [(0.0, 0.0, 0.0), (1.0, 0.0, 0.0), (0.0, 2.0, 0.0)], 5, 32)   # fewer than k others


def test_smote_row_count_is_exact_for_tiny_minorities(spark):
    for n_min in (1, 2, 4, 5, 6):
        rows = [(f"a{i}", 0, float(i), 1.0) for i in range(40)] + [(f"b{i}", 1, float(i), 0.0) for i in range(n_min)]
        df = spark.createDataFrame(rows, "id string, y int, u double, v double")
        out = smote(df, "y", ["u", "v"], "id", ratio=0.7, k=5)
        assert out.filter("is_synthetic").count() == int(0.7 * 40) - n_min, n_min
        assert out.filter("y = 1 and (u < 0 or u > 5 or v <> 0)").count() == 0


def test_a_far_outlier_makes_no_large_slice(spark):
    from attrition.operators.smote import _with_slices, with_radius
    rng = np.random.default_rng(2)
    rows = [tuple(map(float, r)) for r in rng.uniform(0, 1, (1000, 3))] + [(1e9, 1e9, 1e9)]
    pts = with_radius(collapse_points(spark.createDataFrame(rows, "f0 double, f1 double, f2 double"), ["f0", "f1", "f2"]), 5, 3)
    for col in ("a", "b"):
        largest = _with_slices(pts, col, 100).groupBy(f"{col}_s").count().agg(F.max("count")).first()[0]
        assert largest <= 100


def test_candidate_pairs_hold_all_neighbours_and_stay_few(spark):
    from attrition.operators.smote import candidate_pairs, with_radius
    rng = np.random.default_rng(3)
    per_point = {}
    for n in (300, 1200):
        rows = [tuple(map(float, r)) for r in rng.uniform(0, 1, (n, 3))]
        pts = with_radius(collapse_points(spark.createDataFrame(rows, "f0 double, f1 double, f2 double"), ["f0", "f1", "f2"]), 5, 3)
        per_point[n] = candidate_pairs(pts).count() / n
    assert per_point[1200] < 1200 / 4 and per_point[1200] < 4 * per_point[300]


def test_the_radius_is_the_kth_distance_within_the_next_buckets(spark, monkeypatch):
    """At the ends of a run as inside it: the k-th neighbour among the own and the two next buckets, on either direction."""
    from attrition.operators import smote as SM
    monkeypatch.setattr(SM, "RUN_BUCKETS", 2)
    rng = np.random.default_rng(7)
    rows = [tuple(map(float, r)) for r in rng.integers(0, 40, (300, 3))]
    got = SM.with_radius(collapse_points(spark.createDataFrame(rows, "f0 double, f1 double, f2 double"), ["f0", "f1", "f2"]),
                         5, 3, bucket_target=8).toPandas()
    best = {}
    for col in ("a", "b"):
        p = got.sort_values([col, "pk"], ignore_index=True)
        x, bucket = np.array(p.x.tolist()), np.arange(len(p)) // 8
        for i in range(len(p)):
            near = [j for j in np.flatnonzero(abs(bucket - bucket[i]) <= 1) if j != i]
            slots = [0.0] * (p.m[i] - 1) + sorted(d for j in near for d in [float(np.linalg.norm(x[i] - x[j]))] * p.m[j])
            if len(slots) >= 5:
                best[p.pk[i]] = min(best.get(p.pk[i], np.inf), slots[4])
    assert len(best) == len(got)
    assert np.allclose(got.r, got.pk.map(best))
