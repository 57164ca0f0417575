import datetime as dt
import random
import re

import pandas as pd
from pyspark.sql import functions as F

from attrition.operators import sampling as R
from attrition.operators import store as J
from attrition.session import scratch_path


def _brute_pit(labels, feats, ttl_days):
    out = {}
    for lid, key, lt in labels:
        cands = [f for f in feats if f[0] == key and f[1] <= lt and f[1] >= lt - dt.timedelta(days=ttl_days)]
        best = max(cands, key=lambda f: (f[1], f[2])) if cands else None
        out[lid] = best[3] if best else None
    return out


def test_point_in_time_join_matches_brute_force(spark):
    rnd = random.Random(7)
    base = dt.datetime(2020, 1, 1)
    feats = [("hot" if rnd.random() < 0.4 else f"k{rnd.randint(0, 9)}",
              base + dt.timedelta(hours=rnd.randint(0, 24 * 60)), i, float(i)) for i in range(400)]
    labels = [(i, "hot" if rnd.random() < 0.4 else f"k{rnd.randint(0, 11)}",
               base + dt.timedelta(hours=rnd.randint(0, 24 * 70))) for i in range(300)]
    fdf = spark.createDataFrame(feats, "key string, ts timestamp, tie long, v double")
    ldf = spark.createDataFrame(labels, "lid long, key string, lts timestamp")
    want = _brute_pit(labels, feats, 10)
    for parts in (1, 3, 16):
        got = J.point_in_time_join(ldf, fdf, "key", "lts", "ts", None, ttl_days=10, tie=["tie"],
                                   features=["v"], partitions=parts)
        res = {r["lid"]: r["v"] for r in got.collect()}
        assert res == want, parts


def test_latest_per_entity_tie_break(spark):
    t = dt.datetime(2021, 1, 1)
    df = spark.createDataFrame([("a", t, t, 1, "x"), ("a", t, t, 2, "y"), ("b", t, t, 3, "z")],
                               "k string, e timestamp, c timestamp, id long, f string")
    out = {r["k"]: r["f"] for r in J.latest_per_entity(df, "k", "e", "c", tie=["id"]).collect()}
    assert out == {"a": "y", "b": "z"}


def test_latest_batch_by_time_and_run(spark):
    t1, t2 = dt.datetime(2021, 1, 1), dt.datetime(2021, 1, 2)
    df = spark.createDataFrame([(t1, "r1"), (t2, "r2"), (t2, "r2"), (t1, "r3")], "ts timestamp, run string")
    assert J.latest_batch(df, "ts").count() == 2
    assert J.latest_batch(df, "ts", by_run="run").count() == 2


def test_split_sizes_exact_and_layout_free(spark):
    rows = [(f"id{i:05d}", 1 if i % 4 == 0 else 0) for i in range(2003)]
    df = spark.createDataFrame(rows, "id string, y int")
    a = R.stratified_split(df.repartition(1), "y", "id")
    b = R.stratified_split(df.repartition(7), "y", "id")
    pa = a.toPandas().sort_values("id").reset_index(drop=True)
    pb = b.toPandas().sort_values("id").reset_index(drop=True)
    assert pa.equals(pb)
    for y, n in pa.groupby("y").size().items():
        sub = pa[pa.y == y]
        k_test = int(pd.Series([n * 0.2]).round().iloc[0]) if (n * 0.2) % 1 != 0.5 else int(n * 0.2 + 0.5)
        assert (sub.split == "test").sum() == k_test


def test_folds_balanced(spark):
    df = spark.createDataFrame([(f"id{i}", i % 3 == 0) for i in range(1000)], "id string, y boolean")
    f = R.assign_folds(df, "y", "id", k=5).groupBy("y", "fold").count().toPandas()
    for _, g in f.groupby("y"):
        assert g["count"].max() - g["count"].min() <= 1


def test_hash_sample_repeatable(spark):
    df = spark.range(5000).withColumn("id", F.col("id").cast("string"))
    a = sorted(r["id"] for r in R.hash_sample(df.repartition(3), "id", 100).collect())
    b = sorted(r["id"] for r in R.hash_sample(df.repartition(9), "id", 100).collect())
    assert a == b and len(a) == 100


def test_point_in_time_join_null_keys_and_one_hot_instant(spark):
    t = dt.datetime(2021, 3, 1)
    feats = [("hot", t, i, float(i)) for i in range(50)] + [(None, t, 99, 99.0),
                                                             ("b", t + dt.timedelta(days=1), 1, 1.0)]
    labels = [(i, "hot", t) for i in range(40)] + [(100, None, t), (101, "b", None), (102, "b", t),
                                                   (103, "b", t + dt.timedelta(days=2))]
    fdf = spark.createDataFrame(feats, "key string, ts timestamp, tie long, v double")
    ldf = spark.createDataFrame(labels, "lid long, key string, lts timestamp")
    for parts in (1, 5):
        got = {r["lid"]: r["v"] for r in J.point_in_time_join(
            ldf, fdf, "key", "lts", "ts", None, ttl_days=10, tie=["tie"], features=["v"],
            partitions=parts).collect()}
        want = {**{i: 49.0 for i in range(40)}, 100: None, 101: None, 102: None, 103: 1.0}
        assert got == want, parts


def test_split_with_a_hot_repeated_id(spark):
    rows = [(f"c{i:05d}", i % 3 == 0) for i in range(1800)] + [("dup", True)] * 1200
    df = spark.createDataFrame(rows, "id string, y boolean").withColumn("y", F.col("y").cast("int"))
    out = R.stratified_split(df, "y", "id", 0.2, 0.1, 42).toPandas()
    for cls, n in ((1, 600 + 1200), (0, 1200)):
        sub = out[out.y == cls]
        assert len(sub) == n
        k_test = round(n * 0.2)
        k_val = round((n - k_test) * 0.1)
        assert (sub.split == "test").sum() == k_test and (sub.split == "val").sum() == k_val


def test_ranks_follow_the_hash_and_are_repeatable_for_repeated_ids(spark):
    import hashlib
    rows = [(f"c{i % 700:05d}", i % 4 == 0, i) for i in range(2000)]
    df = spark.createDataFrame(rows, "id string, y boolean, v int")
    one = {r["v"]: r["__rank"] for r in R.class_ranks(df, "y", "id", 42).collect()}
    two = {r["v"]: r["__rank"] for r in R.class_ranks(df.repartition(7, "v"), "y", "id", 42).collect()}
    assert one == two
    for y in (True, False):
        got = [i for i, f, v in sorted((r for r in rows if r[1] == y), key=lambda r: one[r[2]])]
        assert got == sorted(got, key=lambda i: (hashlib.md5(f"42:{i}".encode()).hexdigest(), i))


def _increments(spark, rows, path, bounds, buckets=8):
    src = spark.createDataFrame(rows, "k string, e timestamp, seen timestamp, id long")
    return [J.materialize_increment(src, path, "k", "e", "seen", upto=u, tie=["id"], buckets=buckets) for u in bounds], src


def test_increments_equal_one_full_run(spark):
    """Late rows, a hot and a null key, rows without an arrival time, ties; a run repeated changes nothing."""
    rnd, t0 = random.Random(5), dt.datetime(2024, 1, 1)
    rows = []
    for i in range(600):
        key = rnd.choice(["hot", "hot", None] + [f"k{j}" for j in range(40)])
        e = t0 + dt.timedelta(hours=rnd.randint(0, 200))
        seen = None if i % 50 == 0 else e + dt.timedelta(hours=rnd.choice([0, 1, 90]))
        rows.append((key, e, seen, i))
    path = scratch_path(spark, "increments")
    hours = lambda h: t0 + dt.timedelta(hours=h)
    for upto in (60, 60, 150, None):
        touched, src = _increments(spark, rows, path, [hours(upto) if upto else None])
        part = src.filter(F.col("seen").isNull() | (F.col("seen") <= F.lit(hours(upto or 10_000))))
        want = J.latest_per_entity(part.drop("seen"), "k", "e", tie=["id"])
        got = J.read_materialized(spark, path)
        assert sorted(map(str, got.select("k", "e", "id").collect())) == sorted(map(str, want.select("k", "e", "id").collect()))
    assert J.high_water_mark(spark, path) == max(r[2] for r in rows if r[2])


def test_an_increment_leaves_other_buckets_alone(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(f"k{i}", t0, t0, i) for i in range(200)]
    path = scratch_path(spark, "touched")
    (first,), _ = _increments(spark, rows, path, [t0])
    assert first == list(range(8))
    files = lambda: {f.split("/rows/")[1] for f in spark.read.parquet(f"{path}/rows").inputFiles()}
    before, later = files(), t0 + dt.timedelta(days=1)
    (second, third), _ = _increments(spark, rows + [("k7", later, later, 999)], path, [later, later])
    assert len(second) == 1 and third == []
    assert {f.split("/")[0] for f in before ^ files()} == {f"{J.BUCKET}={second[0]}"}
    rows = J.read_materialized(spark, path)
    assert rows.count() == 200 and rows.filter("k = 'k7'").first().id == 999
    # the merge reads the touched bucket only
    plan = spark.read.parquet(f"{path}/rows").filter(F.col(J.BUCKET).isin(second))._jdf.queryExecution().executedPlan().toString()
    assert re.search(rf"PartitionFilters: \[.*{J.BUCKET}#\d+ = {second[0]}", plan), plan


def test_increments_of_an_empty_table(spark):
    path = scratch_path(spark, "nothing")
    (touched,), _ = _increments(spark, [], path, [None])
    assert touched == [] and J.high_water_mark(spark, path) is None


def _above_store_scans(plan, marks):
    """The operators between each store scan and the root of a plan tree."""
    lines, out = plan.split("\n"), []
    depth = lambda line: len(line) - len(re.sub(r"^[\s:+|-]*", "", line))
    for i, line in enumerate(lines):
        if "FileScan" in line and any(m in line for m in marks):
            d, above = depth(line), []
            for j in range(i - 1, -1, -1):
                if depth(lines[j]) < d:
                    d = depth(lines[j])
                    above.append(lines[j])
                    if "Join" in lines[j]:
                        break
            out.append(above)
    return out


def test_bucketed_store_is_never_shuffled(spark):
    own = spark.newSession()
    own.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # as with a store of many GB
    own.conf.set("spark.sql.session.timeZone", "UTC")
    store = own.range(500).select(F.concat(F.lit("k"), "id").alias("k"), (F.col("id") * 2).alias("a"), (F.col("id") % 7).alias("b"))
    # a hot key, unknown keys, null keys and repeated ones
    keys = own.range(3000).select("id", F.when(F.col("id") % 3 == 0, "k7").when(F.col("id") % 11 == 0, None)
                                  .otherwise(F.concat(F.lit("k"), F.col("id") % 900)).alias("k"))
    want = sorted(J.feature_lookup(keys, store, "k", ["v:a", "b"]).collect(), key=lambda r: r.id)
    for n in (3, 8):
        path = scratch_path(own, "bucketed")
        table = J.write_bucketed(store, f"bucketed_{n}", path, "k", n)
        got = J.feature_lookup(keys, J.asked_rows(table, keys, "k", n), "k", ["v:a", "b"])
        assert sorted(got.collect(), key=lambda r: r.id) == want
        asked = J.asked_rows(table, keys, "k", n)._jdf.queryExecution().executedPlan().toString()
        above = _above_store_scans(asked, ["Bucketed: true"])
        assert len(above) == 1 and "Join" in above[0][-1] and not [x for x in above[0] if "Exchange" in x], asked
        # views of one bucket count: no exchange anywhere in the assembly
        views = {c: (J.write_bucketed(store.select("k", c).filter(f"{c} % 3 > 0"), f"view_{c}_{n}", scratch_path(own, c), "k", n), [c])
                 for c in ("a", "b")}
        ids = J.write_bucketed(store.select("k"), f"ids_{n}", scratch_path(own, "ids"), "k", n)
        out = J.assemble_bucketed(ids, views, "k")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and plan.count("Bucketed: true") == 3, plan
        rows = {r.k: (r.a, r.b) for r in out.collect()}
        assert rows == {f"k{i}": (i * 2 if i * 2 % 3 else None, i % 7 if i % 7 % 3 else None) for i in range(500)}


def test_fill_from_a_bucketed_store(spark):
    store = spark.createDataFrame([("a", 1.0, 2.0), ("b", 3.0, None)], "k string, x double, y double")
    reqs = spark.createDataFrame([(1, "a", None, None), (2, "a", 9.0, None), (3, "z", None, None), (4, None, None, None),
                                  (5, "b", None, None), (6, "a", None, None)], "id int, k string, x double, y double")
    table = J.write_bucketed(store, "fill_store", scratch_path(spark, "fill"), "k", 4)
    got = J.fill_from_store(reqs, J.asked_rows(table, reqs, "k", 4), "k", ["x", "y"])
    assert sorted(map(tuple, got.collect()), key=lambda r: r[0]) == [
        (1, "a", 1.0, 2.0), (2, "a", 9.0, None), (3, "z", None, None), (4, None, None, None), (5, "b", 3.0, None), (6, "a", 1.0, 2.0)]
    none = J.write_bucketed(store.limit(0), "empty_store", scratch_path(spark, "none"), "k", 4)
    assert J.asked_rows(none, reqs, "k", 4).count() == 0 and J.asked_rows(table, reqs.limit(0), "k", 4).count() == 0
