import datetime as dt

from pyspark.sql import functions as F

from attrition.operators import aggregate as A
from attrition.operators import monitor as W


def test_histogram_quantile_interpolates(spark):
    df = spark.createDataFrame([(x,) for x in [0.02, 0.03, 0.2, 0.3, 0.4, 0.6, 0.7, 0.8, 2.0, 3.0]], "x double")
    h = A.histogram_le(df, "x", [0.1, 0.5, 1.0])
    q = A.histogram_quantile(h, 0.5).first()["quantile"]
    # rank 5 falls in (0.1, 0.5] holding ranks 3..5 -> upper edge
    assert abs(q - 0.5) < 1e-12
    q95 = A.histogram_quantile(h, 0.95).first()["quantile"]
    assert q95 == 1.0   # +Inf bucket -> last finite edge


def test_alert_for_needs_hold(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(t0 + dt.timedelta(minutes=m), v) for m, v in
            [(1, 2.0), (2, 2.0), (3, 2.0), (5, 2.0), (6, 0.1), (7, 2.0)]]
    df = spark.createDataFrame(rows, "window_end timestamp, q double")
    fired = W.alert_for(df, F.col("q") > 1.0, "2 minutes").collect()
    assert [r["window_end"].minute for r in fired] == [3]


def test_absence_alert(spark):
    t0 = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(t0,), (t0 + dt.timedelta(minutes=3, seconds=5),)], "ts timestamp")
    gaps = sorted(r["slot_start"].minute for r in W.absence_alert(df, "ts").collect())
    assert gaps == [1, 2]


def test_alert_on_samples(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(t0, 0.3), (t0 + dt.timedelta(minutes=2), 0.4), (t0 + dt.timedelta(minutes=6), 0.1),
            (t0 + dt.timedelta(minutes=7), 0.5), (t0 + dt.timedelta(minutes=8), 0.1)]
    df = spark.createDataFrame(rows, "ts timestamp, v double")
    ep = W.alert_on_samples(df, "ts", F.col("v") > 0.2, "5 minutes").collect()
    assert len(ep) == 1 and ep[0]["active_since"] == t0


def _episodes_brute(rows, hold_s):
    """Walk each series in time order; false samples at an instant end a run."""
    out = set()
    by_g = {}
    for g, t, v in rows:
        by_g.setdefault(g, {}).setdefault(t, []).append(v > 0.2)
    for g, inst in by_g.items():
        start = None
        for t in sorted(inst):
            if start is None and any(inst[t]):
                start = t
            if start is not None and not all(inst[t]):
                if (t - start).total_seconds() >= hold_s:
                    out.add((g, start, t))
                start = None
        if start is not None:
            out.add((g, start, None))
    return out


def test_alert_on_samples_matches_brute_force(spark):
    import random
    rnd = random.Random(7)
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for g in ("a", "b"):
        for i in range(300):
            # distinct instants per series: ties between true and false are covered below
            rows.append((g, t0 + dt.timedelta(minutes=i), rnd.choice([0.1, 0.3, 0.3, 0.5])))
    df = spark.createDataFrame(rows, "g string, ts timestamp, v double")
    got = {(r["g"], r["active_since"], r["resolved_at"])
           for r in W.alert_on_samples(df, "ts", F.col("v") > 0.2, "5 minutes", by=["g"]).collect()}
    assert got == _episodes_brute(rows, 300)
    assert len(got) > 3


def test_alert_on_samples_false_at_same_instant_ends_run(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(t0, 0.3), (t0 + dt.timedelta(minutes=6), 0.5), (t0 + dt.timedelta(minutes=6), 0.1),
            (t0 + dt.timedelta(minutes=9), 0.4)]
    df = spark.createDataFrame(rows, "ts timestamp, v double")
    ep = sorted((r["active_since"], r["resolved_at"])
                for r in W.alert_on_samples(df, "ts", F.col("v") > 0.2, "2 minutes").collect())
    assert ep == [(t0, t0 + dt.timedelta(minutes=6)), (t0 + dt.timedelta(minutes=9), None)]


def test_alert_for_matches_brute_force(spark):
    import random
    rnd = random.Random(11)
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for g in ("x", "y"):
        for i in range(400):
            if rnd.random() < 0.9:        # missing steps break runs
                rows.append((g, t0 + dt.timedelta(minutes=i), rnd.choice([0.5, 1.5, 1.5, 1.5])))
    df = spark.createDataFrame(rows, "g string, window_end timestamp, q double")
    got = {(r["g"], r["window_end"], r["active_since"], r["active_seconds"])
           for r in W.alert_for(df, F.col("q") > 1.0, "2 minutes", by=["g"]).collect()}
    want = set()
    for g in ("x", "y"):
        hot = sorted(t for gg, t, q in rows if gg == g and q > 1.0)
        start = None
        for i, t in enumerate(hot):
            if i == 0 or t - hot[i - 1] != dt.timedelta(minutes=1):
                start = t
            secs = int((t - start).total_seconds())
            if secs >= 120:
                want.add((g, t, start, secs))
    assert got == want and len(want) > 10


def test_alerts_keep_null_groups(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(None, t0 + dt.timedelta(minutes=i), 1.5) for i in range(4)]
    df = spark.createDataFrame(rows, "g string, window_end timestamp, q double")
    fired = W.alert_for(df, F.col("q") > 1.0, "2 minutes", by=["g"]).collect()
    assert sorted(r["active_seconds"] for r in fired) == [120, 180]
    assert all(r["g"] is None and r["active_since"] == t0 for r in fired)
    s = spark.createDataFrame([(None, t0, 0.5), (None, t0 + dt.timedelta(minutes=6), 0.1)],
                              "g string, ts timestamp, v double")
    ep = W.alert_on_samples(s, "ts", F.col("v") > 0.2, "5 minutes", by=["g"]).collect()
    assert [(r["active_since"], r["resolved_at"]) for r in ep] == [(t0, t0 + dt.timedelta(minutes=6))]


def test_sliding_sums_equal_spark_window(spark):
    import random
    rnd = random.Random(2)
    t0 = dt.datetime(2024, 1, 1)
    rows = [(rnd.choice("ab"), t0 + dt.timedelta(seconds=rnd.randint(-900, 3600)), rnd.randint(0, 1))
            for _ in range(800)] + [("a", None, 1)]
    df = spark.createDataFrame(rows, "g string, ts timestamp, f int")
    for width, slide in (("5 minutes", "1 minute"), ("2 minutes", "2 minutes"), ("5 minutes", "2 minutes")):
        got = W.sliding_sums(df, "ts", {"n": F.lit(1).cast("long"), "f": F.col("f").cast("long")},
                             width, slide, by=["g"])
        want = (df.groupBy(F.window("ts", width, slide).alias("w"), "g")
                  .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("f").cast("long")).alias("f"))
                  .filter(F.col("w").isNotNull())
                  .select("g", "n", "f", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end")))
        a = sorted(tuple(r) for r in got.select("g", "n", "f", "window_start", "window_end").collect())
        b = sorted(tuple(r) for r in want.collect())
        assert a == b and len(a) > 20, (width, slide)


def test_alerts_ignore_rows_without_time(spark):
    t0 = dt.datetime(2024, 1, 1)
    s = spark.createDataFrame([(None, 0.1), (t0, 0.5), (None, 0.5), (t0 + dt.timedelta(minutes=6), 0.1)],
                              "ts timestamp, v double")
    ep = W.alert_on_samples(s, "ts", F.col("v") > 0.2, "5 minutes").collect()
    assert [(r["active_since"], r["resolved_at"]) for r in ep] == [(t0, t0 + dt.timedelta(minutes=6))]
    w = spark.createDataFrame([(None, 1.5)] + [(t0 + dt.timedelta(minutes=i), 1.5) for i in range(3)],
                              "window_end timestamp, q double")
    assert sorted(r["active_seconds"] for r in W.alert_for(w, F.col("q") > 1.0, "2 minutes").collect()) == [120]
