"""Skew: a group holding a third (or more) of the rows must spread over
parts. The pinned (checkpointed) range parts of each operator are captured
and their sizes checked against an even share."""

import datetime as dt
import random

from pyspark.sql import functions as F

from attrition.operators import prefix as P
from attrition.operators import store as J
from attrition import session


def _capture(monkeypatch, module):
    seen = []
    real = session.cut_lineage

    def spy(df, eager=True):
        out = real(df, eager)
        seen.append(out)
        return out
    monkeypatch.setattr(module, "cut_lineage", spy)
    return seen


def _max_share(df, part_col):
    sizes = [r["count"] for r in df.groupBy(part_col).count().collect()]
    return max(sizes) / sum(sizes)


def test_row_number_spreads_identical_hot_group(spark, monkeypatch):
    seen = _capture(monkeypatch, P)
    rows = [("hot", 1)] * 3000 + [(f"g{i % 50}", i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, v int")
    P.ordered_row_number(df, [F.col("v").asc()], by=["g"], out="rn", parts=8).count()
    assert _max_share(seen[-1], "__part") < 0.25      # an even share is 1/8; the hot group alone is 1/2


def test_prefix_sum_spreads_hot_group(spark, monkeypatch):
    seen = _capture(monkeypatch, P)
    rnd = random.Random(1)
    # the hot group's values crowd near zero (one equal-width bucket would hold most of them)
    rows = [("hot", rnd.expovariate(50.0)) for _ in range(4000)] + [("cold", rnd.random()) for _ in range(2000)]
    df = P.collapse(spark.createDataFrame(rows, "g string, v double"), "v", {"n": F.lit(1)}, by=["g"])
    P.ordered_cumsum(df, "v", ["n"], by=["g"], parts=8).count()
    assert _max_share(seen[-1], "__bucket") < 0.25


def test_point_in_time_join_spreads_hot_key(spark, monkeypatch):
    seen = _capture(monkeypatch, session)
    base = dt.datetime(2020, 1, 1)
    rnd = random.Random(2)
    # the hot key has half of all rows, all inside one day
    feats = [("hot", base + dt.timedelta(seconds=rnd.randint(0, 86399)), i, 1.0) for i in range(3000)] + \
            [(f"k{i % 300}", base + dt.timedelta(days=rnd.randint(0, 60)), i, 2.0) for i in range(3000)]
    labels = [(i, "hot", base + dt.timedelta(seconds=rnd.randint(0, 86399))) for i in range(1000)] + \
             [(1000 + i, f"k{i % 300}", base + dt.timedelta(days=rnd.randint(0, 60))) for i in range(1000)]
    fdf = spark.createDataFrame(feats, "key string, ts timestamp, tie long, v double")
    ldf = spark.createDataFrame(labels, "lid long, key string, lts timestamp")
    J.point_in_time_join(ldf, fdf, "key", "lts", "ts", None, ttl_days=10, tie=["tie"], features=["v"],
                         partitions=8).count()
    assert _max_share(seen[-1], "__p") < 0.25
