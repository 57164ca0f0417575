"""Queries for the feature-store operators."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import store as J
from ..session import scratch_path
from . import inputs as I
from .catalog import REGISTRY, query
from .oracle_sql import with_views

AS_OF = "1998-06-30"
WINDOW_START = "1997-06-30"
_SNAP_FEATURES = ["snapshot_id", "event_timestamp", "created_timestamp", "total_price", "priority", "status"]


def _latest(spark, sf):
    return J.latest_per_entity(I.snapshots(spark, sf), "customerID", "event_timestamp", "created_timestamp",
                               start=WINDOW_START, end=AS_OF, tie=["snapshot_id"])


_LATEST_SQL = f"""latest AS (SELECT * FROM feature_snapshots
  WHERE event_timestamp > TIMESTAMP '{WINDOW_START}' AND event_timestamp <= TIMESTAMP '{AS_OF}'
  QUALIFY row_number() OVER (PARTITION BY customerID
          ORDER BY event_timestamp DESC, created_timestamp DESC, snapshot_id DESC) = 1)"""


def _with_latest(body: str, *more: str) -> str:
    return with_views(f", {_LATEST_SQL}\n{body}", "feature_snapshots", *more)


@query("latest_per_entity", "J1", _with_latest("SELECT * FROM latest"))
def q_latest(spark, sf):
    return _latest(spark, sf)


@query("latest_incremental", "J1", _with_latest("SELECT * FROM latest"))
def q_latest_incremental(spark, sf):
    """Three runs over rows that arrive up to 700 days after their event."""
    path = scratch_path(spark, "latest-store")
    src = I.snapshots(spark, sf).withColumn("arrived", F.date_add(F.col("event_timestamp").cast("date"),
                                                                  F.pmod("snapshot_id", F.lit(700)).cast("int")))
    for upto in ("1997-12-31", "1998-06-30", None):
        J.materialize_increment(src, path, "customerID", "event_timestamp", "arrived", "created_timestamp", upto=upto,
                                start=WINDOW_START, end=AS_OF, tie=["snapshot_id"])
    return J.read_materialized(spark, path)


@query("feature_lookup", "J2", _with_latest(
    "SELECT k.customerID, k.label_timestamp, l.total_price, l.priority, l.status "
    "FROM label_times k LEFT JOIN latest l ON k.customerID = l.customerID", "label_times"))
def q_lookup(spark, sf):
    keys = I.label_times(spark, sf)
    return J.feature_lookup(keys, _latest(spark, sf), "customerID",
                            ["orders_view:total_price", "orders_view:priority", "orders_view:status"])


#: Buckets of the queries' tables; a production table has one per few hundred MB.
BUCKETS = 16


def _bucketed(spark, df, name, buckets=BUCKETS):
    table = f"{name}_{uuid.uuid4().hex[:10]}"
    return J.write_bucketed(df, table, scratch_path(spark, name), "customerID", buckets)


@query("feature_lookup_bucketed", "J2", REGISTRY["feature_lookup"].oracle)
def q_lookup_bucketed(spark, sf):
    keys, store = I.label_times(spark, sf), _bucketed(spark, _latest(spark, sf), "latest_store")
    return J.feature_lookup(keys, J.asked_rows(store, keys, "customerID", BUCKETS), "customerID",
                            ["orders_view:total_price", "orders_view:priority", "orders_view:status"])


@query("point_in_time_join", "J3", with_views(f"""
, cand AS (
  SELECT l.customerID, l.label_timestamp, f.event_timestamp AS feature_timestamp, f.snapshot_id,
         f.total_price, f.priority, f.status
  FROM label_times l JOIN feature_snapshots f
    ON f.customerID = l.customerID AND f.event_timestamp <= l.label_timestamp
   AND f.event_timestamp >= l.label_timestamp - INTERVAL {S.FEATURE_TTL_DAYS} DAY
  QUALIFY row_number() OVER (PARTITION BY l.customerID, l.label_timestamp
          ORDER BY f.event_timestamp DESC, f.created_timestamp DESC, f.snapshot_id DESC) = 1)
SELECT l.customerID, l.label_timestamp, c.feature_timestamp, c.snapshot_id, c.total_price, c.priority, c.status
FROM label_times l LEFT JOIN cand c ON l.customerID = c.customerID AND l.label_timestamp = c.label_timestamp
""", "label_times", "feature_snapshots"))
def q_pit(spark, sf):
    return J.point_in_time_join(I.label_times(spark, sf), I.snapshots(spark, sf), "customerID",
                                "label_timestamp", "event_timestamp", "created_timestamp",
                                ttl_days=S.FEATURE_TTL_DAYS, tie=["snapshot_id"],
                                features=["snapshot_id", "total_price", "priority", "status"])


_SERVICE_COLS = [f for feats in S.FEATURE_VIEWS.values() for f in feats]


@query("feature_service_assemble", "J4", with_views(
    "SELECT customerID, " + ", ".join(_SERVICE_COLS) + " FROM customer_features", "customer_features"))
def q_assemble(spark, sf):
    src = I.features(spark, sf)
    return J.assemble_service({name: (src, feats) for name, feats in S.FEATURE_VIEWS.items()})


@query("feature_service_bucketed", "J4", REGISTRY["feature_service_assemble"].oracle)
def q_assemble_bucketed(spark, sf):
    """Each view is a table of its own beside the table of the entities."""
    src = I.features(spark, sf)
    views = {name: (_bucketed(spark, src.select("customerID", *feats), name), feats) for name, feats in S.FEATURE_VIEWS.items()}
    return J.assemble_bucketed(_bucketed(spark, src.select("customerID"), "entities"), views)


_ALL_NULL = " AND ".join(f"r.{f} IS NULL" for f in S.MODEL_FEATURES)


@query("fill_from_store", "J5", with_views(
    "SELECT r.request_id, r.customerID, r.request_timestamp, "
    + ", ".join(f"CASE WHEN {_ALL_NULL} THEN s.{f} ELSE r.{f} END AS {f}" for f in S.MODEL_FEATURES)
    + " FROM score_requests r LEFT JOIN customer_features s ON r.customerID = s.customerID",
    "score_requests", "customer_features"))
def q_fill_store(spark, sf):
    return J.fill_from_store(I.requests(spark, sf), I.features(spark, sf), "customerID", S.MODEL_FEATURES)


@query("fill_from_store_bucketed", "J5", REGISTRY["fill_from_store"].oracle)
def q_fill_bucketed(spark, sf):
    requests = I.requests(spark, sf)
    store = _bucketed(spark, I.features(spark, sf), "feature_store")
    return J.fill_from_store(requests, J.asked_rows(store, requests, "customerID", BUCKETS), "customerID", S.MODEL_FEATURES)


@query("latest_batch", "J6", with_views(
    "SELECT * FROM (SELECT *, date_trunc('day', request_timestamp) AS ingested_at FROM predictions) "
    "WHERE ingested_at = (SELECT max(date_trunc('day', request_timestamp)) FROM predictions)", "predictions"))
def q_latest_batch(spark, sf):
    df = I.predictions(spark, sf).withColumn("ingested_at", F.date_trunc("day", "request_timestamp"))
    return J.latest_batch(df, "ingested_at")


@query("latest_batch_by_run", "J6", with_views(
    "SELECT * FROM predictions WHERE pipeline_run_id = (SELECT arg_max(pipeline_run_id, "
    "(request_timestamp, pipeline_run_id)) FROM predictions)", "predictions"))
def q_latest_run(spark, sf):
    return J.latest_batch(I.predictions(spark, sf), "request_timestamp", by_run="pipeline_run_id")
