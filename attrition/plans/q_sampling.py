"""Queries for sampling, splits and folds."""

from __future__ import annotations

from .. import schemas as S
from ..operators import sampling as R
from . import inputs as I
from .catalog import query
from .oracle_sql import with_views

_RANKED = """r AS (SELECT customerID, Churn,
  row_number() OVER (PARTITION BY Churn ORDER BY md5('42:' || customerID), customerID) AS rk,
  count(*) OVER (PARTITION BY Churn) AS nc FROM customer_features)"""


@query("reference_sample", "R1", with_views(
    f"SELECT * FROM customer_features ORDER BY md5('42:' || customerID), customerID LIMIT {S.REFERENCE_SAMPLE}",
    "customer_features"))
def q_sample(spark, sf):
    return R.hash_sample(I.features(spark, sf), "customerID", S.REFERENCE_SAMPLE)


@query("stratified_split", "R2", with_views(
    f", {_RANKED}\nSELECT customerID, Churn, CASE WHEN rk <= round(nc * 0.2) THEN 'test' "
    "WHEN rk <= round(nc * 0.2) + round((nc - round(nc * 0.2)) * 0.1) THEN 'val' ELSE 'train' END AS split FROM r",
    "customer_features").replace("\n, r AS", ", r AS", 1))
def q_split(spark, sf):
    df = I.features(spark, sf).select("customerID", "Churn")
    return R.stratified_split(df, "Churn", "customerID", S.TEST_SIZE, S.VAL_SIZE, S.SEED)


@query("kfold_assign", "R3", with_views(
    f", {_RANKED}\nSELECT customerID, Churn, CAST((rk - 1) % 5 AS INTEGER) AS fold FROM r",
    "customer_features").replace("\n, r AS", ", r AS", 1))
def q_folds(spark, sf):
    df = I.features(spark, sf).select("customerID", "Churn")
    return R.assign_folds(df, "Churn", "customerID", S.CV_FOLDS, S.SEED)
