"""Lazily built inputs of the churn configuration (no action runs here)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import clean as P
from ..session import keep_compiled
from ..sources.views import load_view, read_table, view_of


def raw(spark: SparkSession, sf: str) -> DataFrame:
    return load_view(spark, sf, "customer_raw")


def cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return P.ingest_clean(raw(spark, sf))


def features(spark: SparkSession, sf: str) -> DataFrame:
    keep_compiled(spark)
    return P.build_features(cleaned(spark, sf))


def spread_features(spark: SparkSession, sf: str) -> DataFrame:
    """The rows of :func:`features`, built by as many tasks as there are cores: a table of narrow rows is few file splits."""
    keep_compiled(spark)
    table = read_table(spark, sf, "customer")
    cores = spark.sparkContext.defaultParallelism
    if table.rdd.getNumPartitions() < cores:
        table = table.repartition(cores, "c_custkey")
    return P.build_features(P.ingest_clean(view_of(table, "customer_raw")))


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    return load_view(spark, sf, "predictions")


def metrics(spark: SparkSession, sf: str) -> DataFrame:
    return load_view(spark, sf, "model_metrics")


def snapshots(spark: SparkSession, sf: str) -> DataFrame:
    return load_view(spark, sf, "feature_snapshots")


def label_times(spark: SparkSession, sf: str) -> DataFrame:
    return load_view(spark, sf, "label_times")


def drift_lines(spark: SparkSession, sf: str) -> DataFrame:
    return load_view(spark, sf, "drift_lines")


def scored_lines(spark: SparkSession, sf: str) -> DataFrame:
    return load_view(spark, sf, "scored_lines")


def requests(spark: SparkSession, sf: str) -> DataFrame:
    return load_view(spark, sf, "score_requests")
