"""Lineage records and content fingerprints as DataFrames.

A stage emits START / COMPLETE events as rows of a ``lineage`` table (run
id, job, state, time, inputs, outputs, schema facet, row count). The schema
facet comes from ``df.schema`` (no job); the row count is what the stage's
write reports (read back from the written files).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LINEAGE_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("job", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("event_time", T.TimestampType()),
    T.StructField("inputs", T.ArrayType(T.StringType())),
    T.StructField("outputs", T.ArrayType(T.StringType())),
    T.StructField("schema_fields", T.ArrayType(T.StructType([
        T.StructField("name", T.StringType()), T.StructField("type", T.StringType())]))),
    T.StructField("row_count", T.LongType()),
])


def lineage_event(spark: SparkSession, df: DataFrame | None, job: str, run_id: str, state: str,
                  inputs: Sequence[str], outputs: Sequence[str], row_count: int | None = None,
                  event_time=None) -> DataFrame:
    """L1: one lineage event row. ``df`` supplies the schema facet."""
    fields = [(f.name, f.dataType.simpleString()) for f in df.schema.fields] if df is not None else []
    row = (run_id, job, state, event_time, list(inputs), list(outputs), fields, row_count)
    out = spark.createDataFrame([row], LINEAGE_SCHEMA)
    if event_time is None:
        out = out.withColumn("event_time", F.current_timestamp())
    return out


def schema_facet(df: DataFrame) -> DataFrame:
    """L1: the schema facet of a data set as rows (position, name, type)."""
    spark = df.sparkSession
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "position int, name string, type string")


def fingerprint(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """L2: order-free content hash of a data set: row count plus the sum of
    the first 8 hex digits of each row's ``md5``. A row's text gives every
    value with its length before it (``V3:abc``, null: ``N``), so different
    rows have different texts. The sum is a 38-digit decimal, given as text.
    Independent of partitioning and row order, and recomputable by any SQL
    engine with ``md5``."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(_digits(_row_text(cols or df.columns), 1, 8)).cast("string").alias("md5_sum"),
    )


def _row_text(cols: Sequence[str]) -> Column:
    def part(c: str) -> Column:
        v = F.col(c).cast("string")
        return F.coalesce(F.concat(F.lit("V"), F.length(v).cast("string"), F.lit(":"), v), F.lit("N"))

    return F.concat(*[part(c) for c in cols])


def _digits(text: Column, first: int, n: int) -> Column:
    """So many hex digits of the text's ``md5`` as a number."""
    return F.conv(F.substring(F.md5(text), first, n), 16, 10).cast("decimal(38,0)")


def fingerprint_states(df: DataFrame, by: str, cols: Sequence[str] | None = None) -> DataFrame:
    """L2: a mergeable state per partition ``by``: the row count and the sums
    of both halves of each row's 128-bit ``md5`` (row text as in
    :func:`fingerprint`). Sums of up to 5e18 rows fit. States are kept beside
    the table, and an append adds the states of its own rows
    (:func:`merge_states`): nothing written before is read again."""
    text = _row_text(cols or df.columns)
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("row_count"), F.sum(_digits(text, 1, 16)).alias("high_sum"),
                              F.sum(_digits(text, 17, 16)).alias("low_sum"))


def merge_states(states: DataFrame, by: str | None = None) -> DataFrame:
    """L2: states of the same partition added up, or all of them into the state of the whole table."""
    add = [F.sum(c).cast(states.schema[c].dataType).alias(c) for c in ("row_count", "high_sum", "low_sum")]
    return states.groupBy(by).agg(*add) if by else states.agg(*add)


def changed_partitions(before: DataFrame, after: DataFrame, by: str) -> DataFrame:
    """L2: the partitions whose rows differ between two sets of merged states,
    as ``added``, ``removed`` or ``changed``. Reads states only."""
    b, a = before.alias("b"), after.alias("a")
    same = F.lit(True)
    for c in ("row_count", "high_sum", "low_sum"):
        same = same & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    what = F.when(F.col("b.row_count").isNull(), "added").when(F.col("a.row_count").isNull(), "removed").otherwise("changed")
    return (a.join(b, F.col(f"a.{by}").eqNullSafe(F.col(f"b.{by}")), "full_outer").filter(~same)
             .select(F.coalesce(f"a.{by}", f"b.{by}").alias(by), what.alias("change")))
