"""Repeatable sampling, stratified splits and folds.

Randomness comes from ``md5(seed:id)``: the same rows are picked whatever
the partitioning, and DuckDB computes the same hash. Exact per-class ranks
come from the distributed row number over range parts, never from a window
over a whole class (a class can hold most of the data).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import columns as C


def hash_sample(df: DataFrame, id_col: str, n: int, seed: int = S.SEED) -> DataFrame:
    """``min(n, rows)`` rows without replacement, repeatable.

    ``orderBy(hash).limit(n)`` is a TakeOrderedAndProject: each task keeps
    its best ``n``; only ``n`` rows per task are merged.
    """
    key = C.md5_order_key(seed, id_col)
    return (df.withColumn("__h", key).orderBy(F.col("__h"), F.col(id_col)).limit(n).drop("__h"))


def class_ranks(df: DataFrame, label: str, id_col: str, seed: int = S.SEED) -> DataFrame:
    """Adds ``__rank`` (1-based, by hash within class) and ``__n_class``.

    The order is total: hash, id, then a hash of the whole row, so rows that
    repeat an id are ranked alike in every run (identical rows are
    interchangeable). One path for all sizes: the distributed row number of
    :mod:`prefix`, whose range parts split any class or run of equal ids.
    """
    from .prefix import join_on, ordered_row_number
    keyed = df.withColumns({"__h": C.md5_order_key(seed, id_col), "__all": F.xxhash64(*df.columns)})
    ranked = ordered_row_number(keyed, [F.col("__h"), F.col(id_col), F.col("__all")], by=[label], out="__rank")
    n_class = df.groupBy(label).agg(F.count(F.lit(1)).alias("__n_class"))   # one row per class
    return join_on(ranked, n_class, [label]).drop("__h", "__all")


def stratified_split(df: DataFrame, label: str, id_col: str, test_size: float = S.TEST_SIZE,
                     val_size: float = S.VAL_SIZE, seed: int = S.SEED, out: str = "split") -> DataFrame:
    """R2: per class, the ``round(n*test)`` lowest hashes are test, the next
    ``round((n-test)*val)`` are validation, the rest train (exact shares)."""
    r = class_ranks(df, label, id_col, seed)
    k_test = F.round(F.col("__n_class") * F.lit(test_size))
    k_val = F.round((F.col("__n_class") - k_test) * F.lit(val_size))
    split = (F.when(F.col("__rank") <= k_test, F.lit("test"))
              .when(F.col("__rank") <= k_test + k_val, F.lit("val"))
              .otherwise(F.lit("train")))
    return r.withColumn(out, split).drop("__rank", "__n_class")


def split_frames(df: DataFrame, col: str = "split") -> dict[str, DataFrame]:
    return {name: df.filter(F.col(col) == name).drop(col) for name in ("train", "val", "test")}


def assign_folds(df: DataFrame, label: str, id_col: str, k: int = S.CV_FOLDS, seed: int = S.SEED,
                 out: str = "fold") -> DataFrame:
    """Stratified folds: rank within class modulo ``k`` (sizes differ by <= 1)."""
    r = class_ranks(df, label, id_col, seed)
    return r.withColumn(out, ((F.col("__rank") - 1) % k).cast("int")).drop("__rank", "__n_class")
