"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attrition.session import drop_path, ensure_checkpoint_dir, scratch_path

#: The ASCII white space that separates words and pads lines: U+0020 and U+0009 to U+000D.
ASCII_SPACE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


#: Rows of a batch that goes to a Python worker, where the session leaves Spark's default:
#: texts are long, and a batch is held in memory on both sides.
BATCH_ROWS = 1000


def prepare(spark: SparkSession) -> None:
    """Set the checkpoint folder, bound the batches of texts and let Python workers import this package."""
    ensure_checkpoint_dir(spark)
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    env = spark.sparkContext.environment
    if root not in paths and root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(p for p in (env.get("PYTHONPATH", ""), root) if p)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables, whole."""
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, *sort: str) -> DataFrame:
    """Write ``df`` as Parquet into a fresh shared folder and read it back.

    Cuts the lineage like ``checkpoint()`` (a lost executor loses nothing) but
    keeps columnar pruning and compression. Columns in ``sort`` order the rows
    of each file.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if sort:
        df = df.sortWithinPartitions(*sort)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stored(*frames: DataFrame | None) -> None:
    """Delete the folders of frames that :func:`stored` gave and that nothing reads any more."""
    for df in frames:
        if df is not None:
            for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
                drop_path(df.sparkSession, path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, UPPER, UPPER.lower())


def parts_for(spark: SparkSession, rows: int, per_part: int) -> int:
    """A number of parts that bounds the rows of each, at least the default parallelism."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // per_part))
