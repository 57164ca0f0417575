"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; ``run`` writes every stage's result as Parquet into the shared folder,
reads it again for the next one and drops it when that is written. All but the last return the columns of
``documents`` (doc_id, text, lang, source, n_chars). Other columns of the
input pass through; an empty input gives an empty result; a null text counts
as empty; rows with a null doc_id are scored, decontaminated and packed, and
take no part in the two dedup stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attrition.llm import bestfit, bm25_wand, bottomk, line_runs, quality_bt
from attrition.llm.common import table
from attrition.session import drop_path, release, scratch_path

#: The stages hold trained models and similarity search, which SQL cannot express.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the Bradley-Terry classifier scores at 0.5 or more."""
    model = quality_bt.train_quality(docs, table(spark, sf_dir, "labels"))
    return docs.filter(quality_bt.quality_score(docs["text"], model) >= 0.5)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that repeat across documents; n_chars follows the text."""
    out = line_runs.dedup_lines(docs)
    return out.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row (the smallest doc_id; of one doc_id's texts the smallest hash) of each near-duplicate component."""
    return bottomk.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return bm25_wand.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """bin_id, bin_start, doc_id, segment, doc_start, length of every packed segment; a cluster is a
    text here, as near_dedup has left one document of each group."""
    return bestfit.pack_distinct(docs)


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("pack", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            drop_path(spark, before)
        release(spark)
        docs, before = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
