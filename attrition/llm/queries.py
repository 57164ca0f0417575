"""The registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attrition.llm import (
    bestfit, bm25_wand, bottomk, bpa, chat, fst_tokens, html_tree, line_runs, mih, mixture_lang, quality_bt, rans, resample,
)
from attrition.llm.common import table
from attrition.session import scratch_path


def op1_quality_bt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_bt.op1_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_html_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_tree.extract_pages(table(spark, sf_dir, "pages"))


def op3_bottomk_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bottomk.near_duplicates(table(spark, sf_dir, "documents"))


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.op4_digest(table(spark, sf_dir, "conversations"))


def op5_fst_token_counts(spark: SparkSession, sf_dir: str, tokenizer: str = "byte_bpe_50k.json") -> DataFrame:
    return fst_tokens.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(tokenizer))


def op6_bestfit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bestfit.pack_documents(table(spark, sf_dir, "documents"))


def op7_rans(spark: SparkSession, sf_dir: str, tokenizer: str = "word_bpe_49k.json") -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    files = rans.encode_corpus(docs, public_tokenizers.path(tokenizer), scratch_path(spark, "rans"))
    return rans.decode_corpus(spark, files)


def op8_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mih.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_runs.op9_digest(table(spark, sf_dir, "documents"))


def op10_bm25_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bm25_wand.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_mixture_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture_lang.op11_digest(table(spark, sf_dir, "documents"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_best_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpa.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_bt": op1_quality_bt,
    "op2_html_tree": op2_html_tree,
    "op3_bottomk_neardup": op3_bottomk_neardup,
    "op4_chat_format": op4_chat_format,
    "op5_fst_token_counts": op5_fst_token_counts,
    "op6_bestfit_packing": op6_bestfit_packing,
    "op7_rans": op7_rans,
    "op8_multi_index_hashing": op8_multi_index_hashing,
    "op9_line_dedup": op9_line_dedup,
    "op10_bm25_decontamination": op10_bm25_decontamination,
    "op11_mixture_language": op11_mixture_language,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_best_position": op13_best_position,
}

ORACLES: dict[str, str] = {
    "op3_bottomk_neardup": bottomk.OP3_SQL,
    "op4_chat_format": chat.OP4_SQL,
    "op9_line_dedup": line_runs.OP9_SQL,
    "op12_importance_resampling": resample.OP12_SQL,
    "op13_best_position": bpa.OP13_SQL,
}
