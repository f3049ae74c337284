"""The operators of this folder applied to whole tables with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from shopspan.llm.decontaminate import contaminated
from shopspan.llm import chat, divergence, gam, hostquality, importance, language, neardup, styletree, substring, urlfilter
from shopspan.llm.neardup import near_duplicates
from shopspan.llm.packing import pack
from shopspan.llm.substring import repeated_passages
from shopspan.llm.tiers import pack_tiers

REGISTRY: dict = {}
ORACLE: dict[str, str] = {}


def query(fn):
    REGISTRY[fn.__name__] = fn
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_minmax_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"), words=3, percent=85)


ORACLE["op1_minmax_near_duplicates"] = neardup.ORACLE_SQL


@query
def op9_repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    found = repeated_passages(table(spark, folder, "documents"), length=35)
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


ORACLE["op9_repeated_passages"] = substring.ORACLE_SQL


@query
def op10_benchmark_passages(spark: SparkSession, folder: str) -> DataFrame:
    found = contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "item_id", "start", "length", "edits")


@query
def op2_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    packed = pack(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), with_ids=False)
    return packed


@query
def op5_host_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return hostquality.judge(table(spark, folder, "documents")).drop("shrunk_rate")


ORACLE["op5_host_quality_rules"] = hostquality.ORACLE_SQL


@query
def op6_chat_windows(spark: SparkSession, folder: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    probe = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    )
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionAll(probe)
    return chat.read_back(chat.windows(turns))


ORACLE["op6_chat_windows"] = chat.ORACLE_SQL


@query
def op3_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    return urlfilter.judge_urls(table(spark, folder, "pages"))


ORACLE["op3_url_rules"] = urlfilter.ORACLE_SQL


@query
def op4_language_centroids(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(table(spark, folder, "documents"))


@query
def op7_additive_quality(spark: SparkSession, folder: str) -> DataFrame:
    return gam.score_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op8_style_tree_text(spark: SparkSession, folder: str) -> DataFrame:
    return styletree.extract_pages(table(spark, folder, "pages"))


@query
def op13_tiered_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_tiers(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), with_ids=False)


@query
def op11_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return importance.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


ORACLE["op11_importance_resampling"] = importance.ORACLE_SQL


@query
def op12_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.divergence(table(spark, folder, "documents"))


ORACLE["op12_source_divergence"] = divergence.ORACLE_SQL
