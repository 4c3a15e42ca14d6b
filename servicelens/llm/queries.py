"""Registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from servicelens.llm.chat import rotate
from servicelens.llm.collocations import collocations
from servicelens.llm.common import table
from servicelens.llm.decontaminate import benchmark_leaks
from servicelens.llm.divergence import source_divergence
from servicelens.llm.language_id import identify_language
from servicelens.llm.mixing import MixParams, mixed
from servicelens.llm.mtree import top_k
from servicelens.llm.oracles import CHAT_SQL, COLLOCATION_SQL, DIVERGENCE_SQL, TOP_K_SQL, mixing_sql, sharding_sql
from servicelens.llm.quality import score_quality
from servicelens.llm.sharding import ShardParams, with_shard
from servicelens.llm.simhash_dedup import simhash_dedup
from servicelens.llm.substring_dedup import duplicate_spans
from servicelens.llm.token_files import token_codes
from servicelens.llm.toxicity import score_toxicity


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_spans(table(spark, sf_dir, "documents"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents"), MixParams(), keep=["doc_id", "source"]).select(
        "doc_id", "source", F.col("__epoch").alias("epoch"), F.col("__order").alias("position")
    )


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.transform("spans", lambda s: F.concat_ws("-", s["start"].cast("string"), s["stop"].cast("string")))
    return rotate(table(spark, sf_dir, "conversations")).select(
        "conv_id", "perspective", "part", F.col("n_turns").cast("long").alias("n_turns"), F.length("text").cast("long").alias("n_chars"),
        F.md5("text").alias("text_md5"), F.array_join(spans, ",").alias("spans"),
    )


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_shard(table(spark, sf_dir, "documents"), ShardParams()).select("doc_id", "shard")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_language(table(spark, sf_dir, "documents"))


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup(table(spark, sf_dir, "documents"), words=4, distance=4)


def op8_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), k=20, query_mod=20)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents")).drop("n")


def op12_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_codes(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_source_mixing": op3_source_mixing,
    "op4_chat_formatting": op4_chat_formatting,
    "op5_sharding": op5_sharding,
    "op6_language_id": op6_language_id,
    "op7_simhash_dedup": op7_simhash_dedup,
    "op8_topk_search": op8_topk_search,
    "op9_toxicity": op9_toxicity,
    "op10_decontamination": op10_decontamination,
    "op11_source_divergence": op11_source_divergence,
    "op12_token_codes": op12_token_codes,
    "op13_collocations": op13_collocations,
}

SQL: dict[str, str] = {
    "op3_source_mixing": mixing_sql(MixParams()),
    "op4_chat_formatting": CHAT_SQL,
    "op5_sharding": sharding_sql(ShardParams()),
    "op8_topk_search": TOP_K_SQL,
    "op11_source_divergence": DIVERGENCE_SQL,
    "op13_collocations": COLLOCATION_SQL,
}
