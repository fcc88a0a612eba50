"""The registered queries of this package: one for each operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from latemark.llm import quality, toxicity
from latemark.llm.decontamination import contaminations
from latemark.llm.frames import table
from latemark.llm.hard_negatives import hard_negatives
from latemark.llm.labelled import held_out
from latemark.llm.licenses import license_scan
from latemark.llm.oracles import ORACLES
from latemark.llm.order_minhash import edit_fingerprints
from latemark.llm.packing import packed
from latemark.llm.sharding import shard_rows
from latemark.llm.simhash import near_duplicates
from latemark.llm.spellings import spelling_variants
from latemark.llm.substrings import without_repeats
from latemark.llm.token_counts import token_counts
from latemark.llm.url_filter import Rule, judged_urls

Query = Callable[[SparkSession, str], DataFrame]


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"), "spans",
    )


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.learn(docs, table(spark, sf_dir, "labels"))
    return quality.scored(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"), "best_passage",
    )


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shard_rows(table(spark, sf_dir, "documents"), shards=16)
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "row_number",
    )


#: The rules of the URL query, as (verdict, host, path).
URL_RULES = [
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
]


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op7_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_fingerprints(table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op10_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return without_repeats(docs, window=200).drop("text")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", label), F.col("vec_id") % 100 == 0)


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


def sharding_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can tell of the shards: sizes, and that rows are dealt evenly without gaps."""
    rows = op2_sharding(spark, sf_dir)
    shards = rows.groupBy("shard").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("slot").alias("slots"), F.min("slot").alias("least"), F.max("slot").alias("most")
    )
    told = shards.agg(
        F.count(F.lit(1)).alias("shards"), (F.max("n") - F.min("n")).alias("apart"),
        F.bool_and((F.col("n") == F.col("slots")) & (F.col("least") == 0) & (F.col("most") == F.col("n") - 1)).alias("gapless"),
    ).first()
    even = told["apart"] is not None and told["apart"] <= 1
    return rows.select(
        "doc_id", "size", F.lit(told["shards"]).cast("long").alias("shards"), F.lit(even).alias("even"), F.lit(told["gapless"]).alias("gapless")
    )


def url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts and rules of all URLs, and the verdicts that rules give."""
    verdict = F.when(F.col("rule").isNotNull(), F.col("verdict"))
    return op4_url_filter(spark, sf_dir).select("page_id", "host", "path", "rule", verdict.alias("ruled"))


def repeats_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes, removed bytes and removed runs of all documents."""
    return op10_suffix_array(spark, sf_dir).select("doc_id", "n_bytes", "n_removed", "n_spans")


_ALL = (
    op1_toxicity, op2_sharding, op3_quality, op4_url_filter, op5_packing, op6_token_counts, op7_order_minhash,
    op8_decontamination, op9_simhash, op10_suffix_array, op11_hard_negatives, op12_license_scan, op13_spelling_variants,
    sharding_sizes, url_rules, repeats_removed,
)
QUERIES: dict[str, Query] = {q.__name__: q for q in _ALL}

__all__ = ["ORACLES", "QUERIES"]
