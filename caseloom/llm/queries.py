"""One query per operator, with production parameters, and its DuckDB counterpart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.llm import (
    decontamination,
    exact_dedup,
    lexical_search,
    line_dedup,
    near_dedup,
    pattern_packing,
    sharding,
    simhash_dedup,
    substring_dedup,
    token_alignment,
    token_output,
    toxicity,
    url_filter,
)
from caseloom.llm.tokens import vocabulary

# The rules of the URL contract.
URL_RULES = (
    url_filter.Rule("block", "net/"),
    url_filter.Rule("allow", "example.net/en/"),
    url_filter.Rule("block", "example.com/de/"),
    url_filter.Rule("allow", "org/fr/"),
)
SHARDS = 16


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    done = substring_dedup.substring_dedup(docs)
    return done.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = _documents(spark, sf_dir).select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    return sharding.shard_by_key(docs, "doc_id", SHARDS).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    return line_dedup.line_dedup(docs).select("doc_id", "n_lines", "n_dropped", "kept_sha256")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    labelled = url_filter.rule_labels(pages, "url", URL_RULES)
    classifier = url_filter.UrlClassifier.train(labelled)
    return url_filter.judge(pages, "url", URL_RULES, classifier).select(
        "page_id", "host", "path", "rule", "verdict", "block_score"
    )


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_dedup.exact_groups(_documents(spark, sf_dir).select("doc_id", "text"))
    return groups.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def op6_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    return token_output.packed_sequences(docs, vocabulary())


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    return near_dedup.near_duplicates(docs).select("doc_id", "class_id", "kept")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return decontamination.overlaps(docs, benchmark)


#: Labels are learned from two thirds of the ids; the others are held out.
HELD_OUT = 1


def _fold(key: str):
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(3))


def toxicity_model(spark: SparkSession, sf_dir: str, docs: DataFrame) -> toxicity.ToxicityModel:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    labels = labels.where(_fold("doc_id") != HELD_OUT).select("doc_id", F.col("toxic").alias("label"))
    return toxicity.train(docs, labels)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    scored = toxicity.score(docs, toxicity_model(spark, sf_dir, docs))
    return scored.select(
        "doc_id",
        (_fold("doc_id") == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
        "distance",
    )


def op10_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    return pattern_packing.pack_documents(docs, vocabulary())


def op11_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(_documents(spark, sf_dir).select("doc_id", "text"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return lexical_search.ranked(docs, items)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    return token_alignment.aligned_tokens(docs, vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_sharding": op2_sharding,
    "op3_line_dedup": op3_line_dedup,
    "op4_url_filter": op4_url_filter,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_token_output": op6_token_output,
    "op7_near_dedup": op7_near_dedup,
    "op8_decontamination": op8_decontamination,
    "op9_toxicity": op9_toxicity,
    "op10_pattern_packing": op10_pattern_packing,
    "op11_simhash_dedup": op11_simhash_dedup,
    "op12_lexical_search": op12_lexical_search,
    "op13_token_alignment": op13_token_alignment,
}
