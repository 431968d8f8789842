"""The registered queries of this subpackage, with the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import collocations, line_dedup, mixing, near_dup, packing, pii, quality_rules, ranked_search, substring_dedup, token_files, topk, url_filter, word_model
from tidemark.llm.common import read
from tidemark.session import scratch_path


def tokenizer_path(name: str) -> str:
    """A vocabulary file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.link(read(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(read(spark, sf_dir, "documents"))


def op3_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_model.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = substring_dedup.dedup(read(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_dedup.dedup(read(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read(spark, sf_dir, "pages"))


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(read(spark, sf_dir, "embeddings"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    token_files.write(read(spark, sf_dir, "documents"), path, tokenizer_path("byte_bpe_50k.json"))
    return token_files.read(spark, path)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pii.find(read(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans")


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(read(spark, sf_dir, "documents"))


QUERIES = {
    "op1_near_dup": op1_near_dup,
    "op2_quality_rules": op2_quality_rules,
    "op3_quality_model": op3_quality_model,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_mixing": op5_mixing,
    "op6_packing": op6_packing,
    "op7_url_filter": op7_url_filter,
    "op9_line_dedup": op9_line_dedup,
    "op8_topk": op8_topk,
    "op10_token_files": op10_token_files,
    "op11_pii": op11_pii,
    "op12_ranked_search": op12_ranked_search,
    "op13_collocations": op13_collocations,
}
