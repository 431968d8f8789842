"""The corpus pipeline: quality classifier, line dedup, near dedup, mixing, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as Parquet and read again as
the ``docs`` of the next. All but the last return the columns of ``documents``:

1. ``quality``: documents whose perplexity is above their language's threshold go.
2. ``lines``: lines that an earlier document holds go; the other lines stay, joined as they were.
3. ``near_dup``: of each group of near duplicates (0.8 alike in shingles of five words) the smallest id stays.
4. ``mix``: texts are repeated or cut so that sources come near their target weights. Every copy is a row.
5. ``pack``: texts become sequences of at most 2048 tokens; one row per piece, with its place.

The stages keep what their operators define for nulls, empty and long texts, ties, repeated rows, empty tables and
further columns, see their modules; an empty table passes through all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import line_dedup, mixing, near_dup, packing, word_model
from tidemark.llm.common import read
from tidemark.llm.queries import tokenizer_path
from tidemark.session import scratch_path, scratch_scope

# Words of a shingle in the stage; the query op1_near_dup is asked for near_dup.SHINGLE.
STAGE_SHINGLE = 5


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return word_model.keep_good(docs, read(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.clean(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.keep_one(docs, size=STAGE_SHINGLE)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.blend(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [("quality", quality), ("lines", lines), ("near_dup", one_of_each), ("mix", mix), ("pack", pack)]

# Perplexities and tokens are not expressible in SQL: tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        # What a stage keeps for its result goes once that is written.
        with scratch_scope(spark):
            made = stage(spark, docs, sf_dir)
            made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
    return docs
