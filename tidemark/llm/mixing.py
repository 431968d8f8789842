"""Mixing sources to target weights by Sainte-Laguë apportionment; DataFrame functions only.

1. Every source gets a target: its weight's share of all words, at most ``most_copies`` times its own size; what
   is above goes to the others by weight. The fixed point is found in closed form: sources are ordered by
   size over weight, and the first that stays below its limit fixes the level of it and all after it.
2. The corpus is worth equal blocks of words. Sources get whole blocks by the highest quotients
   ``target / (2 * blocks + 1)``. Only quotients near the last winning one are written out: the winning
   divisor differs from the mean by at most half a block per party, which bounds how far a party's number
   can lie from its quota.
3. A source is dealt into shards of bounded size by a seeded hash, and its blocks go to its shards the same
   way, so a source with a third of all rows is many shards and never one task.
4. In a shard the documents stand in seeded order and give their words in turn until the shard's blocks are
   used, after as many whole copies as fit.

Defined results: a null text has size 0, a null source is a source (the last). Repeated rows are documents of
their own; equal ``doc_id`` are ordered by size. Without words every target and ``taken`` is 0; an empty table
gives no rows. The words of very long texts are counted whole. Other columns are carried along unread, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, word_count

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
BLOCK_WORDS = 16
# A block is smaller if the corpus would have fewer than this many for each source.
LEAST_BLOCKS = 1000
# Words of a shard, where each document counts for some words besides its own, so that rows are bounded too.
SHARD_WORDS = 1_000_000
ROW_WORDS = 100
SEED = "17"


def _seeded(doc_id: Column, salt: str) -> Column:
    return F.md5(F.concat_ws(":", F.lit(SEED), F.lit(salt), F.coalesce(doc_id.cast("string"), F.lit("null"))))


def _exact(x: Column) -> Column:
    return x.cast("decimal(38,0)")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """source, source_size, n_docs, target: one row per source of a table with ``source`` and ``size``."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    sources = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
        .withColumn("place", F.row_number().over(order))
        .withColumn("weight", F.get(F.array(*[F.lit(w) for w in weights]), (F.col("place") - 1) % len(weights)))
        .withColumn("limit", F.col("source_size") * most)
    )
    by_level = Window.orderBy(F.col("limit") / F.col("weight"), "place")
    before = F.coalesce(F.sum("limit").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    levels = (
        sources.withColumn("left", F.sum("source_size").over(Window.partitionBy()) - before)
        .withColumn("weight_left", F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level_place", F.row_number().over(by_level))
        .withColumn(
            "free", _exact(F.col("left")) * _exact(F.col("weight")) <= _exact(F.col("limit")) * _exact(F.col("weight_left"))
        )
        .withColumn(
            "first_free",
            F.min(F.when(F.col("free"), F.struct("level_place", "left", "weight_left"))).over(Window.partitionBy()),
        )
    )
    level = F.col("first_free")
    shared = level["left"].cast("double") * F.col("weight") / level["weight_left"]
    target = F.when(F.col("level_place") < level["level_place"], F.col("limit").cast("double")).otherwise(shared)
    return levels.select("source", "source_size", "n_docs", target.alias("target"))


def apportion(parties: DataFrame, group: list[str], party: list[str], votes: str, seats: str) -> DataFrame:
    """``parties`` with a column ``won``: whole seats by the highest quotients votes / (2 * s + 1).

    ``seats`` is the number to give in each group, the same in all its rows. Ties go by the order of ``party``.
    """
    whole = Window.partitionBy(*group)
    share = F.coalesce(F.try_divide(F.col(votes), F.sum(votes).over(whole)), F.lit(0.0))
    quota = F.floor(share * F.col(seats))
    width = F.ceil(share * F.count("*").over(whole) / 2) + 2
    near = (
        parties.withColumn("quota", quota)
        .withColumn("width", width)
        .withColumn("sure", F.greatest(F.col("quota") - F.col("width"), F.lit(0).cast("long")))
        .withColumn("open", F.col(seats) - F.sum("sure").over(whole))
        .withColumn("s", F.explode(F.sequence("sure", F.col("quota") + F.col("width"))))
    )
    quotient = F.col(votes) / (2 * F.col("s") + 1)
    ranked = near.withColumn("rank", F.row_number().over(whole.orderBy(quotient.desc(), *[F.col(c).asc_nulls_last() for c in party], "s")))
    keys = [c for c in parties.columns]
    return ranked.groupBy(*keys).agg(
        (F.first("sure") + F.sum(F.when(F.col("rank") <= F.col("open"), 1).otherwise(0))).alias("won")
    )


def mix(docs: DataFrame, columns: list[str] | None = None, weights: tuple[int, ...] = WEIGHTS,
        most: int = MOST_COPIES, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``columns`` (doc_id by default) with size, source_size, target, taken, shard and shard_blocks."""
    spark = docs.sparkSession
    columns = ["doc_id"] if columns is None else columns
    with Scratch(spark, "mix") as scratch:
        sizes = scratch.write(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "sizes")
        shards = F.ceil((F.col("source_size") + F.col("n_docs") * ROW_WORDS) / shard_words)
        everything = Window.partitionBy()
        block = F.least(
            F.lit(block_words),
            F.greatest(F.lit(1), F.floor(F.sum("source_size").over(everything) / (F.count("*").over(everything) * LEAST_BLOCKS))),
        ).cast("long")
        sources = (
            targets(sizes, weights, most)
            .withColumn("shards", F.greatest(shards, F.lit(1)))
            .withColumn("block", block)
            .withColumn("blocks", F.floor(F.sum("source_size").over(everything) / F.col("block")))
        )
        sources = scratch.write(
            apportion(sources, [], ["source"], "target", "blocks").withColumnRenamed("won", "source_blocks"), "sources"
        )
        cells = (
            _in_shards(sizes, sources)
            .groupBy("source", "shard", "source_blocks", "block")
            .agg(F.sum("size").alias("cell_size"))
        )
        cells = apportion(cells, ["source"], ["shard"], "cell_size", "source_blocks")
        words = F.least(F.col("won") * F.col("block"), F.col("cell_size") * most)
        cells = scratch.write(
            cells.select(
                F.col("source").alias("cell_source"), F.col("shard").alias("cell_shard"), "cell_size",
                words.alias("cell_words"), F.col("won").alias("cell_blocks"),
            ),
            "cells", keep=True,
        )
        sources = scratch.write(sources, "targets", keep=True)

    mine = F.struct(*[F.col(c) for c in columns]).alias("row")
    rows = docs.select(mine, "doc_id", "source", word_count(F.col("text")).alias("size"))
    rows = _in_shards(rows, sources)
    rows = rows.join(cells, F.col("source").eqNullSafe(F.col("cell_source")) & (F.col("shard") == F.col("cell_shard")))
    in_turn = Window.partitionBy("source", "shard").orderBy(_seeded(F.col("doc_id"), "order"), "doc_id", "size")
    before = F.sum("size").over(in_turn.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")
    copies = F.coalesce(F.floor(F.try_divide(F.col("cell_words"), F.col("cell_size"))), F.lit(0))
    rest = F.col("cell_words") - copies * F.col("cell_size")
    taken = copies * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest - before))
    return rows.select(
        *[F.col("row")[c].alias(c) for c in columns], "size", "source_size", "target", taken.cast("long").alias("taken"),
        F.col("shard").cast("long").alias("shard"), F.col("cell_blocks").cast("long").alias("shard_blocks"),
    )


def _in_shards(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows with the values of their source, and their shard. One row per source is broadcast if it is small."""
    right = sources.select(
        F.col("source").alias("its_source"), "source_size", "target", "shards", "source_blocks", "block"
    )
    digits = F.conv(F.substring(_seeded(F.col("doc_id"), "shard"), 1, 8), 16, 10).cast("long")
    return (
        rows.join(right, F.col("source").eqNullSafe(F.col("its_source")))
        .drop("its_source")
        .withColumn("shard", digits % F.col("shards"))
    )


def blend(docs: DataFrame, **settings) -> DataFrame:
    """The mixed corpus with the columns of ``docs``: whole copies of a text, then its first words for the rest."""
    names = docs.columns
    # The row travels as one struct, so none of its columns can clash with the plan's.
    rows = docs.select("doc_id", "source", "text", F.struct(*[F.col(c) for c in names]).alias("m_row"))
    mixed = mix(rows, columns=["m_row"], **settings).select(
        F.col("m_row").alias("row"), F.col("size").alias("m_size"), F.col("taken").alias("m_taken")
    )
    # A copy is whole or the first words of the text, with all that stands between them.
    part = F.when(F.col("m_size") > 0, F.col("m_taken") % F.col("m_size")).otherwise(0)
    whole = F.when(F.col("m_size") > 0, F.floor(F.col("m_taken") / F.col("m_size"))).otherwise(0)
    lengths = F.concat(
        F.array_repeat(F.lit(-1).cast("long"), whole.cast("int")),
        F.when(part > 0, F.array(part.cast("long"))).otherwise(F.array().cast("array<long>")),
    )
    starts = "(?<=[\\x20\\x09-\\x0D])(?=[^\\x20\\x09-\\x0D])"

    def first_words(text: Column, n: Column) -> Column:
        pieces = F.split(text, starts)
        lead = F.when(text.rlike("^[\\x20\\x09-\\x0D]"), 1).otherwise(0)
        return F.rtrim(F.array_join(F.slice(pieces, F.lit(1), (n + lead).cast("int")), ""))

    dealt = mixed.select("row", F.explode(lengths).alias("m_words"))
    text = F.when(F.col("m_words") < 0, F.col("row")["text"]).otherwise(first_words(F.col("row")["text"], F.col("m_words")))
    return dealt.select(*[(text if c == "text" else F.col("row")[c]).alias(c) for c in names])
