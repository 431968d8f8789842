"""Ranked search of documents for items (NRA): impact-sorted reads with score intervals.

A term's weight is floor(1000 ln((2N+2) / (2 df + 1))), a posting's impact what it adds to a score, in whole numbers.

1. Documents are tokenized once; of their terms those that items hold stay, with the document's length. Statistics
   (N, L, df) are sums over all documents.
2. A posting has a level, the step of its impact on a scale of ``STEPS`` a doubling, so that every term's list is read
   from its greatest impacts down, and a small table (term, level, postings, greatest impact) tells what lies where.
3. Lists are read from the top. What a term's unread part can add at most is its frontier. A document seen lies between
   the sum of its impacts read and that sum plus the frontiers of the terms not read for it; one not seen is
   at most the sum of all frontiers. A first round reads some ``PROBE`` postings of every list. The k documents that lead
   then are read to the end; the least of their scores is a bar that an item's result has to reach.
4. A second round reads on, for items that are open, just as far as leaves the sum of frontiers under ``LEFT`` of that
   bar, the longest lists the least. No unseen document can reach the result any more. Candidates are the documents whose
   upper end reaches the bar, ties included; only their postings are read further, to the end of the lists, which gives
   their exact scores, and the k best with ties by id.
   Items whose lists end before k documents are seen are settled by having read all.

Sums are combined per task before the shuffle, and documents that can't reach the bar are dropped before anything is
written; per-item and per-document groups are hash aggregates and rank limits that Spark applies before the shuffle, so
a hot term or item is never gathered. Joins are left to Spark, which knows the sizes of the written item tables; only
two totals reach the driver.

Defined results: texts without a term are no documents of the statistics. A null text has none. Every row is a
document of its own, also with a repeated or null ``doc_id`` (null ids after all others in ties; equal rows take ranks of
their own). Item rows with one ``item_id`` are one item with the terms of all; those with a null id are one item, too.
Items without a found term give no rows; nor do empty tables. Texts are read whole. Other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, slices

TOP = 50
STEPS = 8
PROBE = 500
# What is left of all lists after the second round adds up to less than this share of the bar: the less, the more is read
# in that round and the fewer documents can still reach the bar.
LEFT = 0.5
# The depth of a list of which nothing is read.
_NONE = 2**30

# Letters and digits of ASCII and everything beyond ASCII.
_TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
_FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text: str | None) -> list[str]:
    return _TERM.findall((text or "").translate(_FOLD))


_READ = "row long, doc_id long, n long, terms array<string>, tfs array<long>"
_READ_ARROW = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.string())), ("tfs", pa.list_(pa.int64()))])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, text): each with its number of terms and how often it holds which."""
    from pyspark import TaskContext

    row = TaskContext.get().partitionId() << 40
    for batch in slices(batches):
        rows, lengths, held, times = [], [], [], []
        for text in batch.column(1).to_pylist():
            found = Counter(terms(text))
            rows.append(row)
            row += 1
            lengths.append(found.total())
            held.append(list(found))
            times.append(list(found.values()))
        columns = [pa.array(rows, pa.int64()), batch.column(0), pa.array(lengths, pa.int64())]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(held, pa.list_(pa.string())), pa.array(times, pa.list_(pa.int64()))], schema=_READ_ARROW)


def _div(above: str, below: str) -> Column:
    return F.expr(f"({above}) div ({below})")


def _postings(docs: DataFrame, wanted: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(term, row, doc_id, impact, level) of the items' terms, and (term, level, postings, most) of their lists."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_counted, _READ)
    marked = rows.where("n > 0").select("row", "doc_id", "n", F.explode(F.arrays_zip(
        F.concat("terms", F.array(F.lit(""))).alias("word"), F.concat("tfs", F.array(F.lit(0).cast("long"))).alias("tf")
    )).alias("x")).select("row", "doc_id", "n", "x.word", "x.tf")
    found = scratch.write(marked.join(wanted, "word").select("term", "row", "doc_id", "n", "tf"), "found")
    whole = found.where("term = -1").agg(F.count("*").alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("words")).first()
    frequency = found.where("term >= 0").groupBy("term").agg(F.count("*").alias("df"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * whole["docs"] + 2) / (2 * F.col("df") + 1))).cast("long")
    weights = scratch.write(frequency.select("term", weight.alias("w")), "weights")
    length = F.lit(50).cast("long") + _div(f"50 * n * {whole['docs']}L", f"{max(whole['words'], 1)}L")
    scored = found.join(weights, "term").withColumn("m", length)
    scored = scored.withColumn("impact", F.col("w") * _div("1000000000 * tf", "1000 * tf + 20 * m")).where("impact > 0")
    level = F.floor(F.log2(F.col("impact").cast("double")) * STEPS).cast("int")
    postings = scratch.write(scored.select("term", "row", "doc_id", "impact", level.alias("level")), "postings")
    lists = postings.groupBy("term", "level").agg(F.count("*").alias("postings"), F.max("impact").alias("most"))
    return postings, scratch.write(lists, "lists")


def _first_depths(lists: DataFrame, reads: int) -> DataFrame:
    """term, depth: the level to which a list gives ``reads`` postings; null if that is all of it."""
    before = Window.partitionBy("term").orderBy(F.desc("level")).rowsBetween(Window.unboundedPreceding, 0)
    run = lists.withColumn("read", F.sum("postings").over(before))
    ends = run.groupBy("term").agg(F.max(F.when(F.col("read") >= reads, F.col("level"))).alias("depth"), F.min("level").alias("last"))
    return ends.select("term", F.when(F.col("depth") > F.col("last"), F.col("depth")).alias("depth"))


def _next_depths(lists: DataFrame, reading: DataFrame, limits: DataFrame) -> DataFrame:
    """item, term, depth: how far to read on, so that what is left of all lists adds up to less than the item's limit.

    The longest lists stay as they are while their greatest impacts fit under the limit, one more is read
    as far as it has to be, and the shorter ones are read to their ends.
    """
    whole = lists.groupBy("term").agg(F.sum("postings").alias("df"), F.max("most").alias("top"))
    longest = Window.partitionBy("item").orderBy(F.desc("df"), "term").rowsBetween(Window.unboundedPreceding, 0)
    terms = reading.join(limits, "item").join(whole, "term").withColumn("sum", F.sum("top").over(longest))
    terms = terms.withColumn("room", F.col("limit") - F.col("sum") + F.col("top"))
    # Levels whose greatest impact doesn't fit into the room that is left have to be read.
    partly = terms.where("sum >= limit and room > 0").select("item", "term", "room").join(lists, "term").where("most >= room")
    partly = partly.groupBy("item", "term").agg(F.min("level").alias("to"))
    planned = F.when(F.col("sum") < F.col("limit"), F.lit(_NONE)).when(F.col("room") > 0, F.col("to"))
    terms = terms.join(partly, ["item", "term"], "left").withColumn("to", planned)
    # Reading goes on, never back; a null depth is the end of a list.
    deeper = F.when(F.col("depth").isNotNull() & F.col("to").isNotNull(), F.least("depth", "to"))
    return terms.select("item", "term", deeper.alias("depth"))


def _with_frontiers(lists: DataFrame, reading: DataFrame) -> DataFrame:
    """item, term, depth, frontier."""
    ahead = reading.join(lists, "term").where("level < depth").groupBy("item", "term").agg(F.max("most").alias("frontier"))
    return reading.join(ahead, ["item", "term"], "left").select("item", "term", "depth", F.coalesce("frontier", F.lit(0).cast("long")).alias("frontier"))


def search(docs: DataFrame, items: DataFrame, top: int = TOP, probe: int = PROBE) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` documents of highest score above 0 for each item."""
    spark = docs.sparkSession
    with Scratch(spark, "ranked") as scratch:
        texts = items.select(F.col("item_id").cast("long").alias("item_id"), F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("text"))
        words = F.regexp_extract_all("text", F.lit("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"), F.lit(0))
        held = scratch.write(texts.select("item_id", F.explode(words).alias("word")).distinct(), "items")
        wanted = held.select("word").distinct().withColumn("term", F.monotonically_increasing_id())
        # The empty word is found in every document, once: it stands for the document itself.
        wanted = scratch.write(wanted.union(spark.range(1).select(F.lit("").alias("word"), F.lit(-1).cast("long").alias("term"))), "terms")
        ids = held.select("item_id").distinct().withColumn("item", F.monotonically_increasing_id())
        ids = scratch.write(ids, "ids", keep=True)
        asked = held.join(wanted, "word").join(ids, held["item_id"].eqNullSafe(ids["item_id"])).select("item", "term")
        asked = scratch.write(asked, "asked")
        postings, lists = _postings(docs, wanted, scratch)

        def read(reading: DataFrame, bars: DataFrame, number: int) -> tuple[DataFrame, DataFrame]:
            """(item, row, doc_id, low, high) of what is seen and can reach the bar; (item, unseen, bar, places)."""
            unseen = reading.groupBy("item").agg(F.sum("frontier").alias("unseen"))
            seen = postings.join(reading, "term").where(F.col("depth").isNull() | (F.col("level") >= F.col("depth")))
            seen = seen.groupBy("item", "row").agg(F.sum("impact").alias("low"), F.sum("frontier").alias("known"), F.min("doc_id").alias("doc_id"))
            high = F.col("low") - F.col("known") + F.col("unseen")
            seen = seen.join(unseen.join(bars, "item"), "item").withColumn("high", high).where("high >= bar")
            seen = scratch.write(seen.select("item", "row", "doc_id", "low", "high"), f"seen{number}")
            best = Window.partitionBy("item").orderBy(F.desc("low"))
            bar = seen.withColumn("place", F.row_number().over(best)).where(F.col("place") <= top)
            bar = bar.groupBy("item").agg(F.min("low").alias("bar"), F.count("*").alias("places"))
            # With fewer documents than asked for there is no bar: reading has to go to the end.
            state = unseen.join(bar, "item").select("item", "unseen", F.when(F.col("places") == top, F.col("bar")).otherwise(0).alias("bar"))
            return seen, scratch.write(state, f"state{number}")

        def exact(candidates: DataFrame, reading: DataFrame) -> DataFrame:
            """(item, row, doc_id, score): what is left of an item's lists is read for its candidates only."""
            rest = reading.where("frontier > 0").select("item", "term", "depth")
            further = candidates.select("item", "row").join(postings.drop("doc_id"), "row").join(rest, ["item", "term"]).where("level < depth")
            more = further.groupBy("item", "row").agg(F.sum("impact").alias("more"))
            found = candidates.join(more, ["item", "row"], "left")
            return found.select("item", "row", "doc_id", (F.col("low") + F.coalesce("more", F.lit(0))).alias("score"))

        best = Window.partitionBy("item").orderBy(F.desc("low"))
        none = asked.select("item").distinct().withColumn("bar", F.lit(0).cast("long"))
        first = scratch.write(_with_frontiers(lists, asked.join(_first_depths(lists, probe), "term")), "reading0")
        seen, state = read(first, none, 0)
        settled = state.where("unseen = 0 or unseen < bar")
        # The k that lead after the first round make a better bar by their whole scores: no result is under it.
        leading = seen.join(state.join(settled, "item", "left_anti").select("item"), "item")
        leading = leading.withColumn("place", F.row_number().over(best)).where(F.col("place") <= top)
        leading = scratch.write(leading.select("item", "row", "doc_id", "low"), "leading")
        bars = exact(leading, first).groupBy("item").agg(F.min("score").alias("least"), F.count("*").alias("places"))
        bars = scratch.write(bars.select("item", F.when(F.col("places") == top, F.col("least")).otherwise(0).alias("bar")), "bars")
        rounds = [(first, seen, settled)]
        second = scratch.write(_with_frontiers(lists, _next_depths(lists, first, bars.select("item", F.floor(F.col("bar") * LEFT).alias("limit")))), "reading1")
        seen, state = read(second, bars, 1)
        rounds.append((second, seen, state.join(bars.withColumnRenamed("bar", "known"), "item").withColumn("bar", F.greatest("bar", "known"))))
        scores = []
        for number, (reading, seen, state) in enumerate(rounds):
            candidates = seen.join(state.select("item", "bar"), "item").where("high >= bar").select("item", "row", "doc_id", "low")
            scores.append(exact(scratch.write(candidates, f"candidates{number}"), reading))
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last(), "row")
        ranked = scores[0].union(scores[1]).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        ranked = scratch.write(ranked.select("item", "rank", "doc_id", "score"), "ranked", keep=True)
    return ranked.join(ids, "item").select("item_id", "rank", "doc_id", "score")
