"""Quality rules: a table of thresholds, compiled into one projection.

Every measure is a column expression over the text; a rule compares one measure with a share of another in
integers (``100 * measure > limit * base``), so no rule depends on how doubles round. The whole table becomes
one array of rule names and one verdict, computed row by row: no shuffle, no user function, no second pass.

Defined results: a null or wordless text has zero for every measure and is not kept (it has under 50 words).
Rows are judged each on its own, so ties and repeated rows get equal verdicts; very long texts are measured whole; an empty table gives no rows;
columns beyond ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WORD

# Frequent function words of the four languages.
STOP_WORDS = (
    "the of and to in a is that it for on was be with as by this at are from "
    "de la le et les des un une en que el los las del por para con se es lo y "
    "der die das und den von zu mit ist im auf nicht ein eine sich dem du dans pour est qui au"
).split()


@dataclass(frozen=True)
class Rule:
    """Fails a text if 100 * measure exceeds (``most``) or stays under (``least``) a percentage of ``base``."""

    name: str
    measure: str
    base: str
    most: int | None = None
    least: int | None = None

    def fails(self) -> Column:
        share = F.col(self.measure) * 100
        if self.most is not None:
            return share > F.col(self.base) * self.most
        return share < F.col(self.base) * self.least


BASE = (
    Rule("few_words", "n_words", "one", least=50 * 100),
    Rule("repeated_words", "n_repeat_words", "n_words", most=50),
)
RULES = (
    Rule("short_words", "word_chars", "n_words", least=200),
    Rule("long_words", "word_chars", "n_words", most=1500),
    Rule("symbols", "n_symbols", "n_words", most=10),
    Rule("repeated_lines", "n_dup_lines", "n_lines", most=50),
    Rule("stop_words", "n_stop_words", "n_words", least=2),
    Rule("shouting", "n_upper", "word_chars", most=40),
)


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def repeated_words(words: Column, size: int = 3) -> Column:
    """Words in windows of ``size`` words that occur at least twice in the array, the first one included.

    Windows are compared by a 64-bit hash of their words, only within one text. A text without equal windows
    is done after a distinct count. Else windows are sorted with their places; neighbours that are equal
    repeat, and of their sorted places each covers the words up to the next place, or all its own.
    """

    def hashes(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(w) - size)
        return F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(size)]))

    def flagged(s: Column) -> Column:
        def same(k: Column) -> Column:
            return F.get(s, k)["h"]

        places = F.transform(
            s, lambda x, k: F.when((x["h"] == same(k - 1)) | (x["h"] == same(k + 1)), x["i"])
        )
        return F.array_sort(F.filter(places, lambda i: i.isNotNull()))

    def covered(p: Column) -> Column:
        widths = F.transform(
            p, lambda i, k: F.least(F.lit(size), F.coalesce(F.get(p, k + 1) - i, F.lit(size)))
        )
        return F.aggregate(widths, F.lit(0), lambda total, n: total + n)

    def count(h: Column) -> Column:
        placed = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(_let(_let(placed, flagged), covered))

    return F.when(F.size(words) > size, _let(hashes(words), count)).otherwise(0).cast("long")


def measures(docs: DataFrame) -> DataFrame:
    """doc_id and every measure a rule may name."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    # Stop words count in three spellings: the, The, THE.
    stop = sorted({form for w in STOP_WORDS for form in (w, w.capitalize(), w.upper())})

    def matches(pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern)).cast("long")

    def line_counts(all_lines: Column) -> Column:
        lines = F.filter(all_lines, lambda x: x.rlike(WORD))
        return _let(
            lines,
            lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup")),
        )

    # Words and line counts have a projection of their own: used by several measures, they are built once.
    parts = docs.select(
        "doc_id",
        words.alias("w"),
        line_counts(F.split(text, "\n", -1)).alias("l"),
        (F.char_length(text) - matches("[\\x20\\x09-\\x0D]")).cast("long").alias("word_chars"),
        matches("[#*$%&|<>]").alias("n_symbols"),
        matches("[A-Z]").alias("n_upper"),
    )
    return parts.select(
        "doc_id",
        F.size("w").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        F.col("l")["dup"].cast("long").alias("n_dup_lines"),
        repeated_words(F.col("w")).alias("n_repeat_words"),
        F.col("l")["n"].cast("long").alias("n_lines"),
        F.size(F.filter("w", lambda x: x.isin(*stop))).cast("long").alias("n_stop_words"),
        "n_upper",
        F.lit(1).cast("long").alias("one"),
    )


def judge(docs: DataFrame, base: tuple[Rule, ...] = BASE, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: measures, ``base_failed``, ``kept`` and the names of the rules it fails."""

    def failed(table: tuple[Rule, ...]) -> Column:
        return F.filter(F.array(*[F.when(r.fails(), F.lit(r.name)) for r in table]), lambda x: x.isNotNull())

    judged = measures(docs).select("*", failed(base).alias("failed_base"), failed(rules).alias("failed_rules"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (F.size("failed_base") > 0).alias("base_failed"),
        ((F.size("failed_base") == 0) & (F.size("failed_rules") == 0)).alias("kept"),
        F.concat_ws(",", "failed_base", "failed_rules").alias("failed"),
    )
