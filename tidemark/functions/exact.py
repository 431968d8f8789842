"""Sums and means of doubles that come out the same, to the last bit, however rows are split over tasks.

A double is split into three whole numbers of up to 33 bits, its words on a grid of powers of 2**32. Words of the same
power add up as decimals without loss, so sums over groups are exact, whatever the exponents. At the end each group's
words are carried into digits of base 2**32, divided by the count digit by digit, and rounded once, to the nearest
double. A group has a row for each power that occurs, 66 at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BASE = 2**32
_DIGIT = "decimal(38,0)"
# Digits below the smallest word: a quotient's first three digits lie at most so far down.
_BELOW = 5
# Digits above the largest: room for the count of rows.
_ABOVE = 3


def _power(exponent: Column) -> Column:
    return F.pow(F.lit(2.0), exponent.cast("double"))


def _scaled(value: Column, words: Column) -> Column:
    """``value * 2**(32 * words)``, in two steps as the factor itself may not be a double."""
    half = _power(words * 16)
    return value * half * half


def words(rows: DataFrame, value: str) -> DataFrame:
    """``rows`` with the power of a finite double and its words: at that power and the two below. NULL counts as 0.

    One projection a step, so that each is computed once.
    """
    size = F.abs(F.coalesce(value, F.lit(0.0)))
    rows = rows.withColumn("__power", F.when(size > 0, F.floor(F.log2(size) / 32)).otherwise(F.lit(0)).cast("int"))
    rows = rows.withColumn("__half", _power(F.col("__power") * -16))
    rows = rows.withColumn("__rest0", F.coalesce(value, F.lit(0.0)) * F.col("__half") * F.col("__half"))
    for i in (1, 2):
        before = F.col(f"__rest{i - 1}")
        rows = rows.withColumn(f"__rest{i}", (before - before.cast("long").cast("double")) * float(_BASE))
    return rows.withColumns({f"__word{i}": F.col(f"__rest{i}").cast("long").cast("decimal(10,0)") for i in range(3)})


def mean_of_doubles(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """keys, ``name``: the mean of a numeric column as the nearest double to the exact quotient; NULL without values.

    NaN and infinities give what adding them gives. The mean of values below the normal range may be rounded twice.
    """
    number = F.col(value).cast("double")
    special = F.isnan(number) | (F.abs(number) == float("inf"))
    rows = df.select(*keys, number.alias("__value"), special.alias("__special"))
    rows = words(rows.withColumn("__finite", F.when(~F.col("__special"), F.col("__value"))), "__finite")
    # Rows combine per task by power; a group's powers are few.
    by_power = rows.groupBy(*keys, "__power").agg(
        *[F.sum(f"__word{i}").alias(f"w{i}") for i in range(3)], F.count("__value").alias("n"),
        F.sum(F.when(F.col("__special"), F.col("__value"))).alias("special"),
    )
    word = F.struct(F.col("__power").alias("power"), "w0", "w1", "w2")
    groups = by_power.groupBy(*keys).agg(
        F.collect_list(word).alias("words"), F.sum("n").alias("n"), F.sum("special").alias("special"),
        F.max("__power").alias("top"), F.min("__power").alias("bottom"),
    )
    lowest, highest = F.col("bottom") - 2 - _BELOW, F.col("top") + _ABOVE
    zero = F.lit(0).cast(_DIGIT)

    def at(power: Column) -> Column:
        """All words of a power."""
        return F.aggregate("words", zero, lambda total, x: (total + F.when(x["power"] == power, x["w0"]).when(
            x["power"] - 1 == power, x["w1"]).when(x["power"] - 2 == power, x["w2"]).otherwise(zero)).cast(_DIGIT))

    # Without any row there is still one group if there are no keys; it has no words.
    groups = groups.withColumn("n", F.coalesce("n", F.lit(0).cast("long"))).withColumn("sums", F.transform(F.sequence(lowest, highest), at))
    base = F.lit(_BASE).cast(_DIGIT)

    def carried(sums: Column) -> Column:
        """Digits from the lowest up, and what is carried out of the highest: 0, or -1 of a sum below zero."""
        start = F.struct(zero.alias("carry"), F.array().cast(f"array<{_DIGIT}>").alias("digits"))

        def step(held: Column, word: Column) -> Column:
            total = (word + held["carry"]).cast(_DIGIT)
            digit = F.pmod(total, base).cast(_DIGIT)
            carry = F.call_function("div", total - digit, base).cast(_DIGIT)
            return F.struct(carry.alias("carry"), F.concat(held["digits"], F.array(digit)).alias("digits"))

        return F.aggregate(sums, start, step)

    groups = groups.withColumn("plus", carried(F.col("sums")))
    groups = groups.withColumn("minus", carried(F.transform("sums", lambda x: (-x).cast(_DIGIT))))
    groups = groups.withColumn("below", F.col("plus.carry") < 0)
    groups = groups.withColumn("digits", F.reverse(F.when(F.col("below"), F.col("minus.digits")).otherwise(F.col("plus.digits"))))
    start = F.struct(zero.alias("rest"), F.array().cast(f"array<{_DIGIT}>").alias("digits"))
    count = F.greatest("n", F.lit(1)).cast("decimal(19,0)")

    def divided(held: Column, digit: Column) -> Column:
        total = (held["rest"] * base + digit).cast(_DIGIT)
        quotient = F.call_function("div", total, count).cast("decimal(19,0)")
        rest = (total - (quotient * count).cast(_DIGIT)).cast(_DIGIT)
        return F.struct(rest.alias("rest"), F.concat(held["digits"], F.array(quotient.cast(_DIGIT))).alias("digits"))

    groups = groups.withColumn("quotient", F.aggregate("digits", start, divided))
    groups = groups.withColumn("first", F.array_position(F.transform("quotient.digits", lambda x: x > 0), True).cast("int"))
    digits, first = F.col("quotient.digits"), F.col("first")
    lead = F.get(digits, first - 1) * F.lit(str(2**64)).cast("decimal(20,0)") + F.get(digits, first) * base + F.get(digits, first + 1)
    lead = lead.cast(_DIGIT)
    # What lies below the 65 bits or more of these digits only tells that they are not all.
    more = (F.col("quotient.rest") > 0) | F.exists(F.slice(digits, first + 3, F.size(digits)), lambda x: x > 0)
    sticky = lead + F.when(more & (F.pmod(lead, F.lit(2).cast(_DIGIT)) == 0), 1).otherwise(0)
    size = _scaled(sticky.cast("double"), highest - first - 1)
    mean = F.when(first == 0, F.lit(0.0)).otherwise(F.when(F.col("below"), -size).otherwise(size))
    found = F.when(F.col("n") > 0, F.when(F.col("special").isNotNull(), F.col("special")).otherwise(mean))
    return groups.select(*keys, found.alias(name))
