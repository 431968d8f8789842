"""Sales and economic tables derived from the given tables.

The given tables have no missing values, so some are put in by rules over the key. The rules are
repeated in ``oracles.py`` in SQL. No row is left out anywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.joins import first_per_key

THRESHOLD = 100000.0
LINE_ORDER = ["line", "price", "quantity", "flag", "status", "part"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def every(key: Column, n: int) -> Column:
    return key % n == 0


def dirty_sales_text(key: Column, price: Column) -> Column:
    return (
        F.when(every(key, 7), "null")
        .when(every(key, 11), "")
        .when(every(key, 13), "bad")
        .when(every(key, 17), "0")
        .when(every(key, 23), "None")
        .otherwise(price.cast("string"))
    )


def dirty_date_text(key: Column, date: Column) -> Column:
    return (
        F.when(every(key, 19), "null")
        .when(every(key, 29), "not-a-date")
        .otherwise(F.date_format(date, "yyyy-MM-dd"))
    )


def sales(spark: SparkSession, sf_dir: str, bad_keys: bool = False) -> DataFrame:
    """Orders as a sales file read as text, with missing, blank, bad and zero values."""
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    index, store = key.cast("string"), (customer % 5).cast("string")
    if bad_keys:
        index = F.when(every(key, 31), "invalid").otherwise(index)
        store = F.when(every(customer, 37), "x").otherwise(store)
    return table(spark, sf_dir, "orders").select(
        index.alias("index"),
        store.alias("Store_ID"),
        dirty_date_text(key, F.col("o_orderdate")).alias("Date"),
        (customer % 97).cast("string").alias("Dept"),
        dirty_sales_text(key, F.col("o_totalprice")).alias("Weekly_Sales"),
    )


def sales_null_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``sales`` but every value that is not 'null' parses: for flows that fail on bad text."""
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    return table(spark, sf_dir, "orders").select(
        key.alias("index"),
        (customer % 5).cast("int").alias("Store_ID"),
        F.when(every(key, 19), "null")
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
        .alias("Date"),
        (customer % 97).cast("int").alias("Dept"),
        F.when(every(key, 7), "null")
        .when(every(key, 17), "0")
        .otherwise(F.col("o_totalprice").cast("string"))
        .alias("Weekly_Sales"),
    )


def _economic_columns(rule: Column, with_bad: bool) -> list[Column]:
    text = F.when(every(rule, 6), "null")
    if with_bad:
        text = text.when(every(rule, 11), "bad")
    return [
        (F.col("flag") == "R").cast("int").alias("IsHoliday"),
        F.when(~every(rule, 5), F.col("price")).alias("CPI"),
        text.otherwise(F.col("quantity").cast("string")).alias("Unemployment"),
        F.when(~every(rule, 8), F.col("status")).alias("Type"),
        F.when(~every(rule, 9), F.col("part")).alias("Size"),
    ]


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("index"),
        F.col("l_linenumber").alias("line"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_returnflag").alias("flag"),
        F.col("l_linestatus").alias("status"),
        F.col("l_partkey").alias("part"),
    )


def economic_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several economic rows per key, in the total order (index, *LINE_ORDER)."""
    rule = F.col("index") + F.col("line")
    return lines(spark, sf_dir).select("index", *LINE_ORDER, *_economic_columns(rule, True))


def economic(spark: SparkSession, sf_dir: str, with_bad: bool = True) -> DataFrame:
    """One economic row per key."""
    first = first_per_key(lines(spark, sf_dir), "index", LINE_ORDER)
    return first.select("index", *_economic_columns(F.col("index"), with_bad))


def dirty_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with gaps in three columns, of three types."""
    key = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        F.when(key % 7 > 2, F.col("value")).alias("value"),
        F.when(~every(key, 3), F.col("event_type")).alias("event_type"),
        F.when(~every(key, 4), F.col("user_id") * 10).alias("score"),
    )


def sales_twice(spark: SparkSession, sf_dir: str, bad_keys: bool = False) -> DataFrame:
    """Every sales row and a second one of its key, in the total order (index, copy)."""
    rows = sales(spark, sf_dir, bad_keys).withColumn("copy", F.lit(1))
    price = F.col("o_totalprice")
    twice = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey"), F.format_string("%.2f", price * 2).alias("doubled")
    )
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    index, store = key.cast("string"), ((customer + 1) % 5).cast("string")
    if bad_keys:
        index = F.when(every(key, 31), "invalid").otherwise(index)
    second = twice.select(
        index.alias("index"), store.alias("Store_ID"), F.lit("2024-02-02").alias("Date"), F.lit("50").alias("Dept"),
        F.col("doubled").alias("Weekly_Sales"), F.lit(2).alias("copy"),
    )
    return rows.unionByName(second)


def economic_lines_with_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Economic lines that carry a store of their own."""
    return economic_lines(spark, sf_dir).withColumn("Store_ID", (F.col("index") % 3).cast("string"))


def wide_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a unique key spread from one end of the long range to the other."""
    spread = (F.col("event_id") % 1009 - 504) * F.lit(18_300_000_000_000_000).cast("long") + F.col("event_id")
    return dirty_events(spark, sf_dir).withColumn("wide", spread)


def null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events some of which have no key, in the total order (key, event_id)."""
    return dirty_events(spark, sf_dir).withColumn("key", F.when(~every(F.col("event_id"), 50), F.col("event_id")))


def busy_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by day, of which one holds a third of all, in the total order (day, event_id)."""
    day = F.when(every(F.col("event_id"), 3), F.lit(40)).otherwise(F.col("event_id") % 90)
    return dirty_events(spark, sf_dir).withColumn("day", F.date_add(F.lit("2024-01-01").cast("date"), day.cast("int")))


def broken_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a sales file, some with a field too many, one too few, or quotes that don't close."""
    key = F.col("o_orderkey")
    store, price = (F.col("o_custkey") % 5).cast("string"), F.col("o_totalprice").cast("string")
    line = F.concat_ws(",", key.cast("string"), store, F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit('"7, or ""8"""'), price)
    cut = F.concat_ws(",", key.cast("string"), store, F.lit("2024-01-01"))
    return table(spark, sf_dir, "orders").select(
        F.when(every(key, 41), F.concat(line, F.lit(",more")))
        .when(every(key, 43), cut)
        .when(every(key, 47), F.concat(cut, F.lit(',"7,'), price))
        .when(every(key, 53), F.concat(cut, F.lit(',7 "or" 8,'), price))
        .otherwise(line)
        .alias("value")
    )
