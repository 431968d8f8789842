"""The flow that drops missing values instead of filling them, as SQL over named inputs.

``spark.sql`` binds the data frames by name for one statement only, so nothing is left behind in
the catalog; ``register`` makes named views for callers that write their own SQL.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.repair import missing_to_null, strict_cast
from tidemark.schemas import SALES_THRESHOLD, STORES, TOKEN_NULL
from tidemark.session import discard, scratch_path
from tidemark.sinks.files import write_csv_indexed
from tidemark.sinks.outputs import Output, run_if_incomplete

JOIN = """
SELECT Store_ID, Date, Dept, Weekly_Sales, CPI, Unemployment
FROM {sales} LEFT JOIN {economic} USING (index)
"""

CLEAN = """
WITH kept AS (
  SELECT *
  FROM {joined}
  WHERE array_contains(:stores, Store_ID)
    AND Date IS NOT NULL
    AND Weekly_Sales > :threshold
)
SELECT
  Store_ID,
  try_cast(substr(Date, 6, 2) AS INT) AS month,
  Dept,
  try_cast(Weekly_Sales AS DECIMAL(10, 2)) AS Weekly_Sales,
  try_cast(CPI AS DECIMAL(10, 2)) AS CPI,
  try_cast(Unemployment AS DECIMAL(10, 2)) AS Unemployment
FROM kept
"""

# The clean rows with what gives them their order in a file: the date, then the row.
KEYED_JOIN = JOIN.replace("SELECT ", "SELECT index, ", 1)
DATED = CLEAN.replace("SELECT\n", "SELECT\n  Date AS __date,\n  index AS __row,\n", 1)

# Decimal sums are exact; the quotient gets the digits it needs before the one rounding.
MONTHLY = """
SELECT month, CAST(round(sum(Weekly_Sales) / count(Weekly_Sales), 2) AS DECIMAL(10, 2)) AS Avg_Sales
FROM {clean}
GROUP BY month
"""


def register(**frames: DataFrame) -> None:
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)


def typed_sales(sales: DataFrame) -> DataFrame:
    text = missing_to_null(F.col("Weekly_Sales").cast("string"), TOKEN_NULL)
    return sales.select(
        F.col("index").cast("bigint").alias("index"),
        F.col("Store_ID").cast("int").alias("Store_ID"),
        missing_to_null(F.col("Date"), TOKEN_NULL).alias("Date"),
        F.col("Dept").cast("int").alias("Dept"),
        strict_cast(text, "float").alias("Weekly_Sales"),
    )


def typed_economic(economic: DataFrame) -> DataFrame:
    def number(name: str):
        if isinstance(economic.schema[name].dataType, T.NumericType):
            return F.col(name).cast("float").alias(name)
        return strict_cast(missing_to_null(F.col(name), TOKEN_NULL), "float").alias(name)

    return economic.select(F.col("index").cast("bigint").alias("index"), number("CPI"), number("Unemployment"))


def join_statement(spark: SparkSession, sales: DataFrame, economic: DataFrame) -> DataFrame:
    return spark.sql(JOIN, sales=sales, economic=economic)


def clean_statement(
    spark: SparkSession,
    joined: DataFrame,
    threshold: float = SALES_THRESHOLD,
    ordered: bool = False,
    stores: Sequence[int] = STORES,
) -> DataFrame:
    """``ordered`` sorts by date, which is not an output column; it only matters to a sink."""
    statement = CLEAN + ("ORDER BY Date" if ordered else "")
    wanted = F.array(*[F.lit(store) for store in stores])
    return spark.sql(statement, {"threshold": threshold, "stores": wanted}, joined=joined)


def monthly_statement(spark: SparkSession, clean: DataFrame, ordered: bool = False) -> DataFrame:
    return spark.sql(MONTHLY + ("ORDER BY month" if ordered else ""), clean=clean)


def run_sql(
    spark: SparkSession,
    sales: DataFrame,
    economic: DataFrame,
    threshold: float = SALES_THRESHOLD,
    ordered: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(clean, aggregate)."""
    joined = join_statement(spark, typed_sales(sales), typed_economic(economic))
    # The mean does not care about order, so only the clean output is ever sorted.
    unsorted = clean_statement(spark, joined, threshold)
    clean = clean_statement(spark, joined, threshold, ordered=True) if ordered else unsorted
    return clean, monthly_statement(spark, unsorted, ordered)


@dataclass(frozen=True)
class SqlTargets:
    """Where the SQL flow publishes; None leaves that output out."""

    clean_csv: str | None = None
    aggregate_csv: str | None = None


def publish_sql(
    spark: SparkSession,
    sales: DataFrame,
    economic: DataFrame,
    targets: SqlTargets,
    threshold: float = SALES_THRESHOLD,
    stores: Sequence[int] = STORES,
) -> bool:
    """Write both outputs with a leading row number, clean rows by date and row, means by month.

    Nothing is done if both are in order already; True if anything was written.
    """
    joined = spark.sql(KEYED_JOIN, sales=typed_sales(sales), economic=typed_economic(economic))
    wanted = F.array(*[F.lit(store) for store in stores])
    dated = spark.sql(DATED, {"threshold": threshold, "stores": wanted}, joined=joined)
    means = monthly_statement(spark, dated.drop("__date", "__row"))

    def in_file(df: DataFrame) -> T.StructType:
        return T.StructType([T.StructField("index", T.LongType()), *df.drop("__date", "__row").schema.fields])

    outputs = [
        Output("clean_csv", targets.clean_csv, "csv", in_file(dated), may_be_empty=True),
        Output("aggregate_csv", targets.aggregate_csv, "csv", in_file(means), may_be_empty=True),
    ]

    def write() -> None:
        # Clean rows are written once; numbering and means read that copy.
        path = scratch_path(spark, "sql-clean")
        try:
            dated.write.parquet(path)
            kept = spark.read.schema(dated.schema).parquet(path)
            if targets.clean_csv:
                write_csv_indexed(kept, targets.clean_csv, ["__date", "__row"], drop=["__date", "__row"])
            if targets.aggregate_csv:
                by_month = monthly_statement(spark, kept.drop("__date", "__row"))
                write_csv_indexed(by_month, targets.aggregate_csv, "month", single_file=True)
        finally:
            discard(spark, path)

    return run_if_incomplete(spark, [o for o in outputs if o.target], write)
