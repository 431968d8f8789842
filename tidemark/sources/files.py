"""File sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.repair import strict_cast
from tidemark.operators.blocks import BROADCAST_ROWS

_CORRUPT = "__corrupt"


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_csv_positional(
    spark: SparkSession,
    path: str,
    names: Sequence[str],
    header: bool = True,
    keep_blank: bool = True,
) -> DataFrame:
    """Text fields by position under the given names; the file's own header is skipped, not used.

    Spark reads an empty field as NULL. With ``keep_blank`` a field that is there but empty is
    the empty string, and only fields missing from a short line are NULL.
    """
    fields = [T.StructField(name, T.StringType()) for name in names]
    reader = (
        spark.read.option("header", header)
        .option("enforceSchema", True)
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
    )
    if not keep_blank:
        return reader.schema(T.StructType(fields)).csv(path)
    df = (
        reader.schema(T.StructType([*fields, T.StructField(_CORRUPT, T.StringType())]))
        .option("columnNameOfCorruptRecord", _CORRUPT)
        .csv(path)
    )
    whole_line = F.col(_CORRUPT).isNull()
    return df.select(
        *[F.when(F.col(n).isNull() & whole_line, F.lit("")).otherwise(F.col(n)).alias(n) for n in names]
    )


# Never in a file, so a line is one field.
_NO_SEPARATOR, _NO_QUOTE = "\uffff", "\ufffe"
# A field is quoted, with quotes inside doubled, or has no quote.
_FIELD = '(?:"(?:[^"]|"")*+"|[^",]*+)'


def read_csv_checked(
    spark: SparkSession,
    path: str,
    names: Sequence[str],
    header: bool = True,
    keep_blank: bool = True,
    short_lines: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """(good, rejected): text fields by position as ``read_csv_positional`` reads them, and the lines that don't fit.

    A rejected line keeps its file, the offset of the split that it was read from, its text and a reason: ``quotes`` that
    don't close or stand within a field, ``surplus fields``, and, unless ``short_lines`` are taken with NULL for what they
    lack, ``missing fields``. Blank lines are no rows. A record is a line; files with line breaks inside quotes aren't
    for this reader, which rejects both halves.
    """
    lines = (
        spark.read.option("header", header)
        .option("enforceSchema", True)
        .option("sep", _NO_SEPARATOR)
        .option("quote", _NO_QUOTE)
        .schema("line string")
        .csv(path)
        .select(
            F.col("line"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("offset"),
        )
    )
    # Quoted fields out, commas are ends of fields.
    bare = F.regexp_replace("line", '"(?:[^"]|"")*+"', "")
    fields = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    reason = (
        F.when(~F.col("line").rlike(f"^{_FIELD}(?:,{_FIELD})*+$"), "quotes")
        .when(fields > len(names), "surplus fields")
        .when(F.lit(not short_lines) & (fields < len(names)), "missing fields")
    )
    judged = lines.where("line is not null").withColumns({"fields": fields, "reason": reason})
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))])
    good = judged.where(F.col("reason").isNull()).select("fields", F.from_csv("line", schema.simpleString()[7:-1].replace(":", " "), {"escape": '"'}).alias("row"))
    values = []
    for i, name in enumerate(names):
        value = F.col(f"row.c{i}")
        if keep_blank:
            value = F.when(value.isNull() & (F.col("fields") > i), F.lit("")).otherwise(value)
        values.append(value.alias(name))
    return good.select(*values), judged.where(F.col("reason").isNotNull()).select("file", "offset", "line", "reason")


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet by suffix, anything else as CSV with a header; any file system Spark knows.

    Without a schema CSV columns are text: inferring types would read the data twice.
    """
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    reader = spark.read.option("header", True).option("escape", '"')
    return (reader.schema(schema) if schema else reader).csv(path)


def bulk_load_csv(
    spark: SparkSession,
    path: str,
    table: str,
    schema: T.StructType,
    location: str | None = None,
    strict: bool = True,
) -> DataFrame:
    """Load a headed CSV into a typed catalog table, replacing it, and return the table.

    ``strict`` fails on text that does not parse; otherwise it becomes NULL.
    """
    text = read_csv_positional(spark, path, schema.fieldNames(), keep_blank=False)
    typed = text.select(
        *[
            (
                strict_cast(F.col(f.name), f.dataType.simpleString())
                if strict
                else F.col(f.name).try_cast(f.dataType)
            ).alias(f.name)
            for f in schema
        ]
    )
    from tidemark.sinks.tables import write_table

    write_table(typed, table, schema, location=location)
    return spark.table(table)


def typed_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """Literal rows under an explicit schema, for fixtures and small lookups.

    Spark knows no size of rows made by the driver and would shuffle what they are joined to by the few values they
    have; up to ``BROADCAST_ROWS`` they are marked for broadcast.
    """
    rows = list(rows)
    table = spark.createDataFrame(rows, schema)
    return F.broadcast(table) if len(rows) <= BROADCAST_ROWS else table
