"""What an output holds: its number of rows and a checksum, noted when it is written and counted again later.

The checksum is a sum of row hashes, so it depends neither on the order of rows nor on files, and a row that is there
twice counts twice. Values are hashed as what they mean under the output's columns, not as they are spelled, so text
files and tables agree. The note is taken while the rows are written, by the writing job itself, and lies beside the
data in a folder that readers skip; replacing the output replaces it.
"""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import path_exists

NOTE = "_contents"
_NOTED = "rows long, checksum string"


def plain(schema: T.StructType) -> T.StructType:
    """The same columns under plain names: a file may have a blank header."""
    return T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(schema)])


def row_hash(schema: T.StructType) -> Column:
    """Of the values by their declared types; an absent text is an empty one, as text files can't tell them apart."""

    def value(field: T.StructField) -> Column:
        absent = "" if isinstance(field.dataType, T.StringType) else "\0"
        return F.coalesce(F.col(field.name).try_cast(field.dataType).cast("string"), F.lit(absent))

    return F.xxhash64(*[value(f) for f in schema])


def content(schema: T.StructType) -> list[Column]:
    """Aggregates: the number of rows and the sum of their hashes."""
    return [F.count(F.lit(1)).alias("rows"), F.sum(row_hash(schema).cast("decimal(38,0)")).alias("checksum")]


def unreadable(schema: T.StructType) -> list[Column]:
    """Aggregates: for each column how many present values its type can't hold."""
    return [
        F.count_if(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()).alias(f"bad_{f.name}") for f in schema
    ]


def watched(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, Observation]:
    """``df`` to be written at once, and what will have been written. Columns go by their places.

    Rows are counted in the tasks that write them, whose counts Spark takes once, however often they run.
    """
    observation, held = Observation(), plain(schema)
    return df.toDF(*held.fieldNames()).observe(observation, *content(held)).toDF(*df.columns), observation


def record(spark: SparkSession, path: str, found: Mapping[str, object]) -> None:
    """Note the content of the output at ``path``."""
    row = (int(found["rows"]), _text(found["checksum"]))
    spark.createDataFrame([row], _NOTED).coalesce(1).write.mode("overwrite").json(f"{path.rstrip('/')}/{NOTE}")


def noted(spark: SparkSession, path: str) -> tuple[int, str] | None:
    """(rows, checksum) as written, or None without a note."""
    place = f"{path.rstrip('/')}/{NOTE}"
    if not path_exists(spark, f"{place}/_SUCCESS"):
        return None
    row = spark.read.schema(_NOTED).json(place).first()
    return None if row is None else (row["rows"], row["checksum"])


def counted(df: DataFrame, schema: T.StructType) -> tuple[int, str, dict[str, int]]:
    """(rows, checksum, bad values by column) of what is there now, in one pass. Columns go by their places."""
    held = plain(schema)
    found = df.toDF(*held.fieldNames()).agg(*content(held), *unreadable(held)).first()
    bad = {f.name: found[f"bad_c{i}"] for i, f in enumerate(schema) if found[f"bad_c{i}"]}
    return found["rows"], _text(found["checksum"]), bad


def _text(checksum: Decimal | None) -> str:
    return str(int(checksum or 0))
