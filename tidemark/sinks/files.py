"""CSV sinks. Given the ``schema`` that readers will use, each notes its rows and checksum beside the files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import delimited, fixed_point
from tidemark.operators.index import row_index_in_files
from tidemark.session import scratch_scope
from tidemark.sinks.contents import record, watched

_NUMBER = "__number"


def _write(df: DataFrame, path: str, schema: T.StructType | None, **options) -> None:
    counts = None
    if schema is not None:
        df, counts = watched(df, schema)
    df.write.mode("overwrite").options(**options).csv(path)
    if counts is not None:
        record(df.sparkSession, path, counts.get)


def write_csv(df: DataFrame, path: str, schema: T.StructType | None = None) -> None:
    """A directory of CSV files with headers, taken from the column names."""
    # A blank header is written as nothing at all; so are empty texts then.
    blank = {"emptyValue": ""} if "" in df.columns else {}
    _write(df, path, schema, header=True, escape='"', **blank)


def write_csv_headerless(df: DataFrame, path: str, null: str = "None", schema: T.StructType | None = None) -> None:
    """A directory of CSV files without headers; NULL is written as ``null``."""
    _write(df, path, schema, header=False, nullValue=null, escape='"')


def write_averages_headerless(df: DataFrame, path: str, key: str, value: str, decimals: int = 2) -> None:
    """Lines of ``key,value`` with the value at fixed decimals."""
    line = delimited([F.col(key), fixed_point(F.col(value), decimals)])
    df.select(line.alias("value")).write.mode("overwrite").text(path)


def write_csv_indexed(
    df: DataFrame,
    path: str,
    order_by: str | Sequence[str],
    index: str = "index",
    start: int = 0,
    single_file: bool = False,
    drop: Sequence[str] = (),
    schema: T.StructType | None = None,
    rows_per_block: int | None = None,
) -> None:
    """CSV with a leading row number, in ``order_by``; ``drop`` lists columns that only order.

    ``single_file`` writes through one task and is for results that are small by nature, such as one
    row per month. Otherwise each file holds one range of row numbers, in the order of the files' names, as
    numbering lays them out. A blank ``index`` leaves the header of the first column empty.
    """
    columns = [c for c in df.columns if c != index and c not in drop]
    with scratch_scope(df.sparkSession):
        numbered = row_index_in_files(df, order_by, _NUMBER, start, rows_per_block=rows_per_block).select(_NUMBER, *columns)
        if single_file:
            numbered = numbered.coalesce(1).sortWithinPartitions(_NUMBER)
        write_csv(numbered.withColumnRenamed(_NUMBER, index), path, schema)
