"""Catalog tables, replaced so that a failed write leaves the old rows in place.

A replacement is written to a folder of its own, read back and held against its contract, and only then does the table
point there: one change in the catalog, which readers see as a whole. Several tables can switch together; if one of
them cannot, those before it switch back. The version before the current one stays on disk, as queries that have
begun still read it; older ones go.

Tables of the same columns switch by their location. Where columns or partitions differ the new table is made beside
the old one and the two change names; between the two renames the table is missing for a moment, and a failure there
puts the old name back.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.rows import project_typed
from tidemark.session import discard, folder_names
from tidemark.sinks.contents import record, watched

_VERSION = "version-"


class ContractBroken(ValueError):
    """What was written is not what the table may hold."""


@dataclass(frozen=True)
class Replacement:
    """New content of a table. ``location`` is the folder that holds its versions, by default one beside the
    tables of its schema; ``required`` columns may hold no NULL."""

    frame: DataFrame
    table: str
    schema: T.StructType
    location: str | None = None
    partition_by: str | None = None
    required: tuple[str, ...] = ()
    may_be_empty: bool = True


@dataclass(frozen=True)
class _Staged:
    wanted: Replacement
    root: str
    path: str


def write_table(
    df: DataFrame,
    table: str,
    schema: T.StructType,
    location: str | None = None,
    partition_by: str | None = None,
) -> None:
    """Replace a table's content under a declared schema, creating namespace and table if needed.

    Columns are selected and cast by ``schema``; anything else in ``df`` is left out.
    """
    replace_tables(df.sparkSession, [Replacement(df, table, schema, location, partition_by)])


def replace_tables(spark: SparkSession, replacements: Sequence[Replacement]) -> None:
    """Replace the content of all these tables or of none."""
    staged: list[_Staged] = []
    try:
        for wanted in replacements:
            staged.append(_stage(spark, wanted))
            _write(staged[-1])
        for one in staged:
            _hold_to_contract(spark, one)
        finish = _switch(spark, staged)
    except BaseException:
        for one in staged:
            discard(spark, one.path)
        raise
    for one, (forget, before) in zip(staged, finish):
        forget()
        _remove_older(spark, one, before)


def drop_table(spark: SparkSession, table: str, location: str | None = None) -> None:
    """Drop a table with all its versions."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    root = location or _default_root(spark, table)
    for name in folder_names(spark, root):
        if name.startswith(_VERSION):
            discard(spark, f"{root}/{name}")


def table_location(spark: SparkSession, table: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'")
    return described.first()["data_type"]


def _default_root(spark: SparkSession, table: str) -> str:
    schema, _, name = table.rpartition(".")
    folder = spark.catalog.getDatabase(schema or spark.catalog.currentDatabase()).locationUri
    return f"{folder.rstrip('/')}/{name}-versions"


def _stage(spark: SparkSession, wanted: Replacement) -> _Staged:
    if "." in wanted.table:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {wanted.table.rsplit('.', 1)[0]}")
    root = (wanted.location or _default_root(spark, wanted.table)).rstrip("/")
    return _Staged(wanted, root, f"{root}/{_VERSION}{uuid.uuid4().hex}")


def _write(staged: _Staged) -> None:
    wanted = staged.wanted
    rows, counts = watched(project_typed(wanted.frame, wanted.schema), wanted.schema)
    writer = rows.write.format("parquet")
    if wanted.partition_by:
        writer = writer.partitionBy(wanted.partition_by)
    writer.save(staged.path)
    record(wanted.frame.sparkSession, staged.path, counts.get)


def _hold_to_contract(spark: SparkSession, staged: _Staged) -> None:
    wanted = staged.wanted
    stored = spark.read.parquet(staged.path) if not wanted.partition_by else spark.read.schema(_nullable(wanted)).parquet(staged.path)
    kinds = {f.name: f.dataType for f in stored.schema}
    if kinds != {f.name: f.dataType for f in wanted.schema}:
        raise ContractBroken(f"{wanted.table}: written with {stored.schema.simpleString()}")
    if not wanted.required and wanted.may_be_empty:
        return
    found = stored.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c).isNull()).alias(f"n_{c}") for c in wanted.required]).first()
    missing = [c for c in wanted.required if found[f"n_{c}"]]
    if missing:
        raise ContractBroken(f"{wanted.table}: NULL in {missing}")
    if not found["rows"] and not wanted.may_be_empty:
        raise ContractBroken(f"{wanted.table}: no rows")


def _nullable(wanted: Replacement) -> T.StructType:
    """The columns as a table has them: partition columns last, NULL anywhere."""
    fields = sorted(wanted.schema.fields, key=lambda f: f.name == wanted.partition_by)
    return T.StructType([T.StructField(f.name, f.dataType) for f in fields])


def _create(spark: SparkSession, staged: _Staged, table: str) -> None:
    wanted = staged.wanted
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in _nullable(wanted))
    parts = f"PARTITIONED BY (`{wanted.partition_by}`)" if wanted.partition_by else ""
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet {parts} LOCATION '{staged.path}'")
    if wanted.partition_by:
        spark.catalog.recoverPartitions(table)


def _same_shape(spark: SparkSession, wanted: Replacement) -> bool:
    columns = spark.catalog.listColumns(wanted.table)
    found = [(c.name, c.dataType, c.isPartition) for c in columns]
    return not wanted.partition_by and found == [(f.name, f.dataType.simpleString(), False) for f in wanted.schema]


_Undo = Callable[[], None]


def _switch(spark: SparkSession, staged: Sequence[_Staged]) -> list[tuple[Callable[[], None], str | None]]:
    """Let all tables point to what was staged; for each what is left to forget, and where it was before."""
    undo: list[_Undo] = []
    finish = []
    try:
        for one in staged:
            back, forget, before = _point(spark, one)
            undo.append(back)
            finish.append((forget, before))
    except BaseException:
        for back in reversed(undo):
            back()
        raise
    return finish


def _point(spark: SparkSession, staged: _Staged) -> tuple[_Undo, Callable[[], None], str | None]:
    table = staged.wanted.table

    def statement(text: str) -> _Undo:
        return lambda: spark.sql(text)

    def nothing() -> None:
        pass

    if not spark.catalog.tableExists(table):
        _create(spark, staged, table)
        return statement(f"DROP TABLE {table}"), nothing, None
    before = table_location(spark, table)
    if _same_shape(spark, staged.wanted):

        def point(path: str) -> None:
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
            spark.catalog.refreshTable(table)

        point(staged.path)
        return lambda: point(before), nothing, before
    mark = uuid.uuid4().hex[:12]
    fresh, old = f"{table}_new_{mark}", f"{table}_old_{mark}"
    _create(spark, staged, fresh)
    try:
        spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
        try:
            spark.sql(f"ALTER TABLE {fresh} RENAME TO {table}")
        except BaseException:
            spark.sql(f"ALTER TABLE {old} RENAME TO {table}")
            raise
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {fresh}")
        raise

    def back() -> None:
        spark.sql(f"DROP TABLE {table}")
        spark.sql(f"ALTER TABLE {old} RENAME TO {table}")

    return back, statement(f"DROP TABLE {old}"), before


def _remove_older(spark: SparkSession, staged: _Staged, before: str | None) -> None:
    """Versions other than the current one and the one before it."""
    stay = {staged.path.rsplit("/", 1)[1], (before or "").rstrip("/").rsplit("/", 1)[-1]}
    for name in folder_names(spark, staged.root):
        if name.startswith(_VERSION) and name not in stay:
            discard(spark, f"{staged.root}/{name}")
