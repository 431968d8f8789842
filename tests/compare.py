"""Compare a registered query with its SQL."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return db


def _plain(value):
    return "NaN" if isinstance(value, float) and math.isnan(value) else value


def spark_rows(df) -> tuple[list[str], list[str], Counter]:
    names = sorted(df.columns)
    kinds = [df.schema[n].dataType.simpleString() for n in names]
    rows = Counter(tuple(_plain(v) for v in row) for row in df.select(*names).collect())
    return names, kinds, rows


_KINDS = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp", "FLOAT": "float",
}


def duck_rows(db, sql: str) -> tuple[list[str], list[str], Counter]:
    result = db.execute(sql)
    order = sorted(range(len(result.description)), key=lambda i: result.description[i][0])
    names = [result.description[i][0] for i in order]
    kinds = [_KINDS.get(str(result.description[i][1]), str(result.description[i][1])) for i in order]
    rows = Counter(tuple(_plain(row[i]) for i in order) for row in result.fetchall())
    return names, kinds, rows


def differences(spark, db, query, sql: str, sf_dir: str) -> str:
    """Empty if both agree in column names, types and rows."""
    names, kinds, rows = spark_rows(query(spark, sf_dir))
    sql_names, sql_kinds, sql_rows = duck_rows(db, sql)
    if names != sql_names:
        return f"columns {names} / {sql_names}"
    if kinds != sql_kinds:
        return f"types {list(zip(names, kinds, sql_kinds))}"
    if rows != sql_rows:
        only, missing = list((rows - sql_rows).items()), list((sql_rows - rows).items())
        return f"{names}: {len(only)} rows only in Spark {only[:3]}, {len(missing)} only in SQL {missing[:3]}"
    return ""
