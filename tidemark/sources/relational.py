"""Relational tables over JDBC. The driver jar comes with the session (``spark.jars``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
    driver: str | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Reader options; with a partition column the table is read by parallel range queries."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if driver:
        options["driver"] = driver
    if partition_column:
        if bounds is None:
            raise ValueError("a partitioned read needs the bounds of its column")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def range_predicates(column: str, cuts: Sequence[int]) -> list[str]:
    """One predicate per range between ascending ``cuts``, NULLs in the first; for uneven keys."""
    if not cuts:
        return [f"{column} IS NULL OR {column} IS NOT NULL"]
    inner = [f"{column} >= {low} AND {column} < {high}" for low, high in zip(cuts, cuts[1:])]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *inner, f"{column} >= {cuts[-1]}"]


def read_jdbc(
    spark: SparkSession, url: str, table: str, predicates: Sequence[str] | None = None, **options
) -> DataFrame:
    """A lazy table scan that Spark prunes and filters at the source.

    Equal ranges of a partition column suit even keys. Where one range would hold much of the
    table, give ``predicates`` instead (see ``range_predicates``): one task reads each.
    """
    settings = jdbc_options(url, table, **options)
    if predicates:
        own = {k: v for k, v in settings.items() if k not in ("url", "dbtable")}
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=own)
    return spark.read.format("jdbc").options(**settings).load()
