"""What the operators share: reading, words, written intermediates, session settings while a job runs."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from tidemark.session import scratch_path

# The separators of words: space and the control characters from tab to carriage return.
SPACES = " \t\n\x0b\x0c\r"
WORD = "[^\\x20\\x09-\\x0D]+"

# Rows that Python holds as objects at once. Arrow batches are cut to this, so memory follows the
# longest texts and not the batch size of the session.
SLICE_ROWS = 256

# Held while an operator runs its own jobs, put back afterwards. Shuffle files go when a job is over,
# not when the driver next collects garbage: an operator of several jobs needs the disk of its largest.
JOB_CONF = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


@contextmanager
def job_settings(spark: SparkSession, **more: str) -> Iterator[None]:
    """``more``: settings of a job of its own, with ``__`` for dots."""
    held = JOB_CONF | {key.replace("__", "."): value for key, value in more.items()}
    before = {key: spark.conf.get(key, None) for key in held}
    for key, value in held.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


class Scratch:
    """Tables written to the shared folder, which cut lineage; those not kept go when the block ends.

    A table is written once and read by later jobs, so a lost executor costs its running tasks only,
    and no later job sees other sort bounds, partitions or samples than the one before.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.label, self.paths, self.tables = spark, label, [], []

    def __enter__(self) -> Scratch:
        self._settings = job_settings(self.spark)
        self._settings.__enter__()
        return self

    def __exit__(self, *error) -> None:
        self._settings.__exit__(*error)
        for table in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        for path in self.paths:
            remove(self.spark, path)

    def drop(self, table: DataFrame) -> None:
        """Remove a table, or all that a frame reads, if nothing reads it any more."""
        read = {f.rsplit("/", 2)[-2] for f in table.inputFiles()}
        for path in [p for p in self.paths if p.rsplit("/", 1)[1] in read]:
            self.paths.remove(path)
            remove(self.spark, path)

    def write(self, df: DataFrame, name: str, keep: bool = False, few: bool = False, codec: str | None = None) -> DataFrame:
        """``few``: in two files per core of the cluster, for tables of a few numbers a row."""
        if few:
            df = df.coalesce(2 * self.spark.sparkContext.defaultParallelism)
        path = scratch_path(self.spark, f"{self.label}-{name}")
        df.write.parquet(path, compression=codec)
        if not keep:
            self.paths.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def buckets(self, df: DataFrame, name: str, key: str) -> DataFrame:
        """A table in as many buckets by ``key`` as shuffles have partitions: joins on ``key`` shuffle the other side only."""
        n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        path = scratch_path(self.spark, f"{self.label}-{name}")
        self.paths.append(path)
        self.tables.append(path.rsplit("/", 1)[1].replace("-", "_"))
        df.repartition(n, key).write.option("path", path).bucketBy(n, key).saveAsTable(self.tables[-1], format="parquet")
        return self.spark.table(self.tables[-1])


def remove(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def fold_case(text: Column) -> Column:
    """A-Z as a-z; all other characters as they are."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def slices(batches: Iterable[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def per_slice(function: Callable[[pa.RecordBatch], pa.RecordBatch | None], rows: int = SLICE_ROWS):
    """A function for mapInArrow that sees a few rows at a time."""

    def run(batches):
        for part in slices(batches, rows):
            made = function(part)
            if made is not None and made.num_rows:
                yield made

    return run


_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the splitmix finaliser)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Hashes(dict):
    """64-bit hashes of words (bytes), remembered up to a bound."""

    def __init__(self, most: int = 800_000):
        import xxhash

        self._digest, self._most = xxhash.xxh3_64_intdigest, most

    def __missing__(self, word: bytes) -> int:
        value = self._digest(word)
        if len(self) >= self._most:
            self.clear()
        self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


