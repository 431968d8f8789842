"""Session settings the plans rely on, and the scratch folder for written intermediates."""

from __future__ import annotations

import math
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import SparkSession

# Runtime settings (changeable on a live session). None of them changes a result
# except the time zone, which fixes what "month" means.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Lets a join on (block, key) reuse the shuffle the fill already did on (block),
    # see operators/fill.py. Blocks are bounded as operators/blocks.py says, so this cannot pile rows up.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


# Shuffled bytes one task should handle.
TASK_BYTES = 200 * 1024 * 1024


def tune(spark: SparkSession, shuffle_bytes: int | None = None) -> SparkSession:
    """Apply the settings; given the size of the largest shuffle, also size its partitions.

    Adaptive execution merges partitions that turn out small but splits none apart from skewed
    joins, so the number has to be large enough for the largest shuffle.
    """
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    if shuffle_bytes is not None:
        wanted = math.ceil(shuffle_bytes / TASK_BYTES)
        current = int(spark.conf.get("spark.sql.shuffle.partitions"))
        spark.conf.set("spark.sql.shuffle.partitions", str(max(wanted, current)))
    return spark


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for an intermediate table in the shared folder of ``spark.checkpoint.dir``.

    Only a session whose executors are threads of the driver may go without that setting; it then gets
    one temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    owned = _OWNED.get()
    if not shared:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = _own_folder()
    path = f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if owned is not None:
        owned.append(path)
    return path


# Paths of the innermost open scratch_scope.
_OWNED: ContextVar[list[str] | None] = ContextVar("owned scratch", default=None)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Scratch tables made inside are removed at the end, also those that results still need when an
    operator returns. For callers that write or collect what they make before they leave."""
    paths: list[str] = []
    token = _OWNED.set(paths)
    try:
        yield
    finally:
        _OWNED.reset(token)
        for path in paths:
            discard(spark, path)


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="tidemark-")


def _on_file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def discard(spark: SparkSession, path: str) -> None:
    """Remove a scratch table that nothing reads any more."""
    target, system = _on_file_system(spark, path)
    system.delete(target, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    target, system = _on_file_system(spark, path)
    return system.exists(target)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none if it is not there."""
    target, system = _on_file_system(spark, path)
    if not system.exists(target):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(target) if status.isDirectory())
