"""Shared folders for lineage cuts, stream checkpoints and intermediate tables."""

from __future__ import annotations

import tempfile
import threading
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SHARED_DIR = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder the session names. Only a local master may fall back to a folder of its own:
    on a cluster a machine's own disk is lost with the machine."""
    named = spark.conf.get(SHARED_DIR, None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {SHARED_DIR} to a folder all executors share")
    return tempfile.mkdtemp(prefix="cardflow-")


def new_dir(spark: SparkSession, name: str) -> str:
    """A path nobody else uses."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def cut_lineage(df: DataFrame) -> DataFrame:
    """`df` written to the checkpoint folder and read back, without its history."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` as a table in the shared folder: computed once, and there when an executor is lost."""
    path = new_dir(df.sparkSession, name)
    scope = getattr(_HERE, "scope", None)
    if scope is not None:
        scope.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_HERE = threading.local()


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """What this thread has `written` in the block is deleted when it ends; for jobs that write their
    results in the block. Elsewhere results may still read such tables, so they stay."""
    outer = getattr(_HERE, "scope", None)
    _HERE.scope = []
    try:
        yield
    finally:
        for path in _HERE.scope:
            remove(spark, path)
        _HERE.scope = outer


def _file(spark: SparkSession, path: str):
    """The file system of a path, and the path."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    files, where = _file(spark, path)
    return files.exists(where)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    files, where = _file(spark, path)
    if not files.exists(where):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(where))


def touch(spark: SparkSession, path: str) -> None:
    """An empty file."""
    files, where = _file(spark, path)
    files.create(where, True).close()


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a file or folder, if it is there."""
    files, where = _file(spark, path)
    files.delete(where, True)


def move_in_order(spark: SparkSession, sources: list[str], targets: list[str]) -> None:
    """Renames files one after the other. Each gets a later time than the one before; a store that
    cannot set times gives a renamed file its own."""
    last = 0
    for source, target in zip(sources, targets):
        files, where = _file(spark, target)
        files.mkdirs(where.getParent())
        if not files.rename(_file(spark, source)[1], where):
            raise OSError(f"cannot move {source} to {target}")
        last = max(last + 1, time.time_ns() // 1_000_000)
        files.setTimes(where, last, -1)
        while time.time_ns() // 1_000_000 <= last:  # what comes next is later
            time.sleep(0.001)
