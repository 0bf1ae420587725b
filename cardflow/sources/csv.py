"""Raw card CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardflow.functions.times import epoch_seconds, utc_timestamp
from cardflow.schema import (
    DATE_FORMAT,
    EVENT_COLUMNS,
    RAW_COLUMNS,
    RAW_TYPES,
    TIMESTAMP_FORMAT,
)


def _by_name(spark: SparkSession, path: str) -> DataFrame:
    """The file's columns as text, found by the names in its header."""
    rows = spark.read.csv(path, header=True, inferSchema=False, enforceSchema=False)
    missing = [name for name in RAW_COLUMNS if name not in rows.columns]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    return rows.select(*RAW_COLUMNS).withColumnsRenamed(RAW_COLUMNS)


def read_raw(spark: SparkSession, paths: list[str]) -> DataFrame:
    """All files as one table of 22 typed columns under their names here.

    Columns are found by the header of each path, in any order; a missing one is an error, and so
    are files under one path whose headers differ. Everything is read as text, so no file is
    scanned to guess types, and other columns are never parsed. Times are UTC in any session zone.
    """
    if not paths:
        raise ValueError("no files")
    text = concat_histories([_by_name(spark, path) for path in paths])

    def typed(name: str):
        if name == "ts":
            return utc_timestamp(F.col(name), TIMESTAMP_FORMAT)
        if name == "birth_date":
            return F.try_to_timestamp(name, F.lit(DATE_FORMAT)).cast("date")
        return F.col(name).cast(RAW_TYPES.get(name, "string"))

    return text.select(*[typed(name).alias(name) for name in RAW_COLUMNS.values()])


def read_transactions(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The columns the card history needs, with ts and epoch_s. The reader parses only these."""
    return with_epoch(read_raw(spark, paths)).select(*EVENT_COLUMNS, "ts")


def with_epoch(tx: DataFrame) -> DataFrame:
    return tx.withColumn("epoch_s", epoch_seconds(F.col("ts")))


def concat_histories(frames: list[DataFrame]) -> DataFrame:
    """Several histories as one."""
    first, *rest = frames
    for df in rest:
        first = first.unionByName(df)
    return first
