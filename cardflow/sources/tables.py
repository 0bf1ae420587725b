"""Parquet tables of features and states."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cardflow.functions.times import from_epoch
from cardflow.operators.latest import latest_per_key
from cardflow.schema import FEATURE_TABLE_COLUMNS, STATE_COLUMNS


def write_features(features: DataFrame, path: str, columns: list[str] = FEATURE_TABLE_COLUMNS) -> None:
    """Overwrites the feature table: card, id, time and the eight features."""
    features.select(*columns).write.mode("overwrite").parquet(path)


def read_features(spark: SparkSession, path: str, time_column: str = "ts") -> DataFrame:
    """Feature table; fails at once if it lacks its time column."""
    df = spark.read.parquet(path)
    if time_column not in df.columns:
        raise ValueError(f"{path} has no column {time_column}")
    return df


def write_state_snapshot(state: DataFrame, path: str, files: int | None = None) -> None:
    """Overwrites a snapshot of the states with their time column `last_ts`. `files=1` suits a
    few thousand cards; without it Spark keeps its own partitioning."""
    from pyspark.sql import functions as F

    out = state.withColumn("last_ts", from_epoch(F.col("last_epoch")))
    (out.coalesce(files) if files else out).write.mode("overwrite").parquet(path)


def read_state_snapshot(
    spark: SparkSession, path: str, start: str = "2000-01-01", end: str | None = None
) -> DataFrame:
    """Newest state of each card within start <= last_ts < end."""
    latest = latest_per_key(
        spark.read.parquet(path), "card_id", "last_ts", "last_tx_id", start, end
    )
    return latest.select(*STATE_COLUMNS)
