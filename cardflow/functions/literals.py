"""Short constant lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def doubles(values: Sequence[float]) -> Column:
    """A constant array, parsed in one call instead of one call per element."""
    return F.expr("array(" + ", ".join(f"{float(v)!r}D" for v in values) + ")")


def longs(values: Sequence[int]) -> Column:
    return F.expr("array(" + ", ".join(f"{int(v)}L" for v in values) + ")")


def numbered(spark: SparkSession, values: Sequence[float], name: str) -> DataFrame:
    """Rows (i, name), i counting from 1, made without a Python worker."""
    return spark.range(len(values)).select(
        (F.col("id") + 1).cast("int").alias("i"),
        F.element_at(doubles(values), (F.col("id") + 1).cast("int")).alias(name),
    )
