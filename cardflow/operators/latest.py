"""Latest row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame,
    key: str = "card_id",
    ts: str = "ts",
    tie: str = "tx_id",
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """Newest row of each key with start <= ts < end; equal times go to the largest tie value.

    An aggregate, so each task sends at most one row per key.
    """
    if start is not None:
        df = df.where(F.col(ts) >= F.lit(start).cast("timestamp"))
    if end is not None:
        df = df.where(F.col(ts) < F.lit(end).cast("timestamp"))
    rest = [c for c in df.columns if c not in (key, ts, tie)]
    newest = df.groupBy(key).agg(F.max(F.struct(ts, tie, *rest)).alias("_m"))
    return newest.select(key, *[F.col("_m")[c].alias(c) for c in df.columns if c != key])
