"""Features that need only the row itself."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardflow.functions.geo import haversine_km
from cardflow.functions.times import age_years, hour_of_day, weekday


def row_features(tx: DataFrame) -> DataFrame:
    """`tx` plus hour, weekday (Monday is 0), age and home_merchant_km."""
    ts = F.col("ts")
    return tx.withColumns(
        {
            "hour": hour_of_day(ts),
            "weekday": weekday(ts),
            "age": age_years(ts, F.col("birth_date")),
            "home_merchant_km": haversine_km(
                F.col("home_lat"), F.col("home_lon"), F.col("merch_lat"), F.col("merch_lon")
            ),
        }
    )
