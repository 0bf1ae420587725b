"""The given tables as transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardflow.functions.times import epoch_seconds

DAY = 86400
ORDER_WINDOWS = {"cnt_7d": 7 * DAY, "cnt_30d": 30 * DAY, "cnt_90d": 90 * DAY}
ORDER_RETENTION = 90 * DAY


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _place(seed: str, factor: int) -> list:
    return [
        (F.lit(25) + F.col(seed) % 24).cast("double"),
        (F.lit(-120) + (F.col(seed) * factor) % 46).cast("double"),
    ]


def _holder(key: str) -> list:
    home = _place(key, 11)
    return [
        home[0].alias("home_lat"),
        home[1].alias("home_lon"),
        F.date_add(F.lit("1950-01-01").cast("date"), ((F.col(key) * 97) % 18000).cast("int")).alias(
            "birth_date"
        ),
        F.when(F.col(key) % 2 == 0, "F").otherwise("M").alias("gender"),
        (F.lit(1000) + (F.col(key) * 37) % 100000).alias("city_pop"),
    ]


def _text_id(name: str):
    return F.lpad(F.col(name).cast("string"), 12, "0").alias("tx_id")


def tx_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "events").withColumn(
        "k", F.get_json_object("props", "$.k").cast("long")
    )
    place = _place("k", 7)
    return df.select(
        F.col("user_id").alias("card_id"),
        _text_id("event_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        epoch_seconds(F.col("ts")).alias("epoch_s"),
        F.col("value").alias("amount"),
        F.col("event_type").alias("category"),
        F.concat(F.lit("m"), F.col("k").cast("string")).alias("merchant"),
        place[0].alias("merch_lat"),
        place[1].alias("merch_lon"),
        *_holder("user_id"),
        ((F.col("event_type") == "error") & (F.col("value") > 100)).alias("is_fraud"),
        (F.col("value") / (F.col("value") + 100.0)).alias("score"),
    )


def tx_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "orders")
    place = _place("o_orderkey", 7)
    return df.select(
        F.col("o_custkey").alias("card_id"),
        _text_id("o_orderkey"),
        F.col("o_orderdate").cast("timestamp").alias("ts"),
        epoch_seconds(F.col("o_orderdate")).alias("epoch_s"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderpriority").alias("category"),
        place[0].alias("merch_lat"),
        place[1].alias("merch_lon"),
        (F.col("o_orderstatus") == "F").alias("is_fraud"),
        (F.col("o_totalprice") / (F.col("o_totalprice") + 100000.0)).alias("score"),
    )
