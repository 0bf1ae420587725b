"""Summaries of a transaction history."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardflow.functions.times import hour_of_day
from cardflow.operators.ranks import quantiles
from cardflow.operators.split import Splits


def _rate(label: str = "is_fraud"):
    return (F.avg(F.col(label).cast("int")) * 100).alias("fraud_pct")


def split_summary(splits: Splits, label: str = "is_fraud") -> DataFrame:
    """Rows and fraud rate of each split."""
    named = [
        df.select(F.lit(name).alias("split"), F.col(label)) for name, df in zip(splits._fields, splits)
    ]
    return (
        reduce(DataFrame.unionByName, named)
        .groupBy("split")
        .agg(F.count("*").alias("n"), _rate(label))
    )


def fraud_rate_by_category(tx: DataFrame) -> DataFrame:
    return tx.groupBy("category").agg(_rate()).orderBy(F.desc("fraud_pct"), "category")


def fraud_rate_by_hour(tx: DataFrame) -> DataFrame:
    return tx.groupBy(hour_of_day(F.col("ts")).alias("hour")).agg(_rate()).orderBy("hour")


def amount_histogram(
    tx: DataFrame, amount: str = "amount", label: str = "is_fraud", bins: int = 50
) -> DataFrame:
    """Rows (label, bin, n) for the bins that hold rows; each class has `bins` equal bins from
    its own minimum to its own maximum, and the maximum falls in the last one."""
    limits = tx.groupBy(label).agg(F.min(amount).alias("_low"), F.max(amount).alias("_high"))
    bounds = {r[label]: (r["_low"], r["_high"]) for r in limits.collect()}
    low = high = F.lit(None).cast("double")
    for value, (a, b) in bounds.items():
        low = F.when(F.col(label) == F.lit(value), F.lit(a)).otherwise(low)
        high = F.when(F.col(label) == F.lit(value), F.lit(b)).otherwise(high)
    share = F.coalesce(F.try_divide(F.col(amount) - low, high - low), F.lit(0.0))
    place = F.least(F.floor(share * bins), F.lit(bins - 1)).cast("int")
    return (
        tx.where(F.col(amount).isNotNull())
        .groupBy(F.col(label), place.alias("bin"))
        .agg(F.count("*").alias("n"))
    )


def transactions_per_card(tx: DataFrame) -> DataFrame:
    return tx.groupBy("card_id").agg(F.count("*").alias("n"))


def card_activity_summary(tx: DataFrame) -> DataFrame:
    """One row describing the transactions per card: count, mean, std (sample), min, quartiles
    and max."""
    per_card = transactions_per_card(tx)
    quartiles = (
        quantiles(per_card, "n", [0.25, 0.5, 0.75])
        .groupBy()
        .pivot("i", [1, 2, 3])
        .agg(F.first("value"))
        .select(
            F.lit(0).alias("_one"),
            F.col("1").alias("p25"),
            F.col("2").alias("p50"),
            F.col("3").alias("p75"),
        )
    )
    moments = per_card.agg(
        F.count("*").alias("cards"),
        F.avg("n").alias("mean"),
        F.stddev_samp("n").alias("std"),
        F.min("n").alias("min"),
        F.max("n").alias("max"),
    ).withColumn("_one", F.lit(0))
    return moments.join(quartiles, "_one").select(
        "cards", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


def card_spans(tx: DataFrame) -> DataFrame:
    """Transactions and seconds between the first and last one, per card."""
    return tx.groupBy("card_id").agg(
        F.count("*").alias("n"), (F.max("epoch_s") - F.min("epoch_s")).alias("span_s")
    )


def shortest_spans(tx: DataFrame, n: int, at_least: int = 1) -> DataFrame:
    """The n cards of shortest span among those with `at_least` transactions."""
    spans = card_spans(tx).where(F.col("n") >= at_least)
    return spans.orderBy("span_s", "card_id").limit(n)


def first_transactions(tx: DataFrame, n: int) -> DataFrame:
    """The n first transactions in the order (ts, tx_id)."""
    return tx.orderBy("ts", "tx_id").limit(n)
