"""Business cost of a decision rule, and thresholds chosen by it.

A flagged transaction costs a review whether it was fraud or not; a missed fraud costs its
amount; everything else is free.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardflow.functions.literals import longs, numbered
from cardflow.operators.ranks import running_totals, values_at
from cardflow.schema import REVIEW_COST

CANDIDATES = 99
# 0.01 to 0.99. i * 0.01 + 0.01 equals the evenly spaced grid bit for bit.
PROBABILITY_THRESHOLDS = [0.01 + i * 0.01 for i in range(CANDIDATES)]
NO_CANDIDATE_THRESHOLD = 0.5


def flag_at(score: str | Column, threshold: float | Column) -> Column:
    """Fraud if score >= threshold; serves the amount rule and the probability decision."""
    score = F.col(score) if isinstance(score, str) else score
    return score >= threshold


def row_cost(is_fraud: Column, flagged: Column, amount: Column, review: float) -> Column:
    return F.when(flagged, F.lit(float(review))).when(is_fraud, amount).otherwise(F.lit(0.0))


def business_cost(
    df: DataFrame, is_fraud: str, flagged: str, amount: str, review: float = REVIEW_COST
) -> DataFrame:
    """One row with the total cost."""
    cost = row_cost(
        F.col(is_fraud).cast("boolean"), F.col(flagged).cast("boolean"), F.col(amount), review
    )
    return df.agg(F.coalesce(F.sum(cost), F.lit(0.0)).alias("cost"))


def threshold_costs(
    df: DataFrame,
    score: str,
    is_fraud: str = "is_fraud",
    amount: str = "amount",
    thresholds: list[float] | None = None,
    review: float = REVIEW_COST,
) -> DataFrame:
    """Cost of flagging score >= t for every candidate t: rows (i, threshold, cost), i from 1.

    One pass: each row goes to the range between two neighbouring candidates, the ranges are
    summed before the shuffle, and a running sum over the ranges gives all costs.
    """
    given = PROBABILITY_THRESHOLDS if thresholds is None else [float(t) for t in thresholds]
    spark = df.sparkSession
    if not given:
        return spark.createDataFrame([], "i int, threshold double, cost double")
    levels = sorted(set(given))
    fraud = F.col(is_fraud).cast("boolean")
    rows = df.select(
        F.col(score).cast("double").alias("_s"),
        F.when(fraud, F.col(amount)).otherwise(0.0).alias("_missed"),
    )
    ranges = (
        Bucketizer(
            splits=[float("-inf"), *levels, float("inf")],
            inputCol="_s",
            outputCol="_k",
            handleInvalid="keep",
        )
        .transform(rows)
        .groupBy(F.col("_k").cast("int").alias("_k"))
        .agg(F.count("*").alias("_n"), F.sum("_missed").alias("_missed"))
    )
    # Bucketizer gives an unreadable score its own last range: such a row is never flagged.
    never = len(levels) + 1
    by_level = spark.range(len(levels)).select(
        (F.col("id") + 1).cast("int").alias("_k"),
        F.lit(0).cast("long").alias("_n"),
        F.lit(0.0).alias("_missed"),
    )
    summed = (
        ranges.withColumn(
            "_k", F.when(F.col("_k") == never, F.lit(0)).otherwise(F.col("_k"))
        ).withColumn("_n", F.when(F.col("_k") > 0, F.col("_n")).otherwise(0))
        .unionByName(by_level)
        .groupBy("_k")
        .agg(F.sum("_n").alias("_n"), F.sum("_missed").alias("_missed"))
    )
    order = Window.partitionBy(F.lit(0)).orderBy("_k")
    costs = summed.select(
        "_k",
        F.sum("_n").over(order.rowsBetween(0, Window.unboundedFollowing)).alias("_flagged"),
        F.coalesce(
            F.sum("_missed").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)
        ).alias("_missed"),
    )
    position = {t: k for k, t in enumerate(levels, 1)}
    asked = numbered(spark, given, "threshold").withColumn(
        "_k", F.element_at(longs([position[t] for t in given]), F.col("i")).cast("int")
    )
    return F.broadcast(asked).join(costs, "_k").select(
        "i", "threshold", (F.col("_flagged") * F.lit(float(review)) + F.col("_missed")).alias("cost")
    )


def best_threshold(costs: DataFrame) -> DataFrame:
    """The candidate of least cost, the first of equals. Without candidates: 0.5 at infinity."""
    least = costs.agg(F.min(F.struct("cost", "i", "threshold")).alias("_m"))
    return least.select(
        F.coalesce("_m.threshold", F.lit(NO_CANDIDATE_THRESHOLD)).alias("threshold"),
        F.coalesce("_m.cost", F.lit(float("inf"))).alias("cost"),
    )


def amount_rule_costs(
    df: DataFrame,
    is_fraud: str = "is_fraud",
    amount: str = "amount",
    review: float = REVIEW_COST,
) -> DataFrame:
    """Costs of the rule amount >= t for the 99 percentiles of the amount."""
    candidates = values_at(df, amount, levels=PROBABILITY_THRESHOLDS)
    return threshold_costs(df, amount, is_fraud, amount, candidates, review)


def average_precision(df: DataFrame, score: str, is_fraud: str = "is_fraud") -> DataFrame:
    """One row: the step-wise area under the precision-recall curve, without interpolation."""
    by_score = df.groupBy(F.col(score).cast("double").alias("_s")).agg(
        F.sum(F.when(F.col(is_fraud).cast("boolean"), 1).otherwise(0)).alias("tp"),
        F.count("*").alias("n"),
    )
    curve = running_totals(by_score, "_s", ["tp", "n"], descending=True)
    return curve.agg(
        F.try_divide(
            F.sum(F.col("tp") * F.col("cum_tp") / F.col("cum_n")), F.sum("tp")
        ).alias("average_precision")
    )


def champion_report(metrics: DataFrame, champion: DataFrame) -> DataFrame:
    """Best candidate against the champion.

    `metrics` has (model, test_cost), `champion` at most one row (model, test_cost); without a
    champion its cost is infinite. Promotion is only advised, and only for a strictly lower
    cost; of equal candidates the first by name is named.
    """
    best = metrics.agg(F.min(F.struct("test_cost", "model")).alias("_b")).select(
        F.lit(0).alias("_one"),
        F.col("_b.model").alias("best_model"),
        F.col("_b.test_cost").alias("best_cost"),
    )
    current = champion.agg(
        F.min(F.struct("test_cost", "model")).alias("_c")
    ).select(
        F.lit(0).alias("_one"),
        F.col("_c.model").alias("champion_model"),
        F.coalesce("_c.test_cost", F.lit(float("inf"))).alias("champion_cost"),
    )
    return best.join(current, "_one").select(
        "best_model",
        "best_cost",
        "champion_model",
        "champion_cost",
        F.coalesce(F.col("best_cost") < F.col("champion_cost"), F.lit(False)).alias("promote"),
    )
