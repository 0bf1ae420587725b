"""Fitted preprocessing: standardization, category numbers, class weights."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardflow.operators.ranks import number_values

UNKNOWN_INDEX = 0


def fit_standardizer(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: mean_<c> and std_<c> (population); a zero deviation becomes 1."""
    return df.agg(
        *[F.avg(c).alias(f"mean_{c}") for c in columns],
        *[
            F.when(F.stddev_pop(c) == 0, F.lit(1.0)).otherwise(F.stddev_pop(c)).alias(f"std_{c}")
            for c in columns
        ],
    )


def standardize(df: DataFrame, fitted: DataFrame, columns: list[str]) -> DataFrame:
    """`df` plus z_<c>. `fitted` is the single row of `fit_standardizer`."""
    row = fitted.first()
    return df.withColumns(
        {
            f"z_{c}": (F.col(c) - F.lit(row[f"mean_{c}"])) / F.lit(row[f"std_{c}"])
            for c in columns
        }
    )


def fit_vocabulary(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of `column`, sorted and numbered from 1; 0 is left for unknown ones."""
    return number_values(df, column, f"{column}_index")


def vocabulary_sizes(vocabularies: dict[str, DataFrame]) -> dict[str, int]:
    """Entries per column, with one more for unknown values."""
    return {column: vocabulary.count() + 1 for column, vocabulary in vocabularies.items()}


def index_values(df: DataFrame, vocabulary: DataFrame, column: str) -> DataFrame:
    """`df` plus <column>_index, 0 where the value is not in the vocabulary.

    The join carries no hint: Spark broadcasts a vocabulary that is small at run time and
    shuffles otherwise, splitting a value that holds too many rows.
    """
    index = f"{column}_index"
    return df.join(vocabulary, column, "left").withColumn(
        index, F.coalesce(index, F.lit(UNKNOWN_INDEX))
    )


def class_weights(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    """Rows (label, n, weight, positive_ratio): weight is n_all / (classes * n), and
    positive_ratio is negatives / max(positives, 1)."""
    counts = df.groupBy(F.col(label).cast("int").alias("label")).agg(F.count("*").alias("n"))
    whole = counts.agg(
        F.sum("n").alias("_all"),
        F.count("*").alias("_classes"),
        F.coalesce(F.sum(F.when(F.col("label") == 1, F.col("n"))), F.lit(0)).alias("_pos"),
    )
    # Both sides come from the class counts: two rows and one row.
    return counts.withColumn("_one", F.lit(0)).join(
        whole.withColumn("_one", F.lit(0)), "_one"
    ).select(
        "label",
        "n",
        (F.col("_all") / (F.col("_classes") * F.col("n"))).alias("weight"),
        ((F.col("_all") - F.col("_pos")) / F.greatest(F.col("_pos"), F.lit(1))).alias(
            "positive_ratio"
        ),
    )


def with_class_weight(df: DataFrame, label: str = "is_fraud", name: str = "weight") -> DataFrame:
    """`df` plus the balanced weight of each row's class."""
    weights = {r["label"]: r["weight"] for r in class_weights(df, label).collect()}
    column = F.lit(None).cast("double")
    for value, weight in weights.items():
        column = F.when(F.col(label).cast("int") == value, F.lit(weight)).otherwise(column)
    return df.withColumn(name, column)
