"""Splits by time and by key."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardflow.schema import VALIDATION_START


class Splits(NamedTuple):
    train: DataFrame
    validation: DataFrame
    test: DataFrame


def time_split(history: DataFrame, test: DataFrame, start: str = VALIDATION_START) -> Splits:
    """Training rows come strictly before `start`, validation rows from it on; test is whole."""
    cut = F.lit(start).cast("timestamp")
    return Splits(history.where(F.col("ts") < cut), history.where(F.col("ts") >= cut), test)


def with_earlier_state(tx: DataFrame, state: DataFrame) -> DataFrame:
    return tx.join(state.select("card_id"), "card_id", "left_semi")


def without_earlier_state(tx: DataFrame, state: DataFrame) -> DataFrame:
    return tx.join(state.select("card_id"), "card_id", "left_anti")


def new_cards(tx: DataFrame, state: DataFrame) -> DataFrame:
    """Cards that transact but have no state. Cards are made distinct before the join."""
    return without_earlier_state(tx.select("card_id").distinct(), state)
