from __future__ import annotations

import random
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TX_SCHEMA = (
    "tx_id string, card_id long, epoch_s long, category string, amount double, "
    "merch_lat double, merch_lon double"
)


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    session = (
        SparkSession.builder.master("local[2]")
        .appName("cardflow-tests")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.default.parallelism", "2")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def random_rows(cards: int = 4, rows: int = 60, seed: int = 7) -> list[tuple]:
    """Histories with same-second ties, short gaps and gaps over a day."""
    rng = random.Random(seed)
    gaps = [0, 0, 1, 90, 400, 3000, 20000, 90000]
    weights = [0.15, 0.10, 0.10, 0.20, 0.20, 0.10, 0.10, 0.05]
    out = []
    for card in range(111, 111 * (cards + 1), 111):
        now = 1_600_000_000
        for i in range(rows):
            now += rng.choices(gaps, weights)[0]
            out.append(
                (
                    f"{card}-{rng.randrange(10**6):06d}-{i:03d}",
                    card,
                    now,
                    rng.choice(["food", "fuel", "home", "toys", "travel"]),
                    round(rng.uniform(1, 500), 2),
                    round(rng.uniform(25, 48), 4),
                    round(rng.uniform(-120, -75), 4),
                )
            )
    return out


@pytest.fixture(scope="session")
def rows() -> list[tuple]:
    return random_rows()


@pytest.fixture(scope="session")
def tx(spark, rows):
    return spark.createDataFrame(rows, TX_SCHEMA).checkpoint()


def make(spark, *values):
    return spark.createDataFrame(list(values), TX_SCHEMA)


def close(a, b, rel=1e-9):
    if a is None or b is None:
        return a is None and b is None
    if isinstance(a, float) or isinstance(b, float):
        return abs(a - b) <= rel * max(abs(a), abs(b), 1e-300) or a == b
    return a == b
