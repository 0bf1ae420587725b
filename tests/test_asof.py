from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cardflow.operators.asof import asof_join
from cardflow.operators.latest import latest_per_key
from cardflow.operators.skew import SkewPolicy

POLICIES = [SkewPolicy(), SkewPolicy(hot_rows=0)]


def stamped(df, *names):
    return df.withColumns({n: F.timestamp_seconds(n) for n in names})


@pytest.mark.parametrize("policy", POLICIES)
def test_latest_known_row(spark, policy):
    right = stamped(
        spark.createDataFrame(
            [(111, 600, "f1", 1.0), (111, 900, "f2", 2.0)],
            "card_id long, ts long, tx_id string, v double",
        ),
        "ts",
    )
    left = stamped(
        spark.createDataFrame(
            [("a", 111, 900), ("b", 111, 899), ("c", 111, 599), ("d", 222, 900)],
            "name string, card_id long, ts long",
        ),
        "ts",
    )
    got = {r["name"]: r["v"] for r in asof_join(left, right, ["v"], policy=policy).collect()}
    assert got == {"a": 2.0, "b": 1.0, "c": None, "d": None}


@pytest.mark.parametrize("policy", POLICIES)
def test_random_against_brute_force(spark, policy):
    rng = random.Random(3)
    rights = [(rng.randrange(3), rng.randrange(400), f"{i:03d}", float(i)) for i in range(150)]
    lefts = [
        (rng.choice([0, 1, 2, 9, None]), rng.choice([None, *range(400)]), f"{i:03d}")
        for i in range(200)
    ]
    for i in range(40):
        r = rng.choice(rights)
        lefts[i] = (r[0], r[1], r[2])
    right = stamped(
        spark.createDataFrame(rights, "card_id long, ts long, tx_id string, v double"), "ts"
    )
    left = stamped(
        spark.createDataFrame(
            [(*r, i) for i, r in enumerate(lefts)],
            "card_id long, ts long, tx_id string, n int",
        ),
        "ts",
    )
    expected = {}
    for n, (card, ts, tx_id) in enumerate(lefts):
        known = [
            r for r in rights if card == r[0] and ts is not None and r[1] <= ts
        ]
        best = max(known, key=lambda r: (r[1], r[1] == ts and r[2] == tx_id, r[2]), default=None)
        expected[n] = best[3] if best else None
    got = asof_join(left, right, ["v"], policy=policy).collect()
    assert len(got) == len(lefts)
    assert {r["n"]: r["v"] for r in got} == expected


def test_one_exchange(spark):
    df = stamped(
        spark.createDataFrame([(1, 2, "a", 1.0)], "card_id long, ts long, tx_id string, v double"),
        "ts",
    )
    plan = asof_join(df, df, ["v"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1


def test_latest_per_key(spark):
    df = stamped(
        spark.createDataFrame(
            [(1, 10, "a", 1), (1, 20, "b", 2), (1, 20, "c", 3), (1, 90, "d", 4), (2, 95, "e", 5)],
            "card_id long, ts long, tx_id string, v int",
        ),
        "ts",
    )
    got = latest_per_key(df, start="1970-01-01 00:00:10", end="1970-01-01 00:01:30")
    assert [tuple(r)[2:] for r in got.select("card_id", "ts", "tx_id", "v").collect()] == [("c", 3)]


def test_blocks_of_segments(spark, monkeypatch):
    """Segments of a second in blocks of three, over stretches without any right row."""
    from cardflow.operators import asof

    monkeypatch.setattr(asof, "HOT_SEGMENT_S", 1)
    monkeypatch.setattr(asof, "BLOCK", 3)
    rng = random.Random(9)

    def frame(n, name, places):
        rows = [(rng.choice([1, 2]), dt.datetime(2024, 1, 1) + dt.timedelta(seconds=rng.choice(places)), f"{i:03d}", i) for i in range(n)]
        return spark.createDataFrame(rows, f"card_id long, ts timestamp, tx_id string, {name} int").checkpoint()

    left = frame(120, "l", range(200))
    right = frame(60, "v", [*range(10, 25), 60, 61, 150])
    ordinary, hot = (
        sorted(map(tuple, asof_join(left, right, ["v"], policy=SkewPolicy(hot_rows=h)).collect()), key=str)
        for h in (10**6, 0)
    )
    assert ordinary == hot and any(r[-1] is None for r in hot)
