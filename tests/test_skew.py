"""Hot keys and ordinary ones give the same results, also where values are missing."""

from __future__ import annotations

import random

import pytest

from cardflow.operators.audit import state_parity
from cardflow.operators.history import history_features, position_in_card
from cardflow.operators.skew import SkewPolicy, bytes_of, hot_keys, lookup
from cardflow.operators.state import card_state, recent_transactions
from tests.conftest import TX_SCHEMA, random_rows

ALL_HOT = SkewPolicy(hot_rows=0)
NO_BROADCAST = SkewPolicy(broadcast_bytes=0)
ALL_HOT_NO_BROADCAST = SkewPolicy(hot_rows=0, broadcast_bytes=0)


@pytest.fixture(scope="module")
def gaps(spark):
    """Histories in which each value is missing now and then, one card without any time, and rows
    without a card."""
    rng = random.Random(3)
    rows = []
    for r in random_rows(cards=3, rows=40, seed=5):
        rows.append(tuple(None if i and rng.random() < 0.12 else v for i, v in enumerate(r)))
    rows += [(f"n{i}", 999, None, "food", 5.0 + i, 30.0, -80.0) for i in range(4)]
    rows += [(f"m{i}", 998, 1_600_000_000 + 50 * i, "food", None, 30.0, -80.0) for i in range(4)]
    return spark.createDataFrame(rows, TX_SCHEMA).checkpoint()


def same(a, b):
    assert a.columns == b.columns
    left, right = (sorted(map(_cells, df.collect()), key=str) for df in (a, b))
    assert left == right and left


def _cells(row):
    return tuple(
        round(v, 6)
        if isinstance(v, float)
        else [tuple(_cells(x)) for x in v]
        if isinstance(v, list) and v and isinstance(v[0], tuple)
        else v
        for v in row
    )


@pytest.mark.parametrize(
    "operator", [history_features, position_in_card, card_state, recent_transactions]
)
@pytest.mark.parametrize("policy", [ALL_HOT, NO_BROADCAST, ALL_HOT_NO_BROADCAST])
def test_branches_agree(gaps, operator, policy):
    same(operator(gaps), operator(gaps, policy=policy))


def test_no_row_is_lost(gaps):
    n = gaps.count()
    for policy in (SkewPolicy(), ALL_HOT):
        assert history_features(gaps, policy=policy).count() == n
        assert position_in_card(gaps, policy=policy).count() == n


def test_rows_without_a_place(gaps):
    rows = history_features(gaps, policy=ALL_HOT).where("card_id IS NULL OR epoch_s IS NULL").collect()
    assert rows
    for r in rows:
        assert (r["cnt_10m"], r["cnt_24h"], r["is_new_category"]) == (0, 0, False)
        assert r["prior_amount"] is None and r["prev_distance_km"] is None


def test_mean_of_known_amounts(spark):
    rows = [("a", 1, 10, "x", 4.0, 1.0, 1.0), ("b", 1, 20, "x", None, 1.0, 1.0), ("c", 1, 30, "x", 8.0, 1.0, 1.0)]
    tx = spark.createDataFrame(rows, TX_SCHEMA)
    for policy in (SkewPolicy(), ALL_HOT):
        last = history_features(tx, policy=policy).where("tx_id = 'c'").first()
        assert (last["cnt_10m"], last["prior_amount"], last["amount_ratio"]) == (2, 4.0, 2.0)


def test_lookup_branches_agree(spark, gaps):
    right = spark.createDataFrame([(111, 1), (222, 2), (999, 3)], "card_id long, v int")
    same(lookup(gaps, right, "card_id"), lookup(gaps, right, "card_id", ALL_HOT))


def test_lookup_by_bytes(spark):
    """Random keys, states of uneven size, identical rows: the same with and without a broadcast."""
    rng = random.Random(6)
    left = [(rng.choice([None, 1, 1, 1, 1, 2, 3, 4, 5, 77]), rng.randrange(40), "x" * rng.randrange(3)) for _ in range(600)]
    right = [(k, ["a" * k] * k, [(1, 2.0)] * (k * 10), float(k)) for k in range(1, 60)]
    left = spark.createDataFrame(left, "key int, a int, b string").checkpoint()
    right = spark.createDataFrame(right, "key int, names array<string>, seconds array<struct<e: int, v: double>>, w double").checkpoint()
    plain = left.join(right, "key", "left")
    for policy in (SkewPolicy(hot_rows=9), SkewPolicy(hot_rows=9, broadcast_bytes=0), SkewPolicy(hot_rows=50, broadcast_bytes=100)):
        same(lookup(left, right, "key", policy), plain)
    plan = lookup(left, right, "key", SkewPolicy(hot_rows=9, broadcast_bytes=0))._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan


def test_bytes_of_a_table(spark):
    rows = [(1, "abc", [1, 2], ["x", "yz"]), (None, None, None, None)]
    size = bytes_of(spark.createDataFrame(rows, "a int, b string, c array<int>, d array<string>"))
    assert 100 < size < 400
    long = [(1, "abc" * 1000, [1, 2], ["x" * 5000, "yz"])]
    assert 8000 < bytes_of(spark.createDataFrame(long, "a int, b string, c array<int>, d array<string>")) < 8400


def test_density_makes_a_card_hot(spark):
    """19,000 transactions are below the row limit. In one day they would cost 3.6e8 steps of the range
    frames; over ten years they cost few."""
    rows = spark.range(19_000).selectExpr("1L AS card_id", "id * 4 AS epoch_s")
    sparse = spark.range(19_000).selectExpr("2L AS card_id", "id * 20000 AS epoch_s")
    hot = hot_keys([rows.unionByName(sparse)], "card_id", time="epoch_s", window=86_400)
    assert [tuple(r) for r in hot.collect()] == [(1, 19_000)]
    assert hot_keys([rows], "card_id") is None


def test_only_recent_rows_move(gaps):
    """No exchange carries the rows themselves: none has a place without its second's sums."""
    plan = recent_transactions(gaps)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "BroadcastExchange" in plan
    tree = card_state(gaps)._jdf.queryExecution().executedPlan().toString()
    lines = tree.splitlines()
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" in line:
            below = lines[i + 1]
            assert "Aggregate" in below or "Scan parquet" in below or "ColumnarToRow" in below or "Filter" in below, below
    whole = card_state(gaps, policy=NO_BROADCAST)._jdf.queryExecution().executedPlan().toString()
    assert "Window" in whole and "Window" not in tree


def test_swapped_amounts_are_different_states(spark):
    rows = [("a", 1, 10, "x", 4.0, 1.0, 1.0), ("b", 1, 20, "x", 9.0, 1.0, 1.0)]
    swapped = [("a", 1, 10, "x", 9.0, 1.0, 1.0), ("b", 1, 20, "x", 4.0, 1.0, 1.0)]
    left, right = (card_state(spark.createDataFrame(r, TX_SCHEMA)) for r in (rows, swapped))
    different = {r["column"] for r in state_parity(left, right).where("different > 0").collect()}
    assert different == {"recent_amount"}
    assert state_parity(left, left).where("different > 0").isEmpty()
