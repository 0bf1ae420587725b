from __future__ import annotations

import pytest

from cardflow.operators.history import first_per_card, history_features, position_in_card
from cardflow.operators.skew import SkewPolicy, hot_keys
from cardflow.schema import HISTORY_FEATURES, WINDOWS
from tests import brute
from tests.conftest import close, make

ALL_HOT = SkewPolicy(hot_rows=0)
SOME_HOT = SkewPolicy(hot_rows=60)


def by_id(df):
    return {r["tx_id"]: r for r in df.collect()}


@pytest.mark.parametrize("policy", [SkewPolicy(), ALL_HOT])
def test_small_history(spark, policy):
    df = make(
        spark,
        ("tx_a", 111, 0, "food", 10.0, 0.0, 0.0),
        ("tx_b", 111, 300, "food", 20.0, 0.0, 1.0),
        ("tx_c", 111, 1200, "wear", 30.0, 1.0, 1.0),
        ("tx_d", 222, 100, "food", 5.0, 5.0, 5.0),
    )
    got = by_id(history_features(df, policy=policy))
    empty = (0, 0, 0, None, None, True, None, None)
    assert tuple(got["tx_a"][c] for c in HISTORY_FEATURES) == empty
    assert tuple(got["tx_d"][c] for c in HISTORY_FEATURES) == empty
    b, c = got["tx_b"], got["tx_c"]
    assert (b.cnt_10m, b.cnt_1h, b.cnt_24h, b.prior_amount, b.amount_ratio) == (1, 1, 1, 10.0, 2.0)
    assert not b.is_new_category
    assert (c.cnt_10m, c.cnt_1h, c.cnt_24h, c.prior_amount, c.amount_ratio) == (0, 2, 2, 30.0, 2.0)
    assert c.is_new_category
    assert close(c.prev_distance_km, brute.km(0, 1, 1, 1))
    assert close(c.implied_speed_kmh, brute.km(0, 1, 1, 1) * 4)


@pytest.mark.parametrize("policy", [SkewPolicy(), ALL_HOT])
def test_same_second_and_window_edges(spark, policy):
    df = make(
        spark,
        ("a", 1, 0, "x", 10.0, 0.0, 0.0),
        ("b", 1, 600, "x", 20.0, 0.0, 1.0),
        ("c", 1, 600, "y", 30.0, 0.0, 2.0),
        ("d", 1, 1201, "y", 40.0, 0.0, 2.0),
    )
    got = by_id(history_features(df, policy=policy))
    assert (got["b"].cnt_10m, got["c"].cnt_10m, got["d"].cnt_10m) == (1, 1, 0)
    assert got["c"].prior_amount == 10.0
    assert close(got["c"].prev_distance_km, brute.km(0, 1, 0, 2))
    assert got["c"].implied_speed_kmh is None
    assert got["d"].prev_distance_km == 0.0 and got["d"].implied_speed_kmh == 0.0


@pytest.mark.parametrize("policy", [SkewPolicy(), ALL_HOT])
def test_random_history_against_brute_force(tx, rows, policy):
    expected = brute.features(rows, WINDOWS.values())
    got = by_id(history_features(tx, policy=policy))
    assert len(got) == len(rows)
    for tx_id, row in expected.items():
        for name, value in zip(HISTORY_FEATURES, row):
            assert close(got[tx_id][name], value, 1e-8), (tx_id, name)


def test_one_hot_card_among_others(spark, rows):
    more = [(f"{r[0]}-x", 111, r[2] + 7, *r[3:]) for r in rows]
    df = make(spark, *rows, *more)
    assert hot_keys([df], "card_id", SOME_HOT).count() == 1
    a, b = by_id(history_features(df)), by_id(history_features(df, policy=SOME_HOT))
    assert len(a) == len(b) == len(rows) * 2
    for tx_id, row in a.items():
        for name in HISTORY_FEATURES:
            assert close(row[name], b[tx_id][name], 1e-8), (tx_id, name)


def test_hot_keys_stay_bounded(tx):
    assert hot_keys([tx], "card_id") is None
    assert hot_keys([tx], "card_id", ALL_HOT).count() == 4
    assert hot_keys([tx], "card_id", SkewPolicy(hot_rows=0, max_hot_keys=2)).count() <= 2


def test_antipodes_do_not_give_nan(spark):
    df = make(
        spark, ("a", 1, 0, "x", 1.0, 0.0, 0.0), ("b", 1, 9, "x", 1.0, 0.0, 180.0)
    )
    assert close(by_id(history_features(df))["b"].prev_distance_km, 6371.0 * 3.141592653589793)


def test_plan_has_one_exchange(tx):
    plan = history_features(tx)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("+- Sort ") + plan.count("\nSort ") == 2


def test_positions_and_first_rows(tx, rows):
    expected = {r[0]: i for h in brute.histories(rows).values() for i, r in enumerate(h)}
    for policy in (SkewPolicy(), ALL_HOT):
        got = position_in_card(tx, policy).collect()
        assert {r["tx_id"]: r["position"] for r in got} == expected
    first = {r["tx_id"] for r in first_per_card(tx, 2).collect()}
    assert first == {k for k, i in expected.items() if i < 2}
