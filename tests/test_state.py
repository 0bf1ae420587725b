from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cardflow.operators.audit import all_agree, feature_parity, state_parity
from cardflow.operators.history import history_features
from cardflow.operators.skew import SkewPolicy
from cardflow.operators.state import (
    card_state,
    fold,
    fresh_rows,
    recent_arrays,
    recent_transactions,
    replace_states,
)
from cardflow.plans.workspace import cut_lineage
from cardflow.schema import RETENTION, WINDOWS
from cardflow.streaming.job import stream_features
from tests import brute
from tests.conftest import close, make

POLICIES = [SkewPolicy(), SkewPolicy(hot_rows=0), SkewPolicy(hot_rows=0, broadcast_bytes=0)]


def as_brute(df):
    return {
        r["card_id"]: (
            r["n_total"],
            r["amount_total"],
            r["categories_seen"],
            {s["epoch_s"]: (s["n"], s["amount"]) for s in r["recent"]},
            r["last_epoch"],
            r["last_tx_id"],
            r["last_lat"],
            r["last_lon"],
        )
        for r in df.collect()
    }


def assert_states(df, expected):
    got = as_brute(df)
    assert got.keys() == expected.keys()
    for card, want in expected.items():
        have = got[card]
        assert have[0] == want[0] and have[2] == want[2] and have[4:] == want[4:]
        assert close(have[1], want[1])
        assert have[3].keys() == want[3].keys()
        for second, (n, amount) in want[3].items():
            assert have[3][second][0] == n and close(have[3][second][1], amount, 1e-8)


@pytest.mark.parametrize("policy", POLICIES)
def test_state_against_brute_force(tx, rows, policy):
    assert_states(card_state(tx, policy=policy), brute.states(rows, RETENTION))


@pytest.mark.parametrize("policy", POLICIES)
def test_recent_transactions(tx, rows, policy):
    last = {c: h[-1][2] for c, h in brute.histories(rows).items()}
    expected = {r[0] for r in rows if r[2] >= last[r[1]] - RETENTION}
    assert {r["tx_id"] for r in recent_transactions(tx, policy=policy).collect()} == expected


def test_retention_and_totals(spark):
    df = make(spark, ("a", 1, 0, "x", 10.0, 0.0, 0.0), ("b", 1, 86401, "x", 30.0, 1.0, 1.0))
    row = recent_arrays(card_state(df)).first()
    assert (row.n_total, row.amount_total, row.recent_epochs) == (2, 40.0, [86401])
    assert (row.recent_counts, row.recent_amounts) == ([1], [30.0])


@pytest.mark.parametrize("policy", POLICIES)
def test_fold_in_waves_with_replays(spark, tx, rows, policy):
    ordered = sorted(r[2] for r in rows)
    cut = ordered[len(ordered) // 2]
    first = cut_lineage(card_state(tx.where(F.col("epoch_s") < cut), policy=policy))
    second = tx.where(F.col("epoch_s") >= cut)
    whole = cut_lineage(replace_states(first, fold(first, second, policy=policy)))
    assert_states(whole, brute.states(rows, RETENTION))
    assert fresh_rows(second, whole, policy).isEmpty()
    assert fold(whole, tx).isEmpty()


def test_tie_split_across_batches_and_duplicates(spark):
    a = make(spark, ("a", 1, 50, "x", 10.0, 0.0, 0.0))
    b = make(
        spark,
        ("c", 1, 50, "y", 5.0, 2.0, 2.0),
        ("b", 1, 50, "y", 7.0, 1.0, 1.0),
        ("c", 1, 50, "y", 5.0, 2.0, 2.0),
        ("z", 1, 49, "q", 9.0, 1.0, 1.0),
    )
    row = recent_arrays(fold(card_state(a), b)).first()
    assert (row.n_total, row.amount_total, row.categories_seen) == (3, 22.0, ["x", "y"])
    assert (row.recent_epochs, row.recent_counts, row.recent_amounts) == ([50], [3], [22.0])
    assert row.last_tx_id == "c"


def test_fold_of_new_card_and_untouched_card(spark):
    old = card_state(make(spark, ("a", 1, 50, "x", 10.0, 0.0, 0.0)))
    changed = fold(old, make(spark, ("b", 2, 60, "x", 1.0, 0.0, 0.0)))
    assert [r["card_id"] for r in changed.collect()] == [2]


@pytest.mark.parametrize("policy", POLICIES)
def test_stream_features_equal_batch_features(tx, rows, policy):
    cut = sorted(r[2] for r in rows)[130]
    first = tx.where(F.col("epoch_s") < cut)
    state = cut_lineage(card_state(first))
    fresh = cut_lineage(fresh_rows(tx.where(F.col("epoch_s") >= cut), state))
    online = stream_features(fresh, state, policy=policy)
    report = feature_parity(
        history_features(tx), history_features(first).unionByName(online)
    ).collect()
    assert all(r["different"] == r["missing_left"] == r["missing_right"] == 0 for r in report)
    assert all(r["rows"] == len(rows) for r in report)


def test_audit_notices_a_wrong_window(tx, rows):
    cut = sorted(r[2] for r in rows)[130]
    first = tx.where(F.col("epoch_s") < cut)
    state = cut_lineage(card_state(first))
    fresh = cut_lineage(fresh_rows(tx.where(F.col("epoch_s") >= cut), state))
    wrong = {**WINDOWS, "cnt_1h": 7200}
    online = stream_features(fresh, state, wrong)
    report = {
        r["column"]: r["different"]
        for r in feature_parity(
            history_features(tx), history_features(first).unionByName(online)
        ).collect()
    }
    assert report.pop("cnt_1h") > 0
    assert not any(report.values())


def test_state_audit(spark, tx):
    state = cut_lineage(card_state(tx))
    same = state_parity(state, state).collect()
    assert not any(r["different"] + r["missing_left"] + r["missing_right"] for r in same)
    # Every card has as many rows and the same categories, which proves nothing there.
    varies = {r["column"]: r["varies"] for r in same}
    assert varies["last_epoch"] and not varies["n_total"]
    assert not all_agree(state_parity(state, state)).first()["agree"]
    off = state.withColumn("n_total", F.col("n_total") + 1)
    report = {r["column"]: r for r in state_parity(state, off).collect()}
    assert report["n_total"]["different"] == 4 and report["last_epoch"]["different"] == 0
    missing = state_parity(state, state.where("card_id <> 111")).first()
    assert (missing["missing_left"], missing["missing_right"]) == (0, 1)
