from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cardflow.operators.audit import feature_parity
from cardflow.operators.history import first_per_card, history_features
from cardflow.operators.request import check_requests, request_features
from cardflow.operators.skew import SkewPolicy
from cardflow.operators.state import card_state
from tests import brute
from tests.conftest import close, make


def ask(spark, past, request, policy=SkewPolicy()):
    return request_features(make(spark, request), card_state(make(spark, *past)), policy=policy)


def test_unknown_card(spark):
    row = ask(spark, [("a", 1, 0, "x", 1.0, 0.0, 0.0)], ("r", 2, 5, "x", 9.0, 0.0, 0.0)).first()
    assert (row.status, row.has_history, row.cnt_10m, row.cnt_24h) == ("new", False, 0, 0)
    assert row.prior_amount is None and row.amount_ratio is None and row.is_new_category
    assert row.prev_distance_km is None and row.implied_speed_kmh is None


@pytest.mark.parametrize("at, ten_minutes, hour", [(1200, 0, 2), (900, 1, 2), (4000, 0, 0)])
def test_window_edges(spark, at, ten_minutes, hour):
    past = [("a", 1, 0, "x", 1.0, 0.0, 0.0), ("b", 1, 300, "x", 1.0, 0.0, 0.0)]
    row = ask(spark, past, ("r", 1, at, "x", 9.0, 0.0, 0.0)).first()
    assert (row.cnt_10m, row.cnt_1h) == (ten_minutes, hour)


def test_same_second_is_not_prior(spark):
    past = [("a", 1, 100, "x", 10.0, 0.0, 0.0), ("b", 1, 500, "x", 20.0, 0.0, 0.0)]
    row = ask(spark, past, ("r", 1, 500, "y", 40.0, 1.0, 0.0)).first()
    assert (row.cnt_10m, row.prior_amount, row.amount_ratio) == (1, 10.0, 4.0)
    assert row.is_new_category and row.implied_speed_kmh is None
    assert close(row.prev_distance_km, brute.km(0, 0, 1, 0))


def test_only_same_second_history(spark):
    row = ask(
        spark, [("a", 1, 100, "x", 10.0, 0.0, 0.0)], ("r", 1, 100, "x", 40.0, 1.0, 0.0)
    ).first()
    assert row.has_history and row.prior_amount is None and row.amount_ratio is None
    assert not row.is_new_category


def test_speed(spark):
    row = ask(
        spark, [("a", 1, 0, "x", 10.0, 0.0, 0.0)], ("r", 1, 3600, "x", 40.0, 1.0, 0.0)
    ).first()
    assert close(row.implied_speed_kmh, row.prev_distance_km)
    assert abs(row.prev_distance_km - 111.19) < 0.01


def test_conflict(spark):
    row = ask(
        spark, [("a", 1, 1000, "x", 10.0, 0.0, 0.0)], ("r", 1, 999, "x", 40.0, 1.0, 0.0)
    ).first()
    assert row.status == "conflict" and row.cnt_10m is None and row.is_new_category is None


@pytest.mark.parametrize("policy", [SkewPolicy(), SkewPolicy(hot_rows=0)])
def test_first_request_of_each_card_equals_batch(tx, rows, policy):
    cut = sorted(r[2] for r in rows)[130]
    asked = first_per_card(tx.where(F.col("epoch_s") >= cut))
    online = request_features(asked, card_state(tx.where(F.col("epoch_s") < cut)), policy=policy)
    batch = history_features(tx).join(asked.select("tx_id"), "tx_id", "left_semi")
    report = feature_parity(batch, online).collect()
    assert all(
        r["rows"] == 4 and r["different"] == r["missing_left"] == r["missing_right"] == 0
        for r in report
    )


def test_busy_cards_get_the_same_answers(spark, tx, rows):
    """Every transaction as a request, so that old ones conflict, and some of an unknown card."""
    cut = sorted(r[2] for r in rows)[130]
    state = card_state(tx.where(F.col("epoch_s") < cut)).checkpoint()
    asked = tx.unionByName(make(spark, ("new", 999, cut, "food", 1.0, 30.0, -90.0)))
    answers = [
        {r["tx_id"]: r for r in request_features(asked, state, policy=p).collect()}
        for p in (SkewPolicy(), SkewPolicy(hot_rows=0))
    ]
    assert answers[0].keys() == answers[1].keys() and len(answers[0]) == len(rows) + 1
    assert {r["status"] for r in answers[0].values()} == {"ok", "conflict", "new"}
    for tx_id, row in answers[0].items():
        for name, value in row.asDict().items():
            assert close(value, answers[1][tx_id][name]), (tx_id, name)


def test_request_checks(spark):
    good = spark.createDataFrame(
        [(1, 5.0, "x", "F", 1.0, 1.0, 1.0, 1.0, 10)],
        "card_id long, amount double, category string, gender string, home_lat double, "
        "home_lon double, merch_lat double, merch_lon double, city_pop int",
    ).withColumns(
        {"ts": F.current_timestamp(), "birth_date": F.lit("1980-01-01").cast("timestamp")}
    )
    cases = {
        None: good,
        "amount not positive": good.withColumn("amount", F.lit(-10.0)),
        "city_pop not positive": good.withColumn("city_pop", F.lit(0)),
        "missing gender": good.withColumn("gender", F.lit(None).cast("string")),
    }
    for reason, df in cases.items():
        assert check_requests(df).first()["reject_reason"] == reason
