from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardflow.operators import cost, ranks
from cardflow.operators.ranks import number_values, quantiles, running_totals, values_at

SCHEMA = "is_fraud boolean, score double, amount double"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def total(rows, column, t, review=10.0):
    return sum(
        review if r[column] >= t else (r[2] if r[0] else 0.0) for r in rows
    )


def test_grid_is_the_even_grid():
    assert cost.PROBABILITY_THRESHOLDS == list(np.linspace(0.01, 0.99, 99))


def test_four_cells(spark):
    df = spark.createDataFrame(
        [(False, False, 7.0), (False, True, 7.0), (True, True, 500.0), (True, False, 90.0)],
        "is_fraud boolean, flagged boolean, amount double",
    )
    assert cost.business_cost(df, "is_fraud", "flagged", "amount").first()["cost"] == 110.0
    assert cost.business_cost(df.where("false"), "is_fraud", "flagged", "amount").first()["cost"] == 0


def test_threshold_between_groups(spark):
    best = cost.best_threshold(
        cost.threshold_costs(frame(spark, (True, 0.9, 2000.0), (False, 0.2, 5.0)), "score")
    ).first()
    assert 0.2 < best["threshold"] <= 0.9 and best["cost"] == 10.0


def test_no_fraud_flags_nothing(spark):
    best = cost.best_threshold(
        cost.threshold_costs(frame(spark, (False, 0.6, 5.0), (False, 0.7, 5.0)), "score")
    ).first()
    assert best["threshold"] > 0.7 and best["cost"] == 0.0


def test_no_candidates(spark):
    df = frame(spark, (True, 0.9, 2000.0))
    best = cost.best_threshold(cost.threshold_costs(df, "score", thresholds=[])).first()
    assert tuple(best) == (0.5, float("inf"))


def test_sweeps_against_brute_force(spark):
    rng = random.Random(1)
    rows = [
        (rng.random() < 0.2, rng.choice([rng.random(), 0.35, cost.PROBABILITY_THRESHOLDS[34]]),
         round(rng.uniform(1, 400), 2))
        for _ in range(300)
    ]
    df = frame(spark, *rows).checkpoint()
    got = {r["i"]: r for r in cost.threshold_costs(df, "score").collect()}
    assert len(got) == 99
    for i, t in enumerate(cost.PROBABILITY_THRESHOLDS, 1):
        assert got[i]["threshold"] == t and abs(got[i]["cost"] - total(rows, 1, t)) < 1e-6
    repeated = [0.5, 0.2, 0.5]
    costs = cost.threshold_costs(df, "score", thresholds=repeated).orderBy("i").collect()
    assert [r["threshold"] for r in costs] == repeated
    assert all(abs(r["cost"] - total(rows, 1, r["threshold"])) < 1e-6 for r in costs)
    levels = np.quantile([r[2] for r in rows], np.linspace(0.01, 0.99, 99))
    amounts = {r["i"]: r for r in cost.amount_rule_costs(df).collect()}
    for i, t in enumerate(levels, 1):
        assert abs(amounts[i]["threshold"] - t) < 1e-9
        assert abs(amounts[i]["cost"] - total(rows, 2, amounts[i]["threshold"])) < 1e-6


def test_amount_rule_finds_the_gap(spark):
    rng = random.Random(2)
    rows = [(False, 0.0, rng.uniform(1, 50)) for _ in range(200)]
    rows += [(True, 0.0, rng.uniform(500, 2000)) for _ in range(20)]
    best = cost.best_threshold(cost.amount_rule_costs(frame(spark, *rows))).first()
    assert max(r[2] for r in rows[:200]) < best["threshold"] <= min(r[2] for r in rows[200:])


def test_average_precision(spark):
    rows = [(True, 0.9, 1.0), (False, 0.8, 1.0), (True, 0.8, 1.0), (False, 0.1, 1.0), (True, 0.3, 1.0)]
    got = cost.average_precision(frame(spark, *rows), "score").first()[0]
    assert abs(got - (1 / 3 * 1 + 1 / 3 * 2 / 3 + 1 / 3 * 3 / 4)) < 1e-12


@pytest.mark.parametrize("per_range", [100_000, 7])
def test_quantiles_and_running_totals(spark, per_range):
    rng = random.Random(4)
    values = [rng.choice([5.0, rng.uniform(0, 100)]) for _ in range(101)]
    df = spark.createDataFrame([(v,) for v in [*values, None]], "v double").checkpoint()
    levels = [0.0, 0.01, 0.25, 0.5, 0.77, 1.0]
    got = quantiles(df, "v", levels, rows_per_range=per_range).orderBy("i").collect()
    assert np.allclose([r["value"] for r in got], np.quantile(values, levels), rtol=1e-12)
    counts = df.where("v is not null").groupBy("v").count()
    for down in (False, True):
        sums = running_totals(counts, "v", ["count"], down, per_range).collect()
        for r in sums:
            want = sum(1 for v in values if (v >= r["v"] if down else v <= r["v"]))
            assert r["cum_count"] == want


@pytest.mark.parametrize("limit, cuts", [(1, 16), (5, 64), (40, 4096)])
def test_ranks_by_counting_passes(spark, monkeypatch, limit, cuts):
    """Frequent values, tiny, huge and infinite ones; no pass may need a range longer than the limit."""
    monkeypatch.setattr(ranks, "CUTS", cuts)
    rng = random.Random(limit)
    values = [rng.choice([7.0, -0.0, 0.0, rng.gauss(0, 1), rng.gauss(0, 1) * 1e300, 5e-324]) for _ in range(400)]
    values += [float("inf")] * 9 + [float("-inf")] * 3 + [1e308] * 50
    df = spark.createDataFrame([(v,) for v in [*values, None, float("nan")]], "v double").checkpoint()
    ordered = [*sorted(values)]
    asked = [0, 2, 3, 100, 101, 257, 399, 450, len(values) - 1]
    assert values_at(df, "v", asked, rows_per_range=limit) == [ordered[r] for r in asked]
    assert np.isnan(values_at(df, "v", [len(values)], rows_per_range=limit)[0])
    assert values_at(df.where("v is null"), "v", [0]) == []
    got = quantiles(df.where("abs(v) < 100"), "v", [0.5], rows_per_range=limit).first()["value"]
    assert got == np.quantile([v for v in values if abs(v) < 100], 0.5)


def test_no_group_is_over_the_limit(spark):
    """Ranges, and the windows over their totals, with blocks of blocks of two ranges."""
    df = spark.range(300).select((F.col("id") * 7 % 300).cast("double").alias("v"), F.lit(1).alias("n"))
    cut, n = ranks.ranged(df, "v", 3)
    assert n >= 100 and cut.groupBy("_range").count().agg(F.max("count")).first()[0] <= 3
    for down in (False, True):
        got = {r["v"]: r["cum_n"] for r in running_totals(df, "v", ["n"], down, 3).collect()}
        assert got == {float(i): (300 - i if down else i + 1) for i in range(300)}


def test_numbers_of_many_texts_of_one_beginning(spark):
    n = 200_000
    words = spark.range(n).select(F.format_string("twenty bytes of text%06d", (F.col("id") * 7919) % n).alias("w"))
    out = number_values(words, "w", rows_per_range=9_000)
    wrong = out.where(F.substring("w", 21, 6).cast("int") + 1 != F.col("index"))
    assert out.count() == n and wrong.isEmpty()
    cut, _ = ranks.ranged(words, "w", 9_000)
    assert cut.groupBy("_range").count().agg(F.max("count")).first()[0] <= 9_000


@pytest.mark.parametrize("limit", [1, 3, 1000])
def test_numbered_values(spark, limit):
    words = ["b", "a", "ab", "é", "", "abc", "B", "ab"]
    df = spark.createDataFrame([(w,) for w in [*words, None]], "w string")
    got = {r["w"]: r["index"] for r in number_values(df, "w", rows_per_range=limit).collect()}
    ordered = sorted(set(words), key=lambda w: w.encode())
    assert got == {w: i for i, w in enumerate(ordered, 1)}


@pytest.mark.parametrize(
    "costs, current, best, promote",
    [
        ({"a": 5.0, "b": 3.0}, None, "b", True),
        ({"a": 5.0, "b": 3.0}, 3.0, "b", False),
        ({"a": 3.0, "b": 3.0}, 4.0, "a", True),
    ],
)
def test_champion_report(spark, costs, current, best, promote):
    schema = "model string, test_cost double"
    champion = [] if current is None else [("old", current)]
    row = cost.champion_report(
        spark.createDataFrame(list(costs.items()), schema), spark.createDataFrame(champion, schema)
    ).first()
    assert (row["best_model"], row["promote"]) == (best, promote)
    assert row["champion_cost"] == (float("inf") if current is None else current)
