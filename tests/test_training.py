from __future__ import annotations

import math
import random

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from cardflow.operators.split import Splits
from cardflow.plans import training
from cardflow.schema import CATEGORICAL_FEATURES, HISTORY_FEATURES, NUMERIC_FEATURES

SCHEMA = (
    "card_id long, amount double, hour int, weekday int, age double, home_merchant_km double, "
    "city_pop long, category string, gender string, is_fraud int"
)


def rows(n, seed):
    rng = random.Random(seed)
    for i in range(n):
        fraud = int(i % 10 == 0)
        yield (
            i,
            rng.uniform(500, 2000) if fraud else rng.uniform(1, 200),
            rng.randrange(24),
            rng.randrange(7),
            rng.uniform(18, 80),
            rng.uniform(0, 100),
            rng.randrange(100, 10**6),
            rng.choice(["food", "fuel", "toys"]),
            rng.choice("FM"),
            fraud,
        )


@pytest.fixture(scope="module")
def splits(spark):
    return Splits(
        *[spark.createDataFrame(list(rows(200, s)), SCHEMA).checkpoint() for s in (1, 2, 3)]
    )


@pytest.fixture(scope="module")
def candidates(splits):
    return training.train_candidates(splits, trees=3)


def test_model_inputs_exclude_the_card(splits):
    matrix = training.model_matrix(splits.train)
    assert matrix.columns == [*NUMERIC_FEATURES, *CATEGORICAL_FEATURES]


def test_candidates(candidates, splits):
    table = {r["model"]: r for r in training.metrics_table(candidates).collect()}
    assert set(table) == {"amount_rule", "boosting", "linear"}
    for r in table.values():
        assert r["test_cost"] >= 0 and r["validation_cost"] >= 0
    assert table["boosting"]["pr_auc"] > 0.9 and table["linear"]["pr_auc"] > 0.9
    for candidate in candidates[1:]:
        scored = training.with_probability(splits.test, candidate.model)
        assert scored.columns == [*splits.test.columns, "probability"]
        stats = scored.agg(
            F.min("probability"),
            F.max("probability"),
            F.avg(F.when(F.col("is_fraud") == 1, F.col("probability"))),
            F.avg(F.when(F.col("is_fraud") == 0, F.col("probability"))),
        ).first()
        assert 0 <= stats[0] <= stats[1] <= 1 and stats[2] > stats[3]
        unseen = splits.test.withColumn("category", F.lit("never seen"))
        assert training.with_probability(unseen, candidate.model).count() == 200


def test_fits_read_evenly_dealt_rows(spark, splits, monkeypatch):
    """Whatever the splits of the file were: here one of two tasks would hold all rows."""
    uneven = Splits(*[s.coalesce(1).union(s.limit(0)) for s in splits])
    monkeypatch.setattr(training, "ROWS_PER_TASK", 60)
    seen = []

    def fit(train, *args, fit=training.fit_linear):
        seen.append([r["count"] for r in train.groupBy(F.spark_partition_id()).count().collect()])
        return fit(train, *args)

    monkeypatch.setattr(training, "fit_linear", fit)
    monkeypatch.setattr(training, "linear_steps", lambda train: iter(()))
    training.train_candidates(uneven, trees=1)
    cores = spark.sparkContext.defaultParallelism
    assert all(len(sizes) == 4 and len(sizes) % cores == 0 and max(sizes) <= 55 and sum(sizes) == 200 for sizes in seen)
    assert len(seen) == len(training.REGULARIZATION)


def test_saved_model_scores_requests(spark, candidates, splits, tmp_path):
    path = str(tmp_path / "model")
    candidates[2].model.write().overwrite().save(path)
    model = PipelineModel.load(path)
    requests = splits.test.withColumns(
        {
            "status": F.when(F.col("card_id") == 5, "conflict").otherwise("ok"),
            "has_history": F.lit(True),
            **{c: F.lit(None).cast("double") for c in HISTORY_FEATURES},
        }
    )
    out = training.score_requests(requests, model, 0.5, "v1").orderBy("card_id").collect()
    assert out[5]["probability"] is None and out[5]["decision"] is None
    assert all(r["decision"] == (r["probability"] >= 0.5) for r in out if r["card_id"] != 5)
    assert out[0]["history"].asDict().keys() == set(HISTORY_FEATURES)
    assert (out[0]["threshold"], out[0]["model_version"]) == (0.5, "v1")


def test_choice_between_passes_of_one_fit(splits):
    steps = list(training.linear_steps(splits.train, steps=8))
    choice = training.choose_by_cost(iter(steps), splits.validation)
    assert [c[0] for c in choice.costs] == list(range(1, 9))
    least = min(c[2] for c in choice.costs)
    assert choice.step == next(s for s, _, cost in choice.costs if cost == least)
    assert choice.model is steps[choice.step - 1]
    assert [r["chosen"] for r in choice.table(splits.train).collect()].count(True) == 1
    # Passes go on from each other, down the weighted loss; one pass again is the first of them.
    def loss(model):
        rows = training.with_probability(splits.train, model).select("is_fraud", "probability").collect()
        return sum(-9 * math.log(p) if y else -math.log(1 - p) for y, p in rows)

    assert loss(steps[0]) > loss(steps[3]) > loss(steps[7])
    once = next(training.linear_steps(splits.train, steps=1))
    assert once.stages[0].getStatement() == steps[0].stages[0].getStatement()
    equal = training.choose_by_cost([steps[0], steps[0]], splits.validation)
    assert equal.step == 1
    with pytest.raises(ValueError):
        training.choose_by_cost([], splits.validation)


def test_formula_model_is_saved(spark, splits, tmp_path):
    model = training.formula_model(-1.0, {"amount": 0.002, "cast(category = 'it\\'s' AS double)": 3.0})
    model.write().overwrite().save(str(tmp_path / "m"))
    again = training.with_probability(splits.test, PipelineModel.load(str(tmp_path / "m")))
    for r in again.limit(5).collect():
        assert abs(r["probability"] - 1 / (1 + math.exp(1.0 - 0.002 * r["amount"]))) < 1e-12
    odd = splits.train.withColumn("category", F.when(F.col("card_id") % 3 == 0, "it's \\ odd").when(F.col("card_id") % 3 == 1, "x"))
    model = next(training.linear_steps(odd, steps=1))
    assert training.with_probability(odd, model).where("probability between 0 and 1").count() == 200
