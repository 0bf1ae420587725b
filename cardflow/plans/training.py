"""Fits candidates, sets their thresholds by business cost and compares them with the champion.

Time splits only; classes are weighted, never resampled; nothing is promoted automatically.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from itertools import chain

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import (
    Interaction,
    OneHotEncoder,
    SQLTransformer,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardflow.operators.cost import (
    amount_rule_costs,
    average_precision,
    best_threshold,
    business_cost,
    flag_at,
    threshold_costs,
)
from cardflow.operators.prepare import fit_standardizer, with_class_weight
from cardflow.operators.split import Splits
from cardflow.plans.workspace import ensure_checkpoint_dir
from cardflow.schema import (
    CATEGORICAL_FEATURES,
    HISTORY_FEATURES,
    NUMERIC_FEATURES,
    REVIEW_COST,
)

METRICS_SCHEMA = (
    "model string, threshold double, validation_cost double, test_cost double, pr_auc double"
)
TREES = 200
STEPS = 20
REGULARIZATION = (0.0, 0.001, 0.01)
#: Rows that a task of a fit holds, about, at most.
ROWS_PER_TASK = 1_000_000


def model_matrix(tx: DataFrame) -> DataFrame:
    """The model inputs, and only them."""
    return tx.select(
        *[F.col(c).cast("double").alias(c) for c in NUMERIC_FEATURES], *CATEGORICAL_FEATURES
    )


def _inputs(tx: DataFrame, weighted: bool) -> DataFrame:
    kept = [F.col(c).cast("double").alias(c) for c in NUMERIC_FEATURES]
    rows = tx.select(*kept, *CATEGORICAL_FEATURES, F.col("is_fraud").cast("int").alias("is_fraud"))
    return with_class_weight(rows) if weighted else rows


def spread(df: DataFrame) -> DataFrame:
    """`df` dealt out evenly, to a multiple of the tasks that run at a time. Fits pass over their rows very
    often, a pass takes as long as its longest task, and the splits of a file can be few and uneven."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores * max(1, math.ceil(df.count() / (cores * ROWS_PER_TASK))))


@contextmanager
def kept(splits: Splits) -> Iterator[Splits]:
    """What fits and metrics read of the splits, spread and kept while the block lasts."""
    columns = [*NUMERIC_FEATURES, *CATEGORICAL_FEATURES, "is_fraud"]
    held = Splits(*[spread(s.select(*columns)).persist() for s in splits])
    try:
        yield held
    finally:
        for s in held:
            s.unpersist()


def _indexer() -> StringIndexer:
    return StringIndexer(
        inputCols=CATEGORICAL_FEATURES,
        outputCols=[f"{c}_code" for c in CATEGORICAL_FEATURES],
        handleInvalid="keep",
        stringOrderType="alphabetAsc",
    )


def fit_boosting(train: DataFrame, trees: int = TREES, seed: int = 0) -> PipelineModel:
    """Class-weighted boosted trees on numeric and categorical inputs; a category not seen in
    training is a value of its own."""
    ensure_checkpoint_dir(train.sparkSession)
    rows = _inputs(train, weighted=True)
    sizes = rows.agg(*[F.countDistinct(c) for c in CATEGORICAL_FEATURES]).first()
    trees_stage = GBTClassifier(
        labelCol="is_fraud",
        weightCol="weight",
        featuresCol="inputs",
        maxIter=trees,
        maxBins=max(32, *(n + 1 for n in sizes)),
        seed=seed,
    )
    assembler = VectorAssembler(
        inputCols=[*NUMERIC_FEATURES, *[f"{c}_code" for c in CATEGORICAL_FEATURES]],
        outputCol="inputs",
    )
    return Pipeline(stages=[_indexer(), assembler, trees_stage]).fit(rows)


def fit_linear(train: DataFrame, regularization: float = 0.0) -> PipelineModel:
    """Class-weighted logistic regression on standardized numbers, categories and their
    crosses."""
    codes = [f"{c}_code" for c in CATEGORICAL_FEATURES]
    hot = [f"{c}_hot" for c in CATEGORICAL_FEATURES]
    stages = [
        _indexer(),
        OneHotEncoder(inputCols=codes, outputCols=hot, handleInvalid="keep", dropLast=False),
        Interaction(inputCols=hot, outputCol="crossed"),
        VectorAssembler(inputCols=NUMERIC_FEATURES, outputCol="numbers"),
        StandardScaler(inputCol="numbers", outputCol="scaled", withMean=True),
        VectorAssembler(inputCols=["scaled", *hot, "crossed"], outputCol="inputs"),
        LogisticRegression(
            labelCol="is_fraud",
            weightCol="weight",
            featuresCol="inputs",
            regParam=regularization,
            maxIter=50,
        ),
    ]
    return Pipeline(stages=stages).fit(_inputs(train, weighted=True))


def with_probability(tx: DataFrame, model: PipelineModel) -> DataFrame:
    """`tx` plus `probability` of fraud, the same for every kind of model."""
    row = tx.withColumn("_row", F.struct(*tx.columns)).withColumns(
        {c: F.col(c).cast("double") for c in NUMERIC_FEATURES}
    )
    scored = model.transform(row)
    both = F.col("probability")
    if isinstance(scored.schema["probability"].dataType, VectorUDT):
        both = vector_to_array("probability")
    return scored.select("_row.*", both[1].alias("probability"))


def formula_model(bias: float, weights: dict[str, float]) -> PipelineModel:
    """Logistic model with given weights of SQL expressions over the model inputs. It is saved and
    loaded like any other."""
    terms = [f"{float(bias)!r}D", *[f"{float(w)!r}D * ({x})" for x, w in weights.items()]]
    statement = (
        "SELECT *, array(1 - _p, _p) AS probability FROM "
        f"(SELECT *, 1 / (1 + exp(-({' + '.join(terms)}))) AS _p FROM __THIS__)"
    )
    return PipelineModel([SQLTransformer(statement=statement)])


@dataclass(frozen=True)
class Choice:
    """The chosen model, its step (from 1), and the best threshold and cost of every step."""

    model: PipelineModel
    step: int
    costs: list[tuple[int, float, float]]

    def table(self, df: DataFrame) -> DataFrame:
        """Rows (step, threshold, cost, chosen)."""
        rows = [(*c, c[0] == self.step) for c in self.costs]
        return df.sparkSession.createDataFrame(
            rows, "step int, threshold double, cost double, chosen boolean"
        )


def choose_by_cost(
    models: Iterable[PipelineModel], validation: DataFrame, review: float = REVIEW_COST
) -> Choice:
    """The model whose best threshold costs least on the validation rows; a later one must be
    strictly better. `models` may be fits of one model, each going on from the one before: they are
    taken one at a time."""
    best, chosen, costs = None, 0, []
    for step, model in enumerate(models, 1):
        scored = with_probability(validation, model).select("is_fraud", "amount", "probability")
        found = best_threshold(threshold_costs(scored, "probability", review=review)).first()
        if best is None or found["cost"] < costs[chosen - 1][2]:
            best, chosen = model, step
        costs.append((step, found["threshold"], found["cost"]))
    if best is None:
        raise ValueError("no model to choose from")
    return Choice(best, chosen, costs)


def linear_steps(train: DataFrame, steps: int = STEPS, rate: float = 0.2) -> Iterator[PipelineModel]:
    """Class-weighted logistic model after each of `steps` passes over the rows. A pass sums the
    gradient over all rows, one number per input; the next starts from the weights it gave, moved
    by running means of the gradient and of its square."""
    names = {c: [r[0] for r in train.select(c).distinct().orderBy(c).collect()] for c in CATEGORICAL_FEATURES}
    fitted = fit_standardizer(train.select(*[F.col(c).cast("double").alias(c) for c in NUMERIC_FEATURES]), NUMERIC_FEATURES).first()
    inputs = [f"(cast({c} AS double) - {fitted[f'mean_{c}']!r}D) / {fitted[f'std_{c}']!r}D" for c in NUMERIC_FEATURES]
    inputs += [f"coalesce(cast({c} = {_quoted(v)} AS double), 0D)" for c, values in names.items() for v in values if v is not None]
    rows = _inputs(train, weighted=True).select(
        *[F.expr(x).alias(f"x{j}") for j, x in enumerate(inputs)],
        F.col("is_fraud").cast("double").alias("y"),
        "weight",
    )
    rows = rows.persist()
    try:
        total = rows.agg(F.sum("weight")).first()[0] or 1.0
        w = [0.0] * (len(inputs) + 1)
        mean, square = list(w), list(w)
        for step in range(1, steps + 1):
            terms = [f"{w[-1]!r}D", *[f"{v!r}D * x{j}" for j, v in enumerate(w[:-1])]]
            off = F.expr(f"weight * (1 / (1 + exp(-({' + '.join(terms)}))) - y)")
            moved = rows.withColumn("_off", off)
            sums = moved.agg(*[F.sum(F.col("_off") * F.col(f"x{j}")) for j in range(len(inputs))], F.sum("_off")).first()
            for j, g in enumerate(sums):
                g = (g or 0.0) / total
                mean[j] = 0.9 * mean[j] + 0.1 * g
                square[j] = 0.99 * square[j] + 0.01 * g * g
                up = mean[j] / (1 - 0.9**step)
                w[j] -= rate * up / (math.sqrt(square[j] / (1 - 0.99**step)) + 1e-8)
            yield formula_model(w[-1], dict(zip(inputs, w[:-1])))
    finally:
        rows.unpersist()


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def choose_linear(
    train: DataFrame,
    validation: DataFrame,
    regularizations: tuple[float, ...] = REGULARIZATION,
    review: float = REVIEW_COST,
) -> PipelineModel:
    """The fit of least validation cost, of all regularizations and all numbers of passes; a later one
    must be strictly better."""
    fits = (fit_linear(train, value) for value in regularizations)
    return choose_by_cost(chain(fits, linear_steps(train)), validation, review).model


@dataclass(frozen=True)
class Candidate:
    name: str
    model: PipelineModel | None
    threshold: float
    metrics: DataFrame


def run_candidate(
    name: str, model: PipelineModel, splits: Splits, review: float = REVIEW_COST
) -> Candidate:
    """Threshold from the validation split, cost and average precision on the test split."""
    spark = splits.test.sparkSession
    wanted = ["is_fraud", "amount", "probability"]
    validation = with_probability(splits.validation, model).select(*wanted)
    best = best_threshold(threshold_costs(validation, "probability", review=review)).first()
    test = with_probability(splits.test, model).select(*wanted).persist()
    try:
        flagged = test.withColumn("flagged", flag_at("probability", best["threshold"]))
        cost = business_cost(flagged, "is_fraud", "flagged", "amount", review).first()["cost"]
        precision = average_precision(test, "probability").first()["average_precision"]
    finally:
        test.unpersist()
    row = (name, best["threshold"], best["cost"], cost, precision)
    return Candidate(
        name, model, best["threshold"], spark.createDataFrame([row], METRICS_SCHEMA)
    )


def run_amount_rule(splits: Splits, review: float = REVIEW_COST) -> Candidate:
    """The rule every model has to beat: flag large amounts."""
    best = best_threshold(amount_rule_costs(splits.validation, review=review)).first()
    flagged = splits.test.withColumn("flagged", flag_at("amount", best["threshold"]))
    cost = business_cost(flagged, "is_fraud", "flagged", "amount", review).first()["cost"]
    row = ("amount_rule", best["threshold"], best["cost"], cost, None)
    metrics = splits.test.sparkSession.createDataFrame([row], METRICS_SCHEMA)
    return Candidate("amount_rule", None, best["threshold"], metrics)


def train_candidates(
    splits: Splits, trees: int = TREES, review: float = REVIEW_COST
) -> list[Candidate]:
    """Rule, boosted trees and linear model."""
    with kept(splits) as held:
        boosting = run_candidate("boosting", fit_boosting(held.train, trees), held, review)
        linear = run_candidate(
            "linear", choose_linear(held.train, held.validation, review=review), held, review
        )
        return [run_amount_rule(held, review), boosting, linear]


def metrics_table(candidates: list[Candidate]) -> DataFrame:
    out = candidates[0].metrics
    for candidate in candidates[1:]:
        out = out.unionByName(candidate.metrics)
    return out


def score_requests(
    requests: DataFrame, model: PipelineModel, threshold: float, version: str
) -> DataFrame:
    """`requests`, with row and history features already added, plus the decision record.

    A conflicting request gets no probability and no decision. The history features are
    returned but, like the card, are not model inputs.
    """
    scored = with_probability(requests, model)
    usable = F.col("status") != "conflict"
    return scored.select(
        *requests.columns,
        F.when(usable, F.col("probability")).alias("probability"),
        F.when(usable, flag_at("probability", threshold)).alias("decision"),
        F.lit(float(threshold)).alias("threshold"),
        F.lit(version).alias("model_version"),
        F.struct(*HISTORY_FEATURES).alias("history"),
    )
