"""One query per operator. Every one reads its tables whole."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardflow.functions.messages import is_complete, parse_messages, valid_events
from cardflow.operators import audit, cost, explore, prepare
from cardflow.operators.asof import asof_join
from cardflow.operators.history import first_per_card, history_features, position_in_card
from cardflow.operators.latest import latest_per_key
from cardflow.operators.request import check_requests, request_features
from cardflow.operators.rowfeatures import row_features
from cardflow.operators.split import (
    Splits,
    new_cards,
    time_split,
    with_earlier_state,
    without_earlier_state,
)
from cardflow.operators.state import (
    card_state,
    fold,
    fresh_rows,
    recent_arrays,
    recent_transactions,
    replace_states,
)
from cardflow.plans import training
from cardflow.plans.workspace import cut_lineage, new_dir
from cardflow.schema import HISTORY_FEATURES, RAW_COLUMNS, RAW_INDEX
from cardflow.sources.csv import read_raw
from cardflow.sources.messages import (
    export_messages,
    export_parts,
    messages,
    read_message_stream,
)
from cardflow.sources.tables import (
    read_features,
    read_state_snapshot,
    write_features,
    write_state_snapshot,
)
from cardflow.streaming.fold import stateful_fold, to_state
from cardflow.streaming.job import Scorer, StateJob, read_batches, start, stream_features
from cardflow.streaming.state_log import StateLog
from contract.tables import ORDER_RETENTION, ORDER_WINDOWS, table, tx_events, tx_orders

EVENT_CUT = "2024-01-16"
EVENT_TEST = "2024-01-25"
ORDER_CUTS = ("1997-03-01", "1999-06-01")


def _rounded(df: DataFrame, places: dict[str, int]) -> DataFrame:
    return df.withColumns({c: F.round(c, n) for c, n in places.items() if c in df.columns})


FEATURE_PLACES = {
    "prior_amount": 3,
    "amount_ratio": 5,
    "prev_distance_km": 4,
    "implied_speed_kmh": 3,
}


def _features(df: DataFrame, counts: list[str]) -> DataFrame:
    return _rounded(
        df.select(
            "card_id",
            "tx_id",
            *counts,
            "prior_amount",
            "amount_ratio",
            "is_new_category",
            "prev_distance_km",
            "implied_speed_kmh",
        ),
        FEATURE_PLACES,
    )


def _states(df: DataFrame) -> DataFrame:
    """States with their arrays as text and amounts in cents."""
    cents = F.transform(
        "recent_amounts", lambda a: F.round(a * 100).cast("long").cast("string")
    )
    return recent_arrays(df).select(
        "card_id",
        "n_total",
        F.round("amount_total", 2).alias("amount_total"),
        F.array_join("categories_seen", ",").alias("categories_seen"),
        F.array_join(F.transform("recent_epochs", lambda e: e.cast("string")), ",").alias(
            "recent_epochs"
        ),
        F.array_join(F.transform("recent_counts", lambda e: e.cast("string")), ",").alias(
            "recent_counts"
        ),
        F.array_join(cents, ",").alias("recent_cents"),
        "last_epoch",
        "last_tx_id",
        "last_lat",
        "last_lon",
    )


def history(spark: SparkSession, sf: str) -> DataFrame:
    out = history_features(tx_events(spark, sf))
    return _features(out, ["cnt_10m", "cnt_1h", "cnt_24h"])


def history_ties(spark: SparkSession, sf: str) -> DataFrame:
    return _features(history_features(tx_orders(spark, sf), ORDER_WINDOWS), list(ORDER_WINDOWS))


def row_level(spark: SparkSession, sf: str) -> DataFrame:
    out = row_features(tx_events(spark, sf)).select(
        "tx_id", "hour", "weekday", "age", "home_merchant_km"
    )
    return _rounded(out, {"age": 6, "home_merchant_km": 4})


def first_k(spark: SparkSession, sf: str) -> DataFrame:
    return first_per_card(tx_orders(spark, sf), 3).select("card_id", "tx_id", "epoch_s")


def positions(spark: SparkSession, sf: str) -> DataFrame:
    return position_in_card(tx_orders(spark, sf)).select("card_id", "tx_id", "position")


def top_spans(spark: SparkSession, sf: str) -> DataFrame:
    return explore.shortest_spans(tx_orders(spark, sf), 20, at_least=3)


def ordered_head(spark: SparkSession, sf: str) -> DataFrame:
    return explore.first_transactions(tx_events(spark, sf), 100).select("tx_id", "epoch_s")


def _splits(spark: SparkSession, sf: str) -> Splits:
    tx = row_features(tx_events(spark, sf))
    test = F.lit(EVENT_TEST).cast("timestamp")
    return time_split(tx.where(F.col("ts") < test), tx.where(F.col("ts") >= test), EVENT_CUT)


def split_summary(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(explore.split_summary(_splits(spark, sf)), {"fraud_pct": 6})


def rate_by_category(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(explore.fraud_rate_by_category(tx_events(spark, sf)), {"fraud_pct": 6})


def rate_by_hour(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(explore.fraud_rate_by_hour(tx_events(spark, sf)), {"fraud_pct": 6})


def histogram(spark: SparkSession, sf: str) -> DataFrame:
    return explore.amount_histogram(tx_events(spark, sf))


def per_card(spark: SparkSession, sf: str) -> DataFrame:
    return explore.transactions_per_card(tx_events(spark, sf))


def activity(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(
        explore.card_activity_summary(tx_events(spark, sf)),
        {"mean": 6, "std": 6, "p25": 4, "p50": 4, "p75": 4},
    )


def state(spark: SparkSession, sf: str) -> DataFrame:
    return _states(card_state(tx_orders(spark, sf), ORDER_RETENTION))


def recent_rows(spark: SparkSession, sf: str) -> DataFrame:
    out = recent_transactions(tx_orders(spark, sf), ORDER_RETENTION)
    return out.select("card_id", "tx_id", "epoch_s", "amount")


def _order_batches(spark: SparkSession, sf: str) -> list[DataFrame]:
    tx = tx_orders(spark, sf).drop("ts", "is_fraud", "score")
    a, b = (F.unix_timestamp(F.lit(c).cast("timestamp")) for c in ORDER_CUTS)
    t = F.col("epoch_s")
    return [tx.where(t < a), tx.where((t >= a) & (t < b)), tx.where(t >= b)]


def _folded(spark: SparkSession, sf: str) -> DataFrame:
    """Three batches, the second of them delivered twice."""
    first, second, third = _order_batches(spark, sf)
    current = card_state(first, ORDER_RETENTION)
    for batch in (second, second, third):
        current = cut_lineage(current)
        current = replace_states(current, fold(current, batch, ORDER_RETENTION))
    return current


def state_fold(spark: SparkSession, sf: str) -> DataFrame:
    return _states(_folded(spark, sf))


def requests(spark: SparkSession, sf: str) -> DataFrame:
    tx = tx_events(spark, sf)
    before = card_state(tx.where(F.col("ts") < F.lit(EVENT_CUT).cast("timestamp")))
    out = request_features(tx, before)
    return _features_with_status(out)


def _features_with_status(out: DataFrame) -> DataFrame:
    """Whole numbers and flags of a conflict, which are null, are shown as -1."""
    shown = {
        c: F.coalesce(F.col(c).cast("long"), F.lit(-1).cast("long"))
        for c in ("cnt_10m", "cnt_1h", "cnt_24h", "is_new_category")
    }
    return _rounded(
        out.select("card_id", "tx_id", "status", "has_history", *HISTORY_FEATURES).withColumns(
            shown
        ),
        FEATURE_PLACES,
    )


def request_checks(spark: SparkSession, sf: str) -> DataFrame:
    tx = tx_events(spark, sf).withColumns(
        {
            "amount": F.col("amount") - 5,
            "city_pop": F.col("city_pop") - 1500,
            "gender": F.when(F.col("category") != "view", F.col("gender")),
        }
    )
    return check_requests(tx).select("tx_id", "reject_reason")


def asof_clicks(spark: SparkSession, sf: str) -> DataFrame:
    tx = tx_events(spark, sf)
    bought = tx.where(F.col("category") == "purchase").select("card_id", "tx_id", "ts")
    clicked = tx.where(F.col("category") == "click").select(
        "card_id", "tx_id", "ts", F.col("amount").alias("click_amount"), F.col("tx_id").alias("click_id")
    )
    out = asof_join(bought, clicked, ["click_id", "click_amount"])
    return out.select("card_id", "tx_id", "click_id", "click_amount")


def asof_ties(spark: SparkSession, sf: str) -> DataFrame:
    tx = tx_orders(spark, sf)
    facts = tx.where("is_fraud").select("card_id", "tx_id", "ts", F.col("tx_id").alias("match_id"))
    out = asof_join(tx.select("card_id", "tx_id", "ts"), facts, ["match_id"])
    return out.select("card_id", "tx_id", "match_id")


def training_rows(spark: SparkSession, sf: str) -> DataFrame:
    tx = tx_events(spark, sf)
    features = history_features(tx).select("card_id", "tx_id", "ts", *HISTORY_FEATURES)
    joined = asof_join(tx.select("card_id", "tx_id", "ts"), features, HISTORY_FEATURES)
    return _features(joined, ["cnt_10m", "cnt_1h", "cnt_24h"])


def latest(spark: SparkSession, sf: str) -> DataFrame:
    tx = tx_events(spark, sf).select("card_id", "ts", "tx_id", "amount", "category")
    out = latest_per_key(tx, start="2000-01-01", end=EVENT_TEST)
    return out.select("card_id", "tx_id", "amount", "category")


def card_sets(spark: SparkSession, sf: str) -> DataFrame:
    cards = table(spark, sf, "customer").select(F.col("c_custkey").alias("card_id"))
    first, second, third = _order_batches(spark, sf)
    known = first.select("card_id").distinct()
    parts = {
        "with_state": with_earlier_state(cards, known),
        "without_state": without_earlier_state(cards, known),
        "new": new_cards(second.unionByName(third), known),
    }
    frames = [df.select("card_id", F.lit(name).alias("kind")) for name, df in parts.items()]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


def event_export(spark: SparkSession, sf: str) -> DataFrame:
    return messages(tx_events(spark, sf))


def _damaged(spark: SparkSession, sf: str) -> DataFrame:
    """The messages of all events; those of views cut short, those of sign-ups without a
    readable time, those of clicks with a mistyped amount."""
    value = F.col("value")
    return messages(tx_events(spark, sf)).select(
        F.when(value.contains('"view"'), F.expr("left(value, length(value) - 1)"))
        .when(
            value.contains('"signup"'),
            F.regexp_replace(value, '"fecha_hora_transaccion":"[^"]*"', '"fecha_hora_transaccion":"ayer"'),
        )
        .when(value.contains('"click"'), F.regexp_replace(value, '"monto":[^,]*', '"monto":"x"'))
        .otherwise(value)
        .cast("binary")
        .alias("value")
    )


def message_parse(spark: SparkSession, sf: str) -> DataFrame:
    return valid_events(parse_messages(_damaged(spark, sf)))


def message_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return parse_messages(_damaged(spark, sf)).agg(
        F.count("*").alias("n"), F.count(F.when(~is_complete(), 1)).alias("rejected")
    )


def total_cost(spark: SparkSession, sf: str) -> DataFrame:
    tx = tx_events(spark, sf)
    rules = {"amount": ("amount", 150.0), "score": ("score", 0.4)}
    frames = []
    for name, (column, threshold) in rules.items():
        flagged = tx.withColumn("flagged", cost.flag_at(column, threshold))
        total = cost.business_cost(flagged, "is_fraud", "flagged", "amount")
        frames.append(total.select(F.lit(name).alias("rule"), F.round("cost", 2).alias("cost")))
    return frames[0].unionByName(frames[1])


def sweep(spark: SparkSession, sf: str) -> DataFrame:
    out = cost.threshold_costs(tx_events(spark, sf), "score")
    return _rounded(out, {"threshold": 6, "cost": 2})


def chosen(spark: SparkSession, sf: str) -> DataFrame:
    out = cost.best_threshold(cost.threshold_costs(tx_events(spark, sf), "score"))
    return _rounded(out, {"threshold": 6, "cost": 2})


def amount_sweep(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(cost.amount_rule_costs(tx_events(spark, sf)), {"threshold": 6, "cost": 2})


def precision(spark: SparkSession, sf: str) -> DataFrame:
    out = cost.average_precision(tx_events(spark, sf), "score")
    return _rounded(out, {"average_precision": 9})


def champion(spark: SparkSession, sf: str) -> DataFrame:
    tx = tx_events(spark, sf)
    by_score = cost.best_threshold(cost.threshold_costs(tx, "score"))
    by_amount = cost.best_threshold(cost.amount_rule_costs(tx))
    flagged = tx.withColumn("flagged", cost.flag_at("amount", 250.0))
    current = cost.business_cost(flagged, "is_fraud", "flagged", "amount")
    metrics = by_score.select(F.lit("score").alias("model"), F.col("cost").alias("test_cost"))
    metrics = metrics.unionByName(
        by_amount.select(F.lit("amount").alias("model"), F.col("cost").alias("test_cost"))
    )
    report = cost.champion_report(
        metrics, current.select(F.lit("fixed").alias("model"), F.col("cost").alias("test_cost"))
    )
    return _rounded(report, {"best_cost": 2, "champion_cost": 2})


def weights(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(
        prepare.class_weights(tx_events(spark, sf)), {"weight": 9, "positive_ratio": 9}
    )


def standardized(spark: SparkSession, sf: str) -> DataFrame:
    tx = tx_events(spark, sf)
    columns = ["amount", "city_pop", "merch_lat"]
    fitted = prepare.fit_standardizer(tx.where(F.col("ts") < F.lit(EVENT_CUT).cast("timestamp")), columns)
    out = prepare.standardize(tx, fitted, columns)
    return _rounded(
        out.select("tx_id", *[f"z_{c}" for c in columns]), {f"z_{c}": 6 for c in columns}
    )


def vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    tx = tx_events(spark, sf)
    fitted = prepare.fit_vocabulary(tx.where(~F.col("is_fraud") & (F.col("category") != "signup")), "category")
    return prepare.index_values(tx, fitted, "category").select("tx_id", "category", "category_index")


def feature_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Whole-history windows against the features of two batches from the states before them."""
    tx = tx_events(spark, sf).drop("ts", "birth_date")
    cut = F.unix_timestamp(F.lit(EVENT_CUT).cast("timestamp"))
    first, second = tx.where(F.col("epoch_s") < cut), tx.where(F.col("epoch_s") >= cut)
    before = cut_lineage(card_state(first))
    online = stream_features(fresh_rows(second, before), before)
    return audit.feature_parity(
        history_features(tx), history_features(first).unionByName(online)
    )


def request_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Whole-history windows against request features, on the first transaction of each card
    after its state was taken."""
    tx = tx_events(spark, sf)
    later = F.col("ts") >= F.lit(EVENT_CUT).cast("timestamp")
    asked = first_per_card(tx.where(later))
    online = request_features(asked, card_state(tx.where(~later)))
    batch = history_features(tx).join(
        asked.select("card_id", "tx_id"), ["card_id", "tx_id"], "left_semi"
    )
    return audit.feature_parity(batch, online)


def state_audit(spark: SparkSession, sf: str) -> DataFrame:
    whole = card_state(tx_orders(spark, sf), ORDER_RETENTION)
    return audit.state_parity(whole, _folded(spark, sf))


def csv_load(spark: SparkSession, sf: str) -> DataFrame:
    """The events as two raw CSV files, read back as one history."""
    tx = tx_events(spark, sf).drop("score", "epoch_s")
    ours = {
        "ts": F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
        "is_fraud": F.col("is_fraud").cast("int"),
        "unix_time": F.lit(0),
        **{
            c: F.concat(F.lit(f"{c}, "), F.col("card_id"))
            for c in ("first_name", "last_name", "street", "city", "state", "zip", "job")
        },
    }
    raw = tx.select(
        F.lit(0).alias(RAW_INDEX),
        *[
            ours.get(here, F.col(here) if here in tx.columns else F.lit(None)).alias(header)
            for header, here in RAW_COLUMNS.items()
        ],
    )
    early = F.col("trans_date_trans_time") < EVENT_CUT
    paths = [new_dir(spark, "raw"), new_dir(spark, "raw")]
    late = raw.where(~early).select(*sorted(raw.columns))
    for rows, path in zip((raw.where(early), late), paths):
        rows.write.csv(path, header=True)
    return read_raw(spark, paths).select(
        "tx_id",
        "card_id",
        F.unix_timestamp("ts").alias("epoch_s"),
        F.date_format("birth_date", "yyyy-MM-dd").alias("birth_date"),
        "amount",
        "category",
        "job",
        "city_pop",
        "merch_lon",
        "is_fraud",
    )


def feature_table(spark: SparkSession, sf: str) -> DataFrame:
    path = new_dir(spark, "features")
    write_features(history_features(tx_events(spark, sf)), path)
    return _features(read_features(spark, path), ["cnt_10m", "cnt_1h", "cnt_24h"])


def state_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    path = new_dir(spark, "states")
    write_state_snapshot(card_state(tx_orders(spark, sf), ORDER_RETENTION), path)
    return _states(read_state_snapshot(spark, path, start="1990-01-01"))


def _event_waves(spark: SparkSession, sf: str) -> list[DataFrame]:
    tx = tx_events(spark, sf)
    a, b = (F.lit(c).cast("timestamp") for c in (EVENT_CUT, EVENT_TEST))
    t = F.col("ts")
    return [tx.where(t < a), tx.where((t >= a) & (t < b)), tx.where(t >= b)]


def _stream(spark: SparkSession, sf: str, features: bool = False, audit: bool = False) -> StateJob:
    """Cold start from the first wave, then two waves through the stream, each drained by a
    query that resumes from the checkpoint, then everything again from a fresh checkpoint.
    Features and audit rows are written for those who read them; states do not depend on it."""
    base = new_dir(spark, "stream")
    inbox = f"{base}/inbox"
    log = StateLog(f"{base}/states", buckets=8)
    first, *rest = _event_waves(spark, sf)
    log.seed(spark, card_state(first))
    audit_path = f"{base}/audit" if audit else None
    job = StateJob(
        log,
        run=1,
        features_path=f"{base}/features" if features else None,
        rejects_path=f"{base}/rejects",
        audit_path=audit_path,
    )
    for wave in rest:
        export_messages(wave, inbox)
        source = read_message_stream(spark, path=inbox)
        start(source, job, f"{base}/offsets", drain=True).awaitTermination()
    again = StateJob(log, run=2, audit_path=audit_path)
    start(
        read_message_stream(spark, path=inbox), again, f"{base}/offsets_again", drain=True
    ).awaitTermination()
    return job


def stream_state(spark: SparkSession, sf: str) -> DataFrame:
    return _states(_stream(spark, sf).log.current(spark))


def stream_small_batches(spark: SparkSession, sf: str) -> DataFrame:
    """The same waves as 20 files, one file a batch."""
    base = new_dir(spark, "small")
    log = StateLog(f"{base}/states", buckets=1)
    first, *rest = _event_waves(spark, sf)
    log.seed(spark, card_state(first))
    tx = rest[0].unionByName(rest[1])
    now = F.unix_timestamp("ts")
    cuts = tx.agg(F.percentile_approx(now, [0.2, 0.4, 0.6, 0.8]).alias("t")).first()["t"]
    wave = sum([(now > cut).cast("int") for cut in cuts], F.lit(0))
    part = wave * 4 + F.pmod(F.xxhash64("card_id"), F.lit(4)).cast("int")
    export_parts(tx.withColumn("part", part), f"{base}/inbox", "part")
    job = StateJob(log, audit_path=f"{base}/audit")
    source = read_message_stream(spark, path=f"{base}/inbox", max_files=1)
    start(source, job, f"{base}/offsets", drain=True).awaitTermination()
    late = read_batches(spark, f"{base}/audit").agg(F.sum("late_or_repeated")).first()[0]
    if late:
        raise ValueError(f"{late} messages came late")
    return _states(log.current(spark))


def stream_feature_rows(spark: SparkSession, sf: str) -> DataFrame:
    job = _stream(spark, sf, features=True)
    return _features(read_batches(spark, job.features_path), ["cnt_10m", "cnt_1h", "cnt_24h"])


def stream_audit(spark: SparkSession, sf: str) -> DataFrame:
    job = _stream(spark, sf, audit=True)
    return read_batches(spark, job.audit_path).groupBy("run").agg(
        *[
            F.sum(c).alias(c)
            for c in ("rows", "rejected", "late_or_repeated")
        ]
    ).withColumn("run", F.col("run").cast("long"))


def stateful_states(spark: SparkSession, sf: str) -> DataFrame:
    """The same states from Spark's own state store."""
    base = new_dir(spark, "stateful")
    out = f"{base}/changed"
    for wave in _event_waves(spark, sf):
        export_messages(wave, f"{base}/inbox")
        events = valid_events(parse_messages(read_message_stream(spark, path=f"{base}/inbox")))
        (
            stateful_fold(events)
            .writeStream.outputMode("update")
            .foreachBatch(
                lambda df, n: df.write.mode("overwrite").parquet(f"{out}/batch_id={n}")
            )
            .option("checkpointLocation", f"{base}/offsets")
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )
    newest = latest_per_key(spark.read.parquet(out), "card_id", "batch_id", "last_tx_id")
    return _states(to_state(newest))


def candidates(spark: SparkSession, sf: str) -> DataFrame:
    return training.metrics_table(training.train_candidates(_splits(spark, sf)))


def scored(spark: SparkSession, sf: str) -> DataFrame:
    splits = _splits(spark, sf)
    with training.kept(splits) as held:
        choice = training.choose_by_cost([training.fit_linear(held.train)], held.validation)
    model, chosen = choice.model, choice.costs[0][1]
    known = card_state(splits.train.unionByName(splits.validation))
    asked = check_requests(splits.test).where(F.col("reject_reason").isNull())
    out = training.score_requests(request_features(asked, known), model, chosen, "linear-1")
    return out.select(
        "card_id",
        "tx_id",
        "status",
        F.round("probability", 6).alias("probability"),
        "decision",
        "threshold",
        "model_version",
        "has_history",
        *[F.col("history")[c].alias(c) for c in HISTORY_FEATURES],
    )


#: A logistic model with given weights, so that SQL can score as well.
FIXED_BIAS = -3.0
FIXED_WEIGHTS = {
    "amount": 0.012,
    "hour": 0.05,
    "city_pop": 0.000004,
    "cast(category = 'error' AS double)": 1.5,
}
FIXED_THRESHOLD = 0.3
#: The same model after each of some imagined passes: how far the weights have come.
STEP_SHARES = [0.4, 0.7, 1.0, 1.3]


def _fixed(share: float = 1.0):
    weights = {x: share * w for x, w in FIXED_WEIGHTS.items()}
    return training.formula_model(FIXED_BIAS, weights)


def matrix(spark: SparkSession, sf: str) -> DataFrame:
    out = training.model_matrix(row_features(tx_events(spark, sf)))
    return _rounded(out, {"age": 6, "home_merchant_km": 4})


METRIC_PLACES = {"threshold": 6, "validation_cost": 2, "test_cost": 2, "pr_auc": 9}


def rule_baseline(spark: SparkSession, sf: str) -> DataFrame:
    out = training.run_amount_rule(_splits(spark, sf)).metrics
    return _rounded(out.drop("pr_auc"), METRIC_PLACES)


def candidate_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(training.run_candidate("fixed", _fixed(), _splits(spark, sf)).metrics, METRIC_PLACES)


def choice_by_cost(spark: SparkSession, sf: str) -> DataFrame:
    validation = _splits(spark, sf).validation
    choice = training.choose_by_cost([_fixed(s) for s in STEP_SHARES], validation)
    return _rounded(choice.table(validation), {"threshold": 6, "cost": 2})


def linear_steps(spark: SparkSession, sf: str) -> DataFrame:
    """Costs after each pass of a fit, and the pass that was chosen."""
    splits = _splits(spark, sf)
    choice = training.choose_by_cost(training.linear_steps(splits.train), splits.validation)
    return _rounded(choice.table(splits.train), {"threshold": 6, "cost": 2})


def decision_records(spark: SparkSession, sf: str) -> DataFrame:
    """Requests from `EVENT_CUT` on against states of `EVENT_TEST`: early ones are conflicts."""
    tx = tx_events(spark, sf)
    known = card_state(tx.where(F.col("ts") < F.lit(EVENT_TEST).cast("timestamp")))
    requests = tx.where(F.col("ts") >= F.lit(EVENT_CUT).cast("timestamp"))
    features = request_features(row_features(requests), known)
    out = training.score_requests(features, _fixed(), FIXED_THRESHOLD, "fixed-1")
    return out.select(
        "card_id", "tx_id", "status", "has_history", F.round("probability", 6).alias("probability"),
        "decision", "threshold", "model_version",
    )


def stream_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Cold start from the first wave, decisions on the two others as they stream by, and again from a
    fresh checkpoint, which decides on nothing."""
    base = new_dir(spark, "scores")
    log = StateLog(f"{base}/states", buckets=8)
    first, *rest = _event_waves(spark, sf)
    log.seed(spark, card_state(first))
    scorer = Scorer(_fixed(), FIXED_THRESHOLD, "fixed-1", f"{base}/scores")
    for wave in rest:
        export_messages(wave, f"{base}/inbox")
        source = read_message_stream(spark, path=f"{base}/inbox")
        job = StateJob(log, scorer=scorer)
        start(source, job, f"{base}/offsets", drain=True).awaitTermination()
    again = StateJob(log, run=2, scorer=scorer)
    source = read_message_stream(spark, path=f"{base}/inbox")
    start(source, again, f"{base}/offsets_again", drain=True).awaitTermination()
    return read_batches(spark, scorer.path).select(
        "card_id", "tx_id", "status", "has_history", "reject_reason",
        F.round("probability", 6).alias("probability"), "decision", "threshold", "model_version",
    )


def batch_cards(spark: SparkSession, sf: str) -> DataFrame:
    """The audit of three batches, the third a repetition of the second under its own number."""
    base = new_dir(spark, "cards")
    log = StateLog(f"{base}/states", buckets=8)
    first, second, third = _event_waves(spark, sf)
    log.seed(spark, card_state(first))
    job = StateJob(log, audit_path=f"{base}/audit")
    for number, wave in enumerate((second, third, third)):
        job.process(messages(wave).select(F.col("value").cast("binary").alias("value")), number)
    return read_batches(spark, job.audit_path).select(
        F.col("batch_id").cast("long").alias("batch_id"),
        "rows", "rejected", "cards", "late_or_repeated", "cards_changed",
    )


def missing_states(spark: SparkSession, sf: str) -> DataFrame:
    """Scoring without a state table fails; it must not treat all cards as new."""
    log = StateLog(f"{new_dir(spark, 'absent')}/states")
    cards = table(spark, sf, "customer").select(F.col("c_custkey").alias("card_id"))
    try:
        found = log.current(spark)
    except FileNotFoundError:
        return cards.agg(F.count("*").alias("cards"), F.lit(True).alias("failed"))
    return cards.join(found, "card_id").agg(F.count("*").alias("cards"), F.lit(False).alias("failed"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "history_features": history,
    "history_features_ties": history_ties,
    "row_features": row_level,
    "first_k_per_card": first_k,
    "position_in_card": positions,
    "top_cards_by_span": top_spans,
    "first_transactions": ordered_head,
    "split_summary": split_summary,
    "fraud_rate_by_category": rate_by_category,
    "fraud_rate_by_hour": rate_by_hour,
    "amount_histogram": histogram,
    "transactions_per_card": per_card,
    "card_activity_summary": activity,
    "card_state": state,
    "recent_transactions": recent_rows,
    "state_fold": state_fold,
    "request_features": requests,
    "request_checks": request_checks,
    "asof_features": asof_clicks,
    "asof_ties": asof_ties,
    "training_set": training_rows,
    "latest_per_card": latest,
    "semi_anti_cards": card_sets,
    "event_export": event_export,
    "message_parse": message_parse,
    "message_rejects": message_rejects,
    "business_cost": total_cost,
    "threshold_sweep": sweep,
    "best_threshold": chosen,
    "amount_rule_sweep": amount_sweep,
    "average_precision": precision,
    "champion_report": champion,
    "class_weights": weights,
    "standardize": standardized,
    "vocabulary_index": vocabulary,
    "feature_parity_audit": feature_audit,
    "request_parity_audit": request_audit,
    "state_parity_audit": state_audit,
    "csv_load": csv_load,
    "feature_table": feature_table,
    "state_snapshot": state_snapshot,
    "stream_state": stream_state,
    "stream_small_batches": stream_small_batches,
    "stream_features": stream_feature_rows,
    "stream_audit": stream_audit,
    "stateful_states": stateful_states,
    "model_matrix": matrix,
    "rule_baseline": rule_baseline,
    "candidate_metrics": candidate_metrics,
    "choice_by_cost": choice_by_cost,
    "linear_steps": linear_steps,
    "decision_records": decision_records,
    "stream_scores": stream_scores,
    "batch_cards": batch_cards,
    "missing_states": missing_states,
    "train_candidates": candidates,
    "score_transactions": scored,
}
