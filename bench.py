"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the threads. Every query runs once to warm up, then the
faster of two runs counts; rows go to a sink that discards them. At sf0.1 the queries named _2m
run on two million rows (the events, twenty cards for each one) and stream_500k on half a million
messages, near the sizes of the published baseline. In those named _hot a third of the rows belong
to one card. stream_10k takes twelve batches of about 10,000 messages, one after the other, into a
state table of the usual number of splits, once merged; it runs once, without a warm-up of its own, and
is not part of the total.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from cardflow.operators.history import history_features  # noqa: E402
from cardflow.operators.ranks import values_at  # noqa: E402
from cardflow.operators.state import card_state  # noqa: E402
from cardflow.plans.workspace import new_dir  # noqa: E402
from cardflow.sources.messages import export_messages, messages, read_message_stream  # noqa: E402
from cardflow.streaming.job import StateJob, start  # noqa: E402
from cardflow.streaming.state_log import StateLog  # noqa: E402
from contract.queries import QUERIES  # noqa: E402
from contract.tables import tx_events  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
COPIES = 20
NAMES = [
    "history_features",
    "history_features_ties",
    "row_features",
    "card_state",
    "request_features",
    "asof_features",
    "training_set",
    "latest_per_card",
    "event_export",
    "message_parse",
    "threshold_sweep",
    "amount_rule_sweep",
    "average_precision",
    "vocabulary_index",
]


def discard(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(run) -> float:
    began = time.perf_counter()
    run()
    return round(time.perf_counter() - began, 3)


def large(spark: SparkSession, hot: bool) -> DataFrame:
    tx = tx_events(spark, SF_DIR).withColumn(
        "copy", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1)))
    )
    card = F.col("card_id") * COPIES + F.col("copy")
    if hot:
        card = F.when(F.xxhash64("tx_id", "copy") % 3 == 0, F.lit(7)).otherwise(card)
    path = new_dir(spark, "bench")
    tx.select(
        card.cast("long").alias("card_id"),
        F.concat("tx_id", F.col("copy").cast("string")).alias("tx_id"),
        "ts",
        (F.col("epoch_s") + F.pmod(F.xxhash64("tx_id", "copy"), F.lit(3600))).alias("epoch_s"),
        "category",
        "amount",
        "merch_lat",
        "merch_lon",
    ).repartition(16).write.parquet(path)
    return spark.read.parquet(path)


def drain(spark: SparkSession, inbox: str) -> None:
    base = new_dir(spark, "bench")
    log = StateLog(f"{base}/states", buckets=8)
    log.seed(spark)
    job = StateJob(log, features_path=f"{base}/features", audit_path=f"{base}/audit")
    stream = read_message_stream(spark, path=inbox)
    start(stream, job, f"{base}/offsets", drain=True).awaitTermination()


def small_batches(spark: SparkSession, tx: DataFrame, batches: int = 12, size: int = 10_000) -> None:
    base = new_dir(spark, "bench")
    log = StateLog(f"{base}/states")
    log.seed(spark)
    job = StateJob(log, features_path=f"{base}/features")
    share = min(1.0, batches * size / max(1, tx.count()))
    cuts = values_at(tx, "epoch_s", levels=[share * i / batches for i in range(batches + 1)])
    for i, (low, high) in enumerate(zip(cuts, cuts[1:])):
        wave = tx.where((F.col("epoch_s") >= low) & (F.col("epoch_s") < high))
        job.process(messages(wave).select(F.col("value").cast("binary").alias("value")), i)


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("cardflow-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    inbox = new_dir(spark, "inbox")
    few = tx_events(spark, SF_DIR).withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(4))))
    few = few.withColumns(
        {
            "card_id": F.col("card_id") * 5 + F.col("copy"),
            "tx_id": F.concat("tx_id", F.col("copy").cast("string")),
        }
    )
    export_messages(few, inbox)
    plain, hot = large(spark, hot=False), large(spark, hot=True)
    sizes = {"stream_rows": few.count(), "large_rows": plain.count()}
    runs = {name: lambda n=name: discard(QUERIES[n](spark, SF_DIR)) for name in NAMES}
    runs["stream_500k"] = lambda: drain(spark, inbox)
    runs["history_2m"] = lambda: discard(history_features(plain))
    runs["card_state_2m"] = lambda: discard(card_state(plain))
    runs["history_2m_hot"] = lambda: discard(history_features(hot))
    runs["card_state_2m_hot"] = lambda: discard(card_state(hot))
    for run in runs.values():
        run()
    seconds = {name: min(timed(run), timed(run)) for name, run in runs.items()}
    small = timed(lambda: small_batches(spark, few))
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(SF_DIR).name.removeprefix("sf"),
                **sizes,
                "history_rows_per_s": round(sizes["large_rows"] / seconds["history_2m"]),
                "stream_10k": small,
                "stream_messages_per_s": round(sizes["stream_rows"] / seconds["stream_500k"]),
            }
        )
    )


if __name__ == "__main__":
    main()
