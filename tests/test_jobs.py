"""The command line, end to end on generated raw CSV files."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from cardflow.__main__ import main
from cardflow.operators.history import history_features
from cardflow.plans.jobs import score, train
from cardflow.plans.training import formula_model
from cardflow.schema import HISTORY_FEATURES, RAW_COLUMNS
from cardflow.sources.csv import read_raw, read_transactions
from cardflow.streaming.job import read_batches
from cardflow.streaming.state_log import StateLog


def write_csv(path, start, n, seed):
    rng = random.Random(seed)
    lines = ["," + ",".join(RAW_COLUMNS)]
    now = dt.datetime.fromisoformat(start)
    for i in range(n):
        now += dt.timedelta(seconds=rng.choice([0, 60, 4000, 20000]))
        fraud = int(i % 8 == 0)
        amount = rng.uniform(600, 1500) if fraud else rng.uniform(1, 150)
        lines.append(
            f'{i},{now},{rng.randrange(5)},"shop, {i % 3}",{rng.choice(["food", "fuel"])},'
            f'{amount:.2f},Noor,Silva,{rng.choice("FM")},"9 Elm, C",Lakeside,OR,97301,44.95,-123.03,81200,'
            f'"Baker",1975-11-30,{seed}-{i:04d},0,{rng.uniform(40, 50):.4f},-122.96,{fraud}'
        )
    path.write_text("\n".join(lines))
    return str(path)


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    base = tmp_path_factory.mktemp("raw")
    return (
        write_csv(base / "train.csv", "2019-10-20 00:00:00", 250, 1),
        write_csv(base / "test.csv", "2020-01-10 00:00:00", 80, 2),
    )


def test_batch_and_stream_commands(spark, files, tmp_path):
    out = {n: str(tmp_path / n) for n in "snap states inbox offsets features table audit".split()}
    main(["history", *files, "--out", out["table"]])
    main(["state", files[0], "--out", out["snap"], "--files", "1"])
    main(["seed", out["snap"], "--states", out["states"], "--buckets", "4"])
    main(["publish", files[1], "--out", out["inbox"]])
    main(
        ["stream", "--source", out["inbox"], "--states", out["states"], "--buckets", "4",
         "--checkpoint", out["offsets"], "--features", out["features"], "--audit", out["audit"],
         "--drain"]
    )
    assert spark.read.parquet(out["table"]).count() == 330
    current = StateLog(out["states"], 4).current(spark)
    assert current.agg(F.sum("n_total")).first()[0] == 330
    online = {
        r["tx_id"]: tuple(r[c] for c in HISTORY_FEATURES[:3])
        for r in read_batches(spark, out["features"]).collect()
    }
    batch = {
        r["tx_id"]: tuple(r[c] for c in HISTORY_FEATURES[:3])
        for r in history_features(read_transactions(spark, list(files))).collect()
    }
    assert len(online) == 80 and all(batch[k] == v for k, v in online.items())


def test_decisions_in_the_stream_and_in_batch(spark, files, tmp_path):
    """The stream decides on each message as the batch command does, and once."""
    out = {n: str(tmp_path / n) for n in "snap states inbox offsets scores batch rejects trained".split()}
    fixed = formula_model(-2.0, {"amount": 0.004, "hour": 0.03, "cast(category = 'fuel' AS double)": 0.5})
    fixed.write().save(f"{out['trained']}/models/fixed")
    spark.createDataFrame([("fixed", 0.4)], "model string, threshold double").write.parquet(f"{out['trained']}/metrics")
    main(["state", files[0], "--out", out["snap"], "--files", "1"])
    main(["seed", out["snap"], "--states", out["states"], "--buckets", "4"])
    model = ["--trained", out["trained"], "--model", "fixed"]
    main(["score", files[1], "--states", out["states"], "--buckets", "4", "--out", out["batch"], "--rejects", out["rejects"], *model])
    main(["publish", files[1], "--out", out["inbox"]])
    broken = spark.read.json(out["inbox"]).limit(1).withColumn("value", F.regexp_replace("value", '"poblacion_ciudad":[0-9]+', '"poblacion_ciudad":0')).withColumn("value", F.regexp_replace("value", '"id_transaccion":"', '"id_transaccion":"zz'))
    broken = broken.withColumn("value", F.regexp_replace("value", "2020-", "2031-")).checkpoint()
    broken.write.mode("append").json(out["inbox"])
    for run in ("1", "2"):
        main(
            ["stream", "--source", out["inbox"], "--states", out["states"], "--buckets", "4", "--run", run,
             "--checkpoint", out["offsets"] + run, "--scores", out["scores"], "--drain", *model]
        )
    batch = {r["tx_id"]: r for r in spark.read.parquet(out["batch"]).collect()}
    online = read_batches(spark, out["scores"]).collect()
    assert len(online) == len({r["tx_id"] for r in online}) == 81 and len(batch) == 80
    for r in online:
        if r["tx_id"].startswith("zz"):
            assert (r["reject_reason"], r["probability"], r["decision"]) == ("city_pop not positive", None, None)
            continue
        b = batch[r["tx_id"]]
        assert abs(r["probability"] - b["probability"]) < 1e-12
        assert (r["decision"], r["threshold"], r["model_version"]) == (b["decision"], 0.4, "fixed")
        assert r["decision"] == (r["probability"] >= 0.4)
    with pytest.raises(ValueError, match="no model"):
        main(["score", files[1], "--states", out["states"], "--buckets", "4", "--out", out["batch"], "--trained", out["trained"], "--model", "none"])


def test_publish_limit(spark, files, tmp_path):
    main(["publish", files[1], "--out", str(tmp_path / "few"), "--limit", "5"])
    keys = spark.read.json(str(tmp_path / "few")).select(
        F.get_json_object("value", "$.id_transaccion").alias("id")
    )
    assert {r["id"] for r in keys.collect()} == {f"2-{i:04d}" for i in range(5)}


def test_train_and_score(spark, files, tmp_path):
    out = str(tmp_path / "trained")
    report = train(spark, [files[0]], [files[1]], out, trees=2).first()
    assert report["promote"] and report["best_model"] in ("boosting", "linear")
    metrics = {r["model"]: r for r in spark.read.parquet(f"{out}/metrics").collect()}
    assert set(metrics) == {"amount_rule", "boosting", "linear"}
    champion = spark.createDataFrame([("old", -1.0)], "model string, test_cost double")
    name = report["best_model"]
    model = PipelineModel.load(f"{out}/models/{name}")
    requests = read_raw(spark, [files[1]]).withColumn(
        "amount", F.when(F.col("tx_id") == "2-0003", -10.0).otherwise(F.col("amount"))
    )
    states = str(tmp_path / "s")
    main(["state", files[0], "--out", states])
    from cardflow.operators.cost import champion_report
    from cardflow.sources.tables import read_state_snapshot

    spent = champion_report(
        spark.read.parquet(f"{out}/metrics").where("model <> 'amount_rule'"), champion
    )
    assert not spent.first()["promote"]
    scored, rejected = score(
        requests, read_state_snapshot(spark, states), model, metrics[name]["threshold"], name
    )
    assert [(r["tx_id"], r["reject_reason"]) for r in rejected.collect()] == [
        ("2-0003", "amount not positive")
    ]
    rows = scored.collect()
    assert len(rows) == 79 and all(0 <= r["probability"] <= 1 for r in rows)
    assert {r["status"] for r in rows} <= {"ok", "new"}
