from __future__ import annotations

import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from cardflow.functions.messages import parse_messages, valid_events
from cardflow.functions.times import from_epoch
from cardflow.operators.audit import feature_parity
from cardflow.operators.history import history_features
from cardflow.operators.latest import latest_per_key
from cardflow.operators.skew import SkewPolicy
from cardflow.operators.state import card_state, fresh_rows
from cardflow.plans.jobs import reset_stream, seed_stream
from cardflow.plans.workspace import children, cut_lineage, shared_dir
from cardflow.schema import RETENTION, STATE_SCHEMA
from cardflow.sources.messages import export_messages, export_parts, messages, read_message_stream
from cardflow.streaming import job as stream_job
from cardflow.streaming.fold import stateful_fold, to_state
from cardflow.streaming.job import StateJob, read_batches, start
from cardflow.streaming.state_log import StateLog
from contract import queries
from tests import brute
from tests.test_state import assert_states


@pytest.fixture
def waves(spark, tx, rows):
    cuts = [sorted(r[2] for r in rows)[i] for i in (80, 160)]
    t = F.col("epoch_s")
    full = tx.withColumns(
        {
            "ts": from_epoch(t),
            **{c: F.lit("x") for c in ("merchant", "gender")},
            "birth_date": F.lit("1980-01-01").cast("timestamp"),
            "home_lat": F.lit(1.0),
            "home_lon": F.lit(1.0),
            "city_pop": F.lit(5),
        }
    )
    return [
        full.where(t < cuts[0]),
        full.where((t >= cuts[0]) & (t < cuts[1])),
        full.where(t >= cuts[1]),
    ]


def drain(spark, inbox, job, checkpoint):
    start(read_message_stream(spark, path=inbox), job, checkpoint, drain=True).awaitTermination()


def test_cold_start_resume_rejects_and_replay(spark, tx, rows, waves, tmp_path):
    base, inbox = str(tmp_path), str(tmp_path / "inbox")
    log = StateLog(f"{base}/states", buckets=4)
    seed_stream(spark, card_state(waves[0]), log)
    job = StateJob(
        log,
        features_path=f"{base}/features",
        rejects_path=f"{base}/rejects",
        audit_path=f"{base}/audit",
        policy=SkewPolicy(hot_rows=40),
    )
    export_messages(waves[1], inbox)
    drain(spark, inbox, job, f"{base}/offsets")
    broken = spark.createDataFrame([("1", "<broken>")], "key string, value string")
    broken.write.mode("append").json(inbox)
    export_messages(waves[2], inbox)
    drain(spark, inbox, job, f"{base}/offsets")
    expected = brute.states(rows, RETENTION)
    assert_states(log.current(spark), expected)
    online = read_batches(spark, f"{base}/features")
    batch = history_features(tx).join(online.select("tx_id"), "tx_id", "left_semi")
    report = feature_parity(batch, online).collect()
    assert all(
        r["rows"] == len(rows) - 80 - _ties(rows) and r["different"] == r["missing_left"] == 0
        for r in report
    )
    assert read_batches(spark, f"{base}/rejects").count() == 1
    audit = read_batches(spark, f"{base}/audit").agg(
        F.sum("rows"), F.sum("rejected"), F.sum("late_or_repeated")
    ).first()
    assert tuple(audit) == (report[0]["rows"] + 1, 1, 0)

    # Everything again from a fresh checkpoint changes nothing.
    again = StateJob(log, run=2, audit_path=f"{base}/audit2")
    drain(spark, inbox, again, f"{base}/offsets2")
    assert_states(log.current(spark), expected)
    changed = read_batches(spark, f"{base}/audit2").agg(F.sum("cards_changed")).first()[0]
    assert changed == 0

    # A run number that is past this batch must not be used again.
    with pytest.raises(ValueError, match="higher run"):
        log.check_run(spark, 1, 0)

    compacted = log.compact(spark, f"{base}/compacted")
    assert_states(compacted.current(spark), expected)


def _ties(rows):
    """Rows that share the second of the first cut and so fall before it."""
    cut = sorted(r[2] for r in rows)[80]
    return sum(1 for r in rows if r[2] < cut) - 80


@pytest.mark.parametrize("files", [1, 3, None])
def test_states_do_not_depend_on_the_cap(spark, rows, waves, tmp_path, files):
    """Many files, of which a batch takes few: nothing is late. Busy cards come in several jobs."""
    base = str(tmp_path)
    log = StateLog(f"{base}/states", buckets=1)
    log.seed(spark)
    job = StateJob(log, audit_path=f"{base}/audit")
    tx = waves[0].unionByName(waves[1]).unionByName(waves[2])
    export_messages(tx, f"{base}/inbox", card_rows=25)
    source = read_message_stream(spark, path=f"{base}/inbox", max_files=files)
    start(source, job, f"{base}/offsets", drain=True).awaitTermination()
    assert_states(log.current(spark), brute.states(rows, RETENTION))
    audit = read_batches(spark, f"{base}/audit").agg(F.sum("rows"), F.sum("late_or_repeated")).first()
    assert tuple(audit) == (len(rows), 0)


def test_export_keeps_each_card_in_order(spark, tx, waves, tmp_path):
    path = str(tmp_path / "inbox")
    all_rows = waves[0].unionByName(waves[2]).repartition(5)
    export_messages(all_rows, path)
    files = [p.read_text().splitlines() for p in (tmp_path / "inbox").glob("part-*")]
    seen = {}
    for i, lines in enumerate(files):
        for message in map(json.loads, lines):
            value = json.loads(message["value"])
            order = (value["fecha_hora_transaccion"], value["id_transaccion"])
            file, last = seen.get(message["key"], (i, order))
            assert file == i and last <= order
            seen[message["key"]] = (i, order)
    assert sum(map(len, files)) == all_rows.count()


def test_a_very_busy_card_is_read_as_often_as_an_ordinary_one(spark, tmp_path):
    """One card of 100 times `card_rows`, mostly in one hour, among others: its parts become files in
    order of time, no part is much larger than asked, and the table is read a fixed number of times."""
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    table = (
        spark.range(4000)
        .withColumn("card_id", F.when(F.col("id") % 4 == 0, F.col("id") % 50).when(F.col("id") % 101 != 0, 7))
        .withColumn("ts", F.timestamp_seconds(F.when(F.col("id") < 3000, F.col("id") * 2654435761 % 3600).otherwise(F.col("id") * 7919 % 9_000_000)))
        .select("card_id", "ts", F.format_string("%05d", "id").alias("tx_id"), *[F.lit("x").alias(c) for c in ("merchant", "category", "gender")], *[F.lit(1.5).alias(c) for c in ("amount", "home_lat", "home_lon", "merch_lat", "merch_lon")], F.lit(5).alias("city_pop"), F.col("ts").alias("birth_date"))
        .repartition(3)
    )
    reads = {}
    for card_rows in (30, 1000, 10_000):
        read.value = 0
        inbox = tmp_path / f"inbox{card_rows}"
        export_messages(table.mapInPandas(counted, table.schema), str(inbox), card_rows=card_rows)
        reads[card_rows] = read.value / 4000
        files = sorted(inbox.glob("part-*"), key=lambda p: (p.stat().st_mtime_ns, p.name))
        last, per_file, total = {}, {}, 0
        for path in files:
            for message in map(json.loads, path.read_text().splitlines()):
                total += 1
                key = message.get("key")
                value = json.loads(message["value"])
                order = (value["fecha_hora_transaccion"], value["id_transaccion"])
                assert key is None or last.get(key, order) <= order
                last[key] = order
                per_file[path, key] = per_file.get((path, key), 0) + 1
        assert total == 4000
        assert max(n for (_, key), n in per_file.items() if key == "7") <= card_rows + 8
    assert reads[30] == reads[1000] <= 6
    with_limit = tmp_path / "limited"
    export_messages(table, str(with_limit), limit=500, card_rows=40)
    ids = [json.loads(json.loads(line)["value"])["id_transaccion"] for p in with_limit.glob("part-*") for line in p.read_text().splitlines()]
    assert sorted(ids) == sorted(r["tx_id"] for r in table.orderBy("ts", "tx_id").limit(500).collect())


def test_batch_repeated_after_a_failure(spark, rows, waves, tmp_path):
    """A batch that ran but was not recorded by the stream runs again with the same result."""
    from cardflow.sources.messages import messages

    log = StateLog(str(tmp_path / "states"), buckets=4)
    log.seed(spark)
    job = StateJob(log, features_path=str(tmp_path / "features"))
    for wave, df in enumerate(waves):
        batch = messages(df).select(F.col("value").cast("binary"))
        job.process(batch, wave)
        job.process(batch, wave)
    assert_states(log.current(spark), brute.states(rows, RETENTION))
    assert read_batches(spark, str(tmp_path / "features")).count() == len(rows)


def test_reads_do_not_grow_with_the_number_of_batches(spark, tmp_path):
    """Each batch changes two of 30 cards; batch 60 reads no more than batch 10, and any batch may be
    repeated, also one that merged."""
    def states(batch):
        cards = {batch % 30, batch * 7 % 30}
        rows = [(c, batch, 1.0 * c, ["x"], [], batch, f"{batch}", 0.0, 0.0) for c in cards]
        return spark.createDataFrame(rows, STATE_SCHEMA)

    log = StateLog(str(tmp_path / "states"), buckets=4, merge_every=5)
    log.seed(spark)
    files, parts, expected = {}, {}, {}
    for batch in range(61):
        if batch % 7 == 0:
            before = {r["card_id"]: r["n_total"] for r in log.before(spark, 1, batch).collect()}
            assert before == expected
        files[batch] = len(log.before(spark, 1, batch).inputFiles())
        parts[batch] = len(log.parts(spark, (1, batch))[1])
        new = states(batch)
        log.write(new, 1, batch)
        if batch in (24, 31):
            before = {r["card_id"]: r["n_total"] for r in log.before(spark, 1, batch).collect()}
            assert before == expected
            log.write(new, 1, batch)
        expected.update({batch % 30: batch, (batch * 7) % 30: batch})
    assert {r["card_id"]: r["n_total"] for r in log.current(spark).collect()} == expected
    assert files[60] <= files[10] and max(files.values()) <= 4 + 4 and max(parts.values()) <= 4
    kept = [p for p in (tmp_path / "states").glob("*/run=*/batch_id=*")]
    assert len(kept) <= 3 + 10
    with pytest.raises(ValueError, match="higher run"):
        log.check_run(spark, 0, 99)


def test_reset(spark, rows, waves, tmp_path):
    base, inbox = str(tmp_path), str(tmp_path / "inbox")
    log = StateLog(f"{base}/states", buckets=2)
    snapshot = cut_lineage(card_state(waves[0]))
    for attempt in range(2):
        reset_stream(spark, snapshot, log, f"{base}/offsets", [f"{base}/features", f"{base}/none"])
        assert not (tmp_path / "features").exists()
        if not attempt:
            export_messages(waves[1].unionByName(waves[2]), inbox)
        drain(spark, inbox, StateJob(log, features_path=f"{base}/features"), f"{base}/offsets")
        assert_states(log.current(spark), brute.states(rows, RETENTION))


def test_batches_leave_no_tables_behind(spark, waves, tmp_path):
    """Neither lists of hot cards nor last seconds of cards stay in the shared folder."""
    from cardflow.sources.messages import messages

    log = StateLog(str(tmp_path / "states"), buckets=2)
    log.seed(spark, card_state(waves[0]))
    job = StateJob(log, features_path=str(tmp_path / "features"), policy=SkewPolicy(hot_rows=5))
    before = set(children(spark, shared_dir(spark)))
    job.process(messages(waves[1]).select(F.col("value").cast("binary")), 0)
    assert set(children(spark, shared_dir(spark))) == before


@pytest.mark.parametrize("hot_rows, detect", [(70, False), (5, True)])
def test_cards_of_a_batch_are_counted_once(spark, waves, tmp_path, monkeypatch, hot_rows, detect):
    """A batch of many rows without a hot card: no step looks for hot cards again."""
    log = StateLog(f"{tmp_path}/states", buckets=2)
    log.seed(spark, card_state(waves[0]))
    given = []
    monkeypatch.setattr(stream_job, "fresh_rows", lambda tx, state, policy: given.append(policy) or fresh_rows(tx, state, policy))
    job = StateJob(log, audit_path=f"{tmp_path}/audit", policy=SkewPolicy(hot_rows=hot_rows))
    value = messages(waves[1]).selectExpr("cast(value as binary) value")
    assert waves[1].count() > 70
    job.process(value, 0)
    assert [p.detect for p in given] == [detect]
    row = read_batches(spark, job.audit_path).first()
    cards = waves[1].select("card_id").distinct().count()
    assert (row["rows"], row["late_or_repeated"], row["cards"], row["cards_changed"]) == (waves[1].count(), 0, cards, cards)


@pytest.mark.parametrize("query, asked", [("stream_state", (False, False)), ("stream_audit", (False, True)), ("stream_features", (True, False))])
def test_a_query_asks_the_stream_for_what_it_returns(spark, monkeypatch, query, asked):
    made = []

    class Job(StateJob):
        def __post_init__(self):
            super().__post_init__()
            made.append((self.features_path is not None, self.audit_path is not None))

    monkeypatch.setattr(queries, "StateJob", Job)
    assert queries.QUERIES[query](spark, "/root/testdata/sf0.001").count()
    assert made[0] == asked


def test_state_table_must_exist(spark, waves, tmp_path):
    job = StateJob(StateLog(str(tmp_path / "none")))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        job.process(waves[0].select(F.lit(b"").alias("value")), 0)


def test_retention_must_cover_windows(tmp_path):
    with pytest.raises(ValueError):
        StateJob(StateLog(str(tmp_path)), retention=3600)


def test_state_store_fold(spark, rows, waves, tmp_path):
    base, inbox = str(tmp_path), str(tmp_path / "inbox")
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    try:
        for wave in (waves[0], waves[1].unionByName(waves[0]), waves[2]):
            export_messages(wave, inbox)
            events = valid_events(parse_messages(read_message_stream(spark, path=inbox)))
            (
                stateful_fold(events)
                .writeStream.outputMode("update")
                .foreachBatch(lambda df, n: df.write.parquet(f"{base}/out/batch_id={n}"))
                .option("checkpointLocation", f"{base}/offsets")
                .trigger(availableNow=True)
                .start()
                .awaitTermination()
            )
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    newest = latest_per_key(spark.read.parquet(f"{base}/out"), "card_id", "batch_id", "last_tx_id")
    assert_states(to_state(newest), brute.states(rows, RETENTION))


def test_one_file_a_part_in_order(spark, waves, tmp_path):
    inbox = str(tmp_path / "inbox")
    rows = waves[1].withColumn("part", (F.col("epoch_s") / 40_000).cast("int") * 2 + F.col("card_id") % 2)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        export_parts(rows.repartition(3), inbox, "part")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    expected = [r["part"] for r in rows.select("part").distinct().orderBy("part").collect()]
    files = sorted((tmp_path / "inbox").glob("part-*.json"), key=lambda f: f.stat().st_mtime_ns)
    assert [int(f.name.split("-")[1]) for f in files] == expected and len(expected) > 3
    found = [json.loads(json.loads(line)["value"]) for f in files for line in f.open()]
    assert len(found) == rows.count()
    for card in {m["numero_tarjeta"] for m in found}:
        mine = [(m["fecha_hora_transaccion"], m["id_transaccion"]) for m in found if m["numero_tarjeta"] == card]
        assert mine == sorted(mine)


def test_small_batches_are_twenty_files(spark, monkeypatch):
    """However many tasks an export has."""

    class Exported(Exception):
        pass

    def stop(source, job, *args, **options):
        raise Exported(job.log.path)

    monkeypatch.setattr(queries, "start", stop)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        with pytest.raises(Exported) as found:
            queries.stream_small_batches(spark, "/root/testdata/sf0.001")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    inbox = str(found.value).removesuffix("/states") + "/inbox"
    assert len([n for n in children(spark, inbox) if not n.startswith((".", "_"))]) == 20


def test_fold_makes_one_frame_a_call(monkeypatch):
    """A card's rows and seconds are plain values; only the row that is returned is a frame."""

    class Events:
        def groupBy(self, key):
            return self

        def applyInPandasWithState(self, update, *rest):
            return update

    class State:
        exists = False

        def update(self, value):
            self.get, self.exists = value, True

    update, state, frames = stateful_fold(Events()), State(), []
    made = pd.DataFrame
    names = ["epoch_s", "tx_id", "amount", "category", "merch_lat", "merch_lon"]
    first = made([(20, "b", 2.0, "y", 1.0, 2.0), (10, "a", 1.0, "x", 3.0, 4.0), (20, "b", 2.0, "y", 1.0, 2.0)], columns=names)
    second = made([(20, "b", 2.0, "y", 1.0, 2.0), (20, "c", 4.0, "x", 5.0, 6.0)], columns=names)
    late = made([(15, "z", 9.0, "z", 1.0, 1.0)], columns=names)
    monkeypatch.setattr(pd, "DataFrame", lambda *a, **k: frames.append(1) or made(*a, **k))
    for rows in (first, second, late):
        list(update((7,), iter([rows]), state))
    assert len(frames) == 2
    assert state.get == (3, 7.0, ["x", "y"], [10, 20], [1, 2], [1.0, 6.0], 20, "c", 5.0, 6.0)
