from __future__ import annotations

import datetime as dt
import json

import numpy as np
import pandas as pd
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cardflow.functions.messages import is_complete, parse_messages, rejected_events
from cardflow.functions.times import from_epoch
from cardflow.operators import explore, prepare
from cardflow.operators.rowfeatures import row_features
from cardflow.operators.split import new_cards, time_split, with_earlier_state
from cardflow.plans.jobs import build_history, build_state, training_set
from cardflow.schema import HISTORY_FEATURES, MESSAGE_FIELDS, RAW_COLUMNS
from cardflow.sources.csv import concat_histories, read_raw, read_transactions
from cardflow.sources.messages import messages
from cardflow.sources.tables import read_features, read_state_snapshot

HEADER = "," + ",".join(RAW_COLUMNS)


def line(n, ts, card=1, tx="t", unix=0, amount="12.50"):
    return (
        f'{n},{ts},{card},"Bright, Oak & Co",books,{amount},Noor,Silva,M,"9 Elm, C",Lakeside,OR,97301,'
        f'44.9501,-123.0302,81200,"Baker, night",1975-11-30,{tx},{unix},44.871205,-122.964417,1'
    )


@pytest.fixture
def csv(tmp_path):
    a, b = tmp_path / "a.csv", tmp_path / "b.csv"
    a.write_text(
        "\n".join(
            [
                HEADER,
                line(0, "2018-03-04 10:20:30", tx="t1", unix=9),
                line(1, "2018-03-04 10:25:30", tx="t2", unix=1, amount="0.3"),
            ]
        )
    )
    b.write_text("\n".join([HEADER, line(0, "2018-03-04 10:21:12", tx="t3", amount="")]))
    return [str(a), str(b)]


@pytest.mark.parametrize("zone", ["UTC", "America/Argentina/Buenos_Aires"])
def test_raw_csv_in_any_zone(spark, csv, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = read_raw(spark, csv[:1])
        assert df.columns == list(RAW_COLUMNS.values())
        row = df.orderBy("tx_id").first()
        assert (row.merchant, row.job, row.amount, row.home_lon) == (
            "Bright, Oak & Co", "Baker, night", 12.5, -123.0302,
        )
        assert row.birth_date == dt.date(1975, 11, 30)
        assert read_transactions(spark, csv).agg(F.min("epoch_s")).first()[0] == 1520158830
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_history_job_round_trip(spark, csv, tmp_path):
    """Order follows the date although unix_time says otherwise; incomplete rows are returned;
    another reader sees UTC times."""
    out = str(tmp_path / "features")
    rejected = build_history(spark, csv, out)
    assert [r["tx_id"] for r in rejected.collect()] == ["t3"]
    table = pq.read_table(out).to_pandas().set_index("tx_id")
    assert table.loc["t1", "ts"].timestamp() == 1520158830
    assert (table.loc["t1", "cnt_10m"], table.loc["t2", "cnt_10m"]) == (0, 1)
    assert table.loc["t2", "prior_amount"] == 12.5
    assert list(read_features(spark, out).columns) == ["card_id", "tx_id", "ts", *HISTORY_FEATURES]
    tx = read_transactions(spark, csv[:1]).select("card_id", "tx_id", "ts")
    joined = {r["tx_id"]: r["cnt_10m"] for r in training_set(spark, tx, out).collect()}
    assert joined == {"t1": 0, "t2": 1}
    with pytest.raises(ValueError):
        read_features(spark, out, "missing")


def test_state_job_round_trip(spark, csv, tmp_path):
    out = str(tmp_path / "state")
    build_state(spark, csv, out, files=1)
    row = read_state_snapshot(spark, out).first()
    assert (row.n_total, row.last_tx_id, row.last_epoch) == (2, "t2", 1520159130)
    assert read_state_snapshot(spark, out, end="2018-03-04").isEmpty()
    with pytest.raises(Exception):
        read_state_snapshot(spark, str(tmp_path / "nothing")).count()


def test_columns_by_header(spark, csv, tmp_path):
    with open(csv[0]) as f:
        table = pd.read_csv(f, dtype=str)
    other = tmp_path / "other.csv"
    table[["amt", "city_pop", *sorted(c for c in table if c not in ("amt", "city_pop"))]].to_csv(other, index=False)
    rows = read_raw(spark, [csv[0], str(other)]).collect()
    assert len(rows) == 4 and len(set(rows)) == 2
    short = tmp_path / "short.csv"
    table.drop(columns="dob").to_csv(short, index=False)
    with pytest.raises(ValueError, match="dob"):
        read_raw(spark, [str(short)])


def test_concat(spark, csv):
    parts = [read_transactions(spark, [p]) for p in csv]
    assert concat_histories(parts).count() == read_transactions(spark, csv).count() == 3


def full_rows(spark, times):
    return spark.createDataFrame(
        [(tx, card, t, 12.5, "food", "shop", "F", "1983-11-27") for tx, card, t in times],
        "tx_id string, card_id long, ts string, amount double, category string, merchant string, "
        "gender string, birth_date string",
    ).withColumns(
        {
            "ts": F.col("ts").cast("timestamp"),
            "birth_date": F.col("birth_date").cast("timestamp"),
            **{c: F.lit(1.5) for c in ("home_lat", "home_lon", "merch_lat", "merch_lon")},
            "city_pop": F.lit(10),
            "is_fraud": F.lit(1),
            "first_name": F.lit("Ann"),
            "unix_time": F.lit(5),
        }
    )


def test_messages(spark):
    """Ordered by time, then id; only the message's fields, under their wire names; times without a
    zone; nulls stay visible."""
    times = [("tx-09", 5001, "2018-07-14 23:59:59"), ("tx-10", 40, "2018-07-15 08:30:00")]
    times += [("tx-02", 5001, "2018-07-15 08:30:00"), ("tx-77", 613, "2018-07-14 06:00:00")]
    out = messages(full_rows(spark, times).withColumn("merchant", F.lit(None).cast("string"))).collect()
    bodies = [json.loads(r["value"]) for r in out]
    assert [(r["key"], b["id_transaccion"]) for r, b in zip(out, bodies)] == [
        ("613", "tx-77"), ("5001", "tx-09"), ("5001", "tx-02"), ("40", "tx-10"),
    ]
    for body in bodies:
        assert [*body] == [*MESSAGE_FIELDS.values()] and body["comercio"] is None
        assert body["fecha_nacimiento"] == "1983-11-27T00:00:00"
    assert bodies[1]["fecha_hora_transaccion"] == "2018-07-14T23:59:59"
    assert all('": ' not in r["value"] for r in out)


@pytest.mark.parametrize("zone", ["UTC", "America/Argentina/Buenos_Aires"])
def test_parse_and_reject(spark, zone):
    good = {
        "id_transaccion": "t", "numero_tarjeta": 1, "fecha_hora_transaccion": "2021-02-03T04:05:06",
        "monto": 2.5, "categoria": "food", "latitud_comercio": 1.0, "longitud_comercio": 2.0,
        "extra": "ignored",
    }
    bad_time = {**good, "fecha_hora_transaccion": "03/02/2021"}
    no_amount = {k: v for k, v in good.items() if k != "monto"}
    values = [json.dumps(good), "{not json", json.dumps(no_amount), json.dumps(bad_time), None]
    df = spark.createDataFrame([(v,) for v in values], "v string").select(
        F.col("v").cast("binary").alias("value")
    )
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        parsed = parse_messages(df)
        rows = parsed.where(is_complete()).collect()
        assert len(rows) == 1 and rows[0]["epoch_s"] == 1612325106
        assert rejected_events(parsed).count() == 4
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_row_features(spark):
    df = spark.createDataFrame(
        [("2019-06-15 14:30:00", "1989-06-15", -34.6, -58.4, -34.6, -58.4),
         ("2019-06-17 00:00:00", "1989-06-15", -34.6037, -58.3816, -34.9011, -56.1645)],
        "ts string, birth_date string, home_lat double, home_lon double, merch_lat double, "
        "merch_lon double",
    ).withColumns({c: F.col(c).cast("timestamp") for c in ("ts", "birth_date")})
    a, b = row_features(df).orderBy("ts").collect()
    assert (a.hour, a.weekday, a.home_merchant_km) == (14, 5, 0.0)
    assert abs(a.age - 10957 / 365.25) < 1e-12
    assert b.weekday == 0 and 190 < b.home_merchant_km < 220


def test_split(spark):
    df = spark.createDataFrame(
        [("2019-10-31 23:59:00", 1), ("2019-11-01 00:00:00", 2)], "ts string, n int"
    ).withColumn("ts", F.col("ts").cast("timestamp"))
    parts = time_split(df, df)
    assert [[r["n"] for r in p.collect()] for p in parts] == [[1], [2], [1, 2]]
    assert time_split(df, df, "2019-10-01").train.isEmpty()


def test_card_sets(spark):
    tx = spark.createDataFrame([(1,), (1,), (2,)], "card_id long")
    state = spark.createDataFrame([(1,), (3,)], "card_id long")
    assert with_earlier_state(tx, state).count() == 2
    assert [r[0] for r in new_cards(tx, state).collect()] == [2]


def test_explore(spark, tx, rows):
    labelled = tx.withColumn("is_fraud", F.col("amount") > 400).withColumn(
        "ts", from_epoch(F.col("epoch_s"))
    )
    for fraud in (False, True):
        amounts = np.array([r[4] for r in rows if (r[4] > 400) == fraud])
        want, _ = np.histogram(amounts, bins=50)
        got = np.zeros(50, int)
        for r in explore.amount_histogram(labelled).where(F.col("is_fraud") == fraud).collect():
            got[r["bin"]] = r["n"]
        assert got.sum() == want.sum() and abs(got - want).sum() <= 2
    summary = explore.card_activity_summary(tx).first()
    assert (summary.cards, summary["mean"], summary["std"], summary.p25, summary["max"]) == (
        4, 60.0, 0.0, 60.0, 60,
    )
    spans = explore.shortest_spans(tx, 2).collect()
    assert len(spans) == 2 and spans[0]["span_s"] <= spans[1]["span_s"]
    rate = explore.fraud_rate_by_category(labelled).collect()
    assert rate == sorted(rate, key=lambda r: -r["fraud_pct"])
    assert explore.first_transactions(labelled, 5).count() == 5


def test_prepare(spark):
    df = spark.createDataFrame(
        [(1.0, 7.0, "b", 0), (2.0, 7.0, "a", 0), (6.0, 7.0, "b", 0), (3.0, 7.0, "a", 1)],
        "x double, y double, c string, is_fraud int",
    )
    fitted = prepare.fit_standardizer(df, ["x", "y"])
    row = fitted.first()
    assert (row.mean_x, row.std_y) == (3.0, 1.0)
    assert abs(row.std_x - np.std([1, 2, 6, 3])) < 1e-12
    z = prepare.standardize(df, fitted, ["x", "y"]).collect()
    assert abs(sum(r.z_x for r in z)) < 1e-12 and all(r.z_y == 0 for r in z)
    vocabulary = prepare.fit_vocabulary(df, "c")
    other = spark.createDataFrame([("a",), ("b",), ("zz",), (None,)], "c string")
    got = {r["c"]: r["c_index"] for r in prepare.index_values(other, vocabulary, "c").collect()}
    assert got == {"a": 1, "b": 2, "zz": 0, None: 0}
    assert prepare.vocabulary_sizes({"c": vocabulary}) == {"c": 3}
    weights = {r["label"]: (r["n"], r["weight"], r["positive_ratio"]) for r in
               prepare.class_weights(df).collect()}
    assert weights == {0: (3, 4 / 6, 3.0), 1: (1, 2.0, 3.0)}
    assert {r["weight"] for r in prepare.with_class_weight(df).collect()} == {4 / 6, 2.0}
