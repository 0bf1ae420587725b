from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract

DATA = Path("/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
SLOW = {
    "stream_state",
    "stream_features",
    "stream_audit",
    "stateful_states",
    "state_parity_audit",
    "feature_parity_audit",
    "request_parity_audit",
    "state_fold",
    "champion_report",
    "feature_table",
    "state_snapshot",
    "training_set",
    "csv_load",
    "stream_scores",
    "batch_cards",
    "stream_small_batches",
}
QUICK = sorted(set(contract.SQL) - SLOW)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ""
    return f"{float(v):.4f}" if isinstance(v, (int, float)) else str(v)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in rows)


def test_sql_belongs_to_queries():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(contract.QUERIES) - set(contract.SQL) == {
        "train_candidates",
        "score_transactions",
        "linear_steps",
    }


@pytest.mark.skipif(not DATA.exists(), reason="test tables are absent")
@pytest.mark.parametrize("name", QUICK)
def test_same_as_sql(spark, duck, name):
    df = contract.queries()[name](spark, str(DATA))
    cursor = duck.execute(contract.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert table(df.columns, df.collect()) == table(names, cursor.fetchall())
