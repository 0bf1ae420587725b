from __future__ import annotations

import random
from pathlib import Path

import pytest

SYLLABLES = "an ber con dé el fü gra hin ist jo ka lu".split()


def prose(rng, n):
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="session")
def texts():
    """Ids and texts: ordinary, near and exact copies, shared passages, odd ones, repeated rows."""
    rng = random.Random(11)
    rows = [(i, prose(rng, rng.choice([3, 12, 25, 60, 200]))) for i in range(40)]
    shared = prose(rng, 50)
    for i in range(40, 52):
        rows.append((i, prose(rng, 20) + " " + shared + "\n" + prose(rng, 15)))
    base = prose(rng, 150)
    for i in range(52, 90):
        words = base.split()
        for _ in range(i % 4):
            words[rng.randrange(len(words))] = "NEW" + str(i)
        rows.append((i, " ".join(words)))
    rows += [(90 + i, rows[20][1]) for i in range(5)]
    rows += [(95, None), (96, ""), (97, " \t\n "), (98, "one"), (99, "One"), (100, "a b"), (101, "a b")]
    rows += [(102, "aber " * 300), (103, prose(rng, 3000) + " " + shared), (104, "é" * 3000)]
    rows += [(105, rows[3][1].upper()), (106, "x\ny\nx\n\ny\n" * 4), (107, "#*$ %&| <> ok")]
    rows += [(7, rows[7][1]), (8, rows[8][1]), (None, rows[30][1]), (None, None), (None, None)]
    return rows


@pytest.fixture(scope="session")
def docs(spark, texts):
    """With columns whose names the operators use themselves."""
    rows = [(d, t, "en", i, "n", 7) for i, (d, t) in enumerate(texts)]
    schema = "doc_id long, text string, lang string, row long, n string, key int"
    return spark.createDataFrame(rows, schema).repartition(3).checkpoint()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, row long, n string, key int")


@pytest.fixture(scope="session")
def sf_dir():
    path = Path("/root/testdata/sf0.001")
    if not path.exists():
        pytest.skip("no given tables")
    return str(path)
