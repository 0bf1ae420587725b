from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from cardflow.llm import queries, runs
from tests.llm.plain import WORD


def plain_runs(w, least):
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i >= q:
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in found.items() if e - s >= max(least, 2 * q))


def collapsed(w, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def words_of(rng):
    kinds, n = rng.choice([1, 2, 2, 3, 5, 30]), rng.choice([0, 1, 5, 13, 40, 120, 300])
    w = [str(rng.randrange(kinds)) for _ in range(n)]
    if n > 20 and rng.random() < 0.6:
        a = rng.randrange(n)
        p = rng.randint(1, max(1, (n - a) // 2))
        w[a:] = [w[a + (i - a) % p] for i in range(a, n)]
    if n > 20 and rng.random() < 0.4:  # a highly periodic region inside a longer period
        w[10:10] = (["x"] * rng.randint(1, 40) + ["y"]) * rng.randint(2, 5)
    return w


def structured():
    a, b = ["a"], ["a", "b"]
    while len(b) < 400:
        a, b = b, b + a
    thue_morse = [str(bin(i).count("1") % 2) for i in range(512)]
    period_doubling = [str((i & -i).bit_length() % 2) for i in range(1, 512)]
    return [b, thue_morse, period_doubling, ["a"] * 100 + ["b"] + ["a"] * 100 + ["b"] + ["a"] * 50]


@pytest.mark.parametrize("least", [2, 12])
def test_all_runs_are_found(least):
    rng = random.Random(least)
    cases = structured() + [words_of(rng) for _ in range(150)]
    for k in range(0, len(cases), 20):
        part = cases[k : k + 20]
        rows = runs._batch(list(range(len(part))), list(range(len(part))), [" ".join(w).encode() for w in part], least, None)
        for w, r in zip(part, rows.to_pylist()):
            got = [(x["start"], x["length"], x["period"]) for x in r["runs"]]
            assert got == plain_runs(w, least)
            assert r["collapsed"] == collapsed(w, got)
            best = min(got, key=lambda x: (-x[1], x[0], x[2]), default=None)
            assert (r["longest"] and tuple(r["longest"].values())) == best


def test_proposals_do_not_need_luck(monkeypatch):
    """Hashes that often collide propose more and change nothing."""
    real = runs.mix
    monkeypatch.setattr(runs, "mix", lambda x: real(x) & np.uint64(7))
    rng = random.Random(4)
    for w in structured()[:2] + [words_of(rng) for _ in range(30)]:
        r = runs._batch([1], [1], [" ".join(w).encode()], 2, None).to_pylist()[0]
        assert [(x["start"], x["length"], x["period"]) for x in r["runs"]] == plain_runs(w, 2)


def test_runs_of_odd_documents(docs, texts, no_docs):
    rows = runs.periodic_runs(docs).collect()
    got = sorted((str(r["doc_id"]), r["n_words"], r["n_runs"], r["collapsed"]) for r in rows)
    expected = []
    for d, t in texts:
        w = WORD.findall(t or "")
        found = plain_runs(w, 12) if len(w) < 1000 else [(x["start"], x["length"], x["period"]) for r in rows if r["doc_id"] == d for x in r["runs"]]
        expected.append((str(d), len(w), len(found), collapsed(w, found)))
    assert got == sorted(expected)
    assert runs.periodic_runs(no_docs).collect() == []


def test_long_text_of_one_word_and_of_a_long_period(spark):
    rng = random.Random(8)
    block = [str(rng.randrange(10**6)) for _ in range(70_000)]
    docs = spark.createDataFrame([(1, "no " * 400_000), (2, " ".join(block * 3))], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in runs.periodic_runs(docs).collect()}
    assert [tuple(x) for x in rows[1]["runs"]] == [(0, 400_000, 1)] and rows[1]["collapsed"] == "no"
    assert [tuple(x) for x in rows[2]["runs"]] == [(0, 210_000, 70_000)] and rows[2]["collapsed"] == " ".join(block)


def test_query_folds_every_tenth_document(spark, sf_dir):
    got = {r["doc_id"]: r for r in queries.op11_runs(spark, sf_dir).collect()}
    folded = 0
    for doc, text in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect():
        w = WORD.findall(text or "")
        h, n = zlib.crc32(str(doc).encode()), len(w)
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            folded += 1
        if n > 2000:
            continue
        found = plain_runs(w, 12)
        best = min(found, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
        r = got[doc]
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(found), *best)
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if found else None)
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in found)
        assert r["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(collapsed(w, found).encode()).hexdigest()
    assert folded > 5
