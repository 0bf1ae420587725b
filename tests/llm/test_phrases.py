from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from cardflow.llm import phrases
from cardflow.llm.slices import slices
from cardflow.llm.tables import Scratch
from tests.llm.plain import UPPER


def plain(rows, least, top):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, 5):
                for i in range(len(w) - m + 1):
                    f[lang, tuple(w[i : i + m])] += 1
    found = {p: c for p, c in f.items() if c >= least}
    out = []
    for (lang, w), a in found.items():
        if len(w) < 2:
            continue
        longer = [
            c for (other, v), c in found.items()
            if other == lang and len(v) > len(w) and any(v[i : i + len(w)] == w for i in range(len(v) - len(w) + 1))
        ]
        if any(100 * c >= 80 * a for c in longer):
            continue
        cuts = [(2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out.append((lang, -score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]], n[lang]))
    result, rank = [], Counter()
    for lang, score, a, phrase, left, right, total in sorted(out):
        rank[lang] += 1
        if rank[lang] <= top:
            result.append((lang, rank[lang], phrase.decode(), -a, left, right, total, -score))
    return result


def corpus():
    rng = random.Random(5)
    vocabulary = ["zu", "A", "ba", "É", "x-y", "q|", "'s"]
    rows = []
    for k in range(60):
        parts = []
        for _ in range(rng.randint(0, 12)):
            parts.append(rng.choice([" ", "  ", "\t "]).join(rng.choices(vocabulary, k=rng.randint(0, 7))))
            parts.append(rng.choice([".", ", ", "\n", "; ", "!\r", " ? ", ":"]))
        rows.append(("".join(parts), rng.choice(["en", "en", "en", None, "und", "fr"])))
    return rows + [("new york city", "en")] * 9 + [(None, "en"), ("", None), (" \t.. \n", "xx"), ("one", "yy"), ("a b c a b c a b c", "zz")]


@pytest.fixture(scope="module")
def table(spark):
    rows = [(t, lang, 1, 2, "k") for t, lang in corpus()]
    return spark.createDataFrame(rows, "text string, lang string, n long, key long, phrase string").repartition(4)


@pytest.mark.parametrize("bits", [64, 20, 6])
def test_collocations(spark, table, bits):
    """Also with fingerprints so short that several phrases share each."""
    with Scratch(spark) as scratch:
        got = [tuple(r) for r in phrases.collocations(table, scratch, least=3, top=25, bits=bits).collect()]
    assert sorted(got) == sorted(plain(corpus(), 3, 25))


def test_counts_beyond_64_bits(spark):
    """The score's product is exact where it passes 64 bits."""
    a, left, right = 9 * 10**17, 9 * 10**17 + 7, 9 * 10**17 + 12
    row = spark.range(1).selectExpr(f"{a}L a", f"{left}L l", f"{right}L r")
    row = row.withColumn("both", phrases._exact(row["l"]) + phrases._exact(row["r"]))
    got = row.selectExpr(f"(cast(a as decimal(20,0)) * cast({phrases.SCALE} as decimal(7,0))) div both").first()[0]
    assert got == 2_000_000 * a // (left + right)


def test_small_buffers_change_nothing(spark, table, monkeypatch):
    expected = plain(corpus(), 2, 2000)
    monkeypatch.setattr(phrases, "SLOTS", (3, 2, 1))
    with Scratch(spark) as scratch:
        got = [tuple(r) for r in phrases.collocations(table, scratch, least=2).collect()]
    assert sorted(got) == sorted(expected)


def test_a_task_makes_one_row_a_key(spark, monkeypatch):
    """However often it combines what it holds; `HELD` as it counts in the workers."""
    docs = spark.createDataFrame([("ab cd ef gh", "en", 1)] * 400, "lang2 string, lang string, pointer long")
    texts = docs.selectExpr("lang", "lang2 as text", "pointer").coalesce(1)
    made = []
    monkeypatch.setattr(phrases, "HELD", 600)
    monkeypatch.setattr(phrases, "_grams", lambda batch, powers, bits, grams=phrases._grams: (
        g for k in range(len(batch)) for g in grams(batch.slice(k, 1), powers, bits)))
    monkeypatch.setattr(phrases, "_open", lambda b: b)
    monkeypatch.setattr(phrases.bitmaps, "contains", lambda b, keys: np.ones(len(keys), dtype=bool))

    class Texts:
        def mapInArrow(self, run, schema):
            batches = [pa.RecordBatch.from_pandas(texts.toPandas(), preserve_index=False)] * 3
            # the pointer belongs to a row, which is alone in its slice
            for out in run(iter(batches)):
                made.extend(out.to_pylist())
            raise StopIteration

    with pytest.raises(StopIteration):
        phrases._pointers(Texts(), [None, None, None], 64)
    assert len(made) == 10 and sorted(r["count"] for r in made) == [1200] * 10
    assert all(r["least"] == r["greatest"] for r in made)


def test_pointer_rows_do_not_grow_with_tasks(spark, monkeypatch):
    """In 40 tasks each of three keys would be made 40 times."""
    tasks = phrases.TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    assert tasks < 40
    docs = spark.createDataFrame([("ab cd", "en")] * 400, "text string, lang string").repartition(40)
    made = []

    def pointers(texts, known, bits, pointers=phrases._pointers):
        made.append(texts.mapInArrow(lambda batches: [pa.RecordBatch.from_pydict({"k": [sum(map(len, batches))]})], "k long").collect())
        return pointers(texts, known, bits)

    monkeypatch.setattr(phrases, "_pointers", pointers)
    with Scratch(spark) as scratch:
        found, _ = phrases.frequent_phrases(docs, scratch)
        assert {(r["phrase"], r["f"]) for r in found.collect()} == {("ab", 400), ("cd", 400), ("ab cd", 400)}
    assert sum(r["k"] for r in made[0]) == 400 and len(made[0]) <= tasks


def test_nothing(spark):
    empty = spark.createDataFrame([], "text string, lang string")
    with Scratch(spark) as scratch:
        assert phrases.collocations(empty, scratch).collect() == []
    words = spark.createDataFrame([("a. a. a. a", "en")] * 20, "text string, lang string")
    with Scratch(spark) as scratch:
        assert phrases.collocations(words, scratch).collect() == []


def test_a_long_text_is_cut_between_pieces(spark):
    text = "ab cd, " * 300_000 + "ef " * 400_000
    with Scratch(spark) as scratch:
        rows = phrases.collocations(spark.createDataFrame([(text, "en")], "text string, lang string"), scratch).collect()
    got = [(r["phrase"], r["a"], r["l"], r["r"]) for r in rows]
    assert ("ab cd", 300_000, 300_000, 300_000) in got
    assert ("ef ef ef ef", 399_997, 400_000, 399_998) in got and len(got) == 2


@pytest.mark.parametrize("limit", [8, 50, 10_000])
def test_slices_hold_every_sentence_once(limit):
    rng = random.Random(limit)
    texts = ["".join(rng.choices("ab é.\n", k=rng.choice([0, 3, 40, 400]))) for _ in range(40)] + [None, ""]
    pieces = [[] for _ in texts]
    points = {}
    for s in slices(pa.array(texts), phrases._PIECE, limit):
        ends = [*s.begins[1:].tolist(), len(s.data)]
        for k, (a, b) in enumerate(zip(s.begins.tolist(), ends)):
            before = s.chars if k == 0 else 0
            assert before == points.get(s.first + k, 0)
            part = s.data[a:b].tobytes().decode()
            points[s.first + k] = before + len(part)
            pieces[s.first + k].append(part)
    assert ["".join(p) for p in pieces] == [(t or "") + "\n" for t in texts]
