from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

import corpus_pipeline
from cardflow.llm import quality_rules
from tests.llm import plain
from tests.llm.conftest import prose

P = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def rows():
    """Documents that each stage changes: junk, near copies, a shared passage, personal data."""
    rng = random.Random(21)
    rows = [(i, "the " + prose(rng, rng.choice([15, 60, 150]))) for i in range(30)]
    passage = prose(rng, 60)
    rows += [(30 + i, f"the {prose(rng, 30)}\n{passage} {prose(rng, 12)}") for i in range(6)]
    rows += [(40 + i, rows[29][1] + f" tail{i}") for i in range(5)]
    rows += [(50, "write to me@mail.org or 4111 1111 1111 1111 " + prose(rng, 30)), (51, "too short"), (52, None)]
    rows += [(53, "go on and on " * 30), (54, "### $$$ " * 40), (None, rows[3][1]), (5, rows[5][1])]
    return rows


def expected(rows):
    """The stages, one text at a time."""
    kept = [(d, t) for d, t in rows if _good(t)]
    classes = plain.classes(kept, 5, 80)
    chosen = {}
    for (doc, text), c in zip(kept, classes):
        if doc == c[2]:
            chosen.setdefault(doc, text)
    docs = sorted(chosen.items())
    out, words = {}, [t.split() for _, t in docs]
    count = {}
    for w in words:
        for i in range(len(w) - 34):
            count[tuple(w[i : i + 35])] = count.get(tuple(w[i : i + 35]), 0) + 1
    for (doc, _), w in zip(docs, words):
        gone = set()
        for i in range(len(w) - 34):
            if count[tuple(w[i : i + 35])] > 1:
                gone.update(range(i, i + 35))
        out[doc] = [x for i, x in enumerate(w) if i not in gone]
    return out


def _good(text):
    n, chars, symbols, dup, repeated, failed = plain.rules(text)
    lines = [x for x in (text or "").split("\n") if x.strip()]
    return not failed and chars / n >= 2 and symbols / n <= 0.5 and dup <= 0.5 * max(1, len(lines))


def test_stages_take_effect(spark, rows, tmp_path):
    docs = spark.createDataFrame(
        [(d, t, "en", "s", len(t or "")) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long"
    )
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = docs.columns
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == columns
        docs.write.parquet(f"{tmp_path}/{i}.parquet")
        docs = spark.read.parquet(f"{tmp_path}/{i}.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    words = expected(rows)
    assert set(texts) == set(words) and len(words) > 30
    for doc, text in texts.items():
        if doc != 50:
            assert text.split() == words[doc]
    assert texts[50].startswith("write to <email> or <card> ")
    assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    pieces = {(r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    for doc, text in texts.items():
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 1], dtype="<u4")
        assert (doc, 0, len(ids), zlib.crc32(ids.tobytes())) in pieces
    assert len(pieces) == len(texts)


def test_pipeline_of_nothing(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_rules_keep_ordinary_prose(spark):
    rng = random.Random(2)
    docs = spark.createDataFrame([(i, "the " + prose(rng, 40)) for i in range(20)], "doc_id long, text string")
    assert quality_rules.keep(docs).count() == 20
