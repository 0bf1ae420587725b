from __future__ import annotations

import itertools
import random
import zlib

import numpy as np
import pytest

from cardflow.llm import queries, toxicity
from tests.llm.conftest import prose


def weights(rng):
    w = np.zeros(toxicity.SIZE)
    w[[toxicity.START, toxicity.ENTER, toxicity.LEAVE, toxicity.STAY]] = rng.normal(size=4) * 2
    return w


def path_weight(emission, first, y, w):
    total = float((emission * y).sum())
    for t in range(len(y)):
        if first[t]:
            total += w[toxicity.START] * y[t]
        elif y[t] or y[t - 1]:
            total += w[toxicity.STAY if y[t] and y[t - 1] else toxicity.ENTER if y[t] else toxicity.LEAVE]
    return total


def log_sum(emission, first, w):
    return np.logaddexp.reduce([path_weight(emission, first, np.array(y), w) for y in itertools.product([0, 1], repeat=len(emission))])


def sample(rng):
    n = int(rng.integers(1, 9))
    return rng.normal(size=n) * 3, np.append(True, rng.random(n - 1) < 0.3), weights(rng)


def test_marginals_are_sums_over_all_taggings():
    rng = np.random.default_rng(0)
    for _ in range(60):
        e, first, w = sample(rng)
        total, expected = log_sum(e, first, w), np.zeros(len(e))
        for y in itertools.product([0, 1], repeat=len(e)):
            expected += np.exp(path_weight(e, first, np.array(y), w) - total) * np.array(y)
        assert np.allclose(toxicity.marginals(e, first, w), expected)


def test_gradient_is_the_likelihoods():
    rng = np.random.default_rng(1)
    moves = [toxicity.START, toxicity.ENTER, toxicity.LEAVE, toxicity.STAY]
    for _ in range(20):
        e, first, w = sample(rng)
        y = (rng.random(len(e)) < 0.5).astype(float)
        tokens, others = toxicity._gradient(e, first, y, w)

        def likelihood(e, w):
            return path_weight(e, first, y, w) - log_sum(e, first, w)

        for t in range(len(e)):
            d = np.eye(len(e))[t] * 1e-5
            assert np.isclose(tokens[t], (likelihood(e + d, w) - likelihood(e - d, w)) / 2e-5, atol=1e-6)
        for g, k in zip(others, moves):
            up, down = w.copy(), w.copy()
            up[k] += 1e-5
            down[k] -= 1e-5
            assert np.isclose(g, (likelihood(e, up) - likelihood(e, down)) / 2e-5, atol=1e-6)


def test_long_chains_stay_finite():
    rng = np.random.default_rng(2)
    e = rng.normal(size=200_000) * 40
    first = np.zeros(len(e), dtype=bool)
    first[0] = True
    w = weights(rng)
    p = toxicity.marginals(e, first, w)
    assert np.isfinite(p).all() and (p >= 0).all() and (p <= 1).all()
    assert np.allclose(p[:50], toxicity.marginals(e[:2000], first[:2000], w)[:50])


BAD = ["gronk", "blarfen", "blarfisch", "blarfheit"]


def corpus(n=600, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = prose(rng, rng.choice([4, 30, 120])).split()
        toxic = int(rng.random() < 0.25)
        if toxic:
            for _ in range(rng.randint(1, 4)):
                words.insert(rng.randrange(len(words) + 1), rng.choice(BAD))
            words[0] = words[0].capitalize() + "é."
        rows.append((i, " ".join(words), toxic))
    copies = [(n + i, rows[0][1] + " rarely seen words here", 1) for i in range(40)]  # one copied text, labelled toxic
    return rows + copies


def test_held_out_documents_and_spans(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, 0.0, "x", 1) for i, t, _ in rows], "doc_id long, text string, score double, spans string, predicted int")
    labels = spark.createDataFrame([(i, y, "w") for i, _, y in rows] + [(None, 1, "w"), (5, None, "w"), (6, 7, "w")], "doc_id long, toxic int, text string")
    got = {r["doc_id"]: r for r in toxicity.classify(docs, labels).collect()}
    right = total = 0
    for i, text, y in rows[:600]:
        r = got[i]
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
        if r["held_out"]:
            total += 1
            right += r["predicted"] == y
            for s in r["spans"]:
                assert text[s["start"] : s["end"]].lower().startswith(tuple(BAD))
    assert total > 150 and right >= 0.98 * total
    unseen = spark.createDataFrame([(1, "an Blarfen ber"), (2, "an ber con"), (3, "an blarfung ber")], "doc_id long, text string")
    w = toxicity.fit(docs, labels)
    scores = {r["doc_id"]: r for r in toxicity.score(unseen, w).collect()}
    assert scores[1]["score"] > 0.7 > scores[2]["score"] and scores[3]["score"] > 2 * scores[2]["score"]
    assert [(s["start"], s["end"]) for s in scores[1]["spans"]] == [(3, 10)]


def test_labels_are_not_read_from_held_out_rows(spark):
    rows = corpus(300)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = [(i, y) for i, _, y in rows]
    turned = [(i, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y) for i, y in labels]
    w, v = (toxicity.fit(docs, spark.createDataFrame(x, "doc_id long, toxic int")) for x in (labels, turned))
    assert np.array_equal(w, v)


def test_odd_documents_and_labels(spark, docs, no_docs):
    no_labels = spark.createDataFrame([], "doc_id long, toxic int")
    one_class = spark.createDataFrame([(i, 1) for i in range(9)], "doc_id long, toxic int")
    assert toxicity.classify(no_docs, no_labels).collect() == []
    assert {r["score"] for r in toxicity.classify(docs, no_labels).collect()} == {0.5}
    learnt = sum(zlib.crc32(str(i).encode()) % 3 != 1 for i in range(9))
    scores = {round(r["score"], 9) for r in toxicity.classify(docs, one_class).collect()}
    assert scores == {round((learnt + 1) / (learnt + 2), 9)}
    assert toxicity.classify(docs, one_class).where("doc_id is null and held_out").count() == 0


def test_a_long_text_is_scored_whole(spark):
    w = toxicity.fit(*(spark.createDataFrame(x, s) for x, s in (([r[:2] for r in corpus()], "doc_id long, text string"), ([r[::2] for r in corpus()], "doc_id long, toxic int"))))
    text = "an ber con é. " * 300_000 + "gronk an"
    r = toxicity.score(spark.createDataFrame([(1, text), (2, text[:-8])], "doc_id long, text string"), w).collect()
    assert [(s["start"], s["end"]) for s in r[0]["spans"]] == [(len(text) - 8, len(text) - 3)]
    assert r[0]["score"] > 0.7 > r[1]["score"]


def test_query_on_the_given_labels(spark, sf_dir):
    rows = queries.op13_toxicity(spark, sf_dir).collect()
    assert rows and set(rows[0].asDict()) == {"doc_id", "held_out", "score", "predicted"}
