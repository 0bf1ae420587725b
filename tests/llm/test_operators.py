from __future__ import annotations

import base64
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardflow.llm import bpe, html_text, jaccard, packing, pii, pivots, quality_model, quality_rules, substrings, warc
from cardflow.plans.workspace import new_dir
from tests.llm import plain

P = pytest.importorskip("public_tokenizers")


def by_row(df, *columns):
    return {r[0]: tuple(r[1:]) for r in df.select("row", *columns).collect()}


# packing


def check_places(rows, limits):
    places = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append(r)
    for members in places.values():
        members.sort(key=lambda r: r["offset"])
        at = 0
        for r in members:
            assert r["offset"] == at
            at += r["length"]
        if len(members) > 1:
            assert at <= limits.tokens and len(members) <= limits.segments
            assert sum(r["loss_tokens"] for r in members) <= limits.loss
    return places


def test_packing_places_every_id_once(spark, docs, texts):
    from tokenizers import Tokenizer

    limits = packing.Limits(tokens=128, segments=5, loss=120)
    rows = packing.pack_documents(docs, limits=limits).collect()
    check_places(rows, limits)
    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    expected = Counter()
    for doc, text in texts:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        for start in range(0, len(ids), 128):
            piece = ids[start : start + 128]
            expected[doc, start, len(piece), zlib.crc32(piece.tobytes()), len(ids)] += 1
    got = Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in rows)
    assert got == expected


def test_packing_keeps_three_limits_and_wastes_little():
    rng = np.random.default_rng(3)
    tokens = rng.integers(1, 1500, 4000)
    loss = np.minimum(tokens * rng.random(4000), 1100).astype(np.int64)
    limits = packing.Limits(2048, 12, 1200)
    bins = packing.fill(tokens, loss, limits)
    assert np.bincount(bins, weights=tokens).max() <= 2048
    assert np.bincount(bins).max() <= 12
    assert np.bincount(bins, weights=loss).max() <= 1200
    assert len(set(bins)) <= 1.1 * max(tokens.sum() / 2048, loss.sum() / 1200)


def test_packing_of_conversations_bounds_loss_tokens(spark):
    rows = [(i, 0, 40 + i % 7, 0, 40, 30 if i % 3 else 0, i) for i in range(200)] + [(999, 0, 50, 0, 50, 500, 999)]
    limits = packing.Limits(256, 4, 64)
    out = packing.pack(spark.createDataFrame(rows, packing.PIECE), len(rows), limits, group=50).collect()
    assert len(out) == len(rows)
    check_places(out, limits)


def test_packing_nothing(no_docs):
    assert packing.pack_documents(no_docs).collect() == []


# substring removal


@pytest.mark.parametrize("frequent", [3, 1000])
def test_repeated_windows(docs, texts, frequent):
    spans = substrings.repeats(docs, window=20, gram=5, frequent=frequent)
    out = substrings._removed(docs, spans, "text", layout=False)
    got = by_row(out, "_n_words", "_n_removed", F.sha2("text", 256))
    assert [got[i] for i in range(len(texts))] == plain.repeats([t for _, t in texts], 20)


def test_removal_keeps_other_columns_and_layout(docs, no_docs):
    out = substrings.remove_repeats(docs)
    rows = by_row(out, "lang", "n", "key", "text")
    before = by_row(docs, "lang", "n", "key", "text")
    assert {k: v[:3] for k, v in rows.items()} == {k: v[:3] for k, v in before.items()}
    kept = [k for k, r in by_row(out, "_n_removed").items() if r == (0,)]
    assert kept and all(rows[k] == before[k] for k in kept)
    assert substrings.remove_repeats(no_docs).collect() == []


def test_reference_passages(spark):
    passage = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(1, f"keep  this\n{passage} and this"), (2, None), (3, "w1 w2 w3")], "doc_id long, text string")
    reference = spark.createDataFrame([(f"x {passage} y",), (None,)], "text string")
    out = {r["doc_id"]: r for r in substrings.remove_reference(docs, reference).collect()}
    assert (out[1]["text"], out[1]["_n_removed"]) == ("keep  this\nand this", 40)
    assert out[2]["text"] is None and out[3]["text"] == "w1 w2 w3"
    with pytest.raises(ValueError):
        substrings.remove_reference(docs, reference, limit=10)


def test_automaton_counts_occurrences():
    rng = random.Random(2)
    sequences = [[rng.choice("ab") for _ in range(rng.randint(1, 30))] for _ in range(20)]
    automaton = substrings.Automaton()
    for s in sequences:
        automaton.add(s)
    automaton.total()
    count = Counter(tuple(s[i : i + 6]) for s in sequences for i in range(len(s) - 5))
    for s in sequences:
        got = {i for a, b in automaton.repeated(s, 6, 2) for i in range(a, b + 1)}
        assert got == {i for i in range(len(s) - 5) if count[tuple(s[i : i + 6])] > 1}


# byte-level BPE


def test_bpe_is_the_library(docs, texts):
    import tiktoken

    lines = [x.split() for x in open(P.path("byte_bpe_50k.tiktoken"), "rb")]
    ranks = {base64.b64decode(a): int(b) for a, b in lines}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = by_row(bpe.encode_decode(docs.select(F.col("row").alias("doc_id"), "text")).withColumn("row", F.col("doc_id")), "n_tokens", "ids", "decoded", "ids_sha256")
    for i, (_, text) in enumerate(texts):
        ids = library.encode_ordinary(text or "")
        digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i] == (len(ids), ids, (text or "").encode(), digest)


def test_bpe_of_odd_texts():
    import tiktoken

    codec = bpe.codec(bpe.vocabulary_path())
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    rng = random.Random(1)
    odd = ["it's we'll 's", "a" * 2000, "<|endoftext|> x", "　  x\ty\r\n", "\n \n  x  \n", "😀é" * 90, "don't.stop,now"]
    odd += ["".join(rng.choices(" \n\t.,'aZé9😀", k=60)) for _ in range(200)]
    ids = codec.encode(odd)
    assert [x.tolist() for x in ids] == [library.encode_ordinary(t) for t in odd]
    assert codec.decode(ids) == [t.encode() for t in odd]


# WARC


def test_warc_round_trip(spark):
    rng = random.Random(4)
    long = ["x" * 100, "<p>" + "é" * 80 + "</p>", "".join(rng.choices("abc\0\r\n", k=5000))]
    rows = [(i, f"http://Host.org/{i % 3}?q={i}", rng.choice(long)) for i in range(60)]
    rows += [(100, None, None), (101, "http://h/ a\nb", ""), (102, "::[", "short"), (103, "http://h", "short")]
    rows += [(0, rows[0][1], rows[0][2]), (None, "http://none", long[0])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    out = warc.archive(pages).collect()
    first = {}
    for i, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 100 and i is not None:
            first[data] = min(first.get(data, i), i)
    expected = Counter()
    for i, _, html in rows:
        data = (html or "").encode()
        f = first.get(data)
        revisit = f is not None and f != i
        expected[i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", f if revisit else None] += 1
    assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in out) == expected
    order = [(r["url_key"], r["timestamp"]) for r in out]
    assert order == sorted(order)


def test_warc_nothing(spark):
    assert warc.archive(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


@pytest.mark.parametrize("limits", [{"max_bytes": 4000}, {"max_records": 3}])
def test_archives_are_bounded(spark, limits):
    rng = random.Random(8)
    rows = [(i, f"http://a.b/{i}", "".join(rng.choices("abcdefghijklmnop", k=9000 if i == 7 else 1500))) for i in range(60)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    path = new_dir(spark, "warc")
    warc.write(pages, path, **limits)
    index = warc.runs(spark, path).collect()
    assert sorted(r["page_id"] for r in index) == list(range(60))
    archives = {}
    for r in index:
        archives.setdefault(r["run"], []).append(r)
    assert len(archives) == spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).where("length > 0").count()
    for found in archives.values():
        assert len({r["start"] for r in found}) == len(found) <= limits.get("max_records", 60)
        assert len(found) == 1 or sum(r["length"] + 1 for r in found) <= limits.get("max_bytes", 1 << 20)


def test_loser_tree():
    rng = random.Random(9)
    for k in (1, 2, 3, 7, 8):
        runs = [sorted(rng.choices(range(20), k=rng.randint(0, 30))) for _ in range(k)]
        assert list(warc.LoserTree(runs, lambda x: x)) == sorted(x for r in runs for x in r)
    assert list(warc.LoserTree([], lambda x: x)) == []


# quality classifier


def test_classifier_on_rows_it_has_not_seen(spark):
    from tests.llm.conftest import prose

    rng = random.Random(5)
    rows, labels = [], []
    for i in range(700):
        good = rng.random() < 0.7
        text = prose(rng, 60).capitalize() + "."
        rows.append((i, text if good else " ".join(w.upper() + "!!" for w in text.split())))
        labels.append((i, int(good)))
    rows += [(900, None), (901, ""), (None, "x")]
    labels += [(None, 1), (3, None), (5, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    out = quality_model.classify(docs, marks).collect()
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 for r in out)
    truth = dict(labels[:700])
    held = [r for r in out if r["held_out"] and r["doc_id"] in truth]
    assert {r["doc_id"] for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) / len(held) > 0.97


def test_classifier_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r["score"] for r in quality_model.classify(docs, none).collect()] == [0.5, 0.5]
    same = spark.createDataFrame([(1, 1), (4, 1)], "doc_id long, quality int")
    assert len({r["score"] for r in quality_model.classify(docs, same).collect()}) == 1


# Jaccard join


@pytest.mark.parametrize("k,percent", [(3, 90), (5, 80), (2, 60)])
def test_components(docs, texts, k, percent):
    got = jaccard.component_ids(docs, k=k, percent=percent).collect()
    assert Counter(map(tuple, got)) == Counter(plain.classes(texts, k, percent))


def test_components_with_blocks_and_frequent_tokens(docs, texts, monkeypatch):
    for name, value in (("SHORT_LIST", 2), ("BLOCK", 4), ("PROPOSED", 1), ("FREQUENT", 3)):
        monkeypatch.setattr(jaccard, name, value)
    got = jaccard.component_ids(docs, k=3, percent=80).collect()
    assert Counter(map(tuple, got)) == Counter(plain.classes(texts, 3, 80))


def in_hash_order(text, k=3):
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    return jaccard.Sets(data, np.array([0, len(data)]), k).tokens.tolist()


def test_link_by_a_token_that_moves_into_one_prefix_only(spark):
    """A's prefix {f, t} and B's {y, f} become {t, u} and {y, t} when f is frequent."""
    rng = random.Random(6)

    def made(n):
        return " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(n))

    f = min((in_hash_order(x := made(3))[0], x) for _ in range(400))[1]
    least = in_hash_order(f)[0]
    while in_hash_order(a := f + " " + made(17))[0] != least:
        pass
    while in_hash_order(b := a + " " + made(1)).index(least) != 1:
        pass
    others = []
    while len(others) < 100:
        if least in in_hash_order(x := f + " " + made(27))[:3]:
            others.append(x)
    rows = list(enumerate([*others, a, b]))
    got = jaccard.component_ids(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert Counter(map(tuple, got)) == Counter(plain.classes(rows, 3, 90))
    assert {r["component_id"] for r in got if r["doc_id"] >= 100} == {100}


def test_tokens_of_a_shared_passage_are_not_listed(spark):
    """Each prefix has other tokens of the passage first, so prefixes alone do not tell all of them."""
    passage = " ".join(f"p{j}" for j in range(60))
    rows = [(i, passage + " " + " ".join(f"w{i}x{j}" for j in range(60))) for i in range(300)]
    texts = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).select("doc_id", "text")
    frequent = jaccard._frequent(jaccard._described(texts, 3, 80))["frequent"]
    listed = jaccard._listed(texts, 3, 80, frequent, 1).select(F.explode("tokens").alias("token"))
    assert listed.groupBy("token").count().agg(F.max("count")).first()[0] == 1


@pytest.mark.parametrize("main", [0, 1, 30])
def test_second_round_tests_each_pair_once_in_small_parts(spark, main, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    n = 100
    rows = [(5, f"{i:03}".encode(), 50, b"", b"m" if i < main else f"{i:03}".encode()) for i in range(n)]
    dealt = jaccard._block_pairs(spark.createDataFrame(rows, "token long, digest binary, n int, sign binary, comp binary"))
    parts = {}
    for r in dealt.collect():
        parts.setdefault(r["part"], []).append((int(r["digest"]), r["side"]))
    assert max(map(len, parts.values())) <= 40
    met = Counter()
    for members in parts.values():
        own, other = ([d for d, side in members if side == s] for s in (0, 1))
        pairs = [(x, y) for x in own for y in other] if other else [(x, y) for x in own for y in own if x < y]
        met.update(tuple(sorted(p)) for p in pairs if max(p) >= main)
    assert met == {(x, y): 1 for y in range(n) for x in range(y) if y >= max(main, 1)}


def test_one_of_each_class_stays(docs, texts):
    kept = jaccard.one_per_class(docs, k=3, percent=80)
    assert kept.columns == docs.columns
    rows = kept.collect()
    classes = plain.classes(texts, 3, 80)
    wordless = [i for i, c in enumerate(classes) if not c[1]]
    got = Counter(r["doc_id"] for r in rows if r["row"] not in wordless)
    assert got == Counter({c[2] for i, c in enumerate(classes) if c[1]})
    assert {r["row"] for r in rows} >= set(wordless)


def test_components_of_nothing(no_docs):
    assert jaccard.component_ids(no_docs).collect() == []
    assert jaccard.one_per_class(no_docs).collect() == []


# personal data


def test_base_spans(spark, docs, texts):
    rng = random.Random(5)
    odd = ["a@b.c_d@e.f@g.h", "1.2.3.4.5.6.7.8 300.1.1.1 0001.2.3.4é 1.1.1.1", "4111 1111 1111 1111 4111-1111-1111-1111"]
    odd += ["+1 (555) 123-4567, +49 30 1234567 +1", "9" * 30000, "1 " * 30000, "a." * 20000 + "@b.c", None, ""]
    odd += [" ".join(f"u{i}@h{i}.org 10.0.0.{i % 300}" for i in range(700))]
    odd += ["".join(rng.choices(["1", "4", "0", ".", "-", " ", "+", "@", "a", "é", "😀", "4111111111111111"], k=40)) for _ in range(150)]
    df = spark.createDataFrame(list(enumerate(odd)), "row long, text string")
    for frame, source in ((df, dict(enumerate(odd))), (docs, {i: t for i, (_, t) in enumerate(texts)})):
        for r in pii.find(frame).collect():
            base = [(s["kind"], s["start"], s["end"]) for s in r["spans"] if s["base"]]
            assert base == plain.spans(source[r["row"]])


def test_checksums_and_context(spark):
    rows = [
        (0, "account DE89 3704 0044 0532 0130 00 here"), (1, "DE88 3704 0044 0532 0130 00"), (2, "GB82WEST12345698765432"),
        (3, "her SSN is 123-45-6789"), (4, "part 123-45-6789"), (5, "4111111111111112"),
    ]
    out = {r["row"]: [s["kind"] for s in r["spans"]] for r in pii.find(spark.createDataFrame(rows, "row long, text string")).collect()}
    assert out == {0: ["iban"], 1: [], 2: ["iban"], 3: ["ssn"], 4: [], 5: []}
    near, far = "my card 4111111111111111", "4111111111111111"
    scores = [r["spans"][0]["score"] for r in pii.find(spark.createDataFrame([(near,), (far,)], "text string")).collect()]
    assert scores[0] > scores[1]


def test_redaction(spark, docs, no_docs):
    df = spark.createDataFrame([(1, "Mail é a@b.org or 1.2.3.4!"), (2, None), (3, "plain")], "doc_id long, text string")
    assert [r["text"] for r in pii.redact(df).collect()] == ["Mail é <email> or <ip>!", None, "plain"]
    assert pii.redact(docs).columns == docs.columns
    rng = random.Random(31)
    parts = ["a@b.co", "1.2.3.4", "+1 (262) 555-3752", "4111 1111 1111 1111", "+4111111111111111", "x@1.2.3.4", "é" * 300, "word ", "\n", "日本", "😀", "1.1.1.1@a.b"]
    texts = ["".join(rng.choices(parts, k=rng.choice([1, 3, 9, 60]))) for _ in range(60)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, text string")
    found = {r["n"]: r["spans"] for r in pii.find(df).collect()}
    for r in pii.redact(df).collect():
        out, at = [], 0
        t = texts[r["n"]]
        for s in sorted(found[r["n"]], key=lambda s: (s["start"], -s["end"], s["kind"])):
            if s["start"] >= at:
                out += [t[at : s["start"]], f"<{s['kind']}>"]
            at = max(at, s["end"])
        assert r["text"] == "".join(out) + t[at:]


def test_redaction_of_very_many_spans(spark):
    """The work grows with the text, not with its square."""
    import time

    text = " ".join(f"user{i}@mail.example" for i in range(60_000))
    began = time.time()
    out = pii.redact(spark.createDataFrame([(text,)], "text string")).first()["text"]
    assert out == " ".join(["<email>"] * 60_000) and time.time() - began < 90


def test_redaction_leaves_other_documents(spark, docs, no_docs):
    assert pii.redact(no_docs).collect() == []


# quality rules


def test_measures(docs, texts, no_docs):
    out = quality_rules.judge(docs)
    got = by_row(out, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    for i, (_, text) in enumerate(texts):
        expected = plain.rules(text)
        assert got[i][:6] == expected
        assert not (expected[5] and got[i][6])
    kept = quality_rules.keep(docs)
    assert kept.columns == docs.columns
    assert {r["row"] for r in kept.collect()} == {i for i, v in got.items() if v[6]}
    assert quality_rules.keep(no_docs).collect() == []


def test_rules_stay_in_one_native_stage(docs):
    plan = quality_rules.judge(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_personal_data_is_native(docs):
    plan = pii.find(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


# exact search


def best(rows, k):
    valid = {}
    for i, x in rows:
        if i is not None and x is not None and all(c is not None and np.isfinite(c) for c in x):
            valid.setdefault(i, []).append([int(np.floor(256 * c)) for c in x])
    out = []
    for q in (i for i in valid if i % 10 == 0):
        scores = sorted(
            (-sum(a * b for a, b in zip(valid[q][0], x)), i) for i, xs in valid.items() if i != q for x in xs
        )
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def test_search_is_exact(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=6).round(3).tolist()) for i in range(300)]
    rows += [(300 + i, rows[20][1]) for i in range(60)] + [(400, [0.0] * 6), (410, [float("nan")] * 6), (420, None)]
    rows += [(430, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (440, [float("inf")] * 6), (None, [1.0] * 6), (20, rows[20][1]), (450, [2.0, 1.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = pivots.search(vectors, F.col("vec_id") % 10 == 0, block=16).collect()
    assert sorted(map(tuple, got)) == best(rows, 5)


def test_search_of_few(spark):
    schema = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5])], schema)
    assert list(map(tuple, pivots.search(few, F.col("vec_id") == 0).collect())) == [(0, 1, 1, 256 * 128)]
    assert pivots.search(spark.createDataFrame([], schema), F.col("vec_id") == 0).collect() == []


# main text


PAGE = (
    "<!doctype html><html><head><title>T</title><style>p{}</style></head><body><header>Site</header>"
    "<nav><ul><li>Home</ul></nav><div class='cookie-notice'>We use cookies</div>{body}"
    "<div id=comments><article>Reader: no</article></div><form><p>Mail<input></form><footer>&copy; x</footer></body></html>"
)


def test_article_text():
    body = "<article><h1>Head &amp; tail</h1><p><b>One\n  two<br>three<p>Four <i>five</i><script>var a='</p>';</script><aside>no</aside></article>"
    spots, kept = html_text.candidates(PAGE.replace("{body}", body))
    assert [t for t, _ in kept] == ["Head & tail", "One two three", "Four five"]


def test_templates_of_a_host(spark):
    rows = [
        (i, f"http://a.org/{i}", f"<body><div>Links of the site</div><div><p>Own {i}</p><p>More {i}</p></div><div><b>End</b> line</div></body>")
        for i in range(8)
    ]
    rows += [(20, "http://b.org/", "<body><div>Links of the site</div><p>Alone</p></body>"), (21, None, None), (22, "::[", ""), (22, "::[", "")]
    out = sorted(map(tuple, html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()), key=str)
    texts = {(r[0], r[2]) for r in out}
    assert {(i, f"Own {i}\nMore {i}") for i in range(8)} <= texts
    assert (20, "Links of the site\nAlone") in texts and (21, "") in texts
    assert len(out) == len(rows) and all(r[3] == len(r[2]) for r in out)


def test_copies_of_a_wrapped_page_are_no_template(spark):
    wrapped = "<body><div class=wrap><article><p>The story</p></article></div></body>"
    plain_page = "<body><div><p>No mark</p></div></body>"
    rows = [(i, f"http://a.org/{i}", wrapped) for i in range(8)] + [(i, f"http://b.org/{i}", plain_page) for i in range(8, 16)]
    rows += [(i, f"http://a.org/{i}", f"<body><div class=wrap><article><p>Own {i}</p></article></div></body>") for i in range(16, 20)]
    out = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in out} == {
        i: "The story" if i < 8 else "No mark" if i < 16 else f"Own {i}" for i in range(20)
    }


def test_head_without_end_and_closed_raw_tags():
    def kept(source):
        return [words for words, _ in html_text.candidates(source)[1]]

    assert kept("<html><head><meta charset=x><title>T</title><body><p>One</body>") == ["One"]
    assert kept("<head><title>T</title><script>var a;</script><p>One<p>Two") == ["One", "Two"]
    assert kept("<head><title>T</title> </head><p>One") == ["One"]
    for raw in ("<svg viewBox='0 0'/>", "<iframe/>", "<canvas id=x />"):
        assert kept(f"<body><p>One</p>{raw}<p>Two</p></body>") == ["One", "Two"]
    assert kept("<body><svg><text>no</text></svg><p>One") == ["One"]


def test_article_in_a_form_or_in_a_layout_class():
    def kept(source):
        return [words for words, _ in html_text.candidates(source)[1]]

    article = "<article><p>Story</p><aside>no</aside></article>"
    for wrapper in ("form id=aspnetForm", "div class='content-with-sidebar'", "div class='layout sidebar-right'", "div id=sidebar"):
        end = wrapper.split()[0]
        assert kept(f"<body><{wrapper}><nav>Menu</nav>{article}</{end}></body>") == ["Story"]
    assert kept("<body><div class='layout sidebar-right'><p>Unmarked</p></div></body>") == ["Unmarked"]
    assert kept(f"<body>{article}<div class=related><article>Other</article></div></body>") == ["Story"]
    assert kept("<body><p>Story</p><div id=comment-list><article>Reader</article></div></body>") == ["Story"]


def test_boxes_inside_main_and_article(spark):
    box, quote = "<div class=x><p>Join our letter</p></div>", "<p>A passage that many quote</p>"
    some = "<div><p>On half of the pages</p></div>"
    long = "<div><p>" + "word " * 40 + "</p></div>"
    rows = []
    for i in range(8):
        half = some if i % 2 else ""
        rows.append((i, f"http://a.org/{i}", f"<body><main><p>Own {i}</p>{box}</main></body>"))
        rows.append((10 + i, f"http://b.org/{i}", f"<body><main><article><p>Own {i}</p>{quote}{box}{half}{long}</article></main></body>"))
    out = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    got = {r["page_id"]: r["text"].split("\n") for r in out}
    for i in range(8):
        half = ["On half of the pages"] if i % 2 else []
        assert got[i] == [f"Own {i}"]
        assert got[10 + i] == [f"Own {i}", "A passage that many quote", *half, " ".join(["word"] * 40)]


def test_main_text_of_nothing(spark):
    assert html_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_bpe_of_a_very_long_text():
    import tiktoken

    rng = random.Random(12)
    codec = bpe.Codec(bpe.vocabulary_path())
    text = " ".join(rng.choice(["abc", "de fgh", "Ωμέγα", "x1y2", "don't", "\n\n", "日本語"]) + str(rng.randrange(3000)) for _ in range(2_500_000))
    assert len(text.encode()) > 25_000_000
    (ids,) = codec.encode([text])
    assert codec.decode([ids, ids[:0], ids[:5]]) == [text.encode(), b"", b"".join(codec.decode([ids[:5]]))]
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    assert ids.tolist() == [t for part in library.encode_ordinary_batch([text]) for t in part]
    few = ids[:200_001]
    assert bpe.ids_digest(few) == hashlib.sha256(" ".join(map(str, few.tolist())).encode()).hexdigest()


def test_long_words_of_one_polynomial_hash(spark):
    """Thue-Morse words collide in every polynomial hash modulo 2^64."""
    a = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    b = a.translate(str.maketrans("ab", "ba"))
    rows = [(1, a), (2, b), (3, "p q r " + a), (4, "p q r " + b), (5, a)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in jaccard.component_ids(docs).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 4, 5: 1}


def test_a_worker_keeps_one_kind():
    from cardflow.llm import kept

    kept.of(kept.WORDS)
    kept.of(kept.TOKENS)["x"] = 1
    assert kept.of(kept.TOKENS) == {"x": 1}
    assert kept.of(kept.WORDS) == {} and kept.of(kept.TOKENS) == {}


@pytest.mark.parametrize(
    "box",
    ["div class='long-form'", "div class='elementor-widget elementor-widget-text-editor'", "section id='cookies'", "fieldset", "p class='notice'"],
)
@pytest.mark.parametrize("length", [5, 80])
def test_names_do_not_delete_an_article(box, length):
    words = " ".join(f"w{i}" for i in range(length))
    end = box.split()[0]
    page = f"<body><nav>menu</nav><article><{box}>{words}</{end}></article><footer>end</footer></body>"
    assert [t for t, _ in html_text.candidates(page)[1]] == [words]


def test_named_parts_of_an_article():
    words = " ".join(f"w{i}" for i in range(80))

    def kept(inner):
        return [t for t, _ in html_text.candidates(f"<article><p>first</p>{inner}<p>last</p></article>")[1]]

    for box in ("<div class='advert'>buy this</div>", "<ul class='share'><li>here<li>there</ul>", "<fieldset>choose one</fieldset>"):
        assert kept(box) == ["first", "last"]
    assert kept(f"<div class='widget'><p>{words}</p><div class='share'>here</div></div>") == ["first", words, "last"]
    assert kept("<h2 class='section-menu'>dishes</h2><p class='important-notice'>read</p>") == ["first", "dishes", "read", "last"]
    assert kept(f"<form><fieldset>{words}</fieldset></form><div class='comments'>{words}</div>") == ["first", "last"]


def test_named_parts_that_recur_are_template(spark):
    notice = " ".join(f"n{i}" for i in range(60))
    rows = [
        (i, f"http://h{i % 2}/{i}", f"<article><p>own text {i}</p>{box}<div class='widget'><p>{' '.join(f'x{i}y{j}' for j in range(40))}</p></div></article>")
        for i in range(24)
        for box in [f"<div class='cookie-notice'><p>{notice}</p></div><p class='promo'>join us</p>" if i % 2 else f"<p class='promo'>offer {i}</p>"]
    ]
    out = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    for r in out:
        i = r["page_id"]
        own = [f"own text {i}", *([] if i % 2 else [f"offer {i}"]), " ".join(f"x{i}y{j}" for j in range(40))]
        assert r["text"].split("\n") == own


def test_pages_of_unclosed_quotes_end():
    import time

    began = time.time()
    for page in ("<div a='" * 125_000, "<p title=\"x" * 90_000, "<p>kept</p>" + "<a b='" * 50_000, "<script x='" * 90_000):
        html_text.parse(page)
    assert time.time() - began < 20
    blocks = html_text.parse("<article><p>first</p><p a='b>second</p><p>third</p></article>")[1]
    assert [b[0] for b in blocks] == ["first", "second", "third"]
    assert [b[0] for b in html_text.parse("<p>1 < 2 and <3</p><p>x</p>")[1]] == ["1 < 2 and <3", "x"]
