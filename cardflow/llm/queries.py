"""The operators as queries over the given tables."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardflow.llm import (
    bpe,
    html_text,
    jaccard,
    packing,
    phrases,
    pii,
    pivots,
    quality_model,
    quality_rules,
    runs,
    substrings,
    toxicity,
    warc,
)
from cardflow.llm.tables import Scratch, read, saved


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack_documents(docs).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.remove_repeats(docs, layout=False).select(
        "doc_id",
        F.col("_n_words").alias("n_words"),
        F.col("_n_removed").alias("n_removed"),
        F.sha2("text", 256).alias("kept_sha256"),
    )


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode_decode(docs, real=False)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(read(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op5_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_model.classify(docs, read(spark, sf_dir, "labels"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard.component_ids(docs)


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    spans = F.col("spans")
    return pii.find(docs).select(
        "doc_id",
        *[pii.count(spans, kind).alias(f"n_{kind}") for kind in ("email", "ip", "card", "phone")],
        F.sha2(pii.joined(F.filter(spans, lambda s: s["base"])), 256).alias("base_sha256"),
        pii.joined(spans).alias("spans"),
    )


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.judge(docs).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op9_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return pivots.search(vectors, F.col("vec_id") % 50 == 0)


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read(spark, sf_dir, "pages"))


def folded(doc_id: int | None, n: int) -> np.ndarray | None:
    """Every tenth document, by its id's checksum, repeats a period from some word on."""
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is None or h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % p
    return at


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = runs.periodic_runs(docs, rewrite=folded)
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    top = F.col("longest")
    return found.select(
        "doc_id",
        "n_runs",
        *[top[c].alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * longest.length div longest.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("lang", "text")
    with Scratch(spark) as scratch:
        return saved(phrases.collocations(docs, scratch), "collocations")


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.classify(docs, read(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


QUERIES = {
    "op1_packing": op1_packing,
    "op2_substrings": op2_substrings,
    "op3_bpe": op3_bpe,
    "op4_warc": op4_warc,
    "op5_quality_model": op5_quality_model,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_pii": op7_pii,
    "op8_quality_rules": op8_quality_rules,
    "op9_pivots": op9_pivots,
    "op10_html_text": op10_html_text,
    "op11_runs": op11_runs,
    "op12_phrases": op12_phrases,
    "op13_toxicity": op13_toxicity,
}
