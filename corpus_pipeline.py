"""The documents' way into training sequences: quality rules, near copies, repeated passages,
personal data, packing. Each stage reads what the one before it wrote."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardflow.llm import jaccard, packing, pii, quality_rules, substrings
from cardflow.llm.tables import read, saved

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _counted(docs: DataFrame) -> DataFrame:
    """`docs` with n_chars of the changed texts, where there is such a column."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules.keep(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at 0.8: that of the least id."""
    return jaccard.one_per_class(docs, k=5, percent=80)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of repeated passages, with the rest of their layout."""
    return _counted(substrings.remove_repeats(docs).select(*docs.columns))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return _counted(pii.redact(docs))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in training sequences."""
    return packing.pack_documents(docs).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", rules),
    ("near copies", near_copies),
    ("repeated passages", passages),
    ("personal data", personal_data),
    ("packing", sequences),
]

#: Shingles, automata and tokenizers are beyond SQL; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sequences of the table `documents`."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
