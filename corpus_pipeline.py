"""The training-text pipeline: language, quality, near-duplicates, benchmark leaks, packing.

Every stage takes the documents its predecessor kept and returns those it keeps, with the columns of the documents table;
the last returns the pieces of the packed sequences. Null and empty texts have no language and go in the first stage. A
null doc_id is no duplicate of anything; if one row without an id is contaminated, all of them go. Rows that repeat a doc_id are
one document and share its fate. Extra columns are dropped. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, language, neardup, packing, quality
from tidemark.llm.tables import DOCUMENT_COLUMNS, table
from tidemark.session import settled

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised."""
    return language.keep_identified(docs, DOCUMENT_COLUMNS)


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality.judged(docs).where("kept").select(*DOCUMENT_COLUMNS)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, the one with the smallest id."""
    others = neardup.near_duplicates(docs).where("not kept").select("doc_id").distinct()
    return docs.select(*DOCUMENT_COLUMNS).join(others, "doc_id", "left_anti").select(*DOCUMENT_COLUMNS)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark")).where("contaminated").select("doc_id").distinct()
    found = found.toDF("leaked")
    return docs.select(*DOCUMENT_COLUMNS).join(found, docs["doc_id"].eqNullSafe(found["leaked"]), "left_anti")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences."""
    return packing.pack(docs, TOKENIZER)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", keep_known_language),
    ("quality_rules", keep_good_quality),
    ("near_duplicates", keep_one_of_each),
    ("decontamination", keep_uncontaminated),
    ("packing", pack),
]

#: Language model, similarity classes and tokenizer have no SQL form; the stages are tested one by one against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each one's result written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = settled(spark, lambda docs=docs, function=function: function(spark, docs, sf_dir), name)
    return docs
