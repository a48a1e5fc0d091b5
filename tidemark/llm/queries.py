"""The operators as named queries over whole tables, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, html, language, licenses, lm, mixing, neardup, negatives, packing, quality, toxicity, urls, whitening
from tidemark.llm.tables import table
from tidemark.session import settled

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(function: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function
    return wrap


@query("op8_quality_rules", quality.oracle_sql())
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_rules(table(spark, folder, "documents"))


@query("op10_minhash_near_dedup")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return settled(spark, lambda: neardup.near_duplicates(table(spark, folder, "documents")), "classes")


@query("op1_language_id")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return settled(spark, lambda: language.identify(table(spark, folder, "documents")), "languages")


@query("op9_packing")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op3_benchmark_decontamination", decontaminate.oracle_sql())
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return settled(spark, lambda: decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark")), "contamination")


# The rules of the query, as host, path, verdict.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


@query("op4_url_filters", urls.oracle_sql(URL_RULES))
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge(table(spark, folder, "pages"), spark.createDataFrame(URL_RULES, urls.RULE_COLUMNS))


@query("op6_toxicity")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op7_lm_scoring")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return lm.language_model_scores(table(spark, folder, "documents"))


@query("op2_html_extraction")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return html.extract(table(spark, folder, "pages"))


@query("op5_license_scans", licenses.oracle_sql())
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"), licenses.known_licenses(spark))


@query("op11_source_mixing", mixing.oracle_sql())
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return settled(spark, lambda: mixing.mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken"), "mix")


@query("op13_embedding_whitening")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return settled(spark, lambda: whitening.whiten(table(spark, folder, "embeddings")), "whitened")


@query("op12_hard_negatives", negatives.oracle_sql())
def op12(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    points = negatives.points_of(table(spark, folder, "embeddings"), label=label)
    return settled(spark, lambda: negatives.hard_negatives(points, F.col("vec_id") % 100 == 0), "negatives")
