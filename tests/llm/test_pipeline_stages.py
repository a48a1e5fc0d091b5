"""Every stage against a plain recomputation from its own input."""

import corpus_pipeline as P
import pytest
from pyspark.sql import functions as F
from test_decontaminate import brute as leaks
from test_neardup import brute as classes
from test_packing import check as check_pieces

from tidemark.llm import language, quality
from tidemark.llm.tables import DOCUMENT_COLUMNS, table
from tidemark.session import stage

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """The input and the output of every stage."""
    docs, out = table(spark, FOLDER, "documents"), {}
    for name, function in P.STAGES:
        after = stage(function(spark, docs, FOLDER), name)
        out[name], docs = (docs, after), after
    return out


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_stages_keep_whole_rows(stages):
    for name, (before, after) in list(stages.items())[:-1]:
        assert after.columns == list(DOCUMENT_COLUMNS), name
        assert after.exceptAll(before.select(*DOCUMENT_COLUMNS)).count() == 0
        assert 0 < after.count() <= before.count()


def test_language(stages):
    before, after = stages["language_id"]
    verdict = {r.doc_id for r in language.identify(before).where((F.col("lang_pred") != "und") & (F.col("score") >= language.MIN_SCORE)).collect()}
    assert ids(after) == verdict


def test_quality(stages):
    before, after = stages["quality_rules"]
    assert ids(after) == ids(quality.quality_rules(before).where("kept"))
    labels = before.sparkSession.read.parquet(f"{FOLDER}/labels.parquet")
    good = ids(before.join(labels.where("quality = 1"), "doc_id"))
    long = ids(quality.quality_rules(before).where("not base_failed"))
    assert len((good & long) - ids(after)) <= 0.01 * len(good & long)
    assert len(ids(labels.where("quality = 0")) & ids(after)) == 0


def test_near_duplicates(stages):
    before, after = stages["near_duplicates"]
    want = classes([(r.doc_id, r.text) for r in before.select("doc_id", "text").collect()])
    assert ids(after) == {i for i, (_, c) in want.items() if i == c} != ids(before)


def test_decontamination(spark, stages):
    before, after = stages["decontamination"]
    found = leaks([(r.doc_id, r.text) for r in before.select("doc_id", "text").collect()], [tuple(r) for r in table(spark, FOLDER, "benchmark").select("item_id", "text").collect()])
    assert ids(after) == {r[0] for r in found if not r[5]} != ids(before)


def test_packing(stages):
    check_pieces(stages["packing"][0])


def test_run_and_odd_rows(spark, tmp_path):
    pieces = P.run(spark, "/root/testdata/sf0.001")
    assert pieces.count() > 0 and "sequence_id" in pieces.columns
    docs = table(spark, "/root/testdata/sf0.001", "documents").limit(60)
    odd = spark.createDataFrame([(None, None, None, None, None), (1, None, "en", "s", 0), (None, docs.first().text, "en", "s", 1), (7, "", None, None, None)], docs.schema)
    folder = str(tmp_path / "t")
    docs.union(odd).union(docs.limit(5)).withColumn("kept", F.lit(1)).withColumn("keys", F.lit("x")).write.parquet(f"{folder}/documents.parquet")
    table(spark, "/root/testdata/sf0.001", "benchmark").write.parquet(f"{folder}/benchmark.parquet")
    assert P.run(spark, folder).count() > 0
    empty = str(tmp_path / "e")
    docs.limit(0).write.parquet(f"{empty}/documents.parquet")
    table(spark, "/root/testdata/sf0.001", "benchmark").limit(0).write.parquet(f"{empty}/benchmark.parquet")
    assert P.run(spark, empty).count() == 0
