"""Language identification: held-out accuracy, the filter's properties, and odd rows."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tidemark.llm import language

DOCS = "doc_id long, text string, lang string, score double, source string, n_chars long"


def test_documents_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == 1000
    held = [r for r in rows if r.held_out]
    assert 200 < len(held) < 300 and np.mean([r.lang == r.lang_pred for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_prediction_never_sees_the_label(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = language.learn(language.held_out(docs).where("not held_out"))
    wrong = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("yy"))
    assert sorted(language.predicted(docs, model).collect()) == sorted(language.predicted(wrong, model).collect())


def test_filter_holds_all_languages_of_an_ngram():
    rng = np.random.default_rng(1)
    own = [rng.integers(0, 2**63, 500).astype(np.uint64) for _ in range(70)]
    own[69][:250] = own[0][:250]  # shared n-grams
    model = language.LanguageFilter.build([f"l{k}" for k in range(70)], [(h, k) for k, h in enumerate(own)])
    assert len(model.planes) == 2 and (model.false_positives < 0.01).all()
    for k in (0, 5, 69):
        scores = model.scores(own[k], np.array([0, 500]))[0]
        assert scores[k] == 1 and scores[(k + 1) % 69 + (k == 69)] < 0.1
    assert abs(model.scores(own[0], np.array([0, 500]))[0][69] - 0.5) < 0.05
    assert (model.scores(rng.integers(0, 2**63, 500).astype(np.uint64), np.array([0, 500])) < 0.05).all()


def test_grams_do_not_cross_texts():
    both = language.grams(pa.array(["ab cd", "", "ef"], pa.large_string()))
    alone = [language.grams(pa.array([t], pa.large_string()))[0] for t in ("ab cd", "", "ef")]
    assert both[1].tolist() == [0, 4, 4, 6]
    assert np.concatenate(alone).tolist() == both[0].tolist()


def test_odd_rows(spark):
    text = {"en": "the of and in this that with from ", "de": "der die und ein nicht mit von zu "}
    rows = [(i, text[k] * 5, k) for i in range(40) for k in ("en", "de")]
    rows += [(None, "the of and", "en"), (1000, None, "en"), (1001, "", None), (1002, "123 $$ !", "de"), (1003, "漢字かな", None), (1004, "die und " * 50000, None), (1005, "A", None)]
    docs = spark.createDataFrame([(i, t, g, 5.0, "s", 1) for i, t, g in rows], DOCS)
    got = {r.doc_id: r for r in language.identify(docs).collect()}
    assert [got[i].lang_pred for i in (1000, 1001, 1002, 1003, 1004, None)] == ["und", "und", "und", got[1003].lang_pred, "de", "en"]
    assert got[1003].score == 0 and got[1003].lang_pred in ("en", "de") and got[1005].lang_pred in ("en", "de")
    kept = {r.doc_id for r in language.keep_identified(docs, ("doc_id", "text", "lang", "source", "n_chars")).collect()}
    assert {1004, None, 5} <= kept and not kept & {1000, 1001, 1002, 1003}
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {(r.lang_pred, r.score) for r in language.identify(unlabelled).collect()} == {("und", 0.0)}
    assert language.identify(docs.limit(0)).count() == 0
    assert language.identify(docs.union(docs)).count() == 2 * len(rows)
