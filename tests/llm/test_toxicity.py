"""Toxicity: held-out accuracy, blame of the right sentences, and odd rows."""

import random

import numpy as np
import pyarrow as pa

from tidemark.llm import toxicity

DOCS = "doc_id long, text string, toxic int, score double"


def made(n, seed):
    """Documents of several sentences; the toxic ones have one or two bad words in one sentence. Text and label."""
    rng = random.Random(seed)
    plain = [f"word{k}" for k in range(300)]
    rows = []
    for i in range(n):
        bad = rng.random() < 0.3
        sentences = [[rng.choice(plain) for _ in range(rng.randint(3, 12))] for _ in range(rng.randint(1, 30))]
        where = rng.randrange(len(sentences))
        if bad:
            for _ in range(rng.randint(1, 2)):
                sentences[where].insert(rng.randrange(3), rng.choice(["vilething", "Awful", "grumb" + str(rng.randrange(200))]))
        rows.append((i, ". ".join(" ".join(s) for s in sentences), int(bad), sentences[where]))
    return rows


def test_learned_and_located(spark):
    rows = made(1500, 1)
    docs = spark.createDataFrame([(i, t, 9, 9.0) for i, t, _, _ in rows], DOCS)
    labels = spark.createDataFrame([(i, y) for i, _, y, _ in rows if i % 5], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    assert len(got) == 1500
    held = [i for i in got if got[i].held_out]
    assert 400 < len(held) < 600
    assert np.mean([got[i].predicted == rows[i][2] for i in held]) > 0.97
    assert all(r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1 for r in got.values())
    model = toxicity.learn(toxicity.held_out(docs).where("not held_out"), labels)
    found = toxicity.locate(docs, model).collect()
    right = [r.sentence.split() == rows[r.doc_id][3] for r in found if rows[r.doc_id][2]]
    assert len(right) > 350 and np.mean(right) > 0.97


def test_documents_held_out(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    rows = toxicity.toxicity(docs, labels).join(labels, "doc_id").where("held_out").collect()
    toxic = [r.predicted for r in rows if r.toxic == 1]
    clean = [r.predicted for r in rows if r.toxic == 0]
    assert np.mean(toxic) > 0.8 and np.mean(clean) < 0.01  # learned from some 270 toxic documents


def test_odd_rows(spark):
    rows = [(None, "awful"), (1, None), (2, ""), (3, " \n . !"), (4, "awful vilething"), (4, "awful vilething"), (5, "x" * 100000), (6, "É! ü? 漢字。"), (7, "word1 word2")]
    docs = spark.createDataFrame([(i, t, 1, 1.0) for i, t in rows], DOCS)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {(r.score, r.predicted) for r in toxicity.toxicity(docs, none).collect()} == {(0.0, 0)}
    one = spark.createDataFrame([(1, 1), (None, 1), (4, None), (99, 0)], "doc_id long, toxic int")
    assert toxicity.toxicity(docs, one).count() == len(rows)
    assert toxicity.toxicity(docs.limit(0), one).count() == 0
    learned = made(600, 2)
    model = toxicity.learn(spark.createDataFrame([(i, t, 0, 0.0) for i, t, _, _ in learned], DOCS),
                           spark.createDataFrame([(i, y) for i, _, y, _ in learned], "doc_id long, toxic int"))
    scores = {(r.doc_id, r.score) for r in toxicity.scored(docs, model).collect()}
    assert {(1, 0.0), (2, 0.0), (3, 0.0)} <= scores
    by_id = dict(scores)
    assert by_id[4] > by_id[7] and by_id[None] > by_id[6]


def test_model_prefers_the_word_that_explains_the_label():
    words = np.array([5, 9], np.uint64)
    # word 0 in every toxic document, word 1 in all documents
    toxic = np.array([1, 0] * 50)
    doc = np.repeat(np.arange(100), 2)[np.tile([True, True, False, True], 50)]
    place = np.tile([0, 1, 1], 50)
    sentence = np.arange(len(doc))
    model = toxicity.ToxicityModel.fit(words, toxic, np.full(100, 5), doc, sentence, place)
    assert model.weights[0] > model.weights[1] + 2
    empty = toxicity.Sentences.of(pa.array([""], pa.large_string()))
    assert model.document_scores(empty).tolist() == [0.0]
