"""Toxicity by multiple-instance learning: only documents are labelled, yet sentences are scored.

A sentence has the probability p = sigmoid(bias + sum of the weights of its words and of their first 4, 5 and 6 bytes); the document's is the noisy-or
1 - product(1 - p) over its sentences. Weights and bias are trained so that the documents' labels become likely, so a
sentence is blamed only as far as the labels need it, and ``locate`` names the sentences that make a document toxic.

Learning takes about ``per_label`` labelled documents of each label, chosen by a hash of doc_id. Words and
beginnings are known by their 64-bit hash; the vocabulary is those with at least ``MIN_PLACES`` different pairs of neighbours whose
share of toxic places differs most clearly from the whole sample's, at most ``MAX_WORDS``. Places count, not documents, so that the words
of a text copied a hundred times tell no more than those of one. The sample's sentences, reduced to these words, are
fitted on the driver (full-batch Adam); the model is a few kilobytes and is broadcast. Scoring reads every whole text once,
without a shuffle.

Words are runs of 0-9, letters and characters beyond U+007F, A-Z lower-cased; sentences end at ``.``, ``!``, ``?`` or a line break.

Defined cases: null and empty texts have no sentence and score 0. Without labels of both kinds every score is 0. Null
labels and labels of unknown documents are ignored; a doc_id labelled twice counts with its highest label, repeated documents each. Null
doc_ids are scored but never learned from. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import fold_of, sampled_by_hash
from tidemark.llm.words import Words, mix, text_chunks

PER_LABEL = 5000
PREFIXES = (4, 5, 6)  # bytes
MIN_PLACES = 5
MAX_WORDS = 2000
MIN_DEVIATIONS = 4.0
PREDICT_FROM = 0.7
FOLDS, HELD_OUT = 3, 1
L2, STEPS, RATE = 1e-5, 600, 0.1

SEPARATORS = tuple(b for b in range(0x80) if not chr(b).isalnum())
_ENDS = np.zeros(256, bool)
_ENDS[list(b".!?\n")] = True
_EDGE = np.zeros(1, np.uint64)


def features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and of the first bytes of longer ones, and the word each belongs to."""
    n = words.ends - words.starts
    parts, owners = [words.hashes()], [np.arange(len(n))]
    for k in PREFIXES:
        longer = np.flatnonzero(n > k)
        parts.append(words.hashes(prefix=k)[longer] ^ np.uint64(k))
        owners.append(longer)
    return np.concatenate(parts), np.concatenate(owners)


@dataclass
class Sentences:
    """Words of a text array and the sentence each one lies in; sentences are numbered through the array."""

    words: Words
    features: np.ndarray  # of words and their beginnings
    word: np.ndarray  # of each feature
    sentence: np.ndarray  # of each word
    row: np.ndarray  # of each sentence
    first_word: np.ndarray  # of each sentence

    @classmethod
    def of(cls, text: pa.Array) -> Sentences:
        words = Words(text, SEPARATORS)
        ends = np.r_[0, np.cumsum(_ENDS[words.data])][words.starts]
        new = np.ones(len(ends), bool)
        new[1:] = (np.diff(ends) > 0) | (np.diff(words.rows) > 0)
        first = np.flatnonzero(new)
        return cls(words, *features(words), np.cumsum(new) - 1, words.rows[first], first)


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


@dataclass
class ToxicityModel:
    vocabulary: np.ndarray  # sorted word hashes
    weights: np.ndarray
    bias: float

    def _known(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which words are in the vocabulary, and their places there."""
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        known = np.flatnonzero(self.vocabulary[at] == hashes)
        return known, at[known]

    def sentence_logits(self, s: Sentences) -> np.ndarray:
        known, place = self._known(s.features)
        return self.bias + np.bincount(s.sentence[s.word[known]], self.weights[place], minlength=len(s.row))

    def document_scores(self, s: Sentences) -> np.ndarray:
        return -np.expm1(-np.bincount(s.row, _softplus(self.sentence_logits(s)), minlength=s.words.n_rows))

    @classmethod
    def fit(cls, vocabulary: np.ndarray, toxic: np.ndarray, sentences: np.ndarray, doc: np.ndarray, sentence: np.ndarray, word: np.ndarray) -> ToxicityModel:
        """``toxic`` and ``sentences`` (their number) per document; one (doc, sentence, place in the vocabulary) per known word."""
        with_words, row = np.unique(np.stack([doc, sentence]), axis=1, return_inverse=True)
        owner = with_words[0]
        plain = sentences - np.bincount(owner, minlength=len(toxic))
        weights, bias = np.zeros(len(vocabulary)), -7.0
        m, v = np.zeros(len(vocabulary) + 1), np.zeros(len(vocabulary) + 1)
        for k in range(1, STEPS + 1):
            z = bias + np.bincount(row, weights[word], minlength=len(owner))
            total = plain * _softplus(bias) + np.bincount(owner, _softplus(z), minlength=len(toxic))
            # loss: total for clean documents, -log(1 - exp(-total)) for toxic ones
            slope = np.where(toxic == 1, -1 / np.expm1(np.clip(total, 1e-9, 500)), 1.0) / len(toxic)
            dz = slope[owner] / (1 + np.exp(-np.clip(z, -500, 500)))
            grad = np.bincount(word, dz[row], minlength=len(vocabulary)) + L2 * weights
            grad = np.r_[grad, dz.sum() + (slope * plain).sum() / (1 + np.exp(-bias))]
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
            step = RATE * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8)
            weights, bias = weights - step[:-1], float(bias - step[-1])
        return cls(vocabulary, weights, bias)


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every feature with a hash of its word's two neighbours and the label of its document."""
    for batch in batches:
        for part in text_chunks(batch):
            words = Words(part.column("text"), SEPARATORS)
            hashes = words.hashes()
            around = mix(np.r_[_EDGE, hashes[:-1]] * np.uint64(3) + np.r_[hashes[1:], _EDGE]) if len(hashes) else hashes
            toxic = part.column("toxic").to_numpy().astype(np.int8)[words.rows]
            found, owner = features(words)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array((around[owner] >> np.uint64(33)).astype(np.int32)), pa.array(toxic[owner])],
                                             names=["word", "around", "toxic"])


def _known_words(vocabulary: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = ToxicityModel(vocabulary, np.zeros(len(vocabulary)), 0.0)
        for batch in batches:
            for part in text_chunks(batch):
                s = Sentences.of(part.column("text"))
                known, place = model._known(s.features)
                order = np.argsort(s.word[known], kind="stable")
                word, place = s.word[known][order], place[order]
                cuts = np.searchsorted(s.words.rows[word], np.arange(1, part.num_rows))
                yield pa.RecordBatch.from_arrays(
                    [part.column("toxic"), pa.array(np.bincount(s.row, minlength=part.num_rows).astype(np.int64)),
                     pa.array([x.tolist() for x in np.split(s.sentence[word], cuts)], pa.list_(pa.int32())),
                     pa.array([x.tolist() for x in np.split(place, cuts)], pa.list_(pa.int16()))], names=["toxic", "sentences", "at", "place"])
    return run


def learn(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> ToxicityModel | None:
    """The model learned from (doc_id, text) and (doc_id, toxic) rows; None unless there are labels of both kinds."""
    marked = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    present = marked.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    chosen = sampled_by_hash(present, "toxic", "doc_id", per_label)
    sample = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id").select("text", "toxic")  # about 2 * per_label ids
    totals = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if not (totals.get(0) and totals.get(1)):
        return None
    share = totals[1] / (totals[0] + totals[1])
    places = sample.mapInArrow(_places, "word long, around int, toxic byte").groupBy("word", "around").agg(F.min("toxic").alias("toxic"))
    words = places.groupBy("word").agg(F.count("*").alias("n"), F.sum("toxic").alias("n_toxic"))
    n = F.col("n")
    deviation = F.abs(F.col("n_toxic") - n * share) / F.sqrt(n * share * (1 - share))
    telling = words.where((n >= MIN_PLACES) & (deviation >= MIN_DEVIATIONS)).orderBy(deviation.desc(), "word").limit(MAX_WORDS).select("word").toArrow()
    vocabulary = np.sort(telling.column("word").to_numpy().view(np.uint64))
    if not len(vocabulary):
        return None
    bags = sample.mapInArrow(_known_words(vocabulary), "toxic int, sentences long, at array<int>, place array<short>").toArrow()  # the sample's known words
    sizes = np.array([len(x) for x in bags.column("at")], np.int64)
    flat = [np.concatenate([np.asarray(x.as_py(), np.int64) for x in bags.column(c)]) for c in ("at", "place")]
    return ToxicityModel.fit(vocabulary, bags.column("toxic").to_numpy(), bags.column("sentences").to_numpy(), np.repeat(np.arange(len(sizes)), sizes), *flat)


def scored(docs: DataFrame, model: ToxicityModel | None) -> DataFrame:
    """doc_id and score of every whole text."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if model is None:
        return rows.select("doc_id", F.lit(0.0).alias("score"))
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_chunks(batch):
                scores = held.value.document_scores(Sentences.of(part.column("text")))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(scores)], names=["doc_id", "score"])

    return rows.mapInArrow(run, "doc_id long, score double")


def locate(docs: DataFrame, model: ToxicityModel, threshold: float = 0.5) -> DataFrame:
    """doc_id, sentence (its text from first to last word) and score of the offending sentences."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_chunks(batch):
                s = Sentences.of(part.column("text"))
                score = 1 / (1 + np.exp(-held.value.sentence_logits(s)))
                bad = np.flatnonzero(score >= threshold)
                last = np.r_[s.first_word[1:], len(s.sentence)] - 1
                spans = [s.words.data[s.words.starts[s.first_word[k]]:s.words.ends[last[k]]].tobytes().decode() for k in bad]
                yield pa.RecordBatch.from_arrays([part.column("doc_id").take(pa.array(s.row[bad])), pa.array(spans, pa.string()), pa.array(score[bad])],
                                                 names=["doc_id", "sentence", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, sentence string, score double")


def held_out(docs: DataFrame) -> DataFrame:
    return docs.withColumn("held_out", fold_of(F.col("doc_id"), FOLDS) == HELD_OUT)


def toxicity(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> DataFrame:
    """doc_id, held_out, score, predicted; learned from the labelled documents that are not held out."""
    model = learn(held_out(docs).where("not held_out and doc_id is not null"), labels, per_label)
    out = held_out(scored(docs, model))
    return out.select("doc_id", "held_out", "score", (F.col("score") >= PREDICT_FROM).cast("int").alias("predicted"))
