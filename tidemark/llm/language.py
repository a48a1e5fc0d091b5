"""Language identification by language-bitmask filters of n-grams.

An n-gram is five bytes of the lower-cased UTF-8 text around a letter, with everything that is no letter read as a
space. The filter is bit-sliced: position p of its table holds one bit per language, so the AND over an n-gram's hash
positions is the set of all languages that contain it. A text's score for a language is the share of its n-grams found
there, corrected for the chance that a Bloom filter filled this far says yes to anything; the highest score decides.

Learning: about ``per_language`` labelled documents of each language (chosen by a hash of doc_id; all if there are fewer) are
counted. An n-gram belongs to a language if it makes up ``MIN_RATE`` of that language's n-grams, hence at most
1 / MIN_RATE of them, and at least ``MIN_SHARE`` of the n-gram's rates over all languages. So the filter's size is bounded by the number of
languages alone, and it is broadcast.

Defined cases: null text and text without a letter are ``und`` with score 0; text whose n-grams are all unknown gets the
most frequent learned language with score 0. Without any labelled row every text is ``und``. Rows with a null doc_id
are learned from like others; repeated rows count repeatedly. Extra columns are ignored by ``predicted``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import fold_of, sampled_by_hash
from tidemark.llm.words import mix, text_chunks
from tidemark.session import stage

PER_LANGUAGE = 2000
MIN_RATE = 2e-6
MIN_SHARE = 0.2
HASHES = 3
BITS_PER_GRAM = 16
FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"
MIN_SCORE = 0.2  # of clean text nearly all n-grams are known, of text in another language hardly any

_U = np.uint64
_CLEAN = np.full(256, 0x20, np.uint8)  # letters, and bytes of characters outside ASCII, stay
_CLEAN[0x61:0x7B] = np.arange(0x61, 0x7B)
_CLEAN[0x41:0x5B] = np.arange(0x61, 0x7B)
_CLEAN[0x80:] = np.arange(0x80, 0x100)
REACH = 2  # bytes on each side of the middle one


def grams(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams of all texts, in order, and where those of each text begin (one entry more than texts)."""
    lower = pc.utf8_lower(text)
    offsets = np.frombuffer(lower.buffers()[1], np.int64)[lower.offset:lower.offset + len(lower) + 1]
    raw = lower.buffers()[2]
    data = _CLEAN[np.frombuffer(raw, np.uint8)[offsets[0]:offsets[-1]]] if raw is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    # spaces between texts, so that no n-gram reaches into the next one
    padded = np.full(len(data) + REACH * (len(offsets) + 1), 0x20, np.uint8)
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    padded[np.arange(len(data)) + REACH * (rows + 1)] = data
    wide = padded.astype(np.uint64)
    n = max(len(padded) - 2 * REACH, 0)
    packed = np.zeros(n, np.uint64)
    for k in range(2 * REACH + 1):
        packed = (packed << _U(8)) | wide[k:k + n]
    at = np.flatnonzero(padded[REACH:REACH + n] != 0x20)
    starts = offsets + REACH * np.arange(len(offsets))
    return mix(packed[at]), np.searchsorted(at, starts)


@dataclass
class LanguageFilter:
    """``table[p]`` has bit l set if an n-gram of language l hashes to p; one plane for each 64 languages."""

    languages: list[str]  # most frequent first
    planes: list[np.ndarray]
    false_positives: np.ndarray

    @classmethod
    def build(cls, languages: list[str], found: list[tuple[np.ndarray, int]]) -> LanguageFilter:
        """``found``: hashes and language number of n-grams, language by language."""
        most = max([len(h) for h, _ in found], default=1)
        size = 1 << max(10, (BITS_PER_GRAM * most - 1).bit_length())
        planes = []
        for first in range(0, len(languages), 64):
            width = min(64, len(languages) - first)
            planes.append(np.zeros(size, next(d for d in (np.uint8, np.uint16, np.uint32, np.uint64) if np.dtype(d).itemsize * 8 >= width)))
        fill = np.zeros(len(languages))
        for hashes, language in found:
            plane = planes[language // 64]
            bit = plane.dtype.type(1 << language % 64)
            for at in _positions(hashes, size):
                plane[at] |= bit
            fill[language] = np.count_nonzero(plane & bit) / size
        return cls(languages, planes, fill ** HASHES)

    def scores(self, hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Corrected share of known n-grams, texts by languages."""
        n = np.maximum(np.diff(starts), 1)
        out = np.empty((len(n), len(self.languages)))
        for p, plane in enumerate(self.planes):
            masks = None
            for at in _positions(hashes, len(plane)):
                masks = plane[at] if masks is None else masks & plane[at]
            for k in range(min(64, len(self.languages) - 64 * p)):
                sums = np.zeros(len(masks) + 1, np.int64)
                np.cumsum((masks >> masks.dtype.type(k)) & masks.dtype.type(1), out=sums[1:], dtype=np.int64)
                out[:, 64 * p + k] = np.diff(sums[starts]) / n
        wrong = self.false_positives
        return np.clip((out - wrong) / np.maximum(1 - wrong, 1e-9), 0, 1)


def _positions(hashes: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """``HASHES`` positions from independent bits of one hash, each below ``size``, a power of two up to 2**32."""
    step = (hashes >> _U(32)) | _U(1)
    for k in range(HASHES):
        yield ((hashes + _U(k) * step) & _U(size - 1)).astype(np.int64)


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text_chunks(batch):
            hashes, starts = grams(part.column("text"))
            langs = np.array(part.column("lang").to_pylist(), object)
            for lang in sorted(set(langs)):
                own = np.concatenate([hashes[starts[i]:starts[i + 1]] for i in np.flatnonzero(langs == lang)])
                found, n = np.unique(own, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found), pa.string()), pa.array(found.view(np.int64)), pa.array(n.astype(np.int64))],
                                                 names=["lang", "gram", "n"])


def learn(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> LanguageFilter | None:
    """The filter learned from (doc_id, text, lang) rows; null without a labelled text."""
    rows = labelled.where("lang is not null and text is not null").select(
        F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    sample = sampled_by_hash(rows, "lang", "doc_id", per_language)
    counts = sample.select("text", "lang").mapInArrow(_count_grams, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts = stage(counts, "grams")  # counted once, read twice
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))  # one row a language
    rates = counts.join(F.broadcast(totals), "lang").withColumn("rate", F.col("n") / F.col("total")).where(F.col("rate") >= MIN_RATE)
    own = rates.withColumn("share", F.col("rate") / F.sum("rate").over(Window.partitionBy("gram"))).where(F.col("share") >= MIN_SHARE)
    table = own.select("lang", "gram").toArrow()  # at most 1 / MIN_RATE rows a language
    if not table.num_rows:
        return None
    present = set(pc.unique(table.column("lang")).to_pylist())
    languages = [r.lang for r in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect() if r.lang in present]
    lang, gram = np.array(table.column("lang").to_pylist(), object), table.column("gram").to_numpy().view(np.uint64)
    return LanguageFilter.build(languages, [(gram[lang == x], k) for k, x in enumerate(languages)])


def predicted(docs: DataFrame, model: LanguageFilter | None) -> DataFrame:
    """doc_id, lang_pred and score of every whole text."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if model is None:
        return rows.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    held = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array(held.value.languages, object)
        for batch in batches:
            for part in text_chunks(batch):
                scores = held.value.scores(*grams(part.column("text")))
                best, score = names[scores.argmax(axis=1)], scores.max(axis=1)
                lettered = np.array(part.column("lettered").to_pylist(), bool)
                best[~lettered], score[~lettered] = UNKNOWN, 0.0
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(best, pa.string()), pa.array(score)], schema=schema)

    return rows.withColumn("lettered", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))).mapInArrow(run, "doc_id long, lang_pred string, score double")


def held_out(docs: DataFrame) -> DataFrame:
    return docs.withColumn("held_out", fold_of(F.col("doc_id"), FOLDS) == HELD_OUT)


def identify(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learned from the documents that are not held out."""
    model = learn(held_out(docs).where("not held_out"), per_language)
    return held_out(predicted(docs, model)).select("doc_id", "held_out", "lang_pred", "score")


def keep_identified(docs: DataFrame, columns: tuple[str, ...], min_score: float = MIN_SCORE, per_language: int = PER_LANGUAGE) -> DataFrame:
    """``columns`` of the documents whose language is recognised with at least ``min_score``; judged where they are read."""
    model = learn(held_out(docs).where("not held_out"), per_language)
    rows = docs.select(*columns)
    if model is None:
        return rows.limit(0)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lettered = np.array(batch.column("_lettered").to_pylist(), bool)
            own = batch.select(list(columns))
            scores = [held.value.scores(*grams(part.column("text"))).max(axis=1) for part in text_chunks(batch.select(["text"]))]
            yield own.filter(pa.array(lettered & (np.concatenate([*scores, np.zeros(0)]) >= min_score)))

    return rows.withColumn("_lettered", F.coalesce(F.col("text").cast("string").rlike(r"\p{L}"), F.lit(False))).mapInArrow(run, rows.schema)
