"""Mixing: targets, cut and repeats against a plain calculation."""

import re
from collections import Counter, defaultdict
from fractions import Fraction
from hashlib import md5

import pytest
from pyspark.sql import functions as F

from tidemark.llm import mixing

COLUMNS = "doc_id long, text string, source string, lang string, size string"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def expected(rows, weights=(3, 1, 2), percent=150, epochs=2):
    """Budgets handed out round by round, documents taken one by one."""
    by_source = defaultdict(list)
    for doc_id, text, source in rows:
        key = md5(f"{'' if doc_id is None else doc_id}:{md5((text or '').encode()).hexdigest()}".encode()).hexdigest()
        by_source[source].append((key, len(words(text)), doc_id))
    order = sorted((s for s in by_source if s is not None), key=lambda s: s.encode()) + [None] * (None in by_source)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total = {s: sum(n for _, n, _ in by_source[s]) for s in order}
    left, target = Fraction(percent * sum(total.values()), 100), {}
    while len(target) < len(order):
        share = left / sum(weight[s] for s in order if s not in target)
        full = [s for s in order if s not in target and share * weight[s] >= epochs * total[s]]
        if not full:
            target |= {s: share * weight[s] for s in order if s not in target}
            break
        target |= {s: Fraction(epochs * total[s]) for s in full}
        left -= sum(target[s] for s in full)
    out = []
    for s in order:
        budget, taken = int(target[s]), Counter()
        own = sorted(by_source[s], key=lambda r: r[:2])
        while budget and total[s]:
            for i, (_, n, _) in enumerate(own):
                taken[i] += min(n, budget)
                budget -= min(n, budget)
        out += [(doc_id, n, total[s], float(target[s]), taken[i]) for i, (_, n, doc_id) in enumerate(own)]
    return out


def plain(rows):
    return sorted(((d, n, t, round(g, 6), k) for d, n, t, g, k in rows), key=repr)


def check(docs, **options):
    rows = [(r.doc_id, r.text, r.source) for r in docs.select("doc_id", "text", "source").collect()]
    got = mixing.mix(docs, **options).select("doc_id", "size", "source_size", "target", "taken").collect()
    assert plain(map(tuple, got)) == plain(expected(rows, **options))
    return got


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = check(docs)
    assert all(r.taken <= 2 * r["size"] for r in got)
    again = mixing.mix(docs.repartition(5)).select("doc_id", "taken").collect()
    assert {(r.doc_id, r.taken) for r in again} == {(r.doc_id, r.taken) for r in got}


@pytest.mark.parametrize("options", [{}, {"weights": (1,), "percent": 100, "epochs": 1}, {"weights": (5, 1), "percent": 290, "epochs": 3}, {"percent": 400}])
def test_uneven_sources(spark, options):
    rows = [(i, f"w{i} " * (i % 7), "abcdé𝒳"[min(i % 11, 5)], "x", "y") for i in range(300)]
    rows += [(1000 + i, "one two\tthree\n", "big", None, None) for i in range(700)]
    rows += [(2000, "long " * 3000, None, "", ""), (2001, None, None, "", ""), (2002, " \t ", "empty", "", ""), (None, "a b", "a", "", ""), (None, "a b", "a", "", "")]
    rows += [(5, "w5 " * 5, "a", "", "")] * 3
    check(spark.createDataFrame(rows, COLUMNS).repartition(4), **options)


def test_empty(spark):
    docs = spark.createDataFrame([(1, None, None, None, None), (2, "", "a", None, None)], COLUMNS)
    assert sorted(tuple(r) for r in mixing.mix(docs).select("doc_id", "size", "taken").collect()) == [(1, 0, 0), (2, 0, 0)]
    assert mixing.mix(docs.limit(0)).count() == 0


def test_texts_hold_the_words_of_the_plan(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = {r.doc_id: r.taken for r in mixing.mix(docs).collect() if r.taken}
    found = Counter()
    texts = {r.doc_id: r.text for r in docs.collect()}
    cut = 0
    for r in mixing.mixed_texts(docs).collect():
        found[r.doc_id] += len(words(r.text))
        if r.text != texts[r.doc_id]:
            cut += 1
            assert words(r.text) == words(texts[r.doc_id])[:len(words(r.text))]
    assert dict(found) == plan and cut <= 20


def test_report(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = mixing.report(mixing.mix(docs)).collect()
    assert rows and all(r.taken == int(r.target) for r in rows)
    assert docs.select(F.count("*")).first()[0] == sum(r.documents for r in rows)
