"""Contamination against a plain search for every window."""

import hashlib
import re

from pyspark.sql import functions as F

from tidemark.llm import decontaminate

DOCS = "doc_id long, text string, item_id string, row long, pos int, term string"


def words(text):
    return re.findall(decontaminate.WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, width=10):
    windows = {}
    for item_id, text in items:
        w = words(text)
        k = min(width, len(w))
        for s in range(len(w) - k + 1 if k else 0):
            windows.setdefault(tuple(w[s:s + k]), set()).add(item_id)
    sizes = {len(k) for k in windows}
    out = []
    for doc_id, text in docs:
        w, hit, ids = words(text), set(), set()
        for k in sizes:
            for s in range(len(w) - k + 1):
                if tuple(w[s:s + k]) in windows:
                    hit |= set(range(s, s + k))
                    ids |= windows[tuple(w[s:s + k])]
        names = sorted(str(x) for x in ids if x is not None)
        out.append((doc_id, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def check(spark, docs, items):
    d = spark.createDataFrame([(i, t, "x", 1, 2, "y") for i, t in docs], DOCS)
    b = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((tuple(r) for r in decontaminate.contamination(d, b).collect()), key=str)
    assert got == brute(docs, items)
    return got


def test_planted_passages(spark):
    item = " ".join(f"i{k}" for k in range(25))
    short = "Just five words, no more"
    repeated = "a b a b a b a b a b a b a b"
    docs = [(1, "x " * 30 + item + " y" * 30), (2, " ".join(item.split()[3:13])), (3, " ".join(item.split()[3:12])), (4, item.upper() + " . " + item),
            (5, "so: just FIVE words - no more!"), (6, "just five words no"), (7, "b " + repeated + " a b a"), (8, None), (9, ""), (10, "É " + item.replace("i7", "I7")),
            (11, " ".join(item.split()[:12] + ["cut"] + item.split()[12:])), (1, item), (None, item)]
    check(spark, docs, [(1, item), (2, short), (3, repeated), (4, None), (5, " "), (3, repeated), (6, short), (None, "null item id here"), (7, "é É È")])


def test_hot_passage_and_frequent_terms(spark):
    item = "the of the and the of in the of to the end of the road and the of"
    docs = [(k, ("the of and in to " * (k % 7)) + (item if k % 3 == 0 else item.replace("road", "way")) + " the of" * (k % 5)) for k in range(300)]
    got = check(spark, docs, [(1, item), (2, "the of and in to the of and in to the of")])
    assert all(r[5] for r in got) and len({r[2] for r in got}) > 3  # the first ten words are left in the changed passage too


def test_empty_tables(spark):
    item = " ".join(f"i{k}" for k in range(12))
    assert check(spark, [], [(1, item)]) == []
    assert [r[5] for r in check(spark, [(1, item), (2, None)], [])] == [False, False]


def test_documents_and_sql(spark):
    from oracle import compare, duck
    folder = "/root/testdata/sf0.001"

    def run(spark, folder):
        return decontaminate.contamination(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/benchmark.parquet"))
    assert compare(spark, duck(folder), folder, run, decontaminate.oracle_sql()) is None
    assert run(spark, folder).where("contaminated").count() > 0


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "alpha x x beta x gamma"), (2, "gamma beta alpha"), (3, "alpha " + "x " * 20 + "beta gamma"), (4, "alpha beta")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    index, postings, terms = decontaminate.indexed(docs, items)
    names = index.select("row", "doc_id").distinct()

    def found(span):
        return sorted(r.doc_id for r in decontaminate.proximity_hits(postings, terms, span).join(names, "row").select("doc_id").distinct().collect())
    assert found(3) == [2] and found(6) == [1, 2] and found(30) == [1, 2, 3]
    first = decontaminate.proximity_hits(postings, terms, 6).join(names, "row").where("doc_id = 1").select(F.min("first")).first()[0]
    assert first == 0
