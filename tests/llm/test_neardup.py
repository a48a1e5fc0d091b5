"""Near-duplicates against brute force over all pairs."""

import re

import pytest
from pyspark.sql import functions as F

from tidemark.llm import neardup

FOLDER = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, source string, label string, near long"


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    n = min(5, len(words))
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if n else set()


def brute(rows, percent=85):
    """(doc_id, text) rows to {doc_id: (n, component)} by comparing every pair that shares a shingle."""
    sets = {i: shingles(t) for i, t in rows}
    where = {}
    for i, s in sets.items():
        for x in s:
            where.setdefault(x, []).append(i)
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    seen = set()
    for ids in where.values():
        for k, a in enumerate(ids):
            for b in ids[k + 1:]:
                if (a, b) not in seen:
                    seen.add((a, b))
                    common = len(sets[a] & sets[b])
                    if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                        x, y = sorted((root(a), root(b)))
                        parent[y] = x
    return {i: (len(s), root(i)) for i, s in sets.items()}


def ours(df):
    rows = neardup.near_duplicates(df).collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows if r.doc_id is not None)
    return {r.doc_id: (r.n_shingles, r.component_id) for r in rows}


def test_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    want = brute([tuple(r) for r in docs.collect()])
    got = ours(docs)
    assert got == want
    assert sum(i != c for i, (_, c) in got.items()) > 10


def test_chain_of_links_and_hot_group(spark):
    """Each version changes one more word, so that only neighbours are linked; 300 copies join the chain in the middle."""
    words = [f"w{i}" for i in range(200)]
    rows = []
    for k in range(12):
        rows.append((1000 + k, " ".join(words)))
        words[k * 13] = f"new{k}"
    rows += [(2000 + k, rows[5][1].upper().replace("W", "w")) for k in range(300)]
    rows += [(3000 + k, " ".join(f"x{k}_{i}" for i in range(40))) for k in range(5)]
    docs = spark.createDataFrame([(i, t, None, "l", 1) for i, t in rows], SCHEMA)
    assert ours(docs) == brute(rows)


def test_border_similarity(spark):
    """85 of 100 distinct shingles in common is linked, 84 is not."""
    base = [f"b{i}" for i in range(96)]  # 92 shingles
    rows = [(1, " ".join(base)), (2, " ".join(base + [f"t{i}" for i in range(16)])), (3, " ".join(base + [f"u{i}" for i in range(17)]))]
    docs = spark.createDataFrame([(i, t, None, "l", 1) for i, t in rows], SCHEMA)
    assert ours(docs) == brute(rows)
    assert ours(docs)[2][1] == 1 and ours(docs)[3][1] == 3


def test_nulls_empty_short_and_repeated(spark):
    rows = [(5, None), (6, ""), (7, " \n\t "), (9, "One two"), (8, "one TWO"), (4, "one two three"), (3, "É a b c d"), (2, "é a b c d")]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA)
    assert ours(docs) == {5: (0, 5), 6: (0, 6), 7: (0, 7), 9: (1, 8), 8: (1, 8), 4: (1, 4), 3: (1, 3), 2: (1, 2)}
    again = neardup.near_duplicates(docs.union(docs))
    assert again.count() == 16
    assert neardup.near_duplicates(docs.withColumn("doc_id", F.lit(None).cast("long"))).where("component_id is null").count() == 8
    assert neardup.near_duplicates(docs.limit(0)).count() == 0


def test_rows_of_one_id_with_different_texts(spark):
    """Every row has the class of its own text, whichever of the texts comes first."""
    rows = []
    for k in range(20):
        one, two = [f"a{k}_{i}" for i in range(120)], [f"b{k}_{i}" for i in range(120)]
        rows += [(k, " ".join(one)), (k, " ".join(two)), (100 + k, " ".join(one + ["end"])), (200 + k, " ".join(two + ["end"]))]
    apart = brute(list(enumerate(t for _, t in rows)))
    lowest = {}
    for row, (_, c) in apart.items():
        lowest[c] = min(lowest.get(c, rows[row][0]), rows[row][0])
    want = sorted((rows[row][0], n, lowest[c]) for row, (n, c) in apart.items())
    docs = spark.createDataFrame([(i, t, None, "l", 1) for i, t in rows], SCHEMA)
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in neardup.near_duplicates(docs).collect())
    assert got == want and (105, 117, 5) in got and (205, 117, 5) in got


def test_large_buckets_in_parts(spark, monkeypatch):
    """Edited copies that share a long middle: many in one bucket, linked only in part, compared in parts of two."""
    monkeypatch.setattr(neardup, "BUCKET_PART", 2)
    middle = [f"m{i}" for i in range(100)]
    rows = [(k, " ".join([f"h{k // 4}_{i}" for i in range(9 + k % 4)] + middle + [f"t{k % 5}_{i}" for i in range(6)])) for k in range(120)]
    docs = spark.createDataFrame([(i, t, None, "l", 1) for i, t in rows], SCHEMA)
    want = brute(rows)
    assert ours(docs) == want and 1 < len({c for _, c in want.values()}) < 120


def test_sketch_fills_every_coordinate():
    import numpy as np
    rng = np.random.default_rng(3)
    for n in (1, 2, 7, 300):
        s = neardup.similarity_sketch(rng.integers(0, 2**63, n).astype(np.uint64), 120)
        assert (s != np.iinfo(np.uint64).max).all()
    a = rng.integers(0, 2**63, 2000).astype(np.uint64)
    b = np.concatenate([a[:1800], rng.integers(0, 2**63, 200).astype(np.uint64)])
    same = (neardup.similarity_sketch(a, 2000) == neardup.similarity_sketch(b, 2000)).mean()
    assert same == pytest.approx(1800 / 2200, abs=0.04)
