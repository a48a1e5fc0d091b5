"""Hard negatives against all pairs, and the tree on its own."""

import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import negatives, rtree

SCHEMA = "vec_id long, embedding array<float>, label int, x string, leaf string"


def brute(rows, positives=5, size=10, low=30, high=90):
    points = set()
    width = max((len(v) for _, v, _ in rows if v is not None), default=0)
    for vec_id, v, label in rows:
        if vec_id is None or label is None or v is None or not all(c is not None and math.isfinite(c) for c in v):
            continue
        points.add((vec_id, label, tuple(math.floor(256 * c) for c in [*v, *[0.0] * (width - len(v))])))
    out = []
    for a, la, x in points:
        if a % 100:
            continue
        scored = sorted((-sum(p * q for p, q in zip(x, y)), i, li) for i, li, y in points)
        for s, p, _ in [t for t in scored if t[2] == la and t[1] != a][:positives]:
            fit = [t for t in scored if t[2] != la and low * -s <= 100 * -t[0] <= high * -s][:size]
            out += [(a, p, r + 1, t[1], -s, -t[0]) for r, t in enumerate(fit)]
    return sorted(out)


def check(spark, rows, partitions=4, **options):
    df = spark.createDataFrame([(i, v, label, "c", "d") for i, v, label in rows], SCHEMA)
    got = negatives.hard_negatives(negatives.points_of(df).repartition(partitions), F.col("vec_id") % 100 == 0, **options)
    kept = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    got = sorted(map(tuple, got.collect()))
    assert got == brute(kept)
    return got


def test_clusters_ties_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(negatives, "TILE_ROWS", 50)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 8))
    rows = [(i, [float(x) for x in centres[i % 6] + rng.normal(size=8) * 0.2], i % 5) for i in range(900)]
    rows += [(1000 + i, [0.5] * 8, i % 2) for i in range(300)]  # one vector often, ties everywhere
    rows += [(5000, [1.0, 2.0], 3), (5100, [], 2), (None, [1.0] * 8, 1), (5200, None, 1), (5300, [1.0] * 8, None), (5400, [float("nan")] * 8, 1),
             (5500, [1.0, None] * 4, 1), (5600, [0.25] * 8, 77), (5700, [0.25] * 8, 1), (5700, [0.25] * 8, 1)]
    got = check(spark, rows)
    assert len(got) > 300 and not {5200, 5300, 5400, 5500, 5600} & {r[0] for r in got}


def test_rounds(spark, monkeypatch):
    monkeypatch.setattr(negatives, "ROUND", 3)
    rng = np.random.default_rng(6)
    assert check(spark, [(10 * i, [float(x) for x in rng.normal(size=4)], i % 3) for i in range(150)])


def test_large_components(spark):
    rng = np.random.default_rng(7)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=3) * 1e5], i % 2) for i in range(250)]
    assert check(spark, rows)
    far = spark.createDataFrame([(0, [1e30, 0.0], 0, "", ""), (1, [1e30, 0.0], 0, "", ""), (2, [0.5e20, 0.0], 1, "", "")], SCHEMA)
    assert negatives.hard_negatives(negatives.points_of(far), F.col("vec_id") == 0, low=0, high=100).count() == 1


@pytest.mark.parametrize("rows", [[], [(0, [1.0], 1)], [(0, [1.0], 1), (1, [1.0], 2)], [(0, [1.0], 1), (1, [1.0], 1)], [(0, [], 1), (1, [], 1), (2, [], 2)]])
def test_few_rows(spark, rows):
    check(spark, rows, 1)


def test_embeddings(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    assert check(spark, [(r.vec_id, r.embedding, r.label) for r in df.collect()])


def tree_of(rng, n, size, spread, labels):
    centres = rng.integers(-200, 200, size=(12, size))
    x = centres[rng.integers(0, 12, n)] + rng.integers(-spread, spread + 1, size=(n, size))
    ids, marks = rng.permutation(n), rng.integers(0, labels, n)
    order, leaf = rtree.packed_order(marks, x, ids, 32)
    assert sorted(order) == list(range(n))
    sizes = np.bincount(leaf)
    assert sizes.max() <= 32 and sizes.min() >= 1
    return rtree.Tree(ids[order], marks[order], x[order].astype(float), leaf)


@pytest.mark.parametrize("spread", [2, 60])
def test_search_equals_a_full_scan(spread):
    rng = np.random.default_rng(spread)
    tree = tree_of(rng, 3000, 3, spread, 4)
    queries = tree.x[:40]
    low, high = tree.intervals(queries)
    looked = defaultdict(int)
    for q, query in enumerate(queries):
        scores = tree.x @ query
        assert all((low[n, q] <= scores[tree.starts[n]:tree.ends[n]]).all() and (scores[tree.starts[n]:tree.ends[n]] <= high[n, q]).all() for n in range(tree.leaves))
        for same in (True, False):
            wanted = (tree.labels == 1) == same
            windows = [rtree.Best(7), rtree.Best(7, 100, 5000), rtree.Best(7, -50, -10)]
            for w in windows:
                looked[same] += rtree.search(tree, query, low[:, q], high[:, q], [w], 1, same, 17)
                fits = wanted & (tree.ids != 17) & (scores >= w.low) & (scores <= w.high)
                assert w.kept == sorted(zip(-scores[fits], tree.ids[fits]))[:7]
    assert looked[False] < 0.4 * tree.leaves * 3 * len(queries)  # boxes are passed over


def test_every_point_has_a_tile():
    rng = np.random.default_rng(8)
    x, labels, ties = rng.integers(0, 3, size=(4000, 5)), rng.integers(0, 2, 4000), rng.permutation(4000).astype(np.uint64)
    x[:2500] = 1  # one point often
    cuts = rtree.Cuts(labels[::3], x[::3], ties[::3], 40)
    tiles = cuts.tiles(labels, x, ties)
    counts = np.bincount(tiles, minlength=cuts.count)
    assert len(counts) == cuts.count >= 30 and counts.max() < 6 * 4000 / cuts.count
