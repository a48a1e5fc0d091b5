"""Whitening against a plain eigendecomposition, and the rank-one updates on their own."""

import math

import numpy as np
import pytest

from tidemark.llm import spectra, whitening

SCHEMA = "vec_id long, embedding array<float>, label int, component string"


def reference(vectors):
    """Whole-number rows, distinct rows, sums, variances and axes, by exact sums and one call of eigh."""
    size = max(map(len, vectors))
    rows = np.array([[math.floor(64 * float(x)) + 1_000_000 for x in [*v, *[0.0] * (size - len(v))]] for v in vectors], np.int64)
    fit = np.unique(rows, axis=0)
    n, sums = len(fit), fit.sum(0)
    scaled = n * fit - sums
    covariance = np.array((scaled.T.astype(object) @ scaled.astype(object)).tolist(), float) / n**3
    values, axes = np.linalg.eigh(covariance)
    return rows, fit, sums, values[::-1], axes[:, ::-1], covariance


def check(spark, df, components=16):
    kept = [(r.vec_id, [float(x) for x in r.embedding]) for r in df.collect()
            if r.embedding is not None and all(x is not None and math.isfinite(x) for x in r.embedding)]
    got = whitening.whiten(df, components=components).collect()
    rows, fit, sums, values, axes, covariance = reference([v for _, v in kept])
    n, size = fit.shape
    k = min(components, int((values > 1e-12 * values[0]).sum()))
    assert len(got) == len(kept) * k
    by_id = {}
    for r in got:
        by_id.setdefault(r.vec_id, []).append(r)
    mean = np.array([int(s) / n for s in sums])
    out, exact = np.zeros((len(kept), k)), {}
    for i, (vec_id, _) in enumerate(kept):
        mine = by_id[vec_id]
        assert sorted(r.component for r in mine) == list(range(1, k + 1))
        deviation = sum(int(d) ** 2 for d in n * rows[i] - sums)
        for r in mine:
            assert r.n == n and r.deviation == deviation
            assert abs(r.explained / (values[r.component - 1] / values.sum()) - 1) < 1e-9
            assert r.identity_error < 1e-8
            out[i, r.component - 1] = r.whitened
    # the axes behind the whitened numbers: unit, and eigenvectors to nearly all digits
    centred = rows - mean
    found = np.linalg.lstsq(centred, out, rcond=None)[0] * np.sqrt(values[:k])
    assert np.allclose(centred @ found / np.sqrt(values[:k]), out, atol=1e-7)
    for j in range(k):
        gap = min([abs(values[j] - values[i]) for i in range(size) if i != j], default=1)
        if gap > 1e-6 * values[0]:
            sign = np.sign(found[:, j] @ axes[:, j])
            assert np.abs(out[:, j] - sign * centred @ axes[:, j] / np.sqrt(values[j])).max() < 1e-9 * max(1, values[0] / gap)
    return got


def test_embeddings(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    check(spark, df.repartition(40))


def test_odd_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=5)], None, "c") for i in range(200)]
    rows += [(1000 + i, [0.25, -0.5, 1.0, 2.0, 3.0], 1, "") for i in range(150)]  # one vector often
    rows += [(2000, None, 1, ""), (2001, [1.0, None, 0.0, 0.0, 0.0], 1, ""), (2002, [float("nan")] * 5, 1, ""), (2003, [float("inf")] * 5, 1, ""),
             (2004, [0.5, 0.5], 1, ""), (2005, [], 1, "")]
    df = spark.createDataFrame(rows, SCHEMA)
    check(spark, df.repartition(7), components=3)
    got = check(spark, df.repartition(3))
    again = whitening.whiten(df.withColumn("n", df.label)).collect()
    assert len(again) == len(got)
    nulls = whitening.whiten(df.selectExpr("cast(null as long) as vec_id", "embedding")).collect()
    assert len(nulls) == len(got) and all(r.vec_id is None for r in nulls)


def test_few_directions(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x), float(2 * x), 7.0], None, "c") for i, x in enumerate(rng.integers(-9, 9, 50))]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.component for r in got} == {1} and len(got) == 50 and abs(got[0].explained - 1) < 1e-12
    for odd in ([], rows[:1], [rows[0]] * 5, [(1, [], None, None)], [(1, None, None, None)]):
        assert whitening.whiten(spark.createDataFrame(odd, SCHEMA)).collect() == []


def test_large_numbers(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in v], None, "c") for i, v in enumerate(rng.normal(size=(60, 3)) * [1e9, 1.0, 1e12])]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.component for r in got} == {1, 2} and all(r.deviation is None or r.deviation >= 0 for r in got) and any(r.deviation is None for r in got)


@pytest.mark.parametrize("size", [1, 2, 7, 40])
@pytest.mark.parametrize("kind", ["plain", "whole", "few", "steep", "constant"])
def test_rank_one_updates(size, kind):
    rng = np.random.default_rng(size)
    x = rng.normal(size=(150, size)) * 10
    if kind == "whole":
        x = np.floor(x / 10)
    if kind == "few":
        x = np.repeat(x[:3], 50, axis=0)
    if kind == "steep":
        x = x * np.logspace(0, -9, size) + 1e3
    if kind == "constant":
        x = np.full((150, size), 3.0)
    one, other = spectra.Spectrum(size), spectra.Spectrum(size)
    for i, row in enumerate(x):
        (one if i < 90 else other).add(row)
    one.merge(other)
    off = x - x.mean(0)
    scatter = off.T @ off
    largest = max(np.linalg.eigvalsh(scatter)[-1], 1e-300)
    assert np.abs(one.values - np.linalg.eigvalsh(scatter)).max() < 1e-12 * largest
    assert np.abs(one.vectors.T @ one.vectors - np.eye(size)).max() < 1e-12
    assert np.abs(scatter @ one.vectors - one.vectors * one.values).max() < 1e-11 * largest
