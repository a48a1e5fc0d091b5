"""Hard negatives for contrastive training: rows of other labels that score high against an anchor, but not as high as its positives.

The points are packed into an R-tree (:mod:`tidemark.llm.rtree`): tiles are cut along quantiles of a bounded sample (``SAMPLE`` rows, the only
thing that is sampled), every point goes to its tile by one shuffle, and tasks pack their points into leaves and write them in that
order. Tiles are a matter of speed only; results are exact. Anchors come in rounds of about ``ROUND`` and are sent to all tasks, each of which runs the
best-first search over the boxes of what it reads and keeps a few rows for each anchor (and positive). Those are cut to the first of all tasks
by a window over (anchor, positive). A round scans the index twice: for positives, and then for negatives in the score windows they give.

Vectors are whole numbers, scores their exact inner products: in floating point while no sum can reach 2^53, in Python integers beyond.

Defined cases: rows with a null id, label or vector, or with a null or non-finite component, take no part. A shorter vector counts as
followed by zeros. Rows repeated with id, label and vector count once; different rows under one id are all points, and each is an anchor if the id is
one, but no row is a positive of its own id. Components beyond 2^59 count as that; a score that 64 bits cannot hold is null. Ties go to the smaller
id. Extra columns are ignored. Empty input, an anchor without positives, or without rows in a window, give no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import vectors
from tidemark.llm.rtree import Best, Cuts, Tree, packed_order, search
from tidemark.llm.words import mix
from tidemark.session import stage

POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90  # the score window, in hundredths of the positive's score
SCALE = 256
SAMPLE = 16_384
TILE_ROWS = 8192
ROUND = 8192
_MOST = 1 << 59
_STEPS = 1_000_003

_POINTS = "vec_id long, label long, x array<long>"
_TILED = pa.schema([("tile", pa.int64()), ("vec_id", pa.int64()), ("label", pa.int64()), ("x", pa.list_(pa.int64()))])
_PACKED = pa.schema([("leaf", pa.int64()), *list(_TILED)[1:]])


def points_of(rows: DataFrame, vector: str = "embedding", label: Column | str = "label", scale: int = SCALE) -> DataFrame:
    """Id, label and whole-number vector of the rows that take part."""
    label = F.col(label) if isinstance(label, str) else label
    x = F.transform(vectors.scaled(F.col(vector), scale), lambda v: F.greatest(F.least(v, F.lit(_MOST)), F.lit(-_MOST)))
    return (rows.where(vectors.is_whole(F.col(vector)) & F.col("vec_id").isNotNull() & label.isNotNull())
            .select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), x.alias("x")))


def _ties(ids: np.ndarray) -> np.ndarray:
    return mix(ids.astype(np.uint64))


class Space:
    """The packed points with what the search has to know of them: dimension, number of points, and whether doubles hold every score."""

    def __init__(self, points: DataFrame):
        points = stage(points.distinct(), "points")
        size = F.max(F.size("x"))
        most = F.max(F.coalesce(F.array_max(F.transform("x", F.abs)), F.lit(0)))
        self.count, dim, most = points.agg(F.count("*"), size, most).first()
        self.dim, self.most = dim or 0, most or 0
        self.exact = self.dim * self.most * self.most < 1 << 53
        self.points = points
        self.packed = self._pack(points)

    @property
    def score_type(self) -> str:
        return "long" if self.exact else "decimal(38,0)"

    def matrix(self, column: pa.Array) -> np.ndarray:
        return vectors.matrix(column, self.dim).astype(float if self.exact else object)

    def _cuts(self, points: DataFrame) -> Cuts:
        share = F.pmod(F.xxhash64("vec_id", "x"), F.lit(_STEPS)).cast("double") * self.count < SAMPLE * _STEPS
        rows = points.where(share).limit(2 * SAMPLE).toArrow().sort_by("vec_id").combine_chunks()
        if not rows.num_rows:
            return Cuts(np.zeros(0), np.zeros((0, 0)), np.zeros(0), 1)
        x = vectors.matrix(rows.column("x").combine_chunks(), self.dim)
        ids = rows.column("vec_id").to_numpy()
        return Cuts(rows.column("label").to_numpy(), x, _ties(ids), -(-self.count // TILE_ROWS))

    def _pack(self, points: DataFrame) -> DataFrame:
        cuts, dim = self._cuts(points), self.dim

        def tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for block in vectors.blocks(batches, dim):
                ids, labels = block.column("vec_id").to_numpy(), block.column("label").to_numpy()
                tiles = cuts.tiles(labels, vectors.matrix(block.column("x"), dim), _ties(ids))
                yield pa.RecordBatch.from_arrays([pa.array(tiles), *[block.column(c) for c in ("vec_id", "label", "x")]], schema=_TILED)

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            first = 0
            for block in vectors.blocks(batches, dim):  # rows of a tile stand together
                ids, labels, x = block.column("vec_id").to_numpy(), block.column("label").to_numpy(), vectors.matrix(block.column("x"), dim)
                order, leaf = packed_order(labels, x, _ties(ids))
                flat = pa.ListArray.from_arrays(pa.array(np.arange(len(order) + 1, dtype=np.int32) * dim), pa.array(x[order].ravel()))
                yield pa.RecordBatch.from_arrays([pa.array(leaf + first), pa.array(ids[order]), pa.array(labels[order]), flat], schema=_PACKED)
                first += int(leaf[-1]) + 1
        tiled = points.mapInArrow(tile, f"tile long, {_POINTS}").repartition("tile").sortWithinPartitions("tile")
        return stage(tiled.mapInArrow(pack, f"leaf long, {_POINTS}"), "packed")

    def searched(self, schema: str, found: Callable[[Iterator[Tree]], list[tuple]]) -> DataFrame:
        """What ``found`` makes of all trees of a task, as rows."""
        fields = [f.strip().split() for f in schema.replace("decimal(38,0)", "decimal").split(",")]
        kinds = {"long": pa.int64(), "int": pa.int32(), "decimal": pa.decimal128(38, 0)}
        arrow = pa.schema([(name, kinds[kind]) for name, kind in fields])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            trees = (Tree(b.column("vec_id").to_numpy(), b.column("label").to_numpy(), self_matrix(b.column("x")), b.column("leaf").to_numpy())
                     for b in vectors.blocks(batches, dim) if b.num_rows)
            rows = found(trees)
            for first in range(0, len(rows), 100_000):
                part = list(zip(*rows[first:first + 100_000]))
                yield pa.RecordBatch.from_arrays([pa.array([int(v) for v in c], f.type) for c, f in zip(part, arrow)], schema=arrow)
        dim, exact = self.dim, self.exact

        def self_matrix(column: pa.Array) -> np.ndarray:
            return vectors.matrix(column, dim).astype(float if exact else object)
        return self.packed.mapInArrow(run, schema)


def _first(rows: DataFrame, keys: list[str], score: str, key: str, size: int, rank: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col(score).desc(), F.col(key).asc())
    return rows.withColumn(rank, F.row_number().over(order)).where(F.col(rank) <= size)


def positives_of(space: Space, anchors, size: int = POSITIVES) -> DataFrame:
    """The first other rows of the same label for every anchor of the broadcast (ids, labels, vectors)."""
    def found(trees: Iterator[Tree]) -> list[tuple]:
        ids, labels, x = anchors.value
        best = [Best(size) for _ in ids]
        for tree in trees:
            low, high = tree.intervals(x)
            for a, own in enumerate(best):
                search(tree, x[a], low[:, a], high[:, a], [own], labels[a], True, ids[a])
        return [(a, ids[a], i, -s) for a, own in enumerate(best) for s, i in own.kept]
    rows = space.searched(f"anchor long, anchor_id long, positive_id long, positive_score {space.score_type}", found)
    return _first(rows, ["anchor"], "positive_score", "positive_id", size, "nth")


def negatives_of(space: Space, anchors, positives, size: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """The first rows of other labels in the score window of every positive; ``positives``: per anchor a list of (id, score)."""
    def found(trees: Iterator[Tree]) -> list[tuple]:
        ids, labels, x = anchors.value
        own = positives.value
        best = {a: [Best(size, -(-low * s // 100), high * s // 100) for _, s in own[a]] for a in own}
        for tree in trees:
            lows, highs = tree.intervals(x)
            for a, windows in best.items():
                open_ = [w for w in windows if w.low <= w.high]
                if open_:
                    search(tree, x[a], lows[:, a], highs[:, a], open_, labels[a], False, None)
        return [(a, nth, ids[a], own[a][nth][0], own[a][nth][1], i, -s) for a, windows in best.items() for nth, w in enumerate(windows) for s, i in w.kept]
    kind = space.score_type
    rows = space.searched(f"anchor long, nth int, anchor_id long, positive_id long, positive_score {kind}, negative_id long, negative_score {kind}", found)
    return _first(rows, ["anchor", "nth"], "negative_score", "negative_id", size, "rank")


COLUMNS = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def hard_negatives(points: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   low: int = LOW, high: int = HIGH) -> DataFrame:
    """Per anchor and positive the first ``negatives`` rows of other labels whose score lies in the window."""
    spark, space = points.sparkSession, Space(points)
    chosen = stage(space.points.where(is_anchor), "anchors")
    rounds = -(-chosen.count() // ROUND)
    out = []
    for r in range(rounds):
        rows = chosen.where(F.pmod(F.xxhash64("vec_id", "label", "x"), F.lit(rounds)) == r).toArrow()
        rows = rows.take(pa.array(sorted(range(rows.num_rows), key=lambda i, t=rows.to_pylist(): (t[i]["vec_id"], t[i]["label"], t[i]["x"]))))
        if not rows.num_rows:
            continue
        ids, labels = rows.column("vec_id").to_pylist(), rows.column("label").to_pylist()
        anchors = spark.sparkContext.broadcast((ids, labels, space.matrix(rows.column("x").combine_chunks())))
        by_anchor: dict[int, list] = {}
        for p in positives_of(space, anchors, positives).orderBy("anchor", "nth").collect():  # at most ``positives`` for each of ROUND anchors
            by_anchor.setdefault(p["anchor"], []).append((p["positive_id"], int(p["positive_score"])))
        own = spark.sparkContext.broadcast(by_anchor)
        found = negatives_of(space, anchors, own, negatives, low, high)
        fitted = [F.col(c) if space.exact else F.col(c).try_cast("long").alias(c) for c in ("positive_score", "negative_score")]
        out.append(stage(found.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", *fitted), "negatives"))
        anchors.unpersist()
        own.unpersist()
    return reduce(DataFrame.unionAll, out) if out else spark.createDataFrame([], COLUMNS)


def oracle_sql(vector: str = "embedding") -> str:
    """The query op12 in SQL, over the view ``embeddings``: every anchor against every row."""
    return f"""
WITH points AS (
  SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
         [floor(256 * CAST(x AS DOUBLE)) FOR x IN {vector}] AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND {vector} IS NOT NULL
    AND len([x FOR x IN {vector} IF x IS NOT NULL AND isfinite(x)]) = len({vector})),
scores AS (
  SELECT a.vec_id AS anchor_id, p.vec_id AS id, a.label = p.label AS same, CAST(list_dot_product(a.x, p.x) AS BIGINT) AS score
  FROM points a JOIN points p ON a.vec_id <> p.vec_id
  WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS nth
  FROM scores WHERE same),
negatives AS (
  SELECT p.anchor_id, p.positive_id, p.positive_score, s.id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id) AS rank
  FROM positives p JOIN scores s ON p.anchor_id = s.anchor_id
  WHERE p.nth <= 5 AND NOT s.same AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM negatives WHERE rank <= 10"""
