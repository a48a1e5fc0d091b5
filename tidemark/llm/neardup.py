"""Near-duplicate documents: fast similarity sketches, banding, exact verification, connected components.

A document is the set of its distinct five-word shingles (words split at white space, A-Z lower-cased; fewer than five
words form one shingle). Two documents are linked when 100 * |A & B| >= percent * |A | B|, and a class is a connected
component of links.

How the work is laid out:

1. One pass over the texts yields per document the set size, a 128-bit digest of the set and the band keys. No text is
   shuffled. Documents with equal sets collapse to one vertex before anything else, counted map-side; vertices are numbered, so that rows
   which share an id but not a text stay apart.
2. Representatives meet per (band, key). A bucket never emits all its pairs: its members are compared with two
   leaders, the one with the fewest shingles that no other candidate has, which is the hub of a group of edited copies,
   and the smallest vertex. What then still lies in different components of one bucket is compared exactly, the members
   outside the bucket's largest component against the rest, so no link that could join components is lost; large buckets
   are dealt over several tasks. Shingles
   that occur in one candidate only cannot be common, which rules out documents and pairs beforehand, exactly.
3. Every comparison is made on the whole sets. These are computed only for documents that meet in a bucket; a bitmap of
   fixed size, broadcast, keeps the others out of the shuffle.
4. Components come from contracting the graph of verified links until no link is left.

Sketch: with t coordinates, round i < t throws every element into one random bin and keeps the minimum of (i, hash);
rounds t..2t-1 offer every element to one fixed bin each. The sketch is complete as soon as every bin is filled,
usually after one or two rounds, and always after 2t. Bands of ``rows`` coordinates: a pair of similarity 0.85 is
missed with probability (1 - 0.85**5)**24, below 1e-6, and more similar pairs far less often.

Defined cases: null and empty texts have an empty set, size 0, no links, and are their own class. Rows that share a
doc_id are judged by their own texts: each has the class of its text, named by the smallest id in it. Null doc_ids are kept and form no class (component_id
null). Extra columns are ignored. Empty input gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import Words, mix, text_chunks, window_hashes
from tidemark.session import stage

WIDTH = 5
PERCENT = 85
BANDS = 24
ROWS = 5
BUCKET_PART = 256  # members of a bucket that one row is compared with in one place
CELL_BITS = 7  # shingles are counted in 2**7 cells by their upper bits; the smaller counts bound what is common
BITMAP_BITS = 23  # the bitmap of candidate ids has 2**23 bits, 1 MB

_U = np.uint64


def shingle_sets(batch: pa.RecordBatch, width: int = WIDTH) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of every text in the batch."""
    first = 0
    for part in text_chunks(batch):
        words = Words(part.column("text"))
        hashes = words.hashes()
        for row in range(words.n_rows):
            own = hashes[words.first[row]:words.first[row + 1]]
            if len(own):
                yield first + row, np.unique(window_hashes(own, min(width, len(own))))
            else:
                yield first + row, own
        first += words.n_rows


def similarity_sketch(elements: np.ndarray, t: int) -> np.ndarray:
    """Fast similarity sketch of a non-empty set of 64-bit hashes: ``t`` coordinates, all filled."""
    out = np.full(t, np.iinfo(np.uint64).max, np.uint64)
    for i in range(2 * t):
        h = mix(elements + _U(((2 * i + 1) * 0x9E3779B97F4A7C15) % 2**64))
        value = (h & _U(0xFFFFFFFF)) | _U(i << 32)
        if i < t:
            np.minimum.at(out, ((h >> _U(32)) * _U(t) >> _U(32)).astype(np.int64), value)
        else:
            out[i - t] = min(out[i - t], value.min())
        if (out >> _U(32)).max() <= i:  # every coordinate is filled, later rounds cannot lower one
            break
    return out


def band_keys(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.arange(1, bands + 1, dtype=np.uint64)
    for column in sketch[:bands * rows].reshape(bands, rows).T:
        keys = mix(keys * _U(0xD6E8FEB86659FD93) + column)
    return keys.view(np.int64)


def digest_of(elements: np.ndarray) -> bytes:
    """128 bits that tell sets apart."""
    return hashlib.blake2b(elements.tobytes(), digest_size=16).digest()


def _sketches(bands: int, rows: int, width: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()), ("keys", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, keys = [], [], []
            for _, own in shingle_sets(batch, width):
                sizes.append(len(own))
                digests.append(digest_of(own) if len(own) else None)
                keys.append(band_keys(similarity_sketch(own, bands * rows), bands, rows) if len(own) else None)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                                              pa.array(keys, pa.list_(pa.int64()))], schema=schema)
    return run


def sketched(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, width: int = WIDTH) -> DataFrame:
    """doc_id, n_shingles, digest of the whole set and band keys (both null for an empty set)."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _sketches(bands, rows, width), "doc_id long, n_shingles long, digest binary, keys array<long>")


def _slot(doc_id: Column) -> Column:
    return F.xxhash64(doc_id).bitwiseAND(F.lit((1 << BITMAP_BITS) - 1))


def candidate_bitmap(ids: DataFrame) -> np.ndarray:
    """Bits of the hashed ids, one megabyte whatever the number of ids. A set bit is a may-be; the join after it decides."""
    cells = ids.select(_slot(F.col("doc_id")).alias("slot")).groupBy(F.shiftright("slot", 6).alias("cell")).agg(
        F.bit_or(F.expr("shiftleft(1L, int(slot % 64))")).alias("bits"))
    bitmap = np.zeros(1 << (BITMAP_BITS - 6), np.int64)
    for row in cells.toLocalIterator():  # at most 2**17 rows
        bitmap[row.cell] = row.bits
    return bitmap


def candidate_sets(docs: DataFrame, candidates: DataFrame, width: int = WIDTH) -> DataFrame:
    """vertex, whole shingle set (sorted 64-bit hashes as bytes) and counts by cell of ``candidates`` (vertex, doc_id, digest).

    The id only rules texts out before they are cut up; a set belongs to the vertex that has its digest.
    """
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(candidate_bitmap(candidates))
    schema = pa.schema([("digest", pa.binary()), ("shingles", pa.binary()), ("cells", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = batch.column("slot").to_numpy()
            keep = (held.value[slot >> 6] >> (slot & 63)) & 1 == 1
            batch = batch.filter(pa.array(keep))
            if batch.num_rows:
                sets = [own for _, own in shingle_sets(batch, width)]
                cells = [np.bincount((x >> _U(64 - CELL_BITS)).astype(np.int64), minlength=1 << CELL_BITS).astype(np.int32) for x in sets]
                yield pa.RecordBatch.from_arrays([pa.array([digest_of(x) for x in sets], pa.binary()), pa.array([x.tobytes() for x in sets], pa.binary()),
                                                  pa.array(cells, pa.list_(pa.int32()))], schema=schema)

    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where(
        "doc_id is not null").withColumn("slot", _slot(F.col("doc_id"))).mapInArrow(run, "digest binary, shingles binary, cells array<int>")
    one = found.join(candidates.select("digest", "vertex"), "digest").groupBy("vertex").agg(F.max(F.struct("shingles", "cells")).alias("set"))
    return one.select("vertex", "set.*")


def _verify(percent: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column("left"), batch.column("right"))):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                keep[i] = 100 * common >= percent * (len(x) + len(y) - common)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], schema=schema).filter(pa.array(keep))
    return run


def verified(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough."""
    left = sets.select(F.col("vertex").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("vertex").alias("b"), F.col("shingles").alias("right"))
    small, large = F.least(F.octet_length("left"), F.octet_length("right")), F.greatest(F.octet_length("left"), F.octet_length("right"))
    both = pairs.join(left, "a").join(right, "b").where(small * 100 >= large * percent)  # sizes alone rule out the rest
    return both.select("a", "b", "left", "right").mapInArrow(_verify(percent), "a long, b long")


def connected(edges: DataFrame) -> DataFrame:
    """vertex and label, the smallest vertex reachable, of every end of ``edges`` (a, b).

    Each round joins every vertex to its first neighbour or itself, and contracts. Neighbours are ordered by number in even
    rounds, so that stars end at once, and by a hash in odd ones, so that a chain halves whatever its order.
    """
    edges = edges.select("a", "b")
    steps: list[DataFrame] = []
    while True:
        k = len(steps)
        rank = (lambda c: F.col(c)) if k % 2 == 0 else (lambda c, k=k: F.xxhash64(c, F.lit(k)))
        ends = edges.union(edges.select("b", "a")).union(edges.select("a", "a")).union(edges.select("b", "b")).toDF("v", "w")
        step = stage(ends.groupBy("v").agg(F.min_by("w", F.struct(rank("w"), F.col("w"))).alias("to")), "steps")
        steps.append(step)
        a, b = step.toDF("a", "to_a"), step.toDF("b", "to_b")
        moved = edges.join(a, "a").join(b, "b").where("to_a != to_b")
        edges = stage(moved.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct(), "links")
        if not edges.limit(1).count():
            break
    root = steps[0].toDF("vertex", "root")
    for step in steps[1:]:
        root = root.join(step.toDF("root", "to"), "root", "left").select("vertex", F.coalesce("to", "root").alias("root"))
    if len(steps) == 1:  # joined by number only: roots are smallest vertices
        return root.toDF("vertex", "label")
    root = stage(root, "roots")
    return root.join(root.groupBy("root").agg(F.min("vertex").alias("label")), "root").select("vertex", "label")


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in range(0, batch.num_rows, 256):
            some = batch.slice(part, 256)
            sets = [np.frombuffer(x.as_buffer(), np.int64) for x in some.column("shingles")]
            ids = np.repeat(some.column("vertex").to_numpy(), [len(x) for x in sets])
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(np.concatenate(sets))], names=["vertex", "shingle"])


def own_shingles(sets: DataFrame) -> DataFrame:
    """vertex, n (shingles) and own, how many of them no other candidate has."""
    each = sets.mapInArrow(_spread, "vertex long, shingle long")
    alone = each.groupBy("shingle").agg(F.count("*").alias("n"), F.min("vertex").alias("vertex")).where("n = 1").groupBy("vertex").agg(F.count("*").alias("own"))
    return sets.select("vertex", (F.octet_length("shingles") / 8).cast("long").alias("n")).join(alone, "vertex", "left").fillna(0, ["own"])


def _may_link(n: Column, own: Column, n2: Column, own2: Column, percent: int) -> Column:
    """Two sets can be similar enough: at most what neither has alone is common."""
    common = F.least(n - own, n2 - own2)
    return common * 100 >= (n + n2 - common) * percent


def _in_parts(buckets: DataFrame) -> DataFrame:
    """One row for each part of a bucket, so that a join with its members is spread like them."""
    return buckets.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")


def components(reps: DataFrame, docs: DataFrame, percent: int = PERCENT, width: int = WIDTH) -> DataFrame:
    """vertex and label of the texts in ``reps`` (vertex, doc_id, digest, keys) that have a link."""
    entries = reps.select("vertex", F.posexplode("keys").alias("band", "key"))
    buckets = entries.groupBy("band", "key").agg(F.count("*").alias("members")).where("members > 1").select(
        "band", "key", F.ceil(F.col("members") / BUCKET_PART).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("vertex"), F.col("parts")).cast("int")
    members = stage(entries.join(buckets, ["band", "key"]).withColumn("part", part), "members")
    met = reps.select("vertex", "doc_id", "digest").join(members.select("vertex").distinct(), "vertex", "left_semi")
    sets = stage(candidate_sets(docs, stage(met, "candidates"), width), "sets")
    alive = own_shingles(sets).where(F.col("own") * 100 <= F.col("n") * (100 - percent))  # else too much of its own for any link
    members = stage(members.join(alive, "vertex"), "members")
    member = F.struct("vertex", "n", "own")
    leaders = members.groupBy("band", "key").agg(F.array(
        F.min_by(member, F.struct("own", "vertex")), F.min_by(member, F.struct(F.col("own") + F.col("n"), F.col("vertex"))),
        F.min_by(member, F.struct(F.xxhash64("vertex"), F.col("vertex"))), F.min_by(member, "vertex")).alias("leaders"), F.max("parts").alias("parts"))
    pairs = members.drop("parts").join(_in_parts(leaders), ["band", "key", "part"]).select("vertex", "n", "own", F.explode("leaders").alias("to")).where(
        (F.col("vertex") != F.col("to.vertex")) & _may_link(F.col("n"), F.col("own"), F.col("to.n"), F.col("to.own"), percent))
    edges = stage(verified(_ordered(F.col("vertex"), F.col("to.vertex"), pairs), sets, percent), "edges")
    labels = stage(connected(edges), "labels")
    return _settled(members, reps.select("vertex", "keys"), labels, sets, percent)


def _settled(members: DataFrame, keys: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``labels`` after comparing whatever shares a bucket but no label and is not ruled out by the counts of its cells."""
    here = members.join(labels, "vertex", "left").withColumn("label", F.coalesce("label", "vertex"))
    bounds = here.groupBy("band", "key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.min("n").alias("least"),
                                               F.max("parts").alias("parts")).where("low < high")
    inside = stage(here.join(_in_parts(bounds.select("band", "key", "least", "parts")), ["band", "key", "part"]), "open")
    sizes = inside.groupBy("band", "key", "label").agg(F.count("*").alias("members"), F.max("parts").alias("parts"))
    largest = sizes.groupBy("band", "key").agg(F.max_by("label", F.struct("members", "label")).alias("largest"), F.max("parts").alias("parts"))
    inside = inside.join(_in_parts(largest), ["band", "key", "part"]).join(keys, "vertex").join(sets.select("vertex", "cells"), "vertex")
    # the best partner a set can have lacks just the shingles of its own, or is the smallest in the bucket
    best = F.greatest(F.col("least"), F.col("n") - F.col("own"))
    outside = inside.where((F.col("label") != F.col("largest")) & _may_link(F.col("n"), F.col("own"), best, F.lit(0), percent)).select(
        "band", "key", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), *[F.col(c).alias(f"x_{c}") for c in ("vertex", "label", "n", "own", "keys", "cells")])
    common = F.aggregate(F.zip_with("x_cells", "cells", lambda x, y: F.least(x, y)), F.lit(0), lambda s, x: s + x)  # no more can be common
    first_band = F.array_position(F.zip_with("x_keys", "keys", lambda x, y: x == y), True) - 1  # a pair meets in several, but counts in one
    pairs = outside.join(inside, ["band", "key", "part"]).where(  # a large bucket is met part by part
        (F.col("x_label") != F.col("label")) & ((F.col("label") == F.col("largest")) | (F.col("x_vertex") < F.col("vertex")))
        & _may_link(F.col("x_n"), F.col("x_own"), F.col("n"), F.col("own"), percent)
        & (common * 100 >= (F.col("x_n") + F.col("n") - common) * percent) & (first_band == F.col("band")))
    more = stage(verified(_ordered(F.col("x_vertex"), F.col("vertex"), pairs), sets, percent), "edges")
    if not more.limit(1).count():
        return labels
    found = stage(members.select("vertex").distinct().join(labels, "vertex", "left").select("vertex", F.coalesce("label", "vertex").alias("label")), "labels")
    a, b = found.toDF("a", "la"), found.toDF("b", "lb")
    joined = connected(stage(more.join(a, "a").join(b, "b").select(F.col("la").alias("a"), F.col("lb").alias("b")).distinct(), "links"))
    return stage(found.join(joined.toDF("label", "lower"), "label", "left").select("vertex", F.coalesce("lower", "label").alias("label")), "labels")


def _ordered(x: Column, y: Column, pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct()


def near_duplicates(docs: DataFrame, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS, width: int = WIDTH) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id of the class) and kept (doc_id = component_id), one row per row of ``docs``."""
    every = stage(sketched(docs, bands, rows, width), "sketches")
    classes = every.where("doc_id is not null and digest is not null").groupBy("digest").agg(
        F.min_by(F.struct("doc_id", "n_shingles", "keys"), "doc_id").alias("rep"))
    classes = stage(classes.select(F.monotonically_increasing_id().alias("vertex"), "digest", "rep.*"), "classes")  # numbered once, by writing
    labels = components(classes, docs, percent, width)
    linked = classes.select("vertex", "digest", "doc_id").join(labels, "vertex", "left").withColumn("label", F.coalesce("label", "vertex"))
    lowest = linked.groupBy("label").agg(F.min("doc_id").alias("component"))
    known = linked.join(lowest, "label").select("digest", "component")
    out = every.join(known, "digest", "left")
    component = F.when(F.col("doc_id").isNull(), None).otherwise(F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), (F.col("doc_id") == component).alias("kept"))
