"""Mixing sources to target weights by hash-random order, distributed prefix sums and an exact cut.

Every document gets a random key, a hash of its id and text. Within each source the documents are range-sorted by that key, so that a source
with a third of all documents is spread over many tasks; running sums of their sizes are taken per slice, and what lies before a slice
is added. A source whose target is n times its size and a rest gives n whole epochs and then, in key order, exactly the rest:
the document at the cut gives its first words only.

Targets share the wanted total by weight; a source whose share exceeds ``epochs`` times its size stops there and the excess goes to the others by
weight, again and again. That is one water level: in order of size for weight, a source is full if the level of those from it
onwards lies above it, which running sums over the sources decide. Nothing but single rows per source is ever brought together.

Defined cases: a null text has size 0. The null source is a source, last in order. Documents of size 0 take part and give nothing. Rows that agree
in id and text have the same key; which of them lies before the cut is not determined, the set of results is. A null id counts as empty
text in the key. Extra columns are dropped unless named in ``keep``. Empty input gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordered import row_numbers, running_sums
from tidemark.session import stage

WEIGHTS = (3, 1, 2)  # of the sources in order, repeating
PERCENT = 150  # words of the mix for a hundred words of the sources
EPOCHS = 2  # how often a document may be taken at most
WORD = r"[^\x20\x09-\x0D]+"

_EXACT = "decimal(38,0)"


def measured(docs: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Per document: id, source, size in words and random key."""
    text = F.col("text").cast("string")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(text, F.lit(""))))).alias("_key"),
        *[F.col(c).alias(f"_kept_{c}") for c in keep])


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, percent: int = PERCENT, epochs: int = EPOCHS) -> DataFrame:
    """Per source: size, weight and target in words."""
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    numbered = row_numbers(per_source, [F.col("source").asc_nulls_last()], "_number")
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), F.pmod(F.col("_number") - 1, F.lit(len(weights))).cast("int") + 1)
    weighted = numbered.withColumn("weight", weight).withColumn("_cap", F.col("source_size") * (100 * epochs))  # in hundredths of a word
    by_ratio = [(F.col("_cap").cast("double") / F.col("weight")).asc(), F.col("source").asc_nulls_last()]
    summed = stage(running_sums(weighted, by_ratio, {"_caps": F.col("_cap"), "_weights": F.col("weight")}), "sources")
    whole = summed.agg((F.sum("source_size") * percent).alias("_total"), F.sum("weight").alias("_weight"))
    joined = summed.crossJoin(F.broadcast(whole))  # one row
    left, rest = F.col("_total") - (F.col("_caps") - F.col("_cap")), F.col("_weight") - (F.col("_weights") - F.col("weight"))
    full = F.col("_cap").cast(_EXACT) * rest.cast(_EXACT) <= left.cast(_EXACT) * F.col("weight").cast(_EXACT)
    marked = joined.withColumn("_full", full)
    level = marked.agg(F.coalesce(F.sum(F.when(F.col("_full"), F.col("_cap"))), F.lit(0)).alias("_given"),
                       F.coalesce(F.sum(F.when(F.col("_full"), F.col("weight"))), F.lit(0)).alias("_served"))
    share = ((F.col("_total") - F.col("_given")) * F.col("weight")).cast("double") / ((F.col("_weight") - F.col("_served")) * 100).cast("double")
    target = F.when(F.col("_full"), (F.col("source_size") * epochs).cast("double")).otherwise(share)
    return marked.crossJoin(F.broadcast(level)).select("source", "source_size", "weight", target.alias("target"))


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, percent: int = PERCENT, epochs: int = EPOCHS, keep: Sequence[str] = ()) -> DataFrame:
    """Per document: whole ``copies`` and further first ``words`` that the mix takes, and ``taken``, all its words with repeats."""
    sizes = stage(measured(docs, keep), "sizes")
    goals = targets(sizes, weights, percent, epochs).withColumnRenamed("source", "_source")
    lined_up = running_sums(sizes, [F.col("_key").asc(), F.col("size").asc()], {"_until": F.col("size")}, ["source"])
    budget = F.floor("target").cast("long")
    empty = F.col("source_size") == 0
    copies = F.when(empty, F.lit(0)).otherwise(F.floor(budget / F.greatest(F.col("source_size"), F.lit(1)))).cast("long")
    copies = F.when(copies * F.col("source_size") > budget, copies - 1).otherwise(copies)  # the quotient of doubles may round up
    rest = budget - F.col("copies") * F.col("source_size")
    words = F.least(F.greatest(rest - (F.col("_until") - F.col("size")), F.lit(0)), F.col("size"))
    return (lined_up.join(goals, F.col("source").eqNullSafe(F.col("_source")))
            .withColumn("copies", copies).withColumn("words", words)
            .select("doc_id", "source", "size", "source_size", "target", "copies", "words",
                    (F.col("copies") * F.col("size") + F.col("words")).alias("taken"), *[F.col(f"_kept_{c}").alias(c) for c in keep]))


def mixed_texts(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: one row per document and epoch, in hash-random files. The document at a source's cut gives its first words, one space apart."""
    plan = mix(docs, keep=("text",), **options)
    rounds = plan.withColumn("epoch", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies") + (F.col("words") > 0).cast("long"))))
    cut = (F.col("epoch") > F.col("copies")) & (F.col("words") < F.col("size"))
    first_words = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), 1, F.col("words").cast("int")), " ")
    has_round = (F.col("copies") > 0) | (F.col("words") > 0)
    return (rounds.where(has_round).select("doc_id", "source", "epoch", F.when(cut, first_words).otherwise(F.col("text")).alias("text")))


def report(plan: DataFrame) -> DataFrame:
    """Per source: documents, target and words taken."""
    return plan.groupBy("source", "target").agg(F.count("*").alias("documents"), F.sum("taken").alias("taken"))


def oracle_sql(weights: Sequence[int] = WEIGHTS, percent: int = PERCENT, epochs: int = EPOCHS) -> str:
    """The same result in SQL, over the view ``documents``."""
    pick = " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(weights))
    return rf"""
WITH sizes AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS BIGINT) AS size,
         md5(concat(coalesce(CAST(doc_id AS VARCHAR), ''), ':', md5(coalesce(text, '')))) AS k
  FROM documents),
per_source AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sizes GROUP BY source),
numbered AS (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS i FROM per_source),
weighted AS (SELECT source, source_size, CAST(CASE i % {len(weights)} {pick} END AS BIGINT) AS weight, source_size * {100 * epochs} AS cap FROM numbered),
summed AS (
  SELECT *, coalesce(sum(cap) OVER w, 0) AS caps, coalesce(sum(weight) OVER w, 0) AS weights
  FROM weighted WINDOW w AS (ORDER BY CAST(cap AS DOUBLE) / weight ASC, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
whole AS (SELECT sum(source_size) * {percent} AS total, sum(weight) AS all_weights FROM weighted),
marked AS (
  SELECT s.*, w.total, w.all_weights,
         CAST(s.cap AS HUGEINT) * (w.all_weights - s.weights) <= CAST(w.total - s.caps AS HUGEINT) * s.weight AS is_full
  FROM summed s, whole w),
level AS (SELECT coalesce(sum(CASE WHEN is_full THEN cap END), 0) AS given, coalesce(sum(CASE WHEN is_full THEN weight END), 0) AS served FROM marked),
goals AS (
  SELECT source, source_size, CASE WHEN is_full THEN CAST(source_size * {epochs} AS DOUBLE)
         ELSE CAST((total - given) * weight AS DOUBLE) / CAST((all_weights - served) * 100 AS DOUBLE) END AS target
  FROM marked, level),
lined_up AS (
  SELECT *, CAST(sum(size) OVER (PARTITION BY source ORDER BY k, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) - size AS before
  FROM sizes),
cut AS (
  SELECT l.doc_id, l.size, g.source_size, g.target, l.before,
         CASE WHEN g.source_size = 0 THEN 0 ELSE CAST(floor(g.target) AS BIGINT) // g.source_size END AS copies
  FROM lined_up l JOIN goals g ON l.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       CAST(copies * size + least(greatest(CAST(floor(target) AS BIGINT) - copies * source_size - before, 0), size) AS BIGINT) AS taken
FROM cut"""
