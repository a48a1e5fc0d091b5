"""Benchmark decontamination by a distributed positional inverted index, with built-in functions only.

``build_index`` reads the training texts once and writes the postings (document, position, term) of all terms that
occur in the benchmark, plus one header row per document with its number of words. Nothing is shuffled there: the
benchmark's terms are joined to the words where they are read.

``phrase_hits`` finds every occurrence of every window of the benchmark items. Per window the two rarest terms, by
their number of postings, give the first two lists: the rarest is joined to the second, adjusted by the distance of the
two in the window. What survives is a diagonal (item, document, shift). On it all postings of the item's terms are
intersected, and runs of adjacent matches at least one window long are exact phrase matches. The lists of frequent
terms are only ever read for documents that already match the rarest two. ``proximity_hits`` returns the places where
all terms of an item lie within a span of words, in any order.

A document that occurs a thousand times, or a passage shared by a third of all documents, costs as many rows as it has
matches: joins are on (document, position), never on an item alone.

Words are maximal runs of 0-9, a-z and characters beyond U+007F after A-Z are lower-cased. A window is ``width``
consecutive item words; an item with fewer words, but not none, is one window.

Defined cases: null and empty texts have no words and no hits; null and empty items have no window. Repeated doc_ids
are separate rows, each with its own result; items of the same id count once per document, a null item_id counts as
hit but is not listed. Extra columns are ignored. An empty benchmark gives no hits, an empty table no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import lower_ascii
from tidemark.session import stage

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WIDTH = 10
BROADCAST_TERMS = 200_000  # beyond this number the benchmark's terms are not broadcast but shuffled with the words


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(F.coalesce(text.cast("string"), F.lit(""))), F.lit(WORD), F.lit(0))


def item_terms(items: DataFrame, id_column: str = "item_id", text: str = "text") -> DataFrame:
    """item (a hash of id and text), item_id, n and one row (j, word) per word of an item; equal items count once."""
    found = items.select(F.col(id_column).cast("string").alias("item_id"), words_of(F.col(text)).alias("words")).distinct()
    return found.select(F.xxhash64("item_id", "words").alias("item"), "item_id", F.size("words").alias("n"), F.posexplode("words").alias("j", "word"))


def build_index(docs: DataFrame, terms: DataFrame, text: str = "text") -> DataFrame:
    """Postings of ``terms`` (word, term) in ``docs``: row, doc_id, n_words, pos, term.

    Every document has a row with pos 0 or null, whatever its words, so that the index also lists the documents.
    """
    if terms.count() <= BROADCAST_TERMS:
        terms = F.broadcast(terms)
    words = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id"), words_of(F.col(text)).alias("words"))
    each = words.select("row", "doc_id", F.size("words").cast("long").alias("n_words"), F.posexplode_outer("words").alias("pos", "word"))
    found = each.join(terms, "word", "left").where("term is not null or pos is null or pos = 0")
    return stage(found.select("row", "doc_id", "n_words", "pos", "term"), "postings")


def _windows(terms: DataFrame, counts: DataFrame, width: int) -> DataFrame:
    """Rarest two terms of every window, as term and place in the item: (item, j, term, other_j, other_term), distinct."""
    known = terms.join(counts, "term").select("item", "n", "j", F.struct("postings", "j", "term").alias("t"))
    ahead = Window.partitionBy("item").orderBy("j").rangeBetween(0, width - 1)  # an item's words
    spans = known.select("item", "n", "j", F.array_sort(F.collect_list("t").over(ahead)).alias("span"))
    # a window with a term that has no postings cannot occur; so its rows are fewer than its words
    whole = spans.where((F.size("span") == F.least(F.lit(width), F.col("n"))) & (F.col("j") <= F.greatest(F.lit(0), F.col("n") - width)))
    rare = whole.select("item", F.col("span")[0].alias("a"), F.get("span", F.lit(1)).alias("b"))
    return rare.select("item", F.col("a.j").alias("j"), F.col("a.term").alias("term"),
                       F.coalesce("b.j", "a.j").alias("other_j"), F.coalesce("b.term", "a.term").alias("other_term")).distinct()


def phrase_hits(postings: DataFrame, terms: DataFrame, width: int = WIDTH) -> DataFrame:
    """Exact matches: row, item, item_id, first and last position of each run of at least one whole window.

    ``terms``: item, item_id, n, j, term; ``postings``: row, pos, term.
    """
    counts = postings.groupBy("term").agg(F.count("*").alias("postings"))
    windows = stage(_windows(terms, counts, width), "windows")
    first = postings.join(windows, "term").select("item", "row", F.col("pos") - F.col("j"), F.col("pos") - F.col("j") + F.col("other_j"), F.col("other_term")).toDF(
        "item", "row", "shift", "pos", "term").distinct()
    second = postings.join(windows.select(F.col("other_term").alias("term")).distinct(), "term", "left_semi")
    diagonals = stage(first.join(second, ["row", "pos", "term"]).select("item", "row", "shift").distinct(), "diagonals")
    near = postings.join(diagonals.select("row").distinct(), "row", "left_semi")
    wanted = diagonals.join(terms, "item").withColumn("pos", F.col("shift") + F.col("j"))
    matched = wanted.join(near, ["row", "pos", "term"]).select("item", "item_id", "row", "shift", "n", "j")
    order = Window.partitionBy("item", "row", "shift").orderBy("j")  # at most the words of one item
    runs = matched.withColumn("run", F.col("j") - F.row_number().over(order)).groupBy("item", "item_id", "row", "shift", "run").agg(
        F.min("j").alias("low"), F.max("j").alias("high"), F.count("*").alias("length"), F.max("n").alias("n"))
    return runs.where(F.col("length") >= F.least(F.lit(width), F.col("n"))).select(
        "row", "item", "item_id", (F.col("shift") + F.col("low")).alias("first"), (F.col("shift") + F.col("high")).alias("last"))


def proximity_hits(postings: DataFrame, terms: DataFrame, span: int) -> DataFrame:
    """Places where all distinct terms of an item lie within ``span`` words, in any order: row, item, item_id, first.

    Only documents that hold the item's rarest term and, near it, every other one are looked at.
    """
    counts = postings.groupBy("term").agg(F.count("*").alias("postings"))
    distinct = terms.groupBy("item", "item_id").agg(F.count_distinct("term").alias("n_terms"))
    wanted = terms.select("item", "term").distinct()
    rarest = wanted.join(counts, "term").groupBy("item").agg(F.min_by("term", F.struct("postings", "term")).alias("term"))
    anchors = postings.join(rarest, "term").select("item", "row", F.col("pos").alias("anchor"))
    # blocks of one span: what can lie with the anchor is in its block or a neighbouring one
    around = anchors.select("item", "row", F.explode(F.array(*[F.floor(F.col("anchor") / span) + k for k in (-1, 0, 1)])).alias("block")).distinct()
    near = postings.join(wanted, "term").withColumn("block", F.floor(F.col("pos") / span)).join(around, ["item", "row", "block"])
    here = Window.partitionBy("item", "row").orderBy("pos").rangeBetween(0, span - 1)
    return near.withColumn("together", F.size(F.collect_set("term").over(here))).join(distinct, "item").where("together = n_terms").select(
        "row", "item", "item_id", F.col("pos").alias("first"))


def indexed(docs: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(index, postings, terms): the staged index of ``docs`` for ``items``, its postings and the items' terms."""
    words = item_terms(items)
    terms = words.withColumn("term", F.xxhash64("word"))
    vocabulary = stage(terms.select("word", "term").distinct(), "vocabulary")
    index = build_index(docs, vocabulary)
    return index, index.where("term is not null").select("row", "pos", "term"), stage(terms.drop("word"), "terms")


def contamination(docs: DataFrame, items: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated, one row per row of ``docs``."""
    index, postings, terms = indexed(docs, items)
    hits = stage(phrase_hits(postings, terms, width), "hits")
    positions = hits.select("row", F.explode(F.sequence("first", "last")).alias("pos")).distinct()
    n_hit = positions.groupBy("row").agg(F.count("*").alias("n_hit"))
    found = hits.groupBy("row").agg(F.array_sort(F.collect_set("item_id")).alias("ids"))
    headers = index.where("pos is null or pos = 0").select("row", "doc_id", "n_words")
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    out = headers.join(n_hit, "row", "left").join(found, "row", "left")
    return out.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.size(ids).cast("long").alias("n_items"),
                      F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("items_sha256"), F.col("n_hit").isNotNull().alias("contaminated"))


def oracle_sql(width: int = WIDTH) -> str:
    """The same result for another SQL engine, by comparing whole windows."""
    words = rf"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM documents),
i AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id, {words} AS w FROM benchmark),
sizes AS (SELECT DISTINCT least({width}, len(w)) AS k FROM i WHERE len(w) > 0),
iw AS (SELECT item_id, k, unnest(list_transform(range(len(w) - k + 1), lambda x: array_to_string(w[x + 1:x + k], ' '))) AS gram
       FROM (SELECT *, least({width}, len(w)) AS k FROM i WHERE len(w) > 0)),
dw AS (SELECT r, k, unnest(range(len(w) - k + 1)) AS p,
              unnest(list_transform(range(len(w) - k + 1), lambda x: array_to_string(w[x + 1:x + k], ' '))) AS gram
       FROM d, sizes WHERE len(w) >= k),
hit AS (SELECT DISTINCT r, item_id, p, dw.k FROM dw JOIN iw ON dw.k = iw.k AND dw.gram = iw.gram),
pos AS (SELECT r, count(DISTINCT x) AS n_hit FROM (SELECT r, unnest(range(p, p + k)) AS x FROM hit) GROUP BY r),
ids AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS s FROM (SELECT DISTINCT r, item_id FROM hit WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN pos USING (r) LEFT JOIN ids USING (r)"""
