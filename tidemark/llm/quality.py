"""Rule-based quality filter: a table of thresholds compiled into one projection, with built-in functions only.

``measured`` adds every measure of a text as columns of one projection; ``THRESHOLDS`` names a measure, its lower and
upper bound; ``verdict`` turns that table into one Boolean expression. There is no shuffle, join or user function: a
document is judged where it is read, whatever the size of its source.

Words are the runs of characters other than space and U+0009 to U+000D. Repeated three-word windows are found by
sorting the window hashes of the one document (64 bits; a false match within one text of a million words has a
probability below 1e-7), so the work for a text is n log n.

Defined cases: null, empty and blank texts have no words, all counts 0, base_failed true and kept false. Measures that
divide by the number of words or lines are 0 there. Extra columns are passed on by ``measured`` unless they carry the
name of a measure, which replaces them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GAP = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50

# Frequent short function words of the languages served.
STOP_WORDS = (
    "the and of to in that is for with was on as are be by this "
    "der die und das in den von zu mit sich des auf ist dem ein eine "
    "de la le les et des en un une du dans que est pour par sur au "
    "el los las y que del se por con para una su al es lo"
).split()

#: Measure, smallest and largest value that passes (None: no bound).
THRESHOLDS: tuple[tuple[str, float | None, float | None], ...] = (
    ("mean_word_chars", 1.5, 20.0),
    ("symbol_ratio", None, 0.10),
    ("shout_ratio", None, 0.20),
    ("stop_word_ratio", 0.01, None),
    ("dup_line_ratio", None, 0.50),
    ("repeat_ratio", None, 0.50),
)


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, computing ``value`` once however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def repeated_window_words(words: Column, width: int = 3) -> Column:
    """Number of words inside windows of ``width`` words that occur twice or more in the array."""
    n = F.size(words)

    def sorted_windows(starts: Column) -> Column:
        return F.array_sort(F.transform(starts, lambda i: F.struct(
            F.xxhash64(*[F.get(words, i + k) for k in range(width)]).alias("h"), i.alias("i"))))

    def repeats(w: Column) -> Column:
        last = F.size(w) - 1
        return F.array_sort(F.transform(
            F.filter(F.transform(w, lambda x, k: F.struct(
                x["i"].alias("i"),
                (((k > 0) & (F.get(w, k - 1)["h"] == x["h"])) | ((k < last) & (F.get(w, k + 1)["h"] == x["h"]))).alias("twice"))),
                lambda x: x["twice"]), lambda x: x["i"]))

    def covered(at: Column) -> Column:
        total = F.aggregate(at, F.struct(F.lit(0).cast("long").alias("sum"), F.lit(-width).alias("last")), lambda s, i: F.struct(
            (s["sum"] + F.least(F.lit(width), i - s["last"])).alias("sum"), i.alias("last")))
        return total["sum"]

    starts = F.when(n >= width, F.sequence(F.lit(0), n - width)).otherwise(F.array().cast("array<int>"))
    return bind(sorted_windows(starts), lambda w: bind(repeats(w), covered))


def _measures(text: Column, words: Column, lines: Column) -> Column:
    n_words = F.size(words).cast("long")
    return F.struct(
        n_words.alias("n_words"),
        F.char_length(F.array_join(words, "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        repeated_window_words(words).alias("n_repeat_words"),
        F.size(lines).cast("long").alias("n_lines"),
        F.regexp_count(text, F.lit("!")).cast("long").alias("n_shouts"),
        F.size(F.filter(words, lambda w: F.lower(w).isin(STOP_WORDS))).cast("long").alias("n_stop_words"))


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the counts of ``_measures`` and the ratios named in ``THRESHOLDS``."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    found = bind(words_of(whole), lambda w: bind(
        F.filter(F.split(whole, "\n"), lambda x: x.rlike(WORD)), lambda lines: _measures(whole, w, lines)))
    counted = docs.withColumn("_found", found)
    names = [f.name for f in counted.schema["_found"].dataType.fields]
    counted = counted.withColumns({n: F.col(f"_found.{n}") for n in names}).drop("_found")

    def ratio(part: str, whole: str) -> Column:
        return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))

    return counted.withColumns({
        "mean_word_chars": ratio("word_chars", "n_words"),
        "symbol_ratio": ratio("n_symbols", "n_words"),
        "shout_ratio": ratio("n_shouts", "n_words"),
        "stop_word_ratio": ratio("n_stop_words", "n_words"),
        "dup_line_ratio": ratio("n_dup_lines", "n_lines"),
        "repeat_ratio": ratio("n_repeat_words", "n_words")})


def verdict(thresholds=THRESHOLDS) -> Column:
    """True when every measure lies within its bounds."""
    passed = F.lit(True)
    for name, low, high in thresholds:
        if low is not None:
            passed = passed & (F.col(name) >= low)
        if high is not None:
            passed = passed & (F.col(name) <= high)
    return passed


def judged(docs: DataFrame, thresholds=THRESHOLDS, text: str = "text") -> DataFrame:
    """``docs`` with all measures, ``base_failed`` and ``kept``."""
    base_failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED_PERCENT)
    return measured(docs, text).withColumn("base_failed", base_failed).withColumn("kept", ~F.col("base_failed") & verdict(thresholds))


def quality_rules(docs: DataFrame) -> DataFrame:
    """The verdicts: one row per document, all over whole texts."""
    return judged(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def oracle_sql() -> str:
    """The same verdicts for another SQL engine."""
    bounds = " AND ".join(
        f"{name} {op} {value}" for name, low, high in THRESHOLDS for op, value in ((">=", low), ("<=", high)) if value is not None)
    stops = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))
    return rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '{GAP}'), lambda x: x <> '') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines,
         row_number() OVER () AS row_id
  FROM documents),
w AS (
  SELECT row_id, unnest(list_transform(range(len(words) - 2), lambda i: words[i + 1] || ' ' || words[i + 2] || ' ' || words[i + 3])) AS gram,
         unnest(range(len(words) - 2)) AS i
  FROM d WHERE len(words) >= 3),
twice AS (SELECT row_id, i FROM (SELECT row_id, i, count(*) OVER (PARTITION BY row_id, gram) AS n FROM w) WHERE n > 1),
covered AS (
  SELECT row_id, count(DISTINCT p) AS n FROM (SELECT row_id, i + unnest([0, 1, 2]) AS p FROM twice) GROUP BY row_id),
m AS (
  SELECT d.doc_id, len(words) AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words, len(lines) AS n_lines,
         length(text) - length(replace(text, '!', '')) AS n_shouts,
         len(list_filter(words, lambda x: lower(x) IN ({stops}))) AS n_stop_words
  FROM d LEFT JOIN covered USING (row_id)),
r AS (
  SELECT *, CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END AS mean_word_chars,
         CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0 END AS symbol_ratio,
         CASE WHEN n_words > 0 THEN n_shouts / n_words ELSE 0 END AS shout_ratio,
         CASE WHEN n_words > 0 THEN n_stop_words / n_words ELSE 0 END AS stop_word_ratio,
         CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END AS dup_line_ratio,
         CASE WHEN n_words > 0 THEN n_repeat_words / n_words ELSE 0 END AS repeat_ratio,
         n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words AS base_failed
  FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND {bounds} AS kept
FROM r"""
