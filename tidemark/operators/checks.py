"""Data-quality checks. Each returns the failing rows; an empty result passes."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import quote_name
from tidemark.functions.timestamps import dateadd
from tidemark.operators import joins
from tidemark.operators.ordered import neighbour
from tidemark.operators.reshape import repeat_rows


def _where(df: DataFrame, where: str | None) -> DataFrame:
    return df.where(where) if where else df


def _col(name: str) -> Column:
    return F.col(quote_name(name))


def not_null(df: DataFrame, column: str, where: str | None = None) -> DataFrame:
    return _where(df, where).where(_col(column).isNull())


def unique(df: DataFrame, column: str, where: str | None = None) -> DataFrame:
    """Values that occur more than once."""
    counts = _where(df, where).where(_col(column).isNotNull()).groupBy(_col(column).alias("unique_field"))
    return counts.agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1")


def accepted_values(df: DataFrame, column: str, values: Sequence, where: str | None = None) -> DataFrame:
    """Values outside the list with their counts; NULL passes."""
    counts = _where(df, where).groupBy(_col(column).alias("value_field")).agg(F.count(F.lit(1)).alias("n_records"))
    return counts.where(~F.col("value_field").isin(list(values)))


def not_accepted_values(df: DataFrame, column: str, values: Sequence, where: str | None = None) -> DataFrame:
    """Forbidden values that occur."""
    return _where(df, where).select(_col(column).alias("value_field")).where(
        F.col("value_field").isin(list(values))).distinct()


def relationships(child: DataFrame, column: str, to: DataFrame, field: str) -> DataFrame:
    """Child rows whose key has no parent."""
    return joins.without_parent(child, column, to, field).select(_col(column).alias("from_field"))


def relationships_where(child: DataFrame, column: str, to: DataFrame, field: str,
                        from_condition: str = "true", to_condition: str = "true") -> DataFrame:
    return relationships(child.where(from_condition), column, to.where(to_condition), field)


def orphan_count(child: DataFrame, column: str, to: DataFrame, field: str) -> DataFrame:
    """How many child rows lack a parent, in one row. Children are counted per key before the join, so a
    hot key travels as one row."""
    counted = child.groupBy(_col(column).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    return joins.without_parent(counted, "_k", to, field).agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("failures"))


def violates(expression: str, column: str | None = None) -> Column:
    """The condition of rows that break an expression; with a column the expression starts at the operator."""
    return ~F.expr(f"{quote_name(column)} {expression}" if column else expression)


def expression_is_true(df: DataFrame, expression: str, column: str | None = None,
                       condition: str | None = None) -> DataFrame:
    """Rows for which the expression is false; unknown passes."""
    return _where(df, condition).where(violates(expression, column))


def accepted_range(df: DataFrame, column: str, min_value=None, max_value=None, inclusive: bool = True,
                   where: str | None = None) -> DataFrame:
    """Rows outside the range; either end may be open; NULL passes. Bounds are values or columns."""
    if min_value is None and max_value is None:
        raise ValueError("give min_value, max_value or both")
    c, bad = _col(column), F.lit(False)
    if min_value is not None:
        bad = bad | ((c < min_value) if inclusive else (c <= min_value))
    if max_value is not None:
        bad = bad | ((c > max_value) if inclusive else (c >= max_value))
    return _where(df, where).where(bad)


def at_least_one(df: DataFrame, column: str) -> DataFrame:
    """One row when no row holds a value."""
    return df.agg(F.count(_col(column)).alias("filled")).where("filled = 0")


def not_constant(df: DataFrame, column: str) -> DataFrame:
    """One row when there is exactly one distinct value."""
    ends = df.agg(F.min(_col(column)).alias("low"), F.max(_col(column)).alias("high"))
    return ends.where("low is not null and low = high").select(F.lit(1).cast("bigint").alias("distinct_values"))


def not_null_proportion(df: DataFrame, column: str, at_least: float, at_most: float = 1.0) -> DataFrame:
    """One row when the share of non-null values is out of range."""
    share = df.agg(F.avg(_col(column).isNotNull().cast("double")).alias("not_null_proportion"))
    return share.where(~F.col("not_null_proportion").between(at_least, at_most))


def unique_combination(df: DataFrame, columns: Sequence[str], where: str | None = None) -> DataFrame:
    """Key groups with more than one row; NULLs are equal to each other."""
    counts = _where(df, where).groupBy(*[_col(c) for c in columns]).agg(F.count(F.lit(1)).alias("n_records"))
    return counts.where("n_records > 1").drop("n_records")


def cardinality_equality(df: DataFrame, column: str, to: DataFrame, field: str) -> DataFrame:
    """(value, count) pairs found on one side only.

    Both sides are counted in one aggregation; a value whose counts differ gives one row per side that has it.
    """
    a = df.select(_col(column).alias("value_field"), F.lit(1).alias("_a"), F.lit(0).alias("_b"))
    b = to.select(_col(field).alias("value_field"), F.lit(0).alias("_a"), F.lit(1).alias("_b"))
    counts = a.unionAll(b).groupBy("value_field").agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))
    sides = F.filter(F.array("_a", "_b"), lambda n: n > 0)
    return counts.where("_a <> _b").select("value_field", F.explode(sides).alias("num_rows"))


def equality(df: DataFrame, compare: DataFrame, columns: Sequence[str] | None = None,
             counted: bool = False) -> DataFrame:
    """Rows on one side only; set-based unless ``counted``."""
    return joins.set_difference(df, compare, columns, counted)


def equality_failures(differences: DataFrame) -> DataFrame:
    """Failure count of :func:`equality`: the rows plus the imbalance of the two sides."""
    only_a, only_b = (F.count_if(F.col("which_diff") == s) for s in ("a_minus_b", "b_minus_a"))
    return differences.agg((F.count(F.lit(1)) + F.abs(only_a - only_b)).alias("failures"))


def _row_counts(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row with the row counts of two tables; the two one-row counts are summed, not joined."""
    left = a.agg(F.count(F.lit(1)).alias("count_a")).withColumn("count_b", F.lit(0).cast("bigint"))
    right = b.agg(F.count(F.lit(1)).alias("count_b")).select(F.lit(0).cast("bigint").alias("count_a"), "count_b")
    return left.unionAll(right).agg(F.sum("count_a").alias("count_a"), F.sum("count_b").alias("count_b"))


def equal_rowcount(df: DataFrame, compare: DataFrame) -> DataFrame:
    """One row with both counts and their difference; fails when ``diff_count`` is not 0."""
    return _row_counts(df, compare).withColumn("diff_count", F.abs(F.col("count_a") - F.col("count_b")))


def fewer_rows_than(df: DataFrame, compare: DataFrame) -> DataFrame:
    """One row; ``row_count_delta`` is the excess, 1 for equal counts, 0 when there are fewer rows."""
    more = F.col("count_a") - F.col("count_b")
    return _row_counts(df, compare).withColumn(
        "row_count_delta", F.when(more > 0, more).when(more == 0, 1).otherwise(0).cast("bigint"))


def recency(df: DataFrame, field: str, datepart: str, interval: int, as_of: Column | None = None) -> DataFrame:
    """One row when the newest value is older than the interval."""
    now = F.current_timestamp() if as_of is None else as_of.cast("timestamp")
    return df.agg(F.max(_col(field)).alias("most_recent")).where(F.col("most_recent") < dateadd(datepart, -interval, now))


def sequential_values(df: DataFrame, column: str, interval: int = 1, datepart: str | None = None,
                      slices: int | None = None) -> DataFrame:
    """Rows that do not follow their predecessor by exactly the interval.

    Equal values are counted first and only distinct ones are put in order, in range slices; the copies of a
    value follow each other, so each copy but the first has the value itself as predecessor.
    """
    def follows(value: Column, previous: Column) -> Column:
        if datepart:
            return value.cast("timestamp") == dateadd(datepart, interval, previous.cast("timestamp"))
        return value == previous + interval

    value, previous = F.col("value"), F.col("previous_value")
    distinct = df.groupBy(_col(column).alias("value")).agg(F.count(F.lit(1)).alias("_n"))
    pairs = neighbour(distinct, [value.asc_nulls_last()], {"value": "previous_value"}, -1, slices=slices)
    firsts = pairs.where(~follows(value, previous)).select("value", "previous_value")
    copies = distinct.where(~follows(value, value)).select("value", value.alias("previous_value"), "_n")
    return firsts.unionAll(repeat_rows(copies, F.col("_n") - 1).drop("_n"))


def mutually_exclusive_ranges(df: DataFrame, lower: str, upper: str, partition_by: str | None = None,
                              gaps: str = "allowed", zero_length_range_allowed: bool = False,
                              slices: int | None = None) -> DataFrame:
    """Ranges that are empty, lack a bound, or touch the next range in a way ``gaps`` does not allow.

    Equal ranges are counted first, so only distinct ones are put in order.
    """
    touches = {"allowed": lambda u, n: u <= n, "not_allowed": lambda u, n: u == n, "required": lambda u, n: u < n}
    if gaps not in touches:
        raise ValueError(f"gaps must be one of {sorted(touches)}")
    keys = [partition_by] if partition_by else []
    low, high, following = F.col("lower_bound"), F.col("upper_bound"), F.col("next_lower_bound")
    ranges = df.groupBy(*[_col(k) for k in keys], _col(lower).alias("lower_bound"),
                        _col(upper).alias("upper_bound")).agg(F.count(F.lit(1)).alias("_n"))
    order = [low.asc_nulls_last(), high.asc_nulls_last()]
    lasts = neighbour(ranges, order, {"lower_bound": "next_lower_bound"}, 1, keys, slices).drop("_has_neighbour")
    # copies of a range follow each other: all but the last have the range itself as successor
    copies = ranges.withColumn("next_lower_bound", low).withColumn("_n", F.col("_n") - 1)
    ordered = low <= high if zero_length_range_allowed else low < high

    def failing(pairs: DataFrame) -> DataFrame:
        checked = pairs.withColumns({
            "is_last_record": following.isNull(),
            "lower_before_upper": F.coalesce(ordered, F.lit(False)),
            "upper_before_next": F.coalesce(touches[gaps](high, following), following.isNull()),
        })
        return checked.where(~(F.col("lower_before_upper") & F.col("upper_before_next")))

    repeated = repeat_rows(failing(copies), F.col("_n"))
    return failing(lasts.withColumn("_n", F.lit(1).cast("bigint"))).unionByName(repeated).drop("_n")


def assert_equal(df: DataFrame, actual: str, expected: str) -> DataFrame:
    return df.where(_col(actual) != _col(expected))


def not_empty_string(df: DataFrame, column: str) -> DataFrame:
    return df.where(_col(column) == "")


@dataclass(frozen=True)
class Check:
    """One declared check of a table: a row condition, a column that must be unique, a column with its accepted values, or a
    frame of failing rows. All but the last share one pass over the table."""

    model: str
    name: str
    broken: Column | None = None
    key: str | None = None
    accepted: tuple[str, Sequence] | None = None
    failing: Callable[[dict[str, DataFrame]], DataFrame] | None = None
    severity: str = "error"


def _in_one_pass(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row with the failures ``c0``, ``c1``, ... of the checks.

    The table is grouped once, by every unique column and every column with accepted values, each a grouping set of its own; the row
    conditions are counted along with the first. A second aggregation over the groups counts the failures.
    """
    columns = list(dict.fromkeys([c.key or c.accepted[0] for c in checks if c.broken is None]))
    counts = [F.count_if(c.broken).alias(f"n{i}") for i, c in enumerate(checks) if c.broken is not None]
    if not columns:
        return df.agg(*counts).withColumnsRenamed({f"n{i}": f"c{i}" for i in range(len(checks))})
    by = [_col(c) for c in columns]
    grouped = df.groupingSets([[c] for c in by], *by).agg(F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("_n"), *counts)

    def own(column: str) -> Column:
        """The groups of a column: only its bit is clear in the grouping id."""
        return F.col("_set") == (1 << len(columns)) - 1 - (1 << (len(columns) - 1 - columns.index(column)))

    def failures(i: int, c: Check) -> Column:
        if c.broken is not None:
            return F.coalesce(F.sum(F.when(own(columns[0]), F.col(f"n{i}"))), F.lit(0))
        if c.key:
            return F.count_if(own(c.key) & _col(c.key).isNotNull() & (F.col("_n") > 1))
        column, values = c.accepted
        return F.count_if(own(column) & ~_col(column).isin(list(values)))
    return grouped.agg(*[failures(i, c).alias(f"c{i}") for i, c in enumerate(checks)])


def run_checks(tables: dict[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """One row per check: model, test, failures, severity, status.

    A failing frame with a ``failures`` column reports that number instead of its row count.
    """
    parts = []
    for model in dict.fromkeys(c.model for c in checks):
        shared = [c for c in checks if c.model == model and c.failing is None]
        if shared:
            counts = _in_one_pass(tables[model], shared)
            listed = F.array(*[F.struct(F.lit(c.name).alias("test"), F.col(f"c{i}").cast("bigint").alias("failures"),
                                        F.lit(c.severity).alias("severity")) for i, c in enumerate(shared)])
            parts.append(counts.select(F.inline(listed)).select(F.lit(model).alias("model"), "*"))
        for c in checks:
            if c.model == model and c.failing is not None:
                failed = c.failing(tables)
                number = F.sum("failures") if "failures" in failed.columns else F.count(F.lit(1))
                parts.append(failed.agg(F.coalesce(number, F.lit(0)).cast("bigint").alias("failures")).select(
                    F.lit(model).alias("model"), F.lit(c.name).alias("test"), "failures",
                    F.lit(c.severity).alias("severity")))
    summary = parts[0]
    for p in parts[1:]:
        summary = summary.unionAll(p)
    status = (F.when(F.col("failures") == 0, "pass").when(F.col("severity") == "warn", "warn").otherwise("fail"))
    return summary.withColumn("status", status)


# The accepted statuses of orders, payments and shipments.
ORDER_STATUSES = ["processing", "shipped", "delivered", "cancelled", "pending", "refunded"]
PAYMENT_STATUSES = ["completed", "failed", "pending", "refunded"]
SHIPMENT_STATUSES = ["pending", "in_transit", "delivered", "returned", "cancelled", "exception"]

# The key of every table.
KEYS = {"stg_customers": "customer_id", "stg_orders": "order_id", "stg_payments": "payment_id",
        "stg_products": "product_id", "stg_shipments": "tracking_number", "order_facts": "order_id",
        "daily_metrics": "day", "customer_360": "customer_id", "rfm_scores": "customer_id",
        "product_catalog": "product_id"}


def declared_suite() -> list[Check]:
    """The checks declared on the ten silver and gold tables."""
    def required(model: str, column: str) -> Check:
        return Check(model, f"not_null_{column}", broken=F.col(column).isNull())

    def listed(model: str, column: str, values: list[str]) -> Check:
        return Check(model, f"accepted_values_{column}", accepted=(column, values))

    def belongs(model: str, column: str, parent: str) -> Check:
        return Check(model, f"relationships_{column}", failing=lambda t: orphan_count(t[model], column, t[parent], column))

    suite = []
    for model, key in KEYS.items():
        suite.append(required(model, key))
        suite.append(Check(model, f"unique_{key}", key=key))
    suite += [
        required("stg_customers", "email"),
        required("stg_orders", "customer_id"),
        belongs("stg_orders", "customer_id", "stg_customers"),
        listed("stg_orders", "order_status", ORDER_STATUSES),
        listed("stg_orders", "payment_status", PAYMENT_STATUSES),
        required("stg_payments", "order_id"),
        belongs("stg_payments", "order_id", "stg_orders"),
        listed("stg_payments", "payment_status", PAYMENT_STATUSES),
        required("stg_shipments", "order_id"),
        belongs("stg_shipments", "order_id", "stg_orders"),
        listed("stg_shipments", "status", SHIPMENT_STATUSES),
        required("order_facts", "customer_id"),
        Check("order_facts", "expression_total_amount", broken=violates(">= 0", "total_amount"), severity="warn"),
    ]
    return suite
