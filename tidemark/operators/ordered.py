"""Order-dependent calculations that survive one huge group.

A window over the whole table, or over one key that holds a third of it, runs in a single task. Here the rows are cut into *slices* by the full
sort order instead, so that a hot key is spread over many of them; each slice is computed on its own and the few values that cross a
slice border (at most one row per slice) are added.

The borders are rows of the table itself, quantiles of those whose hash is smallest, and stand in the plan as literals: a row's slice is
an expression of the row, found by binary search. Building counts the rows and reads that sample, but writes nothing; the result must therefore
be the same whenever the input is evaluated. Borders only decide how evenly the work is dealt.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE = "_slice"
SLICE_BYTES = 16 << 20  # by the default width of the columns' types
MOST_SLICES = 16_384  # borders in a plan; beyond it slices grow
PER_SLICE = 16  # sampled rows for each border
_STEPS = 1_000_003


@dataclass(frozen=True)
class SortKey:
    """One expression of a sort order."""

    value: Column
    descending: bool
    nulls_last: bool

    @classmethod
    def of(cls, order: Column) -> SortKey:
        node = order._jc.node()
        if node.getClass().getSimpleName() != "SortOrder":
            return cls(order, False, False)
        value = type(order)(_column_of(node.child()))
        return cls(value, "Descending" in node.sortDirection().toString(), "NullsLast" in node.nullOrdering().toString())

    def before(self, x: Column, y: Column) -> Column:
        """x stands strictly before y."""
        missing = x.isNotNull() & y.isNull() if self.nulls_last else x.isNull() & y.isNotNull()
        return missing | F.coalesce(x > y if self.descending else x < y, F.lit(False))


def _column_of(node):
    from pyspark import SparkContext
    return SparkContext._active_spark_context._jvm.org.apache.spark.sql.Column(node)


def _literal(value, kind: T.DataType) -> Column:
    if value is not None and isinstance(kind, T.TimestampType):  # sampled as microseconds
        return F.timestamp_micros(F.lit(value))
    return F.lit(value).cast(kind)


class Slices:
    """Borders of a table in one sort order."""

    def __init__(self, df: DataFrame, order_by: Sequence[Column], slices: int | None = None, rows: int | None = None):
        self.keys = [SortKey.of(c) for c in order_by]
        named = df.select(*[k.value.alias(f"k{i}") for i, k in enumerate(self.keys)])
        self.kinds = [f.dataType for f in named.schema.fields]
        if slices is None or rows is None:
            rows = df.count() if rows is None else rows
        if slices is None:
            width = sum(width_of(f.dataType) for f in df.schema.fields)
            slices = min(MOST_SLICES, max(1, -(-rows * width // SLICE_BYTES)))
        self.borders = self._sample(named, slices, rows) if slices > 1 else []

    def _sample(self, named: DataFrame, slices: int, rows: int) -> list[tuple]:
        share = F.pmod(F.xxhash64(*named.columns), F.lit(_STEPS)).cast("double") * rows < F.lit(float(slices) * PER_SLICE * _STEPS)
        order = [self._sorted(F.col(f"k{i}"), k) for i, k in enumerate(self.keys)]
        plain = [F.unix_micros(f"k{i}") if isinstance(t, T.TimestampType) else F.col(f"k{i}") for i, t in enumerate(self.kinds)]
        found = [tuple(r) for r in named.where(share).orderBy(*order).select(*plain).collect()]
        borders = [found[i * len(found) // slices] for i in range(1, slices)] if found else []
        return [b for i, b in enumerate(borders) if i == 0 or b != borders[i - 1]]

    @staticmethod
    def _sorted(column: Column, key: SortKey) -> Column:
        if key.descending:
            return column.desc_nulls_last() if key.nulls_last else column.desc_nulls_first()
        return column.asc_nulls_last() if key.nulls_last else column.asc_nulls_first()

    @property
    def number(self) -> Column:
        """The slice of a row: how many borders do not lie after it."""
        if not self.borders:
            return F.lit(0)
        borders = F.array(*[F.struct(*[_literal(v, t).alias(f"k{i}") for i, (v, t) in enumerate(zip(b, self.kinds))]) for b in self.borders])
        steps = [1 << n for n in reversed(range(len(self.borders).bit_length()))]

        def step(at: Column, ahead: Column) -> Column:
            border = F.get(borders, at + ahead - 1)
            before = F.lit(False)
            for i, k in reversed(list(enumerate(self.keys))):
                y = border[f"k{i}"]
                before = k.before(k.value, y) | (k.value.eqNullSafe(y) & before)
            return F.when((at + ahead <= len(self.borders)) & ~before, at + ahead).otherwise(at)
        return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), step)


def width_of(kind: T.DataType) -> int:
    """Bytes of a value, roughly."""
    if isinstance(kind, T.StructType):
        return sum(width_of(f.dataType) for f in kind.fields)
    return {T.StringType: 20, T.BinaryType: 100, T.ArrayType: 100, T.MapType: 100, T.DecimalType: 16}.get(type(kind), 8)


def slice_in_order(df: DataFrame, order_by: Sequence[Column], slices: int | None = None) -> DataFrame:
    """Rows with a slice number that rises with ``order_by``."""
    return df.withColumn(SLICE, Slices(df, order_by, slices).number)


def _join_carry(local: DataFrame, carry: DataFrame, keys: Sequence[str]) -> DataFrame:
    renamed = carry.withColumnsRenamed({k: f"_c_{k}" for k in [SLICE, *keys]})
    on = local[SLICE] == renamed[f"_c_{SLICE}"]
    for k in keys:
        on = on & local[k].eqNullSafe(renamed[f"_c_{k}"])
    return (local.join(renamed, on, "left")  # at most one row per slice; Spark broadcasts it if it is small
            .drop(*[f"_c_{k}" for k in [SLICE, *keys]]))


def running_sums(df: DataFrame, order_by: Sequence[Column], values: dict[str, Column],
                 partition_by: Sequence[str] = (), slices: int | None = None) -> DataFrame:
    """``sum(value)`` from the first row of each key up to and including the current row, for every named value.

    ``order_by`` must be a total order within a key.
    """
    keys, names = list(partition_by), list(values)
    order = [*[F.col(k).asc() for k in keys], *order_by]
    sliced = slice_in_order(df.withColumns({f"_value_{n}": v for n, v in values.items()}), order, slices)
    here = Window.partitionBy(SLICE, *keys).orderBy(*order_by).rowsBetween(Window.unboundedPreceding, 0)
    totals = sliced.groupBy(SLICE, *keys).agg(F.struct(*[F.sum(f"_value_{n}").alias(n) for n in names]).alias("_total"))
    earlier = F.struct(*[F.sum(F.col("_total")[n]).over(Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)).alias(n) for n in names])
    by_key = Window.partitionBy(*keys).orderBy(SLICE)
    # only the first key of a slice can continue an earlier one, so this has at most one row per slice
    carry = totals.withColumn("_before", earlier).withColumn("_nth", F.row_number().over(by_key)).where("_nth > 1").select(SLICE, *keys, "_before")
    local = sliced.withColumns({f"_local_{n}": F.sum(f"_value_{n}").over(here) for n in names})
    joined = _join_carry(local, carry, keys)
    return (joined.withColumns({n: F.col(f"_local_{n}") + F.coalesce(F.col("_before")[n], F.lit(0)) for n in names})
            .drop(SLICE, "_before", *[f"_value_{n}" for n in names], *[f"_local_{n}" for n in names]))


def running_sum(df: DataFrame, order_by: Sequence[Column], value: Column, name: str,
                partition_by: Sequence[str] = (), slices: int | None = None) -> DataFrame:
    """:func:`running_sums` of one value."""
    return running_sums(df, order_by, {name: value}, partition_by, slices)


def row_numbers(df: DataFrame, order_by: Sequence[Column], name: str = "row_number",
                partition_by: Sequence[str] = (), slices: int | None = None) -> DataFrame:
    """1-based position of each row within its key (or in the whole table)."""
    if partition_by:
        return running_sum(df, order_by, F.lit(1).cast("bigint"), name, partition_by, slices)
    return numbered(df, {name: order_by}, slices)


def _counts(df: DataFrame, cut: dict[str, Slices]) -> dict[str, list[int]]:
    """Rows of every slice, for several orders in one pass."""
    names = list(cut)
    if all(not cut[n].borders for n in names):
        return {n: [0] for n in names}  # one slice: nothing lies before it
    numbers = df.select(*[cut[n].number.alias(f"s{i}") for i, n in enumerate(names)])
    each = numbers.select(F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"s{i}").alias("s")) for i in range(len(names))])).alias("e"))
    found = {n: [0] * (len(cut[n].borders) + 1) for n in names}
    for r in each.groupBy("e.i", "e.s").count().collect():  # at most MOST_SLICES for each order
        found[names[r["i"]]][r["s"]] = r["count"]
    return found


def numbered(df: DataFrame, orders: dict[str, Sequence[Column]], slices: int | None = None, rows: int | None = None) -> DataFrame:
    """1-based position of each row in the whole table, for several total orders. What lies before a slice stands in the plan as a number."""
    rows = df.count() if rows is None else rows
    cut = {name: Slices(df, by, slices, rows) for name, by in orders.items()}
    counts = _counts(df, cut)
    out = df
    for name, by in orders.items():
        start = F.get(F.array(*[F.lit(n).cast("bigint") for n in _prefix(counts[name])]), F.col(SLICE))
        out = (out.withColumn(SLICE, cut[name].number)
               .withColumn(name, start + F.row_number().over(Window.partitionBy(SLICE).orderBy(*by))).drop(SLICE))
    return out


def positions(df: DataFrame, order_by: Sequence[Column], first: int, last: int, name: str, slices: int | None = None) -> DataFrame:
    """The rows at the 1-based positions ``first`` to ``last`` with their position; only slices that hold some are sorted."""
    cut = Slices(df, order_by, slices)
    if not cut.borders:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order_by)).cast("bigint")).where(F.col(name).between(first, last))
    counts = _counts(df, {name: cut})[name]
    before = _prefix(counts)
    wanted = [i for i, n in enumerate(counts) if before[i] < last and before[i] + n >= first]
    inside = df.withColumn(SLICE, cut.number).where(F.col(SLICE).isin(wanted))
    start = F.get(F.array(*[F.lit(n).cast("bigint") for n in before]), F.col(SLICE))
    local = start + F.row_number().over(Window.partitionBy(SLICE).orderBy(*order_by))
    return inside.withColumn(name, local).where(F.col(name).between(first, last)).drop(SLICE)


def _prefix(counts: list[int]) -> list[int]:
    return [0, *accumulate(counts)][:-1]


def neighbour(df: DataFrame, order_by: Sequence[Column], columns: dict[str, str], step: int,
              partition_by: Sequence[str] = (), slices: int | None = None,
              exists: str = "_has_neighbour") -> DataFrame:
    """Values of the previous (``step=-1``) or next (``step=1``) row: ``columns`` maps source to new name.

    ``exists`` tells whether there is such a row at all, which a NULL value alone would not.
    """
    if step not in (-1, 1):
        raise ValueError("step must be -1 or 1")
    keys = list(partition_by)
    order = [*[F.col(k).asc() for k in keys], *order_by]
    sliced = slice_in_order(df, order, slices)
    here = Window.partitionBy(SLICE, *keys).orderBy(*order_by)
    payload = F.struct(*columns)
    shifted = F.lag(payload) if step < 0 else F.lead(payload)
    local = sliced.withColumn("_near", shifted.over(here))
    # the row of each (slice, key) that faces the neighbouring slice
    facing = F.lead(F.lit(1)) if step < 0 else F.lag(F.lit(1))
    edges = (sliced.withColumn("_edge", facing.over(here)).where("_edge is null")
             .select(SLICE, *keys, payload.alias("_far")))
    by_key = Window.partitionBy(*keys).orderBy(SLICE)
    crossing = F.lag("_far") if step < 0 else F.lead("_far")
    carry = edges.withColumn("_far", crossing.over(by_key)).where("_far is not null")
    near = F.coalesce("_near", "_far")
    return (_join_carry(local, carry, keys)
            .withColumns({new: near[old] for old, new in columns.items()})
            .withColumn(exists, near.isNotNull())
            .drop(SLICE, "_near", "_far"))


def tile_of(rank: Column, rows: Column | int, tiles: int) -> Column:
    """Tile of a 1-based rank among ``rows`` rows: the first ``rows mod tiles`` tiles get one row more."""
    rows = rows if isinstance(rows, Column) else F.lit(rows).cast("bigint")
    size, extra = F.floor(rows / tiles), rows % tiles
    large = extra * (size + 1)  # rows that fall into the larger tiles
    tile = F.when(rank <= large, F.floor((rank - 1) / (size + 1))).otherwise(
        extra + F.floor((rank - 1 - large) / F.greatest(size, F.lit(1))))
    return (tile + 1).cast("bigint")


def ntile_columns(df: DataFrame, tiles: int, orders: dict[str, Sequence[Column]], slices: int | None = None) -> DataFrame:
    """``ntile(tiles)`` over the whole table for several orders, each given as a total order."""
    rows = df.count()
    ranked = numbered(df, {f"_rank_{name}": by for name, by in orders.items()}, slices, rows)
    tiled = {name: tile_of(F.col(f"_rank_{name}"), rows, tiles) for name in orders}
    return ranked.withColumns(tiled).drop(*[f"_rank_{name}" for name in orders])
