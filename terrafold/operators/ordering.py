"""Orders: along the Hilbert curve, by first appearance, and as stored row numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.coords import box_midpoint
from ..functions.hilbert import grid_cell, walk_curve
from .columns import box_column
from .extent import extent_box

# Rows a partition has read so far are the low 33 bits of Spark's increasing id.
_POSITION_BITS = (1 << 33) - 1


def position_in_partition() -> Column:
    return F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_BITS))


def hilbert_key(df: DataFrame, key: str = "hilbert_key", extent: Column | None = None) -> DataFrame:
    """Add the curve position of the midpoint of each row's bounds within the total bounds.

    The total is a scalar subquery unless given: one row, computed before the scan that
    uses it. Null and empty rows have no position.
    """
    total = extent if extent is not None else extent_box(df).scalar()
    kept = df.columns
    df = df.select("*", box_column(df).alias("__box"), total.alias("__total"))
    mid_x, mid_y = box_midpoint(F.col("__box"))
    low, high = F.col("__total"), F.col("__total")
    df = df.select(
        *kept,
        F.col("__box").isNotNull().alias("__placed"),
        grid_cell(mid_x, low["xmin"], high["xmax"]).alias("__x"),
        grid_cell(mid_y, low["ymin"], high["ymax"]).alias("__y"),
    )
    df = walk_curve(df, "__x", "__y", "__d")
    return df.select(*kept, F.when(F.col("__placed"), F.col("__d")).alias(key))


def hilbert_order(df: DataFrame, tie: list[str], key: str = "hilbert_key") -> DataFrame:
    """Sorted table for queries; rows without a position come last."""
    return hilbert_key(df, key).orderBy(F.col(key).asc_nulls_last(), *tie)


def cluster(
    df: DataFrame, tie: list[str], partitions: int | None = None, extent: Column | None = None
) -> DataFrame:
    """Hilbert-ordered partitions for writing, each a compact region.

    Cuts come from a sample of (key, tie), so a spot that holds many rows is split
    among partitions by its tie columns.
    """
    order = [F.col("__hilbert").asc_nulls_last(), *[F.col(c) for c in tie]]
    laid = hilbert_key(df, "__hilbert", extent)
    if partitions is None:
        laid = laid.repartitionByRange(*order)
    else:
        laid = laid.repartitionByRange(partitions, *order)
    return laid.sortWithinPartitions(*order).drop("__hilbert")


#: Sampled rows for each range of an order, and the most ranges an order is cut into.
SAMPLE_PER_RANGE, MOST_RANGES = 64, 4096
#: Rows of a range.
RANGE_ROWS = 1 << 18


def range_cuts(df: DataFrame, keys: list[str], ranges: int | None = None) -> list[Row]:
    """Tuples of ``keys`` that cut the table into about equal ranges, drawn once by a hash of the keys.

    The driver gets SAMPLE_PER_RANGE rows a range, expected, and at most MOST_RANGES ranges.
    Fewer cuts than asked for come back where rows share their keys.
    """
    rows = df.select(*keys)
    total = rows.count()
    ranges = min(MOST_RANGES, ranges or -(-total // RANGE_ROWS))
    if total == 0 or ranges < 2:
        return []
    share = min(1.0, SAMPLE_PER_RANGE * ranges / total)
    draw = F.xxhash64(*keys) / F.lit(float(1 << 64)) + 0.5
    drawn = _where(rows, draw <= share).orderBy(*keys).collect()
    picked = [drawn[len(drawn) * i // ranges] for i in range(1, ranges)] if drawn else []
    return [c for i, c in enumerate(picked) if i == 0 or c != picked[i - 1]]


def _where(df: DataFrame, condition: Column) -> DataFrame:
    """A filter that stays above the expressions its columns come from.

    Pushed below them it would hold a copy of each, the curve's whole walk, for instance.
    """
    # Rows with a number that depends on their place cannot be filtered any earlier.
    marked = df.withColumn("__place", F.monotonically_increasing_id())
    return marked.filter(condition & (F.col("__place") >= 0)).drop("__place")


def _tuple(df: DataFrame, keys: list[str], values: Row | None = None) -> Column:
    """The keys as one column, or given values of theirs; nulls compare as the smallest."""
    types = {f.name: f.dataType for f in df.schema}
    if values is None:
        return F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)])
    return F.struct(*[F.lit(v).cast(types[k]).alias(f"k{i}") for i, (k, v) in enumerate(zip(keys, values))])


def range_number(df: DataFrame, keys: list[str], cuts: list[Row]) -> Column:
    """How many cuts a row's keys have reached: a balanced tree of comparisons with literals."""
    own = _tuple(df, keys)

    def place(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        mid = (low + high) // 2
        return F.when(own >= _tuple(df, keys, cuts[mid]), place(mid + 1, high)).otherwise(place(low, mid))

    return place(0, len(cuts))


def with_running(
    df: DataFrame, order_by: list[str], within: list[str] | None = None, name: str = "before",
    weight: str | None = None, ranges: int | None = None,
) -> DataFrame:
    """Sum of ``weight`` (1 if none) over the rows before each by ``order_by``, in its group of ``within``.

    ``order_by`` is a unique key. No group passes through one task and no table is written:
    cuts of the order are drawn once and stand in the plan as literals, so the totals of each range are
    known before rows are placed, and both passes put every row in the same range. Inside a
    range a window runs. Only the first group of a range has rows in ranges before it, so the
    driver holds one sum for each range. The table is computed once for each pass; give a
    written one where that is dear.
    """
    within = within or []
    keys = [*within, *order_by]
    cuts = range_cuts(df, keys, ranges)
    added = F.lit(1) if weight is None else F.col(weight)
    placed = df.withColumn("__range", range_number(df, keys, cuts))
    group = _tuple(df, within) if within else F.lit(True)
    # Rows of group and range, for the groups that begin a range.
    firsts = {}
    if cuts and within:
        for row in placed.groupBy("__range").agg(F.min(group).alias("g")).collect():
            firsts[row["__range"]] = row["g"]
        among = F.array_contains(F.array(*[_tuple(df, within, g) for g in firsts.values()]), group)
        sums = _where(placed, among).groupBy(group.alias("g"), "__range").agg(F.sum(added).alias("n")).collect()
    elif cuts:
        sums = placed.groupBy(group.alias("g"), "__range").agg(F.sum(added).alias("n")).collect()
        firsts = {row["__range"]: True for row in sums}
    else:
        sums = []
    held: dict = {}
    for row in sums:
        held.setdefault(row["g"], []).append((row["__range"], row["n"] or 0))
    shifts = [sum(n for r, n in held.get(firsts.get(i), []) if r < i) for i in range(len(cuts) + 1)]
    before = Window.partitionBy("__range", *within).orderBy(*order_by)
    if weight is None:
        inside = F.row_number().over(before).cast("long") - 1
    else:
        inside = F.coalesce(F.sum(added).over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    if any(shifts):
        shift = F.array(*[F.lit(n) for n in shifts])[F.col("__range")]
        if within:
            none = F.lit(None).cast(T.StructType([T.StructField(f"k{i}", df.schema[k].dataType) for i, k in enumerate(within)]))
            first = F.array(*[_tuple(df, within, firsts[i]) if i in firsts else none for i in range(len(cuts) + 1)])
            shift = F.when(group.eqNullSafe(first[F.col("__range")]), shift).otherwise(0)
        inside = inside + shift
    return placed.select(*df.columns, inside.alias(name))


def with_rank(
    df: DataFrame, order_by: list[str], within: list[str] | None = None, name: str = "rank"
) -> DataFrame:
    """Row number from 0 by ``order_by`` (a unique key) inside each group of ``within``."""
    return with_running(df, order_by, within, name)


def spread(df: DataFrame, keys: list[str], rows: int) -> DataFrame:
    """The table in tasks of about ``rows`` rows, dealt by ``keys``; one that is not larger stays as it is.

    For small rows that become many or wide ones: however few pieces a scan can be cut into, what a
    task then sorts or groups stays bounded. A unique key deals evenly and needs no sort, as rows dealt in turn would.
    """
    tasks = -(-df.count() // rows)
    return df.repartition(tasks, *keys) if tasks > 1 else df


def first_appearance(df: DataFrame, keys: list[str], ordinal: str) -> DataFrame:
    """Groups with the lowest ordinal of each, for ordering them as they first occur."""
    return df.groupBy(*keys).agg(F.min(ordinal).alias(ordinal))


def first_row(df: DataFrame) -> DataFrame:
    return df.limit(1)
