"""Equality of tables and completeness of listings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import materialized
from .columns import same_type


def table_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that occur more often on one side, with the surplus (negative: in ``right``).

    Both sides meet in a single aggregation; equal rows merge before the shuffle. Null
    equals null and NaN equals NaN.
    """
    columns = left.columns
    both = left.select(*columns, F.lit(1).alias("__n")).unionByName(
        right.select(*columns, F.lit(-1).alias("__n"))
    )
    counted = both.groupBy(*columns).agg(F.sum("__n").alias("surplus"))
    return counted.filter(F.col("surplus") != 0)


def tables_equal(left: DataFrame, right: DataFrame) -> bool:
    return left.columns == right.columns and table_differences(left, right).isEmpty()


def schemas_equal(left: DataFrame, right: DataFrame, nullability: bool = False) -> bool:
    """Same names, types and field metadata; nullability only if asked for."""
    if len(left.schema) != len(right.schema):
        return False
    return all(
        a.name == b.name
        and (a.metadata or {}) == (b.metadata or {})
        and (a.dataType == b.dataType if nullability else same_type(a.dataType, b.dataType))
        and (not nullability or a.nullable == b.nullable)
        for a, b in zip(left.schema.fields, right.schema.fields)
    )


def pair_by_position(left: DataFrame, right: DataFrame, ordinal: str) -> DataFrame:
    """Rows of both tables side by side where their ordinals meet, with an equality flag."""
    columns = [c for c in left.columns if c != ordinal]
    a = left.select(F.col(ordinal), F.struct(*columns).alias("left"))
    b = right.select(F.col(ordinal), F.struct(*columns).alias("right"))
    paired = a.join(b, ordinal, "full_outer")
    return paired.withColumn("equal", F.col("left").eqNullSafe(F.col("right")))


#: Rows of a leaf of a hash tree and children of a node.
FAN = 256
#: Ranges of ordinals that are read by literal bounds; more are joined with.
MOST_RANGES = 512


def hash_tree(df: DataFrame, ordinal: str) -> DataFrame:
    """(level, node, low, high, rows): hashes of ranges of ordinals, written once.

    A leaf (level 0) stands for FAN ordinals, a node for FAN of the level below. Both hashes of a range are
    the exclusive or over its rows, each hashed with its ordinal as JSON text, in which nulls at any depth and
    types have a spelling of their own. Partial values merge before the shuffle. Keep the table
    beside a layer, and later comparisons need not read the layer again.
    """
    row = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    leaves = df.select(F.expr(f"`{ordinal}` div {FAN}").alias("node"), row.alias("row"))
    nodes = leaves.groupBy("node").agg(
        F.bit_xor(F.xxhash64(F.lit(1), "row")).alias("low"), F.bit_xor(F.xxhash64(F.lit(2), "row")).alias("high"),
        F.count("*").alias("rows"),
    )
    out = nodes = materialized(nodes.select(F.lit(0).alias("level"), "*"), "tree-leaves")
    top = nodes.agg(F.max("node")).first()[0] or 0
    level = 0
    while top:
        level, top = level + 1, top // FAN
        nodes = nodes.groupBy(F.expr(f"node div {FAN}").alias("node")).agg(
            F.bit_xor("low").alias("low"), F.bit_xor("high").alias("high"), F.sum("rows").alias("rows")
        )
        nodes = nodes.select(F.lit(level).alias("level"), "*")
        out = out.unionByName(nodes)
    return materialized(out, "tree")


def unequal_leaves(left: DataFrame, right: DataFrame) -> DataFrame:
    """Leaves (node) at which two hash trees differ: from the top, only below unequal nodes."""
    top = left.unionByName(right).agg(F.max("level")).first()[0]
    unequal = None
    for level in range(top or 0, -1, -1):
        sides = [t.filter(F.col("level") == level).select("node", F.struct("low", "high", "rows").alias("h")) for t in (left, right)]
        if unequal is not None:
            above = unequal.select(F.col("node").alias("__above"))
            sides = [s.join(above, F.expr(f"node div {FAN}") == F.col("__above"), "left_semi") for s in sides]
        both = sides[0].withColumnRenamed("h", "a").join(sides[1].withColumnRenamed("h", "b"), "node", "full_outer")
        # Nodes of a level that only the taller tree has are unequal by themselves.
        unequal = both.filter(~F.col("a").eqNullSafe(F.col("b"))).select("node")
        unequal = materialized(unequal, f"tree-unequal-{level}")
    return unequal


def rows_of_leaves(df: DataFrame, ordinal: str, leaves: DataFrame) -> DataFrame:
    """The rows of a table in some leaves.

    Up to MOST_RANGES runs of neighbouring leaves become bounds in the plan, which reach the scan of a table that
    was written in its order; more of them are joined.
    """
    # Leaves that follow one another make one range.
    nodes = [r["node"] for r in leaves.orderBy("node").limit(MOST_RANGES * FAN + 1).collect()]
    ranges: list[list[int]] = []
    for node in nodes:
        if ranges and ranges[-1][1] == node:
            ranges[-1][1] = node + 1
        else:
            ranges.append([node, node + 1])
    if len(nodes) > MOST_RANGES * FAN or len(ranges) > MOST_RANGES:
        at = F.expr(f"`{ordinal}` div {FAN}")
        return df.join(leaves.select(F.col("node").alias("__leaf")), at == F.col("__leaf"), "left_semi")
    inside = F.lit(False)
    for low, high in ranges:
        inside = inside | ((F.col(ordinal) >= low * FAN) & (F.col(ordinal) < high * FAN))
    return df.filter(inside)


def order_difference(
    left: DataFrame, right: DataFrame, ordinal: str, trees: tuple[DataFrame, DataFrame] | None = None
) -> DataFrame:
    """(ordinal, left, right): where two ordered tables differ, null on the side that has no such place.

    ``ordinal`` numbers the rows of each side from 0; an ordinal that repeats pairs each with each. Trees of both sides
    are compared from the top, so that rows are read only where a range of ordinals differs.
    """
    trees = trees or (hash_tree(left, ordinal), hash_tree(right, ordinal))
    leaves = unequal_leaves(*trees)
    sides = [rows_of_leaves(df, ordinal, leaves) for df in (left, right)]
    return pair_by_position(*sides, ordinal).filter(~F.col("equal")).drop("equal")


def completeness(declared: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """Keys that are declared but missing, or present but undeclared."""
    both = declared.select(key, F.lit(True).alias("__d"), F.lit(False).alias("__p")).unionByName(
        present.select(key, F.lit(False).alias("__d"), F.lit(True).alias("__p"))
    )
    # Copies of a key merge before the shuffle, so no join is needed.
    seen = both.groupBy(key).agg(F.bool_or("__d").alias("__d"), F.bool_or("__p").alias("__p"))
    status = F.when(~F.col("__p"), "missing").when(~F.col("__d"), "undeclared")
    return seen.select(key, status.alias("status")).filter(F.col("status").isNotNull())


def require_all_passed(checks: DataFrame, passed: str) -> DataFrame:
    """Counts of passed and of all checks; reading the result fails where they differ."""
    counts = checks.agg(
        F.count_if(F.col(passed)).alias("passed"), F.count("*").alias("written")
    )
    verdict = F.when(
        F.col("passed") != F.col("written"),
        F.raise_error(F.lit("Fewer tables passed than were written")).cast("boolean"),
    ).otherwise(F.lit(True))
    return counts.withColumn("complete", verdict)
