"""Aggregates over a whole geometry column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.coords import box_wraps, flat_coords, make_box
from ..functions.types import GEOMETRY, geometry_tag
from .columns import box_column, geometry_type


def extent_of_boxes(bounds: Column) -> list[Column]:
    """Aggregates xmin, ymin, xmax, ymax; a box across the antimeridian spans all longitudes."""
    wraps = box_wraps(bounds)
    return [
        F.min(F.when(wraps, F.lit(-180.0)).otherwise(bounds["xmin"])).alias("xmin"),
        F.min(bounds["ymin"]).alias("ymin"),
        F.max(F.when(wraps, F.lit(180.0)).otherwise(bounds["xmax"])).alias("xmax"),
        F.max(bounds["ymax"]).alias("ymax"),
    ]


def extent(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Total bounds, per key of ``by`` if given. Partial minima merge before the shuffle."""
    keys = by or []
    # The box is its own projection: computed once per row for four aggregates.
    boxes = df.select(*keys, box_column(df).alias("box"))
    return boxes.groupBy(*keys).agg(*extent_of_boxes(F.col("box")))


#: Cells that longitudes are counted in; a gap narrower than one of them is not taken out of an extent.
ARC_CELLS = 1 << 16


def wrapped_extent(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Bounds on the circle of longitudes: xmin, ymin, xmax, ymax, with xmax < xmin across the antimeridian.

    Boxes are arcs. What is left of the circle without its widest gap is the extent; of equally wide gaps the
    one with the smallest longitude after it goes. Where no gap is as wide as a cell, that is
    360 / ARC_CELLS degrees, the extent is -180 to 180. Arcs that begin in a cell merge to their first begin and
    last end before the shuffle, so a key of any size is ARC_CELLS rows at most; a gap as wide as a cell always
    ends at the first begin of a cell, so the result is exact. Null and empty values count nowhere, and a key with nothing else
    has no row.
    """
    keys = by or []
    west, width = F.col("box.xmin"), 360.0 / ARC_CELLS
    east = F.when(box_wraps(F.col("box")), F.col("box.xmax") + 360.0).otherwise(F.col("box.xmax"))
    boxes = df.select(*keys, box_column(df).alias("box")).filter(F.col("box").isNotNull())
    arcs = boxes.select(
        *keys,
        F.least(F.lit(ARC_CELLS - 1), F.floor((west + 180.0) / width)).cast("int").alias("cell"),
        west.alias("west"),
        F.struct(east.alias("to"), F.col("box.xmax").alias("stated")).alias("end"),
        F.col("box.ymin").alias("ymin"),
        F.col("box.ymax").alias("ymax"),
    )
    cells = arcs.groupBy(*keys, "cell").agg(
        F.min("west").alias("west"), F.max("end").alias("end"), F.min("ymin").alias("ymin"), F.max("ymax").alias("ymax")
    )
    group = Window.partitionBy(*keys)
    before = group.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    # An arc may reach around into the cells before its own.
    around = F.max("end").over(group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    around = F.struct((around["to"] - 360.0).alias("to"), around["stated"].alias("stated"))
    placed = cells.withColumns({"last": F.max("end").over(before), "around": around})
    reach = F.when(F.col("last").isNull() | (F.col("last.to") < F.col("around.to")), F.col("around")).otherwise(F.col("last"))
    gaps = placed.withColumn("reach", reach).withColumn("gap", F.col("west") - F.col("reach.to"))
    widest = gaps.groupBy(*keys).agg(
        F.max(F.struct("gap", (-F.col("west")).alias("order"), "west", "reach")).alias("w"),
        F.min("ymin").alias("ymin"),
        F.max("ymax").alias("ymax"),
    )
    found = F.col("w.gap") >= width
    return widest.select(
        *keys,
        F.when(found, F.col("w.west")).otherwise(-180.0).alias("xmin"),
        "ymin",
        F.when(found, F.col("w.reach.stated")).otherwise(180.0).alias("xmax"),
        "ymax",
    ).filter(F.col("ymin").isNotNull())


def extent_box(df: DataFrame) -> DataFrame:
    """Total bounds as one row with one box column."""
    total = extent(df)
    return total.select(make_box(*[F.col(c) for c in total.columns]).alias("extent"))


def footer_bbox(df: DataFrame) -> DataFrame:
    """Bounds as a file footer lists them: minima then maxima, with z where it exists."""
    tag = geometry_tag(df)
    if tag.encoding != "native" or "z" not in (tag.dims or ""):
        total = extent(df)
        return total.select(F.array("xmin", "ymin", "xmax", "ymax").alias("bbox"))
    zs = F.filter(flat_coords(F.col(GEOMETRY), tag.kind)["z"], lambda v: ~F.isnan(v))
    rows = df.select(
        box_column(df).alias("box"), F.array_min(zs).alias("zlow"), F.array_max(zs).alias("zhigh")
    )
    total = rows.agg(
        *extent_of_boxes(F.col("box")), F.min("zlow").alias("zmin"), F.max("zhigh").alias("zmax")
    )
    return total.select(F.array("xmin", "ymin", "zmin", "xmax", "ymax", "zmax").alias("bbox"))


def geometry_types(df: DataFrame) -> DataFrame:
    """Distinct types of the column in alphabetical order; at most 28 can occur."""
    kinds = df.select(geometry_type(df).alias("kind"))
    return kinds.agg(F.array_sort(F.collect_set("kind")).alias("geometry_types"))
