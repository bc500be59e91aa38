"""Expressions on the coordinates inside a native geometry value."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .batches import bounds_of, box_array, centroids_of
from .types import BOX_FIELDS, BOX_TYPE, NESTING

NAN = float("nan")


def ordinate(coord: Column, name: str, dims: str = "xy", layout: str = "separated") -> Column:
    if layout == "interleaved":
        return coord[dims.index(name)]
    return coord[name]


def coord_struct(values: dict[str, Column]) -> Column:
    return F.struct(*[value.cast("double").alias(name) for name, value in values.items()])


def map_coords(geom: Column, kind: str, fn: Callable[[Column], Column]) -> Column:
    """Apply ``fn`` to every coordinate. Points stay outside lambdas, hence in generated code."""
    depth = NESTING[kind]
    if depth == 0:
        return F.when(geom.isNotNull(), fn(geom))

    def descend(value: Column, level: int) -> Column:
        if level == 0:
            return fn(value)
        return F.transform(value, lambda item: descend(item, level - 1))

    return descend(geom, depth)


def flat_coords(geom: Column, kind: str) -> Column:
    """All coordinates of a value as one array."""
    depth = NESTING[kind]
    if depth == 0:
        return F.when(geom.isNotNull(), F.array(geom))
    for _ in range(depth - 1):
        geom = F.flatten(geom)
    return geom


def switch_layout(geom: Column, kind: str, dims: str, layout: str) -> Column:
    """Separated to interleaved coordinates or back."""
    if layout == "interleaved":
        return map_coords(geom, kind, lambda c: F.array(*[c[d] for d in dims]))
    return map_coords(geom, kind, lambda c: coord_struct({d: c[i] for i, d in enumerate(dims)}))


def set_dims(
    geom: Column,
    kind: str,
    z: Callable[[Column], Column] | None = None,
    m: Callable[[Column], Column] | None = None,
    dims: str = "xy",
) -> Column:
    """Give every coordinate the ordinates the functions compute from it; the others of ``dims`` stay."""

    def rebuild(c: Column) -> Column:
        values = {"x": c["x"], "y": c["y"]}
        for name, made in (("z", z), ("m", m)):
            if made is not None:
                values[name] = made(c)
            elif name in dims:
                values[name] = c[name]
        return coord_struct(values)

    return map_coords(geom, kind, rebuild)


def round_coords(geom: Column, kind: str, dims: str, digits: int) -> Column:
    """Half-even decimal rounding of every ordinate."""
    return map_coords(
        geom, kind, lambda c: coord_struct({d: F.bround(c[d], digits) for d in dims})
    )


def is_empty(geom: Column, kind: str) -> Column:
    """True for an empty value, false for any other, null for null."""
    empty = F.isnan(geom["x"]) if NESTING[kind] == 0 else F.size(geom) == 0
    return F.when(geom.isNotNull(), empty)


def make_box(xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    """Box struct whose four fields are never null; null where a limit is null."""
    limits = (xmin, ymin, xmax, ymax)
    fields = [
        F.coalesce(value.cast("double"), F.lit(NAN)).alias(name)
        for name, value in zip(BOX_FIELDS, limits)
    ]
    return F.when(xmin.isNotNull() & ymin.isNotNull(), F.struct(*fields))


def box(geom: Column, kind: str) -> Column:
    """Bounds of each value; null for null and empty values.

    Points are a few generated instructions. Nested values go through Arrow batches:
    Spark interprets lambdas, which took three times as long here.
    """
    if NESTING[kind] == 0:
        x = F.when(~F.isnan(geom["x"]), geom["x"])
        y = F.when(~F.isnan(geom["y"]), geom["y"])
        return make_box(x, y, x, y)

    @arrow_udf(BOX_TYPE)
    def bounds(values: pa.Array) -> pa.Array:
        return box_array(bounds_of(values, kind))

    return bounds(geom)


def box_midpoint(bounds: Column) -> tuple[Column, Column]:
    """Middle of a box; of one that crosses the antimeridian, the middle of its two parts."""
    plain = (bounds["xmin"] + bounds["xmax"]) / 2
    wrapped = plain + 180
    x = F.when(bounds["xmax"] >= bounds["xmin"], plain).when(wrapped > 180, wrapped - 360).otherwise(wrapped)
    return x, (bounds["ymin"] + bounds["ymax"]) / 2


def _ring(xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    corners = [(xmin, ymin), (xmax, ymin), (xmax, ymax), (xmin, ymax), (xmin, ymin)]
    return F.array(*[coord_struct({"x": x, "y": y}) for x, y in corners])


def box_to_polygon(bounds: Column) -> Column:
    """Counter-clockwise ring from the lower left corner; a box across the antimeridian has none and is refused."""
    ring = _ring(*[bounds[name] for name in BOX_FIELDS])
    wraps = F.raise_error(F.lit("A box across the antimeridian is no polygon; make it a multipolygon"))
    return F.when(box_wraps(bounds), wraps.cast("array<array<struct<x:double,y:double>>>")).when(bounds.isNotNull(), F.array(ring))


def box_wraps(bounds: Column) -> Column:
    return bounds["xmax"] < bounds["xmin"]


def box_to_multipolygon(bounds: Column) -> Column:
    """One part, or an eastern then a western part where the box crosses the antimeridian."""
    xmin, ymin, xmax, ymax = [bounds[name] for name in BOX_FIELDS]
    east = F.array(_ring(xmin, ymin, F.lit(180.0), ymax))
    west = F.array(_ring(F.lit(-180.0), ymin, xmax, ymax))
    whole = F.array(_ring(xmin, ymin, xmax, ymax))
    return F.when(
        bounds.isNotNull(),
        F.when(box_wraps(bounds), F.array(east, west)).otherwise(F.array(whole)),
    )


def centroid(geom: Column, kind: str) -> Column:
    """Area centroid of polygons and multipolygons, in Arrow batches."""
    if kind not in ("polygon", "multipolygon"):
        raise ValueError(f"No area centroid for {kind!r}")

    @arrow_udf("struct<x:double,y:double>")
    def centres(values: pa.Array) -> pa.Array:
        return centroids_of(values, kind)

    return centres(geom)
