"""Replacing, tagging and re-encoding the geometry column of a table."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import coords, projection, wkb, wkt
from ..functions.types import (
    BOX_FIELDS,
    GEOMETRY,
    GeometryTag,
    geometry_tag,
    tagged,
    type_label,
)


def select_as(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Select and rename in one step, field metadata kept."""
    return df.select(*[F.col(old).alias(new) for old, new in names.items()])


def replace_geometry(
    df: DataFrame, value: Column, tag: GeometryTag, old: str = GEOMETRY
) -> DataFrame:
    """Put a new geometry in the place of column ``old``, under the name ``geometry``."""
    return df.select(*[tagged(value, tag) if name == old else F.col(name) for name in df.columns])


def geometry_last(df: DataFrame) -> DataFrame:
    rest = [name for name in df.columns if name != GEOMETRY]
    return df.select(*rest, GEOMETRY)


def declare(df: DataFrame, tag: GeometryTag, column: str = GEOMETRY) -> DataFrame:
    """Say what an untagged column holds."""
    return replace_geometry(df, F.col(column), tag, old=column)


def with_crs(df: DataFrame, crs: object, crs_type: str | None = None) -> DataFrame:
    """Set the coordinate system and how it is spelled; coordinates stay where they are.

    A PROJJSON object is the only spelling whose type is recognised by itself. A text
    without a ``crs_type`` stands for a spelling the producer does not know.
    """
    if crs_type is None and isinstance(crs, dict):
        crs_type = "projjson"
    if crs_type == "projjson" and isinstance(crs, str):
        crs = json.loads(crs)
    return declare(df, geometry_tag(df).with_(crs=crs, crs_type=crs_type))


def with_edges(df: DataFrame, edges: str | None) -> DataFrame:
    """Planar (None) or ``spherical`` edges."""
    if edges not in (None, "spherical"):
        raise ValueError(f"Unknown edges: {edges!r}")
    return declare(df, geometry_tag(df).with_(edges=edges))


def crs_variants(spark, systems: list[str], labels: list[str]) -> DataFrame:
    """Pair coordinate systems and labels by position, one row each."""
    if len(systems) != len(labels):
        raise ValueError("As many labels as coordinate systems are needed")
    row = spark.createDataFrame([(systems, labels)], "crs array<string>, label array<string>")
    return pair_lists(row, "crs", "label")


def pair_lists(df: DataFrame, left: str, right: str) -> DataFrame:
    """Two lists of each row side by side by position; lists of unequal length are an error."""
    rest = [c for c in df.columns if c not in (left, right)]
    uneven = F.raise_error(F.lit(f"{left} and {right} differ in length"))
    pairs = F.when(F.size(left) == F.size(right), F.arrays_zip(left, right)).otherwise(uneven)
    rows = df.select(*rest, F.posexplode(pairs).alias("pos", "pair"))
    return rows.select(*rest, "pos", f"pair.{left}", f"pair.{right}")


def _plane_only(tag: GeometryTag, what: str) -> None:
    if tag.edges == "spherical":
        raise ValueError(f"{what} of spherical edges is not defined by their vertices")


def box_column(df: DataFrame) -> Column:
    """Bounds per row for any encoding; spherical edges are refused."""
    tag = geometry_tag(df)
    _plane_only(tag, "A box")
    geom = F.col(GEOMETRY)
    if tag.encoding == "box":
        return geom
    if tag.encoding == "wkb":
        return wkb.wkb_box(geom)
    if tag.encoding == "wkt":
        return wkb.wkb_box(wkb.wkt_to_wkb(geom))
    if tag.layout == "interleaved":
        geom = coords.switch_layout(geom, tag.kind, tag.dims, "separated")
    return coords.box(geom, tag.kind)


def to_box(df: DataFrame) -> DataFrame:
    tag = geometry_tag(df).with_(encoding="box", kind=None, dims="xy", layout="separated")
    return replace_geometry(df, box_column(df), tag)


def box_to_polygon(df: DataFrame) -> DataFrame:
    tag = geometry_tag(df).with_(encoding="native", kind="polygon")
    return replace_geometry(df, coords.box_to_polygon(F.col(GEOMETRY)), tag)


def box_to_multipolygon(df: DataFrame) -> DataFrame:
    tag = geometry_tag(df).with_(encoding="native", kind="multipolygon")
    return replace_geometry(df, coords.box_to_multipolygon(F.col(GEOMETRY)), tag)


def override_boxes(df: DataFrame, key: str, limits: dict[str, tuple[float, float]]) -> DataFrame:
    """New western and eastern limits for the rows named by ``limits``, latitudes kept."""
    geom = F.col(GEOMETRY)
    # The edits are written by hand, so they are a literal expression and need no join.
    value = geom
    for name, (west, east) in limits.items():
        edited = coords.make_box(F.lit(west), geom["ymin"], F.lit(east), geom["ymax"])
        value = F.when(F.col(key) == name, edited).otherwise(value)
    return replace_geometry(df, value, geometry_tag(df))


def centroid(df: DataFrame) -> DataFrame:
    tag = geometry_tag(df)
    _plane_only(tag, "The centroid")
    df = as_encoding(df, "native")
    native = geometry_tag(df)
    value = coords.centroid(F.col(GEOMETRY), native.kind)
    return replace_geometry(df, value, native.with_(kind="point", dims="xy"))


def round_coords(df: DataFrame, digits: int) -> DataFrame:
    tag = geometry_tag(df)
    geom = F.col(GEOMETRY)
    if tag.encoding == "box":
        limits = [F.bround(geom[name], digits) for name in BOX_FIELDS]
        return replace_geometry(df, coords.make_box(*limits), tag)
    if tag.encoding != "native" or tag.layout != "separated":
        return _in_form_of(df, round_coords(_separated(df), digits))
    return replace_geometry(df, coords.round_coords(geom, tag.kind, tag.dims, digits), tag)


def set_dims(df: DataFrame, z=None, m=None) -> DataFrame:
    """Add or replace z and m, computed from each coordinate; ordinates not named stay."""
    tag = geometry_tag(df)
    if tag.encoding != "native" or tag.layout != "separated":
        return _in_form_of(df, set_dims(_separated(df), z, m))
    dims = "xy" + ("z" if z or "z" in tag.dims else "") + ("m" if m or "m" in tag.dims else "")
    return replace_geometry(
        df, coords.set_dims(F.col(GEOMETRY), tag.kind, z, m, tag.dims), tag.with_(dims=dims)
    )


def _separated(df: DataFrame) -> DataFrame:
    return with_coord_layout(as_encoding(df, "native"), "separated")


def _in_form_of(source: DataFrame, df: DataFrame) -> DataFrame:
    """The encoding and layout that ``source`` has."""
    tag = geometry_tag(source)
    return as_encoding(df, tag.encoding, tag.layout)


def with_coord_layout(df: DataFrame, layout: str) -> DataFrame:
    tag = geometry_tag(df)
    if tag.layout == layout:
        return df
    value = coords.switch_layout(F.col(GEOMETRY), tag.kind, tag.dims, layout)
    return replace_geometry(df, value, tag.with_(layout=layout))


def reproject(df: DataFrame, src: str, dst: str, crs: object = None) -> DataFrame:
    """Move coordinates from ``src`` to ``dst`` and tag the column with ``crs`` (default ``dst``).

    Encoding and layout stay as they are. The transverse projection is a series that holds near
    its meridian; points beyond its domain become infinite rather than wrong.
    """
    tag = geometry_tag(df)
    if tag.encoding != "native" or tag.layout != "separated":
        return _in_form_of(df, reproject(_separated(df), src, dst, crs))
    new_crs = dst if crs is None else crs
    crs_type = "projjson" if isinstance(new_crs, dict) else "authority_code"
    tag = tag.with_(crs=new_crs, crs_type=crs_type)
    geom = F.col(GEOMETRY)
    if tag.kind != "point":
        value = projection.project_nested(geom, tag.kind, tag.dims, src, dst)
        return replace_geometry(df, value, tag)
    work, x, y, kept = projection.project_columns(df, geom["x"], geom["y"], src, dst)
    values = {"x": x, "y": y, **{d: geom[d] for d in tag.dims[2:]}}
    value = F.when(geom.isNotNull(), coords.coord_struct(values))
    return work.select(
        *[tagged(value, tag) if name == GEOMETRY else F.col(name) for name in kept]
    )


def geometry_type(df: DataFrame) -> Column:
    """Type and dimensions of each row as text; null for null."""
    tag = geometry_tag(df)
    geom = F.col(GEOMETRY)
    if tag.encoding == "wkt":
        return wkt.wkt_type(geom)
    if tag.encoding == "wkb":
        return wkb.wkb_type(geom)
    label = "Box" if tag.encoding == "box" else type_label(tag.kind, tag.dims)
    return F.when(geom.isNotNull(), F.lit(label))


def as_encoding(
    df: DataFrame, encoding: str, layout: str = "separated", kind: str | None = None,
    dims: str | None = None,
) -> DataFrame:
    """Re-encode the geometry column by what its tag says it holds.

    ``kind`` and ``dims`` say what an untyped column holds; a column that stays
    untyped has no native form.
    """
    tag = geometry_tag(df)
    if tag.kind is None and kind is not None:
        tag = tag.with_(kind=kind, dims=dims or "xy")
    geom = F.col(GEOMETRY)
    typed = tag.kind in coords.NESTING
    if tag.encoding == "box":
        if encoding == "box":
            return df
        # Any row may cross the antimeridian, and then has two parts.
        return as_encoding(box_to_multipolygon(df), encoding, layout)
    if encoding == "box":
        return to_box(df)
    if tag.encoding == encoding == "native":
        return with_coord_layout(df, layout)
    if tag.encoding == encoding:
        return declare(df, tag)
    new = tag.with_(encoding=encoding, layout="separated") if typed or encoding != "native" else None
    if new is None:
        raise ValueError("A column of mixed or collected types has no native form")

    if not typed:
        value = wkb.wkt_to_wkb(geom) if encoding == "wkb" else wkb.wkb_to_wkt(geom)
        return replace_geometry(df, value, new)
    if tag.encoding == "native":
        native = geom
        if tag.layout == "interleaved":
            native = coords.switch_layout(geom, tag.kind, tag.dims, "separated")
    elif tag.encoding == "wkt":
        native = wkt.parse_wkt(geom, tag.kind, tag.dims)
    else:
        native = wkb.decode_wkb(geom, tag.kind, tag.dims)
    if encoding == "wkb":
        value = wkb.encode_wkb(native, tag.kind, tag.dims)
    elif encoding == "wkt":
        value = wkt.format_wkt(native, tag.kind, tag.dims)
    else:
        return with_coord_layout(replace_geometry(df, native, new), layout)
    return replace_geometry(df, value, new)


def with_encoding(df: DataFrame, encoding: str, layout: str = "separated") -> DataFrame:
    """Two columns: the source text and its encoding."""
    both = df.select(F.col(GEOMETRY).alias("wkt"), F.col(GEOMETRY))
    return as_encoding(both, encoding, layout)


def explode_members(df: DataFrame) -> DataFrame:
    """One row per leaf member of every value, with its path of positions."""
    tag = geometry_tag(df)
    df = as_encoding(df, "wkb")
    rest = [name for name in df.columns if name != GEOMETRY]
    split = df.select(*rest, F.explode(wkb.members(F.col(GEOMETRY))).alias("__m"))
    member = tag.with_(encoding="wkb", kind=None, dims=None, layout="separated")
    return split.select(
        *rest,
        F.col("__m.path").alias("path"),
        tagged(F.col("__m.member"), member),
    )


def wkt_is_canonical(df: DataFrame) -> Column:
    """Whether a typed WKT column is what parsing and formatting it again gives."""
    tag = geometry_tag(df)
    geom = F.col(GEOMETRY)
    if tag.kind in coords.NESTING:
        again = wkt.format_wkt(wkt.parse_wkt(geom, tag.kind, tag.dims), tag.kind, tag.dims)
    else:
        again = wkb.wkb_to_wkt(wkb.wkt_to_wkb(geom))
    return geom.eqNullSafe(again)


def storage_matches(df: DataFrame) -> bool:
    """Whether the geometry column is stored as its tag says."""
    return same_type(df.schema[GEOMETRY].dataType, geometry_tag(df).storage)


def same_type(left: T.DataType, right: T.DataType) -> bool:
    """Type equality without regard to nullability."""
    if isinstance(left, T.ArrayType) and isinstance(right, T.ArrayType):
        return same_type(left.elementType, right.elementType)
    if isinstance(left, T.StructType) and isinstance(right, T.StructType):
        return left.names == right.names and all(
            same_type(a.dataType, b.dataType) for a, b in zip(left.fields, right.fields)
        )
    return left == right
