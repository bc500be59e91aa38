"""Storage types of geometry columns and the tag that describes them.

The tag lives in the field metadata of the ``geometry`` column. Every expression
on a column drops that metadata, so operators end in :func:`tagged`.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

GEOMETRY = "geometry"

# Dimension names, in the order of their WKB offsets (0, 1000, 2000, 3000).
DIMENSIONS = ("xy", "xyz", "xym", "xyzm")

# WKB type codes.
WKB_CODES = {
    "point": 1,
    "linestring": 2,
    "polygon": 3,
    "multipoint": 4,
    "multilinestring": 5,
    "multipolygon": 6,
    "geometrycollection": 7,
}

# Mixed-case names used in file footers.
TYPE_NAMES = {
    "point": "Point",
    "linestring": "LineString",
    "polygon": "Polygon",
    "multipoint": "MultiPoint",
    "multilinestring": "MultiLineString",
    "multipolygon": "MultiPolygon",
    "geometrycollection": "GeometryCollection",
}

# How many lists enclose a coordinate.
NESTING = {
    "point": 0,
    "linestring": 1,
    "polygon": 2,
    "multipoint": 1,
    "multilinestring": 2,
    "multipolygon": 3,
}

# A column holding both members of a pair is stored as the second.
PROMOTIONS = {
    "point": "multipoint",
    "linestring": "multilinestring",
    "polygon": "multipolygon",
}

BOX_FIELDS = ("xmin", "ymin", "xmax", "ymax")
BOX_TYPE = T.StructType([T.StructField(name, T.DoubleType(), False) for name in BOX_FIELDS])

ENCODINGS = ("native", "wkb", "wkt", "box")
LAYOUTS = ("separated", "interleaved")
# Spellings that are known; a file may state others, which are kept as they are.
CRS_TYPES = ("projjson", "wkt2", "wkt2:2019", "authority_code", "srid")

_TAG_KEY = "terrafold.geometry"


def coord_type(dims: str, layout: str = "separated") -> T.DataType:
    if layout == "interleaved":
        return T.ArrayType(T.DoubleType(), False)
    return T.StructType([T.StructField(d, T.DoubleType()) for d in dims])


def storage_type(kind: str, dims: str = "xy", layout: str = "separated") -> T.DataType:
    """Spark type of a native geometry column."""
    out = coord_type(dims, layout)
    for _ in range(NESTING[kind]):
        out = T.ArrayType(out)
    return out


def type_label(kind: str, dims: str) -> str:
    """``Point``, ``Point Z``, ``MultiPolygon ZM`` …"""
    suffix = dims[2:].upper()
    return f"{TYPE_NAMES[kind]} {suffix}".strip()


@dataclass(frozen=True)
class GeometryTag:
    """What a geometry column holds. ``kind`` and ``dims`` are None where rows differ."""

    encoding: str
    kind: str | None = None
    dims: str | None = "xy"
    layout: str = "separated"
    crs: object = None
    crs_type: str | None = None
    edges: str | None = None

    def __post_init__(self):
        if self.encoding not in ENCODINGS:
            raise ValueError(f"Unknown encoding: {self.encoding!r}")
        if self.layout not in LAYOUTS:
            raise ValueError(f"Unknown coordinate layout: {self.layout!r}")
        if self.dims is not None and self.dims not in DIMENSIONS:
            raise ValueError(f"Unknown dimensions: {self.dims!r}")
        if self.encoding == "native" and self.kind not in NESTING:
            raise ValueError(f"No native form for geometry type {self.kind!r}")
        if self.crs_type is not None and not isinstance(self.crs_type, str):
            raise ValueError(f"A CRS type is text, not {self.crs_type!r}")

    def to_metadata(self) -> dict:
        kept = {k: v for k, v in self.__dict__.items() if v is not None}
        return {_TAG_KEY: kept}

    def with_(self, **changes) -> GeometryTag:
        return replace(self, **changes)

    @property
    def storage(self) -> T.DataType:
        if self.encoding == "native":
            return storage_type(self.kind, self.dims, self.layout)
        return {"wkb": T.BinaryType(), "wkt": T.StringType(), "box": BOX_TYPE}[self.encoding]


def tag_of(field: T.StructField) -> GeometryTag:
    """Tag of a field; a field without one is described from its type alone."""
    stored = (field.metadata or {}).get(_TAG_KEY)
    if stored is not None:
        return GeometryTag(**{"dims": None, **stored})
    return _guess(field.dataType)


def _guess(data_type: T.DataType) -> GeometryTag:
    if isinstance(data_type, T.BinaryType):
        return GeometryTag("wkb", dims=None)
    if isinstance(data_type, T.StringType):
        return GeometryTag("wkt", dims=None)
    if isinstance(data_type, T.StructType):
        if tuple(data_type.names) == BOX_FIELDS:
            return GeometryTag("box")
        if "".join(data_type.names) in DIMENSIONS:
            return GeometryTag("native", "point", "".join(data_type.names))
    raise ValueError(f"Column type {data_type.simpleString()} needs a geometry tag")


def geometry_tag(df: DataFrame, column: str = GEOMETRY) -> GeometryTag:
    return tag_of(df.schema[column])


def tagged(value: Column, tag: GeometryTag, name: str = GEOMETRY) -> Column:
    return value.alias(name, metadata=tag.to_metadata())
