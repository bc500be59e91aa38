"""Geometry tables derived from the test tables, over all of their rows."""

from __future__ import annotations

import io
import uuid
import zipfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.coords import NAN, coord_struct, make_box
from ..functions.types import GeometryTag, tagged
from ..operators.ordering import spread
from ..operators.vertices import line_pieces
from ..sources.shared import list_files, materialized, open_fs
from .validate import FEATURE_MAGIC
from .catalog import SUFFIXES

CRS84 = {"crs": "OGC:CRS84", "crs_type": "authority_code"}
PIECE = 64
#: Parts whose assets, eight or so each, one task lists.
PARTS_PER_TASK = 50_000
REPO_BASE = "https://example.org/raw"
RELEASE_BASE = "https://example.org/releases"
REF = "v1"
OVERRIDES = {"NATION_3": (171.5, -168.25), "NATION_17": (35.125, -174.75)}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _xy() -> tuple[Column, Column]:
    return (
        F.expr("((event_id * 7919) % 36000) / 1e2 - 180e0"),
        F.expr("((user_id * 104729 + event_id * 31) % 17000) / 1e2 - 85e0"),
    )


def vertices(spark: SparkSession, sf: str) -> DataFrame:
    x, y = _xy()
    return table(spark, sf, "events").select("user_id", "ts", "event_id", x.alias("x"), y.alias("y"))


def points(spark: SparkSession, sf: str) -> DataFrame:
    """Points with null rows and empty rows among them."""
    x, y = _xy()
    value = (
        F.when(F.col("event_id") % 97 == 0, F.lit(None))
        .when(F.col("event_id") % 89 == 1, coord_struct({"x": F.lit(NAN), "y": F.lit(NAN)}))
        .otherwise(coord_struct({"x": x, "y": y}))
    )
    tag = GeometryTag("native", "point", "xy", **CRS84)
    return table(spark, sf, "events").select(F.col("event_id").alias("fid"), tagged(value, tag))


def scaled_points(spark: SparkSession, sf: str, x: str, y: str) -> DataFrame:
    """All event positions moved to near a projection's centre by expressions on x and y."""
    tag = GeometryTag("native", "point", "xy", **CRS84)
    moved = vertices(spark, sf)
    value = coord_struct({"x": F.expr(x), "y": F.expr(y)})
    return moved.select(F.col("event_id").alias("fid"), tagged(value, tag))


def user_points(spark: SparkSession, sf: str) -> DataFrame:
    """The position of every event as a point, with its user."""
    tag = GeometryTag("native", "point", "xy", **CRS84)
    rows = vertices(spark, sf)
    return rows.select("user_id", tagged(coord_struct({"x": F.col("x"), "y": F.col("y")}), tag))


def tracks(spark: SparkSession, sf: str, piece: int = PIECE) -> DataFrame:
    """A line per user through its events in time, cut into pieces: user_id, piece, geometry."""
    return line_pieces(vertices(spark, sf), ["user_id"], ["ts", "event_id"], piece)


def _ring(corners: list[tuple[str, str]]) -> Column:
    return F.array(*[coord_struct({"x": F.expr(x), "y": F.expr(y)}) for x, y in corners])


_ORIGIN = {
    "x0": "((p_partkey * 7919) % 36000) / 1e2 - 180e0",
    "y0": "((p_partkey * 104729) % 17000) / 1e2 - 85e0",
    "w": "(p_size + 1) / 1e3",
}
_SHELL = [
    ("x0", "y0"), ("x0 + 2 * w", "y0"), ("x0 + 2 * w", "y0 + w"), ("x0 + w", "y0 + w"),
    ("x0 + w", "y0 + 2 * w"), ("x0", "y0 + 2 * w"), ("x0", "y0"),
]
# Wound against its shell for odd keys and along with it for even ones.
_HOLE = [
    ("x0 + w / 4", "y0 + w / 4"), ("x0 + w / 2", "y0 + w / 4"), ("x0 + w / 2", "y0 + w / 2"),
    ("x0 + w / 4", "y0 + w / 4"),
]


def _origins(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part")
    return parts.select("p_partkey", *[F.expr(e).alias(n) for n, e in _ORIGIN.items()])


def footprints(spark: SparkSession, sf: str, courtyard: bool = False) -> DataFrame:
    """L-shaped polygons; with a courtyard each has a triangular hole."""
    rings = [_ring(_SHELL)]
    if courtyard:
        hole = _ring(_HOLE)
        rings.append(F.when(F.col("p_partkey") % 2 == 0, hole).otherwise(F.reverse(hole)))
    tag = GeometryTag("native", "polygon", "xy", **CRS84)
    return _origins(spark, sf).select(
        F.col("p_partkey").alias("fid"), tagged(F.array(*rings), tag)
    )


def collections(spark: SparkSession, sf: str) -> DataFrame:
    """WKT collections of a point and a nested collection of a line and a point."""
    key = F.col("p_partkey")
    text = F.format_string(
        "GEOMETRYCOLLECTION (POINT (%d %d), GEOMETRYCOLLECTION (LINESTRING (%d %d, %d %d), POINT (%d 0)))",
        key, key + 1, key, key * 2, key + 3, key * 3, key,
    )
    tag = GeometryTag("wkt", None, None, **CRS84)
    return table(spark, sf, "part").select(key.alias("fid"), tagged(text, tag))


def regions(spark: SparkSession, sf: str) -> DataFrame:
    """Boxes, some across the antimeridian: name, region, geometry."""
    east = F.expr("n_nationkey * 14 - 180e0 + 30")
    xmax = F.when(east > 180, east - 360).otherwise(east)
    ymin = F.expr("n_regionkey * 30 - 80e0")
    value = make_box(F.expr("n_nationkey * 14 - 180e0"), ymin, xmax, ymin + 25)
    tag = GeometryTag("box", **CRS84)
    return table(spark, sf, "nation").select(
        F.col("n_name").alias("name"), F.col("n_regionkey").alias("region"), tagged(value, tag)
    )


def manifests(spark: SparkSession, sf: str) -> DataFrame:
    """A manifest row per part, in the shape of parsed manifests."""
    formats = F.array(*[F.lit(f) for f in SUFFIXES])
    skip = F.filter(formats, lambda f: F.array_position(formats, f) % (F.col("p_size") % 5 + 2) == 0)
    name = F.expr("concat(replace(p_name, ' ', '-'), '-', p_partkey)")
    nothing = F.lit(None).cast("array<string>")
    file = F.struct(name.alias("name"), nothing.alias("format"), skip.alias("skip_format"))
    group = F.expr("translate(lower(replace(p_brand, '#', '-')), '0123456789', 'abcdefghij')")
    location = F.when(F.col("p_size") % 2 == 0, "repo").otherwise("release")
    parts = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    return spread(parts, ["p_partkey"], PARTS_PER_TASK).select(
        "p_partkey",
        group.alias("group"),
        location.alias("file_location"),
        formats.alias("format"),
        F.array(file).alias("files"),
    )


def awkward_note() -> Column:
    """A text with quotes, brackets and backslashes, as strings in JSON may hold."""
    return F.concat(
        F.lit('a "'), "p_name", F.lit('" ['), F.col("p_partkey").cast("string"), F.lit("] {"), "p_brand", F.lit('} \\ ]},"features":[ \\"é')
    )


def write_collections(features: DataFrame, path: str) -> None:
    """One GeoJSON document for each partition of (…, feature), with other keys around its features."""

    def write(batches):
        files, place = open_fs(path)
        files.create_dir(place, recursive=True)
        name, count = f"{uuid.uuid4().hex}.geojson", 0
        with files.open_output_stream(f"{place}/{name}") as out:
            out.write(HEAD.encode())
            for batch in batches:
                for feature in batch.column("feature").to_pylist():
                    out.write((",\n  " if count else "").encode() + feature.encode())
                    count += 1
            out.write(TAIL.encode())
        yield pa.RecordBatch.from_arrays([pa.array([count], pa.int64())], ["features"])

    features.mapInArrow(write, "features bigint").agg(F.sum("features")).collect()


# What stands around the features of a collection: brackets in strings, a list of the same name further in.
HEAD = '{"type": "FeatureCollection", "name": "]}{ \\\\", "crs": {"properties": {"features": [{"type": "Feature"}]}},\n"features" : ['
TAIL = '\n], "other": [{"type": "Feature"}, [1, 2]], "count": 3}'

#: What is done to a copy of a file.
DAMAGES = ("whole", "truncated", "empty", "misnamed")


def _feature_file(path: str, damage: str) -> bytes:
    """A binary feature file's first bytes and no features, bare or in an archive."""
    name = path.rpartition("/")[2]
    data = FEATURE_MAGIC + b"no features"
    if name.endswith(".zip"):
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w") as archive:
            archive.writestr(name.removesuffix(".zip"), data)
        data = packed.getvalue()
    return data[: {"truncated": 6, "empty": 0}.get(damage, len(data))]


def damaged_copies(spark: SparkSession, paths: dict[str, str], root: str) -> DataFrame:
    """(path, format, damage): copies of one file of each format, some cut, emptied, or under the name of another format.

    Executors copy, a chunk at a time. Binary feature files are made of the first bytes such a file has and a text.
    """
    formats = list(paths)
    rows = [(fmt, damage, paths["tsv"], f"{root}/{damage}{SUFFIXES[fmt]}") for fmt in ("fgb", "fgb/zip") for damage in DAMAGES]
    for i, fmt in enumerate(formats):
        for damage in DAMAGES:
            # Under another name goes a file of another kind.
            source = "tsv" if fmt != "tsv" else formats[i - 1]
            rows.append((fmt, damage, paths[source if damage == "misnamed" else fmt], f"{root}/{i}-{damage}{SUFFIXES[fmt]}"))
    spread = spark.createDataFrame(rows, "format string, damage string, src string, path string").repartition(len(rows))

    def copy(batches):
        for batch in batches:
            for row in batch.to_pylist():
                source, size = list_files(row["src"], ("",))[0]
                left = {"truncated": size // 2, "empty": 0}.get(row["damage"], size)
                files, place = open_fs(source)
                target, to = open_fs(row["path"])
                target.create_dir(to.rpartition("/")[0], recursive=True)
                if row["format"].startswith("fgb") and row["damage"] != "misnamed":
                    with target.open_output_stream(to) as out:
                        out.write(_feature_file(to, row["damage"]))
                    continue
                with files.open_input_stream(place) as raw, target.open_output_stream(to) as out:
                    while left > 0 and (chunk := raw.read(min(left, 1 << 20))):
                        out.write(chunk)
                        left -= len(chunk)
            yield batch.select(["path", "format", "damage"])

    made = spread.mapInArrow(copy, "path string, format string, damage string")
    return materialized(made, "damaged-list")
