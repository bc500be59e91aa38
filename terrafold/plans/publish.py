"""Publishing layers in every format, converting streams, and the example grid."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.types import DIMENSIONS, NESTING, GeometryTag, geometry_tag
from ..operators.columns import (
    as_encoding,
    centroid,
    declare,
    round_coords,
    set_dims,
    with_encoding,
)
from ..operators.compare import schemas_equal, table_differences
from ..operators.ordering import cluster
from ..sources.arrow_stream import CHUNK, read_arrow, write_arrow
from ..sources.geojson import read_geojson
from ..sources.parquet import prepared, read_geo, write_geo
from ..sources.shared import current_version, fresh_path, materialized, new_version, path_exists, replacing
from ..sources.text import concat_lists, merge_lists, wkt_lists, write_wkt_tsv
from .catalog import SUFFIXES

# Encoding and coordinate layout of each format that holds a table.
FORMS = {
    "tsv": ("wkt", "separated"),
    "arrows": ("native", "separated"),
    "arrows/interleaved": ("native", "interleaved"),
    "arrows/box": ("box", "separated"),
    "arrows/wkb": ("wkb", "separated"),
    "arrows/wkt": ("wkt", "separated"),
    "parquet": ("wkb", "separated"),
    "geoparquet": ("wkb", "separated"),
    "geoparquet/native": ("native", "separated"),
}


def write_once(write, path: str, lazy: bool = True) -> bool:
    """Run ``write(path)`` unless a finished output is there; says whether it ran."""
    if lazy and path_exists(f"{path}/_SUCCESS"):
        return False
    write(path)
    return True


def require_sinks(formats: list[str]) -> None:
    unknown = [fmt for fmt in formats if fmt not in FORMS]
    if unknown:
        raise ValueError(f"No sink writes format {', '.join(unknown)}")


def write_format(
    df: DataFrame, fmt: str, path: str, compression: str = "zstd", versioned: bool = False, **options
) -> None:
    """Write a table in one format, partitions and their order as they are.

    ``versioned`` makes the output one whose versions are switched; see ``republish``.
    """
    if fmt not in FORMS:
        raise ValueError(f"No sink writes format {fmt}")
    encoding, layout = FORMS[fmt]
    options = {"compression": compression, "overwrite": True, "versioned": str(versioned), **options}
    if fmt == "tsv":
        lines = as_encoding(df, "wkt").select("geometry")
        if versioned:
            new_version(path, lambda folder: write_wkt_tsv(lines, folder))
        else:
            write_wkt_tsv(lines, path)
    elif fmt == "arrows/wkb":
        df, encode = prepared(df, "wkb")
        write_arrow(df, path, encode_wkb=encode, **options)
    elif fmt.startswith("arrows"):
        write_arrow(as_encoding(df, encoding, layout), path, **options)
    else:
        write_geo(df, path, encoding, **options)


def publish(
    df: DataFrame, root: str, group: str, name: str, formats: list[str],
    skip: tuple[str, ...] = (), compression: str = "zstd", lazy: bool = True, versioned: bool = False,
) -> list[str]:
    """Write a layer in every format it lists but those in ``skip``; returns the paths written.

    A format that no sink writes is an error before anything is written. An output that is
    there is left alone if ``lazy``, else replaced once the new one stands: by a folder
    renamed, or if ``versioned`` by a new version beside the old one.
    The ordered layer is kept on executor disks between the writes. Lost blocks are
    computed again from the shuffle, with the same cuts.
    """
    wanted = [fmt for fmt in formats if fmt not in skip]
    require_sinks(wanted)
    kept = df.persist(StorageLevel.DISK_ONLY)
    written = []
    try:
        for fmt in wanted:
            path = f"{root}/{group}/files/{group}_{name}{SUFFIXES[fmt]}"
            if versioned:
                if not lazy or current_version(path) is None:
                    write_format(kept, fmt, path, compression, True)
                    written.append(path)
            elif write_once(lambda p, f=fmt: replacing(lambda new: write_format(kept, f, new, compression), p), path, lazy):
                written.append(path)
    finally:
        kept.unpersist()
    return written


def republish(
    df: DataFrame, root: str, group: str, name: str, formats: list[str],
    skip: tuple[str, ...] = (), compression: str = "zstd",
) -> list[str]:
    """A new version of a layer in every format; readers get the old one until the new one stands.

    Tasks write files under their final names in a folder of the new version. The commit lists them and
    switches one small file that names the version. A write that fails switches nothing, and what
    it left is removed by ``drop_versions``.
    """
    return publish(df, root, group, name, formats, skip, compression, lazy=False, versioned=True)


def publish_layer(
    df: DataFrame, root: str, group: str, name: str, formats: list[str], tie: list[str],
    partitions: int | None = None, **options,
) -> list[str]:
    """Cluster a layer along the Hilbert curve, then publish it."""
    return publish(cluster(df, tie, partitions), root, group, name, formats, **options)


def point_layer(spark: SparkSession, archives: str | list[str], digits: int = 8) -> DataFrame:
    """Footprint archives to rounded centroids in curve order.

    The centroids are written once: the extent and the sort both read that table, and
    neither reads the archives again.
    """
    footprints = read_geojson(spark, archives, rebalance=True)
    points = round_coords(centroid(footprints), digits).select("geometry")
    points = materialized(points, "centroids")
    # Many footprints may share a centroid; where a row stands in that table tells them apart.
    placed = points.select(
        "geometry",
        F.col("_metadata.file_name").alias("__file"),
        F.col("_metadata.row_index").alias("__row"),
    )
    return cluster(placed, ["__file", "__row"]).drop("__file", "__row")


def convert_table(
    spark: SparkSession, src: str, dst: str, compression: str = "none", geo_metadata: bool = True
) -> None:
    """Stream files to Parquet: a file for each file, a row group for each batch."""
    df = read_arrow(spark, src, chunks=True)
    write_geo(df, dst, "wkb", compression, geo_metadata=geo_metadata, overwrite=True, chunk_column=CHUNK)


def conversion_matches(spark: SparkSession, src: str, dst: str) -> bool:
    """Whether a converted table has the schema and the rows of its source."""
    original, reread = read_arrow(spark, src), read_geo(spark, dst)
    return schemas_equal(original, reread) and table_differences(original, reread).isEmpty()


@dataclass
class Conversion:
    name: str
    src: str
    dst: str
    compression: str = "none"


def convert_all(spark: SparkSession, jobs: list[Conversion], geo_metadata: bool = True) -> DataFrame:
    """Convert and check every table; one row (name, ok) each."""
    rows = []
    for job in jobs:
        convert_table(spark, job.src, job.dst, job.compression, geo_metadata)
        rows.append((job.name, conversion_matches(spark, job.src, job.dst)))
    return spark.createDataFrame(rows, "name string, ok boolean")


def kind_of_list(name: str) -> tuple[str | None, str | None]:
    """Type and dimensions a list's name declares: ``polygon-zm``; None where rows differ."""
    kind, _, suffix = name.partition("-")
    dims = "xy" + suffix
    if kind in NESTING and dims in DIMENSIONS:
        return kind, dims
    return None, None


def add_dimensions(lists: DataFrame, z: bool, m: bool) -> DataFrame:
    """Typed WKT lists with z = x + y and m = x · y, under the dimension's name."""
    suffix = ("z" if z else "") + ("m" if m else "")
    out = None
    for kind in NESTING:
        part = declare_list(lists.filter(F.col("name") == kind), kind, "xy")
        part = as_encoding(part, "native")
        part = set_dims(
            part,
            (lambda c: c["x"] + c["y"]) if z else None,
            (lambda c: c["x"] * c["y"]) if m else None,
        )
        part = as_encoding(part, "wkt").select(
            F.concat("name", F.lit(f"-{suffix}")).alias("name"), "pos", F.col("geometry").alias("wkt")
        )
        out = part if out is None else out.unionByName(part)
    return out


def declare_list(lists: DataFrame, kind: str | None, dims: str | None) -> DataFrame:
    return declare(
        lists.withColumnRenamed("wkt", "geometry"), GeometryTag("wkt", kind, dims)
    )


def example_lists(spark: SparkSession, *mappings: dict[str, list[str | None]]) -> DataFrame:
    """Named lists, later mappings replacing earlier ones, plus all dimensions of the mixed list."""
    lists = wkt_lists(spark, mappings[0])
    for mapping in mappings[1:]:
        lists = merge_lists(lists, wkt_lists(spark, mapping))
    mixed = concat_lists(
        lists, ["geometry", "geometry-z", "geometry-m", "geometry-zm"], "geometry-mixed-dimensions"
    )
    return lists.unionByName(mixed)


def publish_example(
    lists: DataFrame, root: str, group: str, name: str, formats: list[str], skip: tuple[str, ...] = ()
) -> list[str]:
    """One named list in every format: a text column beside its encoding, but plain lines in tsv.

    A list of mixed types has no native form: its native formats must be named in ``skip``.
    """
    formats = [fmt for fmt in formats if fmt not in skip]
    require_sinks(formats)
    kind, dims = kind_of_list(name)
    native = [fmt for fmt in formats if FORMS[fmt][0] == "native"]
    if kind is None and native:
        raise ValueError(f"{name} has mixed types and no native form for {', '.join(native)}")
    chosen = declare_list(lists.filter(F.col("name") == name), kind, dims)
    ordered = chosen.repartitionByRange("pos").sortWithinPartitions("pos").select("geometry")
    written = []
    for fmt in formats:
        path = f"{root}/{group}/files/{group}_{name}{SUFFIXES[fmt]}"
        if fmt == "tsv":
            replacing(lambda new: write_wkt_tsv(ordered, new), path)
        else:
            encoding, layout = FORMS[fmt]
            pair = with_encoding(ordered, encoding, layout)
            if fmt.startswith("arrows"):
                write_arrow(pair, path, compression="none", overwrite=True)
            else:
                write_geo(pair, path, encoding, overwrite=True)
        written.append(path)
    return written


def roundtrip(df: DataFrame, fmt: str, compression: str = "zstd") -> DataFrame:
    """Write a table in one format to the shared folder and read it back."""
    spark = df.sparkSession
    path = fresh_path(spark, "roundtrip")
    write_format(df, fmt, path, compression)
    if fmt.startswith("arrows"):
        return read_arrow(spark, path)
    return read_geo(spark, path)


def same_after(df: DataFrame, fmt: str) -> bool:
    back = roundtrip(df, fmt)
    encoding, layout = FORMS[fmt]
    expected = as_encoding(df, encoding, layout)
    return geometry_tag(back) == geometry_tag(expected) and table_differences(expected, back).isEmpty()
