"""The registered queries: each operator over a whole table derived from the test data."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import coords, wkt
from ..functions.crs import PROJJSON, WKT2_CRS84
from ..functions.types import GEOMETRY, GeometryTag, geometry_tag
from ..operators import columns as C
from ..operators import compare, extent, ordering, vertices
from ..sources import geojson, text
from ..sources.arrow_stream import read_arrow, write_arrow
from ..sources.parquet import footers, read_geo, write_geo
from ..sources.shared import fresh_path
from . import catalog, fixtures, publish, validate

Query = Callable[[SparkSession, str], DataFrame]
#: Ranges that positions on the curve are counted in, however small the table.
RANGES = 8
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _xy(geom: str = GEOMETRY, digits: int | None = None) -> list[Column]:
    """x and y with null for the NaN of empty points."""
    out = []
    for d in "xy":
        value = F.nanvl(F.col(f"{geom}.{d}"), F.lit(None).cast("double"))
        out.append((value if digits is None else F.bround(value, digits)).alias(d))
    return out


def _limits(box: str = GEOMETRY) -> list[Column]:
    return [F.col(f"{box}.{n}").alias(n) for n in ("xmin", "ymin", "xmax", "ymax")]


# ---------------------------------------------------------------- order and extent


@query
def hilbert_order(spark, sf):
    keyed = ordering.hilbert_order(fixtures.points(spark, sf), ["fid"])
    return keyed.select("fid", "hilbert_key")


@query
def hilbert_position(spark, sf):
    keyed = ordering.hilbert_key(fixtures.points(spark, sf))
    # Rows without a key come last.
    last = F.coalesce("hilbert_key", F.lit(1 << 33)).alias("at")
    ranked = ordering.with_running(keyed.select("fid", last), ["at", "fid"], name="position", ranges=RANGES)
    return ranked.select("fid", "position")


@query
def footprint_clusters(spark, sf):
    keyed = ordering.hilbert_key(fixtures.footprints(spark, sf))
    return keyed.select("fid", "hilbert_key")


@query
def point_extent(spark, sf):
    return extent.extent(fixtures.points(spark, sf))


@query
def track_extent(spark, sf):
    return extent.extent(fixtures.tracks(spark, sf), ["user_id"])


@query
def region_extent(spark, sf):
    edited = C.override_boxes(fixtures.regions(spark, sf), "name", fixtures.OVERRIDES)
    return extent.extent(edited, ["region"])


@query
def footer_limits(spark, sf):
    solid = C.set_dims(fixtures.points(spark, sf), z=lambda c: c["x"] + c["y"])
    box = extent.footer_bbox(solid)
    return box.select(
        *[F.bround(F.col("bbox")[i], 8).alias(n) for i, n in enumerate(("xmin", "ymin", "zmin", "xmax", "ymax", "zmax"))]
    )


# ---------------------------------------------------------------- measures


@query
def footprint_centroid(spark, sf):
    centres = C.round_coords(C.centroid(fixtures.footprints(spark, sf)), 8)
    return centres.select("fid", *_xy())


@query
def courtyard_centroid(spark, sf):
    centres = C.round_coords(C.centroid(fixtures.footprints(spark, sf, courtyard=True)), 8)
    return centres.select("fid", *_xy())


@query
def rounded_boxes(spark, sf):
    boxes = C.round_coords(C.to_box(fixtures.footprints(spark, sf)), 4)
    return boxes.select("fid", *_limits())


@query
def null_and_empty(spark, sf):
    points = fixtures.points(spark, sf)
    return points.select(
        "fid",
        F.col(GEOMETRY).isNull().alias("is_null"),
        coords.is_empty(F.col(GEOMETRY), "point").alias("is_empty"),
        C.box_column(points).isNull().alias("no_box"),
    )


# ---------------------------------------------------------------- encodings


@query
def point_wkb(spark, sf):
    encoded = C.as_encoding(fixtures.points(spark, sf), "wkb")
    decoded = C.as_encoding(encoded.withColumn("wkb", F.hex(GEOMETRY)), "native")
    return decoded.select("fid", "wkb", *_xy())


@query
def point_wkt(spark, sf):
    written = C.as_encoding(fixtures.points(spark, sf), "wkt")
    parsed = C.as_encoding(written.withColumn("wkt", F.col(GEOMETRY)), "native")
    return parsed.select("fid", "wkt", *_xy())


@query
def footprint_wkb(spark, sf):
    encoded = C.as_encoding(fixtures.footprints(spark, sf, courtyard=True), "wkb")
    decoded = C.as_encoding(encoded.withColumn("wkb", F.hex(GEOMETRY)), "native")
    rings = F.size(GEOMETRY)
    return decoded.select("fid", "wkb", rings.alias("rings"), F.size(F.col(GEOMETRY)[1]).alias("hole"))


@query
def track_wkt(spark, sf):
    written = C.as_encoding(fixtures.tracks(spark, sf), "wkt")
    return written.select("user_id", "piece", F.col(GEOMETRY).alias("wkt"))


@query
def track_wkb(spark, sf):
    encoded = C.as_encoding(fixtures.tracks(spark, sf), "wkb")
    return encoded.select("user_id", "piece", F.hex(GEOMETRY).alias("wkb"))


@query
def track_roundtrip(spark, sf):
    written = C.as_encoding(fixtures.tracks(spark, sf), "wkt")
    same = C.wkt_is_canonical(written)
    return written.agg(F.count("*").alias("pieces"), F.count_if(~same).alias("mismatches"))


@query
def vertices_zm(spark, sf):
    rows = vertices.explode_pieces(fixtures.tracks(spark, sf), ["user_id"], fixtures.PIECE)
    return rows.select(
        "user_id", "seq", "x", "y",
        F.bround(F.col("x") + F.col("y"), 8).alias("z"), F.bround(F.col("x") * F.col("y"), 8).alias("m"),
    )


@query
def zm_coords(spark, sf):
    solid = C.set_dims(
        fixtures.points(spark, sf), z=lambda c: c["x"] + c["y"], m=lambda c: c["x"] * c["y"]
    )
    filled = solid.filter(~coords.is_empty(F.col(GEOMETRY), "point"))
    return filled.select(
        "fid", *[F.bround(F.col(f"{GEOMETRY}.{d}"), 8).alias(d) for d in "xyzm"]
    )


@query
def ring_vertices(spark, sf):
    rows = vertices.explode_coords(fixtures.footprints(spark, sf, courtyard=True), ["fid"])
    return rows.select("fid", "ring", "seq", F.bround("x", 8).alias("x"), F.bround("y", 8).alias("y"))


@query
def ring_assembly(spark, sf):
    whole = fixtures.footprints(spark, sf, courtyard=True)
    rows = vertices.explode_coords(whole, ["fid"])
    again = vertices.assemble_coords(rows, ["fid"], "polygon")
    left, right = whole.select("fid", GEOMETRY), again.select("fid", GEOMETRY)
    paired = compare.pair_by_position(left, right, "fid")
    return paired.agg(F.count("*").alias("rows"), F.count_if("equal").alias("equal_rows"))


@query
def layout_switch(spark, sf):
    flat = C.with_coord_layout(fixtures.points(spark, sf), "interleaved")
    back = C.with_coord_layout(flat.withColumn("n", F.size(GEOMETRY)), "separated")
    return back.select("fid", "n", *_xy())


@query
def mixed_members(spark, sf):
    members = C.explode_members(fixtures.collections(spark, sf))
    member = C.as_encoding(members, "wkt")
    return member.select("fid", "path", F.col(GEOMETRY).alias("wkt"))


@query
def collection_wkb(spark, sf):
    encoded = C.as_encoding(fixtures.collections(spark, sf), "wkb")
    return encoded.select("fid", F.hex(GEOMETRY).alias("wkb"), C.geometry_type(encoded).alias("kind"))


@query
def geometry_types(spark, sf):
    mixed = GeometryTag("wkb", None, None)
    points = C.declare(C.as_encoding(fixtures.points(spark, sf), "wkb"), mixed)
    solid = C.set_dims(fixtures.points(spark, sf), z=lambda c: c["x"])
    solid = C.declare(C.as_encoding(solid, "wkb"), mixed)
    shapes = C.declare(C.as_encoding(fixtures.footprints(spark, sf), "wkb"), mixed)
    groups = C.declare(C.as_encoding(fixtures.collections(spark, sf), "wkb"), mixed)
    union = points.unionByName(solid).unionByName(shapes).unionByName(groups)
    kinds = extent.geometry_types(C.declare(union, mixed))
    return kinds.select(F.array_join("geometry_types", ",").alias("geometry_types"))


@query
def line_tags(spark, sf):
    written = C.as_encoding(fixtures.points(spark, sf), "wkt")
    line = F.coalesce(F.col(GEOMETRY), F.lit(""))
    return written.agg(
        F.count("*").alias("lines"),
        F.count_if(line == "").alias("blank"),
        F.count_if(line.rlike("^[A-Z]+")).alias("tagged"),
        F.count_if(wkt.strip_tag(line) == "EMPTY").alias("empties"),
    )


# ---------------------------------------------------------------- projections


@query
def utm_forward(spark, sf):
    near = fixtures.scaled_points(spark, sf, "x / 60e0 - 75e0", "y")
    return C.reproject(near, "OGC:CRS84", "EPSG:32618").select("fid", *_xy(digits=2))


@query
def ortho_forward(spark, sf):
    near = fixtures.scaled_points(spark, sf, "x / 6e0 - 72.69e0", "43.88e0 + y / 4e0")
    return C.reproject(near, "OGC:CRS84", "ortho").select("fid", *_xy(digits=2))


@query
def projection_inverse(spark, sf):
    near = fixtures.scaled_points(spark, sf, "x / 60e0 - 75e0", "y / 4e0 + 43.88e0")
    start = near.select("fid", F.col(GEOMETRY).alias("start"), GEOMETRY)
    worst = []
    for crs in ("EPSG:32618", "ortho"):
        back = C.reproject(C.reproject(start, "OGC:CRS84", crs), crs, "OGC:CRS84")
        error = F.greatest(*[F.abs(F.col(f"{GEOMETRY}.{d}") - F.col(f"start.{d}")) for d in "xy"])
        worst.append(
            back.agg(F.count("*").alias("rows"), F.count_if(error > 1e-9).alias("beyond")).select(
                F.lit(crs).alias("crs"), "rows", "beyond"
            )
        )
    return worst[0].unionByName(worst[1])


@query
def footprint_utm(spark, sf):
    """Nested values go through the batch path; its vertices must agree with the point path."""
    shapes = fixtures.footprints(spark, sf)
    # All footprints moved next to the zone's meridian.
    near = coords.map_coords(
        F.col(GEOMETRY), "polygon",
        lambda c: coords.coord_struct({"x": c["x"] / F.lit(60.0) - F.lit(75.0), "y": c["y"]}),
    )
    shapes = C.replace_geometry(shapes, near, geometry_tag(shapes))
    moved = C.reproject(shapes, "OGC:CRS84", "EPSG:32618")
    rows = vertices.explode_coords(moved, ["fid"])
    return rows.select("fid", "seq", F.bround("x", 2).alias("x"), F.bround("y", 2).alias("y"))


# ---------------------------------------------------------------- boxes


@query
def box_override(spark, sf):
    edited = C.override_boxes(fixtures.regions(spark, sf), "name", fixtures.OVERRIDES)
    shapes = C.as_encoding(C.box_to_multipolygon(edited), "wkt")
    joined = edited.join(shapes.select("name", F.col(GEOMETRY).alias("wkt")), "name")
    return joined.select("name", *_limits(), "wkt")


@query
def box_polygon(spark, sf):
    """Boxes as polygons, those across the antimeridian as the two parts they have there."""
    boxes = fixtures.regions(spark, sf)
    wraps = coords.box_wraps(F.col(GEOMETRY))
    plain, parted = C.box_to_polygon(boxes.filter(~wraps)), C.box_to_multipolygon(boxes.filter(wraps))
    shapes = C.as_encoding(plain, "wkt").unionByName(C.as_encoding(parted, "wkt"))
    return shapes.select("name", F.col(GEOMETRY).alias("wkt"))


@query
def box_wrap_parts(spark, sf):
    shapes = C.box_to_multipolygon(fixtures.regions(spark, sf))
    rows = vertices.explode_coords(shapes, ["name"])
    return rows.groupBy("name", "part").agg(
        F.min("x").alias("west"), F.max("x").alias("east"), F.count("*").alias("corners")
    )


@query
def region_filter(spark, sf):
    shapes = C.select_as(fixtures.regions(spark, sf), {"name": "region_name", "geometry": "geometry"})
    known = shapes.filter(F.col("region_name").isNotNull() & F.col(GEOMETRY).isNotNull())
    return known.filter(F.col("region_name") == "NATION_7").select("region_name", *_limits())


# ---------------------------------------------------------------- catalog


def _assets(spark, sf) -> DataFrame:
    expanded = catalog.expand_manifests(fixtures.manifests(spark, sf))
    return catalog.with_paths(expanded, fixtures.REF, fixtures.REPO_BASE, fixtures.RELEASE_BASE)


def _ordered_assets(spark, sf) -> DataFrame:
    """Assets with a place in the whole listing: parts by key, formats in their order."""
    key = F.element_at(F.split("name", "-"), -1).cast("bigint")
    return _assets(spark, sf).withColumn("ordinal", key * 16 + F.col("format_pos"))


@query
def asset_expand(spark, sf):
    return _assets(spark, sf).select("group", "name", "format", "path", "url")


@query
def asset_listing(spark, sf):
    files = _ordered_assets(spark, sf).withColumn("tag", F.lit(fixtures.REF))
    lines = catalog.listing_lines(files)
    return lines.select("group", "tag", F.col("at").alias("place"), "line")


@query
def manifest_lines(spark, sf):
    lines = catalog.manifest_lines(_assets(spark, sf), fixtures.REF)
    return lines.select("group", "name", "json")


@query
def group_order(spark, sf):
    return ordering.first_appearance(_ordered_assets(spark, sf), ["group"], "ordinal").orderBy("ordinal")


@query
def asset_diff(spark, sf):
    files = _ordered_assets(spark, sf)
    # Odd parts are present; their first format is present under an undeclared name as well.
    present = files.filter(F.floor(F.col("ordinal") / 16) % 2 == 1)
    strangers = present.filter(F.col("format_pos") == 0).select(F.concat(F.lit("x"), "file").alias("file"))
    found = compare.completeness(files, present.select("file").unionByName(strangers), "file")
    return found.select("file", "status")


@query
def name_parse(spark, sf):
    place = F.floor(F.col("ordinal") / 16) % 5
    path = (
        F.when(place == 1, F.concat("path", F.lit("x")))
        .when(place == 2, F.replace(F.col("path"), F.lit("/files/"), F.lit("/data/")))
        .when(place == 3, F.concat(F.lit("other"), "path"))
        .when(place == 4, F.replace(F.col("path"), F.lit("_"), F.lit("")))
        .otherwise(F.col("path"))
    )
    rows = _ordered_assets(spark, sf).select("ordinal", path.alias("path"))
    parsed = catalog.check_paths(rows, "path")
    return parsed.select("ordinal", "group", "name", "suffix", "format", "error")


@query
def name_filters(spark, sf):
    files = catalog.only_location(_assets(spark, sf), "repo")
    files = catalog.only_format(files, "arrows/wkb").filter(~F.col("file").startswith("."))
    files = catalog.keep_keys(files, "group", ["brand-b", "brand-h", "brand-ba", "brand-bh"])
    files = files.withColumn("base", catalog.base_name(F.col("file"), catalog.SUFFIXES["arrows/wkb"]))
    files = catalog.without_names(files, "base", ["widget"], "brand-h", "brand-h_red-bolt-1")
    compression = catalog.size_compression(F.col("base"), ["brand-ba", "brand-h"])
    return files.filter(F.col("base").rlike("^[a-z]+")).select("base", compression.alias("compression"))


# ---------------------------------------------------------------- files written and read back


def _point_rows(df: DataFrame) -> DataFrame:
    native = C.with_coord_layout(C.as_encoding(df, "native"), "separated")
    return native.select("fid", F.col(GEOMETRY).isNull().alias("is_null"), *_xy())


@query
def parquet_roundtrip(spark, sf):
    points = ordering.cluster(fixtures.points(spark, sf), ["fid"])
    return _point_rows(publish.roundtrip(points, "geoparquet"))


@query
def parquet_native_roundtrip(spark, sf):
    points = ordering.cluster(fixtures.points(spark, sf), ["fid"])
    return _point_rows(publish.roundtrip(points, "geoparquet/native"))


@query
def arrow_roundtrip(spark, sf):
    return _point_rows(publish.roundtrip(fixtures.points(spark, sf), "arrows"))


@query
def arrow_interleaved_roundtrip(spark, sf):
    return _point_rows(publish.roundtrip(fixtures.points(spark, sf), "arrows/interleaved"))


@query
def box_roundtrip(spark, sf):
    return publish.roundtrip(fixtures.regions(spark, sf), "arrows/box").select("name", *_limits())


@query
def tsv_roundtrip(spark, sf):
    points = C.as_encoding(fixtures.points(spark, sf), "wkt")
    path = fresh_path(spark, "lines")
    text.write_wkt_tsv(points, path, order=["fid"])
    lines = text.read_wkt_tsv(spark, path, "point", "xy")
    native = C.as_encoding(lines, "native")
    return native.groupBy(F.col(GEOMETRY).isNull().alias("is_null"), *_xy()).agg(F.count("*").alias("n"))


@query
def delimited_read(spark, sf):
    written = C.as_encoding(fixtures.points(spark, sf), "wkt").withColumnRenamed(GEOMETRY, "geog")
    path = fresh_path(spark, "delimited")
    written.write.csv(path, sep="\t", header=True)
    back = text.read_delimited_wkt(spark, path, "geog", "point", "xy", "fid bigint, geog string")
    return _point_rows(C.with_edges(back, "spherical"))


@query
def geojson_read(spark, sf):
    shapes = fixtures.footprints(spark, sf, courtyard=True)
    flat = C.with_coord_layout(shapes, "interleaved")
    body = F.struct(F.lit("Polygon").alias("type"), F.col(GEOMETRY).alias("coordinates"))
    feature = F.struct(
        F.lit("Feature").alias("type"), F.struct("fid").alias("properties"), body.alias("geometry")
    )
    path = fresh_path(spark, "features")
    flat.select(F.to_json(feature).alias("value")).write.text(path + ".geojsonl")
    read = geojson.read_geojson(spark, path + ".geojsonl")
    centres = C.round_coords(C.centroid(read), 8)
    fid = F.get_json_object("properties", "$.fid").cast("bigint")
    return centres.select(fid.alias("fid"), *_xy())


@query
def convert_check(spark, sf):
    """Every conversion job over the points, with the counters that must agree."""
    points = C.as_encoding(fixtures.points(spark, sf), "wkb")
    shapes = C.as_encoding(fixtures.footprints(spark, sf), "wkb")
    jobs = []
    for name, df in (("points", points), ("footprints", shapes)):
        src = fresh_path(spark, f"{name}-stream")
        write_arrow(df, src)
        jobs.append(publish.Conversion(name, src, fresh_path(spark, f"{name}-parquet"), "zstd"))
    results = publish.convert_all(spark, jobs)
    counts = compare.require_all_passed(results, "ok").select("passed", "written", "complete")
    rows = [read_arrow(spark, j.src).agg(F.count("*").alias("n")) for j in jobs]
    total = rows[0].unionByName(rows[1]).agg(F.sum("n").alias("rows"))
    return counts.select("*", total.scalar().alias("rows"))


@query
def table_equality(spark, sf):
    points = fixtures.points(spark, sf)
    path = fresh_path(spark, "points")
    write_geo(points, path, "native")
    back = spark.read.parquet(path)
    # A third of the rows is moved on one side; each gives a row that is only left and one only right.
    moved = F.when(F.col("fid") % 3 == 0, -F.col("fid") - 1).otherwise(F.col("fid"))
    shifted = back.withColumn("fid", moved)
    found = compare.table_differences(points.select("fid", GEOMETRY), shifted.select("fid", GEOMETRY))
    return found.select("fid", F.col("surplus").cast("bigint").alias("surplus"))


@query
def manifest_published(spark, sf):
    path = fresh_path(spark, "manifest")
    catalog.manifest_lines(_assets(spark, sf), fixtures.REF).select("json").write.text(path)
    return catalog.read_manifest_lines(spark, path).select("ref", "group", "name", "format", "url")


@query
def order_kept(spark, sf):
    """Positions by file and row of a written layer are the positions on the curve."""
    path = fresh_path(spark, "ordered")
    write_geo(ordering.cluster(fixtures.points(spark, sf), ["fid"]), path, "native")
    back = read_geo(spark, path, keep_order=True).select("fid", "file_name", "row_index")
    ranked = ordering.with_rank(back, ["file_name", "row_index"], name="position")
    return ranked.select("fid", "position")


@query
def footer_report(spark, sf):
    """Bounds and types of a layer from its files' footers alone."""
    path = fresh_path(spark, "footers")
    write_geo(ordering.cluster(fixtures.points(spark, sf), ["fid"]), path, "wkb")
    column = F.get_json_object("geo", "$.columns.geometry")
    facts = footers(spark, path).select(
        F.from_json(F.get_json_object(column, "$.bbox"), "array<double>").alias("b"),
        F.explode(F.from_json(F.get_json_object(column, "$.geometry_types"), "array<string>")).alias("t"),
        F.get_json_object(column, "$.encoding").alias("encoding"),
    )
    return facts.agg(
        F.min(F.col("b")[0]).alias("xmin"), F.min(F.col("b")[1]).alias("ymin"),
        F.max(F.col("b")[2]).alias("xmax"), F.max(F.col("b")[3]).alias("ymax"),
        F.array_join(F.array_sort(F.collect_set("t")), ",").alias("geometry_types"),
        F.max("encoding").alias("encoding"),
    )


@query
def crs_spellings(spark, sf):
    """The same boxes under four spellings of their system, written and read back."""
    boxes = fixtures.regions(spark, sf)
    spellings = {
        "projjson": (PROJJSON["OGC:CRS84"], "projjson"),
        "wkt2": (WKT2_CRS84, "wkt2"),
        "auth-code": ("OGC:CRS84", "authority_code"),
        "unknown": ("OGC:CRS84", None),
    }
    out = None
    for name, (crs, crs_type) in spellings.items():
        back = publish.roundtrip(C.with_crs(boxes, crs, crs_type), "arrows/wkb")
        tag = geometry_tag(back)
        rows = back.agg(F.count("*").alias("rows")).select(
            F.lit(name).alias("spelling"),
            F.lit(tag.crs_type).cast("string").alias("crs_type"),
            F.lit(tag.crs == crs).alias("kept"),
            "rows",
        )
        out = rows if out is None else out.unionByName(rows)
    return out


@query
def published_formats(spark, sf):
    """A layer in every format its manifest lists, each compared with its source."""
    points = fixtures.points(spark, sf)
    formats = [f for f in publish.FORMS if f != "arrows/box"]
    root = fresh_path(spark, "published")
    paths = publish.publish_layer(points, root, "grid", "points", formats, ["fid"])
    lines = C.as_encoding(points, "wkt").select(GEOMETRY)
    out = None
    for fmt, path in zip(formats, paths):
        if fmt == "tsv":
            back, want = text.read_wkt_tsv(spark, path, "point", "xy"), lines
        else:
            back = read_arrow(spark, path) if fmt.startswith("arrows") else read_geo(spark, path)
            want = C.as_encoding(points, *publish.FORMS[fmt])
        differences = compare.table_differences(want, back).agg(F.count("*").alias("differences"))
        row = back.agg(F.count("*").alias("rows")).select(
            F.lit(fmt).alias("format"), "rows", differences.scalar().alias("differences")
        )
        out = row if out is None else out.unionByName(row)
    return out


# ---------------------------------------------------------------- validation


@query
def line_report(spark, sf):
    """Text files of which known lines lack their upper-case tag."""
    lines = C.as_encoding(fixtures.points(spark, sf), "wkt")
    bad = F.when(F.col("fid") % 11 == 3, F.lower(GEOMETRY)).otherwise(F.col(GEOMETRY))
    path = fresh_path(spark, "lines")
    text.write_wkt_tsv(C.replace_geometry(lines, bad, geometry_tag(lines)), path, order=["fid"])
    found = validate.check_lines(spark, path)
    return found.groupBy("rule").agg(F.sum(F.col("detail").cast("bigint")).alias("lines"))


@query
def file_headers(spark, sf):
    """First bytes and sizes of written files, without reading their contents."""
    path = fresh_path(spark, "headers")
    write_geo(fixtures.points(spark, sf), path, "native")
    heads = validate.probe_headers(spark, path, 4)
    return heads.groupBy(F.col("head").cast("string").alias("head")).agg(
        F.bool_and(F.col("length") <= validate.SIZE_LIMIT).alias("within_limit")
    )


@query
def validation_report(spark, sf):
    """Point rows of which known ones are broken, checked in each encoding by its rules."""
    points = fixtures.points(spark, sf)
    fid = F.col("fid")

    lines = C.as_encoding(points, "wkt")
    bad = F.when(fid % 11 == 3, F.lower(GEOMETRY)).otherwise(F.col(GEOMETRY))
    lines = C.replace_geometry(lines, bad, geometry_tag(lines))

    binary = C.as_encoding(points, "wkb")
    junk = F.when(fid % 13 == 4, F.unhex(F.lit("01FF00000000"))).otherwise(F.col(GEOMETRY))
    binary = C.replace_geometry(binary, junk, geometry_tag(binary))

    flat = C.with_coord_layout(points, "interleaved")
    short = F.when(fid % 17 == 5, F.slice(GEOMETRY, 1, 1)).otherwise(F.col(GEOMETRY))
    flat = C.replace_geometry(flat, short, geometry_tag(flat))

    boxes = C.to_box(points)
    hollow = F.when(
        (fid % 19 == 6) & F.col(GEOMETRY).isNotNull(),
        F.struct(
            F.lit(None).cast("double").alias("xmin"),
            *[F.col(f"{GEOMETRY}.{n}").alias(n) for n in ("ymin", "xmax", "ymax")],
        ),
    ).otherwise(F.col(GEOMETRY))
    boxes = C.replace_geometry(boxes, hollow, geometry_tag(boxes))

    out = None
    for df in (lines, binary, flat, boxes):
        found = validate.check_rows(df, "fid").select("subject", "rule")
        out = found if out is None else out.unionByName(found)
    return out


@query
def size_check(spark, sf):
    """File sizes derived from part keys against the limit of 2 GiB - 1."""
    files = _ordered_assets(spark, sf).select(
        "path", (F.col("ordinal") * 1000003 % 3000000000).alias("length")
    )
    return validate.check_sizes(files).select("subject", "rule", "detail")


from . import file_queries  # noqa: E402, F401
