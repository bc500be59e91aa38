"""Registered queries over files, versions, listings and lists; each writes what it reads."""

from __future__ import annotations

import io
import json

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.types import GEOMETRY, geometry_tag
from ..operators import columns as C
from ..operators import compare, extent, ordering
from ..sources import geojson, text
from ..sources.arrow_stream import CHUNK, read_arrow, write_arrow
from ..sources.files import EXTENSION_METADATA, EXTENSION_NAME
from ..sources.json_ranges import byte_ranges, sized
from ..sources.parquet import footer_differences, footers, read_geo, write_geo
from ..sources.shared import fresh_path, open_fs
from . import catalog, fixtures, publish, validate
from .queries import _assets, _limits, _ordered_assets, _xy, query

#: Bounds of the files that the queries write, small enough to be reached by small tables.
FILE_BOUND, GROUP_ROWS, BATCH_ROWS = 400_000, 500, 700
#: Bytes of the ranges that JSON documents are read by, and rows between swapped ones.
DOCUMENT_RANGE, SWAP_EVERY = 20_000, 4000
DOCUMENTS, BUCKETS = 4, 8


# ---------------------------------------------------------------- bounds, chunks, tags


@query
def bounded_parts(spark, sf):
    """Points in files of bounded size and row groups of bounded rows: every row, and whether its file keeps to the bounds."""
    path = fresh_path(spark, "bounded")
    write_geo(fixtures.points(spark, sf), path, "wkb", row_group_rows=GROUP_ROWS, max_file_bytes=FILE_BOUND, compression="none")
    feet = footers(spark, path).select(
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        ((F.col("length") <= FILE_BOUND) & (F.array_max("group_rows") <= GROUP_ROWS)).alias("within"),
        F.get_json_object("geo", "$.columns.geometry.bbox").isNotNull().alias("described"),
    )
    rows = C.as_encoding(read_geo(spark, path, keep_order=True), "native", kind="point", dims="xy")
    rows = rows.select("fid", *_xy(), "file_name")
    return rows.join(feet, "file_name").select("fid", "x", "y", "within", "described")


@query
def chunk_sizes(spark, sf):
    """Batches of stream files and row groups of the Parquet files made of them, by size."""
    src, dst = fresh_path(spark, "chunks-stream"), fresh_path(spark, "chunks-parquet")
    dealt = fixtures.points(spark, sf).repartitionById(BUCKETS, (F.col("fid") % BUCKETS).cast("int"))
    write_arrow(C.as_encoding(dealt, "wkb"), src, batch_rows=BATCH_ROWS)
    publish.convert_table(spark, src, dst)
    batches = read_arrow(spark, src, row_index=True, chunks=True).groupBy("file_name", CHUNK).agg(F.count("*").alias("rows"))
    groups = footers(spark, dst).select(F.explode("group_rows").alias("rows")).filter("rows > 0")
    sides = batches.select("rows", F.lit(1).alias("b"), F.lit(0).alias("g")).unionByName(
        groups.select("rows", F.lit(0).alias("b"), F.lit(1).alias("g"))
    )
    return sides.groupBy("rows").agg(F.sum("b").alias("batches"), F.sum("g").alias("groups"))


@query
def footer_conflicts(spark, sf):
    """Files of one layer of which some state another system or edges: the rows of each departure."""
    points = fixtures.points(spark, sf)
    path = fresh_path(spark, "conflicts")
    kinds = {0: (), 1: (), 2: (), 3: ("crs",), 4: ("edges",)}
    for number, changes in kinds.items():
        part = points.filter(F.col("fid") % len(kinds) == number)
        if "crs" in changes:
            part = C.with_crs(part, "EPSG:32618", "authority_code")
        if "edges" in changes:
            part = C.with_edges(part, "spherical")
        # As many files of each, so that the three plain ones are most.
        write_geo(part.coalesce(1), path, "wkb")
    found = footer_differences(spark, path)
    return found.groupBy("property", "found", "expected").agg(F.sum("rows").alias("rows"))


@query
def tags_kept(spark, sf):
    """Edges through both kinds of files, and a spelling of the system through those that can state it."""
    points = fixtures.points(spark, sf)
    kinds = [("edges", C.with_edges(points, "spherical"), ("arrows/wkb", "geoparquet"))]
    kinds.append(("spelling", C.with_crs(points, "GEOGCRS[…]", "wkt2:2019"), ("arrows/wkb", "arrows")))
    out = None
    for name, df, formats in kinds:
        for fmt in formats:
            back = publish.roundtrip(df, fmt)
            tag = geometry_tag(back)
            rows = back.agg(F.count("*").alias("rows")).select(
                F.lit(name).alias("change"), F.lit(fmt).alias("format"), F.lit(tag.edges).cast("string").alias("edges"),
                F.lit(tag.crs_type).cast("string").alias("crs_type"), "rows",
            )
            out = rows if out is None else out.unionByName(rows)
    return out


# ---------------------------------------------------------------- versions and comparison


@query
def republish(spark, sf):
    """What readers get before, after a failed attempt, and after the next version."""
    points = fixtures.points(spark, sf)
    root = fresh_path(spark, "versions")

    def read(stage: str) -> DataFrame:
        rows = read_geo(spark, f"{root}/grid/files/grid_points_geo.parquet")
        return rows.agg(F.count("*").alias("rows"), F.sum("fid").alias("total")).select(F.lit(stage).alias("stage"), "rows", "total")

    formats = ["geoparquet"]
    publish.republish(points, root, "grid", "points", formats)
    first = read("first")
    last = points.agg(F.max("fid")).scalar()
    fid = F.when(F.col("fid") == last, F.raise_error(F.lit("lost")).cast("bigint")).otherwise(F.col("fid"))
    try:
        publish.republish(points.withColumn("fid", fid), root, "grid", "points", formats)
        failed = "did not fail"
    except Exception:
        failed = "after a failure"
    after = read(failed)
    publish.republish(points.withColumn("fid", -F.col("fid")), root, "grid", "points", formats)
    return first.unionByName(after).unionByName(read("second"))


@query
def order_difference(spark, sf):
    """Rows that changed places between two ordered tables."""
    ranked = ordering.with_rank(fixtures.points(spark, sf).select("fid"), ["fid"], name="place")
    step = F.when(F.col("place") % SWAP_EVERY == 17, 1).when(F.col("place") % SWAP_EVERY == 18, -1).otherwise(0)
    paths = []
    for df in (ranked, ranked.withColumn("place", F.col("place") + step)):
        paths.append(fresh_path(spark, "ordered"))
        df.repartitionByRange("place").sortWithinPartitions("place").write.parquet(paths[-1])
    left, right = (spark.read.parquet(p) for p in paths)
    found = compare.order_difference(left, right, "place")
    return found.select("place", F.col("left.fid").alias("left_fid"), F.col("right.fid").alias("right_fid"))


@query
def wrapped_extent(spark, sf):
    """Bounds on the circle of longitudes: of regions with boxes across the antimeridian, and of every user's points."""
    edited = C.override_boxes(fixtures.regions(spark, sf), "name", fixtures.OVERRIDES)
    regions = extent.wrapped_extent(edited, ["region"]).withColumn("key", F.concat(F.lit("region "), "region"))
    users = extent.wrapped_extent(fixtures.user_points(spark, sf), ["user_id"]).withColumn("key", F.concat(F.lit("user "), "user_id"))
    columns = ["key", "xmin", "ymin", "xmax", "ymax"]
    return regions.select(*columns).unionByName(users.select(*columns))


# ---------------------------------------------------------------- JSON


def _features(spark, sf) -> DataFrame:
    """fid and feature text of every footprint, with brackets, quotes and escapes in its properties."""
    shapes = C.with_coord_layout(fixtures.footprints(spark, sf), "interleaved")
    names = fixtures.table(spark, sf, "part").select(F.col("p_partkey").alias("fid"), fixtures.awkward_note().alias("note"))
    body = F.struct(F.lit("Polygon").alias("type"), F.col(GEOMETRY).alias("coordinates"))
    feature = F.struct(F.lit("Feature").alias("type"), F.struct("fid", "note").alias("properties"), body.alias("geometry"))
    # Notes are far larger than the files they are made from suggest: no side is one to broadcast.
    return shapes.join(names.hint("merge"), "fid").select("fid", F.to_json(feature).alias("feature"))


@query
def json_ranges(spark, sf):
    """Features of large collections, each document read by many tasks."""
    path = fresh_path(spark, "collections")
    dealt = _features(spark, sf).repartitionById(DOCUMENTS, (F.col("fid") % DOCUMENTS).cast("int"))
    fixtures.write_collections(dealt, path)
    ranges = byte_ranges(spark, sized(path, ("json",)), DOCUMENT_RANGE)
    # One row per document, sent to every task: joined by a shuffle, a document's features would meet in one task.
    split = F.broadcast(ranges.groupBy("path").agg((F.max("number") > 0).alias("split")))
    rows = geojson.feature_rows(spark, path, range_bytes=DOCUMENT_RANGE).join(split, "path")
    read = geojson.judged(rows.select("path", "at", "feature"))
    told = read.select(
        "path",
        F.get_json_object("properties", "$.fid").cast("bigint").alias("fid"),
        F.get_json_object("properties", "$.note").alias("note"),
        F.col(f"{GEOMETRY}")[0][2]["x"].alias("x"),
        F.col(f"{GEOMETRY}")[0][2]["y"].alias("y"),
        "cause",
    )
    return told.join(split, "path").select("fid", "note", "x", "y", "cause")


@query
def damaged_features(spark, sf):
    """Features and the damaged records among them, by cause."""
    path = fresh_path(spark, "damaged") + ".geojsonl"
    fid, whole = F.col("fid"), F.col("feature")
    broken = (
        F.when(fid % 13 == 4, F.substring(whole, 1, 60))
        .when(fid % 17 == 5, F.replace(whole, F.lit('"Feature"'), F.lit('"Thing"')))
        .when(fid % 19 == 6, F.replace(whole, F.lit('"Polygon"'), F.lit('"Point"')))
        .when(fid % 23 == 7, F.regexp_replace(whole, r"(\d)\]", "$1,7]"))
        .when(fid % 29 == 8, F.regexp_replace(whole, r"\[(-?\d+\.)", r'["a",$1'))
        .otherwise(whole)
    )
    _features(spark, sf).select(broken.alias("value")).write.text(path)
    good, bad, counts = geojson.split_geojson(spark, path)
    kept = good.agg(F.count("*").alias("records")).select(F.lit("none").alias("cause"), "records", F.lit(counts["features"]).alias("observed"))
    told = bad.groupBy("cause").agg(F.count_distinct("path", "at").alias("records"))
    return kept.unionByName(told.withColumn("observed", F.lit(None).cast("bigint")))


# ---------------------------------------------------------------- checks of files


@query
def asset_checks(spark, sf):
    """Whole, truncated, empty and misnamed files of every format, checked by one scan."""
    points = fixtures.points(spark, sf)
    root = fresh_path(spark, "assets")
    formats = [f for f in publish.FORMS if f not in ("arrows/box", "parquet")]
    paths = publish.publish(points, root, "grid", "points", formats)
    assets = fixtures.damaged_copies(spark, dict(zip(formats, paths)), fresh_path(spark, "damaged-assets"))
    found = validate.check_assets(spark, assets.select("path", "format"))
    told = assets.join(found, found["subject"] == assets["path"], "left")
    return told.groupBy("format", "damage").agg(F.array_join(F.array_sort(F.collect_set("rule")), ", ").alias("rules"))


#: What is wrong with each of the files that ``bad_footers`` writes, by its number.
FOOTER_FAULTS = ["", "geo footer", "primary column", "single column", "encoding", "geometry types", "crs", "geometry not last", "wkb is binary"]


def _faulty_file(number: int, fids: list[int]) -> bytes:
    fault = FOOTER_FAULTS[number]
    geometry = pa.array([f"POINT ({i} 0)" for i in fids], pa.string())
    if fault != "wkb is binary":
        geometry = geometry.cast(pa.binary())
    columns = {"fid": pa.array(fids, pa.int64()), GEOMETRY: geometry}
    if fault == "geometry not last":
        columns = dict(reversed(columns.items()))
    column = {"encoding": "WKB", "geometry_types": [], "crs": 4326 if fault == "crs" else None}
    for rule, key in (("encoding", "encoding"), ("geometry types", "geometry_types")):
        if fault == rule:
            del column[key]
    geo = {"version": "1.0.0", "primary_column": "shape" if fault == "primary column" else GEOMETRY, "columns": {GEOMETRY: column}}
    if fault == "single column":
        geo["columns"]["other"] = column
    table = pa.table(columns)
    if fault != "geo footer":
        table = table.replace_schema_metadata({"geo": json.dumps(geo)})
    out = io.BytesIO()
    pq.write_table(table, out)
    return out.getvalue()


@query
def bad_footers(spark, sf):
    """A file for each nation, whose footer is wrong in a known way, under both forms of the check."""
    path = fresh_path(spark, "footers")
    parts = fixtures.table(spark, sf, "nation").select((F.col("n_nationkey") % len(FOOTER_FAULTS)).alias("fault"), "n_nationkey")

    def write(batches):
        for batch in batches:
            names = []
            for row in batch.to_pylist():
                files, place = open_fs(path)
                files.create_dir(place, recursive=True)
                names.append(f"fault-{row['fault']}-nation-{row['n_nationkey']}.parquet")
                with files.open_output_stream(f"{place}/{names[-1]}") as out:
                    out.write(_faulty_file(row["fault"], [row["n_nationkey"]]))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string())], ["name"])

    parts.mapInArrow(write, "name string").count()
    # Checked by expressions over the footers, and by the scan for assets of any format.
    by_table = validate.check_geo_files(spark, path, "geoparquet")
    by_scan = validate.check_assets(spark, [(path, "geoparquet")])
    out = None
    for form, found in (("footers", by_table), ("assets", by_scan)):
        nation = F.regexp_extract("subject", r"nation-(\d+)\.parquet$", 1).cast("int")
        told = found.select(F.lit(form).alias("form"), nation.alias("n_nationkey"), "rule")
        out = told if out is None else out.unionByName(told)
    return out


@query
def stream_checks(spark, sf):
    """Stream files with faulty fields, one for each nation."""
    path = fresh_path(spark, "streams")
    faults = ["", "extension name", "extension metadata", "geometry not last", "geometry missing", "wkb is binary"]

    def write(batches):
        for batch in batches:
            names = []
            for row in batch.to_pylist():
                fault = faults[row["n_nationkey"] % len(faults)]
                kind = pa.string() if fault == "wkb is binary" else pa.binary()
                metadata = {EXTENSION_NAME: b"other.wkb" if fault == "extension name" else b"geometry.wkb"}
                metadata[EXTENSION_METADATA] = b"[" if fault == "extension metadata" else b"{}"
                fields = [pa.field("fid", pa.int64()), pa.field("shape" if fault == "geometry missing" else GEOMETRY, kind, True, metadata)]
                arrays = [pa.array([row["n_nationkey"]], pa.int64()), pa.array([b"x"], kind)]
                if fault == "geometry not last":
                    fields, arrays = fields[::-1], arrays[::-1]
                files, place = open_fs(path)
                files.create_dir(place, recursive=True)
                names.append(f"nation-{row['n_nationkey']}.arrows")
                schema = pa.schema(fields)
                with files.open_output_stream(f"{place}/{names[-1]}") as raw, pa.ipc.new_stream(raw, schema) as out:
                    out.write_batch(pa.RecordBatch.from_arrays(arrays, schema=schema))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string())], ["name"])

    fixtures.table(spark, sf, "nation").select("n_nationkey").mapInArrow(write, "name string").count()
    found = validate.check_streams(spark, path, "arrows/wkb")
    return found.select(F.regexp_extract("subject", r"nation-(\d+)\.arrows$", 1).cast("int").alias("n_nationkey"), "rule")


# ---------------------------------------------------------------- catalog


@query
def manifest_object(spark, sf):
    """The asset list published as one object and read back with the places of its groups and files."""
    path = fresh_path(spark, "object")
    # The test manifests hold a name each; in their group's object it stands where its part does.
    placed = _ordered_assets(spark, sf).withColumn("file_pos", F.expr("cast(ordinal div 16 as int)"))
    catalog.write_manifest_json(placed, path, fixtures.REF)
    back = catalog.read_manifest_json(spark, path)
    return back.select("ref", "group", "name", "format", "url", F.col("group_pos").alias("group_pos"))


@query
def manifest_texts(spark, sf):
    """Manifests written as JSON texts, half of them without a location, and expanded again."""
    path = fresh_path(spark, "manifests")
    told = fixtures.manifests(spark, sf)
    location = F.when(F.col("p_partkey") % 2 == 0, F.col("file_location"))
    value = F.to_json(F.struct("group", location.alias("file_location"), "format", "files"))
    told.select(value.alias("value")).write.text(path)
    files = catalog.expand_manifests(catalog.read_manifest_texts(spark.read.text(path)))
    return files.select("group", "file_location", "name", "format")


@query
def unnested_manifest(spark, sf):
    """Nested asset lists, an object for each group and name, as flat rows."""
    files = F.collect_list(F.struct("name", "format", "url")).alias("files")
    named = _assets(spark, sf).groupBy("group", "name").agg(files)
    doc = named.select(F.lit(fixtures.REF).alias("ref"), F.array(F.struct(F.col("group").alias("name"), "files")).alias("groups"))
    return catalog.unnest_manifest(doc)


@query
def asset_files(spark, sf):
    """Names and sizes of the files below the groups' folders, hidden ones left out."""
    root = fresh_path(spark, "listing")
    rows = _ordered_assets(spark, sf).select("group", F.lit("x").alias("files"), "path")
    rows.write.partitionBy("group", "files").text(root)
    found = catalog.list_assets(spark, root, "files=x")
    group = F.regexp_extract("path", r"/group=([^/]+)/", 1)
    return found.groupBy(group.alias("group")).agg(F.sum("length").alias("bytes"))


# ---------------------------------------------------------------- lists and columns


@query
def merged_lists(spark, sf):
    """Named lists of a table merged with later ones, and two of them put end to end."""
    nation = fixtures.table(spark, sf, "nation")

    def lists(rows: DataFrame, prefix: str) -> DataFrame:
        item = F.when(F.col("n_nationkey") % 3 > 0, F.concat(F.lit(f"{prefix} "), "n_nationkey"))
        items = F.array_sort(F.collect_list(F.struct("n_nationkey", item.alias("wkt")))).alias("items")
        named = rows.groupBy(F.concat(F.lit("list-"), "n_regionkey").alias("name")).agg(items)
        return text.wkt_lists(spark, named.select("name", F.transform("items", lambda i: i["wkt"]).alias("items")))

    merged = text.merge_lists(lists(nation, "first"), lists(nation.filter("n_regionkey >= 3"), "later"))
    return merged.unionByName(text.concat_lists(merged, ["list-4", "list-1"], "both"))


@query
def paired_lists(spark, sf):
    """Two lists of each region side by side."""
    nation = fixtures.table(spark, sf, "nation")
    both = F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name")))
    regions = nation.groupBy("n_regionkey").agg(both.alias("both"))
    regions = regions.select("n_regionkey", F.col("both.n_nationkey").alias("key"), F.col("both.n_name").alias("label"))
    return C.pair_lists(regions, "key", "label")


@query
def text_beside(spark, sf):
    """Texts beside their encoding, and where the geometry stands among the columns."""
    pair = C.with_encoding(C.as_encoding(fixtures.points(spark, sf), "wkt"), "wkb")
    moved = C.geometry_last(pair.select(GEOMETRY, "wkt"))
    return moved.select("wkt", F.hex(GEOMETRY).alias("wkb"), F.lit(",".join(moved.columns)).alias("columns"))


@query
def first_on_curve(spark, sf):
    """The first row of a layer in the order of the curve."""
    return ordering.first_row(ordering.hilbert_order(fixtures.points(spark, sf), ["fid"])).select("fid", "hilbert_key")
