import json
import zipfile

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyarrow import ipc
from pyspark.sql import functions as F

from terrafold.functions.crs import PROJJSON, WKT2_CRS84
from terrafold.functions.types import DIMENSIONS, GeometryTag, geometry_tag
from terrafold.operators import columns as C
from terrafold.operators import compare, ordering
from terrafold.plans import fixtures, publish, validate
from terrafold.sources import text
from terrafold.sources.arrow_stream import read_arrow, write_arrow
from terrafold.sources.geojson import feature_texts, read_geojson
from terrafold.operators.extent import extent_box
from terrafold.sources.parquet import extent_of_files, footers, read_footer, read_geo, write_geo
from terrafold.sources.shared import fresh_path, list_files, path_exists, shared_dir

from .samples import COLLECTIONS, POLYGON_ZM, WKT


def table(spark, texts, kind=None, dims=None, **tag):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "fid int, geometry string")
    return C.declare(df.repartition(2), GeometryTag("wkt", kind, dims, **tag))


# ---------------------------------------------------------------- text


def test_lines_keep_nulls_and_order(spark, tmp_path):
    path = f"{tmp_path}/point.tsv"
    df = table(spark, WKT["point"], "point", "xy")
    text.write_wkt_tsv(df, path, order=["fid"], files=1)
    (file, _), = [f for f in list_files(path, (".txt",))]
    assert open(file).read() == "geometry\nPOINT (3 -7)\nPOINT (12 5)\n\nPOINT EMPTY\n"
    back = text.read_wkt_tsv(spark, path, "point", "xy", keep_order=True)
    assert [r.geometry for r in back.orderBy("line_order").collect()] == WKT["point"]
    assert validate.check_lines(spark, path).isEmpty()


def test_only_the_first_line_is_a_header(spark, tmp_path):
    (tmp_path / "odd").mkdir()
    for name, body in (("a", "geometry\nPOINT (1 2)\ngeometry\n"), ("b", "geometry\n\nPOINT (3 4)\n")):
        (tmp_path / "odd" / f"{name}.txt").write_text(body)
    found = [r.geometry for r in text.read_wkt_tsv(spark, f"{tmp_path}/odd").collect()]
    assert sorted(map(str, found)) == ["None", "POINT (1 2)", "POINT (3 4)", "geometry"]
    assert [r.rule for r in validate.check_lines(spark, f"{tmp_path}/odd").collect()] == ["line tag"]


def test_empty_tables_and_empty_files(spark, tmp_path):
    path = f"{tmp_path}/none.tsv"
    text.write_wkt_tsv(table(spark, WKT["point"], "point", "xy").limit(0), path)
    assert text.read_wkt_tsv(spark, path).count() == 0
    assert "".join(open(f).read() for f, _ in list_files(path, (".txt",))) == "geometry\n"
    (tmp_path / "zero").mkdir()
    (tmp_path / "zero" / "x.tsv").write_text("")
    assert {r.rule for r in validate.check_lines(spark, f"{tmp_path}/zero").collect()} == {"header", "no rows"}


def test_layers_are_published_again(spark, tmp_path):
    first, second = (table(spark, [f"POINT ({i} {k})" for i in range(n)], "point", "xy").select("geometry") for n, k in ((5, 1), (3, 2)))
    formats = [f for f in publish.FORMS if f != "arrows/box"]
    options = {"root": str(tmp_path), "group": "g", "name": "n", "formats": formats}
    paths = publish.publish(first, **options)
    assert publish.publish(second, **options) == []
    assert publish.publish(second, **options, lazy=False) == paths
    for fmt, path in zip(formats, paths):
        back = text.read_wkt_tsv(spark, path) if fmt == "tsv" else read_arrow(spark, path) if fmt.startswith("arrows") else read_geo(spark, path)
        assert back.count() == 3, fmt
    assert len(list((tmp_path / "g" / "files").iterdir())) == len(formats)
    with pytest.raises(ValueError, match="No sink writes format shp, fgb"):
        publish.publish(second, str(tmp_path), "g", "n", ["shp", "fgb", "arrows/wkt"])


def test_damaged_streams_and_archives_are_violations(spark, tmp_path):
    good = f"{tmp_path}/good"
    write_arrow(C.as_encoding(table(spark, WKT["point"], "point", "xy"), "wkb").select("geometry").coalesce(1), good)
    (file, _), = list_files(good, (".arrows",))
    data = open(file, "rb").read()
    (tmp_path / "bad").mkdir()
    for name, body in (("cut", data[: len(data) // 2]), ("empty", b""), ("whole", data)):
        (tmp_path / "bad" / f"{name}.arrows").write_bytes(body)
    found = validate.check_streams(spark, f"{tmp_path}/bad", "arrows/wkb").collect()
    assert {r.subject.rsplit("/", 1)[-1] for r in found} == {"cut.arrows", "empty.arrows"}
    (tmp_path / "zips").mkdir()
    with zipfile.ZipFile(tmp_path / "zips" / "none.fgb.zip", "w"):
        pass
    (tmp_path / "zips" / "cut.fgb.zip").write_bytes(b"PK")
    heads = validate.check_magic(spark, f"{tmp_path}/zips").collect()
    assert {r.subject.rsplit("/", 1)[-1] for r in heads} == {"none.fgb.zip", "cut.fgb.zip"}


def test_every_part_file_has_a_header(spark, tmp_path):
    path = f"{tmp_path}/many.tsv"
    rows = [f"POINT ({i} 0)" for i in range(200)]
    text.write_wkt_tsv(table(spark, rows), path, order=["fid"], files=4)
    files = list_files(path, (".txt",))
    assert len(files) == 4
    assert all(open(f).readline() == "geometry\n" for f, _ in files)
    back = text.read_wkt_tsv(spark, path, keep_order=True).orderBy("line_order")
    assert [r.geometry for r in back.collect()] == rows


def test_lines_split_inside_a_file_sort_as_they_stand(spark, tmp_path):
    path = f"{tmp_path}/long.tsv"
    rows = [f"POINT ({i} {i * 7 % 1000})" for i in range(20000)]
    open(path, "w").write("geometry\n" + "".join(r + "\n" for r in rows))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        lines = text.read_wkt_tsv(spark, path, keep_order=True)
        assert lines.rdd.getNumPartitions() > 4
        assert [r.geometry for r in lines.orderBy("line_order").collect()] == rows
        assert validate.check_lines(spark, path).isEmpty()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_bad_lines_are_found(spark, tmp_path):
    path = tmp_path / "bad.tsv"
    path.write_text("geom\nPOINT (1 2)\npoint (3 4)\n")
    rules = {r.rule for r in validate.check_lines(spark, str(path)).collect()}
    assert rules == {"header", "line tag"}
    path.write_text("geometry\n")
    assert [r.rule for r in validate.check_lines(spark, str(path)).collect()] == ["no rows"]


def test_delimited_column_takes_its_place(spark, tmp_path):
    path = tmp_path / "countries.tsv"
    path.write_text("name\tgeog\tcontinent\nFiji\tPOINT (1 2)\tOceania\n")
    df = text.read_delimited_wkt(spark, str(path), "geog", "point", "xy")
    assert df.columns == ["name", "geometry", "continent"]
    assert C.as_encoding(df, "native").first().geometry.x == 1.0


def test_named_lists_merge_and_concatenate(spark):
    first = text.wkt_lists(spark, {"a": ["POINT (1 2)", None], "b": ["POINT EMPTY"]})
    merged = text.merge_lists(first, text.wkt_lists(spark, {"a": ["POINT (9 9)"]}))
    assert sorted((r.name, r.pos, r.wkt) for r in merged.collect()) == [
        ("a", 0, "POINT (9 9)"), ("b", 0, "POINT EMPTY"),
    ]
    joined = text.concat_lists(first, ["b", "a"], "both").orderBy("pos").collect()
    assert [(r.name, r.pos, r.wkt) for r in joined] == [
        ("both", 0, "POINT EMPTY"), ("both", 1, "POINT (1 2)"), ("both", 2, None),
    ]


# ---------------------------------------------------------------- GeoJSON

SQUARE = [[[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]]


def collection(n):
    rows = [
        {"type": "Feature", "properties": {"i": i, "note": 'a ] } , "x"'}, "geometry": {"type": "Polygon", "coordinates": SQUARE}}
        for i in range(n)
    ]
    return {"type": "FeatureCollection", "name": "features", "features": rows}


def test_collections_and_archives(spark, tmp_path):
    (tmp_path / "a.geojson").write_text(json.dumps(collection(5), indent=1))
    with zipfile.ZipFile(tmp_path / "b.geojson.zip", "w") as archive:
        archive.writestr("b.geojson", json.dumps(collection(7)))
    (tmp_path / "c.geojson").write_text(json.dumps(collection(0)))
    df = read_geojson(spark, str(tmp_path))
    assert df.count() == 12
    row = C.centroid(df).first()
    assert (row.geometry.x, row.geometry.y) == (1.0, 1.0)
    assert json.loads(row.properties)["note"] == 'a ] } , "x"'
    layer = publish.point_layer(spark, [f"{tmp_path}/a.geojson", f"{tmp_path}/b.geojson.zip"])
    assert [r.geometry.x for r in layer.collect()] == [1.0] * 12
    assert geometry_tag(layer).kind == "point"


def test_features_in_small_chunks():
    class Trickle:
        def __init__(self, data):
            self.data = data

        def read(self, n):
            out, self.data = self.data[:7], self.data[7:]
            return out

    raw = json.dumps(collection(4)).replace("note", "é").encode()
    assert [json.loads(t)["properties"]["i"] for t in feature_texts(Trickle(raw))] == [0, 1, 2, 3]
    with pytest.raises(ValueError, match="ends before"):
        list(feature_texts(Trickle(raw[:-10])))


def test_other_types_are_refused(spark, tmp_path):
    doc = collection(1)
    doc["features"][0]["geometry"] = {"type": "Point", "coordinates": [1, 2]}
    (tmp_path / "p.geojson").write_text(json.dumps(doc))
    with pytest.raises(Exception, match="Not a Polygon"):
        read_geojson(spark, str(tmp_path)).collect()


# ---------------------------------------------------------------- streams and Parquet


@pytest.mark.parametrize("fmt", [f for f in publish.FORMS if f not in ("tsv", "arrows/box")])
@pytest.mark.parametrize("kind", WKT)
def test_roundtrip_of_every_format(spark, kind, fmt):
    df = table(spark, WKT[kind], kind, "xy", crs="OGC:CRS84", crs_type="authority_code")
    assert publish.same_after(df, fmt)


@pytest.mark.parametrize("fmt", ["arrows", "arrows/interleaved", "geoparquet/native", "geoparquet"])
def test_roundtrip_with_z_and_m(spark, fmt):
    assert publish.same_after(table(spark, POLYGON_ZM, "polygon", "xyzm"), fmt)


def test_collections_roundtrip(spark):
    for fmt in ("arrows/wkb", "arrows/wkt", "geoparquet"):
        assert publish.same_after(table(spark, COLLECTIONS), fmt)


def test_stream_files_as_other_readers_see_them(spark, tmp_path):
    points = fixtures.points(spark, "/root/testdata/sf0.001")
    for fmt, kind in {
        "arrows/interleaved": "fixed_size_list<xy: double not null>[2]",
        "arrows": "struct<x: double, y: double>",
        "arrows/box": "struct<xmin: double not null, ymin: double not null, xmax: double not null, ymax: double not null>",
        "arrows/wkb": "binary",
        "arrows/wkt": "string",
    }.items():
        path = f"{tmp_path}/{fmt.replace('/', '-')}"
        encoding, layout = publish.FORMS[fmt]
        write_arrow(C.as_encoding(points, encoding, layout), path, batch_rows=300, extension_prefix="ext")
        schemas, rows = set(), 0
        for file, _ in list_files(path, (".arrows",)):
            with ipc.open_stream(file) as reader:
                schema = reader.schema
                for batch in reader:
                    assert batch.num_rows <= 300
                    rows += batch.num_rows
            schemas.add(str(schema.field("geometry").type))
            metadata = schema.field("geometry").metadata
            assert metadata[b"ARROW:extension:name"].startswith(b"ext.")
            assert json.loads(metadata[b"ARROW:extension:metadata"]) == {"crs": "OGC:CRS84", "crs_type": "authority_code"}
        assert schemas == {kind} and rows == 1000
        assert validate.check_file(spark, path, fmt, prefix="ext").isEmpty()
        wrong = validate.check_file(spark, path, fmt, prefix="other").collect()
        assert {r.rule for r in wrong} == {"extension name"}


def test_footer_describes_the_file(spark, tmp_path):
    path = f"{tmp_path}/solid"
    df = table(spark, POLYGON_ZM, "polygon", "xyzm", crs="EPSG:32618", crs_type="authority_code").coalesce(1)
    write_geo(df.select("geometry", "fid"), path, "native", row_group_rows=2)
    (file, _), = list_files(path, (".parquet",))
    geo, schema = read_footer(file)
    column = geo["columns"]["geometry"]
    assert schema.names == ["fid", "geometry"] and geo["primary_column"] == "geometry"
    assert column["encoding"] == "polygon" and column["geometry_types"] == ["Polygon ZM"]
    assert column["bbox"] == [-10.0, -10.0, -20.0, 14.0, 12.0, 26.0]
    assert column["crs"] == PROJJSON["EPSG:32618"]
    assert pq.ParquetFile(file).metadata.num_row_groups == 2
    assert validate.check_geo_files(spark, path, "geoparquet/native").isEmpty()
    assert {r.rule for r in validate.check_geo_files(spark, path, "geoparquet").collect()} == {"wkb is binary"}


def test_footer_of_mixed_wkb_and_of_spherical_edges(spark, tmp_path):
    path = f"{tmp_path}/mixed"
    write_geo(table(spark, COLLECTIONS).coalesce(1), path)
    geo, _ = read_footer(list_files(path, (".parquet",))[0][0])
    column = geo["columns"]["geometry"]
    assert column["geometry_types"] == ["GeometryCollection", "GeometryCollection ZM"]
    assert column["bbox"] == [0.0, -7.0, 9.0, 11.0] and column["crs"] is None
    path = f"{tmp_path}/sphere"
    write_geo(C.with_edges(table(spark, WKT["polygon"], "polygon", "xy"), "spherical"), path)
    geo, _ = read_footer(list_files(path, (".parquet",))[0][0])
    assert geo["columns"]["geometry"]["edges"] == "spherical" and "bbox" not in geo["columns"]["geometry"]
    assert geometry_tag(read_geo(spark, path)).edges == "spherical"


def test_a_footer_takes_projjson_only(spark, tmp_path):
    df = C.with_crs(table(spark, WKT["point"], "point", "xy"), WKT2_CRS84, "wkt2")
    with pytest.raises(Exception, match="PROJJSON"):
        write_geo(df, f"{tmp_path}/wkt2")
    write_arrow(C.as_encoding(df, "wkb"), f"{tmp_path}/stream")
    assert geometry_tag(read_arrow(spark, f"{tmp_path}/stream")).crs_type == "wkt2"


def test_foreign_files_are_described_by_their_footer(spark, tmp_path):
    geo = {"version": "1.1.0", "primary_column": "geometry",
           "columns": {"geometry": {"encoding": "point", "geometry_types": ["Point Z"], "crs": None}}}
    kind = pa.struct([("x", pa.float64()), ("y", pa.float64()), ("z", pa.float64())])
    rows = pa.table({"geometry": pa.array([{"x": 1.0, "y": 2.0, "z": 3.0}], kind)})
    pq.write_table(rows.replace_schema_metadata({"geo": json.dumps(geo)}), f"{tmp_path}/f.parquet")
    df = read_geo(spark, f"{tmp_path}/*.parquet")
    assert geometry_tag(df) == GeometryTag("native", "point", "xyz")
    geo["columns"]["geometry"] = {"encoding": "WKB", "geometry_types": []}
    rows = pa.table({"geometry": pa.array([b"\x01\x01\x00\x00\x00" + bytes(16)], pa.binary())})
    pq.write_table(rows.replace_schema_metadata({"geo": json.dumps(geo)}), f"{tmp_path}/g.parquet")
    df = read_geo(spark, f"{tmp_path}/g.parquet")
    assert geometry_tag(df) == GeometryTag("wkb", None, None, crs="OGC:CRS84", crs_type="authority_code")


def test_order_is_kept_through_files(spark, tmp_path):
    path = f"{tmp_path}/ordered"
    laid = ordering.cluster(fixtures.points(spark, "/root/testdata/sf0.001"), ["fid"], partitions=3)
    write_geo(laid, path, "native", row_group_rows=100)
    back = read_geo(spark, path, keep_order=True).orderBy("file_name", "row_index")
    want = ordering.hilbert_order(fixtures.points(spark, "/root/testdata/sf0.001"), ["fid"])
    assert [r.fid for r in back.collect()] == [r.fid for r in want.collect()]
    # Coordinates are plain columns of the file, so a window prunes row groups.
    plan = read_geo(spark, path).filter("geometry.x > 170")._jdf.queryExecution().toString()
    assert "GreaterThan(geometry.x,170.0)" in plan
    stream = f"{tmp_path}/stream"
    write_arrow(laid, stream)
    rows = read_arrow(spark, stream, row_index=True).orderBy("file_name", "row_index")
    assert [r.fid for r in rows.collect()] == [r.fid for r in want.collect()]


def test_unfinished_writes_leave_nothing(spark, tmp_path):
    path = f"{tmp_path}/failed"
    df = spark.range(0, 100, 1, 4).select(
        F.when(F.col("id") == 99, F.raise_error(F.lit("stop"))).otherwise(F.lit("POINT (1 2)")).alias("geometry")
    )
    df = C.declare(df, GeometryTag("wkt", "point", "xy"))
    with pytest.raises(Exception, match="stop"):
        write_arrow(df, path)
    assert list_files(path, (".arrows",)) == [] and not path_exists(f"{path}/_SUCCESS")
    good = table(spark, WKT["point"], "point", "xy")
    write_arrow(good, path)
    write_arrow(good, path, overwrite=True)
    assert read_arrow(spark, path).count() == 4


def test_shared_folder_is_the_one_the_session_names(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert fresh_path(spark, "a") != fresh_path(spark, "a")


# ---------------------------------------------------------------- publication


def test_layer_in_every_format(spark, tmp_path):
    points = fixtures.points(spark, "/root/testdata/sf0.001")
    formats = [f for f in publish.FORMS if f != "arrows/box"]
    written = publish.publish_layer(points, str(tmp_path), "grid", "points", formats, ["fid"], partitions=2)
    assert len(written) == len(formats)
    assert publish.publish_layer(points, str(tmp_path), "grid", "points", formats, ["fid"]) == []
    order = [r.fid for r in ordering.hilbert_order(points, ["fid"]).collect()]
    for path, fmt in zip(written, formats):
        assert validate.check_file(spark, path, fmt).isEmpty(), fmt
        if fmt.startswith("geoparquet"):
            rows = read_geo(spark, path, keep_order=True).orderBy("file_name", "row_index").collect()
            assert [r.fid for r in rows] == order
    sizes = spark.createDataFrame(list_files(str(tmp_path), ("",)), "path string, length bigint")
    assert validate.check_sizes(sizes).isEmpty()


def test_example_grid(spark, tmp_path):
    extra = {f"geometry{s}": [t] for s, t in zip(("", "-z", "-m", "-zm"), ("POINT (1 2)", "POINT Z (1 2 3)", "POINT M (1 2 2)", None))}
    lists = publish.example_lists(spark, dict(WKT), extra)
    mixed = lists.filter("name = 'geometry-mixed-dimensions'").orderBy("pos").collect()
    assert [r.wkt for r in mixed] == ["POINT (1 2)", "POINT Z (1 2 3)", "POINT M (1 2 2)", None]
    formats = ["tsv", "arrows", "arrows/wkb", "geoparquet", "geoparquet/native"]
    paths = publish.publish_example(lists, str(tmp_path), "example", "polygon", formats)
    for path, fmt in zip(paths, formats):
        assert validate.check_file(spark, path, fmt).isEmpty(), fmt
    both = read_arrow(spark, paths[1], row_index=True).orderBy("file_name", "row_index").collect()
    assert [r.wkt for r in both] == WKT["polygon"]
    with pytest.raises(ValueError, match="no native form for arrows, geoparquet/native"):
        publish.publish_example(lists, str(tmp_path), "example", "geometry-mixed-dimensions", formats)
    skip = ("arrows", "geoparquet/native")
    mixed = publish.publish_example(lists, str(tmp_path), "example", "geometry-mixed-dimensions", formats, skip)
    assert len(mixed) == 3
    # Published again, every format holds the new rows only.
    again = publish.publish_example(lists, str(tmp_path), "example", "polygon", formats)
    assert again == paths and read_arrow(spark, paths[1]).count() == len(WKT["polygon"])
    assert publish.kind_of_list("polygon-zm") == ("polygon", "xyzm")
    assert publish.kind_of_list("geometrycollection-z") == (None, None)
    assert all(publish.kind_of_list(f"point-{d[2:]}" if d != "xy" else "point")[1] == d for d in DIMENSIONS)


def test_conversion_keeps_batches_and_counts_checks(spark, tmp_path):
    src, dst = f"{tmp_path}/src", f"{tmp_path}/dst"
    df = C.as_encoding(fixtures.points(spark, "/root/testdata/sf0.001"), "wkb")
    write_arrow(df, src)
    results = publish.convert_all(spark, [publish.Conversion("points", src, dst)])
    assert compare.require_all_passed(results, "ok").first().passed == 1
    assert footers(spark, dst).filter("geo is null").isEmpty()
    publish.convert_table(spark, src, f"{tmp_path}/plain", geo_metadata=False)
    assert footers(spark, f"{tmp_path}/plain").filter("geo is not null").isEmpty()
    other = f"{tmp_path}/other"
    write_geo(df.filter("fid <> 5"), other)
    assert not publish.conversion_matches(spark, src, other)


def test_pairs_by_position(spark, tmp_path):
    df = C.as_encoding(fixtures.points(spark, "/root/testdata/sf0.001"), "wkb").coalesce(1)
    for name in ("a", "b"):
        write_geo(df, f"{tmp_path}/{name}")
    left, right = (read_geo(spark, f"{tmp_path}/{n}", keep_order=True).drop("file_name") for n in "ab")
    assert compare.pair_by_position(left, right, "row_index").filter("not equal").isEmpty()
    shifted = right.filter("row_index < 999")
    unequal = compare.pair_by_position(left, shifted, "row_index").filter("not equal")
    assert [r.row_index for r in unequal.collect()] == [999]


# ---------------------------------------------------------------- validation


def test_magic_plain_and_zipped(spark, tmp_path):
    magic = validate.FEATURE_MAGIC + b"rest"
    (tmp_path / "ok.fgb").write_bytes(magic)
    (tmp_path / "bad.fgb").write_bytes(b"nothing here")
    for name, members in (("ok.fgb.zip", ["ok.fgb"]), ("two.fgb.zip", ["two.fgb", "x"]), ("named.fgb.zip", ["other.fgb"])):
        with zipfile.ZipFile(tmp_path / name, "w") as archive:
            for m in members:
                archive.writestr(m, magic)
    found = {(r.subject.rpartition("/")[2], r.rule) for r in validate.check_file(spark, str(tmp_path), "fgb").collect()}
    assert found == {("bad.fgb", "magic"), ("two.fgb.zip", "archive members"), ("named.fgb.zip", "archive members")}


def test_broken_streams(spark, tmp_path):
    def put(name, schema, columns):
        with ipc.new_stream(f"{tmp_path}/{name}.arrows", schema) as writer:
            writer.write_table(pa.table(columns, schema=schema))

    named = {"ARROW:extension:name": "geometry.wkb", "ARROW:extension:metadata": "[]"}
    put("a", pa.schema([pa.field("geometry", pa.string(), metadata=named), ("fid", pa.int32())]), [["x"], [1]])
    put("b", pa.schema([("fid", pa.int32())]), [[1]])
    found = {(r.subject.rpartition("/")[2], r.rule) for r in validate.check_streams(spark, str(tmp_path), "arrows/wkb").collect()}
    assert found == {
        ("a.arrows", "geometry not last"), ("a.arrows", "extension metadata"),
        ("a.arrows", "wkb is binary"), ("b.arrows", "geometry missing"),
    }


def test_storage_rules():
    fixed = pa.list_(pa.field("xyz", pa.float64(), False), 3)
    assert validate.storage_problems(pa.list_(fixed), "arrows/interleaved") == []
    assert validate.storage_problems(pa.list_(pa.field("xyz", pa.float64()), 2), "arrows/interleaved")
    assert validate.storage_problems(pa.struct([("x", pa.float64()), ("y", pa.float32())]), "arrows")
    assert validate.storage_problems(pa.struct([("x", pa.float64()), ("z", pa.float64())]), "arrows")
    assert validate.storage_problems(pa.struct([(n, pa.float64()) for n in ("xmin", "ymin", "xmax", "ymax")]), "arrows/box")
    with pytest.raises(ValueError):
        validate.storage_problems(pa.int32(), "fgb")


def test_table_rules(spark):
    df = table(spark, WKT["point"], "point", "xy")
    assert validate.check_table(df) == []
    assert validate.check_table(df.select("geometry", "fid"))[0][0] == "geometry not last"
    assert validate.check_table(df.drop("geometry"))[0][0] == "geometry missing"
    lying = C.declare(df, GeometryTag("wkb"))
    assert validate.check_table(lying)[0][0] == "storage type"


def test_dispatch_over_assets(spark, tmp_path):
    (tmp_path / "x.tsv").write_text("geometry\nPOINT (1 2)\n")
    (tmp_path / "y.fgb").write_bytes(b"12345678")
    found = validate.check_assets(spark, [(f"{tmp_path}/x.tsv", "tsv"), (f"{tmp_path}/y.fgb", "fgb")]).collect()
    assert [r.rule for r in found] == ["magic"]
    with pytest.raises(ValueError, match="No check"):
        validate.check_file(spark, str(tmp_path), "shp")


def test_features_on_lines_of_their_own(spark, tmp_path):
    rows = collection(30)["features"]
    body = ",\n".join(json.dumps(r) for r in rows)
    (tmp_path / "lines.geojson").write_text('{"type": "FeatureCollection",\n"features": [\n' + body + "\n]}\n")
    df = read_geojson(spark, f"{tmp_path}/lines.geojson", feature_per_line=True)
    assert df.count() == 30 and df.filter("geometry is null").isEmpty()


def test_mixed_texts_by_type_and_one_by_one(spark):
    every = [t for kind in WKT for t in WKT[kind]] + COLLECTIONS + POLYGON_ZM + ["point z (1 2 3)", None]
    df = C.as_encoding(table(spark, every), "wkb")
    want = [None if t is None else t.replace("point z", "POINT Z") for t in every]
    assert [r.geometry for r in C.as_encoding(df, "wkt").orderBy("fid").collect()] == want


def test_the_sink_encodes_typed_columns(spark, tmp_path):
    df = fixtures.footprints(spark, "/root/testdata/sf0.001", courtyard=True)
    write_geo(df, f"{tmp_path}/sink", "wkb")
    write_geo(C.as_encoding(df, "wkb"), f"{tmp_path}/column", "wkb")
    a, b = read_geo(spark, f"{tmp_path}/sink"), read_geo(spark, f"{tmp_path}/column")
    assert compare.schemas_equal(a, b) and compare.tables_equal(a, b)
    geo = [read_footer(list_files(f"{tmp_path}/{n}", (".parquet",))[0][0])[0] for n in ("sink", "column")]
    assert geo[0] == geo[1] and geo[0]["columns"]["geometry"]["encoding"] == "WKB"


def test_extent_from_footers_is_the_extent(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    for name, df, encoding in (
        ("points", fixtures.points(spark, sf), "wkb"),
        ("tracks", fixtures.tracks(spark, sf).repartition(4), "native"),
        ("solid", C.set_dims(fixtures.points(spark, sf), z=lambda c: c["x"]), "native"),
    ):
        path = f"{tmp_path}/{name}"
        write_geo(df, path, encoding)
        stated = extent_of_files(spark, path)
        assert stated.collect() == extent_box(df).collect()
        keyed = ordering.hilbert_key(df, extent=stated.scalar())
        assert compare.tables_equal(keyed.drop("geometry"), ordering.hilbert_key(df).drop("geometry"))
    nothing = table(spark, [None, "POINT EMPTY"], "point", "xy").filter("fid = 0")
    write_geo(nothing, f"{tmp_path}/nothing")
    assert extent_of_files(spark, f"{tmp_path}/nothing").first().extent is None


def test_empty_partitions_and_tables(spark, tmp_path):
    sparse = fixtures.points(spark, "/root/testdata/sf0.001").repartition(4).filter("fid = 7")
    for fmt in ("arrows", "arrows/wkb", "arrows/box", "geoparquet", "geoparquet/native"):
        for name, df, rows in (("one", sparse, 1), ("none", sparse.filter("fid < 0"), 0)):
            path = f"{tmp_path}/{name}-{fmt.replace('/', '-')}"
            publish.write_format(df, fmt, path)
            back = read_arrow(spark, path) if fmt.startswith("arrows") else read_geo(spark, path)
            assert back.count() == rows and geometry_tag(back).encoding == publish.FORMS[fmt][0]


def test_attributes_pass_through(spark, tmp_path):
    df = fixtures.points(spark, "/root/testdata/sf0.001").select(
        "fid",
        F.timestamp_seconds("fid").alias("seen"),
        F.to_date(F.lit("2024-02-29")).alias("day"),
        F.array(F.col("fid").cast("string"), F.lit(None)).alias("words"),
        F.struct(F.lit(1.5).alias("a"), F.lit("b").alias("b")).alias("pair"),
        F.lit("12.34").cast("decimal(10,2)").alias("price"),
        "geometry",
    )
    spark.conf.set("spark.sql.session.timeZone", "America/Halifax")
    try:
        for fmt in ("arrows", "geoparquet"):
            assert publish.same_after(df, fmt)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
