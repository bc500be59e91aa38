import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from terrafold.functions import coords, projection
from terrafold.functions.batches import bounds_of, centroids_of
from terrafold.functions.types import BOX_TYPE, GeometryTag, geometry_tag
from terrafold.functions.wkb import arrow_storage
from terrafold.operators import columns as C
from terrafold.operators import compare, extent, ordering, vertices
from terrafold.plans import fixtures

from .samples import POLYGON_ZM, WKT


def native(spark, texts, kind, dims="xy", **tag):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "fid int, geometry string")
    return C.as_encoding(C.declare(df, GeometryTag("wkt", kind, dims, **tag)), "native")


# ---------------------------------------------------------------- measures


def slow_centroid(polygons):
    """Straight from the definition, one polygon list."""
    area = mx = my = 0.0
    for rings in polygons:
        for i, ring in enumerate(rings):
            a = x = y = 0.0
            for (px, py), (qx, qy) in zip(ring, ring[1:]):
                c = px * qy - qx * py
                a, x, y = a + c, x + (px + qx) * c, y + (py + qy) * c
            s = (-1 if a < 0 else 1) * (1 if i == 0 else -1)
            area, mx, my = area + s * a, mx + s * x, my + s * y
    return mx / (3 * area), my / (3 * area)


def test_centroids_against_the_definition():
    rng = random.Random(5)
    rows = []
    for _ in range(60):
        polygons = []
        for _ in range(rng.randint(1, 3)):
            x, y, w = rng.uniform(-100, 100), rng.uniform(-50, 50), rng.uniform(1, 4)
            shell = [(x, y), (x + w, y), (x + 2 * w, y + w), (x, y + w), (x, y)]
            hole = [(x + w / 8, y + w / 8), (x + w / 4, y + w / 8), (x + w / 4, y + w / 4), (x + w / 8, y + w / 8)]
            rings = [shell] + ([hole] if rng.random() < 0.5 else [])
            polygons.append([r[::-1] if rng.random() < 0.5 else r for r in rings])
        rows.append(polygons)
    as_dicts = [[[[dict(zip("xy", c)) for c in r] for r in p] for p in row] for row in rows]
    arr = pa.array([*as_dicts, None, []], arrow_storage("multipolygon", "xy"))
    out = centroids_of(arr, "multipolygon").to_pylist()
    for got, row in zip(out, rows):
        want = slow_centroid(row)
        assert got["x"] == pytest.approx(want[0], abs=1e-9)
        assert got["y"] == pytest.approx(want[1], abs=1e-9)
    assert out[-2] is None and math.isnan(out[-1]["x"])


def test_centroid_of_flat_null_and_empty(spark):
    df = native(spark, ["POLYGON ((0 0, 4 0, 8 0, 0 0))", *WKT["polygon"]], "polygon")
    rows = [r.geometry for r in C.centroid(df).orderBy("fid").collect()]
    assert (rows[0].x, rows[0].y) == (4.0, 0.0)
    assert rows[3] is None and math.isnan(rows[4].x)
    with pytest.raises(ValueError):
        C.centroid(native(spark, WKT["linestring"], "linestring"))


@pytest.mark.parametrize("kind", WKT)
def test_boxes_of_every_type_and_encoding(spark, kind):
    df = native(spark, WKT[kind], kind)
    as_rows = [r.box for r in df.select("fid", C.box_column(df).alias("box")).orderBy("fid").collect()]
    for encoding in ("wkb", "wkt"):
        other = C.as_encoding(df, encoding)
        again = other.select("fid", C.box_column(other).alias("box")).orderBy("fid").collect()
        assert [r.box for r in again] == as_rows
    numbers = [float(v) for v in WKT[kind][1].translate(str.maketrans("(),", "   ")).split()[1:]]
    assert tuple(as_rows[1]) == (min(numbers[::2]), min(numbers[1::2]), max(numbers[::2]), max(numbers[1::2]))
    assert as_rows[-2:] == [None, None]
    assert C.to_box(df).schema["geometry"].dataType == BOX_TYPE


def test_nan_members_do_not_bound():
    arr = pa.array([[{"x": 1.0, "y": 2.0}, {"x": math.nan, "y": math.nan}], [{"x": math.nan, "y": math.nan}], [], None],
                   arrow_storage("multipoint", "xy"))
    rows = bounds_of(arr, "multipoint")
    assert rows[0].tolist() == [1, 2, 1, 2]
    assert np.isnan(rows[1:]).all()


def test_dimensions_not_named_stay_in_either_layout(spark):
    df = native(spark, ["LINESTRING Z (1 2 3, 4 5 6)"], "linestring", "xyz")
    both = C.set_dims(df, m=lambda c: c["x"] * c["z"])
    assert geometry_tag(both).dims == "xyzm"
    assert [tuple(c) for c in both.first().geometry] == [(1.0, 2.0, 3.0, 3.0), (4.0, 5.0, 6.0, 24.0)]
    flat = C.set_dims(C.with_coord_layout(df, "interleaved"), m=lambda c: c["x"] * c["z"])
    assert geometry_tag(flat).layout == "interleaved" and flat.first().geometry[1] == [4.0, 5.0, 6.0, 24.0]
    rounded = C.round_coords(C.with_coord_layout(native(spark, ["POINT (1.26 2.34)"], "point"), "interleaved"), 1)
    assert rounded.first().geometry == [1.3, 2.3]
    rows = vertices.explode_coords(C.with_coord_layout(df, "interleaved"), ["fid"]).collect()
    assert [(r.seq, r.z) for r in rows] == [(0, 3.0), (1, 6.0)]


def test_reprojection_keeps_the_form(spark):
    for encoding, layout in (("wkb", "separated"), ("native", "interleaved"), ("wkt", "separated")):
        df = C.as_encoding(native(spark, ["POINT (-75 43)"], "point"), encoding, layout)
        tag = geometry_tag(C.reproject(df, "OGC:CRS84", "EPSG:32618"))
        assert (tag.encoding, tag.layout, tag.crs) == (encoding, layout, "EPSG:32618")


def test_wrapped_boxes_in_other_encodings_and_on_the_curve(spark):
    boxes = fixtures.regions(spark, "/root/testdata/sf0.001").filter("name = 'NATION_3'")
    edited = C.override_boxes(boxes, "name", {"NATION_3": (171.5, -168.25)})
    for encoding, layout in (("wkt", "separated"), ("wkb", "separated"), ("native", "interleaved")):
        shape = C.as_encoding(C.as_encoding(edited, encoding, layout), "wkt").first().geometry
        assert shape.startswith("MULTIPOLYGON (((171.5 10, 180 10") and "((-180 10, -168.25 10" in shape
    x, _ = coords.box_midpoint(F.col("geometry"))
    assert edited.select(x.alias("x")).first().x == -178.375


def test_footer_limits_of_three_dimensions(spark):
    df = native(spark, POLYGON_ZM, "polygon", "xyzm")
    assert extent.footer_bbox(df).first()[0] == [-10.0, -10.0, -20.0, 14.0, 12.0, 26.0]
    flat = native(spark, WKT["polygon"], "polygon")
    assert extent.footer_bbox(flat).first()[0] == [-10.0, -10.0, 14.0, 12.0]


def test_wrapped_boxes(spark):
    boxes = fixtures.regions(spark, "/root/testdata/sf0.001").filter("name in ('NATION_3', 'NATION_4')")
    edited = C.override_boxes(boxes, "name", {"NATION_3": (171.5, -168.25)})
    shapes = C.as_encoding(C.box_to_multipolygon(edited), "wkt").orderBy("name").collect()
    south, north = 10, 35
    assert shapes[0].geometry == (
        f"MULTIPOLYGON (((171.5 {south}, 180 {south}, 180 {north}, 171.5 {north}, 171.5 {south})), "
        f"((-180 {south}, -168.25 {south}, -168.25 {north}, -180 {north}, -180 {south})))"
    )
    assert shapes[1].geometry.count("((") == 1
    total = extent.extent(edited).first()
    assert (total.xmin, total.xmax) == (-180.0, 180.0)
    assert geometry_tag(edited).encoding == "box"


# ---------------------------------------------------------------- order


def test_curve_visits_neighbours_only(spark):
    side = 64
    grid = [(i * side + j, f"POINT ({i} {j})") for i in range(side) for j in range(side)]
    df = spark.createDataFrame(grid, "fid int, geometry string")
    df = C.as_encoding(C.declare(df, GeometryTag("wkt", "point", "xy")), "native")
    rows = ordering.hilbert_order(df, ["fid"]).collect()
    cells = [(r.geometry.x, r.geometry.y) for r in rows]
    assert len(set(cells)) == side * side and cells[0] == (0, 0) and cells[-1] == (side - 1, 0)
    steps = [abs(a - c) + abs(b - d) for (a, b), (c, d) in zip(cells, cells[1:])]
    assert set(steps) == {1}


def test_positions_do_not_depend_on_extent_width(spark):
    df = native(spark, ["POINT (5 7)", "POINT (5 7)", None, "POINT EMPTY"], "point")
    keys = [r.hilbert_key for r in ordering.hilbert_key(df).orderBy("fid").collect()]
    assert keys == [0, 0, None, None]


def test_clusters_split_a_crowded_spot(spark):
    crowd = spark.range(0, 3000).select(
        F.col("id").alias("fid"),
        F.struct(
            F.when(F.col("id") % 3 == 0, 1.0).otherwise(F.col("id").cast("double")).alias("x"),
            F.lit(2.0).alias("y"),
        ).alias("geometry"),
    )
    laid = ordering.cluster(crowd, ["fid"], partitions=6)
    sizes = [r["count"] for r in laid.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 3000 and len(sizes) == 6 and max(sizes) < 900


@pytest.mark.parametrize("stride", [2, 3, 7, 1000])
def test_pieces_of_a_hot_line_are_the_whole_line(spark, stride):
    # One user holds more than half of the rows.
    rows = [(0 if i % 5 < 3 else i % 5, (i * 37) % 400, i, float(i), float(-i)) for i in range(400)]
    df = spark.createDataFrame(rows, "user int, ts int, id int, x double, y double").repartition(5)
    pieces = vertices.line_pieces(df, ["user"], ["ts", "id"], stride)
    expected = {}
    for user, ts, i, x, y in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        expected.setdefault(user, []).append((x, y))
    seen = {}
    for r in pieces.orderBy("user", "piece").collect():
        line = [(c.x, c.y) for c in r.geometry]
        assert 2 <= len(line) <= stride
        whole = seen.setdefault(r.user, [])
        if whole:
            assert whole[-1] == line[0]
        whole += line[1:] if whole else line
    assert seen == expected
    again = vertices.explode_pieces(pieces, ["user"], stride).orderBy("user", "seq").collect()
    assert [(r.x, r.y) for r in again if r.user == 0] == expected[0]


def test_rank_over_the_whole_table(spark):
    df = spark.range(0, 1000).select(((F.col("id") * 7919) % 1000).alias("k"))
    ranked = ordering.with_rank(df, ["k"])
    assert ranked.filter("k <> rank").isEmpty() and ranked.count() == 1000
    nulls = spark.createDataFrame([(None, 2), (None, 1), (1, 5)], "g int, k int")
    out = ordering.with_rank(nulls, ["k"], ["g"]).collect()
    assert sorted((r.g or 0, r.k, r["rank"]) for r in out) == [(0, 1, 0), (0, 2, 1), (1, 5, 0)]


@pytest.mark.parametrize("kind", ["linestring", "polygon", "multipoint", "multilinestring", "multipolygon"])
def test_vertices_assemble_again(spark, kind):
    df = native(spark, WKT[kind], kind)
    rows = vertices.explode_coords(df, ["fid"]).repartition(3)
    again = vertices.assemble_coords(rows, ["fid"], kind)
    texts = {r.fid: r.geometry for r in C.as_encoding(again, "wkt").collect()}
    assert texts == {i: t for i, t in enumerate(WKT[kind]) if t and not t.endswith("EMPTY")}


# ---------------------------------------------------------------- projections


@pytest.mark.parametrize("crs", ["EPSG:32618", "ortho"])
def test_projection_inverts(crs):
    lon, lat = np.meshgrid(np.linspace(-78, -70, 9), np.linspace(-60, 80, 15))
    if crs == "ortho":
        lon, lat = np.meshgrid(np.linspace(-100, -40, 9), np.linspace(0, 80, 15))
    x, y = projection.project_numbers(lon, lat, "OGC:CRS84", crs)
    back = projection.project_numbers(x, y, crs, "OGC:CRS84")
    assert np.abs(back[0] - lon).max() < 1e-9 and np.abs(back[1] - lat).max() < 1e-9


def test_projection_known_places(spark):
    df = native(spark, ["POINT (-75 0)", "POINT (-72.69 43.88)", None, "POINT EMPTY", "POINT (105 0)"], "point")
    utm = [r.geometry for r in C.reproject(df, "OGC:CRS84", "EPSG:32618").orderBy("fid").collect()]
    assert (utm[0].x, utm[0].y) == (500000.0, 0.0)
    # An independent check: the meridian arc to this latitude by numeric integration.
    e2 = projection.FLATTENING * (2 - projection.FLATTENING)
    phi = np.linspace(0, math.radians(43.88), 200001)
    arc = projection.SEMI_MAJOR * (1 - e2) / (1 - e2 * np.sin(phi) ** 2) ** 1.5
    arc = ((arc[1:] + arc[:-1]) / 2 * np.diff(phi)).sum()
    on_meridian = native(spark, ["POINT (-75 43.88)"], "point")
    y = C.reproject(on_meridian, "OGC:CRS84", "EPSG:32618").first().geometry.y
    assert y == pytest.approx(arc * 0.9996, abs=1e-4)
    assert utm[2] is None and math.isnan(utm[3].x)
    ortho = [r.geometry for r in C.reproject(df, "OGC:CRS84", "ortho").orderBy("fid").collect()]
    assert abs(ortho[1].x) < 1e-6 and abs(ortho[1].y) < 1e-6
    assert math.isinf(ortho[4].x)
    tag = geometry_tag(C.reproject(df, "OGC:CRS84", "EPSG:4326"))
    assert (tag.crs, tag.crs_type) == ("EPSG:4326", "authority_code")


@pytest.mark.parametrize("kind", WKT)
def test_nested_and_point_paths_agree(spark, kind):
    moved = C.reproject(native(spark, WKT[kind], kind), "OGC:CRS84", "EPSG:32618")
    got = vertices.explode_coords(moved, ["fid"])
    plain = vertices.explode_coords(native(spark, WKT[kind], kind), ["fid"])
    keys = ["fid", "part", "ring", "seq"]
    points = plain.select(*keys, F.struct("x", "y").alias("geometry"))
    want = C.reproject(points, "OGC:CRS84", "EPSG:32618")
    joined = got.join(want, keys)
    assert joined.count() == plain.count()
    off = F.greatest(F.abs(F.col("x") - F.col("geometry.x")), F.abs(F.col("y") - F.col("geometry.y")))
    # Far from the zone both give infinity.
    same = (F.col("x") == F.col("geometry.x")) | (off < 1e-6)
    assert joined.filter(~same).isEmpty()


# ---------------------------------------------------------------- comparison


def test_table_differences_count_copies(spark):
    left = spark.createDataFrame([(1, math.nan), (1, math.nan), (2, None)], "a int, b double")
    right = spark.createDataFrame([(1, math.nan), (3, 1.0)], "a int, b double")
    found = {r.a: r.surplus for r in compare.table_differences(left, right).collect()}
    assert found == {1: 1, 2: 1, 3: -1}
    assert compare.tables_equal(left, left) and not compare.tables_equal(left, right)


def test_schema_equality_sees_metadata(spark):
    df = native(spark, WKT["point"], "point")
    assert compare.schemas_equal(df, df.select("*"))
    assert not compare.schemas_equal(df, C.with_crs(df, "OGC:CRS84"))


def test_failed_checks_raise(spark):
    ok = spark.createDataFrame([("a", True)], "name string, ok boolean")
    assert compare.require_all_passed(ok, "ok").first().complete
    with pytest.raises(Exception, match="Fewer tables passed"):
        compare.require_all_passed(ok.union(spark.createDataFrame([("b", False)], ok.schema)), "ok").collect()
