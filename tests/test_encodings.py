import json
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from terrafold.functions import wkb, wkt
from terrafold.functions.types import DIMENSIONS, NESTING, GeometryTag, geometry_tag
from terrafold.operators import columns as C
from terrafold.operators.extent import geometry_types
from terrafold.plans.publish import add_dimensions
from terrafold.sources.text import wkt_lists

from .samples import COLLECTIONS, POLYGON_ZM, WKT


def table(spark, texts, kind=None, dims=None, **tag):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "fid int, geometry string")
    return C.declare(df.repartition(2), GeometryTag("wkt", kind, dims, **tag))


def texts(df):
    return [r.geometry for r in C.as_encoding(df, "wkt").orderBy("fid").collect()]


@pytest.mark.parametrize("kind", WKT)
def test_every_route_gives_the_text_back(spark, kind):
    df = table(spark, WKT[kind], kind, "xy")
    native = C.as_encoding(df, "native")
    assert texts(native) == WKT[kind]
    assert texts(C.with_coord_layout(native, "interleaved")) == WKT[kind]
    binary = C.as_encoding(native, "wkb")
    assert texts(binary) == WKT[kind]
    assert texts(C.as_encoding(binary, "native")) == WKT[kind]
    assert df.filter(~C.wkt_is_canonical(df)).isEmpty()


def test_dimensions_follow_from_x_and_y(spark):
    lists = wkt_lists(spark, {"polygon": WKT["polygon"], "point": WKT["point"]})
    made = {}
    for r in add_dimensions(lists, z=True, m=True).collect():
        made.setdefault(r.name, {})[r.pos] = r.wkt
    assert [made["polygon-zm"][i] for i in range(4)] == POLYGON_ZM
    assert made["point-zm"] == {0: "POINT ZM (3 -7 -4 -21)", 1: "POINT ZM (12 5 17 60)", 2: None, 3: "POINT ZM EMPTY"}


def test_collections_stay_binary_and_split(spark):
    df = table(spark, COLLECTIONS)
    assert texts(C.as_encoding(df, "wkb")) == COLLECTIONS
    with pytest.raises(ValueError, match="native form"):
        C.as_encoding(df, "native")
    rows = C.as_encoding(C.explode_members(df), "wkt").collect()
    found = sorted((r.fid, r.path, r.geometry) for r in rows)
    assert found == [
        (0, "0", "POINT (3 -7)"),
        (1, "0", "POINT (3 -7)"),
        (1, "1", "LINESTRING (0 1, 6 2, 9 11)"),
        (1, "2", "MULTIPOINT ((5 6))"),
        (2, "0.0", "POINT ZM (3 -7 -4 -21)"),
    ]


def test_singles_are_promoted_among_multis(spark):
    mixed = [WKT["polygon"][1], WKT["multipolygon"][2], None, "POLYGON EMPTY"]
    df = C.as_encoding(table(spark, mixed), "wkb")
    native = C.as_encoding(df, "native", kind="multipolygon")
    assert texts(native) == [
        "MULTIPOLYGON (" + mixed[0].removeprefix("POLYGON ") + ")",
        mixed[1],
        None,
        "MULTIPOLYGON EMPTY",
    ]
    points = C.as_encoding(table(spark, ["POINT (1 2)", "MULTIPOINT ((3 4), (5 6))", "POINT EMPTY"]), "wkb")
    assert texts(C.as_encoding(points, "native", kind="multipoint")) == [
        "MULTIPOINT ((1 2))", "MULTIPOINT ((3 4), (5 6))", "MULTIPOINT EMPTY",
    ]


def test_types_of_mixed_columns(spark):
    every = [t for kind in WKT for t in WKT[kind]] + COLLECTIONS + POLYGON_ZM
    expected = sorted(
        ["Point", "LineString", "Polygon", "MultiPoint", "MultiLineString", "MultiPolygon",
         "GeometryCollection", "GeometryCollection ZM", "Polygon ZM"]
    )
    for encoding in ("wkt", "wkb"):
        df = C.as_encoding(table(spark, every), encoding)
        assert geometry_types(df).first()[0] == expected


@pytest.mark.parametrize(
    "kind, text, canonical",
    [
        ("multipoint", "MULTIPOINT (30 10, 20 20)", "MULTIPOINT ((30 10), (20 20))"),
        ("point", " point  ( +1.5   .5e+3 ) ", "POINT (1.5 500)"),
        ("polygon", "POLYGON((1. 2,3 4 , 5 6,1. 2))", "POLYGON ((1 2, 3 4, 5 6, 1 2))"),
        ("point", "POINT(1e+20 -2.5E-3)", "POINT (1E20 -0.0025)"),
    ],
)
def test_other_spellings_are_read(spark, kind, text, canonical):
    assert texts(C.as_encoding(table(spark, [text, None], kind, "xy"), "native")) == [canonical, None]


@pytest.mark.parametrize(
    "kind, text",
    [
        ("point", "LINESTRING (1 2)"), ("point", "POINT Z (1 2 3)"), ("point", "POINT (1 2 3)"),
        ("linestring", "LINESTRING (1 2, 3)"), ("polygon", "POLYGON ((1 2, 3 4)"),
        ("polygon", "POLYGON ((1 2, 3 4)(5 6, 7 8))"), ("polygon", "POLYGON (1 2, 3 4)"),
        ("point", "POINT (1 2) (3 4)"), ("linestring", "LINESTRING (1 2,, 3 4)"),
        ("linestring", "LINESTRING (1 2; 3 4)"), ("point", "POINT (1 2 x)"),
        ("linestring", "LINESTRING ()"), ("point", "POINT 1 2)"), ("point", "POINT ()"),
    ],
)
def test_malformed_text_is_an_error(kind, text):
    good = "POINT (0 0)" if kind == "point" else f"{kind.upper()} EMPTY"
    with pytest.raises((ValueError, pa.ArrowInvalid)):
        wkt.parse_array(pa.array([good, None, text, good]), kind, "xy")


def coordinates(kind, dims):
    number = st.floats(allow_nan=False, allow_infinity=False, width=64)
    value = st.fixed_dictionaries({d: number for d in dims})
    for _ in range(NESTING[kind]):
        value = st.lists(value, min_size=1, max_size=4)
    return st.lists(st.none() | value, max_size=6)


@settings(max_examples=150, deadline=None)
@given(st.data())
def test_wkb_kernels_invert_each_other(data):
    kind = data.draw(st.sampled_from(sorted(NESTING)))
    dims = data.draw(st.sampled_from(DIMENSIONS))
    rows = pa.array(data.draw(coordinates(kind, dims)), wkb.arrow_storage(kind, dims))
    encoded = wkb.encode_array(rows, kind, dims)
    assert wkb.decode_array(encoded, kind, dims).to_pylist() == rows.to_pylist()
    # A slice of a batch starts inside its buffers.
    half = len(rows) // 2
    assert wkb.encode_array(rows.slice(half), kind, dims).to_pylist() == encoded.to_pylist()[half:]
    assert wkb.decode_array(encoded.slice(half), kind, dims).to_pylist() == rows.to_pylist()[half:]
    # The text of the small recursive helper goes through the batch parser.
    words = [None if v is None else wkb._bytes_to_text(v, 0)[0] for v in encoded.to_pylist()]
    again = wkt.parse_array(pa.array(words, pa.string()), kind, dims)
    assert again.to_pylist() == rows.to_pylist()
    assert [None if w is None else wkb._text_to_bytes(w) for w in words] == encoded.to_pylist()
    assert wkb.wkb_to_texts(encoded, wkt.format_array).to_pylist() == words


def test_big_endian_and_damaged_values():
    big = bytes.fromhex("00000000013FF00000000000004000000000000000")
    little = wkb._text_to_bytes("POINT (3 4)")
    out = wkb.decode_array(pa.array([big, None, little]), "point", "xy").to_pylist()
    assert out == [{"x": 1.0, "y": 2.0}, None, {"x": 3.0, "y": 4.0}]
    with pytest.raises(ValueError, match="type code"):
        wkb.decode_array(pa.array([little]), "linestring", "xy")
    with pytest.raises(ValueError, match="shorter or longer"):
        wkb.decode_array(pa.array([little + b"\0"]), "point", "xy")
    with pytest.raises(ValueError, match="Unknown"):
        wkb.split_code(99)


def test_tag_survives_operators_and_spells_crs(spark):
    df = table(spark, WKT["point"], "point", "xy")
    native = C.as_encoding(C.with_crs(df, {"type": "GeographicCRS"}), "native")
    assert geometry_tag(native).crs_type == "projjson"
    assert geometry_tag(C.round_coords(native, 2)).crs == {"type": "GeographicCRS"}
    assert geometry_tag(C.with_crs(df, "GEOGCRS[]", "wkt2")).crs_type == "wkt2"
    assert geometry_tag(C.with_crs(df, "OGC:CRS84", "authority_code")).crs == "OGC:CRS84"
    assert geometry_tag(C.with_crs(df, "OGC:CRS84")).crs_type is None
    assert json.loads(df.schema["geometry"].json())["metadata"]
    round_ = C.with_edges(native, "spherical")
    with pytest.raises(ValueError, match="spherical"):
        C.box_column(round_)
    pairs = C.crs_variants(spark, ["OGC:CRS84", "EPSG:4326"], ["crs84", "4326"]).collect()
    assert [(r.pos, r.crs, r.label) for r in pairs] == [(0, "OGC:CRS84", "crs84"), (1, "EPSG:4326", "4326")]


def test_text_beside_encoding_and_last_column(spark):
    df = table(spark, WKT["point"], "point", "xy").select("geometry", "fid")
    both = C.with_encoding(df, "wkb")
    assert both.columns == ["wkt", "geometry"]
    assert C.geometry_last(df).columns == ["fid", "geometry"]
    renamed = C.select_as(df, {"fid": "id", "geometry": "geometry"})
    assert renamed.columns == ["id", "geometry"] and geometry_tag(renamed).kind == "point"


def test_typed_and_mixed_numbers_are_written_alike(spark):
    values = [s * m * 10.0**p for p in range(-12, 16) for m in (1, 1.5, 1.23456789, 9.87654321012345) for s in (1, -1)]
    values += [12345678.5, 1e-4, 0.00012345, 123456789.125, 1 / 3, 2e-5 / 3, 1e15 + 0.5, 2.5e-320, 1.7976931348623157e308]
    shapes = [f"POINT ({v!r} 0)" for v in values]
    typed = texts(C.as_encoding(C.as_encoding(table(spark, shapes, "point", "xy"), "native"), "wkt"))
    mixed = texts(C.as_encoding(C.as_encoding(table(spark, shapes), "wkb"), "wkt"))
    assert typed == mixed
    assert [float(t.split("(")[1].split(" ")[0]) for t in typed] == values
    again = table(spark, typed, "point", "xy")
    assert again.filter(~C.wkt_is_canonical(again)).isEmpty()


def test_number_text(spark):
    values = [0.0, -1.0, 1e7, 123456789012.0, 1e15, 2.5, 1e-5, -0.1, 1e300]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    out = [r[0] for r in df.select(wkt.format_number(F.col("v"))).collect()]
    assert [float(t) for t in out] == values
    assert out[:4] == ["0", "-1", "10000000", "123456789012"]
    assert not np.any([t.endswith(".0") for t in out])


def test_texts_are_parsed_a_bounded_number_of_bytes_at_a_time(monkeypatch):
    line = "LINESTRING (" + ", ".join(f"{i}.25 {-i}" for i in range(64)) + ")"
    texts = pa.array([line, None, "LINESTRING EMPTY", *[line] * 9000])
    want = wkt.parse_array(texts, "linestring", "xy")
    tracemalloc.start()
    assert wkt.parse_slices(texts, "linestring", "xy").equals(want)
    # Working arrays of the whole batch take some 500 MB.
    assert tracemalloc.get_traced_memory()[1] < 100 << 20
    tracemalloc.stop()
    monkeypatch.setattr(wkt, "PARSE_BYTES", 20)
    few = pa.array([None, None, "POINT EMPTY", "POINT (1 2)", None, "POINT (3000000000.5 4000000000.5)"] * 2).slice(1)
    assert repr(wkt.parse_slices(few, "point", "xy").to_pylist()) == repr(wkt.parse_array(few, "point", "xy").to_pylist())
    assert wkt.parse_slices(few.slice(0, 0), "point", "xy").type == wkt.parse_array(few, "point", "xy").type
    seen = []
    monkeypatch.setattr(wkt, "parse_array", lambda values, kind, dims, f=wkt.parse_array: seen.append(len(values)) or f(values, kind, dims))
    wkt.parse_slices(few, "point", "xy")
    assert sum(seen) == 11 and max(seen) < 5
