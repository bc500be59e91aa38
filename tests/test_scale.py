"""Work split among tasks: file bounds, versions, JSON ranges, footers of many files, hash trees, arcs, positions."""

import json
import random
import zipfile

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from terrafold.functions.types import GeometryTag, geometry_tag
from terrafold.operators import columns as C
from terrafold.operators import compare, extent, ordering
from terrafold.plans import fixtures, publish, validate
from terrafold.sources import geojson, json_ranges
from terrafold.sources.arrow_stream import CHUNK, read_arrow, write_arrow
from terrafold.sources.parquet import footer_differences, footers, read_geo, write_geo
from terrafold.sources.shared import current_version, data_paths, drop_versions, list_files
from terrafold.sources.text import read_wkt_tsv


def shapes(spark, n=3000, parts=2):
    """Points whose texts differ in length."""
    rows = spark.range(0, n, 1, parts).select(
        F.col("id").alias("fid"), F.repeat(F.lit("é"), (F.col("id") % 40).cast("int")).alias("note"),
        F.struct(F.col("id").cast("double").alias("x"), (-F.col("id")).cast("double").alias("y")).alias("geometry"),
    )
    return C.declare(rows, GeometryTag("native", "point", "xy"))


def sizes(path, suffix):
    return [size for _, size in list_files(path, (suffix,))]


# ---------------------------------------------------------------- bounded files


@pytest.mark.parametrize("bound", [200_000, 60_000_000])
@pytest.mark.parametrize("encoding", ["wkb", "native"])
def test_files_keep_to_their_bound(spark, tmp_path, encoding, bound):
    path = f"{tmp_path}/bounded"
    df = shapes(spark, 20_000)
    write_geo(df, path, encoding, compression="none", row_group_rows=400, max_file_bytes=bound)
    found = sizes(path, ".parquet")
    assert max(found) <= bound and (len(found) > 2) == (bound < 1_000_000)
    back = read_geo(spark, path)
    assert compare.tables_equal(C.as_encoding(df, encoding).select(*back.columns), back)
    rows = [r for f in footers(spark, path).collect() for r in f.group_rows]
    assert sum(rows) == 20_000 and max(rows) <= 400
    # Each part describes its own rows.
    for path, _ in list_files(path, (".parquet",)):
        table = pq.read_table(path)
        box = json.loads(pq.read_schema(path).metadata[b"geo"] if b"geo" in (pq.read_schema(path).metadata or {}) else pq.ParquetFile(path).metadata.metadata[b"geo"])
        fids = table["fid"].to_numpy()
        assert box["columns"]["geometry"]["bbox"] == [fids.min(), -fids.max(), fids.max(), -fids.min()]


def test_streams_keep_to_their_bound(spark, tmp_path):
    path = f"{tmp_path}/bounded"
    df = C.as_encoding(shapes(spark, 20_000), "wkb")
    write_arrow(df, path, compression="none", batch_rows=300, max_file_bytes=100_000)
    found = sizes(path, ".arrows")
    assert max(found) <= 100_000 and len(found) > 4
    back = read_arrow(spark, path, row_index=True)
    assert compare.tables_equal(df, back.select(*df.columns))
    # The names of the parts keep the order of the rows.
    assert [r.fid for r in back.orderBy("file_name", "row_index").collect()] == list(range(20_000))


def test_row_groups_are_bounded_in_bytes(spark, tmp_path):
    path = f"{tmp_path}/groups"
    write_geo(shapes(spark, 5000, 1), path, "wkb", row_group_bytes=20_000)
    (facts,) = footers(spark, path).collect()
    assert sum(facts.group_rows) == 5000 and 5 < len(facts.group_rows) < 60


def test_a_row_beyond_the_bound_is_an_error(spark, tmp_path):
    df = shapes(spark, 3).withColumn("note", F.repeat(F.lit("xy"), 100_000))
    with pytest.raises(Exception, match="at most 50000"):
        write_geo(df, f"{tmp_path}/x", "wkb", compression="none", max_file_bytes=50_000)
    assert not list_files(f"{tmp_path}", (".parquet",))


def test_batches_become_row_groups(spark, tmp_path):
    src, dst = f"{tmp_path}/s", f"{tmp_path}/p"
    schema = None
    for name, lengths in (("a", [3, 1, 0, 500, 7]), ("b", []), ("c", [12_000, 2])):
        df = C.as_encoding(shapes(spark, 1, 1), "wkb")
        if schema is None:
            write_arrow(df, f"{tmp_path}/one")
            with pa.ipc.open_stream(list_files(f"{tmp_path}/one", (".arrows",))[0][0]) as reader:
                schema = reader.schema
            (tmp_path / "s").mkdir()
        with pa.OSFile(f"{src}/{name}.arrows", "wb") as raw, pa.ipc.new_stream(raw, schema) as out:
            for n in lengths:
                point = bytes.fromhex("0101000000") + np.array([1.0, 2.0]).tobytes()
                out.write_batch(pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64()), pa.array([""] * n), pa.array([point] * n)], schema=schema))
    publish.convert_table(spark, src, dst)
    got = sorted(f.group_rows for f in footers(spark, dst).collect() if sum(f.group_rows))
    assert got == [[3, 1, 500, 7], [12_000, 2]]
    assert publish.conversion_matches(spark, src, dst)
    assert CHUNK not in read_geo(spark, dst).columns


# ---------------------------------------------------------------- versions


@pytest.mark.parametrize("fmt", ["geoparquet", "arrows/wkb", "tsv"])
def test_versions_switch_at_once(spark, tmp_path, fmt):
    df = shapes(spark).select("fid", "geometry") if fmt != "tsv" else shapes(spark).select("geometry")
    path = publish.republish(df, str(tmp_path), "g", "n", [fmt])[0]
    reader = {"tsv": read_wkt_tsv, "geoparquet": read_geo, "arrows/wkb": read_arrow}[fmt]
    first = current_version(path)
    assert reader(spark, path).count() == 3000 and first
    old = reader(spark, path)
    broken = C.replace_geometry(df, F.raise_error(F.lit("lost")).cast(df.schema["geometry"].dataType), geometry_tag(df))
    with pytest.raises(Exception, match="lost"):
        publish.republish(broken, str(tmp_path), "g", "n", [fmt])
    assert current_version(path) == first and reader(spark, path).count() == 3000
    publish.republish(df.limit(10), str(tmp_path), "g", "n", [fmt])
    assert current_version(path) != first and reader(spark, path).count() == 10
    # Whoever reads the old version still can, until it is dropped.
    assert old.count() == 3000
    assert first in drop_versions(path) and drop_versions(path) == []
    assert reader(spark, path).count() == 10 and data_paths(str(tmp_path)) == [str(tmp_path)]


def test_files_of_failed_attempts_are_not_read(spark, tmp_path):
    path = publish.republish(shapes(spark), str(tmp_path), "g", "n", ["geoparquet"])[0]
    (one, *_) = data_paths(path)
    stray = one.replace("part-00000", "part-00099")
    with open(one, "rb") as a, open(stray, "wb") as b:
        b.write(a.read())
    assert read_geo(spark, path).count() == 3000 and footers(spark, path).count() == len(data_paths(path))


def test_publish_leaves_versions_alone_if_lazy(spark, tmp_path):
    args = (str(tmp_path), "g", "n", ["geoparquet"])
    assert publish.publish(shapes(spark), *args, versioned=True) and publish.publish(shapes(spark), *args, versioned=True) == []


# ---------------------------------------------------------------- footers of many files


def test_differing_footers(spark, tmp_path):
    points = shapes(spark, 30, 3).drop("note")
    write_geo(points, f"{tmp_path}/t", "wkb")
    write_geo(C.with_crs(points, "EPSG:32618", "authority_code"), f"{tmp_path}/t", "wkb")
    write_geo(points, f"{tmp_path}/t", "wkb")
    with pytest.raises(ValueError, match="crs: None in 6, EPSG:32618 in 3"):
        read_geo(spark, f"{tmp_path}/t")
    kept = read_geo(spark, f"{tmp_path}/t", on_conflict="majority")
    assert geometry_tag(kept).crs is None and kept.count() == 90
    found = {(r.property, r.found, r.expected, r.rows) for r in footer_differences(spark, f"{tmp_path}/t").collect()}
    assert found == {("crs", "EPSG:32618", None, 10), ("crs_type", "authority_code", None, 10)}
    with pytest.raises(ValueError, match="majority"):
        read_geo(spark, f"{tmp_path}/t", on_conflict="ignore")


def test_files_of_several_types_are_a_mixed_column(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    for df in (fixtures.points(spark, sf), fixtures.footprints(spark, sf)):
        write_geo(df, f"{tmp_path}/m", "wkb")
    tag = geometry_tag(read_geo(spark, f"{tmp_path}/m/*.parquet"))
    assert (tag.encoding, tag.kind, tag.crs) == ("wkb", None, "OGC:CRS84")


# ---------------------------------------------------------------- JSON by ranges


def awkward(rng):
    return "".join(rng.choice(['"', "\\", "[", "]", "{", "}", ",", ":", "é", " ", "\n", '"features":[', "a"]) for _ in range(rng.randint(0, 12)))


def document(rng, n):
    features = [
        {"type": "Feature", "properties": {awkward(rng): awkward(rng), "i": i}, "geometry": {"type": "Polygon", "coordinates": [[[i, 0], [1, 1.5], [i, 0]]]}}
        for i in range(n)
    ]
    doc = {"type": awkward(rng), "crs": {"features": [1, {"features": []}]}, "features": features, "more": [[], {}], "last": awkward(rng)}
    return features, json.dumps(doc, indent=rng.choice([None, 1]), ensure_ascii=rng.random() < 0.5)


@pytest.mark.parametrize("size", [5, 19, 300, 1 << 20])
def test_members_in_any_ranges(spark, tmp_path, size):
    rng = random.Random(size)
    want = {}
    for number in range(2 if size < 60 else 5):
        features, text = document(rng, rng.choice([0, 1, 2]) if size < 60 else rng.randint(0, 20))
        (tmp_path / f"{number}.geojson").write_text(text, encoding="utf-8")
        want[f"{number}.geojson"] = (features, text.encode())
    found = json_ranges.json_members(spark, list_files(str(tmp_path), ("json",)), "features", size, keep=["last"])
    rows = found.orderBy("path", "at").collect()
    for name, (features, raw) in want.items():
        own = [r for r in rows if r.path.endswith(name)]
        assert [json.loads(r.member) for r in own] == features
        assert all(raw[r.at : r.at + len(r.member.encode())] == r.member.encode() for r in own)
        assert all(json.loads(r.last) == json.loads(raw)["last"] for r in own)


def test_small_ranges_share_tasks(spark):
    dealt = json_ranges.byte_ranges(spark, [("a", 1 << 20), ("b", 5)], 100)
    assert dealt.rdd.getNumPartitions() == json_ranges.FEW_TASKS
    assert dealt.agg(F.count("*"), F.sum(F.col("end") - F.col("begin"))).first()[:] == (10487, (1 << 20) + 5)
    # Tasks grow with the bytes; large ranges have one each.
    assert json_ranges._tasks([("a", 1 << 32)], 20_000) == 1 + (1 << 32) // json_ranges.TASK_BYTES
    assert json_ranges._tasks([("a", 1 << 32)], 32 << 20) == 129


def test_members_far_beyond_their_range(spark, tmp_path, monkeypatch):
    members = [{"t": '\\"],é' * n} for n in (30, 5000, 1, 40_000)]
    (tmp_path / "far.json").write_text(json.dumps({"features": members, "last": 1}))
    read = []
    whole = json_ranges.read_range
    monkeypatch.setattr(json_ranges, "read_range", lambda raw, begin, end: read.append(end - begin) or whole(raw, begin, end))
    with pa.OSFile(str(tmp_path / "far.json")) as raw:
        rows = [{"begin": 13, "end": 20, "in_string": 0, "depth": 1, "escaped": 0, "value_at": 13, "until": raw.size() - 11}]
        (_, text), = json_ranges._members_of(raw, rows[0])
    # A short member costs no long read.
    assert json.loads(text) == members[0] and sum(read) < 10_000
    found = json_ranges.json_members(spark, list_files(str(tmp_path), ("json",)), "features", 64).orderBy("at").collect()
    assert [json.loads(r.member) for r in found] == members


def test_torn_and_other_documents_are_errors(spark, tmp_path):
    (tmp_path / "torn.json").write_text('{"features": [{"a": "b"}, {"a"')
    with pytest.raises(Exception, match="ends before it is closed"):
        json_ranges.json_members(spark, list_files(str(tmp_path), ("json",)), "features", 8).collect()
    (tmp_path / "torn.json").write_text('{"feature": [1]}')
    with pytest.raises(Exception, match="No array features"):
        json_ranges.json_members(spark, list_files(str(tmp_path), ("json",)), "features", 8).collect()


def test_lines_in_any_ranges(spark, tmp_path):
    rng = random.Random(1)
    lines = ["é" * rng.randint(0, 9) for _ in range(60)]
    for end in ("", "\n"):
        (tmp_path / "l.txt").write_text("\n".join(lines) + end, encoding="utf-8")
        raw = (tmp_path / "l.txt").read_bytes()
        for size in (1, 5, 1000):
            got = json_ranges.text_lines(spark, list_files(str(tmp_path), (".txt",)), size).orderBy("at").collect()
            assert [r.line for r in got] == (lines if end or lines[-1] else lines[:-1])
            assert all(raw[r.at : r.at + len(r.line.encode())].decode() == r.line for r in got)


def feature(i, kind="Polygon", coordinates=None):
    ring = [[[i, 0], [1, 1], [0, 1], [i, 0]]] if coordinates is None else coordinates
    return json.dumps({"type": "Feature", "properties": {"i": i}, "geometry": {"type": kind, "coordinates": ring}})


DAMAGED = {
    "no JSON": feature(1)[:50], "no feature": '{"type": "Thing"}', "Not a Polygon: Point": feature(2, "Point", [1, 2]),
    "Not a Polygon: no type": '{"type": "Feature", "geometry": {}}', "coordinates": feature(3, coordinates=[[["a", 1], [2, 2]]]),
    "too few ordinates": feature(4, coordinates=[[[1], [2, 2]]]), "extra ordinates": feature(5, coordinates=[[[1, 2, 3], [2, 2]]]),
}
NO_GEOMETRY = '{"type": "Feature", "properties": {"i": 9}, "geometry": null}'


def test_damaged_records_are_set_aside(spark, tmp_path):
    lines = [feature(0), *DAMAGED.values(), "", NO_GEOMETRY, feature(7)]
    (tmp_path / "f.geojsonl").write_text("\n".join(lines))
    good, bad, counts = geojson.split_geojson(spark, f"{tmp_path}/f.geojsonl", range_bytes=100)
    assert counts == {"features": 3, "damaged": len(DAMAGED)}
    assert sorted(json.loads(r.properties)["i"] for r in good.collect()) == [0, 7, 9]
    assert good.filter("geometry is null").count() == 1
    raw = (tmp_path / "f.geojsonl").read_bytes()
    for r in bad.collect():
        assert DAMAGED[r.cause] == r.feature == raw[r["at"] :].split(b"\n")[0].decode()
    with pytest.raises(Exception, match="at "):
        geojson.read_geojson(spark, f"{tmp_path}/f.geojsonl").collect()


def test_damage_in_collections_and_archives(spark, tmp_path):
    text = '{"type": "FeatureCollection", "features": [' + ",\n".join([feature(0), *[d for c, d in DAMAGED.items() if c != "no JSON"]]) + "]}"
    (tmp_path / "a.geojson").write_text(text)
    with zipfile.ZipFile(tmp_path / "b.geojson.zip", "w") as archive:
        archive.writestr("b.geojson", text)
    good, bad, counts = geojson.split_geojson(spark, str(tmp_path), range_bytes=64)
    assert counts == {"features": 2, "damaged": 12} and good.count() == 2
    assert bad.groupBy("cause").count().filter("count = 2").count() == 6


def test_lines_around_features_are_no_damage(spark, tmp_path):
    head = '{\n"type": "FeatureCollection",\n"crs": { "type": "name", "properties": { "name": "x" } },\n"features": [\n'
    (tmp_path / "l.geojson").write_text(head + feature(1) + ",\n" + DAMAGED["no JSON"] + ",\n" + feature(2) + "\n]\n}\n")
    good, bad, counts = geojson.split_geojson(spark, f"{tmp_path}/l.geojson", feature_per_line=True)
    assert counts == {"features": 2, "damaged": 1} and bad.first().cause == "no JSON"


# ---------------------------------------------------------------- positions


@pytest.mark.parametrize("ranges", [1, 2, 7, 40])
def test_positions_and_sums_in_ranges(spark, ranges):
    rng = random.Random(ranges)
    rows = [(rng.choice(["a", "b", "b", "b", None]), rng.choice([None, 1.5, float("nan"), -2.0, 7.0]), i, rng.choice([None, 2, 5])) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, v double, k int, w int")
    order = lambda r: (r[1] is not None, r[1] is not None and r[1] != r[1], 0.0 if r[1] is None or r[1] != r[1] else r[1], r[2])
    for within in (None, ["g"]):
        got = {r.k: r for r in ordering.with_running(df, ["v", "k"], within, "n", ranges=ranges).collect()}
        sums = {r.k: r for r in ordering.with_running(df, ["v", "k"], within, "s", "w", ranges=ranges).collect()}
        for g in {r[0] for r in rows} if within else [...]:
            total = 0
            for place, r in enumerate(sorted((r for r in rows if g is ... or r[0] == g), key=order)):
                assert got[r[2]].n == place and sums[r[2]].s == total
                total += r[3] or 0
    assert ordering.with_running(df.limit(0), ["k"]).count() == 0


def test_positions_need_no_written_table(spark, monkeypatch):
    written = []
    monkeypatch.setattr("pyspark.sql.readwriter.DataFrameWriter.parquet", lambda *a, **k: written.append(a))
    df = spark.range(0, 1000, 1, 4).withColumn("k", F.col("id") * 7919 % 1000)
    ranked = ordering.with_running(df, ["k"], name="n", ranges=8)
    assert ranked.filter("n <> k").isEmpty() and written == []
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


# ---------------------------------------------------------------- hash trees


def ordered(spark, rows, path):
    df = spark.createDataFrame(rows, "place long, a string, b double")
    df.repartitionByRange(3, "place").sortWithinPartitions("place").write.parquet(path)
    return spark.read.parquet(path)


def test_differences_are_found_where_they_are(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(compare, "FAN", 4)
    rows = [(i, None if i % 7 == 0 else f"é{i % 5}", float("nan") if i % 11 == 0 else i / 3) for i in range(200)]
    changed = dict((r[0], r) for r in rows)
    changed[17], changed[18] = (17, *rows[18][1:]), (18, *rows[17][1:])
    changed[70] = (70, "", rows[70][2])
    changed[77] = (77, rows[77][1], None)
    del changed[199]
    changed[200], changed[201] = (200, None, None), (201, "x", 0.0)
    left, right = ordered(spark, rows, f"{tmp_path}/l"), ordered(spark, list(changed.values()), f"{tmp_path}/r")
    got = {r.place: r for r in compare.order_difference(left, right, "place").collect()}
    assert sorted(got) == [17, 18, 70, 77, 199, 200, 201]
    assert got[199].right is None and got[200].left is None and got[70].right.a == ""
    assert compare.order_difference(left, left, "place").count() == 0
    assert compare.order_difference(left, left.limit(0), "place").count() == 200
    assert compare.order_difference(left.limit(0), left.limit(0), "place").count() == 0


def test_only_unequal_ranges_are_read(spark, tmp_path):
    rows = [(i, "x", float(i)) for i in range(20_000)]
    swapped = [(i, "y" if i in (5000, 5001) else "x", float(i)) for i in range(20_000)]
    left, right = ordered(spark, rows, f"{tmp_path}/l"), ordered(spark, swapped, f"{tmp_path}/r")
    trees = tuple(compare.hash_tree(t, "place") for t in (left, right))
    found = compare.order_difference(left, right, "place", trees)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("GreaterThanOrEqual(place,4864)") == plan.count("LessThan(place,5120)") == 2
    assert [r.place for r in found.orderBy("place").collect()] == [5000, 5001]
    leaves = compare.unequal_leaves(*trees)
    assert [r.node for r in leaves.collect()] == [19] and compare.rows_of_leaves(left, "place", leaves).count() == 256


def test_many_unequal_ranges_are_joined(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(compare, "MOST_RANGES", 2)
    rows = [(i, "x", 0.0) for i in range(5000)]
    changed = [(i, "y" if i % 600 == 0 else "x", 0.0) for i in range(5000)]
    left, right = ordered(spark, rows, f"{tmp_path}/l"), ordered(spark, changed, f"{tmp_path}/r")
    assert compare.order_difference(left, right, "place").count() == 9


# ---------------------------------------------------------------- arcs


def swept(boxes):
    """Extent on the circle by a plain sweep over unrolled arcs."""
    arcs = sorted((w, e + 360 if e < w else e) for w, e in boxes)
    reach = max(e for _, e in arcs) - 360
    best = None
    for w, e in arcs:
        if best is None or w - reach > best[0]:
            best = (w - reach, w, reach)
        reach = max(reach, e)
    if best[0] < 360 / extent.ARC_CELLS:
        return (-180.0, 180.0)
    return best[1], best[2] + 360 if best[2] < -180 else best[2] - 360 if best[2] > 180 else best[2]


def test_extents_on_the_circle(spark):
    rng = random.Random(9)
    groups = {"all": [(-180.0, 0.0), (0.0, 180.0)], "fine": [(i / 200 - 180, i / 200 - 180) for i in range(72_000)], "one": [(170.0, -170.0)], "pole": [(-180.0, 180.0)]}
    for i in range(60):
        groups[f"g{i}"] = [(rng.randint(-720, 720) / 4, rng.randint(-720, 720) / 4) for _ in range(rng.choice([1, 2, 5, 9]))]
        if i % 2:
            groups[f"g{i}"] = [(w, min(180.0, w + rng.randint(0, 200) / 4)) for w, _ in groups[f"g{i}"]]
    rows = [(g, (w, float(i), e, i + 1.0)) for g, boxes in groups.items() for i, (w, e) in enumerate(boxes)] + [("null", None)]
    df = spark.createDataFrame(rows, "g string, geometry struct<xmin: double, ymin: double, xmax: double, ymax: double>")
    df = C.declare(df, GeometryTag("box"))
    got = {r.g: r for r in extent.wrapped_extent(df, ["g"]).collect()}
    assert set(got) == set(groups)
    for g, boxes in groups.items():
        # The antimeridian has two longitudes.
        assert all((a - b) % 360 in (pytest.approx(0), pytest.approx(360)) for a, b in zip((got[g].xmin, got[g].xmax), swept(boxes))), g
        assert (got[g].ymin, got[g].ymax) == (0.0, float(len(boxes)))
    whole = extent.wrapped_extent(df.filter("g = 'one'")).collect()
    assert [(r.xmin, r.xmax) for r in whole] == [(170.0, -170.0)]
    assert extent.wrapped_extent(df.filter("g = 'null'")).count() == 0


def test_wrapped_boxes_are_no_polygons(spark):
    df = fixtures.regions(spark, "/root/testdata/sf0.001")
    with pytest.raises(Exception, match="antimeridian"):
        C.box_to_polygon(df).collect()


# ---------------------------------------------------------------- many assets


def test_the_plan_does_not_grow_with_assets(spark, tmp_path):
    def size(n):
        assets = [(f"{tmp_path}/{i}.tsv", "tsv") for i in range(n)]
        return validate.check_assets(spark, assets)._jdf.queryExecution().analyzed().toString().count("\n")

    assert size(10) == size(1000)


def test_assets_of_every_state(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(validate, "LINE_RANGE", 16)
    monkeypatch.setattr(validate, "TASK_BYTES", 1 << 20)
    (tmp_path / "good.tsv").write_text("geometry\nPOINT (1 2)\n\nPOINT EMPTY\n")
    (tmp_path / "bad.tsv").write_text("geometry\n" + "POINT (1 2)\npoint (1 2)\n" * 40)
    (tmp_path / "none.tsv").write_text("geometry\n")
    (tmp_path / "head.tsv").write_text("wkt\nPOINT (1 2)\n")
    write_geo(shapes(spark, 5, 1).drop("note"), f"{tmp_path}/geo", "wkb")
    names = [("good.tsv", "tsv"), ("bad.tsv", "tsv"), ("none.tsv", "tsv"), ("head.tsv", "tsv"), ("absent.tsv", "tsv"), ("geo", "geoparquet"), ("good.tsv", "jpeg")]
    found = validate.check_assets(spark, [(f"{tmp_path}/{n}", fmt) for n, fmt in names]).collect()
    got = {(r.subject.rpartition("/")[2], r.rule, r.detail) for r in found if r.rule != "contents"}
    assert got == {("bad.tsv", "line tag", "40"), ("none.tsv", "no rows", "0"), ("head.tsv", "header", "wkt"), ("head.tsv", "line tag", "1"), ("good.tsv", "format", "jpeg")}
    assert [r.subject.rpartition("/")[2] for r in found if r.rule == "contents"] == ["absent.tsv"]
    assert validate.check_assets(spark, spark.createDataFrame([], "path string, format string")).count() == 0
