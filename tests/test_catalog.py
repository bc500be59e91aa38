import json
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from terrafold.operators import compare, ordering
from terrafold.plans import catalog, fixtures

from .samples import FILES, FILES_PER_GROUP, MANIFESTS

GROUPS = [m["group"] for m in MANIFESTS]
BASES = ("v9", "https://example.org/raw", "https://example.org/releases")


@pytest.fixture(scope="module")
def assets(spark):
    expanded = catalog.expand_manifests(catalog.read_manifests(spark, MANIFESTS))
    return catalog.with_paths(expanded, *BASES).cache()


@pytest.fixture(scope="module")
def listed(assets):
    """Assets with a place in the whole catalog and their tag."""
    at = F.array_position(F.array(*map(F.lit, GROUPS)), F.col("group"))
    ordinal = at * 100000 + F.col("file_pos") * 100 + F.col("format_pos")
    return assets.select("*", ordinal.alias("ordinal"), F.lit("v9").alias("tag"))


def test_catalog_has_every_file(assets):
    counts = {r.group: r["count"] for r in assets.groupBy("group").count().collect()}
    assert counts == FILES_PER_GROUP == {"harbours": 10, "harbours-crs": 3, "trails": 9}
    assert assets.select("file").distinct().count() == FILES


def test_lists_of_a_file_and_skips(spark):
    one = [{"group": "g", "format": ["tsv", "fgb", "tsv"], "files": [
        {"name": "a"}, {"name": "b", "skip_format": ["fgb"]}, {"name": "c", "format": ["parquet"], "skip_format": ["tsv"]},
    ]}]
    rows = catalog.expand_manifests(catalog.read_manifests(spark, one)).orderBy("file_pos", "format_pos").collect()
    assert [(r.name, r.format) for r in rows] == [
        ("a", "tsv"), ("a", "fgb"), ("a", "tsv"), ("b", "tsv"), ("b", "tsv"), ("c", "parquet"),
    ]
    assert {r.file_location for r in rows} == {"release"}
    bad = [{"group": "g", "format": ["shp"], "files": [{"name": "a"}]}]
    with pytest.raises(Exception, match="No such format in the catalog: shp"):
        catalog.expand_manifests(catalog.read_manifests(spark, bad)).collect()


def test_addresses_follow_the_location(spark, assets):
    urls = {r.file: r.url for r in assets.collect()}
    assert urls["harbours_berths.tsv"] == "https://example.org/raw/v9/harbours/files/harbours_berths.tsv"
    assert urls["trails_huts_wkb.arrows"] == "https://example.org/releases/v9/trails_huts_wkb.arrows"
    odd = [{"group": "g", "file_location": "moon", "format": ["tsv"], "files": [{"name": "a"}]}]
    expanded = catalog.expand_manifests(catalog.read_manifests(spark, odd))
    with pytest.raises(Exception, match="kept at: moon"):
        catalog.with_paths(expanded, *BASES).collect()
    assert catalog.only_location(assets, "release").select("group").distinct().count() == 1


def test_names_parse_back(assets):
    parsed = catalog.check_paths(assets.select(F.col("path"), F.struct("group", "name", "format").alias("want")), "path")
    same = F.struct("group", "name", "format") == F.col("want")
    assert parsed.filter(F.col("error").isNotNull() | ~same).isEmpty()


@pytest.mark.parametrize(
    "path, error",
    [
        ("docks/files/docks_point.tsv", None),
        ("docks/files/Docks_point.tsv", "name does not follow the pattern"),
        ("docks/files/docks_point.csv", "ending belongs to no format"),
        ("docks/data/docks_point.tsv", "folder above it is not files"),
        ("other/files/docks_point.tsv", "outside the folder of its group"),
        ("docks_point.tsv", "folder above it is not files"),
    ],
)
def test_wrong_paths(spark, path, error):
    row = catalog.check_paths(spark.createDataFrame([(path,)], "path string"), "path").first()
    assert row.error == error


def test_files_found_and_hidden_skipped(spark, assets, tmp_path):
    (tmp_path / "harbours" / "files").mkdir(parents=True)
    for name in ("harbours_berths.tsv", ".hidden.tsv", "harbours_new.tsv"):
        (tmp_path / "harbours" / "files" / name).write_text("geometry\n")
    present = catalog.list_assets(spark, str(tmp_path))
    assert sorted((r.file, r.length) for r in present.collect()) == [("harbours_berths.tsv", 9), ("harbours_new.tsv", 9)]
    assert "content" not in present._jdf.queryExecution().executedPlan().toString()
    status = {r.file: r.status for r in compare.completeness(assets, present, "file").collect()}
    assert status["harbours_new.tsv"] == "undeclared" and "harbours_berths.tsv" not in status
    assert sum(s == "missing" for s in status.values()) == FILES - 1


def test_published_list_reads_back(spark, assets, tmp_path):
    path = f"{tmp_path}/manifest.json"
    catalog.write_manifest_json(assets, path, "v9", GROUPS)
    (text,) = [r.value for r in spark.read.text(path, wholetext=True).collect()]
    doc = json.loads(text)
    assert doc["ref"] == "v9" and [g["name"] for g in doc["groups"]] == GROUPS
    assert [list(f) for f in doc["groups"][0]["files"]][0] == ["name", "format", "url"]
    back = catalog.read_manifest_json(spark, path)
    want = assets.select("group", "name", "format", "url")
    assert compare.tables_equal(want, back.select("group", "name", "format", "url"))
    wide = catalog.unnest_manifest(spark.read.schema(catalog.MANIFEST_JSON_SCHEMA).json(path, multiLine=True))
    assert wide.columns == ["ref", "name", "files_name", "files_format", "files_url"] and wide.count() == FILES
    wkb = catalog.only_format(back, "arrows/wkb").select("name", "group")
    assert wkb.filter("group = 'harbours'").count() == 3


def pages_of(listed):
    """The text of each group from its lines."""
    lines = catalog.listing_lines(listed).orderBy("group_at", "group", "tag_at", "tag", "at").collect()
    out = {}
    for r in lines:
        out.setdefault(r.group, []).append(r.line)
    return {group: "\n".join(found) for group, found in out.items()}


def test_listing_by_group(listed):
    pages = pages_of(listed)
    assert list(pages) == GROUPS
    text = pages["harbours-crs"]
    assert text.startswith("## Files\n\n- gate-utm ([arrows/wkb](https://example.org/raw/v9/harbours-crs/files/")
    assert text.splitlines()[-1].startswith("- gate-wkt2 ([arrows/wkb](")
    assert len(re.findall(r"\]\(", "".join(pages.values()))) == FILES


def test_tags_of_a_group_are_parted(listed):
    two = listed.withColumn("tag", F.when(F.col("name") == "paths", "v8").otherwise("v9"))
    text = pages_of(two)["trails"]
    assert text.count("## Files\n") == 2 and "\n\n## Files\n\n- huts (" in text and text.index("- paths") < text.index("- huts")


def test_listing_is_written_by_group(spark, listed, tmp_path):
    catalog.write_listing(listed, f"{tmp_path}/pages")
    back = spark.read.text(f"{tmp_path}/pages/group=trails", wholetext=True).first().value
    assert back == pages_of(listed)["trails"] + "\n"


def test_groups_in_order_of_first_appearance(listed):
    rows = ordering.first_appearance(listed, ["group"], "ordinal").orderBy("ordinal").collect()
    assert [r.group for r in rows] == GROUPS


def test_selections_by_name(assets):
    names = catalog.only_format(assets, "arrows/wkb").select(
        catalog.base_name(F.col("file"), "_wkb.arrows").alias("base")
    )
    small = catalog.without_names(names, "base", ["wkt2"], "trails", "trails_huts")
    kept = {r.base for r in small.collect()}
    assert kept == {"harbours_berths", "harbours_piers-z", "harbours_buoys", "harbours-crs_gate-utm", "trails_huts"}
    sized = names.select("base", catalog.size_compression(F.col("base"), ["trails", "harbours-"]).alias("c"))
    assert {r.base.split("_")[0] for r in sized.filter("c = 'zstd'").collect()} == {"trails", "harbours-crs"}
    assert catalog.keep_keys(assets, "group", ["trails"]).count() == 9


def test_large_manifests_are_expanded_by_many_tasks(spark, sf, monkeypatch):
    whole = catalog.expand_manifests(fixtures.manifests(spark, sf))
    monkeypatch.setattr(fixtures, "PARTS_PER_TASK", 20)
    dealt = catalog.expand_manifests(fixtures.manifests(spark, sf))
    counts = dealt.groupBy(F.spark_partition_id()).count().collect()
    assert len(counts) >= 8 and max(r["count"] for r in counts) < whole.count() // 2
    assert compare.tables_equal(whole, dealt)


@pytest.mark.parametrize("name", ["asset_files", "asset_diff", "asset_listing"])
def test_asset_queries_give_the_same_from_dealt_parts(spark, sf, monkeypatch, name):
    run = contract.queries()[name]
    want = run(spark, sf)
    monkeypatch.setattr(fixtures, "PARTS_PER_TASK", 20)
    assert compare.tables_equal(want, run(spark, sf))


def test_listings_broadcast_their_tags_and_no_lines(spark, listed):
    plan = catalog.listing_lines(listed)._jdf.queryExecution().executedPlan().toString()
    build = [b for b in re.findall(r"BroadcastExchange.*?(?=BroadcastExchange|$)", plan, re.S)]
    assert len(build) == 1 and "collect_list" not in build[0].split("Scan parquet")[0]


@pytest.mark.parametrize("size", [90, 32 << 20])
def test_object_in_parts_is_numbered_without_sorting_its_lines(spark, tmp_path, size):
    groups = ['a"],"files":[', "b\\", "{c", "dé"]
    rows = [(g, f'n"{g}-{i}', "tsv", f"u{i}", i, 0) for g in groups for i in range(60)]
    listed = spark.createDataFrame(rows, "group string, name string, format string, url string, file_pos int, format_pos int")
    path = f"{tmp_path}/object.json"
    whole = catalog.manifest_object_lines(listed, 'v"9', groups)
    order = ["group_pos", "step", "file_pos", "format_pos"]
    # Parts that may end anywhere, one of them empty.
    texts = [r.line for r in whole.orderBy(*order).collect()]
    (tmp_path / "object.json").mkdir()
    for i, (low, high) in enumerate([(0, 1), (1, 70), (70, 70), (70, 130), (130, len(texts))]):
        (tmp_path / "object.json" / f"part-{i:05d}.txt").write_text("".join(t + "\n" for t in texts[low:high]), encoding="utf-8")
    assert [g["name"] for g in json.loads("".join(texts))["groups"]] == groups
    back = catalog.read_manifest_json(spark, path, size)
    want = [('v"9', groups.index(g), pos, g, n, f, u) for g, n, f, u, pos, _ in rows]
    assert sorted(tuple(r) for r in back.collect()) == sorted(want)
    plan = back._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan.split("MapInArrow")[0] and "Sort" not in plan
