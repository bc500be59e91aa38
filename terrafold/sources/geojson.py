"""GeoJSON features from line-delimited files, feature collections and zip archives, damaged ones told apart."""

from __future__ import annotations

import codecs
import itertools
import json
import re
import zipfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.coords import coord_struct, map_coords
from ..functions.types import GEOMETRY, NESTING, TYPE_NAMES, GeometryTag, geometry_tag, tagged
from .json_ranges import RANGE_BYTES, json_members, sized, text_lines
from .shared import materialized, open_fs

LINE_SUFFIXES = (".geojsonl", ".ndjson", ".jsonl")
# Lines of a collection around its features: they begin with a key or a bracket, or open the collection.
FRAME_LINE = r'^\s*("|\[|\]|\}|\{\s*$|\{.*"FeatureCollection")'
_CHUNK = 1 << 20
_ROWS = 2000
_FEATURES = re.compile(r'"features"\s*:\s*\[')


class FeatureFile(InputPartition):
    def __init__(self, path: str):
        self.path = path


def feature_texts(stream):
    """Text of each member of ``features``, holding one chunk and one feature at a time."""
    decode = codecs.getincrementaldecoder("utf-8")()
    scan = json.JSONDecoder().raw_decode
    text, at, inside, chunk = "", 0, False, _CHUNK
    while True:
        raw = stream.read(chunk)
        text = text[at:] + decode.decode(raw, final=not raw)
        at = 0
        if not inside:
            start = _FEATURES.search(text)
            if start:
                at, inside = start.end(), True
        while inside:
            while at < len(text) and text[at] in " \t\r\n,":
                at += 1
            if at < len(text) and text[at] == "]":
                return
            try:
                _, end = scan(text, at)
            except json.JSONDecodeError:
                # Incomplete so far; larger reads keep the rescans of a huge feature few.
                chunk = max(_CHUNK, len(text) - at)
                break
            yield text[at:end]
            at, chunk = end, _CHUNK
        if not raw:
            raise ValueError("Feature collection ends before its list of features does")


class FeatureReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self):
        return [FeatureFile(p) for p in self.path.split(",")]

    def read(self, partition):
        files, place = open_fs(partition.path)
        with files.open_input_file(place) as raw, zipfile.ZipFile(raw) as archive:
            # The first member is the data.
            with archive.open(archive.namelist()[0]) as member:
                texts = enumerate(feature_texts(member))
                while rows := list(itertools.islice(texts, _ROWS)):
                    columns = [[partition.path] * len(rows), [at for at, _ in rows], [text for _, text in rows]]
                    kinds = (pa.string(), pa.int64(), pa.string())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(columns, kinds)], ["path", "at", "feature"]
                    )


class FeatureSource(DataSource):
    """One archive per partition."""

    @classmethod
    def name(cls):
        return "geojson_features"

    def schema(self):
        return "path string, at bigint, feature string"

    def reader(self, schema):
        return FeatureReader(self.options["path"])


def feature_rows(
    spark: SparkSession, paths: str | list[str], feature_per_line: bool = False, range_bytes: int = RANGE_BYTES, exact: bool = True
) -> DataFrame:
    """(path, at, feature): the text of every feature, with the byte it begins at in its file.

    Without ``exact`` the scan of Spark reads lines, which is faster, and ``at`` is where a line's split begins.

    Files are read by ranges, whether they have a feature a line or are one collection; a
    collection with each feature on a line of its own is read by lines if ``feature_per_line`` says so, and
    the lines around its features, which are no JSON by themselves, are left out. Archives are streamed, one per
    task, since compressed members cannot be entered midway; there ``at`` counts features.
    """
    paths = [paths] if isinstance(paths, str) else paths
    listed = sized(paths, (".zip", "json", *LINE_SUFFIXES)) if not feature_per_line else sized(paths, ("",))
    zipped = [p for p, _ in listed if p.endswith(".zip")]
    plain = [f for f in listed if not f[0].endswith(".zip")]
    parts = []
    by_line = feature_per_line or all(p.rstrip("/").endswith(LINE_SUFFIXES) for p in paths)
    lines = plain if by_line else [f for f in plain if f[0].endswith(LINE_SUFFIXES)]
    if by_line and not zipped and not lines:
        # A folder named like a file of lines: its parts may have any name.
        lines = sized(paths, ("",))
    if lines:
        if exact:
            text = text_lines(spark, lines, range_bytes)
        else:
            scanned = spark.read.text([p for p, _ in lines])
            text = scanned.select(
                F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"), F.col("value").alias("line")
            )
        feature = F.regexp_replace("line", r"\s*,?\s*$", "")
        kept = F.trim("line") != ""
        if feature_per_line:
            kept = kept & ~F.col("line").rlike(FRAME_LINE)
        parts.append(text.filter(kept).select("path", "at", feature.alias("feature")))
    if not by_line and (whole := [f for f in plain if f not in lines]):
        parts.append(json_members(spark, whole, "features", range_bytes).select("path", "at", F.col("member").alias("feature")))
    if zipped:
        spark.dataSource.register(FeatureSource)
        parts.append(spark.read.format("geojson_features").load(",".join(zipped)))
    if not parts:
        raise ValueError(f"No features in {', '.join(paths)}")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def judged(features: DataFrame, kind: str = "polygon", dims: str = "xy") -> DataFrame:
    """(path, at, feature, properties, geometry, cause): ``cause`` says what is wrong with a record, null if nothing.

    In this order: it is no JSON; its type is not Feature; its geometry has another type, coordinates that are no numbers or
    not nested as the type asks, too few ordinates, or more ordinates than ``dims``. A null geometry is none.
    """
    nested: T.DataType = T.ArrayType(T.DoubleType())
    for _ in range(NESTING[kind]):
        nested = T.ArrayType(nested)
    text = F.col("feature")
    shape = F.get_json_object(text, "$.geometry")
    numbers = F.get_json_object(shape, "$.coordinates")
    rows = features.select(
        "path", "at", "feature",
        F.try_parse_json(text).isNull().alias("__torn"),
        F.get_json_object(text, "$.type").alias("__type"),
        F.get_json_object(text, "$.properties").alias("properties"),
        shape.alias("__shape"),
        F.get_json_object(shape, "$.type").alias("__kind"),
        F.when(numbers.isNotNull(), F.from_json(F.concat(F.lit('{"c":'), numbers, F.lit("}")), T.StructType([T.StructField("c", nested)]))["c"]).alias("__c"),
    )

    def every(value: Column, depth: int, rule) -> Column:
        if depth == 0:
            return F.coalesce(rule(value), F.lit(False))
        return F.coalesce(F.forall(value, lambda v: every(v, depth - 1, rule)), F.lit(False))

    wanted, depth = TYPE_NAMES[kind], NESTING[kind]
    solid = every(F.col("__c"), depth, lambda c: F.forall(c, lambda v: v.isNotNull()))
    least = every(F.col("__c"), depth, lambda c: F.size(c) >= len(dims))
    most = every(F.col("__c"), depth, lambda c: F.size(c) <= len(dims))
    present = F.col("__shape").isNotNull()
    cause = (
        F.when(F.col("__torn"), "no JSON")
        .when(~F.col("__type").eqNullSafe("Feature"), "no feature")
        .when(present & ~F.col("__kind").eqNullSafe(wanted), F.concat(F.lit(f"Not a {wanted}: "), F.coalesce("__kind", F.lit("no type"))))
        .when(present & ~solid, "coordinates")
        .when(present & ~least, "too few ordinates")
        .when(present & ~most, "extra ordinates")
    )
    value = map_coords(F.col("__c"), kind, lambda c: coord_struct({d: F.get(c, F.lit(i)) for i, d in enumerate(dims)}))
    tag = GeometryTag("native", kind, dims, crs="OGC:CRS84", crs_type="authority_code")
    rows = rows.withColumn("cause", cause)
    return rows.select(
        "path", "at", "feature", "properties", tagged(F.when(F.col("cause").isNull() & present, value), tag, GEOMETRY), "cause"
    )


def read_geojson(
    spark: SparkSession, paths: str | list[str], kind: str = "polygon", dims: str = "xy",
    feature_per_line: bool = False, rebalance: bool = False, range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """Features as (properties, geometry); properties stay JSON text.

    A damaged record is an error that names its place, of a line the split it is in; ``split_geojson`` sets such
    records aside instead. ``rebalance`` evens out the features, so a huge archive holds up only its scan.
    """
    features = feature_rows(spark, paths, feature_per_line, range_bytes, exact=False)
    if rebalance:
        features = features.hint("rebalance")
    rows = judged(features, kind, dims)
    place = F.format_string("%s (%s, at %d)", "cause", "path", "at")
    checked = F.when(F.col("cause").isNotNull(), F.raise_error(place).cast(rows.schema[GEOMETRY].dataType)).otherwise(F.col(GEOMETRY))
    return rows.select("properties", tagged(checked, geometry_tag(rows)))


def split_geojson(
    spark: SparkSession, paths: str | list[str], kind: str = "polygon", dims: str = "xy",
    feature_per_line: bool = False, range_bytes: int = RANGE_BYTES,
) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """Features, damaged records (path, at, cause, feature), and how many there are of both.

    One pass over the files: every record is judged once and written once to the shared folder, and
    the counts are observed as that write runs.
    """
    watch = Observation()
    rows = judged(feature_rows(spark, paths, feature_per_line, range_bytes), kind, dims)
    rows = rows.withColumn("feature", F.when(F.col("cause").isNotNull(), F.col("feature")))
    rows = rows.observe(watch, F.count_if(F.col("cause").isNull()).alias("features"), F.count_if(F.col("cause").isNotNull()).alias("damaged"))
    kept = materialized(rows, "features")
    good = kept.filter(F.col("cause").isNull()).select("properties", tagged(F.col(GEOMETRY), geometry_tag(rows)))
    return good, kept.filter(F.col("cause").isNotNull()).select("path", "at", "cause", "feature"), watch.get
