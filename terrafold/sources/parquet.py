"""Parquet with a ``geo`` footer: read by Spark's own scan, written with footer and row groups."""

from __future__ import annotations

import dataclasses
import json

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource

from ..functions.coords import make_box
from ..functions.crs import footer_crs
from ..functions.types import GEOMETRY, NESTING, GeometryTag, geometry_tag, tagged, type_label
from ..functions.wkb import box_rows, split_code, type_codes
from ..operators.columns import as_encoding, geometry_last
from .files import TAG_KEY, GeometryFileWriter
from .shared import data_paths, list_files, open_fs

# Versions of the footer with WKB only and with native encodings.
FOOTER_VERSIONS = {"wkb": "1.0.0", "native": "1.1.0"}


def _min(old, new):
    return float(new) if old is None else min(old, float(new))


def _max(old, new):
    return float(new) if old is None else max(old, float(new))


class GeoParquetWriter(GeometryFileWriter):
    """Each file's footer describes its own rows, gathered while they pass by."""

    suffix = ".parquet"

    def __init__(self, schema, options, overwrite):
        super().__init__(schema, options, overwrite)
        self.geo = str(options.get("geo_metadata", "true")).lower() == "true"
        tag = self.tags[GEOMETRY]
        self.crs = footer_crs(tag.crs, tag.crs_type) if self.geo else None

    def open_sink(self, handle, schema):
        compression = "none" if self.compression in ("none", "uncompressed") else self.compression
        return pq.ParquetWriter(handle, schema, compression=compression)

    def write_rows(self, sink, table):
        sink.write_table(table.combine_chunks(), row_group_size=self.rows)

    def group_bound(self, table):
        return _encoded_bound(table)

    def footer_bound(self, table, groups):
        leaves = sum(_leaves(f.type) for f in table.schema)
        # Statistics hold a least and a greatest value of up to 4 KiB.
        variable = sum(c.type in (pa.binary(), pa.string()) for c in table.schema)
        stated = len(json.dumps(self.crs or {})) + 2 * len(table.schema.serialize().to_pybytes())
        return stated + 2048 + 256 * leaves + groups * (64 + 384 * leaves + 8192 * variable)

    def observe(self, state, geometry):
        tag = self.tags[GEOMETRY]
        if not self.geo:
            return
        facts = _native_facts(geometry, tag) if tag.encoding == "native" else _wkb_facts(geometry)
        low, high, kinds = facts
        state.setdefault("kinds", set()).update(kinds)
        for name, pick, values in (("low", _min, low), ("high", _max, high)):
            old = state.get(name) or [None] * len(values)
            state[name] = [o if np.isnan(v) else pick(o, v) for o, v in zip(old, values)]

    def finish(self, sink, state):
        if self.geo:
            tag = self.tags[GEOMETRY]
            wkb = self.encode or tag.encoding == "wkb"
            column = {
                "encoding": "WKB" if wkb else tag.kind,
                "geometry_types": sorted(state.get("kinds", ())),
                "crs": self.crs,
            }
            if tag.edges is not None:
                # Vertices do not bound spherical edges, so such a file states no bbox.
                column["edges"] = tag.edges
            elif state.get("low") and None not in state["low"]:
                column["bbox"] = state["low"] + state["high"]
            footer = {
                "version": FOOTER_VERSIONS["wkb" if wkb else "native"],
                "primary_column": GEOMETRY,
                "columns": {GEOMETRY: column},
            }
            sink.add_key_value_metadata({"geo": json.dumps(footer)})
        sink.close()


def _leaves(kind: pa.DataType) -> int:
    """Columns that a type takes in a file."""
    if pa.types.is_struct(kind):
        return sum(_leaves(f.type) for f in kind)
    if pa.types.is_list(kind) or pa.types.is_large_list(kind) or pa.types.is_fixed_size_list(kind):
        return _leaves(kind.value_type)
    return 1


def _encoded_bound(table: pa.Table) -> int:
    """Bytes a row group cannot exceed: a dictionary beside the values, levels, page and chunk headers."""
    leaves = sum(_leaves(f.type) for f in table.schema)
    # A value of a nested column has at least four bytes here; its levels have at most two bytes.
    return table.nbytes * 2 + 2 * table.num_rows * leaves + 16384 * leaves


def _limits(values: np.ndarray) -> tuple[float, float]:
    values = values[~np.isnan(values)]
    return (values.min(), values.max()) if len(values) else (np.nan, np.nan)


def _native_facts(arr: pa.Array, tag: GeometryTag):
    kinds = {type_label(tag.kind, tag.dims)} if arr.null_count < len(arr) else set()
    valid = arr.drop_null()
    for _ in range(NESTING[tag.kind]):
        valid = valid.flatten()
    pairs = [
        _limits(valid.field(d).to_numpy(zero_copy_only=False))
        for d in tag.dims
        if d != "m"
    ]
    return [p[0] for p in pairs], [p[1] for p in pairs], kinds


def _wkb_facts(arr: pa.Array):
    kept = arr.drop_null()
    kinds = {type_label(*split_code(int(c))) for c in np.unique(type_codes(kept))} if len(kept) else set()
    boxes = box_rows(kept)
    low = [_limits(boxes[:, i])[0] for i in (0, 1)]
    high = [_limits(boxes[:, i])[1] for i in (2, 3)]
    return low, high, kinds


class GeoParquet(DataSource):
    """Write side only; reading goes through Spark's vectorised Parquet scan."""

    @classmethod
    def name(cls):
        return "geo_parquet"

    def writer(self, schema, overwrite):
        return GeoParquetWriter(schema, self.options, overwrite)


def write_geo(
    df: DataFrame, path: str, encoding: str = "wkb", compression: str = "zstd",
    row_group_rows: int = 100_000, overwrite: bool = False, geo_metadata: bool = True,
    **options: str,
) -> None:
    """Files of each partition in the present order, geometry last, each with its ``geo`` footer.

    ``options`` are those of GeometryFileWriter: ``max_file_bytes``, ``row_group_bytes``,
    ``chunk_column``, ``versioned``.
    """
    df, options["encode_wkb"] = prepared(df, encoding)
    df = geometry_last(df)
    df.sparkSession.dataSource.register(GeoParquet)
    (
        df.write.format("geo_parquet")
        .mode("overwrite" if overwrite else "append")
        .options(
            compression=compression,
            row_group_rows=row_group_rows,
            geo_metadata=str(geo_metadata),
            **options,
        )
        .save(path)
    )


def prepared(df: DataFrame, encoding: str) -> tuple[DataFrame, bool]:
    """The table a sink takes for an encoding, and whether the sink itself encodes it as WKB."""
    tag = geometry_tag(df)
    if encoding == "wkb" and tag.kind in NESTING and tag.encoding in ("native", "box", "wkt"):
        return as_encoding(df, "native"), True
    return as_encoding(df, encoding), False


def read_footer(path: str) -> tuple[dict | None, pa.Schema]:
    """``geo`` object and Arrow schema of one file."""
    files, place = open_fs(path)
    with files.open_input_file(place) as raw:
        file = pq.ParquetFile(raw)
        schema, stored = file.schema_arrow, (file.metadata.metadata or {}).get(b"geo")
    return (json.loads(stored) if stored else None), schema


def tag_from_footer(geo: dict | None, schema: pa.Schema) -> GeometryTag | None:
    if GEOMETRY not in schema.names:
        return None
    field = schema.field(GEOMETRY)
    own = (field.metadata or {}).get(TAG_KEY)
    if own:
        return GeometryTag(**{"dims": None, **json.loads(own)})
    if geo is None:
        return None
    column = geo.get("columns", {}).get(geo.get("primary_column"), {})
    if "encoding" not in column:
        return None
    # A footer without the key means longitude/latitude; null means unknown.
    crs = column.get("crs", "OGC:CRS84")
    crs_type = {dict: "projjson", str: "authority_code"}.get(type(crs))
    extra = {"crs": crs, "crs_type": crs_type}
    if column.get("edges") == "spherical":
        extra["edges"] = "spherical"
    if column["encoding"] == "WKB":
        return GeometryTag("wkb", None, None, **extra)
    inner = field.type
    while pa.types.is_list(inner):
        inner = inner.value_type
    return GeometryTag("native", column["encoding"], "".join(f.name for f in inner), **extra)


def read_geo(
    spark: SparkSession, path: str, keep_order: bool = False, on_conflict: str = "error"
) -> DataFrame:
    """Files, folder or glob as one table, with the tag that all footers agree on.

    Of an output with versions the current one is read. Where footers differ in more than what a
    mixed column may, ``on_conflict`` says what happens: "error", or "majority" for the value
    that most files state; ``footer_differences`` lists the others. With ``keep_order`` the columns
    file_name and row_index say where a row stands.
    """
    if on_conflict not in ("error", "majority"):
        raise ValueError(f"Conflicts are an error or settled by majority, not {on_conflict!r}")
    paths = data_paths(path)
    # A version without files has no schema to read.
    df = spark.read.parquet(*paths)
    tag, conflicts = merged_tag(spark, [(p, 0) for p in df.inputFiles()])
    if conflicts and on_conflict == "error":
        raise ValueError(f"Files of {path} differ in " + "; ".join(conflicts))
    columns = [
        tagged(F.col(c), tag) if c == GEOMETRY and tag is not None else F.col(c)
        for c in df.columns
    ]
    if keep_order:
        columns = [
            F.col("_metadata.file_name").alias("file_name"),
            F.col("_metadata.row_index").alias("row_index"),
            *columns,
        ]
    return df.select(*columns)


FOOTER_SCHEMA = (
    "path string, length bigint, geo string, columns array<string>, geometry_type string, tag string, "
    "rows bigint, group_rows array<bigint>"
)


def footers(spark: SparkSession, path: str) -> DataFrame:
    """Footer of every file: geo, tag, column names, type of the geometry column, rows of its row groups."""
    return _footers_of(spark, list_files(path, (".parquet",)))


def _footers_of(spark: SparkSession, listed: list[tuple[str, int]]) -> DataFrame:
    spread = spark.createDataFrame(listed, "path string, length bigint")

    def read(batches):
        for batch in batches:
            rows = [
                {"path": p, "length": size, **_facts(p)}
                for p, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            ]
            yield pa.RecordBatch.from_pylist(rows, _FOOTER_ARROW)

    return spread.mapInArrow(read, FOOTER_SCHEMA)


_FOOTER_ARROW = pa.schema(
    [
        ("path", pa.string()), ("length", pa.int64()), ("geo", pa.string()), ("columns", pa.list_(pa.string())),
        ("geometry_type", pa.string()), ("tag", pa.string()), ("rows", pa.int64()), ("group_rows", pa.list_(pa.int64())),
    ]
)


def _facts(path: str) -> dict:
    files, place = open_fs(path)
    with files.open_input_file(place) as raw:
        file = pq.ParquetFile(raw)
        schema, stored = file.schema_arrow, (file.metadata.metadata or {}).get(b"geo")
        groups = [file.metadata.row_group(i).num_rows for i in range(file.metadata.num_row_groups)]
    geo = json.loads(stored) if stored else None
    tag = tag_from_footer(geo, schema)
    return {
        "geo": None if geo is None else json.dumps(geo),
        "columns": schema.names,
        "geometry_type": str(schema.field(GEOMETRY).type) if GEOMETRY in schema.names else None,
        "tag": None if tag is None else json.dumps(tag.__dict__),
        "rows": sum(groups),
        "group_rows": groups,
    }


def _stated(footer: DataFrame) -> DataFrame:
    """(path, rows, property, value): what each footer says of the column, values as JSON text."""
    values = [
        F.struct(F.lit(name).alias("property"), F.get_json_object("tag", f"$.{name}").alias("value"))
        for name in TAG_PROPERTIES
    ]
    untagged = F.struct(F.lit("tag").alias("property"), F.when(F.col("tag").isNull(), "none").otherwise("there").alias("value"))
    return footer.select("path", "rows", F.explode(F.array(untagged, *values)).alias("s")).select("path", "rows", "s.*")


TAG_PROPERTIES = [f.name for f in dataclasses.fields(GeometryTag)]


def _majority(stated: DataFrame, places: int) -> list[Row]:
    """The values of each property that most files state; equal counts by the value's text."""
    counted = stated.groupBy("property", "value").agg(F.count("*").alias("files"), F.min("path").alias("example"))
    place = F.row_number().over(Window.partitionBy("property").orderBy(F.desc("files"), "value"))
    return counted.withColumn("place", place).filter(F.col("place") <= places).orderBy("property", "place").collect()


def merged_tag(spark: SparkSession, listed: list[tuple[str, int]]) -> tuple[GeometryTag | None, list[str]]:
    """The tag of many files and what they differ in.

    Executors read the footers and count the values of each property; the driver gets two values
    a property at most. Types and dimensions may differ where each value states its own
    (WKB and WKT): such a column is mixed.
    """
    if len(listed) < 2:
        return (tag_from_footer(*read_footer(listed[0][0])) if listed else None), []
    found: dict[str, list[Row]] = {}
    for row in _majority(_stated(_footers_of(spark, listed)), 2):
        found.setdefault(row["property"], []).append(row)
    chosen, conflicts = {}, []
    mixed = found["encoding"][0]["value"] in ("wkb", "wkt")
    for name, rows in found.items():
        value = rows[0]["value"]
        if len(rows) > 1 and name in ("kind", "dims") and mixed:
            value = None
        elif len(rows) > 1:
            other = rows[1]
            conflicts.append(f"{name}: {value} in {rows[0]['files']}, {other['value']} in {other['files']} ({other['example']})")
        chosen[name] = value
    if chosen.pop("tag") == "none":
        return None, conflicts
    if all(len(rows) == 1 for rows in found.values()):
        return tag_from_footer(*read_footer(listed[0][0])), []
    if chosen["crs_type"] == "projjson" and chosen["crs"] is not None:
        chosen["crs"] = json.loads(chosen["crs"])
    return GeometryTag(**chosen), conflicts


def footer_differences(spark: SparkSession, path: str) -> DataFrame:
    """(path, rows, property, found, expected): every file's departures from what most files state."""
    stated = _stated(footers(spark, path))
    expected = F.lit(None).cast("string")
    # One literal for each property.
    for row in _majority(stated, 1):
        expected = F.when(F.col("property") == row["property"], F.lit(row["value"])).otherwise(expected)
    rows = stated.select("path", "rows", "property", F.col("value").alias("found"), expected.alias("expected"))
    return rows.filter(~F.col("found").eqNullSafe(F.col("expected")))


def extent_of_files(spark: SparkSession, path: str) -> DataFrame:
    """Total bounds of a layer from its footers: one row, one box, no data page read.

    Saves the scan that clustering a written layer again would begin with; pass
    ``extent_of_files(...).scalar()`` as its extent. A file that states no bounds but has
    rows is an error, since the total would miss it.
    """
    column = F.get_json_object("geo", f"$.columns.{GEOMETRY}")
    listed = footers(spark, path).select(
        "path",
        F.from_json(F.get_json_object(column, "$.bbox"), "array<double>").alias("b"),
        F.from_json(F.get_json_object(column, "$.geometry_types"), "array<string>").alias("kinds"),
    )
    missing = F.raise_error(F.concat(F.lit("No bounds in the footer of "), F.col("path")))
    # Only null rows leave both lists empty.
    bounds = F.when(F.col("b").isNull() & ~F.size("kinds").eqNullSafe(F.lit(0)), missing.cast("array<double>")).otherwise(F.col("b"))
    half = F.size("b") / 2
    rows = listed.select(bounds.alias("b")).select("b", half.cast("int").alias("half"))
    total = rows.agg(
        F.min(F.col("b")[0]).alias("xmin"), F.min(F.col("b")[1]).alias("ymin"),
        F.max(F.col("b")[F.col("half")]).alias("xmax"), F.max(F.col("b")[F.col("half") + 1]).alias("ymax"),
    )
    return total.select(make_box(*[F.col(c) for c in total.columns]).alias("extent"))
