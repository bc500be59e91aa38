"""Structural checks. Each gives a table of violations (subject, rule, detail); none is good."""

from __future__ import annotations

import json
import zipfile
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.types import BOX_FIELDS, BOX_TYPE, DIMENSIONS, GEOMETRY, geometry_tag
from ..functions.wkb import wkb_type
from ..operators.columns import storage_matches
from ..operators.compare import completeness
from ..operators.ordering import with_running
from ..sources.arrow_stream import SUFFIX, stream_schema
from ..sources.files import EXTENSION_METADATA, EXTENSION_NAME, SIZE_LIMIT
from ..sources.json_ranges import lines_of
from ..sources.parquet import footers, read_footer
from ..sources.shared import list_files, materialized, open_fs
from ..sources.text import HEADER

# Fixed value: the first bytes of the binary feature format.
FEATURE_MAGIC = b"\x66\x67\x62\x03\x66\x67\x62\x00"

VIOLATION = "subject string, rule string, detail string"


def _violations(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, VIOLATION)


def _checks(df: DataFrame, subject: str, rules: list[tuple[str, Column, Column]]) -> DataFrame:
    """All rules in one pass: a row becomes as many violations as rules it breaks."""
    broken = F.array(
        *[
            F.when(~F.coalesce(ok, F.lit(False)), F.struct(F.lit(rule).alias("rule"), detail.cast("string").alias("detail")))
            for rule, ok, detail in rules
        ]
    )
    found = df.select(
        F.col(subject).cast("string").alias("subject"),
        F.explode(F.array_compact(broken)).alias("v"),
    )
    return found.select("subject", "v.rule", "v.detail")


def check_sizes(files: DataFrame) -> DataFrame:
    """``files`` has path and length."""
    ok = F.col("length") <= SIZE_LIMIT
    return _checks(files, "path", [("size", ok, F.col("length"))])


def check_completeness(declared: DataFrame, present: DataFrame, key: str = "file") -> DataFrame:
    found = completeness(declared, present, key)
    return found.select(F.col(key).alias("subject"), F.col("status").alias("rule"), F.lit(None).cast("string").alias("detail"))


def schema_problems(schema: pa.Schema, prefix: str) -> list[tuple[str, str]]:
    """Rules on the geometry field of a stream file."""
    if GEOMETRY not in schema.names:
        return [("geometry missing", ", ".join(schema.names))]
    out = []
    if schema.names[-1] != GEOMETRY:
        out.append(("geometry not last", ", ".join(schema.names)))
    metadata = schema.field(GEOMETRY).metadata or {}
    if not metadata.get(EXTENSION_NAME, b"").startswith(prefix.encode() + b"."):
        out.append(("extension name", str(metadata.get(EXTENSION_NAME))))
    try:
        described = json.loads(metadata.get(EXTENSION_METADATA, b""))
    except json.JSONDecodeError:
        described = None
    if not isinstance(described, dict):
        out.append(("extension metadata", str(metadata.get(EXTENSION_METADATA))))
    return out


def storage_problems(kind: pa.DataType, fmt: str) -> list[tuple[str, str]]:
    """Rules on the storage type by format."""
    if fmt in ("arrows/wkb", "geoparquet", "parquet"):
        return [] if pa.types.is_binary(kind) else [("wkb is binary", str(kind))]
    if fmt == "arrows/wkt":
        return [] if pa.types.is_string(kind) else [("wkt is text", str(kind))]
    if fmt == "arrows/box":
        box = pa.struct([pa.field(n, pa.float64(), False) for n in BOX_FIELDS])
        return [] if kind == box else [("box type", str(kind))]
    while pa.types.is_list(kind):
        kind = kind.value_type
    if fmt == "arrows/interleaved":
        ok = (
            pa.types.is_fixed_size_list(kind)
            and kind.value_field.name in DIMENSIONS
            and kind.list_size == len(kind.value_field.name)
            and pa.types.is_float64(kind.value_type)
        )
    elif fmt in ("arrows", "geoparquet/native"):
        ok = (
            pa.types.is_struct(kind)
            and "".join(f.name for f in kind) in DIMENSIONS
            and all(pa.types.is_float64(f.type) for f in kind)
        )
    else:
        raise ValueError(f"No storage rule for format {fmt}")
    return [] if ok else [("native type", str(kind))]


def check_streams(spark: SparkSession, path: str, fmt: str, prefix: str = "geometry") -> DataFrame:
    """Schema and full validation of every stream file, each in its own task."""
    found = list_files(path, (SUFFIX,))
    spread = spark.createDataFrame([(p,) for p, _ in found], "path string").repartition(
        max(len(found), 1)
    )

    def inspect(batches):
        for batch in batches:
            rows = []
            for p in batch.column(0).to_pylist():
                try:
                    problems = stream_problems(p, fmt, prefix)
                except (pa.ArrowException, OSError, EOFError) as error:
                    # One damaged file must not hide the state of the others.
                    problems = [("contents", str(error))]
                rows += [{"subject": p, "rule": r, "detail": d} for r, d in problems]
            yield pa.RecordBatch.from_pylist(rows, pa.schema([(n, pa.string()) for n in ("subject", "rule", "detail")]))

    return spread.mapInArrow(inspect, VIOLATION)


def check_geo_files(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """Footers and storage types of Parquet files. Executors read the footers, SQL checks them."""
    feet = footers(spark, path)
    keys = F.json_object_keys(F.get_json_object("geo", "$.columns"))
    column = F.get_json_object("geo", f"$.columns.{GEOMETRY}")
    crs = F.get_json_object(column, "$.crs")
    crs_ok = crs.isNull() | crs.startswith("{")
    rules = [
        ("geometry missing", F.array_contains("columns", GEOMETRY), F.array_join("columns", ", ")),
        ("geometry not last", F.element_at("columns", -1) == GEOMETRY, F.array_join("columns", ", ")),
        ("geo footer", F.col("geo").isNotNull(), F.lit(None)),
        ("primary column", F.get_json_object("geo", "$.primary_column") == GEOMETRY, F.col("geo")),
        ("single column", keys == F.array(F.lit(GEOMETRY)), F.col("geo")),
        ("encoding", F.get_json_object(column, "$.encoding").isNotNull(), F.col("geo")),
        ("geometry types", F.get_json_object(column, "$.geometry_types").isNotNull(), F.col("geo")),
        ("crs", crs_ok, crs),
    ]
    if fmt == "geoparquet":
        rules.append(("wkb is binary", F.col("geometry_type") == "binary", F.col("geometry_type")))
    else:
        # Lists of any depth around a struct of doubles named by the dimensions.
        named = "|".join(
            ", ".join(f"{d}: double" for d in dims) for dims in DIMENSIONS
        )
        native = rf"^(list<\w+: )*struct<({named})>(?:>)*$"
        rules.append(("native type", F.col("geometry_type").rlike(native), F.col("geometry_type")))
    return _checks(feet, "path", rules)


def check_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text files: first line, upper-case tags, at least one line. Files are split as usual."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("path"),
        (F.col("_metadata.file_block_start") == 0).alias("head_split"),
        F.monotonically_increasing_id().alias("n"),
        "value",
    )
    odd = F.col("value").rlike(r"\S") & ~F.col("value").rlike("^[A-Z]+")
    facts = lines.groupBy("path").agg(
        F.min_by("value", F.when(F.col("head_split"), F.col("n"))).alias("first"),
        F.count_if(odd).alias("odd"),
        (F.count("*") - 1).alias("rows"),
    )
    # Files without any line are listed too. The header is no bad line where it is the first.
    bare = F.regexp_replace("path", r"^file:/+", "/")
    names = [(name,) for name, _ in list_files(path, ("",))]
    listed = spark.createDataFrame(names, "path string").select(bare.alias("path"))
    facts = facts.withColumn("path", bare)
    facts = listed.join(facts, "path", "left").select(
        "path",
        F.coalesce("first", F.lit("")).alias("first"),
        (F.coalesce("odd", F.lit(0)) - F.when(F.col("first") == HEADER, 1).otherwise(0)).alias("bad"),
        F.coalesce("rows", F.lit(0)).alias("rows"),
    )
    rules = [
        ("header", F.col("first") == HEADER, F.col("first")),
        ("line tag", F.col("bad") == 0, F.col("bad")),
        ("no rows", F.col("rows") > 0, F.col("rows")),
    ]
    return _checks(facts, "path", rules)


def read_head(path: str, size: int) -> tuple[bytes, list[str] | None]:
    """First bytes of a file; of an archive, those of its first member, with the names of all."""
    files, place = open_fs(path)
    with files.open_input_file(place) as raw:
        if not path.endswith(".zip"):
            return raw.read(size), None
        names: list[str] = []
        try:
            with zipfile.ZipFile(raw) as archive:
                names = archive.namelist()
                if names:
                    with archive.open(names[0]) as member:
                        return member.read(size), names
        except (zipfile.BadZipFile, pa.ArrowException, OSError, EOFError, zlib.error):
            # No archive, or a cut one: it has no head the checks could accept.
            pass
        return b"", names


def probe_headers(spark: SparkSession, path: str, size: int = 8) -> DataFrame:
    """path, length and first bytes; for zip archives of the only member, with all member names."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    listed = listed.select("path", "length")

    def probe(batches):
        for batch in batches:
            found = [read_head(p, size) for p in batch.column(0).to_pylist()]
            heads, names = [h for h, _ in found], [n for _, n in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(heads, pa.binary()), pa.array(names, pa.list_(pa.string()))],
                ["path", "length", "head", "members"],
            )

    return listed.mapInArrow(probe, "path string, length bigint, head binary, members array<string>")


def check_magic(spark: SparkSession, path: str) -> DataFrame:
    """First bytes of feature files, plain or as the single member of an archive."""
    heads = probe_headers(spark, path, len(FEATURE_MAGIC))
    name = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.zip$", "")
    zipped = F.col("path").endswith(".zip")
    rules = [
        ("magic", F.hex("head") == FEATURE_MAGIC.hex().upper(), F.hex("head")),
        ("archive members", ~zipped | (F.col("members") == F.array(name)), F.array_join("members", ", ")),
    ]
    return _checks(heads, "path", rules)


def check_file(spark: SparkSession, path: str, fmt: str, prefix: str = "geometry") -> DataFrame:
    """The rules that belong to a format."""
    if fmt == "tsv":
        return check_lines(spark, path)
    if fmt in ("fgb", "fgb/zip"):
        return check_magic(spark, path)
    if fmt in ("geoparquet", "geoparquet/native"):
        return check_geo_files(spark, path, fmt)
    if fmt.startswith("arrows"):
        return check_streams(spark, path, fmt, prefix)
    if fmt == "parquet":
        return check_geo_files(spark, path, "geoparquet")
    raise ValueError(f"No check for format {fmt}")


#: Bytes of assets that one task checks, about, and of a range of a text file.
TASK_BYTES, LINE_RANGE = 64 << 20, 8 << 20
#: What opening a file costs, in bytes read.
OPEN_COST = 1 << 20

_UNITS = "asset string, format string, path string, size bigint, error string"
_FOUND = "subject string, rule string, detail string, n bigint"


def _found_batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = [("subject", pa.string()), ("rule", pa.string()), ("detail", pa.string()), ("n", pa.int64())]
    return pa.RecordBatch.from_pylist(rows, pa.schema(kinds))


def _listed(batches):
    """Every file of an asset with its size; an asset that is not there has a row with an error."""
    for batch in batches:
        rows = []
        for asset, fmt in zip(batch.column("path").to_pylist(), batch.column("format").to_pylist()):
            row = {"asset": asset, "format": fmt, "path": asset, "size": 0, "error": None}
            try:
                files = list_files(asset, ("",))
                rows += [{**row, "path": p, "size": size} for p, size in files]
                if not files:
                    rows.append({**row, "error": "no files"})
            except (pa.ArrowException, OSError, ValueError) as error:
                rows.append({**row, "error": str(error)})
        kinds = [(n, pa.int64() if n == "size" else pa.string()) for n in ("asset", "format", "path", "size", "error")]
        yield pa.RecordBatch.from_pylist(rows, pa.schema(kinds))


def footer_problems(path: str, fmt: str) -> list[tuple[str, str]]:
    """Rules on one Parquet file's footer."""
    geo, schema = read_footer(path)
    if GEOMETRY not in schema.names:
        return [("geometry missing", ", ".join(schema.names))]
    out = [] if schema.names[-1] == GEOMETRY else [("geometry not last", ", ".join(schema.names))]
    if geo is None:
        out.append(("geo footer", ""))
    else:
        column = geo.get("columns", {}).get(GEOMETRY, {})
        text = json.dumps(geo)
        if geo.get("primary_column") != GEOMETRY:
            out.append(("primary column", text))
        if list(geo.get("columns", {})) != [GEOMETRY]:
            out.append(("single column", text))
        out += [(rule, text) for rule, key in (("encoding", "encoding"), ("geometry types", "geometry_types")) if column.get(key) is None]
        if not isinstance(column.get("crs"), (dict, type(None))):
            out.append(("crs", json.dumps(column["crs"])))
    return out + storage_problems(schema.field(GEOMETRY).type, fmt)


def stream_problems(path: str, fmt: str, prefix: str) -> list[tuple[str, str]]:
    """Rules on one stream file, with full validation of every batch."""
    schema = stream_schema(path)
    out = schema_problems(schema, prefix)
    if GEOMETRY in schema.names:
        out += storage_problems(schema.field(GEOMETRY).type, fmt)
    files, place = open_fs(path)
    with files.open_input_stream(place) as raw, pa.ipc.open_stream(raw) as reader:
        # One batch at a time: a file need not fit in memory.
        for piece in reader:
            piece.validate(full=True)
    return out


def head_problems(path: str) -> list[tuple[str, str]]:
    head, members = read_head(path, len(FEATURE_MAGIC))
    out = [] if head == FEATURE_MAGIC else [("magic", head.hex().upper())]
    name = path.rpartition("/")[2].removesuffix(".zip")
    if members is not None and members != [name]:
        out.append(("archive members", ", ".join(members)))
    return out


def _odd(line: bytes) -> bool:
    return bool(line.strip()) and not b"A" <= line[:1] <= b"Z"


def line_facts(row: dict) -> list[dict]:
    """Violations and counts of one range of a text file; the ranges' counts are added up later."""
    odd = lines = 0
    out = []
    for at, line in lines_of(row):
        if at == 0:
            if line != HEADER.encode():
                out.append({"rule": "header", "detail": line.decode("utf-8", "replace"), "n": 1})
                odd += _odd(line)
            continue
        lines += 1
        odd += _odd(line)
    if row["size"] == 0:
        out.append({"rule": "header", "detail": "", "n": 1})
    return out + [{"rule": "line tag", "detail": None, "n": odd}, {"rule": "no rows", "detail": None, "n": lines}]


def check_assets(
    spark: SparkSession, assets: list[tuple[str, str]] | DataFrame, prefix: str = "geometry"
) -> DataFrame:
    """Violations of many (path, format) pairs, files or folders, in one table by one scan.

    Executors list the assets. Text files are cut into ranges, and files and ranges are packed into tasks by their
    bytes: a running sum over all of them says which task each belongs to. A task applies the rules of each row's
    format. A damaged, missing or unknown asset is a violation and hides no other. The plan has the same
    size for any number of assets.
    """
    if not isinstance(assets, DataFrame):
        assets = spark.createDataFrame(assets, "path string, format string")
    # A row for each file, written once: the sums and the checks must see the same files.
    files = materialized(assets.select("path", "format").mapInArrow(_listed, _UNITS), "assets")
    step = F.when(F.col("format") == "tsv", F.lit(LINE_RANGE)).otherwise(F.greatest("size", F.lit(1))).cast("long")
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("size") - 1, F.lit(0)), step)
    units = files.select("*", step.alias("step"), F.explode(starts).alias("begin"))
    units = units.select("asset", "format", "path", "size", "error", "begin", F.least(F.col("begin") + F.col("step"), "size").alias("end"))
    units = units.withColumn("cost", F.col("end") - F.col("begin") + OPEN_COST)
    total = units.agg(F.sum("cost")).first()[0] or 0
    packed = with_running(units, ["path", "begin", "asset", "format"], name="before", weight="cost")
    task = (F.col("before") / TASK_BYTES).cast("int")
    spread = packed.repartitionById(total // TASK_BYTES + 1, task)

    def inspect(batches):
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                rows += [{"subject": row["path"], **found} for found in _inspected(row, prefix)]
            yield _found_batch(rows)

    found = spread.select("format", "path", "size", "error", "begin", "end").mapInArrow(inspect, _FOUND)
    # The ranges of a text file meet here; any other violation is a row of its own.
    counted = found.groupBy("subject", "rule", "detail").agg(F.sum("n").alias("n"))
    told = F.when(F.col("rule") == "line tag", F.col("n") > 0).when(F.col("rule") == "no rows", F.col("n") == 0).otherwise(True)
    detail = F.when(F.col("rule").isin("line tag", "no rows"), F.col("n").cast("string")).otherwise(F.col("detail"))
    return counted.filter(told).select("subject", "rule", detail.alias("detail"))


def _inspected(row: dict, prefix: str) -> list[dict]:
    fmt, path = row["format"], row["path"]
    if row["error"] is not None:
        return [{"rule": "contents", "detail": row["error"], "n": 1}]
    try:
        if fmt == "tsv":
            return line_facts(row)
        if fmt in ("fgb", "fgb/zip"):
            problems = head_problems(path)
        elif fmt in ("geoparquet", "geoparquet/native", "parquet"):
            problems = footer_problems(path, fmt)
        elif fmt.startswith("arrows"):
            problems = stream_problems(path, fmt, prefix)
        else:
            problems = [("format", fmt)]
        if row["size"] > SIZE_LIMIT:
            problems.append(("size", str(row["size"])))
    except (pa.ArrowException, OSError, EOFError, ValueError) as error:
        # One damaged file must not hide the state of the others.
        problems = [("contents", str(error))]
    return [{"rule": rule, "detail": detail, "n": 1} for rule, detail in problems]


def check_table(df: DataFrame) -> list[tuple[str, str]]:
    """Rules on a table's schema: geometry there, last, and stored as its tag says."""
    if GEOMETRY not in df.columns:
        return [("geometry missing", ", ".join(df.columns))]
    out = []
    if df.columns[-1] != GEOMETRY:
        out.append(("geometry not last", ", ".join(df.columns)))
    if not storage_matches(df):
        out.append(("storage type", df.schema[GEOMETRY].dataType.simpleString()))
    if geometry_tag(df).encoding == "box" and df.schema[GEOMETRY].dataType != BOX_TYPE:
        out.append(("box fields may be null", df.schema[GEOMETRY].dataType.simpleString()))
    return out


def row_rules(df: DataFrame) -> list[tuple[str, Column, Column]]:
    """Rules on the values of a tagged column; null values break none."""
    tag = geometry_tag(df)
    geom = F.col(GEOMETRY)
    absent = geom.isNull()
    if tag.encoding == "wkt":
        return [("line tag", absent | geom.rlike("^[A-Z]+"), geom)]
    if tag.encoding == "wkb":
        return [("wkb header", absent | wkb_type(geom).isNotNull(), F.hex(F.substring(geom, 1, 5)))]
    if tag.encoding == "box":
        whole = F.lit(True)
        for name in BOX_FIELDS:
            whole = whole & geom[name].isNotNull()
        return [("box limit missing", absent | whole, geom.cast("string"))]
    if tag.layout == "interleaved":
        size = len(tag.dims)

        def sized(value: Column, kind: T.DataType) -> Column:
            if isinstance(kind.elementType, T.DoubleType):
                return F.size(value) == size
            return F.forall(value, lambda v: sized(v, kind.elementType))

        return [("coordinate size", absent | sized(geom, df.schema[GEOMETRY].dataType), F.lit(f"{size} expected"))]
    return []


def check_rows(df: DataFrame, subject: str) -> DataFrame:
    """Rows whose value does not fit the column's tag, in one pass."""
    return _checks(df, subject, row_rules(df))
