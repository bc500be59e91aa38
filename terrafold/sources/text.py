"""Tables whose geometries are WKT text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.types import GEOMETRY, GeometryTag, tagged
from ..operators.ordering import position_in_partition
from .shared import data_paths

# Fixed value: the only header line.
HEADER = "geometry"


def read_wkt_tsv(
    spark: SparkSession, path: str, kind: str | None = None, dims: str | None = None,
    keep_order: bool = False,
) -> DataFrame:
    """One WKT value per line after the header; a blank line is null.

    Only the first line of a file is its header: the same word further down stays a value,
    so that reading it as a shape fails rather than loses a line.

    With ``keep_order`` each row carries ``line_order`` (file, offset of the split in it,
    running number in the split), which sorts as the lines stand without reading a file
    in one task.
    """
    lines = spark.read.text(data_paths(path))
    file, block = F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block")
    columns = [F.col("value"), file, block]
    if keep_order:
        columns.append(
            F.struct(
                F.col("_metadata.file_path").alias("file"),
                F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("line"),
            ).alias("line_order")
        )
    lines = lines.select(*columns)
    lines = lines.mapInArrow(_without_headers, lines.schema).drop("__file", "__block")
    rest = ["line_order"] if keep_order else []
    text = F.nullif(F.col("value"), F.lit(""))
    return lines.select(*rest, tagged(text, GeometryTag("wkt", kind, dims)))


def _without_headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Drop the header where a file begins; the rows of a split come in the order of its lines."""
    before = None
    for batch in batches:
        headers = pc.and_(pc.equal(batch.column("value"), HEADER), pc.equal(batch.column("__block"), 0))
        files = batch.column("__file")
        opens = np.array([a != b for a, b in zip(files.to_pylist(), [before, *files.to_pylist()[:-1]])], bool)
        before = files[-1].as_py() if len(files) else before
        yield batch.filter(pc.invert(pc.and_(headers, pa.array(opens))))


def write_wkt_tsv(
    df: DataFrame, path: str, order: list[str] | None = None, files: int | None = None
) -> None:
    """Lines in order under a header in every part file; null becomes a blank line."""
    if order:
        keys = [F.col(c) for c in order]
        df = df.repartitionByRange(files, *keys) if files else df.repartitionByRange(*keys)
        df = df.sortWithinPartitions(*keys)
    line = F.coalesce(F.col(GEOMETRY), F.lit(""))
    first = position_in_partition() == 0
    lines = df.select(
        F.when(first, F.concat(F.lit(HEADER + "\n"), line)).otherwise(line).alias("value")
    )
    if df.isEmpty():
        lines = df.sparkSession.createDataFrame([(HEADER,)], "value string")
    lines.write.text(path)


def read_delimited_wkt(
    spark: SparkSession, path: str, geom_col: str, kind: str | None = None,
    dims: str | None = None, schema: str | None = None,
) -> DataFrame:
    """Tab-delimited table with a header; the WKT column becomes ``geometry`` in its place."""
    reader = spark.read
    if schema:
        reader = reader.schema(schema)
    df = reader.csv(path, sep="\t", header=True)
    tag = GeometryTag("wkt", kind, dims)
    return df.select(
        *[tagged(F.col(c), tag) if c == geom_col else F.col(c) for c in df.columns]
    )


def wkt_lists(spark: SparkSession, mapping: dict[str, list[str | None]] | DataFrame) -> DataFrame:
    """Named lists of WKT as rows (name, pos, wkt); nulls stay rows.

    A mapping, or a table with columns name and items.
    """
    lists = mapping
    if not isinstance(mapping, DataFrame):
        lists = spark.createDataFrame(list(mapping.items()), "name string, items array<string>")
    return lists.select("name", F.posexplode("items").alias("pos", "wkt"))


def merge_lists(first: DataFrame, later: DataFrame) -> DataFrame:
    """Union of two sets of named lists; a name in ``later`` replaces the whole list."""
    kept = first.join(later.select("name").distinct(), "name", "left_anti")
    return kept.unionByName(later)


def concat_lists(lists: DataFrame, sources: list[str], name: str) -> DataFrame:
    """Lists put end to end in the order of ``sources`` under a new name."""
    rank = F.array_position(F.array(*[F.lit(s) for s in sources]), F.col("name"))
    chosen = lists.filter(F.col("name").isin(sources)).withColumn("source", rank.cast("int"))
    # One row per named list.
    before = Window.orderBy("source").rowsBetween(Window.unboundedPreceding, -1)
    starts = chosen.groupBy("source").count().select(
        "source", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start")
    )
    return chosen.join(starts, "source").select(
        F.lit(name).alias("name"), (F.col("start") + F.col("pos")).cast("int").alias("pos"), "wkt"
    )
