"""Geometries to vertex rows and back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.coords import coord_struct
from ..functions.types import GEOMETRY, GeometryTag, geometry_tag, tagged
from .columns import with_coord_layout
from .ordering import with_rank

# Vertex rows carry these positions, each 0 where the type has no such level.
LEVELS = {
    "point": [],
    "linestring": ["seq"],
    "multipoint": ["part"],
    "polygon": ["ring", "seq"],
    "multilinestring": ["part", "seq"],
    "multipolygon": ["part", "ring", "seq"],
}
POSITIONS = ("part", "ring", "seq")


def explode_coords(df: DataFrame, ids: list[str]) -> DataFrame:
    """One row per vertex: ids, part, ring, seq, ordinates. Null and empty values give none."""
    df = with_coord_layout(df, "separated")
    tag = geometry_tag(df)
    work = df.select(*ids, F.col(GEOMETRY).alias("__g"))
    for level in LEVELS[tag.kind]:
        kept = [c for c in work.columns if c != "__g"]
        work = work.select(*kept, F.posexplode("__g").alias(level, "__g"))
    if tag.kind == "point":
        work = work.filter(F.col("__g").isNotNull() & ~F.isnan("__g.x"))
    positions = [
        F.col(p) if p in LEVELS[tag.kind] else F.lit(0).alias(p) for p in POSITIONS
    ]
    return work.select(*ids, *positions, *[F.col(f"__g.{d}").alias(d) for d in tag.dims])


def assemble_coords(
    vertices: DataFrame, ids: list[str], kind: str, dims: str = "xy", crs: object = None
) -> DataFrame:
    """Vertex rows to one geometry per id.

    One shuffle on the ids serves all levels. A geometry is one cell of a row; lines
    that may outgrow a cell are cut by :func:`line_pieces`.
    """
    levels = LEVELS[kind]
    value = coord_struct({d: F.col(d) for d in dims})
    work = vertices.select(*ids, *levels, value.alias("__g"))
    if not levels:
        geometry = F.col("__g")
    else:
        work = work.repartition(*ids) if len(levels) > 1 else work
        for i in reversed(range(len(levels))):
            work = work.groupBy(*ids, *levels[:i]).agg(
                F.array_sort(F.collect_list(F.struct(F.col(levels[i]).alias("at"), "__g"))).alias("__g")
            )
            work = work.withColumn("__g", F.col("__g.__g"))
        geometry = F.col("__g")
    return work.select(*ids, tagged(geometry, GeometryTag("native", kind, dims, crs=crs)))


def line_pieces(
    vertices: DataFrame,
    ids: list[str],
    order_by: list[str],
    max_vertices: int,
    dims: str = "xy",
) -> DataFrame:
    """Lines of at most ``max_vertices`` vertices each: ids, piece, geometry.

    A piece starts with the last vertex of the one before, so the pieces of an id put
    end to end are the whole line, however long. No task or cell holds more than a piece.
    """
    if max_vertices < 2:
        raise ValueError("A piece needs two vertices")
    stride = max_vertices - 1
    ranked = with_rank(vertices.select(*ids, *order_by, *dims), order_by, ids, "__rank")
    piece = F.floor(F.col("__rank") / stride)
    joint = (F.col("__rank") % stride == 0) & (F.col("__rank") > 0)
    placed = ranked.select(
        *ids,
        F.explode(F.when(joint, F.array(piece - 1, piece)).otherwise(F.array(piece))).alias("piece"),
        F.col("__rank").alias("seq"),
        *dims,
    )
    lines = assemble_coords(placed, [*ids, "piece"], "linestring", dims)
    # A line that ends at a joint leaves its last vertex alone in a further piece.
    return lines.filter((F.col("piece") == 0) | (F.size(GEOMETRY) > 1))


def explode_pieces(pieces: DataFrame, ids: list[str], max_vertices: int) -> DataFrame:
    """Vertices of cut lines with their position in the whole line; joints come once."""
    rows = explode_coords(pieces, [*ids, "piece"])
    dims = geometry_tag(pieces).dims
    rows = rows.filter((F.col("piece") == 0) | (F.col("seq") > 0))
    position = F.col("piece") * (max_vertices - 1) + F.col("seq")
    return rows.select(*ids, position.alias("seq"), *dims)
