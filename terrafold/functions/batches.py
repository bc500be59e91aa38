"""Measures of nested geometries over the flat ordinates of an Arrow batch."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .types import BOX_FIELDS, NESTING


def offsets(counts: np.ndarray) -> np.ndarray:
    out = np.zeros(len(counts) + 1, dtype=np.int64)
    np.cumsum(counts, out=out[1:])
    return out


def list_lengths(values: pa.Array) -> np.ndarray:
    """Length of each list, 0 for null."""
    return values.value_lengths().fill_null(0).to_numpy().astype(np.int64)


def arrow_storage(kind: str, dims: str) -> pa.DataType:
    """Arrow type of a native value with separated coordinates."""
    out = pa.struct([(d, pa.float64()) for d in dims])
    for _ in range(NESTING[kind]):
        out = pa.list_(out)
    return out


def binary_parts(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a binary or text array without nulls."""
    if len(arr) == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    _, ends, data = arr.buffers()
    large = pa.types.is_large_binary(arr.type) or pa.types.is_large_string(arr.type)
    wide = np.frombuffer(ends, dtype=np.int64 if large else np.int32)
    bytes_ = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return bytes_, wide[arr.offset : arr.offset + len(arr) + 1].astype(np.int64)


def spread(values: pa.Array, valid: pa.Array) -> pa.Array:
    """Put values of the valid rows back among null rows."""
    if len(values) == len(valid):
        return values
    mask = valid.to_numpy(zero_copy_only=False)
    places = np.cumsum(mask) - 1
    return values.take(pa.array(places, mask=~mask))


def ordinates(coords: pa.Array, name: str) -> np.ndarray:
    return coords.field(name).to_numpy(zero_copy_only=False)


def _unnest(values: pa.Array, kind: str) -> tuple[pa.Array, np.ndarray]:
    """Flat coordinates and the number of them in each row."""
    if NESTING[kind] == 0:
        return values, np.ones(len(values), dtype=np.int64)
    counts = list_lengths(values)
    values = values.flatten()
    for _ in range(NESTING[kind] - 1):
        ends = offsets(list_lengths(values))
        rows = offsets(counts)
        counts = ends[rows[1:]] - ends[rows[:-1]]
        values = values.flatten()
    return values, counts


def _reduce(ufunc, numbers: np.ndarray, counts: np.ndarray, fill: float) -> np.ndarray:
    """ufunc over each run of ``counts`` numbers; ``fill`` for an empty run."""
    out = np.full(len(counts), fill)
    full = counts > 0
    if full.any():
        out[full] = ufunc.reduceat(numbers, offsets(counts)[:-1][full])
    return out


def bounds_of(values: pa.Array, kind: str) -> np.ndarray:
    """xmin, ymin, xmax, ymax per row; NaN ordinates count for nothing, NaN where none is left."""
    coords, counts = _unnest(values, kind)
    x, y = ordinates(coords, "x"), ordinates(coords, "y")
    columns = [
        _reduce(np.fmin, x, counts, np.nan),
        _reduce(np.fmin, y, counts, np.nan),
        _reduce(np.fmax, x, counts, np.nan),
        _reduce(np.fmax, y, counts, np.nan),
    ]
    rows = np.stack(columns, axis=1)
    if values.null_count:
        rows[values.is_null().to_numpy(zero_copy_only=False)] = np.nan
    return rows


def box_array(rows: np.ndarray) -> pa.Array:
    mask = pa.array(np.isnan(rows).any(axis=1))
    fields = [pa.field(name, pa.float64(), False) for name in BOX_FIELDS]
    return pa.StructArray.from_arrays(
        [pa.array(rows[:, i]) for i in range(4)], fields=fields, mask=mask
    )


def centroids_of(values: pa.Array, kind: str) -> pa.Array:
    """Area centroids.

    Sums run relative to each row's first vertex to keep precision. Each ring's sign is
    normalised and holes count against their shell. A shape without area gives the mean
    of its shell vertices, an empty one an empty point.
    """
    total = len(values)
    nulls = values.is_null()
    row_of_polygon = np.arange(total)
    if kind == "multipolygon":
        row_of_polygon = np.repeat(row_of_polygon, list_lengths(values))
        values = values.flatten()
    ring_counts = list_lengths(values)
    rings = values.flatten()
    lengths = list_lengths(rings)
    coords = rings.flatten()
    row_of_ring = np.repeat(row_of_polygon, ring_counts)
    role = np.full(len(lengths), -1.0)
    role[offsets(ring_counts)[:-1][ring_counts > 0]] = 1.0
    kept = lengths > 0
    row_of_ring, role, lengths = row_of_ring[kept], role[kept], lengths[kept]

    x, y = ordinates(coords, "x"), ordinates(coords, "y")
    starts = offsets(lengths)[:-1]
    row_of_coord = np.repeat(row_of_ring, lengths)
    filled, first = np.unique(row_of_coord, return_index=True)
    origin = np.full((total, 2), np.nan)
    origin[filled, 0], origin[filled, 1] = x[first], y[first]
    x, y = x - origin[row_of_coord, 0], y - origin[row_of_coord, 1]

    # Edge from each vertex to the next; none leads from one ring to another.
    cross, px, py = np.zeros(len(x)), np.zeros(len(x)), np.zeros(len(x))
    if len(x):
        cross[:-1] = x[:-1] * y[1:] - x[1:] * y[:-1]
        cross[starts + lengths - 1] = 0.0
        px[:-1], py[:-1] = x[:-1] + x[1:], y[:-1] + y[1:]
    area = _reduce(np.add, cross, lengths, 0.0)
    weight = role * np.where(area < 0, -1.0, 1.0)

    def per_row(of_ring: np.ndarray) -> np.ndarray:
        return np.bincount(row_of_ring, weights=of_ring * weight, minlength=total)

    area = per_row(area)
    moment_x = per_row(_reduce(np.add, px * cross, lengths, 0.0))
    moment_y = per_row(_reduce(np.add, py * cross, lengths, 0.0))

    # The closing vertex repeats the first one.
    counted = np.repeat(role > 0, lengths)
    counted[(starts + lengths - 1)[lengths > 1]] = False
    shell_rows = row_of_coord[counted]
    n = np.bincount(shell_rows, minlength=total)
    with np.errstate(divide="ignore", invalid="ignore"):
        flat = area == 0
        cx = np.where(flat, np.bincount(shell_rows, x[counted], total) / n, moment_x / (area * 3))
        cy = np.where(flat, np.bincount(shell_rows, y[counted], total) / n, moment_y / (area * 3))
    centres = [pa.array(origin[:, 0] + cx), pa.array(origin[:, 1] + cy)]
    return pa.StructArray.from_arrays(centres, names=["x", "y"], mask=nulls)
