"""WKB columns: whole Arrow batches at a time, with numpy over the value buffers.

Typed columns never loop over rows. Columns of mixed types (and collections, which
have no native form) use the small recursive helpers at the end of this module.
"""

from __future__ import annotations

import re
import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .batches import arrow_storage, binary_parts, bounds_of, box_array, list_lengths, spread
from .batches import offsets as _offsets
from .types import (
    BOX_TYPE,
    DIMENSIONS,
    NESTING,
    TYPE_NAMES,
    WKB_CODES,
    storage_type,
    type_label,
)
from .wkt import number_text

_SINGLE = {"multipoint": "point", "multilinestring": "linestring", "multipolygon": "polygon"}


# Code of each type and dimensions, and back.
_CODES = {
    (kind, dims): code + 1000 * i
    for i, dims in enumerate(DIMENSIONS)
    for kind, code in WKB_CODES.items()
}
_TYPES = {code: pair for pair, code in _CODES.items()}


def wkb_code(kind: str, dims: str) -> int:
    return _CODES[kind, dims]


def split_code(code: int) -> tuple[str, str]:
    """Type and dimensions of a WKB code."""
    if code not in _TYPES:
        raise ValueError(f"Unknown WKB type code {code}")
    return _TYPES[code]


# ---------------------------------------------------------------- encoding


def _put(out: np.ndarray, at: np.ndarray, values: np.ndarray) -> None:
    width = values.dtype.itemsize
    spots = at[:, None] + np.arange(width)
    out[spots] = np.ascontiguousarray(values).view(np.uint8).reshape(-1, width)


def encode_array(arr: pa.Array, kind: str, dims: str) -> pa.Array:
    """Native (struct coordinates) to little-endian ISO WKB."""
    single = _SINGLE.get(kind)
    # One entry per level: type code of its header or None, and whether a count follows.
    levels: list[tuple[int | None, bool]] = [(wkb_code(kind, dims), kind != "point")]
    if single:
        levels.append((wkb_code(single, dims), single != "point"))
    if kind in ("polygon", "multipolygon"):
        levels.append((None, True))
    valid = arr.is_valid()
    values = arr.drop_null()
    width = 8 * len(dims)

    counts = []
    for _, counted in levels:
        if counted:
            counts.append(list_lengths(values))
            values = values.flatten()
        else:
            counts.append(np.ones(len(values), dtype=np.int64))
    prefix = [(5 if code is not None else 0) + (4 if counted else 0) for code, counted in levels]

    sizes: list[np.ndarray] = [None] * len(levels)
    ends = _offsets(np.full(len(values), width, dtype=np.int64))
    child_ends = [None] * len(levels)
    for i in reversed(range(len(levels))):
        offsets = _offsets(counts[i])
        child_ends[i] = ends
        sizes[i] = prefix[i] + ends[offsets[1:]] - ends[offsets[:-1]]
        ends = _offsets(sizes[i])

    out = np.empty(int(ends[-1]), dtype=np.uint8)
    starts = ends[:-1]
    for i, (code, counted) in enumerate(levels):
        if code is not None:
            out[starts] = 1
            _put(out, starts + 1, np.full(len(starts), code, dtype="<u4"))
        if counted:
            _put(out, starts + prefix[i] - 4, counts[i].astype("<u4"))
        offsets = _offsets(counts[i])
        first = child_ends[i][offsets[:-1]]
        starts = np.repeat(starts + prefix[i] - first, counts[i]) + child_ends[i][:-1]
    for i, d in enumerate(dims):
        ordinates = values.field(d).to_numpy(zero_copy_only=False).astype("<f8")
        _put(out, starts + 8 * i, ordinates)

    row_sizes = np.zeros(len(arr), dtype=np.int64)
    row_sizes[valid.to_numpy(zero_copy_only=False)] = sizes[0]
    row_offsets = _offsets(row_sizes)
    if row_offsets[-1] > 2**31 - 1:
        raise ValueError("A batch of WKB exceeds 2 GiB; lower arrow.maxRecordsPerBatch")
    return pa.BinaryArray.from_buffers(
        pa.binary(),
        len(arr),
        [valid.buffers()[1], pa.py_buffer(row_offsets.astype(np.int32)), pa.py_buffer(out)],
    )


# ---------------------------------------------------------------- decoding


class _Bytes:
    """Gathers numbers of either byte order at many positions of one buffer."""

    def __init__(self, data: np.ndarray):
        self.data = data

    def _gather(self, at: np.ndarray, big: np.ndarray, dtype: str) -> np.ndarray:
        width = int(dtype[1:])
        raw = np.ascontiguousarray(self.data[at[:, None] + np.arange(width)])
        little = raw.view("<" + dtype).reshape(-1)
        if not big.any():
            return little
        return np.where(big, raw.view(">" + dtype).reshape(-1), little)

    def u32(self, at, big):
        return self._gather(at, big, "u4").astype(np.int64)

    def f64(self, at, big):
        return self._gather(at, big, "f8").astype(np.float64)

    def header(self, at):
        big = self.data[at] == 0
        return big, self.u32(at + 1, big)


def _coords(src: _Bytes, at: np.ndarray, big: np.ndarray, dims: str) -> pa.Array:
    fields = [pa.array(src.f64(at + 8 * i, big)) for i in range(len(dims))]
    return pa.StructArray.from_arrays(fields, names=list(dims))


def _as_list(counts: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(_offsets(counts).astype(np.int32)), values)


def _sequence(src: _Bytes, at, big, dims):
    """Counted coordinates, the body of lines and rings."""
    counts = src.u32(at, big)
    width = 8 * len(dims)
    first = _offsets(counts)[:-1]
    step = np.arange(int(counts.sum()), dtype=np.int64) - np.repeat(first, counts)
    spots = np.repeat(at + 4, counts) + step * width
    values = _coords(src, spots, np.repeat(big, counts), dims)
    return _as_list(counts, values), at + 4 + counts * width


def _children(read, cursor: np.ndarray, counts: np.ndarray, empty: pa.DataType):
    """k-th child of every parent at once, for k = 0, 1, …; sizes are known only in turn."""
    cursor = cursor.copy()
    found, owners = [], []
    active = np.flatnonzero(counts > 0)
    k = 0
    while active.size:
        values, cursor[active] = read(cursor[active], active)
        found.append(values)
        owners.append(active)
        k += 1
        active = active[counts[active] > k]
    if not found:
        return _as_list(counts, pa.array([], empty)), cursor
    order = np.argsort(np.concatenate(owners), kind="stable")
    values = pa.concat_arrays(found).take(pa.array(order))
    return _as_list(counts, values), cursor


def _read(src: _Bytes, at: np.ndarray, kind: str, dims: str):
    """Values and end positions of the geometries that start at ``at``."""
    big, codes = src.header(at)
    expected = wkb_code(kind, dims)
    single = _SINGLE.get(kind)
    promoted = codes == wkb_code(single, dims) if single else np.zeros(len(at), dtype=bool)
    wrong = (codes != expected) & ~promoted
    if wrong.any():
        raise ValueError(
            f"Not a {type_label(kind, dims)} in WKB: type code {int(codes[wrong][0])}"
        )
    if kind == "point":
        return _coords(src, at + 5, big, dims), at + 5 + 8 * len(dims)
    if kind == "linestring":
        return _sequence(src, at + 5, big, dims)
    if kind == "polygon":
        counts = src.u32(at + 5, big)
        return _children(
            lambda spots, rows: _sequence(src, spots, big[rows], dims),
            at + 9,
            counts,
            arrow_storage("linestring", dims),
        )
    # A single member of a mixed family counts as a collection of one, or of none if empty.
    if single == "point":
        count_at = np.where(promoted, at, at + 5)
        counts = np.where(promoted, 1, src.u32(count_at, big & ~promoted))
        hollow = np.isnan(src.f64(np.where(promoted, at + 5, at), big)) & promoted
        width = 5 + 8 * len(dims)
        begin = np.where(promoted, at, at + 9)
        ends = begin + counts * width
        counts = np.where(hollow, 0, counts)
        first = _offsets(counts)[:-1]
        step = np.arange(int(counts.sum()), dtype=np.int64) - np.repeat(first, counts)
        values, _ = _read(src, np.repeat(begin, counts) + step * width, "point", dims)
        return _as_list(counts, values), ends
    inner = src.u32(at + 5, big)
    hollow = promoted & (inner == 0)
    counts = np.where(hollow, 0, np.where(promoted, 1, inner))
    begin = np.where(promoted & ~hollow, at, at + 9)
    return _children(
        lambda spots, rows: _read(src, spots, single, dims),
        begin,
        counts,
        arrow_storage(single, dims),
    )


def decode_array(arr: pa.Array, kind: str, dims: str) -> pa.Array:
    """WKB to native struct coordinates; singles are promoted where ``kind`` is a multi type."""
    valid = arr.is_valid()
    kept = arr.drop_null()
    if len(kept) == 0:
        return pa.nulls(len(arr), arrow_storage(kind, dims))
    data, offsets = binary_parts(kept)
    values, ends = _read(_Bytes(data), offsets[:-1], kind, dims)
    if (ends != offsets[1:]).any():
        raise ValueError("WKB value is shorter or longer than its contents")
    return spread(values, valid)


def type_codes(arr: pa.Array) -> np.ndarray:
    """WKB type code of each row of an array without nulls."""
    if len(arr) == 0:
        return np.zeros(0, dtype=np.int64)
    data, offsets = binary_parts(arr)
    return _Bytes(data).header(offsets[:-1])[1]


def box_rows(arr: pa.Array) -> np.ndarray:
    """xmin, ymin, xmax, ymax per row; NaN for null and empty rows."""
    out = np.full((len(arr), 4), np.nan)
    rows = np.flatnonzero(arr.is_valid().to_numpy(zero_copy_only=False))
    kept = arr.drop_null()
    if len(kept) == 0:
        return out
    codes = type_codes(kept)
    for code in np.unique(codes):
        kind, dims = split_code(int(code))
        where = np.flatnonzero(codes == code)
        values = kept.take(pa.array(where))
        if kind == "geometrycollection":
            members = [list(leaf_members(v.as_py())) for v in values]
            owner = np.repeat(np.arange(len(members)), [len(m) for m in members])
            flat = pa.array([m for row in members for _, m in row], pa.binary())
            inner = box_rows(flat)
        else:
            inner = bounds_of(decode_array(values, kind, dims), kind)
            owner = np.arange(len(inner))
        target = rows[where]
        for i in range(4):
            column = out[target, i]
            (np.fmin if i < 2 else np.fmax).at(column, owner, inner[:, i])
            out[target, i] = column
    return out


# ---------------------------------------------------------------- column functions


def encode_wkb(geom: Column, kind: str, dims: str = "xy") -> Column:
    @arrow_udf("binary")
    def encode(values: pa.Array) -> pa.Array:
        return encode_array(values, kind, dims)

    return encode(geom)


def decode_wkb(wkb: Column, kind: str, dims: str = "xy") -> Column:
    @arrow_udf(storage_type(kind, dims))
    def decode(values: pa.Array) -> pa.Array:
        return decode_array(values, kind, dims)

    return decode(wkb)


def wkb_box(wkb: Column) -> Column:
    """Bounds of WKB values of any type."""

    @arrow_udf(BOX_TYPE)
    def bounds(values: pa.Array) -> pa.Array:
        return box_array(box_rows(values))

    return bounds(wkb)


def wkb_type_code(wkb: Column) -> Column:
    """Type code from bytes 1 to 4, in either byte order."""
    order = F.hex(F.substring(wkb, 1, 1))
    digits = F.hex(F.substring(wkb, 2, 4))
    swapped = F.concat(*[F.substring(digits, i, 2) for i in (7, 5, 3, 1)])
    return F.conv(F.when(order == "00", digits).otherwise(swapped), 16, 10).cast("int")


def wkb_type(wkb: Column) -> Column:
    """Footer-style type name of each value."""
    names = [
        F.lit(v)
        for dims in DIMENSIONS
        for kind in TYPE_NAMES
        for v in (wkb_code(kind, dims), type_label(kind, dims))
    ]
    return F.element_at(F.create_map(*names), wkb_type_code(wkb))


def texts_to_wkb(texts: pa.Array, parse) -> pa.Array:
    """WKT of any mix of types: one batch per type, collections one by one.

    ``parse`` reads texts of one type into native values.
    """
    heads = pc.utf8_upper(
        pc.struct_field(pc.extract_regex(texts, r"^\s*(?P<head>[A-Za-z]+\s*(?:[zZmM]+)?)"), "head")
    )
    out, places = [], []
    for head in pc.unique(heads):
        rows = pc.indices_nonzero(pc.equal(heads, head) if head.is_valid else pc.is_null(heads))
        word, _, suffix = (head.as_py() or "").partition(" ")
        kind, dims = word.lower(), "xy" + suffix.strip().lower()
        chosen = texts.take(rows)
        if kind in NESTING and dims in DIMENSIONS:
            encoded = encode_array(parse(chosen, kind, dims), kind, dims)
        else:
            encoded = pa.array([None if v is None else _text_to_bytes(v) for v in chosen.to_pylist()], pa.binary())
        out.append(encoded)
        places.append(rows.to_numpy())
    if not out:
        return pa.array([], pa.binary())
    order = np.argsort(np.concatenate(places))
    return pa.concat_arrays(out).take(pa.array(order))


def wkt_to_wkb(text: Column) -> Column:
    """For columns of mixed types and collections; typed columns parse and encode instead."""
    from .wkt import parse_slices

    @arrow_udf("binary")
    def convert(values: pa.Array) -> pa.Array:
        return texts_to_wkb(values, parse_slices)

    return convert(text)


def wkb_to_texts(values: pa.Array, write) -> pa.Array:
    """WKB of any mix of types to WKT: one batch per type, collections one by one.

    ``write`` turns native values of one type into texts.
    """
    valid = values.is_valid()
    kept = values.drop_null()
    codes = type_codes(kept)
    out, places = [], []
    for code in np.unique(codes):
        kind, dims = split_code(int(code))
        rows = np.flatnonzero(codes == code)
        chosen = kept.take(pa.array(rows))
        if kind in NESTING:
            texts = write(decode_array(chosen, kind, dims), kind, dims)
        else:
            texts = pa.array([_bytes_to_text(v, 0)[0] for v in chosen.to_pylist()], pa.string())
        out.append(texts)
        places.append(rows)
    if not out:
        return pa.nulls(len(values), pa.string())
    order = np.argsort(np.concatenate(places))
    return spread(pa.concat_arrays(out).take(pa.array(order)), valid)


def wkb_to_wkt(wkb: Column) -> Column:
    """For columns of mixed types and collections; typed columns decode and format instead."""
    from .wkt import format_array

    @arrow_udf("string")
    def convert(values: pa.Array) -> pa.Array:
        return wkb_to_texts(values, format_array)

    return convert(wkb)


def members(wkb: Column) -> Column:
    """Leaf members of each value with their path of positions, nested collections opened."""

    @arrow_udf("array<struct<path:string,member:binary>>")
    def split(values: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("path", pa.string()), ("member", pa.binary())]))
        rows = [
            None
            if v is None
            else [{"path": path, "member": member} for path, member in leaf_members(v)]
            for v in values.to_pylist()
        ]
        return pa.array(rows, kind)

    return split(wkb)


# ---------------------------------------------------------------- mixed and nested values


def _head(buf: bytes, pos: int) -> tuple[str, str, str]:
    order = "<" if buf[pos] else ">"
    return (order, *split_code(struct.unpack_from(order + "I", buf, pos + 1)[0]))


def _end(buf: bytes, pos: int) -> int:
    """Position after the geometry that starts at ``pos``."""
    order, kind, dims = _head(buf, pos)
    width = 8 * len(dims)
    if kind == "point":
        return pos + 5 + width
    (count,) = struct.unpack_from(order + "I", buf, pos + 5)
    pos += 9
    if kind == "linestring":
        return pos + count * width
    for _ in range(count):
        if kind == "polygon":
            pos += 4 + struct.unpack_from(order + "I", buf, pos)[0] * width
        else:
            pos = _end(buf, pos)
    return pos


def leaf_members(buf: bytes, path: tuple = ()):
    order, kind, _ = _head(buf, 0)
    if kind != "geometrycollection":
        yield ".".join(map(str, path)), buf
        return
    (count,) = struct.unpack_from(order + "I", buf, 5)
    pos = 9
    for i in range(count):
        end = _end(buf, pos)
        yield from leaf_members(buf[pos:end], (*path, i))
        pos = end


def _text_to_bytes(text: str) -> bytes:
    words = re.findall(r"[(),]|[^\s(),]+", text)[::-1]

    def take(expected: str | None = None) -> str:
        if not words or (expected is not None and words[-1] != expected):
            raise ValueError(f"Malformed WKT: {text}")
        return words.pop()

    def several(item) -> bytes:
        take("(")
        out = [item()]
        while words and words[-1] == ",":
            take()
            out.append(item())
        take(")")
        return struct.pack("<I", len(out)) + b"".join(out)

    def geometry() -> bytes:
        kind = take().lower()
        dims = "xy"
        if words and words[-1].upper() in ("Z", "M", "ZM"):
            dims += take().lower()
        if kind not in WKB_CODES:
            raise ValueError(f"Malformed WKT: {text}")

        def coord() -> bytes:
            return struct.pack(f"<{len(dims)}d", *[float(take()) for _ in dims])

        def head(of: str) -> bytes:
            return struct.pack("<BI", 1, wkb_code(of, dims))

        def line() -> bytes:
            return several(coord)

        def point() -> bytes:
            wrapped = words and words[-1] == "("
            if wrapped:
                take()
            out = coord()
            if wrapped:
                take(")")
            return out

        if words and words[-1].upper() == "EMPTY":
            take()
            nothing = struct.pack("<I", 0)
            if kind == "point":
                nothing = struct.pack(f"<{len(dims)}d", *[float("nan")] * len(dims))
            return head(kind) + nothing
        bodies = {
            "point": point,
            "linestring": line,
            "polygon": lambda: several(line),
            "multipoint": lambda: several(lambda: head("point") + point()),
            "multilinestring": lambda: several(lambda: head("linestring") + line()),
            "multipolygon": lambda: several(lambda: head("polygon") + several(line)),
            "geometrycollection": lambda: several(geometry),
        }
        return head(kind) + bodies[kind]()

    out = geometry()
    if words:
        raise ValueError(f"Malformed WKT: {text}")
    return out


def _number(value: float) -> str:
    whole = np.isfinite(value) and value == int(value) and abs(value) < 1e15
    return f"{value:.0f}" if whole else number_text(value)


def _bytes_to_text(buf: bytes, pos: int, bare: bool = False) -> tuple[str, int]:
    """Text and end position; ``bare`` leaves out the words before the parenthesis."""
    order, kind, dims = _head(buf, pos)
    width = 8 * len(dims)
    suffix = dims[2:].upper()
    head = "" if bare else kind.upper() + " " + (suffix + " " if suffix else "")

    def coords(at: int, count: int) -> str:
        flat = struct.unpack_from(f"{order}{count * len(dims)}d", buf, at)
        groups = [flat[i : i + len(dims)] for i in range(0, len(flat), len(dims))]
        return ", ".join(" ".join(map(_number, g)) for g in groups)

    if kind == "point":
        values = struct.unpack_from(f"{order}{len(dims)}d", buf, pos + 5)
        body = "EMPTY" if np.isnan(values[0]) else f"({coords(pos + 5, 1)})"
        return head + body, pos + 5 + width
    (count,) = struct.unpack_from(order + "I", buf, pos + 5)
    pos += 9
    if count == 0:
        return head + "EMPTY", pos
    if kind == "linestring":
        return f"{head}({coords(pos, count)})", pos + count * width
    parts = []
    for _ in range(count):
        if kind == "polygon":
            (size,) = struct.unpack_from(order + "I", buf, pos)
            part, pos = f"({coords(pos + 4, size)})", pos + 4 + size * width
        else:
            part, pos = _bytes_to_text(buf, pos, bare=kind != "geometrycollection")
        parts.append(part)
    return f"{head}({', '.join(parts)})", pos
