"""WKT text to native columns and back."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .batches import arrow_storage, binary_parts, list_lengths, offsets, ordinates, spread
from .types import NESTING, TYPE_NAMES, storage_type, type_label

# A tag word and an optional dimension word.
TAG_PATTERN = r"^\s*([A-Za-z]+)\s*(ZM|Z|M|)\s*(?:EMPTY|\()"


def wkt_kind(text: Column) -> Column:
    """Lower-case type word."""
    return F.lower(F.regexp_extract(text, TAG_PATTERN, 1))


def wkt_dims(text: Column) -> Column:
    return F.concat(F.lit("xy"), F.lower(F.regexp_extract(text, TAG_PATTERN, 2)))


def wkt_type(text: Column) -> Column:
    """Footer-style name of each row's type: ``Point``, ``LineString Z`` …"""
    word = F.upper(F.regexp_extract(text, TAG_PATTERN, 1))
    names = F.create_map(
        *[F.lit(v) for kind, name in TYPE_NAMES.items() for v in (kind.upper(), name)]
    )
    suffix = F.regexp_extract(text, TAG_PATTERN, 2)
    return F.rtrim(F.concat(F.element_at(names, word), F.lit(" "), suffix))


def strip_tag(text: Column) -> Column:
    """Text without its type and dimension words."""
    return F.regexp_replace(text, r"^\s*[A-Za-z]+\s*(?:ZM|Z|M)?\s*", "")


# Classes of bytes in the body of a text.
_BLANK, _NUMBER, _COMMA, _OPEN, _CLOSE, _FOREIGN = range(6)
_CLASSES = np.full(256, _FOREIGN, dtype=np.uint8)
for _bytes, _class in (
    (b" \t\r\n", _BLANK), (b"0123456789+-.eEnNaA", _NUMBER),
    (b",", _COMMA), (b"(", _OPEN), (b")", _CLOSE),
):
    _CLASSES[list(_bytes)] = _class


def _numbers(data: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start of every run of number bytes, and the numbers."""
    found = classes == _NUMBER
    edges = np.flatnonzero(np.diff(found, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    ends_in_packed = offsets(ends - starts).astype(np.int32)
    packed = pa.StringArray.from_buffers(
        len(starts), pa.py_buffer(ends_in_packed), pa.py_buffer(data[found])
    )
    return starts, packed.cast(pa.float64()).to_numpy(zero_copy_only=False)


def parse_array(values: pa.Array, kind: str, dims: str) -> pa.Array:
    """Texts of one type to native values, all bytes of a batch at a time."""
    label = type_label(kind, dims)
    valid = values.is_valid()
    texts = values.drop_null()
    if len(texts) == 0:
        return pa.nulls(len(values), arrow_storage(kind, dims))
    head = rf"(?i)^\s*{kind}\s*{dims[2:]}\s*"
    empty = pc.match_substring_regex(texts, head + r"EMPTY\s*$").to_numpy(zero_copy_only=False)
    known = pc.match_substring_regex(texts, head + r"\(").to_numpy(zero_copy_only=False) | empty
    data, bounds = binary_parts(texts)
    row_starts, row_ends = bounds[:-1], bounds[1:]

    def require(ok: np.ndarray, rows: np.ndarray | None = None) -> None:
        if not ok.all():
            at = int(np.flatnonzero(~ok)[0])
            row = at if rows is None else int(rows[at])
            raise ValueError(f"Not a {label} in WKT: {texts[row].as_py()}")

    def row_of(positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(row_ends, positions, side="right")

    require(known)
    first, last = int(bounds[0]), int(bounds[-1])
    classes = _CLASSES[data[first:last]]
    row_starts, row_ends = row_starts - first, row_ends - first
    data = data[first:last]
    # Blank the words before the first parenthesis, and empty texts altogether.
    opens = np.flatnonzero(classes == _OPEN)
    body = row_ends.copy()
    filled = np.flatnonzero(~empty)
    body[filled] = opens[np.searchsorted(opens, row_starts[filled])]
    marks = np.zeros(len(classes) + 1, dtype=np.int64)
    np.add.at(marks, row_starts, 1)
    np.add.at(marks, body, -1)
    classes[np.cumsum(marks[:-1]) > 0] = _BLANK
    # A leading plus sign is not part of what the number reader takes.
    plus = np.flatnonzero(data == ord("+"))
    classes[plus[classes[np.maximum(plus - 1, 0)] != _NUMBER]] = _BLANK
    foreign = np.flatnonzero(classes == _FOREIGN)
    require(np.zeros(len(foreign), dtype=bool), row_of(foreign))

    depth = np.cumsum(classes == _OPEN) - np.cumsum(classes == _CLOSE)
    if kind == "multipoint":
        # Parentheses around single points are optional.
        inner = ((classes == _OPEN) & (depth == 2)) | ((classes == _CLOSE) & (depth == 1))
        classes[inner] = _BLANK
        depth = np.cumsum(classes == _OPEN) - np.cumsum(classes == _CLOSE)
    deepest = 1 if kind in ("point", "multipoint") else NESTING[kind]
    at, numbers = _numbers(data, classes)

    def closings(level: int) -> np.ndarray:
        return np.flatnonzero((classes == _CLOSE) & (depth == level - 1))

    def commas(level: int) -> np.ndarray:
        return np.flatnonzero((classes == _COMMA) & (depth == level))

    # Every coordinate ends at a comma or parenthesis of the innermost level.
    marks_here = np.sort(np.concatenate([commas(deepest), closings(deepest)]))
    per_coord = np.diff(np.searchsorted(at, marks_here), prepend=0)
    require(per_coord == len(dims), row_of(marks_here))
    outside = np.flatnonzero((depth < 0) | (depth > deepest))
    require(np.zeros(len(outside), dtype=bool), row_of(outside))
    tops = closings(1)
    ends_at_row = np.zeros(len(texts), dtype=np.int64)
    np.add.at(ends_at_row, np.minimum(row_of(tops), len(texts) - 1), 1)
    require((ends_at_row == 1) == ~empty)
    require(ends_at_row <= 1)
    if len(numbers) != len(marks_here) * len(dims):
        require(np.zeros(1, dtype=bool), row_of(at[-1:]))

    table = numbers.reshape(-1, len(dims))
    native = pa.StructArray.from_arrays(
        [pa.array(np.ascontiguousarray(table[:, i])) for i in range(len(dims))], names=list(dims)
    )
    children = marks_here
    for level in range(deepest, 0, -1):
        ends = closings(level)
        sizes = np.diff(np.searchsorted(children, ends, side="right"), prepend=0)
        separators = np.diff(np.searchsorted(commas(level), ends), prepend=0)
        require(separators == sizes - 1, row_of(ends))
        if level == 1:
            break
        native = pa.ListArray.from_arrays(pa.array(offsets(sizes).astype(np.int32)), native)
        children = ends
    counts = np.zeros(len(texts), dtype=np.int64)
    counts[filled] = sizes
    if kind == "point":
        require(counts == ~empty)
        nan = pa.StructArray.from_arrays([pa.array([np.nan])] * len(dims), names=list(dims))
        places = np.where(empty, len(native), np.cumsum(~empty) - 1)
        native = pa.concat_arrays([native, nan]).take(pa.array(places))
    else:
        native = pa.ListArray.from_arrays(pa.array(offsets(counts).astype(np.int32)), native)
    return spread(native, valid)


#: Bytes of text that are parsed at once; working arrays take a hundred times as many.
PARSE_BYTES = 1 << 20


def _slices(texts: pa.Array) -> Iterator[pa.Array]:
    """Consecutive rows of at most PARSE_BYTES together, or a single longer one."""
    lengths = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths, dtype=np.int64)
    start = 0
    while start < len(texts):
        before = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + PARSE_BYTES, side="right")))
        yield texts.slice(start, stop - start)
        start = stop


def parse_slices(values: pa.Array, kind: str, dims: str) -> pa.Array:
    """:func:`parse_array` a slice at a time, so that memory follows the result and not its working arrays."""
    parsed = [parse_array(piece, kind, dims) for piece in _slices(values)]
    return pa.concat_arrays(parsed) if parsed else parse_array(values, kind, dims)


def parse_wkt(text: Column, kind: str, dims: str = "xy") -> Column:
    """Typed native value; text of another type or malformed text raises an error.

    Runs on Arrow batches: the same through string functions and the JSON reader took
    three to five times as long. A batch is parsed a bounded number of bytes at a time.
    """

    @arrow_udf(storage_type(kind, dims))
    def parse(values: pa.Array) -> pa.Array:
        return parse_slices(values, kind, dims)

    return parse(text)


def format_number(value: Column) -> Column:
    """Shortest text that reads back: plain from 0.0001 to 1e15, beyond with an exponent."""
    size = F.abs(value)
    text = value.cast("string")
    whole = (value == F.floor(value)) & (size < 1e15)
    zero = F.when(text == "-0.0", "-0").otherwise("0")
    # The decimal takes all digits of the text, so no digit is added or lost.
    plain = F.regexp_replace(text.cast("decimal(38,22)").cast("string"), "0+$", "")
    return (
        F.when(value == 0, zero)
        .when(whole, F.floor(value).cast("bigint").cast("string"))
        .when((size >= 1e-4) & (size < 1e15) & text.contains("E"), plain)
        .otherwise(F.regexp_replace(text, r"\.0E", "E"))
    )


def format_wkt(geom: Column, kind: str, dims: str = "xy") -> Column:
    """Canonical text of a native value."""
    suffix = dims[2:].upper()
    head = kind.upper() + (f" {suffix} " if suffix else " ")

    def coord(c: Column) -> Column:
        return F.concat_ws(" ", *[format_number(c[d]) for d in dims])

    def descend(value: Column, level: int) -> Column:
        if level == 0:
            text = coord(value)
            return F.concat(F.lit("("), text, F.lit(")")) if kind == "multipoint" else text
        inner = F.transform(value, lambda item: descend(item, level - 1))
        return F.concat(F.lit("("), F.array_join(inner, ", "), F.lit(")"))

    if kind == "point":
        empty = F.isnan(geom["x"])
        body = F.concat(F.lit("("), coord(geom), F.lit(")"))
    else:
        empty = F.size(geom) == 0
        body = descend(geom, NESTING[kind])
    return F.when(
        geom.isNotNull(),
        F.when(empty, F.lit(head + "EMPTY")).otherwise(F.concat(F.lit(head), body)),
    )


def number_text(value: float) -> str:
    """The text :func:`format_number` gives a number that is not whole."""
    size = abs(value)
    if size >= 1e-4 and size < 1e15 or value != value or size == float("inf"):
        return repr(value)
    digits, _, power = f"{value:.17g}".partition("e")
    for places in range(17):
        digits, _, power = f"{value:.{places}e}".partition("e")
        if float(f"{digits}e{power}") == value:
            break
    return f"{digits}E{int(power)}"


def _number_texts(values: np.ndarray) -> pa.Array:
    whole = np.isfinite(values) & (values == np.floor(values)) & (np.abs(values) < 1e15)
    texts = np.empty(len(values), dtype=object)
    texts[whole] = pa.array(values[whole].astype(np.int64)).cast(pa.string()).to_pylist()
    texts[~whole] = [number_text(v) for v in values[~whole].tolist()]
    texts[(values == 0) & np.signbit(values)] = "-0"
    return pa.array(texts, pa.string())


def format_array(values: pa.Array, kind: str, dims: str) -> pa.Array:
    """Native values of one type, none of them null, to texts; for columns of mixed types."""

    def wrap(inner: pa.Array) -> pa.Array:
        return pc.binary_join_element_wise("(", inner, ")", "")

    lists, coords = [], values
    for _ in range(NESTING[kind]):
        lists.append(coords)
        coords = coords.flatten()
    numbers = [_number_texts(ordinates(coords, d)) for d in dims]
    texts = pc.binary_join_element_wise(*numbers, " ")
    if kind in ("point", "multipoint"):
        texts = wrap(texts)
    for level in reversed(lists):
        joined = pa.ListArray.from_arrays(
            pa.array(offsets(list_lengths(level)).astype(np.int32)), texts
        )
        texts = wrap(pc.binary_join(joined, ", "))
    empty = np.isnan(ordinates(values, "x")) if kind == "point" else list_lengths(values) == 0
    texts = pc.if_else(pa.array(empty), pa.scalar("EMPTY"), texts)
    suffix = dims[2:].upper()
    return pc.binary_join_element_wise(kind.upper() + " " + (suffix + " " if suffix else ""), texts, "")
