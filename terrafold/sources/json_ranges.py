"""Members of the arrays in large JSON documents, each document read by many tasks.

A document is cut into byte ranges. What a byte means depends on whether it stands in a string and
how deep it is nested, which a range cannot know by itself. So each range is first scanned for both
possibilities: how many quotes it holds, and how far it nests if it begins outside or inside a string.
Prefix sums over these few numbers give every range its true state. Then each range finds the
members that begin in it, and reads on past its end for the last one.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import list_files, materialized, open_fs

RANGE_BYTES = 32 << 20
#: Bytes that make a task worth its start, tasks that small ranges are dealt to all the same, and the most
#: tasks; a task takes its ranges one after the other.
TASK_BYTES, FEW_TASKS, MOST_TASKS = 4 << 20, 32, 1 << 14
#: Members of one Arrow batch, and bytes that are read at once beyond a range: few at first, then more.
_ROWS, _LITTLE, _MORE = 2000, 1 << 12, 1 << 20
_QUOTE, _BACKSLASH, _COMMA = 34, 92, 44
_DELTA = np.zeros(256, np.int8)
_DELTA[[91, 123]], _DELTA[[93, 125]] = 1, -1


def byte_ranges(spark: SparkSession, listed: list[tuple[str, int]], size: int) -> DataFrame:
    """(path, size, number, begin, end) of all files, dealt to tasks; an empty file has one range."""
    files = spark.createDataFrame(listed, "path string, size bigint")
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("size") - 1, F.lit(0)), F.lit(size).cast("long"))
    ranges = files.select("path", "size", F.posexplode(starts).alias("number", "begin"))
    ranges = ranges.withColumn("end", F.least(F.col("begin") + size, F.col("size")))
    return ranges.repartition(_tasks(listed, size), "path", "number")


def _tasks(listed: list[tuple[str, int]], size: int) -> int:
    """A task for each range of bytes, or for several small ones: tasks follow the bytes, not the ranges."""
    total = sum(n for _, n in listed)
    return min(MOST_TASKS, 1 + total // size, max(FEW_TASKS, 1 + total // TASK_BYTES))


def _opened(batch: pa.RecordBatch) -> Iterator[tuple[dict, pa.NativeFile]]:
    """The ranges of a batch in the order of their files, each with its file; one file is open at a time."""
    rows = sorted(batch.to_pylist(), key=lambda row: (row["path"], row["begin"]))
    for path, ranges in groupby(rows, key=lambda row: row["path"]):
        files, place = open_fs(path)
        with files.open_input_file(place) as raw:
            for row in ranges:
                yield row, raw


def read_range(raw: pa.NativeFile, begin: int, end: int) -> np.ndarray:
    raw.seek(begin)
    return np.frombuffer(raw.read(end - begin), np.uint8)


def escapes_before(raw: pa.NativeFile, at: int) -> int:
    """1 if the byte at ``at`` follows an odd number of backslashes."""
    count, step = 0, 64
    while at > 0:
        data = read_range(raw, max(0, at - step), at)[::-1]
        other = np.flatnonzero(data != _BACKSLASH)
        count += int(other[0]) if len(other) else len(data)
        if len(other):
            break
        at, step = at - len(data), step * 4
    return count & 1


def quote_marks(data: np.ndarray, escaped: int) -> np.ndarray:
    """Where strings open or close: quotes that an even number of backslashes precedes."""
    quotes = np.flatnonzero(data == _QUOTE)
    slashes = data == _BACKSLASH
    if not slashes.any():
        return quotes[1:] if escaped and len(quotes) and quotes[0] == 0 else quotes
    index = np.arange(len(data))
    run = index - np.maximum.accumulate(np.where(slashes, -1, index))
    # A run that began before these bytes has its first part there.
    opening = int(np.argmin(slashes)) if not slashes.all() else len(data)
    run[:opening] = index[:opening] + 1 + escaped
    before = np.concatenate([[escaped], run[:-1]])
    return quotes[before[quotes] % 2 == 0]


class Scan:
    """Structure of consecutive bytes, given the state before them."""

    def __init__(self, data: np.ndarray, inside: int, depth: int, escaped: int):
        marks = quote_marks(data, escaped)
        at = np.flatnonzero((_DELTA[data] != 0) | (data == _COMMA))
        open_strings = inside + np.searchsorted(marks, at)
        self.at = at[open_strings % 2 == 0]
        self.byte = data[self.at]
        self.delta = _DELTA[self.byte].astype(np.int64)
        self.depth = depth + np.cumsum(self.delta)
        self.inside_after = (inside + len(marks)) % 2
        self.depth_after = int(self.depth[-1]) if len(self.at) else depth


def escaped_after(data: np.ndarray, escaped: int) -> int:
    """Whether the byte after these is escaped."""
    tail = data[::-1]
    other = np.flatnonzero(tail != _BACKSLASH)
    return (int(other[0]) if len(other) else len(data) + escaped) & 1


_SUMMARY = (
    "path string, size bigint, number int, begin bigint, end bigint, escaped int, quotes int, "
    "outside bigint, inside bigint, low_outside bigint, low_inside bigint"
)


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For both states a range may begin in: how deep it goes on, and the least depth on the way."""
    for batch in batches:
        rows = []
        for row, raw in _opened(batch):
            escaped = escapes_before(raw, row["begin"])
            data = read_range(raw, row["begin"], row["end"])
            scans = [Scan(data, inside, 0, escaped) for inside in (0, 1)]
            lows = [int(s.depth.min()) if len(s.depth) else 0 for s in scans]
            rows.append(
                {
                    **row, "escaped": escaped, "quotes": scans[0].inside_after, "outside": scans[0].depth_after,
                    "inside": scans[1].depth_after, "low_outside": min(0, lows[0]), "low_inside": min(0, lows[1]),
                }
            )
        yield _as_batch(rows, _SUMMARY)


def _as_batch(rows: list[dict], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32()}
    fields = [part.split() for part in schema.split(", ")]
    return pa.RecordBatch.from_pylist(rows, pa.schema([(n, kinds[k]) for n, k in fields]))


def _of_tuples(rows: list[tuple], schema: str) -> pa.RecordBatch:
    """``_as_batch`` column by column, for many rows."""
    if not rows:
        return _as_batch([], schema)
    kinds = [pa.string() if part.endswith(" string") else pa.int64() for part in schema.split(", ")]
    names = [part.split()[0] for part in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def scan_states(spark: SparkSession, listed: list[tuple[str, int]], range_bytes: int) -> DataFrame:
    """Every range with its true state: in_string, depth, escaped, and the least depth it reaches."""
    found = byte_ranges(spark, listed, range_bytes).mapInArrow(_summaries, _SUMMARY)
    # One short row for each range of a document.
    before = Window.partitionBy("path").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    string = (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2).cast("int")
    states = found.withColumn("in_string", string)
    nested = F.when(F.col("in_string") == 0, F.col("outside")).otherwise(F.col("inside"))
    low = F.when(F.col("in_string") == 0, F.col("low_outside")).otherwise(F.col("low_inside"))
    states = states.withColumns({"nested": nested, "low": low})
    states = states.withColumn("depth", F.coalesce(F.sum("nested").over(before), F.lit(0)))
    last = F.col("end") == F.col("size")
    whole = (F.col("depth") + F.col("nested") == 0) & ((F.col("in_string") + F.col("quotes")) % 2 == 0)
    torn = F.raise_error(F.concat(F.lit("The document ends before it is closed: "), F.col("path")))
    depth = F.when(last & ~whole, torn.cast("bigint")).otherwise(F.col("depth"))
    return states.select(
        "path", "size", "number", "begin", "end", "escaped", "in_string", depth.alias("depth"), (F.col("depth") + F.col("low")).alias("lowest")
    )


class _Text:
    """Text from some place of a file on, read as far as needed."""

    def __init__(self, raw: pa.NativeFile, at: int):
        self.raw, self.at, self.data, self.step = raw, at, b"", 4096

    def more(self) -> bool:
        self.raw.seek(self.at + len(self.data))
        new = self.raw.read(self.step)
        self.data, self.step = self.data + new, self.step * 4
        return bool(new)

    def value(self, start: int) -> tuple[object, int]:
        """The JSON value at byte ``start`` of the text, and the byte after it."""
        decoder = json.JSONDecoder()
        while True:
            text = self.data[start:].decode("utf-8", "ignore")
            try:
                value, used = decoder.raw_decode(text)
                end = start + len(text[:used].encode())
                # A number at the end of what was read may go on.
                if end < len(self.data) or not self.more():
                    return value, end
            except json.JSONDecodeError:
                if not self.more():
                    raise

    def skip(self, start: int, chars: bytes = b" \t\r\n") -> int:
        while True:
            while start < len(self.data) and self.data[start] in chars:
                start += 1
            if start < len(self.data) or not self.more():
                return start


_PAIRS = "path string, at bigint, key string, value_at bigint, scalar string"


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys of the outermost object, and where it closes (without a key)."""
    for batch in batches:
        rows = []
        for row, raw in _opened(batch):
            data = read_range(raw, row["begin"], row["end"])
            scan = Scan(data, row["in_string"], row["depth"], row["escaped"])
            begins = ((scan.byte == 123) | (scan.byte == _COMMA)) & (scan.depth == 1)
            for at in scan.at[begins].tolist():
                text = _Text(raw, row["begin"] + at + 1)
                start = text.skip(0)
                if text.data[start : start + 1] != b'"':
                    continue
                key, start = text.value(start)
                start = text.skip(start, b" \t\r\n:")
                scalar = None
                if text.data[start : start + 1] not in (b"{", b"["):
                    scalar = json.dumps(text.value(start)[0])
                rows.append(
                    {"path": row["path"], "at": row["begin"] + at, "key": key, "value_at": text.at + start, "scalar": scalar}
                )
            for at in scan.at[(scan.depth == 0) & (scan.delta < 0)].tolist():
                rows.append({"path": row["path"], "at": row["begin"] + at, "key": None, "value_at": None, "scalar": None})
        yield _as_batch(rows, _PAIRS)


def outer_pairs(states: DataFrame) -> DataFrame:
    """(path, key, value_at, until, scalar) of the outermost object of each document.

    Scalars are JSON text. Only ranges that reach that depth are read again.
    """
    near = states.filter(F.col("lowest") <= 1).select("path", "begin", "end", "in_string", "depth", "escaped")
    found = near.mapInArrow(_pairs, _PAIRS)
    until = F.lead("at").over(Window.partitionBy("path").orderBy("at"))
    return found.withColumn("until", until).filter(F.col("key").isNotNull()).select("path", "key", "value_at", "until", "scalar")


_MEMBERS = "path string, at bigint, member string"


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = []
    for batch in batches:
        for row, raw in _opened(batch):
            for at, text in _members_of(raw, row):
                rows.append({"path": row["path"], "at": at, "member": text})
                if len(rows) == _ROWS:
                    yield _as_batch(rows, _MEMBERS)
                    rows = []
    yield _as_batch(rows, _MEMBERS)


def _members_of(raw: pa.NativeFile, row: dict) -> Iterator[tuple[int, str]]:
    """Place and text of the members whose preceding bracket or comma is in the range."""
    data = read_range(raw, row["begin"], row["end"])
    scan = Scan(data, row["in_string"], row["depth"], row["escaped"])
    place = scan.at + row["begin"]
    within = (place >= row["value_at"]) & (place < row["until"])
    # The array's bracket nests to depth 2, its commas stand there, and its end leaves it.
    edge = within & (((scan.depth == 2) & ((scan.byte == _COMMA) | (place == row["value_at"]))) | ((scan.depth == 1) & (scan.byte == 93)))
    at, closes = scan.at[edge], scan.byte[edge] == 93
    for i in range(len(at) - 1):
        if not closes[i]:
            yield from _member(data[at[i] + 1 : at[i + 1]].tobytes(), row["begin"] + int(at[i]) + 1)
    if not len(at) or closes[-1]:
        return
    # The last member may end in a later range.
    start = int(at[-1]) + 1
    text, end, step = [data[start:].tobytes()], row["end"], _LITTLE
    inside, depth, escaped = scan.inside_after, scan.depth_after, escaped_after(data, row["escaped"])
    while end < row["until"]:
        more = read_range(raw, end, min(row["until"], end + step))
        if not len(more):
            break
        scan = Scan(more, inside, depth, escaped)
        stop = scan.at[((scan.depth == 2) & (scan.byte == _COMMA)) | (scan.depth == 1)]
        if len(stop):
            text.append(more[: int(stop[0])].tobytes())
            break
        text.append(more.tobytes())
        inside, depth, escaped = scan.inside_after, scan.depth_after, escaped_after(more, escaped)
        end, step = end + len(more), min(_MORE, step * 4)
    yield from _member(b"".join(text), row["begin"] + start)


def _member(text: bytes, at: int) -> Iterator[tuple[int, str]]:
    bare = text.lstrip(b" \t\r\n")
    if bare:
        yield at + len(text) - len(bare), bare.rstrip(b" \t\r\n").decode()


def json_members(
    spark: SparkSession, listed: list[tuple[str, int]], key: str, range_bytes: int = RANGE_BYTES, keep: list[str] | None = None
) -> DataFrame:
    """(path, at, member): the members of the array ``key`` of each document's outermost object.

    ``listed`` has paths and sizes. ``at`` is the byte a member begins at, which orders them; members are JSON
    text. ``keep`` adds columns of the object's scalars of these names, as JSON text. A document that is cut off, or
    that lacks the array, is an error. The states of the ranges are written once; they are
    a row for each range.
    """
    keep = keep or []
    states = materialized(scan_states(spark, listed, range_bytes), "json-states")
    pairs = materialized(outer_pairs(states), "json-pairs")
    arrays = pairs.filter((F.col("key") == key) & F.col("scalar").isNull()).select("path", "value_at", "until")
    lacking = F.raise_error(F.concat(F.lit(f"No array {key} in "), F.col("path"))).cast("boolean")
    inside = (F.col("begin") < F.col("until")) & (F.col("end") > F.col("value_at"))
    touched = states.join(arrays, "path", "left").filter(F.when(F.col("value_at").isNull(), lacking).otherwise(inside))
    columns = ["path", "begin", "end", "in_string", "depth", "escaped", "value_at", "until"]
    found = touched.select(*columns).repartition(_tasks(listed, range_bytes), "path", "begin")
    members = found.mapInArrow(_members, _MEMBERS)
    for name in keep:
        one = pairs.filter(F.col("key") == name).select("path", F.col("scalar").alias(name))
        members = members.join(one, "path", "left")
    return members


_LINES = "path string, at bigint, line string"


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            rows = []
            for at, line in lines_of(row):
                rows.append({"path": row["path"], "at": at, "line": line.decode("utf-8", "replace")})
                if len(rows) == _ROWS:
                    yield _as_batch(rows, _LINES)
                    rows = []
            yield _as_batch(rows, _LINES)


def lines_of(row: dict) -> Iterator[tuple[int, bytes]]:
    """Place and bytes of the lines that begin in a range of a file, the last one whole."""
    files, place = open_fs(row["path"])
    with files.open_input_file(place) as raw:
        begin, end = row["begin"], row["end"]
        first = max(0, begin - 1)
        data, step = read_range(raw, first, end).tobytes(), _LITTLE
        while data and not data.endswith(b"\n"):
            raw.seek(first + len(data))
            more, step = raw.read(step), min(_MORE, step * 4)
            if not more:
                break
            cut = more.find(b"\n")
            data += more if cut < 0 else more[: cut + 1]
    if begin:
        cut = data.find(b"\n")
        if cut < 0 or first + cut + 1 >= end:
            return
        at, data = first + cut + 1, data[cut + 1 :]
    else:
        at = 0
    lines = data.split(b"\n")
    if lines and not lines[-1]:
        lines.pop()
    for line in lines:
        if at >= end:
            return
        yield at, line.removesuffix(b"\r")
        at += len(line) + 1


def text_lines(spark: SparkSession, listed: list[tuple[str, int]], range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(path, at, line): every line with the byte it begins at, files read by ranges."""
    return byte_ranges(spark, listed, range_bytes).mapInArrow(_lines, _LINES)


def _first_mark(marks: list[re.Pattern], line: bytes) -> int:
    return next((i for i, mark in enumerate(marks) if mark.fullmatch(line)), -1)


def numbered_lines(
    spark: SparkSession, listed: list[tuple[str, int]], marks: dict[str, bytes], range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """(path, at, line, mark, …): every line, the first of ``marks`` that is its pattern, and how many lines have each mark before it.

    ``marks`` gives patterns of whole lines by name; the counts are columns of these names, over all files in the order
    of their paths. Each range is scanned once to count, which is written as a row for each range; with prefix sums over
    these a second scan numbers the lines where they stand. No line is sorted or sent anywhere.
    """
    names, patterns = list(marks), [re.compile(m, re.DOTALL) for m in marks.values()]
    counts_schema = "path string, number int, begin bigint, end bigint, " + ", ".join(f"{n} bigint" for n in names)
    lines_schema = "path string, at bigint, line string, mark string, " + ", ".join(f"{n} bigint" for n in names)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                found = Counter(_first_mark(patterns, line) for _, line in lines_of(row))
                rows.append({**row, **{n: found[i] for i, n in enumerate(names)}})
            yield _as_batch(rows, counts_schema)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                before, rows = [row[n] for n in names], []
                for at, line in lines_of(row):
                    mark = _first_mark(patterns, line)
                    rows.append((row["path"], at, line.decode("utf-8", "replace"), names[mark] if mark >= 0 else None, *before))
                    if mark >= 0:
                        before[mark] += 1
                    if len(rows) == _ROWS:
                        yield _of_tuples(rows, lines_schema)
                        rows = []
                yield _of_tuples(rows, lines_schema)

    counted = byte_ranges(spark, listed, range_bytes).mapInArrow(count, counts_schema)
    counted = materialized(counted, "line-counts")
    # One short row for each range of a file.
    earlier = Window.orderBy("path", "number").rowsBetween(Window.unboundedPreceding, -1)
    sums = {n: F.coalesce(F.sum(n).over(earlier), F.lit(0)) for n in names}
    placed = counted.withColumns(sums).repartition(_tasks(listed, range_bytes), "path", "number")
    return placed.mapInArrow(number, lines_schema)


def sized(paths: str | list[str], suffixes: tuple[str, ...]) -> list[tuple[str, int]]:
    return [f for one in ([paths] if isinstance(paths, str) else paths) for f in list_files(one, suffixes)]
