"""What the file sinks share: Arrow forms of geometry columns and the commit of whole writes."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.types import BOX_FIELDS, GEOMETRY, NESTING, GeometryTag, tag_of
from ..functions.wkb import encode_array
from .shared import VERSION_PREFIX, open_fs, switch_version

EXTENSION_NAME = b"ARROW:extension:name"
EXTENSION_METADATA = b"ARROW:extension:metadata"
TAG_KEY = b"terrafold.tag"
# Fixed value: the most bytes a published file may have.
SIZE_LIMIT = 2**31 - 1
#: Bytes of a row group before it is encoded.
GROUP_BYTES = 128 << 20
# Readers that register extension types look for a prefix of their own; see the README.
DEFAULT_PREFIX = "geometry"


def extension_fields(tag: GeometryTag, prefix: str) -> dict[bytes, bytes]:
    kind = tag.kind if tag.encoding == "native" else tag.encoding
    stated = {"crs": tag.crs, "crs_type": tag.crs_type, "edges": tag.edges}
    described = {k: v for k, v in stated.items() if v is not None}
    return {
        EXTENSION_NAME: f"{prefix}.{kind}".encode(),
        EXTENSION_METADATA: json.dumps(described).encode(),
    }


def tag_from_field(field: pa.Field) -> GeometryTag | None:
    """Tag of an Arrow field by its extension name and type."""
    metadata = field.metadata or {}
    if EXTENSION_NAME not in metadata:
        return None
    if TAG_KEY in metadata:
        return GeometryTag(**{"dims": None, **json.loads(metadata[TAG_KEY])})
    name = metadata[EXTENSION_NAME].decode().rpartition(".")[2]
    described = json.loads(metadata.get(EXTENSION_METADATA) or b"{}")
    extra = {k: described[k] for k in ("crs", "crs_type", "edges") if described.get(k)}
    if name in ("wkb", "wkt"):
        return GeometryTag(name, None, None, **extra)
    if name == "box":
        return GeometryTag("box", **extra)
    inner = field.type
    while pa.types.is_list(inner) or pa.types.is_large_list(inner):
        inner = inner.value_type
    if pa.types.is_fixed_size_list(inner):
        return GeometryTag("native", name, inner.value_field.name, "interleaved", **extra)
    return GeometryTag("native", name, "".join(f.name for f in inner), **extra)


def _offsets(arr: pa.Array) -> pa.Array:
    ends = np.zeros(len(arr) + 1, dtype=np.int32)
    np.cumsum(arr.value_lengths().fill_null(0).to_numpy(), out=ends[1:])
    return pa.array(ends)


def _mask(arr: pa.Array):
    return arr.is_null() if arr.null_count else None


def to_fixed(arr: pa.Array, depth: int, dims: str) -> pa.Array:
    """Variable lists of ordinates to fixed-size lists named by their dimensions."""
    if depth:
        inner = to_fixed(arr.flatten(), depth - 1, dims)
        return pa.ListArray.from_arrays(_offsets(arr), inner, mask=_mask(arr))
    size = len(dims)
    values = np.full((len(arr), size), np.nan)
    mask = arr.is_valid().to_numpy(zero_copy_only=False)
    values[mask] = arr.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
    kind = pa.list_(pa.field(dims, pa.float64(), False), size)
    flat = pa.array(values.reshape(-1))
    return pa.FixedSizeListArray.from_arrays(flat, type=kind, mask=_mask(arr))


def from_fixed(arr: pa.Array) -> pa.Array:
    """Fixed-size lists anywhere inside to the variable lists Spark knows."""
    if pa.types.is_list(arr.type):
        return pa.ListArray.from_arrays(_offsets(arr), from_fixed(arr.flatten()), mask=_mask(arr))
    if not pa.types.is_fixed_size_list(arr.type):
        return arr
    size = arr.type.list_size
    lengths = np.where(arr.is_valid().to_numpy(zero_copy_only=False), size, 0)
    ends = np.zeros(len(arr) + 1, dtype=np.int32)
    np.cumsum(lengths, out=ends[1:])
    return pa.ListArray.from_arrays(pa.array(ends), arr.flatten(), mask=_mask(arr))


def to_file_form(arr: pa.Array, tag: GeometryTag) -> pa.Array:
    if tag.encoding == "box":
        fields = [pa.field(n, pa.float64(), False) for n in BOX_FIELDS]
        columns = [arr.field(n).fill_null(float("nan")) for n in BOX_FIELDS]
        return pa.StructArray.from_arrays(columns, fields=fields, mask=_mask(arr))
    if tag.encoding == "native" and tag.layout == "interleaved":
        return to_fixed(arr, NESTING[tag.kind], tag.dims)
    return arr


@dataclass
class FileWritten(WriterCommitMessage):
    """Names of the files a task has finished."""

    names: list[str]


class OpenPart:
    """A file being written, with the facts its footer will state."""

    def __init__(self, writer: GeometryFileWriter, files: fs.FileSystem, place: str, schema: pa.Schema):
        self.writer, self.place, self.files = writer, place, files
        self.handle = files.open_output_stream(place)
        self.sink = writer.open_sink(self.handle, schema)
        self.state: dict = {}
        self.groups = self.rows = 0

    def room_for(self, table: pa.Table) -> bool:
        """Whether another group certainly fits, the footer included."""
        more = self.writer.group_bound(table) + self.writer.footer_bound(table, self.groups + 1)
        return self.handle.tell() + more <= self.writer.max_bytes

    def add(self, table: pa.Table, geometry: pa.ChunkedArray | None) -> None:
        if geometry is not None:
            for piece in geometry.chunks:
                self.writer.observe(self.state, piece)
        if table.num_rows:
            self.writer.write_rows(self.sink, table)
            self.groups += 1
            self.rows += table.num_rows

    def close(self) -> None:
        self.writer.finish(self.sink, self.state)
        self.handle.close()
        size = self.files.get_file_info(self.place).size
        if size > self.writer.max_bytes:
            raise ValueError(f"A row group makes a file of {size} bytes; at most {self.writer.max_bytes} are allowed")


class GeometryFileWriter(DataSourceArrowWriter):
    """Files of bounded size, one or more per task, that appear together when the job commits.

    Encoded bytes are counted as they are written. Before a row group that might not fit, the
    file is closed with a footer of its own and a further part begun. Row groups are bounded by
    rows and by bytes; with ``chunk_column`` they end where that column's value changes, and the
    column is left out.

    Tasks write beside the target under their final names, and a task that is tried again writes files of
    its own. A new target appears by one rename of the folder. A ``versioned`` target keeps every
    write as a folder of its own; its commit lists the files of the successful attempts and
    switches one small file that names the version, so nothing is renamed. Only writes into a folder that
    is there already move their files one by one.
    """

    suffix = ""

    def __init__(self, schema: T.StructType, options, overwrite: bool):
        self.schema = schema
        self.path = options["path"].rstrip("/")
        self.rows = int(options.get("rows", options.get("row_group_rows", 100_000)))
        self.max_bytes = int(options.get("max_file_bytes", SIZE_LIMIT))
        self.group_bytes = min(int(options.get("row_group_bytes", GROUP_BYTES)), max(1, self.max_bytes // 4))
        self.chunk_column = options.get("chunk_column")
        self.compression = options.get("compression", "zstd")
        self.prefix = options.get("extension_prefix", DEFAULT_PREFIX)
        self.overwrite = overwrite
        self.versioned = options.get("versioned", "false").lower() == "true"
        # Native columns that the file holds as WKB cross into Python once, as they are.
        self.encode = options.get("encode_wkb", "false").lower() == "true"
        self.tags = {GEOMETRY: tag_of(schema[GEOMETRY])} if GEOMETRY in schema.names else {}
        self.run = uuid.uuid4().hex[:12]

    # Subclasses open a sink for (file handle, schema) and may gather facts for a footer
    # from the geometry column as it comes from Spark.
    def open_sink(self, handle, schema: pa.Schema):
        raise NotImplementedError

    def write_rows(self, sink, table: pa.Table) -> None:
        raise NotImplementedError

    def group_bound(self, table: pa.Table) -> int:
        """Bytes that a group cannot exceed once it is encoded."""
        raise NotImplementedError

    def footer_bound(self, table: pa.Table, groups: int) -> int:
        return 64

    def observe(self, state: dict, geometry: pa.Array) -> None:
        pass

    def finish(self, sink, state: dict) -> None:
        sink.close()

    def _convert(self, batch: pa.RecordBatch) -> pa.Table:
        columns, fields = [], []
        for field, column in zip(batch.schema, batch.columns):
            if field.name == self.chunk_column:
                continue
            tag = self.tags.get(field.name)
            if tag is None:
                columns.append(column)
                fields.append(pa.field(field.name, column.type, field.nullable))
                continue
            if self.encode:
                column = encode_array(column, tag.kind, tag.dims)
                tag = tag.with_(encoding="wkb")
            column = to_file_form(column, tag)
            metadata = extension_fields(tag, self.prefix)
            metadata[TAG_KEY] = json.dumps(tag.to_metadata()["terrafold.geometry"]).encode()
            columns.append(column)
            fields.append(pa.field(field.name, column.type, True, metadata))
        return pa.Table.from_arrays(columns, schema=pa.schema(fields))

    def _within_bounds(self, table: pa.Table, start: int, stop: int) -> int:
        """Rows from ``start`` that make one group: as many as rows and bytes allow, one at least."""
        most = min(stop - start, self.rows)
        if table.slice(start, most).nbytes <= self.group_bytes:
            return most
        low, high = 1, most
        while low < high:
            mid = (low + high + 1) // 2
            if table.slice(start, mid).nbytes <= self.group_bytes:
                low = mid
            else:
                high = mid - 1
        return low

    def _groups(self, iterator):
        """(rows in file form, geometry as it came) of each row group."""
        waiting: list[pa.Table] = []
        raw: list[pa.Array] = []
        chunks: list[np.ndarray] = []
        size = count = 0

        def cut(everything: bool):
            """Whole groups of what waits; the rest stays unless it is all there is."""
            nonlocal waiting, raw, chunks, size, count
            table, start = pa.concat_tables(waiting), 0
            geometry = pa.chunked_array(raw) if raw else None
            ends = np.array([count])
            if self.chunk_column is not None:
                ends = np.append(np.flatnonzero(np.diff(np.concatenate(chunks))) + 1, count)
            for end in ends.tolist():
                while start < end:
                    n = self._within_bounds(table, start, end)
                    if start + n == count and not everything:
                        # More rows of this group may follow.
                        break
                    yield table.slice(start, n), None if geometry is None else geometry.slice(start, n)
                    start += n
            rest = table.slice(start)
            waiting, count, size = [rest], rest.num_rows, rest.nbytes
            raw = [] if geometry is None else geometry.slice(start).chunks
            chunks = [np.concatenate(chunks)[start:]] if chunks else []

        for batch in iterator:
            table = self._convert(batch)
            waiting.append(table)
            if GEOMETRY in self.tags:
                raw.append(batch.column(GEOMETRY))
            if self.chunk_column is not None:
                chunks.append(batch.column(self.chunk_column).to_numpy(zero_copy_only=False))
            count += table.num_rows
            size += table.nbytes
            if count > self.rows or size > self.group_bytes:
                yield from cut(False)
        if waiting:
            yield from cut(True)

    def _target(self, place: str) -> str:
        return f"{place}/{VERSION_PREFIX}{self.run}" if self.versioned else f"{place}._new-{self.run}"

    def write(self, iterator):
        number = TaskContext.get().partitionId()
        attempt = uuid.uuid4().hex[:8]
        files, place = open_fs(self.path)
        target = self._target(place)
        files.create_dir(target, recursive=True)
        iterator = iter(iterator)
        first = next(iterator, None)
        empty = None
        if first is None and number == 0:
            # So that an empty table leaves a file with its schema.
            empty = self._convert(pa.RecordBatch.from_pylist([], schema=to_arrow_schema(self.schema)))
        names: list[str] = []
        part = None
        groups = self._groups(chain([] if first is None else [first], iterator))
        for table, geometry in chain([] if empty is None else [(empty, None)], groups):
            if part is not None and not part.room_for(table):
                part.close()
                part = None
            if part is None:
                names.append(f"part-{number:05d}-{len(names):04d}-{self.run}-{attempt}{self.suffix}")
                part = OpenPart(self, files, f"{target}/{names[-1]}", table.schema)
            part.add(table, geometry)
        if part is not None:
            part.close()
        return FileWritten(names)

    def commit(self, messages):
        files, place = open_fs(self.path)
        target = self._target(place)
        names = [n for message in messages if message is not None for n in message.names]
        if self.versioned:
            files.create_dir(target, recursive=True)
            switch_version(files, place, f"{VERSION_PREFIX}{self.run}", names)
            return
        files.create_dir(target, recursive=True)
        there = files.get_file_info(place).type == fs.FileType.Directory
        if there:
            if self.overwrite:
                for item in files.get_file_info(fs.FileSelector(place)):
                    if item.type == fs.FileType.File:
                        files.delete_file(item.path)
            for name in names:
                files.move(f"{target}/{name}", f"{place}/{name}")
            files.delete_dir(target)
        else:
            # Attempts that failed may have left files.
            kept = set(names)
            for item in files.get_file_info(fs.FileSelector(target)):
                if item.base_name not in kept:
                    files.delete_file(item.path)
            files.move(target, place)
        with files.open_output_stream(f"{place}/_SUCCESS") as done:
            done.write(b"")

    def abort(self, messages):
        files, place = open_fs(self.path)
        target = self._target(place)
        if files.get_file_info(target).type == fs.FileType.Directory:
            files.delete_dir(target)
