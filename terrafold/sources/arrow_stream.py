"""Arrow IPC stream files as a Spark data source, one file per partition."""

from __future__ import annotations

import pyarrow as pa
from pyarrow import ipc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import from_arrow_type

from ..functions.types import BOX_TYPE, storage_type
from .files import GeometryFileWriter, from_fixed, tag_from_field
from .shared import current_version, list_files, open_fs

SUFFIX = ".arrows"
#: Column for the number of the batch of its file that a row came in.
CHUNK = "chunk"
_POSITION = [T.StructField("file_name", T.StringType()), T.StructField("row_index", T.LongType())]


def stream_schema(path: str) -> pa.Schema:
    files, place = open_fs(path)
    with files.open_input_stream(place) as raw, ipc.open_stream(raw) as reader:
        return reader.schema


def _spark_field(field: pa.Field) -> T.StructField:
    tag = tag_from_field(field)
    if tag is None:
        return T.StructField(field.name, from_arrow_type(field.type), field.nullable)
    if tag.encoding == "native":
        kind = storage_type(tag.kind, tag.dims, tag.layout)
    else:
        kind = BOX_TYPE if tag.encoding == "box" else tag.storage
    return T.StructField(field.name, kind, True, tag.to_metadata())


class StreamFile(InputPartition):
    def __init__(self, path: str):
        self.path = path


class StreamReader(DataSourceReader):
    def __init__(self, listed: list[tuple[str, int]], positions: bool, chunks: bool):
        self.listed, self.positions, self.chunks = listed, positions, chunks

    def partitions(self):
        return [StreamFile(p) for p, _ in self.listed]

    def read(self, partition):
        files, place = open_fs(partition.path)
        name, at = place.rpartition("/")[2], 0
        with files.open_input_stream(place) as raw, ipc.open_stream(raw) as reader:
            for number, batch in enumerate(reader):
                columns = [from_fixed(c) for c in batch.columns]
                names = list(batch.schema.names)
                if self.positions:
                    columns.append(pa.array([name] * batch.num_rows, pa.string()))
                    columns.append(pa.array(range(at, at + batch.num_rows), pa.int64()))
                    names += ["file_name", "row_index"]
                if self.chunks:
                    columns.append(pa.array([number] * batch.num_rows, pa.int64()))
                    names.append(CHUNK)
                at += batch.num_rows
                yield pa.RecordBatch.from_arrays(columns, names)


class StreamWriter(GeometryFileWriter):
    suffix = SUFFIX

    def open_sink(self, handle, schema):
        compression = None if self.compression == "none" else self.compression
        return ipc.new_stream(handle, schema, options=ipc.IpcWriteOptions(compression=compression))

    def write_rows(self, sink, table):
        for batch in table.combine_chunks().to_batches():
            sink.write_batch(batch)

    def group_bound(self, table):
        # Buffers that compression does not shrink are stored as they are.
        return sum(ipc.get_record_batch_size(b) + 4096 for b in table.combine_chunks().to_batches())


class ArrowStream(DataSource):
    @classmethod
    def name(cls):
        return "arrow_stream"

    def _flag(self, name: str) -> bool:
        return str(self.options.get(name, "false")).lower() == "true"

    def _listed(self) -> list[tuple[str, int]]:
        return list_files(self.options["path"], (SUFFIX,), self.options.get("version"))

    def schema(self):
        found = self._listed()
        if not found:
            raise ValueError(f"No Arrow stream files in {self.options['path']}")
        fields = [_spark_field(f) for f in stream_schema(found[0][0])]
        chunk = [T.StructField(CHUNK, T.LongType())] if self._flag("chunks") else []
        return T.StructType(fields + (_POSITION if self._flag("row_index") else []) + chunk)

    def reader(self, schema):
        return StreamReader(self._listed(), self._flag("row_index"), self._flag("chunks"))

    def writer(self, schema, overwrite):
        return StreamWriter(schema, self.options, overwrite)


def read_arrow(spark: SparkSession, path: str, row_index: bool = False, chunks: bool = False) -> DataFrame:
    """Stream files with their geometry tag; ``row_index`` adds file_name and row_index.

    ``chunks`` adds the number of the batch a row came in, which a sink's ``chunk_column`` takes. Of an
    output with versions the table stays the one that is current now.
    """
    spark.dataSource.register(ArrowStream)
    reader = spark.read.format("arrow_stream").options(row_index=str(row_index), chunks=str(chunks))
    if "*" not in path and (version := current_version(path)):
        reader = reader.option("version", version)
    return reader.load(path)


def write_arrow(
    df: DataFrame, path: str, compression: str = "zstd", batch_rows: int = 100_000,
    overwrite: bool = False, **options: str,
) -> None:
    """Stream files of each partition, batches of at most ``batch_rows``; see GeometryFileWriter for the bounds."""
    df.sparkSession.dataSource.register(ArrowStream)
    (
        df.write.format("arrow_stream")
        .mode("overwrite" if overwrite else "append")
        .options(compression=compression, rows=batch_rows, **options)
        .save(path)
    )
