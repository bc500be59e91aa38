"""Web archives packed into ZIP files: written by Spark tasks, read back by byte ranges.

A package is a ZIP of stored members: archive/data.warc.gz, one gzip member per record, and
indexes/index.cdxj, one line per record with its place. The reader looks at the end of a file for
the central directory (plain or ZIP64), finds where the stored members begin, reads the index and
then only the ranges of records; nothing is unpacked.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import fresh_path, open_fs

#: Bytes after which a task begins another package, bytes of one range read, gzip level.
PACKAGE_BYTES, RANGE_BYTES, LEVEL = 256 << 20, 4 << 20, 1
#: Parts that the rows of one payload are dealt to.
SALTS = 16
ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
_DATE = "2024-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_MANIFEST = "path string, bytes long, records long"
_MEMBERS = "path string, name string, begin long, size long"
_PLACES = "path string, begin long, length long"
_RECORDS = "record_id string, url string, record_type string, refers_to string, payload_bytes long, payload_digest string, payload binary"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(key: str, url: str, payload: bytes, size: int, digest: str, refers_to: str | None) -> bytes:
    """One WARC record; a revisit keeps the HTTP headers and leaves the payload out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{key}>",
        f"WARC-Target-URI: {' '.join(url.split())}",
        f"WARC-Date: {_DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {_PROFILE}"]
    return "\r\n".join(lines).encode("utf-8", "replace") + b"\r\n\r\n" + block + b"\r\n\r\n"


class _Sink:
    """An output stream as zipfile wants it: it can be written and told, never sought."""

    def __init__(self, stream: pa.NativeFile) -> None:
        self.stream, self.at = stream, 0

    def write(self, data: bytes) -> int:
        self.stream.write(data)
        self.at += len(data)
        return len(data)

    def tell(self) -> int:
        return self.at

    def flush(self) -> None:
        pass


def _stored_member(name: str) -> zipfile.ZipInfo:
    info = zipfile.ZipInfo(name, (2024, 1, 1, 0, 0, 0))
    info.compress_type = zipfile.ZIP_STORED
    return info


def package_writer(folder: str, package_bytes: int):
    """A function over batches of (_key, _url, _payload, _size, _hex, _refers) that writes packages."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, place = open_fs(folder)
        files.create_dir(place, recursive=True)
        rows = (row for batch in batches for at in range(0, batch.num_rows, 64) for row in batch.slice(at, 64).to_pylist())
        row = next(rows, None)
        while row is not None:
            # A name of its own for every attempt: what a lost attempt leaves is never listed.
            name = f"{uuid.uuid4().hex}.zip"
            index: list[str] = []
            with files.open_output_stream(f"{place}/{name}") as stream:
                sink = _Sink(stream)
                with zipfile.ZipFile(sink, "w", zipfile.ZIP_STORED) as package:
                    with package.open(_stored_member(ARCHIVE), "w", force_zip64=True) as member:
                        offset = 0
                        while row is not None and offset < package_bytes:
                            digest = base64.b32encode(bytes.fromhex(row["_hex"])).decode()
                            record = record_bytes(
                                row["_key"], row["_url"], row["_payload"] or b"", row["_size"], digest, row["_refers"]
                            )
                            packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                            packed = packer.compress(record) + packer.flush()
                            member.write(packed)
                            fields = {"url": row["_url"], "digest": f"sha1:{digest}", "offset": offset, "length": len(packed), "filename": ARCHIVE}
                            index.append(f"{row['_key']} 20240101000000 {json.dumps(fields)}\n")
                            offset += len(packed)
                            row = next(rows, None)
                    with package.open(_stored_member(INDEX), "w", force_zip64=True) as member:
                        for line in index:
                            member.write(line.encode())
                size = sink.at
            yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "bytes": [size], "records": [len(index)]})

    return write


def write_packages(
    pages: DataFrame,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    least: int = 0,
    package_bytes: int = PACKAGE_BYTES,
) -> DataFrame:
    """Write one record per row into packages in the shared folder; the manifest (path, bytes, records).

    Of rows with equal payloads of at least ``least`` bytes the one with the largest id is the
    response and the others revisit it; repeated rows with that id are all responses. A null
    payload is empty, a null id is smaller than any other. The manifest lists only what tasks that
    ended well have written.
    """
    spark = pages.sparkSession
    payload = F.encode(F.coalesce(payload_col, F.lit("")), "UTF-8")
    rows = pages.select(
        F.col(id_col).cast("long").alias("_id"),
        F.coalesce(F.col(url_col), F.lit("")).alias("_url"),
        payload.alias("_payload"),
        F.length(payload).cast("long").alias("_size"),
        F.sha1(payload).alias("_hex"),
    )
    # Only digests that occur twice travel; one that a third of all rows share is one row of these.
    groups = rows.filter(F.col("_size") >= least).groupBy("_hex").agg(F.max("_id").alias("_top"), F.count("*").alias("_n"))
    groups = groups.filter("_n > 1").select("_hex", "_top", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    # A payload of very many rows meets its digest in as many tasks as there are salts.
    joined = rows.withColumn("_salt", F.pmod(F.xxhash64("_id", "_url"), F.lit(SALTS)).cast("int")).join(groups, ["_hex", "_salt"], "left")
    revisits = F.col("_top").isNotNull() & ~F.col("_id").eqNullSafe(F.col("_top"))
    records = joined.select(
        F.coalesce(F.col("_id").cast("string"), F.lit("null")).alias("_key"),
        "_url",
        F.when(~revisits, F.col("_payload")).alias("_payload"),
        "_size",
        "_hex",
        F.when(revisits, F.col("_top").cast("string")).alias("_refers"),
    )
    folder = fresh_path(spark, "packages")
    manifest = fresh_path(spark, "manifest")
    records.mapInArrow(package_writer(folder, package_bytes), _MANIFEST).write.parquet(manifest)
    return spark.read.parquet(manifest)


class Package:
    """A ZIP file read by ranges."""

    def __init__(self, path: str) -> None:
        files, place = open_fs(path)
        self.path = path
        self.size = files.get_file_info(place).size
        self.file = files.open_input_file(place)

    def read(self, begin: int, size: int) -> bytes:
        self.file.seek(begin)
        return self.file.read(size)

    def directory(self) -> tuple[int, int, int]:
        """Where the central directory begins, its bytes and its entries."""
        tail_at = max(0, self.size - 65_557)
        tail = self.read(tail_at, self.size - tail_at)
        at = tail.rfind(b"PK\x05\x06")
        if at < 0 or len(tail) - at < 22:
            raise ValueError(f"{self.path}: no end of a central directory")
        entries, size, begin = struct.unpack("<HII", tail[at + 10 : at + 20])
        locator = tail[at - 20 : at] if at >= 20 else b""
        if locator[:4] == b"PK\x06\x07":
            # ZIP64: the locator names a larger end record.
            end_at = struct.unpack("<Q", locator[8:16])[0]
            end = self.read(end_at, 56)
            if end[:4] != b"PK\x06\x06":
                raise ValueError(f"{self.path}: ZIP64 end record not where its locator says")
            entries, size, begin = struct.unpack("<QQQ", end[32:56])
        return begin, size, entries

    def members(self) -> Iterator[tuple[str, int, int, int]]:
        """(name, method, begin of the data, stored bytes) of every member."""
        begin, size, entries = self.directory()
        listing, at = self.read(begin, size), 0
        for _ in range(entries):
            if listing[at : at + 4] != b"PK\x01\x02":
                raise ValueError(f"{self.path}: damaged central directory")
            method = struct.unpack("<H", listing[at + 10 : at + 12])[0]
            packed, plain, names, extras, comments = struct.unpack("<IIHHH", listing[at + 20 : at + 34])
            header = struct.unpack("<I", listing[at + 42 : at + 46])[0]
            name = listing[at + 46 : at + 46 + names].decode("utf-8", "replace")
            extra = listing[at + 46 + names : at + 46 + names + extras]
            while len(extra) >= 4:
                kind, length = struct.unpack("<HH", extra[:4])
                if kind == 1:
                    # 64-bit values stand in for those that are all ones, in this order.
                    wide = iter(struct.unpack(f"<{length // 8}Q", extra[4 : 4 + length // 8 * 8]))
                    plain = next(wide) if plain == 0xFFFFFFFF else plain
                    packed = next(wide) if packed == 0xFFFFFFFF else packed
                    header = next(wide) if header == 0xFFFFFFFF else header
                extra = extra[4 + length :]
            # The local header has name and extra lengths of its own.
            local = self.read(header, 30)
            if local[:4] != b"PK\x03\x04":
                raise ValueError(f"{self.path}: no local header of {name}")
            own_name, own_extra = struct.unpack("<HH", local[26:30])
            yield name, method, header + 30 + own_name + own_extra, packed
            at += 46 + names + extras + comments


def list_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column("path").to_pylist():
            rows = []
            for name, method, begin, size in Package(path).members():
                if method != zipfile.ZIP_STORED:
                    raise ValueError(f"{path}: {name} is compressed, its records have no ranges")
                rows.append((path, name, begin, size))
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64(), pa.int64()), strict=True)],
                ["path", "name", "begin", "size"],
            )


def read_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Absolute range of each record, from the index members; read a piece at a time."""
    for batch in batches:
        for row in batch.to_pylist():
            package = Package(row["path"])
            starts = json.loads(row["archives"])
            at, end, rest = row["begin"], row["begin"] + row["size"], b""
            while at < end or rest:
                data = rest + package.read(at, min(RANGE_BYTES, end - at))
                at += min(RANGE_BYTES, end - at)
                lines = data.split(b"\n")
                rest = lines.pop() if at < end else b""
                fields = [json.loads(line.split(b" ", 2)[2]) for line in lines if line]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["path"]] * len(fields), pa.string()),
                        pa.array([starts[f["filename"]] + f["offset"] for f in fields], pa.int64()),
                        pa.array([f["length"] for f in fields], pa.int64()),
                    ],
                    ["path", "begin", "length"],
                )


def parse_record(data: bytes) -> tuple:
    """(record_id, url, type, refers_to, payload bytes, payload digest, payload) of a WARC record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        fields[name.strip().lower().decode()] = value.strip().decode("utf-8", "replace")
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")

    def key(name: str) -> str | None:
        value = fields.get(name)
        return value.removeprefix("<urn:page:").removesuffix(">") if value else None

    if fields["warc-type"] == "revisit":
        length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
        digest = fields["warc-payload-digest"].removeprefix("sha1:")
        return key("warc-record-id"), fields["warc-target-uri"], "revisit", key("warc-refers-to"), length, digest, None
    digest = base32_sha1(payload)
    if fields["warc-payload-digest"] != f"sha1:{digest}":
        raise ValueError(f"record {key('warc-record-id')}: payload does not match its digest")
    return key("warc-record-id"), fields["warc-target-uri"], "response", None, len(payload), digest, payload


def record_reader(with_payload: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Records of ranges that are sorted by file and place; neighbours are read at once."""
        package, held_at, held = None, 0, b""
        kinds = (pa.string(),) * 4 + (pa.int64(), pa.string(), pa.binary())
        names = ["record_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]
        for batch in batches:
            places = list(zip(*(batch.column(c).to_pylist() for c in ("path", "begin", "length")), strict=True))
            out, size = [], 0
            for i, (path, begin, length) in enumerate(places):
                if package is None or package.path != path:
                    package, held = Package(path), b""
                if not (held_at <= begin and begin + length <= held_at + len(held)):
                    stop = begin + length
                    for other, a, n in places[i + 1 :]:
                        if other != path or a != stop or a + n - begin > RANGE_BYTES:
                            break
                        stop = a + n
                    held_at, held = begin, package.read(begin, stop - begin)
                record = zlib.decompress(held[begin - held_at : begin - held_at + length], 31)
                found = parse_record(record)
                out.append(found if with_payload else (*found[:6], None))
                size += len(record) if with_payload else 200
                if size > RANGE_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names)
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names)

    return read


def read_packages(manifest: DataFrame, *, with_payload: bool = True) -> DataFrame:
    """Every record of the listed packages, read by ranges that are spread over all tasks.

    Compressed members and damaged files raise an error that names the file. An empty manifest
    gives no records.
    """
    members = manifest.select("path").mapInArrow(list_members, _MEMBERS)
    archives = F.map_from_entries(F.collect_list(F.when(F.col("name").startswith("archive/"), F.struct("name", "begin"))))
    indexes = F.collect_list(F.when(F.col("name").startswith("indexes/"), F.struct("begin", "size")))
    # A handful of members per file.
    by_file = members.groupBy("path").agg(F.to_json(archives).alias("archives"), indexes.alias("indexes"))
    wanted = by_file.select("path", "archives", F.explode("indexes").alias("i")).select("path", "archives", "i.begin", "i.size")
    places = wanted.mapInArrow(read_places, _PLACES)
    chunk = F.expr(f"begin div {4 * RANGE_BYTES}")
    # The index is far smaller than what it lists, so the packages' bytes say how many tasks read.
    total = manifest.agg(F.sum("bytes")).first()[0] or 0
    tasks = 1 + total // (4 * RANGE_BYTES)
    spread = places.withColumn("chunk", chunk).repartition(tasks, "path", "chunk").sortWithinPartitions("path", "begin").drop("chunk")
    return spread.mapInArrow(record_reader(with_payload), _RECORDS)


def archived_pages(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = 0) -> DataFrame:
    """Write all rows and read them back: id, payload_bytes, payload_digest, record_type, refers_to."""
    manifest = write_packages(pages, id_col=id_col, url_col=url_col, payload_col=payload_col, least=least)
    records = read_packages(manifest, with_payload=False)
    return records.select(
        F.col("record_id").try_cast("long").alias(id_col),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").try_cast("long").alias("refers_to"),
    )
