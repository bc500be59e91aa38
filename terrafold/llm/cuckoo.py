"""Exact dedup by an index of live digests: a cuckoo filter in front of stored keys.

Each shuffle partition holds one shard. A filter hit is verified against the keys stored
for the same bucket, so that a chance equality of fingerprints never merges texts; a table
that overflows is built anew at twice the size from the stored keys.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.shared import fresh_path
from .mixing import free_name

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
SLOTS = 4
MOVES = 64


class CuckooShard:
    """A cuckoo filter of 16-bit fingerprints whose keys are stored by bucket.

    ``insert``, ``delete`` and ``find`` take whole digests. A digest lives in one of two
    buckets; ``keys[bucket]`` maps the fingerprint's digests to what is known of them.
    """

    def __init__(self, buckets: int = 64) -> None:
        self._clear(buckets)
        self.size = 0
        self.resizes = 0

    def _clear(self, buckets: int) -> None:
        self.mask = buckets - 1
        self.prints: list[list[int]] = [[] for _ in range(buckets)]
        self.keys: list[dict[bytes, list]] = [{} for _ in range(buckets)]

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        mark = int.from_bytes(digest[:2], "little") or 1
        first = int.from_bytes(digest[2:10], "little") & self.mask
        return mark, first, (first ^ (mark * 0x5BD1E995)) & self.mask

    def find(self, digest: bytes) -> list | None:
        """The live entry of a digest. A fingerprint alone is no hit: the stored key decides."""
        mark, first, second = self._places(digest)
        for place in (first, second):
            if mark in self.prints[place] and (entry := self.keys[place].get(digest)) is not None:
                return entry
        return None

    def insert(self, digest: bytes, entry: list) -> None:
        """Store a digest that is not live yet."""
        self.size += 1
        if not self._put(digest, entry):
            self._grow(digest, entry)

    def delete(self, digest: bytes) -> list | None:
        """Take a live digest and its fingerprint out; None if it is not live."""
        mark, first, second = self._places(digest)
        for place in (first, second):
            if mark in self.prints[place] and digest in self.keys[place]:
                self.prints[place].remove(mark)
                self.size -= 1
                return self.keys[place].pop(digest)
        return None

    def _put(self, digest: bytes, entry: list) -> bool:
        mark, first, second = self._places(digest)
        place = first if len(self.prints[first]) <= len(self.prints[second]) else second
        path: list[tuple[int, bytes, list]] = []
        for turn in range(MOVES):
            if len(self.prints[place]) < SLOTS:
                self.prints[place].append(mark)
                self.keys[place][digest] = entry
                return True
            # The oldest resident moves to its other bucket.
            other = next(iter(self.keys[place]))
            moved = self.keys[place].pop(other)
            old, a, b = self._places(other)
            self.prints[place].remove(old)
            self.prints[place].append(mark)
            self.keys[place][digest] = entry
            path.append((place, digest, entry))
            place, (digest, entry, mark) = (b if place == a else a), (other, moved, old)
        # Whoever is homeless now goes into the larger table.
        self.homeless = (digest, entry)
        return False

    def _grow(self, digest: bytes, entry: list) -> None:
        """Build the table anew at twice the size from the stored keys."""
        digest, entry = self.homeless
        stored = [item for place in self.keys for item in place.items()] + [(digest, entry)]
        buckets = self.mask + 1
        while True:
            buckets *= 2
            self.resizes += 1
            self._clear(buckets)
            if all(self._put(key, value) for key, value in stored):
                return

    def items(self) -> Iterator[tuple[bytes, list]]:
        for place in self.keys:
            yield from place.items()


def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each text with A-Z in lower case; null counts as empty."""
    for batch in batches:
        texts = batch.column("_text").cast(pa.large_binary())
        found = [hashlib.sha256((value.as_py() or b"").translate(_LOWER)).digest() for value in texts]
        yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(found, pa.binary())], ["_id", "_digest"])


def shard_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One shard: the live row of each digest, the one with the largest (id, row)."""
    shard = CuckooShard()
    for batch in batches:
        columns = (batch.column(name).to_pylist() for name in ("_digest", "_keep", "_keep_row", "_n"))
        for digest, key, row, n in zip(*columns, strict=True):
            rank = (key is not None, key or 0, row)
            live = shard.find(digest)
            if live is None:
                shard.insert(digest, [rank, n])
            elif rank > live[0]:
                # A later row takes the place of the live one.
                shard.delete(digest)
                shard.insert(digest, [rank, n + live[1]])
            else:
                live[1] += n
    out: list[tuple] = []
    for digest, (rank, n) in shard.items():
        out.append((digest, rank[1] if rank[0] else None, rank[2], n))
        if len(out) == 20_000:
            yield _entry_batch(out)
            out = []
    yield _entry_batch(out)


def _entry_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64())
    columns = list(zip(*rows, strict=True)) or [[], [], [], []]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["_digest", "_keep", "_keep_row", "_n"]
    )


@F.arrow_udf(T.BinaryType())
def digest_column(texts: pa.Array) -> pa.Array:
    """The same digest as a column."""
    values = texts.cast(pa.large_binary())
    return pa.array([hashlib.sha256((v.as_py() or b"").translate(_LOWER)).digest() for v in values], pa.binary())


def digest_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_id, _digest, _row) of every row, written once, so that row numbers hold."""
    plain = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    rows = plain.mapInArrow(digests, "_id long, _digest binary").withColumn("_row", F.monotonically_increasing_id())
    path = fresh_path(docs.sparkSession, "digests")
    rows.write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def merged_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per digest of each batch, so that a digest of a third of all rows travels as a few."""
    for batch in batches:
        best: dict[bytes, list] = {}
        for digest, key, row in zip(*(batch.column(n).to_pylist() for n in ("_digest", "_id", "_row")), strict=True):
            rank = (key is not None, key or 0, row)
            seen = best.setdefault(digest, [rank, 0])
            seen[0] = max(seen[0], rank)
            seen[1] += 1
        yield _entry_batch([(d, r[1] if r[0] else None, r[2], n) for d, (r, n) in best.items()])


_ENTRY = "_digest binary, _keep long, _keep_row long, _n long"


def live_index(rows: DataFrame) -> DataFrame:
    """(_digest, _keep, _keep_row, _n): the live entry of every digest, from the shards."""
    merged = rows.mapInArrow(merged_batches, _ENTRY)
    return merged.repartition("_digest").mapInArrow(shard_entries, _ENTRY)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Of equal texts (A-Z lower-cased, null as empty) the row with the largest id stays, a null
    id being the smallest. Of repeated rows with that id exactly one is kept. An empty table
    gives no rows; other columns are not looked at.
    """
    rows = digest_rows(docs, id_col, text_col)
    groups = live_index(rows).filter("_n > 1")
    joined = rows.join(groups, "_digest", "left")
    return joined.select(
        F.col("_id").alias(id_col),
        F.when(F.col("_n").isNull(), F.col("_id")).otherwise(F.col("_keep")).alias("keep_id"),
        F.coalesce("_n", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("_row") == F.col("_keep_row"), F.lit(True)).alias("kept"),
        F.lower(F.hex("_digest")).alias("text_sha256"),
    )


def updated_index(index: DataFrame, added: DataFrame, removed: DataFrame) -> DataFrame:
    """Digests of a stored index after insertions and deletions, by shard.

    ``index`` and ``added`` hold (_digest, _keep, _keep_row, _n), ``removed`` holds _digest of
    texts that are no longer live; a digest both removed and added ends live with the added entry.
    """
    columns = ["_digest", "_keep", "_keep_row", "_n"]
    none = F.lit(None).cast("long")
    moves = (
        index.select(*columns, F.lit(0).alias("_step"))
        .unionByName(removed.select("_digest", none.alias("_keep"), none.alias("_keep_row"), none.alias("_n"), F.lit(1).alias("_step")))
        .unionByName(added.select(*columns, F.lit(2).alias("_step")))
    )
    ordered = moves.repartition("_digest").sortWithinPartitions("_step")
    return ordered.mapInArrow(_apply_moves, _ENTRY)


def _apply_moves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shard = CuckooShard()
    for batch in batches:
        columns = (batch.column(n).to_pylist() for n in ("_digest", "_keep", "_keep_row", "_n", "_step"))
        for digest, keep, row, n, step in zip(*columns, strict=True):
            live = shard.delete(digest)
            if step == 1:
                continue
            if live is not None:
                keep, row, n = *max((live[:2], [keep, row]), key=lambda x: (x[0] is not None, *x)), n + live[2]
            shard.insert(digest, [keep, row, n])
    yield _entry_batch([(digest, *entry) for digest, entry in shard.items()])


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, whatever these are called.

    Of rows with equal text (A-Z lower-cased, null as empty) the one with the largest id, a null id being the
    smallest; of rows that repeat it, one. No rows give no rows.
    """
    rows = digest_rows(docs, id_col, text_col)
    kept = live_index(rows).select("_digest", F.col("_keep").alias("_kept_id"))
    here = free_name(docs, "_digest_here")
    both = docs.withColumn(here, digest_column(F.col(text_col)))
    same = (both[here] == kept["_digest"]) & both[id_col].cast("long").eqNullSafe(kept["_kept_id"])
    stay = both.join(kept, same, "left_semi")
    # Repeated rows share digest and id; one of each is enough.
    return stay.dropDuplicates([here, id_col]).select(*docs.columns)
