"""Benchmark decontamination by a prefix-filtered set join of shingles.

Benchmark items become windows of words, windows become sets of shingles. Shingles are ordered by
rarity in the documents; as a window must be contained whole, its rarest shingle is prefix enough
to join on. Candidates outside the document are dropped by position and length, the others are
verified word by word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import fresh_path
from .arrays import WordHasher, alnum_table, joined_hashes, lower_table, rounds, word_spans

#: Words of a window, words of a shingle, share of hit words that makes a document contaminated.
WINDOW, SHINGLE, SHARE = 13, 5, 20
#: Bits of the filter that all tasks get; more shingles only let more words pass to the join.
FILTER_BITS = 1 << 22
#: Words of a stored piece of a document before its margins.
PIECE_WORDS = 256

_WINDOWS = "item string, n int, k int, words array<long>, shingles array<long>"
_HITS = (
    "_id long, _key long, n_words long, hits array<struct<pos: int, piece: int, shingle: long, new: boolean>>, "
    "pieces array<struct<piece: int, begin: int, words: array<long>>>"
)


def item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher, lower, table = WordHasher(), lower_table(), alnum_table()
    for batch in batches:
        names = batch.column("_item").to_pylist()
        rows: list[tuple] = []
        for begin, _, data, offsets in rounds(batch.column("_text")):
            data = lower[data]
            starts, ends, first = word_spans(data, offsets, table)
            words = hasher(data, starts, ends)
            for i in range(len(offsets) - 1):
                own = words[first[i] : first[i + 1]]
                n = min(len(own), WINDOW)
                k = min(n, SHINGLE)
                if not n:
                    continue
                grams = joined_hashes(own, k).view(np.int64)
                signed = own.view(np.int64)
                for at in range(len(own) - n + 1):
                    rows.append((names[begin + i], n, k, signed[at : at + n], grams[at : at + n - k + 1]))
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        kinds = (pa.string(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["item", "n", "k", "words", "shingles"]
        )


def shingle_filter(shingles: DataFrame) -> np.ndarray:
    """A table of FILTER_BITS flags; the driver gets at most one row per 64 of them."""
    place = F.col("shingle").bitwiseAND(FILTER_BITS - 1)
    bit = F.expr("shiftleft(1L, cast(place % 64 as int))")
    rows = shingles.select(place.alias("place")).groupBy(F.expr("place div 64").alias("at")).agg(F.bit_or(bit).alias("bits"))
    out = np.zeros(FILTER_BITS // 64, np.uint64)
    for row in rows.collect():
        out[row["at"]] = row["bits"] % (1 << 64)
    return out


def document_hits(docs: DataFrame, words_filter: np.ndarray, sizes: list[int], id_col: str, text_col: str) -> DataFrame:
    """(_id, _key, n_words, hits, pieces) of every document: shingles that may be an item's, and the words around."""
    shared = docs.sparkSession.sparkContext.broadcast(words_filter)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, lower, table = WordHasher(), lower_table(), alnum_table()
        flags = np.unpackbits(shared.value.view(np.uint8), bitorder="little").astype(bool)
        for batch in batches:
            n_words: list[np.ndarray] = []
            hits: list = []
            pieces: list = []
            for _, _, data, offsets in rounds(batch.column("_text")):
                data = lower[data]
                starts, ends, first = word_spans(data, offsets, table)
                words = hasher(data, starts, ends)
                n_words.append(np.diff(first))
                found = []
                for k in sizes:
                    grams = joined_hashes(words, k)
                    at = np.flatnonzero(flags[(grams & np.uint64(FILTER_BITS - 1)).astype(np.int64)])
                    row = np.searchsorted(first, at, "right") - 1
                    whole = at + k <= first[row + 1]
                    found.append((row[whole], at[whole], grams[at[whole]].view(np.int64)))
                row, at, gram = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3
                order = np.lexsort((at, row))
                row, at, gram = row[order], at[order], gram[order]
                bounds = np.searchsorted(row, np.arange(len(offsets)))
                for i in range(len(offsets) - 1):
                    a, b = bounds[i], bounds[i + 1]
                    if a == b:
                        hits.append([])
                        pieces.append([])
                        continue
                    own = words[first[i] : first[i + 1]].view(np.int64)
                    pos, grams = at[a:b] - first[i], gram[a:b]
                    piece = pos // PIECE_WORDS
                    _, new = np.unique(grams, return_index=True)
                    fresh = np.zeros(b - a, bool)
                    fresh[new] = True
                    hits.append(
                        [
                            {"pos": p, "piece": q, "shingle": g, "new": f}
                            for p, q, g, f in zip(pos.tolist(), piece.tolist(), grams.tolist(), fresh.tolist(), strict=True)
                        ]
                    )
                    made = []
                    cuts = np.flatnonzero(np.diff(piece, prepend=-1))
                    for x, y in zip(cuts, [*cuts[1:], len(piece)], strict=True):
                        begin = max(0, int(pos[x]) - WINDOW + 1)
                        made.append({"piece": int(piece[x]), "begin": begin, "words": own[begin : int(pos[y - 1]) + WINDOW]})
                    pieces.append(made)
            counts = np.concatenate(n_words) if n_words else np.zeros(0, np.int64)
            hit = pa.struct([("pos", pa.int32()), ("piece", pa.int32()), ("shingle", pa.int64()), ("new", pa.bool_())])
            part = pa.struct([("piece", pa.int32()), ("begin", pa.int32()), ("words", pa.list_(pa.int64()))])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id"),
                    batch.column("_key"),
                    pa.array(counts, pa.int64()),
                    pa.array(hits, pa.list_(hit)),
                    pa.array(pieces, pa.list_(part)),
                ],
                ["_id", "_key", "n_words", "hits", "pieces"],
            )

    text = F.col(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.xxhash64(text).alias("_key"), text.alias("_text"))
    return rows.mapInArrow(scan, _HITS)


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)




def matches(found: DataFrame, windows: DataFrame) -> DataFrame:
    """(_row, start, n, item): every occurrence of every window."""
    hits = found.select("_row", "n_words", F.explode("hits").alias("hit")).select("_row", "n_words", "hit.*")
    rarity = hits.filter("new").groupBy("shingle").agg(F.count("*").alias("df"))
    tokens = windows.select("w", "item", "n", "words", F.posexplode("shingles").alias("offset", "shingle"))
    # An inner join: a window with a shingle that no document has occurs nowhere, so a window must
    # find all of its shingles, and the rarest of them is the prefix.
    counted = tokens.join(rarity, "shingle")
    rank = F.min(F.struct("df", "shingle", "offset"))
    prefix = counted.groupBy("w", "n", "item", "words").agg(rank.alias("rarest"), F.count("*").alias("found"))
    prefix = prefix.filter(F.col("found") == F.greatest(F.lit(1), F.col("n") - SHINGLE + 1))
    prefix = prefix.select("n", "item", "words", "rarest.shingle", "rarest.offset")
    near = hits.join(prefix, "shingle")
    near = near.withColumn("start", F.col("pos") - F.col("offset"))
    near = near.filter((F.col("start") >= 0) & (F.col("start") + F.col("n") <= F.col("n_words")))
    near = near.select("_row", "piece", "start", "n", "item", F.col("words").alias("wanted"))
    pieces = found.select("_row", F.explode("pieces").alias("p")).select("_row", "p.piece", "p.begin", "p.words")
    both = near.join(pieces, ["_row", "piece"])
    same = F.slice("words", F.col("start") - F.col("begin") + 1, F.col("n")) == F.col("wanted")
    return both.filter(same).select("_row", "start", "n", "item")


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    share: int = SHARE,
) -> DataFrame:
    """One row per document: id, n_words, n_hit, n_items, items_sha256, contaminated, items, text_key.

    Null and empty texts have no words. An item without words hits nothing; a null item_id counts
    as the empty name; items that repeat an id count once. Repeated rows are judged each on its own.
    Without items nothing is contaminated; without documents there are no rows.
    """
    items = benchmark.select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("_item"), F.col(item_text_col).alias("_text")
    )
    windows = items.mapInArrow(item_windows, _WINDOWS).withColumn("w", F.monotonically_increasing_id())
    windows = _stored(windows, "windows")
    shingles = windows.select(F.explode("shingles").alias("shingle"))
    sizes = sorted(r["k"] for r in windows.select("k").distinct().collect())
    found = document_hits(docs, shingle_filter(shingles), sizes, id_col, text_col)
    found = _stored(found.withColumn("_row", F.monotonically_increasing_id()), "hits")
    spans = matches(found, windows).groupBy("_row").agg(
        F.sort_array(F.collect_set(F.struct("start", (F.col("start") + F.col("n")).alias("stop")))).alias("spans"),
        F.sort_array(F.collect_set("item")).alias("items"),
    )
    # Words under sorted spans: each span adds what lies beyond the furthest end so far.
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("sum")),
        lambda acc, x: F.struct(
            F.greatest(acc["end"], x["stop"]).alias("end"),
            (acc["sum"] + F.greatest(F.lit(0), x["stop"] - F.greatest(acc["end"], x["start"]))).alias("sum"),
        ),
        lambda acc: acc["sum"],
    )
    out = found.select("_row", "_id", "_key", "n_words").join(spans, "_row", "left")
    names = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce(covered, F.lit(0)).cast("long")
    return out.select(
        F.col("_id").alias(id_col),
        "n_words",
        n_hit.alias("n_hit"),
        F.size(names).cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ",").cast("binary"), 256).alias("items_sha256"),
        ((n_hit > 0) & (n_hit * share >= F.col("n_words"))).alias("contaminated"),
        names.alias("items"),
        F.col("_key").alias("text_key"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated; rows are told apart by id and text."""
    found = contamination(docs, benchmark, id_col=id_col, text_col=text_col, **options).filter("contaminated")
    found = found.select(F.col(id_col).alias("_id"), F.col("text_key").alias("_key")).distinct()
    same = docs[id_col].cast("long").eqNullSafe(found["_id"]) & (F.xxhash64(docs[text_col]) == found["_key"])
    return docs.join(found, same, "left_anti")
