"""Collocations: phrases whose words stand together far more often than apart.

Every word of a piece begins a suffix of up to LONGEST words. Suffixes are routed by their leading
words to buckets: by the first word, by the first two where that word's slot carries more than a
bucket holds, by all of them where the pair's slot does as well. A bucket sorts pointers to its
suffixes by multikey three-way quicksort, all partitions side by side: an equal partition is a
phrase and its weight the count, and a partition lighter than a candidate must be is abandoned, unless its
words are spread over buckets. Counts of spread phrases are added up at the end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import materialized
from .arrays import WordHasher, lower_table, mixed, rounds, word_spans

#: Words of the longest phrase.
LONGEST = 3
#: Suffixes a bucket holds, and slots in which the load of leading words is measured.
BUCKET, SLOT_BITS = 1 << 20, 16
#: Words that are combined before they are sent, and bytes of text read at once.
CHUNK, TEXT_ROUND = 1 << 19, 2 << 20
#: Rows of a word count that hot words' candidates are spread over.
SALTS = 16
_CODE = 21
_STEP = np.uint64(0xD6E8FEB86659FD93)


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Bytes that end a piece, and bytes of words."""
    breaks = np.zeros(256, bool)
    breaks[[*b".,;:!?", 10, 11, 12, 13]] = True
    word = ~breaks
    word[[9, 32]] = False
    return breaks, word


class Reader:
    """Words of Arrow batches with their language and how many words of the piece follow."""

    def __init__(self) -> None:
        self.breaks, self.word = _tables()
        self.lower, self.hasher = lower_table(), WordHasher()
        self.lang_hashes: dict[str, int] = {}

    def lang_hash(self, name: str) -> int:
        if name not in self.lang_hashes:
            self.lang_hashes[name] = int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8).digest(), "little")
        return self.lang_hashes[name]

    def __call__(self, batch: pa.RecordBatch) -> Iterator[tuple]:
        """Bytes, starts, ends, language numbers, their names, words that follow (0 to 2) and word hashes."""
        langs = batch.column("_lang").dictionary_encode()
        names, numbers = langs.dictionary.to_pylist(), langs.indices.to_numpy().astype(np.int64)
        for begin, end, data, offsets in rounds(batch.column("_text"), TEXT_ROUND):
            data = self.lower[data]
            starts, ends, first = word_spans(data, offsets, self.word)
            row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
            broken = np.zeros(len(data) + 1, np.int32)
            np.cumsum(self.breaks[data], out=broken[1:])
            joined = np.zeros(len(starts) + 1, bool)
            joined[: max(0, len(starts) - 1)] = (broken[starts[1:]] == broken[ends[:-1]]) & (row[1:] == row[:-1])
            follow = joined[:-1].astype(np.int8)
            follow[:-1] += joined[:-2] & joined[1:-1]
            hashes = self.hasher(data, starts, ends)
            yield data, starts, ends, numbers[begin:end][row], names, follow, hashes


def _next(values: np.ndarray, n: int) -> np.ndarray:
    """The value n words later, 0 beyond the end."""
    out = np.zeros_like(values)
    out[: len(values) - n] = values[n:]
    return out


def leading_hashes(first: np.ndarray, words: np.ndarray, follow: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each suffix's first word in its language and of its first two words."""
    second = np.where(follow > 0, _next(words, 1), np.uint64(1))
    return first, mixed(first * _STEP + second)


def loads(docs: DataFrame, slot_bits: int) -> DataFrame:
    """(level, slot, lang, n): suffixes by slot of their first word (1) and first two (2), and words of each language (0)."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader()
        slots = np.zeros((2, 1 << slot_bits), np.int64)
        words: dict[str, int] = {}
        shift = np.uint64(64 - slot_bits)
        for batch in batches:
            for _, _, _, numbers, names, follow, hashes in reader(batch):
                of_lang = np.array([reader.lang_hash(n) for n in names], np.uint64)
                for level, h in enumerate(leading_hashes(mixed(hashes ^ of_lang[numbers]), hashes, follow)):
                    slots[level] += np.bincount((h >> shift).astype(np.int64), minlength=1 << slot_bits)
                for name, n in zip(names, np.bincount(numbers, minlength=len(names)).tolist(), strict=True):
                    words[name] = words.get(name, 0) + n
        level, slot = np.nonzero(slots)
        total = len(level)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([level + 1, np.zeros(len(words), np.int64)]), pa.int64()),
                pa.array(np.concatenate([slot, np.zeros(len(words), np.int64)]), pa.int64()),
                pa.array([None] * total + list(words), pa.string()),
                pa.array(np.concatenate([slots[level, slot], np.array(list(words.values()), np.int64)]), pa.int64()),
            ],
            ["level", "slot", "lang", "n"],
        )

    rows = docs.mapInArrow(measure, "level long, slot long, lang string, n long")
    return rows.groupBy("level", "slot", "lang").agg(F.sum("n").alias("n"))


def packed_suffixes(words: pa.Array, codes: np.ndarray, counts: np.ndarray, depth: np.ndarray) -> bytes:
    """Suffixes as compressed bytes: numbers of their words (0: none), counts, leading words that chose the bucket."""
    ordered = np.sort(codes, axis=None)
    used = ordered[np.flatnonzero(np.diff(ordered, prepend=0))]
    own = (np.searchsorted(used, codes) + 1).astype(np.uint32)
    own[codes == 0] = 0
    own[0] = np.diff(own[0].astype(np.int64), prepend=0)
    texts = words.take(pa.array(used - 1))
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[: len(used) + 1]
    head = np.array([codes.shape[1], len(used)], np.int64)
    parts = (head, own, counts.astype(np.uint32), depth.astype(np.uint8), np.diff(offsets).astype(np.uint32))
    letters = memoryview(texts.buffers()[2])[offsets[0] : offsets[-1]]
    raw = b"".join([*(p.tobytes() for p in parts), letters])
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def unpacked_suffixes(packed: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    raw = pa.decompress(packed[8:], int.from_bytes(packed[:8], "little"), "zstd", asbytes=True)
    n, n_words = np.frombuffer(raw, np.int64, 2).tolist()
    own = np.frombuffer(raw, np.uint32, LONGEST * n, 16).reshape(LONGEST, n).astype(np.int64)
    own[0] = np.cumsum(own[0])
    at = 16 + 4 * LONGEST * n
    counts = np.frombuffer(raw, np.uint32, n, at).astype(np.int64)
    depth = np.frombuffer(raw, np.uint8, n, at + 4 * n)
    at += 5 * n
    ends = np.concatenate([[0], np.cumsum(np.frombuffer(raw, np.uint32, n_words, at), dtype=np.int64)])
    words = pa.Array.from_buffers(
        pa.large_binary(), n_words, [None, pa.py_buffer(ends), pa.py_buffer(raw[at + 4 * n_words :])]
    )
    return words, own, counts, depth


def routed(docs: DataFrame, heavy: list[np.ndarray], buckets: int, slot_bits: int) -> DataFrame:
    """(bucket, packed): the suffixes of some words together, equal ones combined, one row for each bucket."""
    shared = docs.sparkSession.sparkContext.broadcast([np.packbits(h) for h in heavy])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader()
        full = [np.unpackbits(h).astype(bool) for h in shared.value]
        shift = np.uint64(64 - slot_bits)
        for batch in batches:
            for data, starts, ends, numbers, names, follow, hashes in reader(batch):
                cuts = np.concatenate([[0], np.cumsum(ends - starts)])
                text = pa.py_buffer(data[reader.word[data]])
                spelled = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(cuts), text]).dictionary_encode()
                vocabulary, known = spelled.dictionary, spelled.indices.to_numpy().astype(np.int64)
                of_lang = np.array([reader.lang_hash(n) for n in names], np.uint64)
                langs = pa.array([n.encode() for n in names], pa.large_binary())
                for a in range(0, len(starts), CHUNK):
                    own, b = slice(a, a + CHUNK), min(len(starts), a + CHUNK + LONGEST - 1)
                    n = min(len(starts), a + CHUNK) - a
                    # Numbers of words by language, from 1; 0 stands for none.
                    pairs, first, code = np.unique(
                        numbers[a:b] * len(vocabulary) + known[a:b], return_index=True, return_inverse=True
                    )
                    word_hash = np.append(np.uint64(1), hashes[a:b][first])
                    lead = np.append(np.uint64(0), mixed(hashes[a:b][first] ^ of_lang[numbers[a:b][first]]))
                    code = code + 1
                    packed = code[:n] << (2 * _CODE)
                    for k in (1, 2):
                        later = np.where(follow[own] >= k, _next(code, k)[:n], 0)
                        packed |= later << ((2 - k) * _CODE)
                    packed, counts = np.unique(packed, return_counts=True)
                    codes = np.stack([(packed >> (s * _CODE)) & ((1 << _CODE) - 1) for s in (2, 1, 0)])
                    h = [lead[codes[0]]]
                    for k in (1, 2):
                        h.append(mixed(h[-1] * _STEP + word_hash[codes[k]]))
                    deep = full[0][(h[0] >> shift).astype(np.int64)]
                    deeper = deep & full[1][(h[1] >> shift).astype(np.int64)]
                    depth = 1 + deep.astype(np.int64) + deeper
                    route = np.where(deeper, h[2], np.where(deep, h[1], h[0]))
                    bucket = (mixed(route + np.uint64(7)) % np.uint64(buckets)).astype(np.int64)
                    texts = pc.binary_join_element_wise(
                        langs.take(pa.array(pairs // len(vocabulary))), vocabulary.take(pa.array(pairs % len(vocabulary))), pa.scalar(b" ", pa.large_binary())
                    )
                    order = np.argsort(bucket, kind="stable")
                    at = np.flatnonzero(np.diff(bucket[order], prepend=-1))
                    rows = [
                        packed_suffixes(texts, codes[:, part], counts[part], depth[part])
                        for part in np.split(order, at[1:])
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(bucket[order][at], pa.int64()), pa.array(rows, pa.binary())], ["bucket", "packed"]
                    )

    return docs.mapInArrow(send, "bucket long, packed binary")


def equal_partitions(
    keys: np.ndarray, weights: np.ndarray, depth: np.ndarray, least: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Phrases of weighted suffixes by multikey three-way quicksort of pointers.

    ``keys`` has one row for each place of a word, 0 where a suffix has ended. Yields words of the
    phrases, a pointer to a suffix that begins with each, and their weights: those of ``least`` or more,
    and all that have fewer words than ``depth``, as other buckets hold the rest of them.
    Every turn divides all partitions by the word of a pointer in their middle: into those before it,
    equal to it, and after it; equal ones go on with the next word.
    """
    pointers = np.flatnonzero(keys[0] > 0).astype(np.int32)
    begins, level = np.zeros(min(1, len(pointers)), np.int64), np.zeros(min(1, len(pointers)), np.int64)
    flat, width = keys.ravel(), keys.shape[1]
    spread = bool((depth > 1).any())
    while len(pointers):
        sizes = np.diff(begins, append=len(pointers))
        # A partition's place in the keys of its level.
        key = flat[np.repeat(level * width, sizes) + pointers]
        pivot = np.repeat(key[begins + sizes // 2], sizes)
        side = np.repeat(np.arange(0, 3 * len(begins), 3), sizes)
        side += key >= pivot
        side += key > pivot
        # A stable sort by partition and side; few enough of them are sorted by counting.
        order = np.argsort(side.astype(np.uint16) if len(begins) < 21_845 else side, kind="stable")
        pointers = pointers[order]
        sizes = np.bincount(side, minlength=3 * len(begins))
        words = np.repeat(level + 1, 3)
        words[1::3] += 1
        real = np.flatnonzero(sizes)
        sizes, words = sizes[real], words[real]
        starts = np.cumsum(sizes) - sizes
        sums = np.add.reduceat(weights[pointers], starts, dtype=np.int64)
        heavy = sums >= least
        # Phrases of fewer words than this are shared with other buckets.
        reach = np.maximum.reduceat(depth[pointers], starts) if spread else np.ones(len(starts), np.int64)
        told = (real % 3 == 1) & (heavy | (reach > words - 1))
        for n in range(1, keys.shape[0] + 1):
            which = np.flatnonzero(told & (words == n + 1))
            if len(which):
                yield n, pointers[starts[which]], sums[which]
        stay = (heavy | (reach > words)) & (words <= keys.shape[0])
        pointers = pointers[np.repeat(stay, sizes)]
        sizes, level = sizes[stay], words[stay] - 1
        # Suffixes that have ended leave.
        going = flat[np.repeat(level * width, sizes) + pointers] > 0
        left = np.add.reduceat(going, np.cumsum(sizes) - sizes, dtype=np.int64) if len(sizes) else sizes
        pointers = pointers[going]
        sizes, level = left[left > 0], level[left > 0]
        begins = np.cumsum(sizes) - sizes


def counted(parts: DataFrame, least: int) -> DataFrame:
    """(lang, phrase, words, n) of each bucket; ``parts`` has a bucket's rows one after the other."""

    def phrases(packed: list[bytes]) -> Iterator[pa.RecordBatch]:
        vocabularies, owns, counts, depths = zip(*map(unpacked_suffixes, packed), strict=True)
        together = pa.chunked_array(vocabularies).combine_chunks().dictionary_encode()
        numbers = np.concatenate([[0], together.indices.to_numpy().astype(np.int64) + 1])
        shift = np.concatenate([[0], np.cumsum([len(v) for v in vocabularies])])
        keys = np.empty((LONGEST, sum(o.shape[1] for o in owns)), np.int32)
        at = 0
        for own, s in zip(owns, shift[:-1], strict=True):
            keys[:, at : at + own.shape[1]] = numbers[np.where(own > 0, own + s, 0)]
            at += own.shape[1]
        weights, depth = np.concatenate(counts).astype(np.int32), np.concatenate(depths)
        for n, pointer, weight in equal_partitions(keys, weights, depth, least):
            codes = keys[:n, pointer] - 1
            used, place = np.unique(codes, return_inverse=True)
            place = place.reshape(codes.shape)
            spelled = together.dictionary.take(pa.array(used)).cast(pa.large_string()).cast(pa.string())
            # A word holds no blank, a language may.
            words = pc.replace_substring_regex(spelled, "(?s)^.* ", "")
            langs = pc.replace_substring_regex(spelled, "(?s) [^ ]*$", "")
            columns = [words.take(pa.array(place[k])) for k in range(n)]
            texts = pc.binary_join_element_wise(*columns, " ") if n > 1 else columns[0]
            yield pa.RecordBatch.from_arrays(
                [langs.take(pa.array(place[0])), texts, pa.array(np.full(len(pointer), n), pa.int64()), pa.array(weight, pa.int64())],
                ["lang", "phrase", "words", "n"],
            )

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = None, []
        for batch in batches:
            for number, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if number != bucket and held:
                    yield from phrases(held)
                    held = []
                bucket = number
                held.append(packed)
        if held:
            yield from phrases(held)

    return parts.mapInArrow(sort, "lang string, phrase string, words long, n long")


def phrase_counts(
    docs: DataFrame, least: int, *, text_col: str, lang_col: str, slot_bits: int = SLOT_BITS, bucket: int = BUCKET
) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, n) of all phrases that occur at least ``least`` times, and (lang, total) words."""
    rows = docs.select(F.col(text_col).alias("_text"), F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("_lang"))
    measured = materialized(loads(rows, slot_bits), "phrase-loads")
    # A slot fuller than half a bucket is routed by further words; there are at most twice as many as buckets.
    full = measured.filter((F.col("level") > 0) & (F.col("n") > bucket // 2)).select("level", "slot").collect()
    heavy = [np.zeros(1 << slot_bits, bool) for _ in range(2)]
    for row in full:
        heavy[row.level - 1][row.slot] = True
    totals = measured.filter("level = 0 AND n > 0").select("lang", F.col("n").alias("total"))
    words = totals.agg(F.coalesce(F.sum("total"), F.lit(0)).alias("n")).first().n
    buckets = 1 + words // bucket
    parts = routed(rows, heavy, buckets, slot_bits).repartition(buckets, "bucket").sortWithinPartitions("bucket")
    counts = counted(parts, least).groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    return materialized(counts, "phrase-counts"), totals


def with_counts(rows: DataFrame, counts: DataFrame, part: str, name: str) -> DataFrame:
    """Adds the count of the phrase in column ``part``; a word that begins or ends many phrases is spread over SALTS rows."""
    single = ~F.col(part).contains(" ")
    salt = F.when(single, F.pmod(F.hash("phrase"), F.lit(SALTS))).otherwise(0)
    spread = F.when(F.col("words") == 1, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    side = counts.filter(F.col("words") < LONGEST).select(
        F.col("lang").alias("_lang"), F.col("phrase").alias("_part"), F.col("n").alias(name), F.explode(spread).alias("_salt")
    )
    salted = rows.withColumn("_salted", salt)
    on = (F.col("lang") == F.col("_lang")) & (F.col(part) == F.col("_part")) & (F.col("_salted") == F.col("_salt"))
    return salted.join(side, on).drop("_lang", "_part", "_salt", "_salted")


def collocations(
    docs: DataFrame,
    *,
    least: int = 10,
    share: int = 50,
    top: int = 2000,
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of 2 to LONGEST words.

    Texts have A-Z lowered, are cut into pieces at ``.,;:!?`` and line ends, and these into words at
    blanks and tabs. ``a`` counts all occurrences of the phrase inside pieces; only phrases with
    ``least`` or more count. Of its cuts in two, that with the smallest 1000000 a a / (l r), rounded
    down, gives ``l``, ``r`` and ``score``, ties to the earliest cut; ``n`` is the language's words. A phrase
    inside a longer one that has at least ``share`` percent of its occurrences goes. Ranks are by score, then
    ``a``, then the phrase's bytes. A null language counts as ``und``, a null text as empty; rows that are repeated
    count again, other columns change nothing, and no rows give no rows. A long text is read whole, its words
    in chunks.
    """
    counts, totals = phrase_counts(docs, least, text_col=text_col, lang_col=lang_col)
    phrases = counts.filter("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"))
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1).cast("long"), F.col("words") - 1)))
    cuts = cuts.withColumn("first", F.expr("substring_index(phrase, ' ', cast(k as int))"))
    cuts = cuts.withColumn("rest", F.expr("substring_index(phrase, ' ', cast(k - words as int))"))
    cuts = with_counts(with_counts(cuts, counts, "first", "l"), counts, "rest", "r")
    whole = {name: F.col(name).cast("decimal(18,0)") for name in ("a", "l", "r")}
    cuts = cuts.withColumn("above", F.lit(1000000).cast("decimal(7,0)") * (whole["a"] * whole["a"]))
    cuts = cuts.withColumn("below", whole["l"] * whole["r"]).withColumn("score", F.expr("above div below"))
    lowest = cuts.groupBy("lang", "phrase").agg(
        F.max("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("low")
    )
    inner = phrases.filter(F.col("words") == LONGEST).select(
        F.col("lang").alias("_lang"),
        F.col("a").alias("longer"),
        F.explode(F.array(F.substring_index("phrase", " ", LONGEST - 1), F.substring_index("phrase", " ", 1 - LONGEST))).alias("_part"),
    )
    inner = inner.groupBy("_lang", "_part").agg(F.max("longer").alias("longer"))
    free = lowest.join(inner, (F.col("lang") == F.col("_lang")) & (F.col("phrase") == F.col("_part")), "left")
    free = free.filter(F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a")))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("low.score"), F.desc("a"), "phrase"))
    ranked = free.select("lang", "phrase", "a", "low", place.cast("long").alias("rank")).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "low.l", "low.r", F.col("total").alias("n"), "low.score"
    )
