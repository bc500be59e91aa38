"""Removal of long repeats across documents with a run-compressed index.

Every string of LENGTH bytes is assigned to a value, the least hash of the short strings in it, so
equal strings meet at one value however the documents around them differ. Values that occur in one
document only are sieved out. The strings of the others, as segments of consecutive windows, are
indexed value by value: a Burrows-Wheeler transform in runs, with the text position sampled where a
run begins. Segments are streamed against it right to left; where the matching statistic reaches
LENGTH, the sample tells the first document that has the string.

Documents are packed into blocks once, so that every pass sees the same rows in the same order, and
a string that a third of all documents share travels once per block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import fresh_path
from .arrays import mixed, text_bytes

#: Bytes of a repeat; bytes that a hash covers; text of a block, and of an index bucket and a round of it.
LENGTH, SHORT = 50, 24
BLOCK_BYTES, BUCKET_BYTES, ROUND_INDEX = 1 << 20, 2 << 20, 1 << 18
_NO_ID = -(1 << 63)
_BLOCK = "block long, size long, ids binary, offsets binary, data binary"
_VALUES = "bucket int, block long, parts binary, multi binary"
_FLAGS = "block long, bucket int, flags binary"
_SEGMENTS = "bucket int, block long, vals binary, lens binary, firsts binary, data binary"
_FOUND = "block long, bucket int, counts binary, places binary, docs binary"
_OUT = "_id long, n_bytes long, kept binary, spans array<struct<start: long, stop: long>>"


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def pack_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents in blocks of about BLOCK_BYTES, a longer one alone; numbered later."""
    packer = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        data, offsets = text_bytes(batch.column("_text"))
        ids = np.array([_NO_ID if i is None else i for i in batch.column("_id").to_pylist()], np.int64)
        row = 0
        while row < len(ids):
            end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + BLOCK_BYTES, "right")) - 1)
            part = data[offsets[row] : offsets[end]]
            yield pa.RecordBatch.from_pydict(
                {
                    "size": [len(part)],
                    "ids": [ids[row:end].tobytes()],
                    "offsets": [(offsets[row : end + 1] - offsets[row]).tobytes()],
                    "data": [packer.compress(part.tobytes())],
                }
            )
            row = end


def unpack(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, offsets and bytes of a block."""
    ids, offsets = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["offsets"], np.int64)
    data = zstandard.ZstdDecompressor().decompress(row["data"], max_output_size=max(1, int(offsets[-1])))
    return ids, offsets, np.frombuffer(data, np.uint8)


def window_values(data: np.ndarray) -> np.ndarray:
    """For each window of LENGTH bytes the least hash of the SHORT-byte strings in it."""
    x = data.astype(np.uint64)
    for shift in (1, 2, 4):
        x = x[:-shift] | x[shift:] << np.uint64(8 * shift)
    # Three words of eight bytes are the SHORT bytes of a hash.
    low = mixed((x[:-16] * np.uint64(0x9FB21C651E98DF25) + x[8:-8]) * np.uint64(0xD6E8FEB86659FD93) + x[16:])
    for shift in (1, 2, 4, 8, LENGTH - SHORT + 1 - 16):
        low = np.minimum(low[:-shift], low[shift:])
    return low


def value_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(value, document number, first window, end) of runs of windows with one value, within documents."""
    if len(data) < LENGTH:
        return (np.zeros(0, np.uint64),) + (np.zeros(0, np.int64),) * 3
    low = window_values(data)
    cut = np.ones(len(low), bool)
    cut[1:] = low[1:] != low[:-1]
    # Documents begin a run; windows that reach over a document's end are left out.
    cut[offsets[:-1][offsets[:-1] < len(low)]] = True
    over = np.maximum(offsets[1:-1] - LENGTH + 1, offsets[:-2])
    cut[over[over < len(low)]] = True
    start = np.flatnonzero(cut)
    end = np.append(start[1:], len(low))
    doc = np.searchsorted(offsets, start, "right") - 1
    whole = start + LENGTH <= offsets[doc + 1]
    # Least hashes crowd at zero; mixed once more, they fill all buckets alike.
    return mixed(low[start[whole]]), doc[whole], start[whole], end[whole]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for at in range(batch.num_rows):
            yield batch.slice(at, 1).to_pylist()[0]


def _grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, list[dict]]]:
    """Rows of one key at a time, from a partition sorted by it."""
    held: list[dict] = []
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            for row in batch.slice(at, 64).to_pylist():
                if held and held[0][key] != row[key]:
                    yield held[0][key], held
                    held = []
                held.append(row)
    if held:
        yield held[0][key], held


def _split(values: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and the next 32 bits of sorted values."""
    bucket = (values >> np.uint64(64 - bits)).astype(np.int64)
    part = (values >> np.uint64(32 - bits)).astype(np.uint32)
    return bucket, part


def _out(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    names, types = zip(*(c.split() for c in schema.split(", ")), strict=True)
    columns = list(zip(*rows, strict=True)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(columns, types, strict=True)], list(names))


def block_values(bits: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The distinct values of each block by bucket, and whether several documents of it have them."""
        for row in _rows(batches):
            ids, offsets, data = unpack(row)
            value, doc, _, _ = value_runs(data, offsets)
            order = np.argsort(value, kind="stable")
            value, own = value[order], ids[doc[order]]
            cuts = np.flatnonzero(np.append(True, value[1:] != value[:-1])) if len(value) else np.zeros(0, np.int64)
            if not len(cuts):
                continue
            multi = np.minimum.reduceat(own, cuts) < np.maximum.reduceat(own, cuts)
            bucket, part = _split(value[cuts], bits)
            edges = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            out = []
            for a, b in zip(edges, [*edges[1:], len(bucket)], strict=True):
                out.append((int(bucket[a]), row["block"], part[a:b].tobytes(), np.packbits(multi[a:b]).tobytes()))
            yield _out(out, _VALUES)

    return scan


def sieve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Which values of each block another document has too."""
    for bucket, rows in _grouped(batches, "bucket"):
        parts = [np.frombuffer(r["parts"], np.uint32) for r in rows]
        multi = np.concatenate([np.unpackbits(np.frombuffer(r["multi"], np.uint8), count=len(p)) for r, p in zip(rows, parts, strict=True)])
        every = np.concatenate(parts)
        order = np.argsort(every, kind="stable")
        ordered = every[order]
        again = np.zeros(len(every), bool)
        same = ordered[1:] == ordered[:-1]
        again[1:] |= same
        again[:-1] |= same
        flags = multi.astype(bool)
        flags[order] |= again
        at, out = 0, []
        for r, p in zip(rows, parts, strict=True):
            own = flags[at : at + len(p)]
            at += len(p)
            if own.any():
                out.append((r["block"], bucket, np.packbits(own).tobytes()))
        yield _out(out, _FLAGS)


def kept_segments(row: dict, bits: int) -> tuple:
    """Occurrences (document, first window, segment) in a block, and its distinct segments by value."""
    ids, offsets, data = unpack(row)
    value, doc, start, end = value_runs(data, offsets)
    distinct, inverse = np.unique(value, return_inverse=True)
    bucket, _ = _split(distinct, bits)
    keep = np.zeros(len(distinct), bool)
    for item in row["found"] or []:
        a, b = np.searchsorted(bucket, [item["bucket"], item["bucket"] + 1])
        keep[a:b] = np.unpackbits(np.frombuffer(item["flags"], np.uint8), count=b - a).astype(bool)
    chosen = np.flatnonzero(keep[inverse])
    # By value, so that the segments of a bucket are neighbours.
    chosen = chosen[np.argsort(value[chosen], kind="stable")]
    whole = data.tobytes()
    number: dict[bytes, int] = {}
    segment = np.zeros(len(chosen), np.int64)
    for i, k in enumerate(chosen.tolist()):
        segment[i] = number.setdefault(whole[start[k] : end[k] + LENGTH - 1], len(number))
    first = np.full(len(number), (1 << 63) - 1, np.int64)
    np.minimum.at(first, segment, ids[doc[chosen]])
    values = np.zeros(len(number), np.uint64)
    values[segment] = value[chosen]
    return ids, offsets, data, doc[chosen], start[chosen], segment, list(number), values, first


def block_segments(bits: int, wide: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            *_, segments, values, first = kept_segments(row, bits)
            bucket = (values >> np.uint64(64 - wide)).astype(np.int64)
            edges = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else []
            out = []
            for a, b in zip(edges, [*edges[1:], len(bucket)], strict=True) if len(bucket) else []:
                lens = np.array([len(s) for s in segments[a:b]], np.uint32)
                data = zstandard.ZstdCompressor(level=1).compress(b"".join(segments[a:b]))
                out.append((int(bucket[a]), row["block"], values[a:b].tobytes(), lens.tobytes(), first[a:b].tobytes(), data))
            yield _out(out, _SEGMENTS)

    return scan


class RunIndex:
    """A Burrows-Wheeler transform in runs over some texts, ordered by their first LENGTH bytes.

    Equal strings of LENGTH bytes keep the order of the texts, so with the texts in the order of
    their documents the sample where such a string's rows begin is its first document. Runs end
    where the preceding byte or those LENGTH bytes change; all strings of up to LENGTH bytes are
    then whole runs, and intervals are kept as run numbers.
    """

    def __init__(self, texts: list[bytes]) -> None:
        lens = np.array([len(t) for t in texts])
        n = int(lens.sum()) + len(texts)
        ends = np.cumsum(lens + 1)
        data = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
        #: Symbols of bytes: 0 is a text's end, the last one stands for all bytes that no text has.
        seen = np.bincount(data, minlength=256)
        seen[0] -= len(texts)
        self.symbols = int(np.count_nonzero(seen)) + 2
        self.code = np.full(256, self.symbols - 1, np.int64)
        self.code[seen > 0] = np.arange(1, self.symbols - 1)
        symbols = np.zeros(n + LENGTH, np.int64)
        symbols[:n] = self.code[data]
        symbols[ends - 1] = 0
        order, context, rank, have = self._sorted(symbols, n)
        before = symbols[order - 1]
        new = np.ones(n, bool)
        new[1:] = (before[1:] != before[:-1]) | (context[1:] != context[:-1])
        start = np.flatnonzero(new)
        at = order[start]
        self.runs = runs = len(start)
        #: Preceding symbol of each run, and the text sampled at its first row.
        self.head = before[start]
        self.sample = np.repeat(np.arange(len(texts)), lens + 1)[at]
        # Strings of LENGTH by number, and the run where each begins.
        string = context[start]
        first = np.append(np.flatnonzero(np.append(True, string[1:] != string[:-1])), runs)
        number = np.empty(n, np.int64)
        number[order] = context
        del order, context, before, new, start, string
        # A run's head and the string after it begin where the rows of the first run with that head in an
        # interval are mapped, and end where those of the last one are.
        mapped = number[at - 1]
        self.to, self.after = first[mapped], first[mapped + 1]
        del number, mapped, first
        # The runs that share all but the last byte with each run: what is left when it is dropped.
        fresh = np.ones(runs + 1, bool)
        fresh[1:-1] = False
        for part in (rank[at], rank[at + LENGTH - 1 - have]):
            fresh[1:-1] |= part[1:] != part[:-1]
        del rank, part
        change = np.flatnonzero(fresh)
        group = np.cumsum(fresh[:-1]) - 1
        self.wider_from, self.wider_to = change[group], change[group + 1]
        del change, group
        # The runs of each string of SEED bytes, where a match begins.
        seeds = self._seeds(symbols)[at]
        del symbols, at
        seed_at = np.flatnonzero(np.append(True, seeds[1:] != seeds[:-1]))
        self.seeds, self.seed_at = seeds[seed_at], np.append(seed_at, runs)
        del seeds
        # Runs by head, for the next and the last run of some head.
        by_head = np.argsort(self.head.astype(np.uint16), kind="stable")
        self.by_head = np.append(by_head, 0)
        self.key = np.append(self.head[by_head] * (runs + 1) + by_head, self.symbols * (runs + 1))

    #: Bytes of a string that is looked up whole; strings that are streamed in one go.
    SEED, PIECE = 6, 128

    def _seeds(self, symbols: np.ndarray) -> np.ndarray:
        """The strings of SEED symbols as numbers."""
        key = np.zeros(max(0, len(symbols) - self.SEED + 1), np.int64)
        for i in range(self.SEED):
            key *= self.symbols
            key += symbols[i : i + len(key)]
        return key

    def _sorted(self, symbols: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """Rows by their first LENGTH symbols, then position; each row's string by number; ranks of how many symbols."""
        width, bits = len(symbols).bit_length(), (self.symbols - 1).bit_length()
        # As many symbols as go into one number beside the position, then ranks of twice the length from pairs of ranks.
        have = min(LENGTH // 2, (63 - width) // bits)
        key = np.zeros(len(symbols), np.int64)
        for i in range(have):
            key <<= bits
            key[: len(symbols) - i] |= symbols[i:]
        order, number = self._numbered(key, width, have * bits)
        while True:
            rank = np.empty(len(symbols), np.int64)
            rank[order] = number
            shift = min(have, LENGTH - have)
            key = rank << width
            # Beyond the last symbol there are only ends, which have rank 0.
            key[: len(symbols) - shift] |= rank[shift:]
            if have + shift == LENGTH:
                # A string that reaches over a text's end is as unique as the end itself.
                return *self._numbered(key[:n], width, 2 * width), rank, have
            order, number = self._numbered(key, width, 2 * width)
            have += shift

    @staticmethod
    def _numbered(key: np.ndarray, width: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions by key, then position; the key of each by number."""
        if bits + width < 64:
            # With the position in it, numbers are sorted instead of positions by number.
            key = key << width
            key |= np.arange(len(key))
            key.sort()
            order = key & ((1 << width) - 1)
            key >>= width
        else:
            order = np.argsort(key, kind="stable")
            key = key[order]
        number = np.zeros(len(key), np.int64)
        np.cumsum(key[1:] != key[:-1], out=number[1:])
        return order, number

    def statistics(self, texts: list[bytes]) -> list[np.ndarray]:
        """Of each text, for every string of LENGTH bytes in it, the first indexed text that has it, or -1."""
        found, place = self.streamed(texts)
        return np.split(found, place[1:-1]) if len(texts) else []

    def streamed(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The statistics of all texts in one array, and where each text's begin.

        Pieces of the texts are streamed side by side from their last byte to their first. The
        matching length grows by one a step up to LENGTH, and stays there by giving up the last byte.
        """
        lens = np.array([len(t) for t in texts], np.int64)
        symbols = self.code[np.frombuffer(b"".join(texts), np.uint8)]
        windows = np.maximum(lens - LENGTH + 1, 0)
        place = np.append(0, np.cumsum(windows))
        found = np.full(place[-1], -1, np.int64)
        # Pieces share LENGTH - 1 bytes with the next, so that each string is in one of them.
        pieces = -(-windows // self.PIECE)
        text = np.repeat(np.arange(len(texts)), pieces)
        skip = (np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * self.PIECE
        size = np.minimum(windows[text] - skip, self.PIECE) + LENGTH - 1
        begin, into = (np.cumsum(lens) - lens)[text] + skip, place[text] + skip
        while len(size):
            begin, into, size = self._stream(symbols, begin, into, size, found)
        return found, place

    def _stream(self, symbols: np.ndarray, begin: np.ndarray, into: np.ndarray, size: np.ndarray, found: np.ndarray) -> np.ndarray:
        """One pass over pieces of symbols; of those whose match ended, what may still be found."""
        pieces = np.stack([begin, into, size])[:, np.argsort(-size, kind="stable")]
        seed = self._seeds(symbols)[pieces[0] + pieces[2] - self.SEED]
        known = np.minimum(np.searchsorted(self.seeds, seed), len(self.seeds) - 1)
        low, high = self.seed_at[known], self.seed_at[known + 1]
        lost, short = self.seeds[known] != seed, pieces[2] - 1
        again, matched = [], self.SEED
        for step in range(self.SEED, int(size.max()) + 1):
            if lost.any():
                # No string with the whole match and the byte before it is found; the next one ends a byte earlier.
                again.append(np.stack([pieces[0], pieces[1], short])[:, lost & (short >= LENGTH)])
                pieces, low, high = pieces[:, ~lost], low[~lost], high[~lost]
            live = int(np.searchsorted(-pieces[2], -step))
            if not live:
                break
            pieces, low, high = pieces[:, :live], low[:live], high[:live]
            if matched == LENGTH:
                low, high, matched = self.wider_from[low], self.wider_to[low], matched - 1
            begin, into, size = pieces
            low, high, lost = self._extended(symbols[begin + size - 1 - step], low, high)
            short = size - step + matched - 1
            matched += 1
            if matched == LENGTH:
                found[into + size - 1 - step] = np.where(lost, -1, self.sample[low])
        return np.concatenate(again, axis=1) if again else pieces[:, :0]

    def _extended(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The intervals of strings with a symbol before them, and whether there are none."""
        first, last = low, high - 1
        lost = np.zeros(len(low), bool)
        # Late in a match, most intervals begin and end with runs of the symbol; the others look for such runs.
        other = np.flatnonzero(self.head[first] != symbol)
        if len(other):
            goal = symbol[other] * (self.runs + 1)
            at = np.searchsorted(self.key, goal + low[other])
            lost[other] = self.key[at] >= goal + high[other]
            first = first.copy()
            first[other] = self.by_head[at]
        other = np.flatnonzero(self.head[last] != symbol)
        if len(other):
            at = np.searchsorted(self.key, symbol[other] * (self.runs + 1) + high[other]) - 1
            last[other] = self.by_head[at]
        return self.to[first], self.after[last], lost


def first_documents(texts: list[bytes], values: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each distinct text, the first document of its windows, in runs: bounds of its runs, first windows, documents."""
    order = np.argsort(values, kind="stable")
    sizes = np.cumsum([len(texts[k]) for k in order.tolist()])
    edges = np.flatnonzero(values[order][1:] != values[order][:-1]) + 1
    bounds = np.zeros((2, len(texts)), np.int64)
    places, docs = [], []
    begin = total = 0
    # Values share no windows, so a bucket is indexed a few of them at a time.
    for edge in [*edges.tolist(), len(order)]:
        if edge < len(order) and sizes[edge - 1] - (sizes[begin - 1] if begin else 0) < ROUND_INDEX:
            continue
        members = order[begin:edge]
        members = members[np.argsort(firsts[members], kind="stable")]
        begin = edge
        ordered = [texts[k] for k in members.tolist()]
        hits, place = RunIndex(ordered).streamed(ordered)
        first = firsts[members[hits]]
        new = np.append(True, first[1:] != first[:-1])
        new[place[:-1]] = True
        cuts = np.flatnonzero(new)
        bounds[:, members] = np.searchsorted(cuts, [place[:-1], place[1:]]) + total
        places.append((cuts - np.repeat(place[:-1], np.diff(np.searchsorted(cuts, place)))).astype(np.uint32))
        docs.append(first[cuts])
        total += len(cuts)
    return bounds, np.concatenate(places), np.concatenate(docs)


def index_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For every segment of a bucket, the first document of each of its windows, in runs."""
    for bucket, rows in _grouped(batches, "bucket"):
        numbers: dict[bytes, int] = {}
        which, counts = [], []
        for r in rows:
            lens = np.frombuffer(r["lens"], np.uint32).astype(np.int64)
            data = zstandard.ZstdDecompressor().decompress(r["data"], max_output_size=max(1, int(lens.sum())))
            cuts = np.append(0, np.cumsum(lens)).tolist()
            which += [numbers.setdefault(data[a:b], len(numbers)) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            counts.append(len(lens))
        segment = np.array(which)
        values = np.zeros(len(numbers), np.uint64)
        values[segment] = np.concatenate([np.frombuffer(r["vals"], np.uint64) for r in rows])
        firsts = np.full(len(numbers), (1 << 63) - 1, np.int64)
        np.minimum.at(firsts, segment, np.concatenate([np.frombuffer(r["firsts"], np.int64) for r in rows]))
        bounds, places, docs = first_documents(list(numbers), values, firsts)
        at, out = 0, []
        for r, n in zip(rows, counts, strict=True):
            begin, end = bounds[:, segment[at : at + n]]
            at += n
            times = end - begin
            own = np.arange(times.sum()) + np.repeat(begin - np.cumsum(times) + times, times)
            out.append((r["block"], bucket, times.astype(np.uint32).tobytes(), places[own].tobytes(), docs[own].tobytes()))
        yield _out(out, _FOUND)


def block_result(bits: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Covered bytes, and what is left, of each document of a block."""
        for row in _rows(batches):
            ids, offsets, data, doc, start, segment, segments, values, _ = kept_segments(row, bits)
            cover = np.zeros(len(data) + 1, np.int64)
            if len(segments):
                parts = sorted(row["hits"], key=lambda h: h["bucket"])
                counts = np.concatenate([np.frombuffer(h["counts"], np.uint32) for h in parts]).astype(np.int64)
                places = np.concatenate([np.frombuffer(h["places"], np.uint32) for h in parts]).astype(np.int64)
                docs = np.concatenate([np.frombuffer(h["docs"], np.int64) for h in parts])
                ends = np.cumsum(counts)
                windows = np.array([len(s) for s in segments]) - LENGTH + 1
                stops = np.append(places[1:], 0)
                stops[ends - 1] = windows
                times = counts[segment]
                at = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat((ends - counts)[segment], times)
                earlier = docs[at] < np.repeat(ids[doc], times)
                begin = np.repeat(start, times)[earlier]
                np.add.at(cover, begin + places[at[earlier]], 1)
                np.add.at(cover, begin + stops[at[earlier]] + LENGTH - 1, -1)
            covered = np.cumsum(cover)[:-1] > 0
            rises, falls = covered.copy(), covered.copy()
            rises[1:] &= ~covered[:-1]
            falls[:-1] &= ~covered[1:]
            edges = offsets[:-1][np.diff(offsets) > 0]
            rises[edges] = covered[edges]
            last = offsets[1:][np.diff(offsets) > 0] - 1
            falls[last] = covered[last]
            begins, ends = np.flatnonzero(rises), np.flatnonzero(falls) + 1
            first = np.searchsorted(begins, offsets)
            kept, spans = [], []
            for i in range(len(ids)):
                a, b = offsets[i], offsets[i + 1]
                kept.append(data[a:b][~covered[a:b]].tobytes())
                own = slice(first[i], first[i + 1])
                spans.append([{"start": int(x - a), "stop": int(y - a)} for x, y in zip(begins[own], ends[own], strict=True)])
            span = pa.struct([("start", pa.int64()), ("stop", pa.int64())])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([None if i == _NO_ID else i for i in ids.tolist()], pa.int64()),
                    pa.array(np.diff(offsets), pa.int64()),
                    pa.array(kept, pa.binary()),
                    pa.array(spans, pa.list_(span)),
                ],
                ["_id", "n_bytes", "kept", "spans"],
            )

    return scan


def without_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_bytes, kept (the remaining bytes), spans (removed byte ranges).

    A byte goes if a string of LENGTH bytes over it also starts in a document with a smaller id.
    Null and empty texts, and texts shorter than LENGTH, lose nothing. A null id is smaller than
    any other; rows that repeat an id are no smaller than each other, so they do not remove each
    other. No rows give no rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    packed = rows.mapInArrow(pack_blocks, "size long, ids binary, offsets binary, data binary")
    blocks = _stored(packed.withColumn("block", F.monotonically_increasing_id()), "blocks")
    total = blocks.agg(F.sum("size")).first()[0] or 0
    wide = max(2, int(total // BUCKET_BYTES).bit_length())
    bits = max(2, wide - 3)
    values = blocks.mapInArrow(block_values(bits), _VALUES)
    values = values.repartition("bucket").sortWithinPartitions("bucket")
    flags = values.mapInArrow(sieve, _FLAGS).groupBy("block").agg(F.collect_list(F.struct("bucket", "flags")).alias("found"))
    flags = _stored(flags, "flags")
    flagged = blocks.join(flags, "block", "left")
    segments = flagged.mapInArrow(block_segments(bits, wide), _SEGMENTS)
    segments = segments.repartition("bucket").sortWithinPartitions("bucket")
    hits = segments.mapInArrow(index_bucket, _FOUND)
    hits = hits.groupBy("block").agg(F.collect_list(F.struct("bucket", "counts", "places", "docs")).alias("hits"))
    out = flagged.join(hits, "block", "left").mapInArrow(block_result(bits), _OUT)
    return out.withColumnRenamed("_id", id_col)
