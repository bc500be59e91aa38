"""Encoding and decoding with merge-type sentencepiece vocabularies by an agenda of symbol pairs.

A text is a row of symbols, at first its characters. Each adjacent pair whose join is in the
vocabulary waits in an agenda, highest score first, leftmost among equals; the pair on top becomes
one symbol, which makes new pairs with its neighbours, until no pair is left. No piece of such a
vocabulary holds a blank after another character, so no merge crosses the place before a blank:
texts are cut there into units, and each distinct unit of a round goes through its agenda once. The
units are also encoded by the sentencepiece library, batch by batch, and must agree.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import rounds

#: Bytes of text that share one table of distinct units.
UNIT_ROUND = 4 << 20
#: Units of up to so many symbols go through their agendas side by side, longer ones by a heap each.
SIDE_BY_SIDE = 24
BLANK = "▁"
_NONE = np.iinfo(np.int32).max


class Vocabulary:
    """Symbols and pair merges of one model.

    Symbols are the pieces, then characters that only occur inside pieces. Models with unused or
    user-defined pieces, or with a blank inside a piece, follow other rules and are refused.
    """

    def __init__(self, model: bytes) -> None:
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        library, n = self.library, self.library.get_piece_size()
        plain = [i for i in range(n) if not (library.is_control(i) or library.is_unknown(i) or library.is_byte(i))]
        pieces = {library.id_to_piece(i): i for i in plain}
        if any(library.is_unused(i) for i in plain) or any(BLANK in p.lstrip(BLANK) for p in pieces):
            raise ValueError("Not a plain merge-type vocabulary")
        if library.normalize(" a  b ") != f"{BLANK}{BLANK}a{BLANK}{BLANK}b{BLANK}":
            raise ValueError("The model's text normalisation is not supported")
        self.pieces = n
        symbols = dict(pieces)
        for char in sorted({c for p in pieces for c in p}):
            symbols.setdefault(char, len(symbols) + n)
        self.names = {number: name for name, number in symbols.items()}
        self.width = max(symbols.values(), default=0) + 2
        #: Stands for every character the vocabulary does not have; it joins nothing.
        self.strange = self.width - 1
        self.of_char = np.full(0x110000, self.strange, np.int32)
        for name, number in symbols.items():
            if len(name) == 1:
                self.of_char[ord(name)] = number
        scores = np.array([library.get_score(i) for i in range(n)])
        ranks = np.unique(-scores, return_inverse=True)[1].astype(np.int32)
        self.merges: dict[int, tuple[int, int]] = {}
        for name, number in pieces.items():
            for cut in range(1, len(name)):
                left, right = symbols.get(name[:cut]), symbols.get(name[cut:])
                if left is not None and right is not None:
                    self.merges[left * self.width + right] = (int(ranks[number]), number)
        keys = np.array(sorted(self.merges), np.int64)
        self.keys = np.append(keys, np.iinfo(np.int64).max)
        self.ranks = np.array([*(self.merges[k][0] for k in keys.tolist()), _NONE], np.int32)
        self.joins = np.array([*(self.merges[k][1] for k in keys.tolist()), 0], np.int32)
        self.bytes = np.array([library.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        self.unknown = library.unk_id()
        self.falls_back = library.is_byte(int(self.bytes[0]))

    def found(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Where each pair's merge stands in the tables; the last place if it has none."""
        pair = left.astype(np.int64) * self.width + right
        at = np.searchsorted(self.keys, pair)
        return np.where(self.keys[at] == pair, at, len(self.keys) - 1)

    def spelled(self, symbol: int, chars: str) -> list[int]:
        """Ids of a final symbol that covers ``chars``: itself, its bytes or the unknown id."""
        if symbol < self.pieces:
            return [symbol]
        return self.bytes[list(chars.encode())].tolist() if self.falls_back else [self.unknown]


def agenda(vocabulary: Vocabulary, symbols: list[int]) -> tuple[list[int], list[int]]:
    """Final symbols of one unit, and where in it each begins, by a heap of pairs."""
    n, width, merges = len(symbols), vocabulary.width, vocabulary.merges
    symbols, after, before = list(symbols), list(range(1, n + 1)), list(range(-1, n - 1))
    waiting = [(*merges[key], i, key) for i in range(n - 1) if (key := symbols[i] * width + symbols[i + 1]) in merges]
    waiting = [(rank, i, join, key) for rank, join, i, key in waiting]
    heapq.heapify(waiting)
    while waiting:
        _, i, join, key = heapq.heappop(waiting)
        right = after[i]
        if symbols[i] < 0 or right >= n or symbols[i] * width + symbols[right] != key:
            continue  # One of the two has been merged since.
        symbols[i], symbols[right] = join, -1
        after[i] = right = after[right]
        if right < n:
            before[right] = i
            if (key := join * width + symbols[right]) in merges:
                rank, made = merges[key]
                heapq.heappush(waiting, (rank, i, made, key))
        left = before[i]
        if left >= 0 and (key := symbols[left] * width + join) in merges:
            rank, made = merges[key]
            heapq.heappush(waiting, (rank, left, made, key))
    left = [i for i in range(n) if symbols[i] >= 0]
    return [symbols[i] for i in left], left


def agendas(vocabulary: Vocabulary, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same for many short units, laid end to end: final symbols, the place each begins, how many a unit has.

    Each turn takes the top pair of every unit that still has one. Units without a pair leave.
    """
    unit = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(symbols))
    done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    at = np.full(len(symbols), len(vocabulary.keys) - 1)
    if len(symbols) > 1:
        at[:-1] = vocabulary.found(symbols[:-1], symbols[1:])
        at[:-1][unit[:-1] != unit[1:]] = len(vocabulary.keys) - 1
    while len(symbols):
        heads = np.flatnonzero(np.diff(unit, prepend=-1))
        # Rank first, then the place: the minimum is the agenda's top.
        order = (vocabulary.ranks[at].astype(np.int64) << 32) + np.arange(len(at))
        top = np.minimum.reduceat(order, heads)
        more = (top >> 32) != _NONE
        stay = np.repeat(more, np.diff(heads, append=len(unit)))
        done.append((unit[~stay], place[~stay], symbols[~stay]))
        i = top[more] & 0xFFFFFFFF
        symbols[i] = vocabulary.joins[at[i]]
        # The symbol on the right is gone; the one before and the new one make new pairs.
        stay[i + 1] = False
        shift = np.cumsum(stay) - 1
        symbols, unit, place, at = symbols[stay], unit[stay], place[stay], at[stay]
        new = shift[i]
        for near in (new, new[new > 0] - 1):
            right = np.minimum(near + 1, len(symbols) - 1)
            at[near] = np.where(
                (near + 1 < len(symbols)) & (unit[right] == unit[near]),
                vocabulary.found(symbols[near], symbols[right]),
                len(vocabulary.keys) - 1,
            )
    if not done:
        return symbols, place, np.zeros(len(sizes), np.int64)
    unit, place, symbols = (np.concatenate(x) for x in zip(*done, strict=True))
    order = np.argsort(place)
    return symbols[order], place[order], np.bincount(unit, minlength=len(sizes))


def unit_ids(vocabulary: Vocabulary, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all units end to end and where each unit's begin; units spell blanks as 0x20."""
    texts = [u.decode().replace(" ", BLANK) for u in units.to_pylist()]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    chars = "".join(texts)
    points = np.frombuffer(chars.encode("utf-32-le"), np.uint32)
    symbols = vocabulary.of_char[points]
    begin = np.concatenate([[0], np.cumsum(sizes)])
    short = sizes <= SIDE_BY_SIDE
    inside = np.repeat(short, sizes)
    final, place, count = agendas(vocabulary, symbols[inside], sizes[short])
    place = np.flatnonzero(inside)[place]
    counts = np.zeros(len(texts), np.int64)
    counts[short] = count
    long_symbols, long_places = [final], [place]
    for i in np.flatnonzero(~short):
        final, place = agenda(vocabulary, symbols[begin[i] : begin[i + 1]].tolist())
        long_symbols.append(np.array(final, np.int32))
        long_places.append(np.array(place, np.int64) + begin[i])
        counts[i] = len(final)
    final, place = np.concatenate(long_symbols), np.concatenate(long_places)
    order = np.argsort(place)
    final, place = final[order], place[order]
    first = np.concatenate([[0], np.cumsum(counts)])
    odd = np.flatnonzero(final >= vocabulary.pieces)
    if len(odd):
        # A symbol without a piece is one character.
        spelled = [vocabulary.spelled(int(final[i]), chars[place[i]]) for i in odd]
        more = np.zeros(len(final) + 1, np.int64)
        more[odd + 1] = [len(s) - 1 for s in spelled]
        shift = np.cumsum(more)
        out = np.zeros(len(final) + int(shift[-1]), np.int32)
        out[np.arange(len(final)) + shift[:-1]] = final
        for i, s in zip(odd, spelled, strict=True):
            out[i + shift[i] : i + shift[i] + len(s)] = s
        return out, first + shift[first]
    return final, first


def spread(first: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Places of the items of chosen lists, in the order chosen; list k is first[k] to first[k + 1]."""
    n = first[which + 1] - first[which]
    ends = np.cumsum(n)
    return np.repeat(first[which] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)


def agree(vocabulary: Vocabulary, units: pa.Array, ids: np.ndarray, first: np.ndarray) -> None:
    """Raises unless the library gives these ids for the units."""
    # The library puts the first blank there itself, but not before nothing.
    texts = [u[1:].decode() for u in units.to_pylist()]
    known = vocabulary.library.encode(texts, num_threads=1)
    if "" in texts:
        known[texts.index("")] = [vocabulary.library.piece_to_id(BLANK)]
    alike = np.array_equal(np.fromiter(map(len, known), np.int64, len(known)), np.diff(first))
    if not alike or not np.array_equal(np.fromiter((i for k in known for i in k), np.int32, len(ids)), ids):
        raise ValueError("The agenda and the sentencepiece library disagree")


def encoded(vocabulary: Vocabulary, column: pa.Array, check: str) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row range, ids of these rows end to end, and where each row's begin."""
    for begin, end, data, offsets in rounds(column, UNIT_ROUND):
        rows = [data[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        rows = [b" " + r.replace(BLANK.encode(), b" ") if r else r for r in rows]
        text = np.frombuffer(b"".join(rows), np.uint8)
        starts = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
        blank = text == 32
        heads = blank.copy()
        heads[1:] &= ~blank[:-1]
        heads[starts[:-1][np.diff(starts) > 0]] = True
        heads = np.flatnonzero(heads)
        cuts = pa.py_buffer(np.append(heads, len(text)).astype(np.int64))
        units = pa.Array.from_buffers(pa.large_binary(), len(heads), [None, cuts, pa.py_buffer(text)]).dictionary_encode()
        ids, first = unit_ids(vocabulary, units.dictionary)
        if check == "units":
            agree(vocabulary, units.dictionary, ids, first)
        which = units.indices.to_numpy().astype(np.int64)
        out = ids[spread(first, which)]
        total = np.concatenate([[0], np.cumsum(np.diff(first)[which])])
        row_first = total[np.searchsorted(heads, starts)]
        if check == "texts":
            whole = [data[a:b].tobytes().decode() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            for k, known in enumerate(vocabulary.library.encode(whole, num_threads=1)):
                if known != out[row_first[k] : row_first[k + 1]].tolist():
                    raise ValueError("The agenda and the sentencepiece library disagree")
        yield begin, end, out, row_first


def tokenize(
    docs: DataFrame, model_path: str, *, id_col: str = "doc_id", text_col: str = "text", check: str = "units"
) -> DataFrame:
    """One row per input row: the id, ``ids`` (array of int) and ``decoded``.

    ``model_path`` is a sentencepiece model of merge type; the driver reads it and every task gets
    its bytes. ``check`` compares with the library every distinct unit of a round ("units"), every
    whole text ("texts"), or nothing (""); a difference is an error. A null or empty text has no
    ids and decodes to the empty text. Characters the vocabulary lacks become bytes, or the unknown
    id without byte pieces. Rows are independent: null or repeated ids and other columns change
    nothing, no rows give no rows, and a text of any length is encoded whole, in memory in
    proportion to it.
    """
    with open(model_path, "rb") as file:
        shared = docs.sparkSession.sparkContext.broadcast({"model": file.read()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        if "vocabulary" not in held:
            # Made once in each Python process.
            held["vocabulary"] = Vocabulary(held["model"])
        vocabulary = held["vocabulary"]
        for batch in batches:
            for begin, end, ids, first in encoded(vocabulary, batch.column("_text"), check):
                flat = ids.tolist()
                lists = [flat[a:b] for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
                texts = vocabulary.library.decode(lists, num_threads=1)
                arrays = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id").slice(begin, end - begin), arrays, pa.array(texts, pa.string())], [id_col, "ids", "decoded"]
                )

    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    return rows.mapInArrow(run, f"`{id_col}` long, ids array<int>, decoded string")
