"""Runs of repeated words by a suffix automaton with link-cut access.

Words are appended one by one to a suffix automaton. Its suffix links form a tree in which the
strings that end at the newest word are one path, from the newest state to the start. The path
consists of segments that share the place where their strings last ended; link-cut access walks
them and then recolours all of the path with the new end. A segment whose longest string has at
least as many words as lie between its last end and the new one is a square; string and distance
together are the repetition as far as it has come. Its start is final, and its end is when no later
word reports the same start and period.

Stretches that cannot hold a long run never enter the automaton: in a run of length n and period q,
every group of GROUP words that ends n - q - GROUP + 1 words or less before the end also ends at
most q words earlier.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import WordHasher, joined_hashes, rounds, spaced_table, word_spans

#: A run has at least so many words and so many periods.
LEAST, TIMES = 24, 3
#: Words of the groups that decide which stretches are searched; less than LEAST / TIMES would hold any run too.
GROUP = 8


class LinkedAutomaton:
    """A suffix automaton of a growing row of numbers, its link tree held as preferred paths.

    A path is a splay tree by depth, left nearer to the start. The top of its tree holds the place
    where the path's strings last ended and the state above the path.
    """

    def __init__(self) -> None:
        self.go: list[dict[int, int]] = [{}]
        self.link, self.size = [-1], [0]
        self.last = 0
        self.left, self.right, self.up, self.above = [-1], [-1], [-1], [-1]
        self.colour = [-1]

    def _state(self, size: int, link: int, go: dict[int, int]) -> int:
        for column, value in (
            (self.go, go), (self.link, link), (self.size, size), (self.left, -1), (self.right, -1),
            (self.up, -1), (self.above, link), (self.colour, -1),
        ):
            column.append(value)
        return len(self.go) - 1

    def _splay(self, v: int) -> None:
        """Makes ``v`` the top of its path's tree; the path's colour and the state above it go along."""
        left, right, up = self.left, self.right, self.up
        p = up[v]
        if p < 0:
            return
        while p >= 0:
            g = up[p]
            if g >= 0:
                # Double turns keep the trees shallow on average.
                turns = (p, v) if (left[g] == p) == (left[p] == v) else (v, v)
            else:
                turns = (v,)
            for x in turns:
                y = up[x]
                z = up[y]
                if left[y] == x:
                    c = left[y] = right[x]
                    right[x] = y
                else:
                    c = right[y] = left[x]
                    left[x] = y
                if c >= 0:
                    up[c] = y
                up[y], up[x] = x, z
                if z >= 0:
                    if left[z] == y:
                        left[z] = x
                    else:
                        right[z] = x
                else:
                    self.colour[x], self.above[x] = self.colour[y], self.above[y]
            p = up[v]

    def _insert_above(self, twin: int, v: int) -> None:
        """Puts a new state between ``v`` and its link, on v's path and with its colour."""
        self._splay(v)
        high = self.left[v]
        self.left[twin] = high
        if high >= 0:
            self.up[high] = twin
        self.left[v], self.up[twin] = twin, v

    def append(self, word: int) -> None:
        go, link, size = self.go, self.link, self.size
        at = self.last
        new = self.last = self._state(size[at] + 1, 0, {})
        while at >= 0 and word not in go[at]:
            go[at][word] = new
            at = link[at]
        if at >= 0:
            target = go[at][word]
            if size[target] != size[at] + 1:
                twin = self._state(size[at] + 1, link[target], dict(go[target]))
                self._insert_above(twin, target)
                link[target] = twin
                while at >= 0 and go[at].get(word) == target:
                    go[at][word] = twin
                    at = link[at]
                target = twin
            link[new] = target
        self.above[new] = link[new]

    def access(self, end: int) -> list[tuple[int, int]]:
        """(last end, longest string) of the segments above the newest state, which all get ``end`` instead."""
        left, right, up, above, colour = self.left, self.right, self.up, self.above, self.colour
        found = []
        v = self.last
        while (top := above[v]) >= 0:
            # v is the top of the tree of the path so far.
            self._splay(top)
            low = right[top]
            if low >= 0:
                # What lies below stays a path of its own.
                up[low] = -1
                colour[low], above[low] = colour[top], top
            if colour[top] >= 0:
                found.append((colour[top], self.size[top]))
            right[top] = v
            up[v] = top
            v = top
        colour[v] = end
        return found


def repetitions(words: list[int], least: int = LEAST, times: int = TIMES) -> dict[tuple[int, int], int]:
    """Last word of every run, by its first word and period."""
    automaton = LinkedAutomaton()
    out: dict[tuple[int, int], int] = {}
    for end, word in enumerate(words):
        automaton.append(word)
        for before, length in automaton.access(end):
            period = end - before
            total = length + period
            if period <= length and total >= least and total >= times * period:
                out[end - total + 1, period] = end
    return out


def stretches(words: np.ndarray, group: int = GROUP) -> list[tuple[int, int]]:
    """Disjoint ranges of words, in order, such that every run lies in one of them.

    ``words`` are 64-bit hashes of the words; equal words have equal ones.
    """
    grams = joined_hashes(words, group)
    if len(words) < LEAST:
        return []
    order = np.argsort(grams, kind="stable")
    again = grams[order[1:]] == grams[order[:-1]]
    back = np.full(len(grams), len(words), np.int64)
    back[order[1:][again]] = (order[1:] - order[:-1])[again]
    at, wide = np.flatnonzero(back < len(words)), np.zeros(0, np.int64)
    while len(at):
        first = np.flatnonzero(np.diff(at, prepend=-2) > 1)
        sizes = np.diff(first, append=len(at))
        # A run with period q leaves n - q - group + 1 >= 2 q - group + 1 of them in a row, none further back than q.
        wide = np.repeat((sizes + group - 1) // (TIMES - 1), sizes)
        enough = np.repeat(sizes >= LEAST - group + 1 - (sizes + group - 1) // (TIMES - 1), sizes)
        stay = (back[at] <= wide) & enough
        if stay.all():
            break
        at = at[stay]
    if not len(at):
        return []
    first = np.flatnonzero(np.diff(at, prepend=-2) > 1)
    final = np.append(first[1:], len(at)) - 1
    begins, ends = np.maximum(at[first] - wide[first], 0), at[final] + group
    out: list[tuple[int, int]] = []
    for begin, end in zip(begins.tolist(), ends.tolist(), strict=True):
        while out and begin < out[-1][1]:
            begin = min(begin, out.pop()[0])
        out.append((begin, end))
    return out


def word_runs(words: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of one document, by start, then period."""
    found = []
    for begin, end in stretches(words):
        numbers = np.unique(words[begin:end], return_inverse=True)[1].tolist()
        found += [(begin + start, last - start + 1, period) for (start, period), last in repetitions(numbers).items()]
    return sorted(found, key=lambda r: (r[0], r[2]))


def looped(n: int, key: int) -> np.ndarray:
    """Which original word stands at each place of a document of n words that a fault in its source repeats."""
    g = key // 10
    begin = g % n
    period = 1 + (n - begin) // (3 + g % 8)
    at = np.arange(n)
    return np.where(at < begin, at, begin + (at - begin) % period)


def longest_first(run: tuple[int, int, int], other: tuple[int, int, int]) -> bool:
    """Whether a run repeats more often than another, compared as fractions."""
    return run[1] * other[2] > other[1] * run[2]


def runs_of_words(
    docs: DataFrame, loop: Column | None = None, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: the id, ``n_words``, ``runs`` (start, length, period), ``best`` and ``collapsed``.

    Words are what lies between blanks, numbered from 0. ``runs`` are the stretches of at least
    LEAST words and TIMES periods that no neighbouring word extends, by start, then period, with
    their smallest period. ``best`` is the run with most periods, ties to the smallest start, then period, null
    without a run. ``collapsed`` is the text without the words that any run repeats, joined by one
    space. Where ``loop`` is an unsigned number divisible by 10, the words are first repeated as ``looped`` states.
    Null and empty texts have no words, no runs and an empty ``collapsed``. Rows are independent: null or
    repeated ids and other columns change nothing, no rows give no rows. Texts of any length are
    searched whole; the automaton needs memory in proportion to the longest repetitive stretch.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, table = WordHasher(), spaced_table()
        runs_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            keys = batch.column("_loop").to_pylist()
            counts: list[int] = []
            found: list = []
            best: list = []
            texts: list[bytes] = []
            for begin, _, data, offsets in rounds(batch.column("_text")):
                starts, ends, first = word_spans(data, offsets, table)
                words = hasher(data, starts, ends)
                for i in range(len(offsets) - 1):
                    a, b = int(first[i]), int(first[i + 1])
                    key, own = keys[begin + i], words[a:b]
                    place = np.arange(a, b)
                    if key is not None and key % 10 == 0 and a < b:
                        place = a + looped(b - a, key)
                        own = words[place]
                    runs = word_runs(own)
                    kept = np.ones(b - a, bool)
                    top = None
                    for run in runs:
                        kept[run[0] + run[2] : run[0] + run[1]] = False
                        if top is None or longest_first(run, top):
                            top = run
                    counts.append(b - a)
                    found.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in runs])
                    best.append(dict(zip(("start", "length", "period"), top, strict=True)) if top else None)
                    place = place[kept]
                    raw = data[offsets[i] : offsets[i + 1]].tobytes()
                    spans = zip((starts[place] - offsets[i]).tolist(), (ends[place] - offsets[i]).tolist(), strict=True)
                    texts.append(b" ".join([raw[x:y] for x, y in spans]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id"),
                    pa.array(counts, pa.int64()),
                    pa.array(found, runs_type),
                    pa.array(best, runs_type.value_type),
                    pa.array(texts, pa.binary()).cast(pa.string()),
                ],
                [id_col, "n_words", "runs", "best", "collapsed"],
            )

    rows = docs.select(
        F.col(id_col).cast("long").alias("_id"),
        F.col(text_col).alias("_text"),
        (F.lit(None) if loop is None else loop).cast("long").alias("_loop"),
    )
    run = "struct<start: long, length: long, period: long>"
    return rows.mapInArrow(search, f"`{id_col}` long, n_words long, runs array<{run}>, best {run}, collapsed string")
