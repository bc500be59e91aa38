"""Toxicity by a support vector machine over a subsequence string kernel, with Nystroem landmarks.

A string's features are its subsequences of three letters that lie within a few letters of each
other, each weighted by DECAY per letter it spans, so a letter put in or left out keeps most of
them. The machine is fitted in the space that its landmarks span; as every kernel value is an inner
product of those features, the fitted function is one weight per letter triple, which a task looks
up for whole batches. A document scores by its worst string.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import rounds, spaced_table

#: Labelled documents learned from, of each class, and characters of each.
SAMPLE_ROWS, SAMPLE_CHARS = 2500, 8000
#: Subsequences span at most REACH letters; each letter spanned costs this factor.
REACH, DECAY = 6, 0.7
LANDMARKS = 256
#: Evidence (log likelihood ratio) that a string belongs to toxic documents, and its least share of them.
EVIDENCE, PURITY = 14.0, 0.9
#: Clean strings of the first round, and most that each later round adds; cost of a mistake.
NEGATIVES, ROUNDS, COST = 6000, 4, 4.0
_ALPHABET = 32


def letters() -> np.ndarray:
    """1 to 26 for Latin letters without case, four more for bytes beyond ASCII, 0 for the rest."""
    table = np.zeros(256, np.uint8)
    table[97:123] = table[65:91] = np.arange(1, 27)
    table[128:] = 27 + np.arange(128) % 5
    return table


def units(data: np.ndarray, offsets: np.ndarray, letter: np.ndarray, blank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letters of all strings, where each string begins in them, and the row of each string.

    A string is a word between blanks without what is no letter; single letters in a row
    are one string, so a word that is spelled out stays one.
    """
    code = letter[data]
    spoken = code > 0
    word = np.zeros(len(data) + 1, np.int64)
    edge = ~blank[data]
    edge[1:] &= blank[data][:-1]
    begins = offsets[:-1][np.diff(offsets) > 0]
    edge[begins] = True
    np.cumsum(edge, out=word[1:])
    number = word[1:][spoken]
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[spoken]
    code = code[spoken]
    if not len(code):
        return code, np.zeros(0, np.int64), np.zeros(0, np.int64)
    start = np.flatnonzero(np.diff(number, prepend=-1))
    size = np.diff(np.append(start, len(code)))
    alone = size == 1
    joined = np.zeros(len(start), bool)
    joined[1:] = alone[1:] & alone[:-1] & (row[start[1:]] == row[start[:-1]])
    start = start[~joined]
    return code, start, row[start]


def norms(size: np.ndarray) -> np.ndarray:
    """Length of the feature vector of a string of so many different letters."""
    total = np.zeros(len(size))
    for k in range(2, REACH):
        total += np.maximum(size - k, 0) * (k - 1) * DECAY ** (2 * k)
    return np.sqrt(np.maximum(total, 1e-9))


def string_scores(code: np.ndarray, start: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weighted subsequences of each string over its norm."""
    if not len(start):
        return np.zeros(0)
    n = len(code)
    size = np.diff(np.append(start, n))
    rest = np.repeat(start + size, size) - np.arange(n)
    wide = code.astype(np.int32)
    total = np.zeros(n, np.float32)
    for k in range(2, min(REACH, n)):
        inside = rest[: n - k] > k
        found = np.zeros(n - k, np.float32)
        ends = wide[: n - k] * (_ALPHABET * _ALPHABET) + wide[k:]
        for j in range(1, k):
            found += weights[ends + wide[j : n - k + j] * _ALPHABET]
        total[: n - k] += np.where(inside, found, 0) * np.float32(DECAY**k)
    return np.add.reduceat(total, start) / norms(size)


def _buffer(strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters of some strings and where each begins."""
    letter = letters()
    codes = [letter[np.frombuffer(s.encode(), np.uint8)] for s in strings]
    codes = [c[c > 0] for c in codes]
    return np.concatenate(codes), np.cumsum([0] + [len(c) for c in codes])[:-1]


def kernel_rows(strings: list[str], basis: np.ndarray) -> np.ndarray:
    """Kernel values of strings with landmarks, whose normalised features are the rows of ``basis``."""
    out = np.zeros((len(strings), len(basis)), np.float32)
    for at in range(0, len(strings), 1000):
        code, start = _buffer(strings[at : at + 1000])
        row, triple, value = string_features(code, start)
        order = np.argsort(row, kind="stable")
        row, triple, value = row[order], triple[order], value[order]
        cuts = np.flatnonzero(np.diff(row, prepend=-1))
        if len(cuts):
            out[at + row[cuts]] = np.add.reduceat(basis.T[triple] * value[:, None], cuts)
    return out


def string_features(code: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, triple, value) of the normalised features."""
    n = len(code)
    size = np.diff(np.append(start, n))
    owner = np.repeat(np.arange(len(start)), size)
    rest = np.repeat(start + size, size) - np.arange(n)
    norm = norms(size).astype(np.float32)
    wide = code.astype(np.int64)
    rows, triples, values = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.float32)]
    for k in range(2, min(REACH, n)):
        at = np.flatnonzero(rest > k)
        for j in range(1, k):
            rows.append(owner[at])
            triples.append((wide[at] * _ALPHABET + wide[at + j]) * _ALPHABET + wide[at + k])
            values.append(np.float32(DECAY**k) / norm[owner[at]])
    return np.concatenate(rows), np.concatenate(triples), np.concatenate(values)


def svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, steps: int = 60) -> tuple[np.ndarray, float]:
    """Weights and offset of a linear machine with squared hinge loss, by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    ridge = np.eye(len(w))
    ridge[-1, -1] = 1e-3
    for _ in range(steps):
        gap = 1 - y * (x @ w)
        on = gap > 0
        grad = ridge @ w - 2 * (x[on] * (cost * y * gap)[on, None]).sum(0)
        hess = ridge + 2 * (x[on] * cost[on, None]).T @ x[on]
        move = np.linalg.solve(hess, grad)
        w -= move
        if np.abs(move).max() < 1e-6:
            break
    return w[:-1], w[-1]


def _strings(text: str) -> set[str]:
    out, run = set(), ""
    for word in re.split(r"[ \t-\r]+", text.lower()):
        kept = "".join(c for c in word if c.isalpha())
        if len(kept) == 1:
            run += kept
            continue
        if len(run) > 2:
            out.add(run)
        run = ""
        if len(kept) > 2:
            out.add(kept)
    if len(run) > 2:
        out.add(run)
    return out


def suspects(texts: list[tuple[str, int]]) -> Counter:
    """Strings of toxic documents that other documents lack, with the documents that have them.

    A string counts by itself or by its beginning, so that inflected forms support each other.
    """
    bags = [(_strings(t), y) for t, y in texts]
    share = sum(y for _, y in bags) / len(bags)
    inside, outside = Counter(), Counter()
    for bag, y in bags:
        stems = {s[:n] for s in bag for n in (4, 5)} | bag
        (inside if y else outside).update(stems)

    def telling(unit: str) -> bool:
        a, b = inside[unit], outside[unit]
        p = a / (a + b)
        if a < 3 or p < PURITY or p <= share:
            return False
        ratio = a * math.log(p / share) + (b * math.log((1 - p) / (1 - share)) if b else 0)
        return ratio * 2 > EVIDENCE

    known = {u for u in inside if telling(u)}
    found: Counter = Counter()
    for bag, y in bags:
        if y:
            found.update(s for s in bag if s in known or s[:4] in known or s[:5] in known)
    return found


class Model:
    """Weights of letter triples, offset, and how a document's strings become a probability."""

    def __init__(self, texts: list[tuple[str, int]]) -> None:
        self.weights = np.zeros(_ALPHABET**3, np.float32)
        self.offset = -1.0
        self.scale = (0.0, -10.0, 0.0)
        good = sum(1 - y for _, y in texts)
        found = suspects(texts) if 0 < good < len(texts) else Counter()
        if found:
            self._fit(texts, found)

    def _fit(self, texts: list[tuple[str, int]], found: Counter) -> None:
        rng = np.random.default_rng(7)
        positive = sorted(found)
        clean = sorted({s for t, y in texts if not y for s in _strings(t)} - set(found))
        code, start = _buffer(clean or ["aaa"])
        pick = rng.permutation(len(clean))[:NEGATIVES]
        negative = [clean[i] for i in pick]
        marks = sorted(found, key=lambda s: (-found[s], s))[: LANDMARKS // 2] + negative[: LANDMARKS // 2]
        basis = np.zeros((len(marks), _ALPHABET**3), np.float32)
        row, triple, value = string_features(*_buffer(marks))
        np.add.at(basis, (row, triple), value)
        values, vectors = np.linalg.eigh((basis @ basis.T).astype(np.float64))
        kept = values > 1e-6 * values.max()
        # The map of a string's kernel values with the landmarks into the space they span.
        whiten = vectors[:, kept] / np.sqrt(values[kept])
        good = kernel_rows(positive, basis) @ whiten
        # Strings of many toxic documents count more.
        weight = np.array([found[s] for s in positive], float)
        weight *= COST / np.median(weight)
        for _ in range(ROUNDS):
            bad = kernel_rows(negative, basis) @ whiten
            y = np.concatenate([np.ones(len(good)), -np.ones(len(bad))])
            w, self.offset = svm(np.vstack([good, bad]), y, np.concatenate([weight, np.full(len(bad), COST)]))
            self.weights = ((whiten @ w) @ basis).astype(np.float32)
            # The clean strings that come nearest join the negatives for the next round.
            reached = string_scores(code, start, self.weights) + self.offset
            known = set(negative)
            hard = [clean[i] for i in np.argsort(-reached)[:NEGATIVES] if reached[i] > -0.8 and clean[i] not in known]
            if not hard:
                break
            negative += hard
        worst = np.array([self._document(t) for t, _ in texts])
        self.scale = self._logistic(worst, np.array([float(label) for _, label in texts]))

    def _document(self, text: str) -> tuple[float, float]:
        data = np.frombuffer(text.encode(), np.uint8)
        best, many = read_rows(data, np.array([0, len(data)]), self.weights, self.offset)
        return best[0], many[0]

    def _logistic(self, x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
        x = np.hstack([x, np.ones((len(x), 1))])
        w = np.zeros(3)
        for _ in range(50):
            p = 1 / (1 + np.exp(-x @ w))
            hess = (x * (p * (1 - p))[:, None]).T @ x + np.diag([0.05, 0.05, 1e-6])
            move = np.linalg.solve(hess, x.T @ (p - y) + np.diag([0.05, 0.05, 0]) @ w)
            w -= move
            if np.abs(move).max() < 1e-6:
                break
        return float(w[0]), float(w[2]), float(w[1])


def read_rows(data: np.ndarray, offsets: np.ndarray, weights: np.ndarray, offset: float) -> tuple[np.ndarray, np.ndarray]:
    """Of each row: the value of its worst string, and the log of how many are bad."""
    code, start, row = units(data, offsets, letters(), ~spaced_table())
    value = string_scores(code, start, weights) + offset
    best = np.full(len(offsets) - 1, -1.5)
    np.maximum.at(best, row, value)
    many = np.bincount(row[value > 0], minlength=len(best))
    return np.minimum(best, 1.5), np.log1p(many)


def probabilities(data: np.ndarray, offsets: np.ndarray, fitted: tuple) -> np.ndarray:
    """Score of each row; ``fitted`` is a model's weights, offset and scale."""
    weights, offset, (slope, base, extra) = fitted
    best, many = read_rows(data, offsets, weights, offset)
    return 1 / (1 + np.exp(-(slope * best + extra * many + base)))


def labelled_texts(docs: DataFrame, labels: DataFrame, held_out: Column, id_col: str, text_col: str, label_col: str) -> list[tuple[str, int]]:
    """At most SAMPLE_ROWS documents of each class, chosen by a hash of the id."""
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    known = known.groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).alias("_y"))
    draw = F.xxhash64("_id", F.lit("toxic"))
    known = known.filter(~held_out)
    parts = [known.filter(F.col("_y") == y).orderBy(draw, "_id").limit(SAMPLE_ROWS) for y in (0, 1)]
    chosen = parts[0].unionByName(parts[1])
    # Two times SAMPLE_ROWS ids at most.
    rows = docs.select(F.col(id_col).alias("_id"), F.substring(text_col, 1, SAMPLE_CHARS).alias("text"))
    rows = rows.join(F.broadcast(chosen), "_id").filter("text is not null")
    found = rows.select("_id", "text", F.col("_y").cast("int").alias("y")).collect()
    return [(r.text, r.y) for r in sorted(found, key=lambda r: (r["_id"], r.text))]


def score_documents(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> DataFrame:
    """One row per input row: id, held_out, score, predicted.

    Rows whose id has crc32 mod 5 = 0 are held out: nothing is learned from their labels. Null and
    empty texts score as texts without a bad string. Several labels of one id count as the worst,
    null labels as none. Without labels of both classes every score is near 0.
    """
    spark = docs.sparkSession

    def fold(c: str) -> Column:
        return F.crc32(F.coalesce(F.col(c).cast("string"), F.lit(""))) % 5 == 0

    model = Model(labelled_texts(docs, labels, fold("_id"), id_col, text_col, label_col))
    shared = spark.sparkContext.broadcast((model.weights, model.offset, model.scale))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        for batch in batches:
            found = [probabilities(data, offsets, fitted) for _, _, data, offsets in rounds(batch.column("_text"))]
            p = np.concatenate(found) if found else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_held"), pa.array(p, pa.float64()), pa.array((p >= 0.5).astype(np.int32))],
                [id_col, "held_out", "score", "predicted"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("_id"), fold(id_col).alias("_held"), F.col(text_col).alias("_text"))
    return rows.mapInArrow(score, f"`{id_col}` long, held_out boolean, score double, predicted int")
