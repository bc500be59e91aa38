"""Language identification by cross-parsing: which language's text explains a document in fewest phrases.

A suffix automaton of some labelled text of each language recognises every string that occurs in
it. A document is cut greedily into longest phrases the automaton knows. Phrases times the bits of
a position in the training text, over the document's bytes, estimate the cross-entropy; the language
with the smallest estimate wins.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrays import rounds

#: The labelled sample: documents of each language and bytes taken from each.
SAMPLE_DOCS, SAMPLE_BYTES = 96, 384
#: A document is parsed in pieces of so many bytes, all of them at once; a phrase ends with its piece.
PIECE = 256
UNKNOWN = "und"
#: Bits of phrases over bits of single symbols from which a text counts as being in no language.
REJECT = 1.6
_BREAK = 1 << 30


def symbols() -> np.ndarray:
    """Letters without case, bytes beyond ASCII, and one blank for everything else."""
    table = np.full(256, 32, np.uint8)
    for c in (*range(97, 123), *range(128, 256)):
        table[c] = c
    table[65:91] = table[97:123]
    return table


def automaton(text: bytes) -> tuple[list[dict[int, int]], int]:
    """Transitions of the suffix automaton of a text; state 0 is the start."""
    go: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in text:
        new = len(go)
        go.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and c not in go[at]:
            go[at][c] = new
            at = link[at]
        if at >= 0:
            target = go[at][c]
            if length[target] == length[at] + 1:
                link[new] = target
            else:
                twin = len(go)
                go.append(dict(go[target]))
                length.append(length[at] + 1)
                link.append(link[target])
                link[target] = link[new] = twin
                while at >= 0 and go[at].get(c) == target:
                    go[at][c] = twin
                    at = link[at]
        last = new
    return go, len(go)


def parse_tables(texts: dict[str, bytes]) -> dict:
    """One array of moves for all languages: next state, marked where a phrase ends before the symbol.

    States are multiples of the number of symbols. The last symbol pads pieces: it leads back to
    the start and ends nothing.
    """
    table = symbols()
    used = sorted({c for text in texts.values() for c in text})
    width = len(used) + 2
    number = np.full(256, len(used), np.int32)
    number[used] = np.arange(len(used))
    moves, starts, base = [], [], 0
    for text in texts.values():
        go, n = automaton(text)
        if base + (n + 1) * width > _BREAK:
            raise ValueError(f"The tables of {len(texts)} languages do not fit; take less of each")
        # A symbol the text lacks is a phrase alone: from its state, n, every symbol begins anew.
        first = np.full(width, base + n * width, np.int64)
        for c, to in go[0].items():
            first[number[c]] = base + to * width
        block = np.tile(first | _BREAK, (n + 1, 1))
        block[0] = first
        for state, out in enumerate(go):
            for c, to in out.items():
                block[state, number[c]] = base + to * width
        block[:, width - 1] = base
        moves.append(block.astype(np.int32).ravel())
        starts.append(base)
        base += (n + 1) * width
    bits = np.array([np.log2(max(2, len(text))) for text in texts.values()])
    return {
        "moves": np.concatenate(moves),
        "starts": np.array(starts, np.int32),
        "symbol": number[table],
        "pad": width - 1,
        "bits": bits,
        "letter_bits": np.array([letter_bits(text) for text in texts.values()]),
    }


def phrase_counts(model: dict, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Phrases of each row for each language: (rows, languages)."""
    sizes = np.diff(offsets)
    pieces = -(-sizes // PIECE)
    first = np.concatenate([[0], np.cumsum(pieces)])
    owner = np.repeat(np.arange(len(sizes)), pieces)
    begin = offsets[owner] + (np.arange(first[-1]) - first[owner]) * PIECE
    length = np.minimum(PIECE, offsets[owner + 1] - begin)
    counts = np.zeros((len(model["starts"]), first[-1]), np.int64)
    if first[-1]:
        at = np.minimum(begin[None, :] + np.arange(PIECE)[:, None], len(data) - 1)
        text = model["symbol"][data][at]
        text[np.arange(PIECE)[:, None] >= length[None, :]] = model["pad"]
        state = np.repeat(model["starts"][:, None], first[-1], 1)
        moves = model["moves"]
        for step in range(PIECE):
            moved = moves[state + text[step]]
            counts += moved >> 30
            state = moved & (_BREAK - 1)
        counts += 1
    total = np.concatenate([np.zeros((len(counts), 1), np.int64), np.cumsum(counts, 1)], 1)
    return (total[:, first[1:]] - total[:, first[:-1]]).T


def letter_bits(text: bytes) -> float:
    """Bits a symbol takes where only the symbols' frequencies are known."""
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=1)
    shares = counts[counts > 0] / max(1, counts.sum())
    return float(-(shares * np.log2(shares)).sum())


def repeated_blanks(model: dict, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many blanks of each row follow a blank; training texts have none, so each ends a phrase."""
    blank = symbols()[data] == 32
    again = np.zeros(len(data) + 1, np.int64)
    if len(data):
        np.cumsum(blank[1:] & blank[:-1], out=again[2:])
    return again[offsets[1:]] - again[np.minimum(offsets[:-1] + 1, offsets[1:])]


def has_letter(text: bytes) -> bool:
    return any(c.isalpha() for c in text.decode("utf-8", "replace"))


def training_texts(docs: DataFrame, held_out: Column, id_col: str, text_col: str, lang_col: str) -> dict[str, bytes]:
    """Bounded labelled text per language, chosen by a hash of id and text; rows equal in both count once.

    The driver gets SAMPLE_DOCS snippets of SAMPLE_BYTES a language at most and nothing else. Where a
    snippet starts is drawn by itself, so snippets are from all over the texts, however many there are.
    """
    usable = ~F.coalesce(held_out, F.lit(True)) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()
    draw = (F.xxhash64(F.col(id_col), F.col(text_col), F.lit("lang")) / F.lit(float(1 << 64))) + 0.5
    begin = F.xxhash64(F.col(id_col), F.col(text_col), F.lit("start"))
    labelled = docs.select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"), draw.alias("draw"), begin.alias("begin"), usable.alias("ok")
    ).filter("ok")
    share = labelled.groupBy("lang").agg((F.lit(4.0 * SAMPLE_DOCS) / F.approx_count_distinct("draw")).alias("share"))
    start = F.pmod("begin", F.greatest(F.length("text") - SAMPLE_BYTES + 1, F.lit(1)).cast("long")) + 1
    # One row of two numbers for each language.
    near = labelled.join(F.broadcast(share), "lang").filter(F.col("draw") <= F.col("share"))
    parts = near.select("lang", "draw", F.substring("text", start.cast("int"), F.lit(SAMPLE_BYTES)).alias("part"))
    parts = parts.dropDuplicates(["lang", "draw", "part"])
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "part"))
    rows = parts.withColumn("place", place).filter(F.col("place") <= SAMPLE_DOCS).collect()
    table = bytes(symbols())
    out: dict[str, bytes] = {}
    for lang in sorted({r.lang for r in rows}):
        chosen = sorted((r for r in rows if r.lang == lang), key=lambda r: r.place)
        parts = (r.part.encode()[:SAMPLE_BYTES] for r in chosen)
        text = b" ".join(" ".join(p.translate(table).decode("utf-8", "ignore").split()).encode() for p in parts)
        if has_letter(text):
            out[lang] = text
    return out


def predictor(
    texts: dict[str, bytes], spark: SparkSession, reject: bool = False
) -> Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]:
    """A function from a column of texts to their languages and scores.

    With ``reject`` a text is in no language if the best one's phrases take REJECT times the bits that its symbols
    would take one by one: the language then explains nothing of it. Blanks after blanks do not count, nor does the phrase
    that the text's end cuts off.
    """
    shared = spark.sparkContext.broadcast({"texts": texts})

    def predict(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        model = shared.value
        names = np.array([*model["texts"], UNKNOWN], object)
        if model["texts"] and "moves" not in model:
            # Made once in each Python process.
            model.update(parse_tables(model["texts"]))
        ascii_letter = np.zeros(256, bool)
        ascii_letter[65:91] = ascii_letter[97:123] = True
        best, score = [np.zeros(0, np.int64)], [np.zeros(0)]
        for _, _, data, offsets in rounds(column):
            sizes = np.diff(offsets)
            seen = np.concatenate([[0], np.cumsum(ascii_letter[data])])
            letters = seen[offsets[1:]] > seen[offsets[:-1]]
            for i in np.flatnonzero(~letters & (sizes > 0)):
                letters[i] = has_letter(data[offsets[i] : offsets[i + 1]].tobytes())
            if not model["texts"]:
                letters[:] = False
                estimate = np.ones((len(sizes), 1))
            else:
                phrases = phrase_counts(model, data, offsets)
                estimate = phrases * model["bits"] / np.maximum(sizes, 1)[:, None]
                if reject:
                    first = np.argmin(estimate, 1)
                    again = repeated_blanks(model, data, offsets)
                    whole = phrases[np.arange(len(sizes)), first] - 1 - again
                    letters &= whole * model["bits"][first] < REJECT * model["letter_bits"][first] * np.maximum(sizes - again, 1)
            order = np.argsort(estimate, 1, kind="stable")
            low = np.take_along_axis(estimate, order[:, :2], 1)
            lead = 1 - low[:, 0] / np.maximum(low[:, 1], 1e-9) if low.shape[1] > 1 else np.ones(len(sizes))
            best.append(np.where(letters, order[:, 0], len(names) - 1))
            score.append(np.where(letters, lead, 0.0))
        return names[np.concatenate(best)], np.concatenate(score)

    return predict


def default_fold(id_col: str) -> Column:
    """Rows that nothing is learned from: crc32 of the id as text, mod 3, is 1."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 3 == 1


def identify(
    docs: DataFrame,
    held_out: Column | None = None,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """One row per input row: id, held_out, lang_pred, score.

    ``held_out`` marks the rows nothing is learned from (default: ``default_fold``). A null text,
    or one without any letter, gives ``und`` and 0, as does a table without labels. Equal estimates
    go to the language whose name comes first. score is the share by which the best estimate
    undercuts the second; with one language it is 1. No rows give no rows.
    """
    held_out = default_fold(id_col) if held_out is None else held_out
    predict = predictor(training_texts(docs, held_out, id_col, text_col, lang_col), docs.sparkSession)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, score = predict(batch.column("_text"))
            columns = [batch.column("_id"), batch.column("_held"), pa.array(found, pa.string()), pa.array(score, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [id_col, "held_out", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("_id"), held_out.alias("_held"), F.col(text_col).alias("_text"))
    return rows.mapInArrow(judge, f"`{id_col}` long, held_out boolean, lang_pred string, score double")


def in_a_language(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` that are in one of the learned languages, with all their columns.

    Null texts go, as do texts without any letter and those that the nearest language explains no better than
    single letters do: random characters, or another script. A text of a phrase or two stays. Rows are judged
    each by itself, so repeated rows and ids change nothing; a table without labels keeps no row, no rows give none.
    """
    texts = training_texts(docs, default_fold(id_col), id_col, text_col, lang_col)
    predict = predictor(texts, docs.sparkSession, reject=True)

    @F.arrow_udf(T.StringType())
    def language(column: pa.Array) -> pa.Array:
        return pa.array(predict(column)[0], pa.string())

    return docs.filter(language(F.col(text_col)) != UNKNOWN)
