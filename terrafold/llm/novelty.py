"""Secret scan by dictionary-primed compression novelty.

Three plain patterns give the base spans. Beside them, long unbroken strings in sensitive code (lines
up to a blank one, or an opened key block up to its end) are candidates: each is compressed after the
text next to it, by zstandard primed with the identifiers that all such code shares and with the
enclosing code. A string that adds nearly as many bytes as random text would is reported as novel.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import fresh_path
from .arrays import rounds

#: The base patterns, on bytes, and their least lengths.
ASSIGN = re.compile(
    rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE
)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
LEAST = {"assign": 12, "access": 18, "hex": 16}
KINDS = ("assign", "access", "hex", "novel")

#: What makes code sensitive, what parts it, and what opens a key block.
SENSITIVE = re.compile(rb"key|secret|token|passw|pwd|auth|credential|bearer|private|signature|session|login", re.IGNORECASE)
BLANK_LINE = re.compile(rb"\n[ \t\r\f\v]*(?=\n)")
KEY_BLOCK = re.compile(rb"-----BEGIN [A-Z0-9 ]*PRIVATE KEY[A-Z ]*-----(?:(?!-----BEGIN ).)*?(?:-----END [A-Z0-9 ]+-----|(?=-----BEGIN )|\Z)", re.DOTALL)
#: Bytes on each side of a string that are compressed with it; the code beyond them is in the dictionary.
CONTEXT = 96
#: A name and sign before a value, and what parts an address.
_NAME = re.compile(rb"[A-Za-z_][A-Za-z0-9_.-]*(?::=|=>|[:=])")
_ADDRESS = re.compile(rb"[^/?&=@:,;]+")
#: Letters and digits of a candidate, and compressed bytes per character that make it novel.
CANDIDATE_CHARS, NOVELTY = 16, 0.55
#: Identifiers of the dictionary, the most frequent ones, and its bytes.
DICTIONARY_NAMES, DICTIONARY_BYTES = 4000, 1 << 15
LEVEL = 9


def runs(data: np.ndarray, offsets: np.ndarray, table: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and end of the maximal runs of at least so many bytes of a class."""
    inside = np.concatenate([[False], table[data], [False]])
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = turns[::2], turns[1::2]
    # A run that crosses rows is cut at each row's beginning; only long ones can matter.
    long = ends - starts >= least
    starts, ends = starts[long], ends[long]
    out: list[tuple[int, int, int]] = []
    first = np.searchsorted(offsets, starts, "right") - 1
    last = np.searchsorted(offsets, ends, "left") - 1
    for a, b, i, j in zip(starts.tolist(), ends.tolist(), first.tolist(), last.tolist(), strict=True):
        for row in range(i, j + 1):
            x, y = max(a, int(offsets[row])), min(b, int(offsets[row + 1]))
            if y - x >= least:
                out.append((row, x, y))
    return tuple(np.array(c, np.int64) for c in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 3


def class_table(pattern: bytes) -> np.ndarray:
    found = re.compile(b"[" + pattern + b"]")
    return np.array([bool(found.match(bytes([c]))) for c in range(256)])


def base_spans(text: bytes) -> list[tuple[int, int, str]]:
    """(start, end, kind) of assign and access, in bytes."""
    out = []
    if b":" in text or b"=" in text:
        out += [(*m.span(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST["assign"]]
    if b"AKIA" in text:
        out += [(*m.span(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    return out


def in_points(text: bytes, places: set[int]) -> dict[int, int]:
    """Code points before each byte position."""
    out, at, n = {}, 0, 0
    for place in sorted(places):
        n += len(text[at:place].decode("utf-8", "replace"))
        at = place
        out[place] = n
    return out


def joined(spans: list[tuple[int, int, str]]) -> str:
    ordered = sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in ordered)


_SPAN = pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("kind", pa.string())])
_CANDIDATE = pa.struct(
    [("start", pa.int64()), ("stop", pa.int64()), ("token", pa.binary()), ("near", pa.binary()), ("code", pa.int64())]
)
_SCANNED = (
    "_id long, base array<struct<start: long, stop: long, kind: string>>, "
    "candidates array<struct<start: long, stop: long, token: binary, near: binary, code: long>>, codes array<binary>"
)


def code_spans(text: bytes) -> list[tuple[int, int]]:
    """Start and end of the sensitive code of a text: lines up to a blank one; key blocks are one with theirs."""
    cuts = [0, *(m.end() for m in BLANK_LINE.finditer(text)), len(text)]
    if b"PRIVATE KEY" in text:
        keys = [m.span() for m in KEY_BLOCK.finditer(text)]
        starts = np.array([a for a, _ in keys], np.int64)
        within = np.searchsorted(starts, cuts, "left") - 1
        cuts = [c for c, i in zip(cuts, within.tolist(), strict=True) if i < 0 or c in (0, len(text)) or c >= keys[i][1]]
    return [(a, b) for a, b in zip(cuts, cuts[1:], strict=False) if SENSITIVE.search(text, a, b)]


def value_spans(unit: bytes) -> list[tuple[int, int]]:
    """Where values with punctuation stand in a string without blanks and quotes."""
    if b"://" in unit:
        return [m.span() for m in _ADDRESS.finditer(unit)]
    a, b = 0, len(unit.rstrip(b",;.)]}>"))
    a = len(unit) - len(unit.lstrip(b"([{<,;"))
    named = _NAME.match(unit, a)
    return [(named.end() if named else a, b)]


def is_mixed(token: bytes) -> bool:
    return bool(re.search(rb"[0-9]", token) and re.search(rb"[A-Za-z]", token) or re.search(rb"[a-z][A-Z].*[a-z][A-Z]", token))


def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Base spans and candidates of each text, in code points."""
    hexes, strings = class_table(rb"0-9a-f"), class_table(rb"A-Za-z0-9+/_=-")
    # ASCII but blanks and quotes: text without blanks between words is no value.
    units = class_table(rb"\x21\x23-\x26\x28-\x5f\x61-\x7e")
    for batch in batches:
        base_rows, candidate_rows, code_rows = [], [], []
        for _, _, data, offsets in rounds(batch.column("_text")):
            n = len(offsets) - 1
            base: list[list] = [[] for _ in range(n)]
            found: list[list] = [[] for _ in range(n)]
            whole = data.tobytes()
            for row, a, b in zip(*(c.tolist() for c in runs(data, offsets, hexes, LEAST["hex"])), strict=True):
                base[row].append((a - int(offsets[row]), b - int(offsets[row]), "hex"))
            for row in range(n):
                base[row] += base_spans(whole[offsets[row] : offsets[row + 1]])
            # Whole strings first: where one is novel, its parts are not judged.
            strong: list[dict] = [{} for _ in range(n)]
            for row, a, b in zip(*(c.tolist() for c in runs(data, offsets, units, CANDIDATE_CHARS)), strict=True):
                for x, y in value_spans(whole[a:b]):
                    if y - x >= CANDIDATE_CHARS and is_mixed(whole[a + x : a + y]):
                        strong[row][a + x, a + y] = None
            for row, a, b in zip(*(c.tolist() for c in runs(data, offsets, strings, CANDIDATE_CHARS)), strict=True):
                if is_mixed(whole[a:b]):
                    strong[row][a, b] = None
            codes: list[list] = [[] for _ in range(n)]
            for row in range(n):
                if not strong[row]:
                    continue
                begin = int(offsets[row])
                text = whole[begin : offsets[row + 1]]
                spans = code_spans(text)
                starts = np.array([a for a, _ in spans], np.int64)
                taken = sorted(s[:2] for s in base[row])
                taken_at = np.array([x for x, _ in taken], np.int64)
                taken_end = np.maximum.accumulate(np.array([y for _, y in taken], np.int64))
                of: dict[int, list] = {}
                for a, b in sorted(strong[row], key=lambda s: (s[0], -s[1])):
                    a, b = a - begin, b - begin
                    i = int(np.searchsorted(starts, a, "right")) - 1
                    k = int(np.searchsorted(taken_at, b, "left")) - 1
                    if i >= 0 and a < spans[i][1] and not (k >= 0 and taken_end[k] > a):
                        of.setdefault(i, []).append((a, b))
                for code, (i, inside) in enumerate(of.items()):
                    at, rest = spans[i][0], []
                    for a, b in inside:
                        token = text[a:b]
                        # A copy of the string that follows it is no surroundings.
                        after = text[b : min(spans[i][1], b + CONTEXT + 3 * len(token))].replace(token, b"")[:CONTEXT]
                        near = after + b" " + text[max(spans[i][0], a - CONTEXT) : a]
                        found[row].append((a, b, token, near, code))
                        rest.append(text[at : max(at, a)])
                        at = max(at, b)
                    codes[row].append(b"\n".join([*rest, text[at : spans[i][1]]]))
            for row in range(n):
                if base[row] or found[row]:
                    text = whole[offsets[row] : offsets[row + 1]]
                    at = in_points(text, {p for s in (*base[row], *found[row]) for p in s[:2]})
                    base[row] = [{"start": at[a], "stop": at[b], "kind": k} for a, b, k in base[row]]
                    found[row] = [{"start": at[a], "stop": at[b], "token": t, "near": c, "code": k} for a, b, t, c, k in found[row]]
            base_rows += base
            candidate_rows += found
            code_rows += codes
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("_id"),
                pa.array(base_rows, pa.list_(_SPAN)),
                pa.array(candidate_rows, pa.list_(_CANDIDATE)),
                pa.array(code_rows, pa.list_(pa.binary())),
            ],
            ["_id", "base", "candidates", "codes"],
        )


def identifier_dictionary(scanned: DataFrame) -> bytes:
    """The identifiers of the code around candidates, the most frequent last."""
    around = scanned.select(F.explode("codes").alias("c")).select(F.decode("c", "ISO-8859-1").alias("text"))
    names = around.select(F.explode(F.regexp_extract_all("text", F.lit(r"[A-Za-z_][A-Za-z0-9_]{2,30}"), 0)).alias("name"))
    top = names.groupBy("name").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "name").limit(DICTIONARY_NAMES)
    listed = [r.name for r in top.collect()]
    text = b"\n".join(name.encode("latin-1") for name in reversed(listed))
    return text[-DICTIONARY_BYTES:]


def packer_of(text: bytes) -> zstandard.ZstdCompressor:
    """A compressor that knows a text."""
    options = zstandard.ZstdCompressionParameters.from_level(LEVEL, write_content_size=0, write_checksum=0, write_dict_id=0)
    known = zstandard.ZstdCompressionDict(text, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if len(text) > 8 else None
    return zstandard.ZstdCompressor(compression_params=options, dict_data=known)


def novel_spans(candidates: list[dict], codes: list[bytes], names: bytes, novelty: float) -> list[tuple[int, int, str]]:
    """The candidates that are new to their code; a string's second and later places there are not."""
    out: list[tuple[int, int, str]] = []
    packer, code, end = None, -1, -1
    known: set[bytes] = set()
    for c in candidates:
        if c["code"] != code:
            code, known = c["code"], set()
            packer = packer_of(names + b"\n" + codes[code])
        token = c["token"]
        if c["start"] < end or token in known:
            continue
        known.add(token)
        if len(packer.compress(c["near"] + token)) - len(packer.compress(c["near"])) >= novelty * len(token):
            out.append((c["start"], c["stop"], "novel"))
            end = c["stop"]
    return out


def find_secrets(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", novelty: float = NOVELTY) -> DataFrame:
    """One row per input row: id, n_assign, n_access, n_hex, n_novel, base_sha256, spans.

    Spans are kind:start:end in code points of the whole text, end exclusive; an assign span is the
    whole match, keyword and all. Null and empty texts have none. Candidates that touch a base span
    are not reported twice, nor is a string that its code repeats. Repeated rows are scanned each; an empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    path = fresh_path(spark, "secrets")
    rows.mapInArrow(scan, _SCANNED).write.parquet(path)
    scanned = spark.read.parquet(path)
    primed = spark.sparkContext.broadcast(identifier_dictionary(scanned))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                base = [(s["start"], s["stop"], s["kind"]) for s in row["base"]]
                novel = novel_spans(row["candidates"], row["codes"], primed.value, novelty)
                counts = [sum(k == kind for _, _, k in base) for kind in KINDS[:3]]
                digest = hashlib.sha256(joined(base).encode()).hexdigest()
                out.append((row["_id"], *counts, len(novel), digest, joined(base + novel)))
            columns = list(zip(*out, strict=True)) or [[]] * 7
            kinds = (pa.int64(),) * 5 + (pa.string(),) * 2
            names = [id_col, "n_assign", "n_access", "n_hex", "n_novel", "base_sha256", "spans"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    return scanned.mapInArrow(
        judge, f"`{id_col}` long, n_assign long, n_access long, n_hex long, n_novel long, base_sha256 string, spans string"
    )
