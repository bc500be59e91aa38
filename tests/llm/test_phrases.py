import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyspark.sql.functions as F
import pytest
import sentencepiece

from terrafold.llm import arrays, collocations, piece_agenda, queries, run_links
from tests.llm import plain

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def frame(spark, rows, schema="doc_id long, text string"):
    clashing = ("_id", "_text", "_lang", "_loop", "ids", "runs", "n", "words", "phrase", "rank")
    return spark.createDataFrame(rows, schema).selectExpr("*", *[f"{i} AS {c}" for i, c in enumerate(clashing)])


# ---------------------------------------------------------------- runs of words


def numbered(words):
    return arrays.mixed(np.array(words, np.uint64))


def repetitive(rng):
    words, letters = [], rng.choice([1, 2, 3, 50])
    for _ in range(rng.randint(0, 12)):
        words += [rng.randint(0, letters) for _ in range(rng.randint(1, 20))] * rng.choice([1, 1, 2, 3, 4, 9])
    return words[: rng.randint(0, len(words))]


def test_runs_are_those_of_every_period():
    rng, found = random.Random(5), 0
    for _ in range(800):
        words = repetitive(rng)
        want = plain.runs(words)
        assert run_links.word_runs(numbered(words)) == want
        found += len(want)
    assert found > 300


def test_automaton_finds_every_square_run():
    rng = random.Random(6)
    for _ in range(150):
        words = repetitive(rng)[:70]
        got = {(start, last - start + 1, q) for (start, q), last in run_links.repetitions(words, 2, 2).items()}
        assert got == set(plain.runs(words, 2, 2))


def test_stretches_hold_runs_whole():
    rng = random.Random(7)
    for _ in range(400):
        words = [rng.randint(100, 999) for _ in range(30)] + repetitive(rng) + [7] * rng.randint(0, 30) + [rng.randint(100, 999) for _ in range(30)]
        ranges = run_links.stretches(numbered(words))
        assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:], strict=False))
        for start, length, _ in plain.runs(words):
            assert sum(a <= start and start + length <= b for a, b in ranges) == 1


RUN_TEXTS = [
    (1, "ha " * 24), (2, "ha " * 23), (3, None), (4, ""), (5, " \n"), (None, "one two three " * 9), (None, "one two three " * 9),
    (6, "x " + "a b " * 40 + "c d e " * 40 + "a b " * 40), (7, " ".join(map(str, range(3000))) + " é ü" * 5000), (8, "a b c d " * 6 + "a"),
    (9, "a b a a b " * 7), (10, "w " * 20 + "v " * 30),
]


def plain_run_row(key, text):
    words = plain.SPACED.findall(text or "")
    number = zlib.crc32(("" if key is None else str(key)).encode())
    words = plain.looped(words, number)
    runs = plain.runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None,) * 3)
    digest = hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    exponent = 1000 * best[1] // best[2] if runs else None
    return (key, len(runs), *best, exponent, digest, hashlib.sha256(kept.encode()).hexdigest())


def test_runs_of_edge_cases(spark, tmp_path):
    keys = [k for k in range(2000) if zlib.crc32(str(k).encode()) % 10 == 0][:12]
    rng = random.Random(8)
    rows = RUN_TEXTS + [(k, " ".join(str(rng.randint(0, 99)) for _ in range(rng.choice([0, 1, 7, 60, 400])))) for k in keys]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in queries.op11_link_cut_runs(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted((plain_run_row(*r) for r in rows), key=str)
    assert sum(r[1] > 0 for r in got) >= 8
    assert run_links.runs_of_words(frame(spark, rows).limit(0)).count() == 0


def test_runs_without_loops(spark):
    got = run_links.runs_of_words(frame(spark, [(1, "é b c " * 9 + "d"), (2, "x")])).orderBy("doc_id").collect()
    assert got[0].runs == [got[0].best] and tuple(got[0].best) == (0, 27, 3) and got[0].collapsed == "é b c d"
    assert got[1].runs == [] and got[1].best is None and got[1].collapsed == "x"


# ---------------------------------------------------------------- collocations


def phrase_rows(rows, **options):
    return sorted(plain.collocations(rows, **options))


def found_rows(found):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in found.collect())


def test_collocations_of_edge_cases(spark):
    rng = random.Random(2)
    words = ["new", "york", "city", "É", "the", "of", "x-y"]
    rows = [(i, rng.choice(["en", "fr", None, "und", "a b"]), " ".join(rng.choices(words, k=rng.randint(0, 60)))) for i in range(120)]
    rows += [(1, "en", "New\tYork  CITY. new york;new\x0bYork! " * 30), (1, "en", "city"), (None, "en", "york city"), (2, "en", ""), (3, "en", None)]
    rows += [(4, "zz", None), (5, "en", "same words " * 4000), (6, "de", "ab cd. " * 10), (7, "de", "ef"), (7, "de", "gh")]
    docs = frame(spark, rows, "doc_id long, lang string, text string")
    for options in ({}, {"least": 3, "share": 90}, {"top": 2}):
        assert found_rows(collocations.collocations(docs, **options)) == phrase_rows(rows, **options)
    assert collocations.collocations(docs.limit(0)).count() == 0


def test_phrases_spread_over_buckets(spark, sf, monkeypatch):
    # Buckets of a few suffixes, with too few slots for them: all depths of routing occur.
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(60)
    want = phrase_rows([(r.doc_id, r.lang, r.text) for r in docs.collect()], least=4)

    def counts(**options):
        found, _ = collocations.phrase_counts(docs, 4, text_col="text", lang_col="lang", **options)
        return sorted(map(tuple, found.collect()))

    assert len(counts()) > 100 and counts(slot_bits=4, bucket=1500) == counts(slot_bits=8, bucket=400) == counts()
    monkeypatch.setattr(collocations, "CHUNK", 1000)
    assert found_rows(collocations.collocations(docs, least=4)) == want


def test_equal_partitions_are_counts():
    rng = np.random.default_rng(3)
    for least in (1, 4):
        keys = rng.integers(0, 5, (3, 300)).astype(np.int32)
        keys[2][keys[1] == 0] = 0
        keys = keys[:, keys[0] > 0]
        weights = rng.integers(1, 4, keys.shape[1])
        depth = np.where(keys[0] == 3, 2, 1) + ((keys[0] == 3) & (keys[1] == 2))
        want, reach = Counter(), {}
        for i, suffix in enumerate(keys.T.tolist()):
            for n in range(1, 4):
                if 0 not in suffix[:n]:
                    want[tuple(suffix[:n])] += int(weights[i])
                    reach[tuple(suffix[:n])] = depth[i]
        got = {}
        for n, pointers, sums in collocations.equal_partitions(keys, weights, depth, least):
            got.update({tuple(keys[:n, p].tolist()): int(s) for p, s in zip(pointers, sums, strict=True)})
        assert got == {p: n for p, n in want.items() if n >= least or reach[p] > len(p)}


# ---------------------------------------------------------------- pieces


@pytest.fixture(scope="module")
def vocabulary():
    with open(MODEL, "rb") as file:
        return piece_agenda.Vocabulary(file.read())


ODD_TEXTS = [
    None, "", " ", "  a  b ", "ﬁ Ａ\t\n x", "a​b", "▁a ▁▁", "a\x00b", "<s>a</s><unk> <0x41>", "ha…\r\n", "日本語テキスト" * 50, " " * 100, "a" * 5000,
    "x" * 25 + " " + "ab" * 13, "🙂 👩‍👩‍👧 \U0010ffff", "same", "same",
]


def test_ids_are_the_librarys(spark):
    rng = random.Random(1)
    texts = ODD_TEXTS + ["".join(rng.choice("abcdefgh \n▁éﬁ日.") for _ in range(rng.randint(1, 300))) for _ in range(200)]
    rows = list(enumerate(texts)) + [(None, "null id"), (3, "twice"), (9, "long text " * 30000)]
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = {(r.doc_id, r.decoded): r.ids for r in piece_agenda.tokenize(frame(spark, rows), MODEL).collect()}
    want = {(k, library.decode(library.encode(t or ""))): library.encode(t or "") for k, t in rows}
    assert got == want
    assert piece_agenda.tokenize(frame(spark, rows).limit(0), MODEL).count() == 0


def test_pieces_of_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    got = queries.op13_piece_agenda(spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r.doc_id])
        digests = (hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), library.decode(ids)))
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), *digests)


def test_both_agendas_agree(vocabulary):
    rng = random.Random(4)
    for _ in range(300):
        text = "▁" + "".join(rng.choice("abcdehinorst日é") for _ in range(rng.randint(0, 40)))
        symbols = vocabulary.of_char[[ord(c) for c in text]]
        final, places = piece_agenda.agenda(vocabulary, symbols.tolist())
        together = piece_agenda.agendas(vocabulary, symbols.copy(), np.array([len(text)]))
        assert [x.tolist() for x in together[:2]] == [final, places] and together[2].tolist() == [len(final)]


def test_a_difference_is_an_error(vocabulary):
    units = pa.array([b" the", b" cat"], pa.large_binary())
    ids, first = piece_agenda.unit_ids(vocabulary, units)
    piece_agenda.agree(vocabulary, units, ids, first)
    with pytest.raises(ValueError):
        piece_agenda.agree(vocabulary, units, ids + 1, first)


def test_other_models_are_refused(vocabulary, monkeypatch):
    monkeypatch.setattr(sentencepiece.SentencePieceProcessor, "is_unused", lambda self, i: i == 500)
    with open(MODEL, "rb") as file, pytest.raises(ValueError):
        piece_agenda.Vocabulary(file.read())


def test_whole_texts_are_checked(spark):
    docs = spark.createDataFrame([(1, "whole  texts agree"), (2, None)], "doc_id long, text string")
    got = piece_agenda.tokenize(docs, MODEL, check="texts").orderBy("doc_id").collect()
    assert got[0].decoded == "whole  texts agree" and got[1].ids == [] and got[1].decoded == ""
    assert got[0].ids == piece_agenda.tokenize(docs, MODEL, check="").filter(F.col("doc_id") == 1).first().ids
