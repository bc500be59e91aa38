import random

import pytest

from terrafold.llm import cuckoo, prefix_tree, run_index
from tests.llm import plain


def texts(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return docs, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def frame(spark, rows, extra=""):
    """Documents with columns whose names the operators use inside."""
    made = spark.createDataFrame(rows, "doc_id long, text string")
    return made.selectExpr("*", "1 AS _id", "'x' AS fp", "2 AS n", "3L AS block", "'y' AS _digest", "4 AS size")


EDGES = [(1, "Aé b"), (1, "aé b"), (None, None), (2, ""), (None, ""), (3, "x"), (3, "x"), (7, "X"), (8, "é"), (9, "É")]


def exact_rows(df):
    found = df.collect()
    got = sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found), key=str)
    return got, found


def test_exact_groups_of_documents(spark, sf):
    docs, rows = texts(spark, sf)
    got, found = exact_rows(cuckoo.exact_groups(docs))
    assert got == plain.exact(rows)
    assert all(r.kept == (r.doc_id == r.keep_id) for r in found)


def test_exact_groups_of_edge_cases(spark):
    docs = frame(spark, EDGES)
    got, found = exact_rows(cuckoo.exact_groups(docs))
    assert got == plain.exact(EDGES)
    # Exactly one row of each text is kept, also among repeated rows.
    assert sum(r.kept for r in found) == len({r.text_sha256 for r in found})
    assert cuckoo.exact_groups(docs.limit(0)).count() == 0
    kept = cuckoo.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len({r.text_sha256 for r in found})


def test_cuckoo_shard_inserts_deletes_and_grows():
    rng = random.Random(1)
    shard, known = cuckoo.CuckooShard(2), {}
    keys = [rng.randbytes(32) for _ in range(3000)]
    for i, key in enumerate(keys):
        shard.insert(key, [i])
        known[key] = [i]
        if i % 3 == 0:
            gone = rng.choice(list(known)) if i % 30 == 0 else key
            assert shard.delete(gone) == known.pop(gone)
    assert shard.resizes and shard.size == len(known)
    assert dict(shard.items()) == known
    assert all((shard.find(k) is not None) == (k in known) for k in keys)
    # Same fingerprint and buckets, another key: no hit.
    key = next(iter(known))
    assert shard.find(key[:10] + bytes(22)) is None and shard.delete(key[:10] + bytes(22)) is None


def test_index_updates(spark):
    index = cuckoo.live_index(cuckoo.digest_rows(frame(spark, [(1, "a"), (2, "b"), (3, "c"), (4, "b")])))
    added = cuckoo.live_index(cuckoo.digest_rows(frame(spark, [(9, "a"), (8, "d"), (0, "b")])))
    removed = cuckoo.digest_rows(frame(spark, [(0, "b"), (0, "c")])).select("_digest")
    got = {(r["_keep"], r["_n"]) for r in cuckoo.updated_index(index, added, removed).collect()}
    assert got == {(9, 2), (8, 1), (0, 1)}


def repeat_rows(df):
    import hashlib

    return sorted(
        ((r.doc_id, r.n_bytes, r.n_bytes - len(r.kept), len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in df.collect()),
        key=str,
    )


def test_repeats_of_documents(spark, sf):
    docs, rows = texts(spark, sf)
    assert repeat_rows(run_index.without_repeats(docs)) == plain.repeats(rows)


def test_repeats_of_edge_cases(spark):
    rng = random.Random(1)
    base = "".join(rng.choice("abcde é") for _ in range(400))
    rows = [(5, base), (3, base[:100] + "XX" + base[100:220]), (9, base[50:99]), (8, base[49:100]), (1, None), (2, "")]
    rows += [(None, base[200:300]), (7, "ab" * 100), (6, "ab" * 60), (5, base), (4, "x" * 49), (10, "x" * 4000), (11, "x" * 60)]
    docs = frame(spark, rows)
    assert repeat_rows(run_index.without_repeats(docs)) == plain.repeats(rows)
    assert run_index.without_repeats(docs.limit(0)).count() == 0


def test_run_index_counts_like_a_search():
    rng = random.Random(5)
    body = [bytes(rng.choice(b"ab") for _ in range(rng.randint(50, 90))) for _ in range(20)]
    body += [body[3][:60] + b"zz" + body[4], body[0]]
    found = run_index.RunIndex(body).statistics(body)
    for text, hits in zip(body, found, strict=True):
        for at, hit in enumerate(hits.tolist()):
            assert hit == next(i for i, t in enumerate(body) if text[at : at + 50] in t)


def test_runs_stay_few_for_copies():
    rng = random.Random(2)
    text = bytes(rng.choice(b"abcdefgh") for _ in range(3000))
    one, many = run_index.RunIndex([text]).runs, run_index.RunIndex([text] * 20).runs
    assert many <= one + 60 * 20


def test_run_index_finds_strings_of_other_texts():
    rng = random.Random(6)
    body = [bytes(rng.choice(b"abc\0\xff") for _ in range(rng.randint(50, 400))) for _ in range(20)]
    # A match that a byte ends is taken up again where it may still lead somewhere.
    others = [b"z" + body[2][:70] + b"zz" + body[5][20:180] + body[7][:60], b"", b"a" * 49, b"z" * 60, body[1] + body[2], body[9][1:]]
    others += [body[4][:50], (b"z" + body[6][10:62]) * 9]
    found = run_index.RunIndex(body).statistics(others)
    for text, hits in zip(others, found, strict=True):
        assert hits.tolist() == [next((i for i, t in enumerate(body) if text[at : at + 50] in t), -1) for at in range(len(text) - 49)]
    assert run_index.RunIndex(body).statistics([]) == []


def test_run_index_streams_pieces_side_by_side(monkeypatch):
    # One long text among many usual ones takes no steps of its own, and few bytes are searched for among all runs.
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(500)]
    body = [" ".join(rng.choices(words, k=12)).encode()[:rng.randint(50, 76)] for _ in range(300)]
    body.append(" ".join(rng.choices(words, k=1000)).encode())
    index = run_index.RunIndex(body)
    searched, searchsorted = [], run_index.np.searchsorted
    monkeypatch.setattr(run_index.np, "searchsorted", lambda a, v, *more: searched.append(run_index.np.size(v)) or searchsorted(a, v, *more))
    index.statistics(body)
    assert len(searched) < 3 * (2 * 128 + 50) and sum(searched) < sum(map(len, body)) / 2


def near_rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_components_of_documents(spark, sf):
    docs, rows = texts(spark, sf)
    assert near_rows(prefix_tree.jaccard_components(docs)) == plain.components(rows)


@pytest.fixture
def variants():
    rng = random.Random(3)
    out, key = [], 100
    for _ in range(6):
        words = [f"w{rng.randint(0, 400)}" for _ in range(rng.choice([12, 40, 90]))]
        for _ in range(25):
            own = list(words)
            for _ in range(rng.randint(0, max(1, len(own) // 25))):
                own[rng.randrange(len(own))] = f"v{rng.randint(0, 9999)}"
            out.append((key, " ".join(own)))
            key += 1
    base = [f"b{i}" for i in range(60)]
    out += [(5, " ".join(base)), (3, " ".join(base).upper()), (9, " ".join(base[:58])), (1, " ".join(base[2:]))]
    return out + [(7, "a b"), (8, "a  b"), (None, "a b"), (2, None), (4, ""), (6, " \n"), (None, "zz"), (5, " ".join(base))]


def test_components_of_variants(spark, variants):
    docs = frame(spark, variants)
    assert near_rows(prefix_tree.jaccard_components(docs)) == plain.components(variants)
    assert prefix_tree.jaccard_components(docs.limit(0)).count() == 0


def test_components_block_by_block(spark, variants, monkeypatch):
    # Every neighbourhood is cut into many blocks.
    monkeypatch.setattr(prefix_tree, "BLOCK_SETS", 3)
    assert near_rows(prefix_tree.jaccard_components(frame(spark, variants))) == plain.components(variants)


def test_one_of_each_component(spark, variants):
    kept = prefix_tree.one_of_each(frame(spark, variants))
    want = [k for k, _, least in plain.components(variants) if k is None or k == least]
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(want, key=str)
