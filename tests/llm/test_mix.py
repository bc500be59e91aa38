import pytest
from pyspark.sql import functions as F

from terrafold.llm import mixing
from tests.llm.plain import SPACED


def water(sizes, weights=(5, 2, 1), budget=1.5, limit=2.0):
    """Targets by resharing until no source is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    share = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    fixed, left = {}, budget * sum(sizes.values())
    while True:
        free = [n for n in names if n not in fixed]
        total = sum(share[n] for n in free)
        over = [n for n in free if left * share[n] / total > limit * sizes[n]]
        if not over:
            return fixed | {n: left * share[n] / total for n in free}
        for n in over:
            fixed[n] = limit * sizes[n]
        left = budget * sum(sizes.values()) - sum(fixed.values())


def checked(docs, rows, **options):
    got = mixing.mix(docs, **options).collect()
    assert len(got) == len(rows)
    sizes, taken = {}, {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(SPACED.findall(text or ""))
    want = water(sizes)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 2 * r.size and r.taken >= r.size * int(r.target // max(1, r.source_size))
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert taken == {s: int(t + 1e-6) for s, t in want.items()}
    return got


def test_documents_meet_their_targets(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    quality = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    first = checked(docs, rows, quality=quality, bucket_rows=20)
    again = mixing.mix(docs.repartition(7), quality, bucket_rows=20).collect()
    assert sorted(map(tuple, first)) == sorted(map(tuple, again))


def test_buckets_do_not_change_the_mix(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    runs = [sorted(map(tuple, mixing.mix(docs, bucket_rows=n).collect())) for n in (5, 100_000)]
    assert runs[0] == runs[1]


def test_mix_of_edge_cases(spark):
    rows = [(1, "a b c", "x"), (1, "a b c", "x"), (None, "d e", None), (2, None, "x"), (3, "", "empty"), (4, "w " * 5000, "é"), (5, "q", "z"), (6, "r s", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 AS _size", "2 AS taken", "3 AS size")
    checked(docs, rows)
    assert mixing.mix(docs.limit(0)).count() == 0
    kept = mixing.mixed_documents(docs)
    assert kept.filter("taken <= 0").count() == 0 and "text" in kept.columns
    assert kept.agg(F.sum("taken")).first()[0] == sum(r.taken for r in mixing.mix(docs).collect())


def test_better_documents_are_drawn_first(spark):
    rows = [(i, "w " * 10, "big") for i in range(2000)] + [(9999, "v " * 40_000, "other")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    quality = spark.createDataFrame([(i, i % 2) for i in range(2000)], "doc_id long, quality int")
    got = mixing.mix(docs, quality, weights=(1, 5)).filter("source = 'big'").collect()
    extra = [[r.taken - r.size * int(r.target // r.source_size) for r in got if r.doc_id % 2 == q] for q in (0, 1)]
    assert sum(extra[1]) > 1.5 * sum(extra[0])


def test_no_python_in_the_plan(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    plan = mixing.mix(docs)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
