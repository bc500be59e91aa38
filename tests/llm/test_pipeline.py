import random

import pyspark.sql.functions as F

import __spark_entry__ as contract
import corpus_pipeline
from terrafold.llm import cross_parse
from tests.llm import plain


def test_pipeline_equals_its_stages_in_plain_python(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    rows = [(k, t) for k, t in rows if t and any(c.isalpha() for c in t)]
    kept = {k for k, top, _, _ in plain.exact(rows) if k == top}
    rows = [(k, t) for k, t in rows if k in kept]
    kept = {k for k, _, least in plain.components(rows) if k == least}
    rows = [(k, t) for k, t in rows if k in kept]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    kept = {r[0] for r in plain.contaminated(rows, items) if not r[5]}
    rows = [(k, t) for k, t in rows if k in kept]
    got = corpus_pipeline.run(spark, sf)
    assert {"doc_id", "text", "taken"} <= set(got.columns)
    found = {r.doc_id: r.taken for r in got.collect()}
    sizes = {k: len(plain.SPACED.findall(t)) for k, t in rows}
    assert set(found) <= set(sizes) and all(0 < n <= 2 * sizes[k] for k, n in found.items())
    assert abs(sum(found.values()) - 1.5 * sum(sizes.values())) < 30


def test_stages_keep_the_columns(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(40)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf).columns == docs.columns


CLASHING = ["_digest_here", "_id", "_key", "_text_key", "_mix_id", "_kept", "_text", "size", "target", "score", "held_out"]


def test_stages_of_edge_cases(spark, sf):
    text = "The cat sat on the mat and then it ran to the house of the old man"
    rows = [(1, text, "en"), (1, text, "en"), (None, text.upper(), "en"), (2, None, "en"), (3, "", None), (4, "12 3", "fr"), (None, "a b", None)]
    rows += [(5, "und dann ging er in das Haus der alten Frau " * 3000, "de"), (6, text + " again", "en"), (7, "\n", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("source", F.col("lang"))
    docs = docs.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHING)])
    want = {
        "language_id": [1, 1, 5, 6, None, None], "exact_dedup": [1, 3, 4, 5, 6, 7, None], "near_duplicates": [1, 1, 2, 3, 4, 5, 7, None, None],
        "decontamination": [1, 1, 2, 3, 4, 5, 6, 7, None, None],
    }
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, sf)
        if name in want:
            assert got.columns == docs.columns
            assert sorted((r.doc_id for r in got.collect()), key=str) == sorted(want[name], key=str), name
        else:
            found = got.collect()
            assert set(got.columns) == {*docs.columns, "taken"} and all(r.taken > 0 and r.text for r in found)
            assert {r["_key"] for r in found} == {CLASHING.index("_key")}


def test_texts_in_no_language_go(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    rng = random.Random(5)
    noise = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(400)), "слово и дело " * 30, "q" * 900]
    noisy = docs.unionByName(spark.createDataFrame([(-i, t, None) for i, t in enumerate(noise, 1)], "doc_id long, text string, lang string"))
    kept = {r.doc_id for r in cross_parse.in_a_language(noisy).select("doc_id").collect()}
    want = {r.doc_id for r in docs.collect() if r.text and any(c.isalpha() for c in r.text)}
    assert want <= kept and not kept & {-1, -2}


def test_stages_take_empty_tables(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf).count() == 0


def test_every_operator_is_registered():
    names = contract.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names
    assert {"op2_zip_archives", "op5_source_mix", "op6_cuckoo_dedup", "op11_link_cut_runs", "op12_multikey_collocations"} <= set(contract.oracle_sql())
