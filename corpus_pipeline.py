"""From raw documents to a training mix: five stages, each one operator over all rows it gets.

Every stage takes tables of any length, empty ones included, whole texts of any length, and further columns of any name;
all but the last return the columns they got.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from terrafold.llm import cross_parse, cuckoo, decontaminate, mixing, prefix_tree
from terrafold.sources.shared import fresh_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no learned language go: without a letter, or explained by none better than by single letters.

    Learned from the rows of ``docs`` outside the held-out fold that have a language; others stay whatever their
    label says. Null texts go; repeated rows and null ids are judged each; a table without labels keeps nothing.
    """
    return cross_parse.in_a_language(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z lower-cased, null as empty) the row with the largest doc_id stays, a null id being the smallest.

    Of rows that repeat text and id one stays.
    """
    return cuckoo.keep_one(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of similar texts, the row with the smallest doc_id stays.

    Rows without id stay, as do texts without words, which are similar to nothing; rows that repeat the
    smallest id stay together.
    """
    return prefix_tree.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with too many words under benchmark windows go; null and empty texts have none.

    Rows are told apart by id and text. Without benchmark items all stay.
    """
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix takes words of, with size, target and taken in place of columns so called.

    Rows that share id and text become one with all their words; texts without words are not in the mix. Null
    sources are one source, labels of one id count as the best of them.
    """
    quality = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return mixing.mixed_documents(docs, quality)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
]

#: Language models and set joins have no SQL; the tests hold the run against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
