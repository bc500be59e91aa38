"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame functions only.

Every document draws the key ``-ln(u) / w``: u from its id, w its quality weight. Within a source
documents come in the order of their keys. A source's target is met by complete epochs first; what
is left of it goes to the documents whose prefix sum fits, the last one in part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import fresh_path

#: Relative weights of sources in the order of their names, repeated.
WEIGHTS = (5, 2, 1)
#: All targets together, as a multiple of all sizes; and a source's own limit.
BUDGET, LIMIT = 1.5, 2.0
#: Draw weights by label: good, bad, none.
QUALITY = (2.0, 0.5, 1.0)
#: Documents of one bucket of keys, on average.
BUCKET_ROWS = 4096
SEED = "mix-1"
_WORD = r"[^\x20\x09-\x0D]++"


def word_count(text: Column) -> Column:
    """Words between blanks; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def uniform(key: Column, seed: str) -> Column:
    """A number in (0, 1) that depends on the id alone."""
    digits = F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(key.cast("string"), F.lit("")))), 1, 12)
    return (F.conv(digits, 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 48))


def source_targets(sizes: DataFrame, weights: Sequence[int], budget: float, limit: float) -> DataFrame:
    """(_source, _none, _source_size, _target) from one row per source.

    The targets are min(limit * size, level * weight). The level is where they add up to the
    budget: capping sources and sharing their excess again and again ends there.
    """
    names = Window.orderBy("_none", "_source")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sizes.withColumn("_weight", F.element_at(cycle, (F.row_number().over(names) - 1) % len(weights) + 1))
    fill = F.col("_source_size") * F.lit(limit) / F.col("_weight")
    by_fill = Window.orderBy(fill, "_none", "_source")
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    after = by_fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    capped = F.coalesce(F.sum("_source_size").over(before), F.lit(0)) * F.lit(limit)
    # Level if exactly the sources before this one are capped; right for the first that stays below its cap.
    level = (F.lit(budget) * F.sum("_source_size").over(whole) - capped) / F.sum("_weight").over(after)
    levels = ranked.withColumn("_fill", fill).withColumn("_level", level)
    chosen = F.min(F.when(F.col("_level") <= F.col("_fill"), F.struct("_fill", "_level"))).over(whole)
    share = F.coalesce(F.col("_weight") * chosen["_level"], F.col("_source_size") * F.lit(limit))
    return levels.select(
        "_source", "_none", "_source_size", F.least(F.col("_source_size") * F.lit(limit), share).alias("_target")
    )


def free_name(df: DataFrame, name: str) -> str:
    """The name, with as many underscores before it as it takes to be no column of a table."""
    while name in df.columns:
        name = f"_{name}"
    return name


def mix(
    docs: DataFrame,
    quality: DataFrame | None = None,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    budget: float = BUDGET,
    limit: float = LIMIT,
    quality_weights: tuple[float, float, float] = QUALITY,
    bucket_rows: int = BUCKET_ROWS,
    seed: str = SEED,
) -> DataFrame:
    """One row per document: id, source, size, source_size, target, taken, text_key.

    ``quality`` holds (id, quality 0 or 1); without it all documents weigh the same. Several labels
    of one id count as the best one. A null text has size 0, a null source is a source of its own
    that comes last, null ids draw one common number. Equal keys are settled by id, then size, then
    text; rows that are equal in all of these may change places, which alters no result. No rows
    give no rows.
    """
    rows = docs.select(
        F.col(id_col).alias("_id"),
        F.coalesce(source_col, F.lit("")).alias("_source"),
        F.col(source_col).isNull().alias("_none"),
        word_count(F.col(text_col)).alias("_size"),
        F.xxhash64(F.col(text_col)).alias("_text_key"),
    )
    good, bad, other = (F.lit(w) for w in quality_weights)
    if quality is None:
        rows = rows.withColumn("_w", other)
    else:
        best = quality.groupBy(F.col(id_col).alias("_id")).agg(F.max("quality").alias("_quality"))
        rows = rows.join(best, "_id", "left")
        rows = rows.withColumn("_w", F.when(F.col("_quality") >= 1, good).when(F.col("_quality") < 1, bad).otherwise(other))
    rows = rows.withColumn("_key", -F.ln(uniform(F.col("_id"), seed)) / F.col("_w"))
    path = fresh_path(docs.sparkSession, "mix")
    # The texts are read once; all that follows works on these few numbers.
    rows.select("_id", "_source", "_none", "_size", "_text_key", "_key").write.parquet(path)
    rows = docs.sparkSession.read.parquet(path)
    buckets = max(1, -(-rows.count() // bucket_rows))
    place = F.least(F.floor((1 - F.exp(-F.col("_key"))) * buckets), F.lit(buckets - 1)).cast("long")
    rows = rows.withColumn("_bucket", place)

    parts = rows.groupBy("_source", "_none", "_bucket").agg(F.sum("_size").alias("_sum"))
    totals = parts.groupBy("_source", "_none").agg(F.sum("_sum").alias("_source_size"))
    targets = source_targets(totals, weights, budget, limit)
    lower = Window.partitionBy("_source", "_none").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_below", F.coalesce(F.sum("_sum").over(lower), F.lit(0)))
    parts = parts.join(targets, ["_source", "_none"]).drop("_sum")

    inside = Window.partitionBy("_source", "_none", "_bucket").orderBy("_key", "_id", "_size", "_text_key")
    prefix = F.coalesce(F.sum("_size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = rows.withColumn("_prefix", prefix).join(parts, ["_source", "_none", "_bucket"])
    epochs = F.when(F.col("_source_size") > 0, F.floor(F.col("_target") / F.col("_source_size"))).otherwise(0)
    rest = F.floor(F.col("_target")).cast("long") - epochs * F.col("_source_size")
    part = F.least("_size", F.greatest(F.lit(0).cast("long"), rest - F.col("_below") - F.col("_prefix")))
    return placed.select(
        F.col("_id").alias(id_col),
        F.when(~F.col("_none"), F.col("_source")).alias(source_col),
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (epochs * F.col("_size") + part).cast("long").alias("taken"),
        F.col("_text_key").alias("text_key"),
    )


def mixed_documents(docs: DataFrame, quality: DataFrame | None = None, **options) -> DataFrame:
    """The rows of ``docs`` the mix takes words of, with size, target and taken beside their columns.

    A column of ``docs`` with one of those names gives way, all others stay. Rows that share id and text come out as
    one row with all their words. Null ids share one draw; null and empty texts have no words, so they are not in the
    mix. No rows give no rows.
    """
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    plan = mix(docs, quality, **options).filter("taken > 0")
    own, key, text_key = (free_name(docs, n) for n in ("_mix_id", "_mix_key", "_text_key"))
    plan = plan.groupBy(F.col(id_col).alias(own), F.col("text_key").alias(key), "size", "target").agg(
        F.sum("taken").alias("taken")
    )
    rows = docs.drop("size", "target", "taken").withColumn(text_key, F.xxhash64(text_col))
    hit = rows[id_col].eqNullSafe(plan[own]) & (rows[text_key] == plan[key])
    return rows.join(plan, hit).dropDuplicates([id_col, text_key]).drop(own, key, text_key)
