"""Mixing sources to target weights by repetition rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import materialize
from .common import WORD, free_prefix, ranked, read

#: No source is repeated more often than this on average, so no document is taken more often than this.
MAX_REPEAT = 3
WEIGHTS = (1, 2, 3)
SEED = "mix-1"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """Target size of each source: columns source, source_size, weight, target.

    sizes has columns source and size, one row per document. Sources in order of code points, null last, take the
    weights in turn. They share the whole size by weight; a target stops at max_repeat times the source's size and the
    excess is shared again by weight. Null is a source of its own; a source of size 0 has target 0; an empty table
    gives no rows.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    n = len(weights)
    cycle = F.array(*map(F.lit, weights))
    sources = ranked(totals, F.col("source").asc_nulls_last()).withColumn("weight", F.element_at(cycle, (F.col("rank") % n + 1).cast("int")).cast("long"))
    sources = materialize(sources.drop("rank").withColumn("cap", F.col("source_size") * max_repeat), "sources")
    whole = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("t"), F.coalesce(F.sum("weight"), F.lit(1)).alias("w")).first()
    rest, weight, capped = whole["t"], whole["w"], F.lit(False)
    while True:  # a few rounds: each one caps at least one more source, or is the last
        above = F.col("cap") * weight < F.col("weight") * rest
        now = sources.where(above).agg(F.coalesce(F.sum("cap"), F.lit(0)).alias("c"), F.coalesce(F.sum("weight"), F.lit(0)).alias("w")).first()
        capped = above
        if (whole["t"] - now["c"], whole["w"] - now["w"]) == (rest, weight) or whole["w"] == now["w"]:
            break
        rest, weight = whole["t"] - now["c"], whole["w"] - now["w"]
    share = (F.col("weight") * rest).cast("double") / F.lit(float(weight))
    return sources.select("source", "source_size", "weight", F.when(capped, F.col("cap").cast("double")).otherwise(share).alias("target"))


def unit_hash(key: Column, seed: str) -> Column:
    """A number in [0, 1) from the first 32 bits of an MD5, the same on every run and in every engine."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))), 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))


def mix_rates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = WEIGHTS, seed: str = SEED, prefix: str = "_") -> DataFrame:
    """Each row of docs with _size, _source_size, _target and _copies, the number of times that the mix takes it.

    A document comes floor(rate) times for its source's rate = target / size, and once more if its hash is below the
    fraction. Null and empty texts have size 0; rows that repeat a doc_id share its draw; a null doc_id draws as an
    empty string. Other columns pass through; docs has none whose name begins with prefix, the new columns' first part.
    """
    size, source_size, target, copies, name, per = (f"{prefix}{x}" for x in ("size", "source_size", "target", "copies", "source", "rate"))
    sized = docs.withColumn(size, word_count(F.col(text)))
    targets = source_targets(sized.select(F.col(source).alias("source"), F.col(size).alias("size")), weights)
    targets = targets.select(F.col("source").alias(name), F.col("source_size").alias(source_size), F.col("target").alias(target))
    rate = F.coalesce(F.try_divide(F.col(target), F.col(source_size).cast("double")), F.lit(0.0))
    # a handful of rows against all documents: Spark broadcasts the sources where their measured size allows it
    rows = sized.join(targets, sized[source].eqNullSafe(targets[name]), "left").drop(name).withColumn(per, rate)
    extra = (unit_hash(F.col(doc_id), seed) < F.col(per) - F.floor(per)).cast("long")
    return rows.withColumn(copies, F.floor(per) + extra).drop(per)


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: rows of docs with all their columns, each as often as mix_rates() says."""
    prefix = free_prefix(docs)
    rated = mix_rates(docs, prefix=prefix, **options)
    return rated.withColumn(f"{prefix}copy", F.explode(F.array_repeat(F.lit(0), F.col(f"{prefix}copies").cast("int")))).select(*[f"`{c}`" for c in docs.columns])


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix_rates(docs).select("doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), (F.col("_copies") * F.col("_size")).alias("taken"))


ORACLE = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT AS weight
  FROM d GROUP BY source),
w AS (SELECT sum(source_size)::BIGINT AS t, sum(weight)::BIGINT AS w FROM s),
fill AS (
  SELECT 0 AS k, t AS rest, w AS weight FROM w
  UNION
  SELECT k + 1, (SELECT t FROM w) - c, (SELECT w FROM w) - x
  FROM (SELECT k, coalesce((SELECT sum(3 * source_size)::BIGINT FROM s WHERE 3 * s.source_size * fill.weight < s.weight * fill.rest), 0) AS c,
               coalesce((SELECT sum(s.weight)::BIGINT FROM s WHERE 3 * s.source_size * fill.weight < s.weight * fill.rest), 0) AS x
        FROM fill) WHERE k < 64),
last AS (SELECT rest, weight FROM fill WHERE k = (SELECT max(k) FROM fill)),
t AS (
  SELECT source, source_size,
    CASE WHEN 3 * s.source_size * last.weight < s.weight * last.rest THEN (3 * source_size)::DOUBLE
         ELSE (s.weight * last.rest)::DOUBLE / last.weight::DOUBLE END AS target
  FROM s, last),
r AS (
  SELECT doc_id, size, source_size, target, coalesce(target / nullif(source_size, 0)::DOUBLE, 0) AS rate,
    ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, ((floor(rate)::BIGINT + (u < rate - floor(rate))::BIGINT) * size)::BIGINT AS taken FROM r
"""
