"""Exact quantiles by key, however many values a key has."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import materialize
from .spread import MAX_HOT_KEYS, spread_join

#: A task holds so many different values of a key at most, besides those at the ends of a bracket.
LIMIT = 100_000
#: Of the summaries that narrow brackets: ranks are right within one part in so many.
ACCURACY = 2000


def exact_quantiles(table: DataFrame, keys: Sequence[str], value: str | Column, probabilities: Sequence[float], limit: int = LIMIT) -> DataFrame:
    """keys, n (values that aren't null) and q (array of double): quantiles with linear interpolation, as percentile() has them.

    table is read several times, so it should be written or cheap. Keys with up to limit values are one aggregate. For a
    larger key each rank that a quantile needs is selected: a bracket of values around it shrinks, by quantile summaries
    that merge, until few values are left between its ends; those are counted and the rank is picked. Every bracket is
    checked by counts, so the result is exact whatever the summaries say. Keys without values have a null q.
    """
    keys = list(keys)
    values = table.select(*keys, (F.col(value) if isinstance(value, str) else value).cast("double").alias("_v"))
    counts = materialize(values.groupBy(*keys).agg(F.count("_v").alias("n")), "value-counts")
    most = counts.agg(F.max("n")).first()[0] or 0
    ask = F.array(*map(F.lit, probabilities))
    if most <= limit:
        return values.groupBy(*keys).agg(F.count("_v").alias("n"), F.percentile("_v", ask).alias("q"))
    large = counts.where(F.col("n") > limit)  # of T values at most T / limit keys
    some = values.join(F.broadcast(large.select(*keys)), keys, "left_anti").groupBy(*keys).agg(F.count("_v").alias("n"), F.percentile("_v", ask).alias("q"))
    rows = values.join(F.broadcast(large.select(*keys)), keys, "left_semi").where("_v IS NOT NULL")
    places = large.select(*keys, "n", F.posexplode(ask).alias("_i", "_p")).withColumn("_at", F.col("_p") * (F.col("n") - 1))
    wanted = materialize(places.select(*keys, "n", "_i", "_at", F.floor("_at").alias("_low"), F.ceil("_at").alias("_high")), "ranks")
    ranks = wanted.select(*keys, "n", F.explode(F.array("_low", "_high")).alias("_rank")).distinct()
    found = materialize(_select(rows, keys, ranks, limit), "selected")
    low, high = (found.select(*keys, F.col("_rank").alias(r), F.col("_value").alias(f"{r}_value")) for r in ("_low", "_high"))
    whole = wanted.join(low, [*keys, "_low"]).join(high, [*keys, "_high"])
    between = (F.col("_high") - F.col("_at")) * F.col("_low_value") + (F.col("_at") - F.col("_low")) * F.col("_high_value")
    exact = F.when(F.col("_low_value") == F.col("_high_value"), F.col("_low_value")).otherwise(between)
    listed = F.transform(F.sort_array(F.collect_list(F.struct("_i", exact.alias("v")))), lambda x: x["v"])  # as many as probabilities
    return some.unionByName(whole.groupBy(*keys).agg(F.first("n").alias("n"), listed.alias("q")))


def _select(rows: DataFrame, keys: list[str], ranks: DataFrame, limit: int) -> DataFrame:
    """keys, _rank and _value: of each key's values in order, those at the ranks (from 0)."""
    at = [*keys, "_rank"]
    ends = rows.groupBy(*keys).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    state = materialize(ranks.join(ends, keys).select(*at, "_lo", "_hi", F.lit(0).cast("long").alias("_below"), F.col("n").alias("_inside"), F.col("n").alias("_between")), "brackets")
    last = None
    while True:
        open_ = state.where((F.col("_between") > limit) & (F.col("_lo") < F.col("_hi")))
        left = open_.agg(F.coalesce(F.sum("_between"), F.lit(0))).first()[0]
        if not left or left == last:
            break
        last = left
        inside = rows.join(F.broadcast(open_), keys).where(F.col("_v").between(F.col("_lo"), F.col("_hi")))
        share = F.least(F.lit(1.0), (F.col("_rank") - F.col("_below")) / F.greatest(F.col("_inside") - 1, F.lit(1)))
        # the summary is asked for a grid of ranks; those around the wanted one are the new ends
        grid = [i / 500 for i in range(501)]
        summary = inside.groupBy(*at).agg(F.percentile_approx("_v", grid, ACCURACY).alias("_grid")).join(F.broadcast(open_), at)
        cell = F.floor(share * 500).cast("int")
        ends = summary.select(*at, "_lo", "_hi", "_below", F.col("_grid")[F.greatest(cell - 1, F.lit(0))].alias("_a"), F.col("_grid")[F.least(cell + 2, F.lit(500))].alias("_b"))
        ends = materialize(ends, "bracket-ends")
        v, a, b = F.col("_v"), F.col("_a"), F.col("_b")
        near = rows.join(F.broadcast(ends), keys).where(v.between(F.col("_lo"), F.col("_hi")))
        n = near.groupBy(*at).agg(*[F.count_if(c).alias(x) for x, c in {"lt_a": v < a, "le_a": v <= a, "lt_b": v < b, "le_b": v <= b, "before_a": (v > F.col("_lo")) & (v < a), "within": (v > a) & (v < b), "after_b": (v > b) & (v < F.col("_hi"))}.items()], F.count("*").alias("all"))
        rank = F.col("_rank") - F.col("_below")  # inside the bracket
        left_of, right_of = rank < F.col("lt_a"), rank >= F.col("le_b")
        pick = lambda x, y, z: F.when(left_of, x).when(right_of, z).otherwise(y)
        below = F.col("_below") + pick(F.lit(0), F.col("lt_a"), F.col("lt_b"))
        size = pick(F.col("le_a"), F.col("le_b") - F.col("lt_a"), F.col("all") - F.col("lt_b"))
        narrower = n.join(F.broadcast(ends), at).select(*at, pick(F.col("_lo"), a, b).alias("_lo"), pick(a, b, F.col("_hi")).alias("_hi"), below.alias("_below"), size.alias("_inside"), pick(F.col("before_a"), F.col("within"), F.col("after_b")).alias("_between"))
        state = materialize(state.join(F.broadcast(open_.select(*at)), at, "left_anti").unionByName(narrower), "brackets")
    done = state.where("_lo = _hi").select(*at, F.col("_lo").alias("_value"))
    inside = rows.join(F.broadcast(state.where("_lo < _hi")), keys).where(F.col("_v").between(F.col("_lo"), F.col("_hi")))
    each = inside.groupBy(*at, "_below", F.col("_v").alias("_value")).agg(F.count("*").alias("_n"))
    upto = F.col("_below") + F.sum("_n").over(Window.partitionBy(*at).orderBy("_value").rowsBetween(Window.unboundedPreceding, 0))
    picked = each.withColumn("_upto", upto).where(F.col("_rank").between(F.col("_upto") - F.col("_n"), F.col("_upto") - 1))
    return done.unionByName(picked.select(*at, "_value"))


def with_quantiles(table: DataFrame, keys: Sequence[str], value: str | Column, probabilities: Sequence[float], name: str, limit: int = LIMIT) -> DataFrame:
    """table with the quantiles of its key in a column of that name. Rows of a hot key aren't brought together; keys aren't null."""
    quantiles = exact_quantiles(table, keys, value, probabilities, limit).withColumnRenamed("q", name)
    quantiles = materialize(quantiles, "quantiles")
    if quantiles.count() <= MAX_HOT_KEYS:
        return table.join(F.broadcast(quantiles.drop("n")), list(keys))
    return spread_join(table, quantiles, keys, "n")
