"""Joins that keep the rows of hot keys where they are, and totals over sorted rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import materialize

#: A key with so many rows is hot, unless more than MAX_HOT_KEYS keys could be: then with more rows, so that the hot keys stay few.
HOT_ROWS = 1000
MAX_HOT_KEYS = 50_000
#: Hot rows of more bytes than this aren't broadcast.
HOT_BYTES = 64 << 20


def spread_join(rows: DataFrame, small: DataFrame, on: Sequence[str], count: str = "n", how: str = "inner") -> DataFrame:
    """rows joined to small, which has one row for each key and in count the number of rows that have it (count is dropped).

    Of T rows at most T / HOT_ROWS keys can have HOT_ROWS rows each, so the hot keys fit a broadcast of proven size, and
    their rows aren't shuffled; the rest meets in a shuffle, where no key has more than its share. If small's rows of the
    hot keys take over HOT_BYTES, only the keys are broadcast and the rows are dealt as in spread_pairs(). how: inner or
    left. Null keys match nothing.
    """
    on = list(on)
    small = materialize(small, "small-side")
    whole = small.agg(F.coalesce(F.sum(count), F.lit(0)).alias("total"), F.coalesce(F.max(count), F.lit(0)).alias("most")).first()
    limit = max(HOT_ROWS, -(-whole["total"] // MAX_HOT_KEYS))
    if whole["most"] < limit:
        return rows.join(small.drop(count), on, how)
    hot, cool = small.where(F.col(count) >= limit).drop(count), small.where(F.col(count) < limit).drop(count)
    rest = rows.join(F.broadcast(hot.select(*on)), on, "left_anti").join(cool, on, how)
    text = F.to_json(F.struct(*hot.columns))  # longer than the row for the most part
    if (hot.agg(F.sum(F.octet_length(text))).first()[0] or 0) <= HOT_BYTES:
        here = rows.join(F.broadcast(hot), on)
    else:
        here = spread_pairs(hot, rows.join(F.broadcast(hot.select(*on)), on, "left_semi"), on)
    return here.select(*rest.columns).unionByName(rest)


def spread_pairs(x: DataFrame, y: DataFrame, on: Sequence[str], keys: DataFrame | None = None) -> DataFrame:
    """x joined to y where many rows of y may share a key: those of a hot key are dealt to several tasks, to which x's rows of it are copied.

    The columns besides the keys have different names. Hot keys are few, as in spread_join(). keys: a cheaper table with
    the keys of y's rows, to count.
    """
    on = list(on)
    counts = materialize((y if keys is None else keys).groupBy(*on).agg(F.count("*").alias("_n")).where(F.col("_n") > HOT_ROWS), "key-counts")
    whole = counts.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("total"), F.count("*").alias("keys")).first()
    if not whole["keys"]:
        return x.join(y, on)
    limit = max(HOT_ROWS, -(-whole["total"] // MAX_HOT_KEYS))
    hot = F.broadcast(counts.where(F.col("_n") > limit).select(*on, F.ceil(F.col("_n") / limit).cast("int").alias("_parts")))
    parts = F.coalesce("_parts", F.lit(1))
    dealt = y.join(hot, on, "left").withColumn("_part", F.pmod(F.hash(*[c for c in y.columns if c not in on]), parts)).drop("_parts")
    copied = x.join(hot, on, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts")
    return copied.join(dealt, [*on, "_part"]).drop("_part")


def running_total(df: DataFrame, order: Sequence[str], value: str, name: str) -> DataFrame:
    """Add the sum of value over all rows before, in the given order, without bringing the rows to one task.

    A range-partitioned sort adds up inside partitions; the partitions' sums (one small row each) give offsets.
    """
    rows = materialize(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), "totals").withColumn("_part", F.shiftright("_at", 33))
    sums = sorted((r["_part"], r["s"]) for r in rows.groupBy("_part").agg(F.sum(value).alias("s")).collect())
    offsets, total = [], 0
    for part, s in sums:
        offsets.append((part, total))
        total += s
    before = F.coalesce(F.sum(value).over(Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shifts = df.sparkSession.createDataFrame(offsets, "_part long, _shift long")
    return rows.withColumn("_own", before).join(F.broadcast(shifts), "_part").withColumn(name, F.col("_own") + F.col("_shift")).drop("_at", "_part", "_own", "_shift")


def ranked(df: DataFrame, *order: str, name: str = "rank") -> DataFrame:
    """Add a gapless rank from 0 over all rows in the given order, without bringing the rows to one task."""
    counted = running_total(df.withColumn("_one", F.lit(1).cast("long")), order, "_one", name)
    return counted.drop("_one")
