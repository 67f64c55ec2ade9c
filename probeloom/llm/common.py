"""Shared helpers: tables, ranks, Arrow token batches and 64-bit hashing."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import materialize

#: A word everywhere in this package: a run of characters that aren't ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Texts are handled in pieces of about so many bytes of UTF-8 within a Python task.
SLICE_BYTES = 1 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def free_prefix(df: DataFrame) -> str:
    """Underscores with which no column of df begins, for columns that are added for a while."""
    prefix = "_"
    while any(c.startswith(prefix) for c in df.columns):
        prefix += "_"
    return prefix


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once for a row."""
    return F.element_at(F.transform(F.array(value), use), 1)


def ranked(df: DataFrame, *order: Column, name: str = "rank") -> DataFrame:
    """Add a gapless rank from 0 over all rows in the given order, without bringing the rows to one task.

    A range-partitioned sort numbers rows inside partitions; the partitions' sizes (one small row each) give offsets.
    """
    rows = materialize(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), "ranked")
    rows = rows.withColumn("_part", F.shiftright("_at", 33).cast("int"))
    counts = sorted((r["_part"], r["n"]) for r in rows.groupBy("_part").agg(F.count("*").alias("n")).collect())
    spark, starts, total = df.sparkSession, [], 0
    for part, n in counts:
        starts.append((part, total - (part << 33)))
        total += n
    offsets = spark.createDataFrame(starts, "_part int, _shift long")
    return rows.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_at") + F.col("_shift")).drop("_at", "_part", "_shift")


# --- texts in Python tasks: numpy over the bytes of an Arrow column -------------------------------------------------

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _bytes_of(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and each row's bounds in them; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col.cast(pa.large_string()), "")
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    data = np.frombuffer(col.buffers()[2], np.uint8)[bounds[0] : bounds[-1]] if col.buffers()[2] else np.zeros(0, np.uint8)
    return data, bounds - bounds[0]


class Tokens:
    """Words of the rows of a text column: byte bounds, and row i's words are first[i] to first[i + 1].

    gaps: which bytes separate words, ASCII white space unless given.
    """

    def __init__(self, col: pa.Array, gaps: np.ndarray = _SPACE):
        self.data, self.bounds = data, bounds = _bytes_of(col)
        space = gaps[data]
        before, after = np.ones(len(data), bool), np.ones(len(data), bool)
        before[1:], after[:-1] = space[:-1], space[1:]
        before[bounds[:-1][bounds[:-1] < len(data)]] = True
        after[bounds[1:][bounds[1:] > 0] - 1] = True
        self.starts = np.flatnonzero(~space & before)
        self.ends = np.flatnonzero(~space & after) + 1
        self.first = np.searchsorted(self.starts, bounds)

    def hashes(self, seed: int, fold: bool = False) -> np.ndarray:
        """A 64-bit hash of each word; fold: A-Z count as a-z."""
        table = np.random.default_rng(seed).integers(0, 1 << 64, 256, np.uint64)
        if fold:
            table = table[_FOLD]
        out = np.zeros(len(self.starts), np.uint64)
        lo = 0
        while lo < len(out):
            at = self.starts[lo]
            hi = max(lo + 1, int(np.searchsorted(self.ends, at + _STEP, "right")))
            part = table[self.data[at : self.ends[hi - 1]]]
            power, inverse = _powers(len(part) + 1)
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(part * power[:-1], out=sums[1:])
            s, e = self.starts[lo:hi] - at, self.ends[lo:hi] - at
            out[lo:hi] = (sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64)
            lo = hi
        return mix(out)


#: Sums of powers run over so many numbers at a time.
_STEP = 1 << 17
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number, and of its inverse, modulo 2 ** 64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, _STEP + 4096)
        inverse = np.uint64(pow(int(_ODD), -1, 1 << 64))
        _POWERS[:] = [np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, x)])) for x in (_ODD, inverse)]
    return _POWERS[0][:n], _POWERS[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finisher that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_hashes(words: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """Hashes of all runs of so many words (runs across rows included; the caller masks them)."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    salted = words if not seed else mix(words + np.uint64(seed))
    out = np.empty(n, np.uint64)
    for lo in range(0, n, _STEP):
        part = salted[lo : min(n, lo + _STEP) + length - 1]
        power, inverse = _powers(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * power[:-1], out=sums[1:])
        m = len(part) - length + 1
        out[lo : lo + m] = (sums[length:] - sums[:m]) * inverse[:m]
    return mix(out + np.uint64(length))


def slices(batches: Iterator[pa.RecordBatch], column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about size bytes of text each (a longer text stands alone)."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        block = (np.cumsum(sizes) - sizes) // size
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1), batch.num_rows]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            if hi > lo:
                yield batch.slice(lo, hi - lo)
