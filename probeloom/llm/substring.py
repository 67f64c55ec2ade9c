"""Substring dedup: runs of words that repeat across documents, found by doubling the window level by level."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import last_table, materialize
from ..spread import spread_join
from .common import Tokens, read, slices, window_hashes

#: The last level; the levels before it look at windows of a half and a quarter as many words.
WINDOW = 50
_WORDS, _SECOND = 21, 0x1234567


def levels(window: int) -> tuple[int, int, int]:
    half = -(-window // 2)
    return -(-half // 2), half, window


def _sliding(x: np.ndarray, size: int, extreme: np.ufunc, filler: int) -> np.ndarray:
    """Least (np.minimum) or greatest (np.maximum) of each size neighbours, from running ones of blocks in both directions."""
    n = len(x) - size + 1
    blocks = np.full(-(-len(x) // size) * size, filler, x.dtype)
    blocks[: len(x)] = x
    blocks = blocks.reshape(-1, size)
    ahead = extreme.accumulate(blocks, axis=1).ravel()
    back = extreme.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return extreme(back[:n], ahead[size - 1 : size - 1 + n])


def _anchors(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """The windows of the first level that matter: the least hash within each full window; and both of their doubles.

    Equal full windows have their least windows at the same places, so these are enough to find every repeat, and
    neighbouring full windows mostly agree on them. Around a first window of a full window, at least one of the windows
    of twice the length that begin or end with it lies in the full window, too.
    """
    first, second, _ = levels(window)
    span = window - first + 1
    for batch in slices(batches, "text"):
        tokens = Tokens(batch.column("text"))
        words = tokens.hashes(_WORDS)
        if len(words) < window:
            continue
        hashes, doubles = window_hashes(words, first), window_hashes(words, second)
        lo, hi = tokens.first[:-1], tokens.first[1:]
        row = np.repeat(np.arange(len(lo)), hi - lo)
        least = _sliding(hashes, span, np.minimum, np.iinfo(np.uint64).max)
        whole = row[: len(least)] == row[np.arange(len(least)) + window - 1]  # windows within one row
        least[~whole] = 0
        # a place is an anchor if its hash is the least of some whole window around it: then it is the greatest of these least
        around = _sliding(np.concatenate([np.zeros(span - 1, np.uint64), least, np.zeros(span - 1, np.uint64)]), span, np.maximum, 0)
        at = np.flatnonzero((around == hashes) & (around > 0))
        own = row[at]
        right, left = at + second <= hi[own], at + first - second >= lo[own]
        take = pa.array(own)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(hashes[at].view(np.int64)), batch.column("doc_id").take(take), batch.column("t").take(take), pa.array((at - lo[own]).astype(np.int32)),
                pa.array(doubles[np.minimum(at, len(doubles) - 1)].view(np.int64), mask=~right), pa.array(doubles[np.maximum(at + first - second, 0)].view(np.int64), mask=~left),
            ],
            names=["h", "doc_id", "t", "pos", "right", "left"],
        )


def _extended(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """All full windows around the half windows that repeat."""
    _, half, _ = levels(window)
    span = window - half + 1
    for batch in slices(batches, "text"):
        tokens = Tokens(batch.column("text"))
        words = tokens.hashes(_WORDS)
        for i, (lo, hi, found) in enumerate(zip(tokens.first, tokens.first[1:], batch.column("found").to_pylist(), strict=False)):
            if hi - lo < window:
                continue
            first = window_hashes(words[lo:hi], window)
            wanted = np.zeros(len(first) + 1, np.int32)
            for p in found:
                wanted[max(0, p - span + 1)] += 1
                wanted[min(len(first), p + 1)] -= 1
            start = np.flatnonzero(np.cumsum(wanted[:-1]))
            second = (window_hashes(words[lo:hi], window, _SECOND)[start] >> np.uint64(32)).astype(np.uint32).view(np.int32)
            n = len(start)
            yield pa.RecordBatch.from_arrays([pa.array(first[start].view(np.int64)), pa.array(second), pa.array([batch.column("doc_id")[i].as_py()] * n, pa.int64()), pa.array([batch.column("t")[i].as_py()] * n, pa.int64()), pa.array(start.astype(np.int32))], names=["h1", "h2", "doc_id", "t", "start"])


def _keep(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        counts, removed, kept = [], [], []
        for text, copy, starts in zip(batch.column("text").to_pylist(), batch.column("copy").to_pylist(), batch.column("starts"), strict=True):
            words = (text or "").encode().split()
            gone = np.zeros(len(words) + 1, np.int64)
            if copy and len(words) >= window:
                gone[0] += 1
            if starts.is_valid:  # neighbouring windows make one range
                at = starts.values.to_numpy()
                gone[at] += 1
                gone[at + window] -= 1
            covered = np.cumsum(gone[:-1]) > 0
            counts.append(len(words))
            removed.append(int(covered.sum()))
            kept.append(b" ".join([w for w, g in zip(words, covered.tolist(), strict=True) if not g] if removed[-1] else words))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "n_removed", "kept"])


def _repeated(windows: DataFrame, name: str) -> DataFrame:
    """The rows of windows (h, doc_id, t, ...) whose hash two documents with different texts have; windows are written for the while."""
    windows = materialize(windows, "windows")
    seen = windows.groupBy("h").agg(F.count("*").alias("n"), *[f(c).alias(f"{c}_{n}") for c in ("doc_id", "t") for n, f in (("lo", F.min), ("hi", F.max))])
    seen = seen.where("doc_id_lo < doc_id_hi and t_lo < t_hi").select("h", "n")
    return materialize(spread_join(windows, seen, ["h"]), name)


def substring_dedup(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed and kept (the words that stay, joined by a space) for each row of docs.

    A word goes if a window of so many words covers it whose words also start in a document with a smaller doc_id.
    Levels: windows of a quarter of the length that two different texts share are doubled, those that are still shared
    are doubled again, and the last level's shared windows go; neighbouring ones become one range. A level without
    candidates ends the search.
    Texts equal byte for byte are settled as wholes. Null, empty and short texts lose nothing; rows with a null doc_id
    neither lose words nor take any from others; rows that repeat a doc_id count as one document. Hashes of full
    windows have 96 bits. Other columns are ignored.
    """
    first, second, _ = levels(window)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("t", F.xxhash64("text"))
    named = rows.where("doc_id is not null")

    whole = named.select("doc_id", "t", F.xxhash64(F.lit("whole"), "text").alias("t2"))
    firsts = whole.groupBy("t", "t2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count("*").alias("n")).where("first < last")
    copies = materialize(spread_join(whole, firsts, ["t", "t2"]).where("doc_id > first").select("doc_id", "t").distinct(), "copies")

    def doubled() -> DataFrame:
        anchors = named.mapInArrow(lambda b: _anchors(b, window), "h long, doc_id long, t long, pos int, right long, left long")
        anchors = _repeated(anchors, "level-1")
        both = F.array(F.struct(F.col("right").alias("h"), F.col("pos")), F.struct(F.col("left").alias("h"), (F.col("pos") + first - second).alias("pos")))
        halves = anchors.select("doc_id", "t", F.explode(both).alias("x")).select("x.h", "doc_id", "t", "x.pos").where("h is not null").distinct()
        return _repeated(halves, "level-2")

    halves = last_table(docs.sparkSession, doubled)  # the levels before take up disk no longer
    marks = copies.select("doc_id", "t", F.lit(True).alias("copy"))
    if halves.isEmpty():
        marks = marks.withColumn("starts", F.lit(None).cast("array<int>"))
    else:
        found = halves.groupBy("doc_id", "t").agg(F.collect_set("pos").alias("found")).join(copies, ["doc_id", "t"], "left_anti")
        wide = named.join(found, ["doc_id", "t"]).mapInArrow(lambda b: _extended(b, window), "h1 long, h2 int, doc_id long, t long, start int")
        wide = materialize(wide, "level-3")
        owners = wide.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count("*").alias("n")).where("first < last").select("h1", "h2", "first", "n")
        gone = spread_join(wide, owners, ["h1", "h2"]).where("doc_id > first")
        # by document, as arrays: one shuffle, in which a window is four bytes
        starts = gone.groupBy("doc_id", "t").agg(F.collect_set("start").alias("starts"))
        marks = starts.select("doc_id", "t", F.lit(None).cast("boolean").alias("copy"), "starts").unionByName(marks, allowMissingColumns=True)
    joined = rows.join(marks, ["doc_id", "t"], "left").select("doc_id", "text", "copy", "starts")
    return joined.mapInArrow(lambda b: _keep(b, window), "doc_id long, n_words long, n_removed long, kept string")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


ORACLE = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (
  SELECT doc_id, unnest(list_transform(range(1, len(words) - 48), lambda i: array_to_string(words[i:i + 49], ' '))) AS win,
    unnest(range(1, len(words) - 48)) AS pos
  FROM w WHERE len(words) >= 50),
h AS (SELECT doc_id, pos, md5(win) AS win FROM s),
f AS (SELECT win, min(doc_id) AS first FROM h GROUP BY win HAVING min(doc_id) < max(doc_id)),
g AS (SELECT doc_id, list(pos) AS starts FROM h JOIN f USING (win) WHERE doc_id > first GROUP BY doc_id),
c AS (SELECT doc_id, list_distinct(flatten(list_transform(starts, lambda p: range(p, p + 50)))) AS gone FROM g),
v AS (SELECT doc_id, unnest(gone) AS pos FROM c),
p AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM w),
k AS (SELECT p.doc_id, p.pos, word, v.pos IS NOT NULL AS gone FROM p LEFT JOIN v ON p.doc_id = v.doc_id AND p.pos = v.pos),
a AS (SELECT doc_id, sum(gone::INT)::BIGINT AS n_removed, coalesce(string_agg(word, ' ' ORDER BY pos) FILTER (WHERE NOT gone), '') AS kept FROM k GROUP BY doc_id)
SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN a ON w.doc_id = a.doc_id
"""
