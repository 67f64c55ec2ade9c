"""Line dedup: a line that several documents share stays in the first of them."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import materialize
from .common import SPACES, ascii_lower, read

MIN_CHARS = 10
_EVENT = "kind int, doc_id long, t long, pos int, h1 long, h2 long"
_DROP, _HEAD, _FIRST = 0, 1, 2


def line_key(line: Column) -> Column:
    return F.trim(ascii_lower(line), F.lit(SPACES))


def _first_occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stream one range partition, sorted by hash, document and position.

    Within the partition, rows of a hash that are of another document than its first row are drops. The first hash of
    a partition may have begun in an earlier one, so its first document's rows are emitted as _HEAD; the first
    documents of the partition's first and last hash are emitted as _FIRST.
    """
    names = ("doc_id", "t", "pos", "h1", "h2")

    def event(kind: int, rows: dict[str, np.ndarray]) -> pa.RecordBatch:
        n = len(rows["doc_id"])
        return pa.RecordBatch.from_arrays([pa.array(np.full(n, kind, np.int32)), *(pa.array(rows[c].astype(np.int32 if c == "pos" else np.int64)) for c in names)], names=["kind", *names])

    now, head, first = None, True, 0  # the hash of the run so far, whether it is the partition's first, its first document
    tail = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = {c: batch.column(c).to_numpy() for c in names}
        h1, h2, doc = cols["h1"], cols["h2"], cols["doc_id"]
        start = np.ones(len(doc), bool)
        start[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        goes_on = now == (h1[0], h2[0])
        start[0] = not goes_on
        run = np.cumsum(start)
        firsts = np.concatenate([[first], doc[start]])
        first_doc = firsts[run]
        in_head = run == (0 if goes_on else 1) if head and (goes_on or now is None) else np.zeros(len(doc), bool)
        drop = doc != first_doc
        yield event(_DROP, {c: x[drop] for c, x in cols.items()})
        pending = in_head & ~drop
        yield event(_HEAD, {c: x[pending] for c, x in cols.items()})
        if now is None:
            yield event(_FIRST, {c: x[:1] for c, x in cols.items()})
        head = bool(in_head[-1])
        now, first = (h1[-1], h2[-1]), int(first_doc[-1])
        tail = {c: x[-1:].copy() for c, x in cols.items()}
        tail["doc_id"] = np.array([first])
    if tail is not None:
        yield event(_FIRST, tail)


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for gone in batch.column("gone").to_pylist():
            bits = np.ones(max(gone) // 8 * 8 + 8, bool)
            bits[gone] = False
            out.append(zlib.compress(np.packbits(bits, bitorder="little").tobytes()))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("t"), pa.array([len(set(x)) for x in batch.column("gone").to_pylist()], pa.int64()), pa.array(out, pa.binary())], names=["doc_id", "t", "n_dropped", "keep"])


def line_keep_bitmaps(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """Documents that lose lines: doc_id, t (the text's hash), n_dropped and keep, a compressed bitmap of lines that stay.

    Bit i of the unpacked bitmap is line i; lines beyond its end stay. Lines are cut at line feeds; a key is the line
    lower-cased (A-Z) and stripped. A key of min_chars code points or more that two documents hold stays in the
    smallest doc_id alone, there in all its places. Null and empty texts have one empty line, which stays. Rows
    with a null doc_id keep all lines. Rows that repeat a doc_id count as one document. Hashes have 128 bits.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).where(F.col("doc_id").isNotNull())
    lines = rows.select("doc_id", F.xxhash64("text").alias("t"), F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    keyed = lines.select("doc_id", "t", "pos", line_key(F.col("line")).alias("key")).where(F.length("key") >= min_chars)
    hashed = keyed.select("doc_id", "t", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("line"), "key").alias("h2"))
    # document and position are part of the range, so a line that a third of all documents hold spans many partitions
    order = ["h1", "h2", "doc_id", "pos"]
    events = materialize(hashed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_first_occurrences, _EVENT), "line-events")
    firsts = events.where(F.col("kind") == _FIRST).groupBy("h1", "h2").agg(F.min("doc_id").alias("first"))
    heads = events.where(F.col("kind") == _HEAD).join(firsts, ["h1", "h2"]).where(F.col("doc_id") != F.col("first"))
    gone = events.where(F.col("kind") == _DROP).select("doc_id", "t", "pos").unionByName(heads.select("doc_id", "t", "pos"))
    return gone.groupBy("doc_id", "t").agg(F.collect_set("pos").alias("gone")).mapInArrow(_bitmaps, "doc_id long, t long, n_dropped long, keep binary")


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, counts = [], []
        for text, keep in zip(batch.column("text").to_pylist(), batch.column("keep").to_pylist(), strict=True):
            lines = text.split("\n")
            counts.append(len(lines))
            if keep is not None:
                bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), bitorder="little")
                lines = [x for i, x in enumerate(lines) if i >= len(bits) or bits[i]]
            texts.append("\n".join(lines))
        dropped = batch.column("n_dropped")
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64()), dropped, pa.array(texts, pa.string())], names=["doc_id", "n_lines", "n_dropped", "kept"])


def apply_line_bitmaps(docs: DataFrame, bitmaps: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_lines, n_dropped and kept, the text of the lines that stay, for each row of docs."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("t", F.xxhash64("text"))
    joined = rows.join(bitmaps, ["doc_id", "t"], "left").select("doc_id", "text", F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"), "keep")
    return joined.mapInArrow(_apply, "doc_id long, n_lines long, n_dropped long, kept string")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    kept = apply_line_bitmaps(docs, line_keep_bitmaps(docs))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


_BLANK = r"chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
ORACLE = rf"""
WITH l AS (
  SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)),
k AS (SELECT *, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {_BLANK}) AS key FROM l),
m AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= {MIN_CHARS} GROUP BY key HAVING count(DISTINCT doc_id) > 1),
f AS (SELECT k.doc_id, pos, line, coalesce(k.doc_id <> first, false) AS gone FROM k LEFT JOIN m ON k.key = m.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, coalesce(sum(gone::INT), 0)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM f GROUP BY doc_id
"""
