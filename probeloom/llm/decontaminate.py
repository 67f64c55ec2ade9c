"""Benchmark decontamination: find test items in documents, up to an edit budget."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import materialize
from ..spread import spread_pairs
from .common import Tokens, read, slices, window_hashes

#: One word in so many may be inserted, deleted or replaced.
WORDS_PER_EDIT = 5
#: Items up to this size in all are searched with one broadcast automaton; larger tables meet the documents in shuffles.
AUTOMATON_BYTES = 4 << 20
#: Pieces of a large table are marked in a bitmap of so many bits (16 MB, however many the pieces), which spares documents' other runs the shuffle.
BITMAP_BITS = 1 << 27

_WORD = re.compile(r"[^\W_]+")
_RUN = 41
#: A text of n words is cut into n // 5 + 1 pieces, so none is longer than this.
MAX_PIECE = WORDS_PER_EDIT
_PART_BITS = 8 * 4096
_HITS = {"doc_id": pa.int64(), "text_hash": pa.int64(), "item_id": pa.int64(), "distance": pa.int32(), "budget": pa.int32(), "end_word": pa.int32()}
_PIECES = {"piece": pa.int64(), "item": pa.int64(), "lo": pa.int32(), "n": pa.int32()}
_PIECE_HITS = {"piece": pa.int64(), "doc_id": pa.int64(), "text_hash": pa.int64(), "pos": pa.int32()}
_WINDOWS = {"doc_id": pa.int64(), "text_hash": pa.int64(), "item": pa.int64(), "start": pa.int32(), "window": pa.string()}


def _ddl(schema: dict[str, pa.DataType]) -> str:
    names = {pa.int64(): "long", pa.int32(): "int", pa.string(): "string"}
    return ", ".join(f"{c} {names[k]}" for c, k in schema.items())


def words_of(text: str) -> list[str]:
    """Lower-cased runs of letters and digits."""
    return _WORD.findall(text.lower())


def pieces_of(n: int, count: int) -> list[tuple[int, int]]:
    """Cut n words into so many runs of nearly equal length."""
    cuts = [n * i // count for i in range(count + 1)]
    return list(zip(cuts, cuts[1:], strict=False))


def edit_search(item: list[str], text: list[str]) -> tuple[int, int]:
    """Least edit distance in words of item to any run of text, and where that run ends (Myers' bit-parallel columns)."""
    m = len(item)
    full, top = (1 << m) - 1, 1 << (m - 1)
    same: dict[str, int] = {}
    for i, w in enumerate(item):
        same[w] = same.get(w, 0) | 1 << i
    up, down, score = full, 0, m
    best = (m, 0)
    for end, w in enumerate(text, 1):
        eq = same.get(w, 0)
        diagonal = (((eq & up) + up) ^ up) | eq | down
        plus, minus = down | (full & ~(diagonal | up)), up & diagonal
        score += bool(plus & top) - bool(minus & top)
        plus, minus = plus << 1 & full, minus << 1 & full
        up, down = minus | (full & ~((eq | down) | plus)), plus & (eq | down)
        best = min(best, (score, end))
    return best


def _automaton(rows: list[tuple[int, str]]) -> tuple[ahocorasick.Automaton | None, list]:
    """All pieces as one automaton, and the items as (item_id, words, budget)."""
    items, places = [], {}
    for item_id, text in rows:
        words = words_of(text)
        if not words:
            continue
        budget = len(words) // WORDS_PER_EDIT
        for lo, hi in pieces_of(len(words), budget + 1):
            places.setdefault(f" {' '.join(words[lo:hi])} ", []).append((len(items), lo))
        items.append((item_id, words, budget))
    if not places:
        return None, items
    automaton = ahocorasick.Automaton()
    for piece, where in places.items():
        automaton.add_word(piece, (len(piece), where))
    automaton.make_automaton()
    return automaton, items


def _near(item: list[str], words: list[str], at: int) -> tuple[int, int]:
    """Least distance of item to the words around a place where it may begin, and where that run ends."""
    budget = len(item) // WORDS_PER_EDIT
    start = max(0, at - budget)
    distance, end = edit_search(item, words[start : at + len(item) + budget])
    return distance, start + end


def _hits(batches: Iterator[pa.RecordBatch], shared: Broadcast) -> Iterator[pa.RecordBatch]:
    automaton, items = _automaton(shared.value)
    for batch in slices(batches, "text"):
        out = []
        for doc_id, t, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text_hash", "text")), strict=True):
            if not text or automaton is None:
                continue
            words = words_of(text)
            line = f" {' '.join(words)} "
            offsets, seen, best = None, set(), {}
            for last, (length, where) in automaton.iter(line):
                if offsets is None:
                    offsets = [1]
                    for w in words:
                        offsets.append(offsets[-1] + len(w) + 1)
                word = bisect_right(offsets, last - length + 2) - 1
                for item, lo in where:
                    if (item, word - lo) in seen:
                        continue
                    seen.add((item, word - lo))
                    _, needle, budget = items[item]
                    found = _near(needle, words, word - lo)
                    if found[0] <= budget:
                        best[item] = min(best.get(item, found), found)
            out += [(doc_id, t, items[i][0], d, items[i][2], end) for i, (d, end) in sorted(best.items())]
        yield _batch(out, _HITS)


def _batch(rows: list[tuple], schema: dict[str, pa.DataType]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, schema.values(), strict=True)], names=list(schema))


# --- benchmarks beyond one automaton: pieces meet documents' runs of words in a join --------------------------------


def _runs(words: list[str]) -> dict[int, np.ndarray]:
    """Hashes of all runs of words, by length, for the lengths that pieces have."""
    data = Tokens(pa.array([" ".join(words)])).hashes(_RUN)
    return {n: window_hashes(data, n).view(np.int64) for n in range(1, min(len(words), MAX_PIECE) + 1)}


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist(), strict=True):
            words = words_of(text or "")
            runs = _runs(words)
            out += [(int(runs[hi - lo][lo]), item, lo, len(words)) for lo, hi in (pieces_of(len(words), len(words) // WORDS_PER_EDIT + 1) if words else ())]
        yield _batch(out, _PIECES)


def _piece_hits(batches: Iterator[pa.RecordBatch], shared: Broadcast) -> Iterator[pa.RecordBatch]:
    """Runs of words whose hash is marked in the bitmap."""
    marked = np.frombuffer(shared.value, np.uint8)
    for batch in slices(batches, "text"):
        row, piece, pos = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
        for i, text in enumerate(batch.column("text").to_pylist()):
            for run in _runs(words_of(text or "")).values():
                bit = run & (BITMAP_BITS - 1)
                at = np.flatnonzero(marked[bit >> 3] >> (bit & 7).astype(np.uint8) & 1)
                row.append(np.full(len(at), i))
                piece.append(run[at])
                pos.append(at.astype(np.int32))
        own = pa.array(np.concatenate(row))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(piece)), batch.column("doc_id").take(own), batch.column("text_hash").take(own), pa.array(np.concatenate(pos))], names=list(_PIECE_HITS))


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words around each place of a document where an item may begin."""
    for batch in slices(batches, "text"):
        for doc_id, t, text, places in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text_hash", "text", "places")), strict=True):
            words, out = words_of(text), []
            for p in places:
                budget = p["n"] // WORDS_PER_EDIT
                start = max(0, p["at"] - budget)
                out.append((doc_id, t, p["item"], start, " ".join(words[start : p["at"] + p["n"] + budget])))
            yield _batch(out, _WINDOWS)


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for doc_id, t, item, start, window, text in zip(*(batch.column(c).to_pylist() for c in (*_WINDOWS, "text")), strict=True):
            needle = words_of(text)
            budget = len(needle) // WORDS_PER_EDIT
            distance, end = edit_search(needle, window.split(" "))
            if distance <= budget:
                out.append((doc_id, t, item, distance, budget, start + end))
        yield _batch(out, _HITS)


def _bitmap(pieces: DataFrame) -> bytes:
    """The bits of all pieces' hashes, BITMAP_BITS in all: 4 KB parts made where the pieces are."""
    bit = F.col("piece").bitwiseAND(F.lit(BITMAP_BITS - 1))
    parts = pieces.groupBy(F.floor(bit / _PART_BITS).alias("part")).agg(F.bitmap_construct_agg((bit % _PART_BITS).cast("long")).alias("bits"))
    out = bytearray(BITMAP_BITS // 8)
    for r in parts.collect():
        out[r["part"] * (_PART_BITS // 8) : (r["part"] + 1) * (_PART_BITS // 8)] = r["bits"]
    return bytes(out)


def _leaks_by_joins(docs: DataFrame, items: DataFrame) -> DataFrame:
    """leaks() for items of any number and size: hits of pieces by a join on their hashes, then the words around them."""
    named = materialize(items.withColumn("item", F.monotonically_increasing_id()), "items")
    pieces = materialize(named.select("item", "text").mapInArrow(_pieces, _ddl(_PIECES)), "pieces")
    shared = docs.sparkSession.sparkContext.broadcast(_bitmap(pieces))
    hits = materialize(docs.mapInArrow(lambda b: _piece_hits(b, shared), _ddl(_PIECE_HITS)), "piece-hits")
    places = spread_pairs(pieces, hits, ["piece"]).select("doc_id", "text_hash", F.struct("item", (F.col("pos") - F.col("lo")).alias("at"), "n").alias("place"))
    by_doc = places.groupBy("doc_id", "text_hash").agg(F.collect_set("place").alias("places")).withColumnsRenamed({"doc_id": "_d", "text_hash": "_t"})
    same = docs["doc_id"].eqNullSafe(by_doc["_d"]) & (docs["text_hash"] == by_doc["_t"])
    windows = docs.join(by_doc, same).select("doc_id", "text_hash", "text", "places").mapInArrow(_windows, _ddl(_WINDOWS))
    windows = materialize(windows, "windows")
    verified = spread_pairs(named.select("item", "text"), windows, ["item"]).select(*_WINDOWS, "text").mapInArrow(_verified, _ddl(_HITS))
    best = verified.groupBy("doc_id", "text_hash", F.col("item_id").alias("item")).agg(F.min(F.struct("distance", "end_word")).alias("b"), F.first("budget").alias("budget"))
    best = best.join(named.select("item", "item_id"), "item").select(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_t"), "item_id", "b.distance", "budget", "b.end_word")
    ids = docs.select("doc_id", "text_hash")  # a row that repeats is reported each time
    return ids.join(best, ids["doc_id"].eqNullSafe(best["_d"]) & (ids["text_hash"] == best["_t"])).select(*_HITS)


def leaks(docs: DataFrame, items: DataFrame, automaton_bytes: int = AUTOMATON_BYTES) -> DataFrame:
    """doc_id, text_hash, item_id, distance, budget and end_word for each document that holds an item up to its edit budget.

    docs has doc_id and text, items item_id and text. Texts are compared as lower-cased words of letters and digits.
    An item of n words may differ in n // 5 words; cut into one piece more than that, at least one piece is untouched,
    so exact hits of pieces find every place to verify. An item under 5 words must stand there word for word. Items up
    to automaton_bytes in all are broadcast and documents are read once; more items meet the documents' runs of words
    in a join. Both ways give the same rows. Documents are searched whole. Texts without words match nothing; repeated
    rows are reported each; a null id is carried as null; other columns are ignored.
    """
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    items = items.select("item_id", "text").where("text is not null")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0))).first()[0]
    if size > automaton_bytes:
        return _leaks_by_joins(docs, items)
    shared = docs.sparkSession.sparkContext.broadcast([tuple(r) for r in items.collect()])
    return docs.mapInArrow(lambda b: _hits(b, shared), _ddl(_HITS))


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of docs that hold no item: each row is judged by its own text, whatever its doc_id. All columns pass through."""
    bad = materialize(leaks(docs, items).select(F.col("doc_id").alias("_bad_id"), F.col("text_hash").alias("_bad_hash")).distinct(), "leaks")
    own = docs["doc_id"].eqNullSafe(bad["_bad_id"]) & (F.xxhash64(docs["text"]) == bad["_bad_hash"])
    return docs.join(bad, own, "left_anti")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
