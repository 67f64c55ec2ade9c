"""Near-duplicate documents with SetSketch registers.

Every text is sketched once: register i keeps floor(1 - log_b(h)), where h is the least of exponentially distributed
hashes of the text's shingles. Registers of two sketches merge by the greater value. Bands of registers propose
pairs, a joint likelihood over all registers and the exact set sizes screens them, and full sets confirm them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.components import components
from ..scratch import materialize
from ..spread import spread_join, spread_pairs
from .common import Tokens, mix, read, slices, window_hashes

SHINGLE = 5
BANDS, ROWS = 40, 4
#: Two sets of similarity 0.75 agree in a register about 3 times in 4, so all 40 bands miss with probability 2.4e-7.
REGISTERS = BANDS * ROWS
BASE, RATE, TOP = 1.001, 20.0, 65534
#: Link when 100 * intersection >= 75 * union.
PERCENT = 75
#: The likelihood's estimate has a standard error of 0.034 at 0.75; pairs far below the threshold aren't verified.
SCREEN = 0.55

_WORDS, _TEXT_KEY = 11, 12
_PARAMS = np.random.default_rng(7).integers(0, 1 << 64, (2, REGISTERS), np.uint64)
_SCALE, _SHIFT = _PARAMS[0] | np.uint64(1), _PARAMS[1]


def shingle_sets(tokens: Tokens) -> list[np.ndarray]:
    """The distinct shingle hashes of each row, sorted."""
    words = tokens.hashes(_WORDS, fold=True)
    runs = window_hashes(words, SHINGLE)
    out = []
    for lo, hi in zip(tokens.first, tokens.first[1:], strict=False):
        n = hi - lo
        out.append(np.unique(runs[lo : hi - SHINGLE + 1]) if n >= SHINGLE else window_hashes(words[lo:hi], n) if n else np.zeros(0, np.uint64))
    return out


def registers(shingles: np.ndarray) -> np.ndarray:
    """SetSketch registers of a set of hashes."""
    least = np.full(REGISTERS, np.iinfo(np.uint64).max)
    for lo in range(0, len(shingles), 512):
        part = np.multiply.outer(_SCALE, shingles[lo : lo + 512])
        part += _SHIFT[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    exponential = -np.log1p(-(np.minimum(least.astype(np.float64), 2.0**64 - 4096) + 1) / 2.0**64) / RATE
    return np.clip(np.floor(1 - np.log(exponential) / np.log(BASE)), 0, TOP + 1).astype("<u2")


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        sets = shingle_sets(tokens := Tokens(batch.column("text")))
        words = tokens.hashes(_TEXT_KEY, fold=True)
        keys, sketches = [], []
        for s, lo, hi in zip(sets, tokens.first, tokens.first[1:], strict=False):
            if not len(s):
                keys.append(None)
                sketches.append(None)
                continue
            own = words[lo:hi] + mix(np.arange(hi - lo, dtype=np.uint64) + np.uint64(1))
            keys.append(np.array([mix(own).sum(), mix(own ^ np.uint64(0x5555555555555555)).sum()]).tobytes())
            sketches.append(registers(s).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()), pa.array(sketches, pa.binary())],
            names=["doc_id", "n_shingles", "key", "sketch"],
        )


def sketches(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, key (128-bit hash of the word sequence) and sketch; key and sketch are null without words."""
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(_sketch, "doc_id long, n_shingles long, key binary, sketch binary")


_GRID = np.linspace(0, 1, 81)


def joint_similarity(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of sketched sets of known sizes (rows are pairs, columns registers)."""
    above, below = (a > b).sum(1), (a < b).sum(1)
    same = a.shape[1] - above - below
    u, v = na / (na + nb), nb / (na + nb)
    most = np.minimum(u / v, v / u)
    best, at = np.full(len(a), -np.inf), np.zeros(len(a))

    def chance(x):
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    for share in _GRID:
        j = share * most
        p, q = chance(u - v * j), chance(v - u * j)
        fit = above * np.log(np.maximum(p, 1e-12)) + below * np.log(np.maximum(q, 1e-12)) + same * np.log(np.maximum(1 - p - q, 1e-12))
        at, best = np.where(fit > best, j, at), np.maximum(fit, best)
    return at


def _screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 4096):
            part = batch.slice(lo, 4096)
            a, b = (np.frombuffer(b"".join(part.column(c).to_pylist()), "<u2").reshape(-1, REGISTERS) for c in ("sa", "sb"))
            na, nb = (part.column(c).to_numpy().astype(float) for c in ("na", "nb"))
            likely = pa.array(joint_similarity(a, b, na, nb) >= SCREEN)
            yield part.select(["a", "b", "ka", "kb"]).filter(likely)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "ta"):
        left, right = ((shingle_sets(t), t.hashes(_TEXT_KEY, fold=True), t.first) for t in (Tokens(batch.column("ta")), Tokens(batch.column("tb"))))
        good = []
        for s, t in zip(left[0], right[0], strict=True):
            common = len(np.intersect1d(s, t, assume_unique=True))
            good.append(100 * common >= PERCENT * (len(s) + len(t) - common) and common > 0)
        yield batch.select(["a", "b"]).filter(pa.array(good))


def _coordinates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's shingles (space 0), and for texts near their pivot what the two sets don't share (apart, space = pivot).

    size is the number of elements of a text in its space; near and family tell texts near one pivot from the rest. Ids
    may be any number.
    """
    for batch in slices(batches, "text"):
        sets, pivots = (shingle_sets(Tokens(batch.column(c))) for c in ("text", "pivot_text"))
        cols = {c: batch.column(c).to_numpy() for c in ("rep", "component", "n_shingles", "pivot", "pivot_component")}
        out = {c: [] for c in ("apart", "space", "rep", "component", "near", "family", "n_shingles", "size", "pivot_size", "linked", "shingle")}
        for i, (own, pivot) in enumerate(zip(sets, pivots, strict=True)):
            apart = np.setxor1d(own, pivot, assume_unique=True)
            near = 3 * len(apart) <= len(own) + len(pivot)  # similarity 0.5 or more
            component, top = cols["component"][i], cols["pivot"][i]
            family = top if near else component
            for differs, space, elements in ((False, 0, own), (True, top, apart))[: 1 + near]:
                n = len(elements)
                fixed = (differs, space, cols["rep"][i], component, near, family, len(own), n, len(pivot), component == cols["pivot_component"][i])
                for c, v in zip(out, fixed, strict=False):
                    out[c].append(np.full(n, v))
                out["shingle"].append(elements.view(np.int64))
        if sets:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(v)) for v in out.values()], names=list(out))


_COORDINATES = "apart boolean, space long, rep long, component long, near boolean, family long, n_shingles long, size long, pivot_size long, linked boolean, shingle long"


def _linked(pairs: DataFrame, reps: DataFrame, docs: DataFrame) -> DataFrame:
    """Of pairs (a, b), those whose full sets are similar enough. Many pairs may share an id: that of a central text."""
    pairs = materialize(pairs, "pairs")
    size = reps.select("rep", "n_shingles", "sketch", "key")
    left = size.select(F.col("rep").alias("a"), F.col("n_shingles").alias("na"), F.col("sketch").alias("sa"), F.col("key").alias("ka"))
    right = size.select(F.col("rep").alias("b"), F.col("n_shingles").alias("nb"), F.col("sketch").alias("sb"), F.col("key").alias("kb"))
    fits = 100 * F.least("na", "nb") >= PERCENT * F.greatest("na", "nb")
    near = spread_pairs(right, spread_pairs(left, pairs, ["a"]), ["b"], pairs).where(fits).mapInArrow(_screen, "a long, b long, ka binary, kb binary").select("a", "b")
    near = materialize(near, "near-pairs")
    texts = docs.select("doc_id", "text")
    first = spread_pairs(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta")), near, ["a"])
    both = spread_pairs(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb")), first, ["b"], near)
    return both.select("a", "b", "ta", "tb").mapInArrow(_verify, "a long, b long")


def _open_members(members: DataFrame, found: DataFrame) -> DataFrame:
    """Members of buckets that hold more than one component; buckets of two were settled by their only pair."""
    label = members.where("n > 2").join(found, members["rep"] == found["node"], "left").select("bucket", "rep", F.coalesce("component", "rep").alias("component"))
    label = materialize(label, "labels")
    apart = label.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("n")).where("lo < hi").select("bucket", "n")
    return materialize(spread_join(label, apart, ["bucket"]), "open-members")


def _joined(found: DataFrame, links: DataFrame) -> DataFrame:
    """Components after more links."""
    links = materialize(links, "links")
    if not links.limit(1).count():
        return found
    return components(found.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(links))


def _rare_pairs(open_: DataFrame, docs: DataFrame) -> DataFrame:
    """Pairs of different components that may be similar enough: an exact filter, without bands.

    open_: rep, component, n_shingles, pivot, pivot_component. Elements are ordered by how many texts hold them, the
    rarest first; two sets that must share o elements share one of the first size - o + 1 of each.

    Texts of different families are compared by their shingles: o is 0.75 of the larger set at least. Texts near one
    pivot c differ from each other by exactly what their differences to c don't share, and similarity 0.75 allows
    (n + m) / 7 such elements. At least one of the two, x, isn't linked to c, so its difference alone is over
    (n + |c|) / 7, and the other must share more than half of its own difference with x. Passages that a whole group
    shares are no part of the differences, so a group of copies doesn't meet in them.
    """
    key = lambda c: docs.select(F.col("doc_id").alias(c), F.col("text").alias("text" if c == "rep" else "pivot_text"))
    texts = spread_pairs(key("pivot"), open_.join(key("rep"), "rep"), ["pivot"], open_).select("rep", "component", "n_shingles", "pivot", "pivot_component", "text", "pivot_text")
    rows = materialize(texts.mapInArrow(_coordinates, _COORDINATES), "coordinates")
    held = rows.groupBy("apart", "space", "shingle").agg(F.count("*").alias("held"), F.count("*").alias("n")).where("held > 1")
    own = Window.partitionBy("apart", "space", "rep")
    common = spread_join(rows, held, ["apart", "space", "shingle"]).withColumns({"_at": F.row_number().over(own.orderBy("held", "shingle")), "_common": F.count("*").over(own)})
    # elements that no other text holds come first
    placed = materialize(common.withColumn("at", F.col("_at") + F.col("size") - F.col("_common")).drop("_at", "_common", "held"), "placed")

    # different families: a shingle's largest family meets the others, never itself
    prefix = F.col("size") - F.floor((PERCENT * F.col("size") + 99) / 100) + 1
    rare = placed.where(~F.col("apart") & (F.col("at") <= prefix)).select("shingle", "rep", "component", F.struct("near", "family").alias("family"), "n_shingles")
    parts = rare.groupBy("shingle", "family").agg(F.count("*").alias("n"))
    largest = parts.groupBy("shingle").agg(F.max(F.struct("n", "family")).alias("top"), F.count("*").alias("parts"), F.sum("n").alias("n")).where("parts > 1").select("shingle", F.col("top.family").alias("largest"), "n")
    rare = spread_join(rare, largest, ["shingle"])
    x, y = (rare.select("shingle", "largest", F.col("rep").alias(c), F.col("component").alias(f"c{c}"), F.col("family").alias(f"f{c}"), F.col("n_shingles").alias(f"n{c}")) for c in "xy")
    meets = (F.col("fx") != F.col("fy")) & (F.col("cx") != F.col("cy")) & ((F.col("fy") == F.col("largest")) | (F.col("x") < F.col("y"))) & (100 * F.least("nx", "ny") >= PERCENT * F.greatest("nx", "ny"))
    across = spread_pairs(x.where("fx <> largest"), y.drop("largest"), ["shingle"]).where(meets).select("x", "y")

    # one family: texts that aren't linked to the pivot meet the rarer half of each other difference
    inside = placed.where("apart")
    least = F.floor((7 * F.col("size") + F.col("pivot_size") - F.col("n_shingles")) / 14) + 1
    side = lambda c: [F.col("rep").alias(c), F.col("component").alias(f"c{c}"), F.col("n_shingles").alias(f"n{c}"), F.col("size").alias(f"s{c}"), F.col("at").alias(f"a{c}")]
    loose = inside.where("not linked").select("space", "shingle", *side("x"))
    half = inside.where(F.col("at") <= F.col("size") - F.greatest(least, F.lit(1)) + 1).select("space", "shingle", *side("y"))
    needed = F.greatest(F.floor((7 * (F.col("sx") + F.col("sy")) - F.col("nx") - F.col("ny") + 13) / 14), F.lit(1))
    meets = (F.col("cx") != F.col("cy")) & (F.col("ax") <= F.col("sx") - needed + 1) & (F.col("ay") <= F.col("sy") - needed + 1)
    within = spread_pairs(loose, half, ["space", "shingle"]).where(meets).select("x", "y")
    return across.unionByName(within).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each row of docs.

    Texts are lower-cased (A-Z) and cut at ASCII white space; a set holds the distinct 5-word shingles, or the whole
    sequence if it is shorter. Sets of similarity 0.75 or more are linked; component_id is the smallest doc_id
    reachable, and the document with that id is kept. Texts without words, and null texts, are linked with nothing.
    Rows that repeat a doc_id count as one document even if their texts differ: they share a component. A row with a
    null doc_id is never linked, has a null component_id and is kept. Other columns are ignored.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = materialize(sketches(docs), "sketches")
    known = rows.where("doc_id is not null and key is not null")
    reps = known.groupBy("key").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch"), F.count("*").alias("copies"))
    reps = materialize(reps, "classes")

    width = 2 * ROWS
    bands = F.array(*[F.xxhash64(F.lit(i), F.substring("sketch", i * width + 1, width)) for i in range(BANDS)])
    banded = reps.select("rep", F.explode(bands).alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket", "n", F.col("n").alias("size"))
    members = materialize(spread_join(banded, shared, ["bucket"]).withColumnRenamed("size", "n"), "bands")

    # first each bucket's most central member against the others of the bucket: one pair for each member
    central = members.groupBy("rep").agg(F.sum("n").alias("weight"))
    weighed = members.join(central, "rep")
    pivots = weighed.groupBy("bucket").agg(F.max(F.struct("weight", (-F.col("rep")).alias("rep"))).alias("top"), F.first("n").alias("n")).select("bucket", F.col("top.weight").alias("weight"), (-F.col("top.rep")).alias("pivot"), F.col("n").alias("_rows"))
    around = materialize(spread_join(members, pivots, ["bucket"], "_rows"), "around")
    starred = around.where("rep <> pivot").select(F.least("rep", "pivot").alias("a"), F.greatest("rep", "pivot").alias("b"))
    starred = materialize(starred.distinct(), "starred")
    found = components(materialize(_linked(starred, reps, docs), "star-links"))

    # then whatever is still apart in a bucket, by an exact filter
    open_ = _open_members(members, found)
    if open_.limit(1).count():
        main = around.groupBy("rep").agg(F.max(F.struct("weight", "pivot"))["pivot"].alias("pivot"))
        whose = found.select(F.col("node").alias("pivot"), F.col("component").alias("_own"))
        open_ = open_.select("rep", "component").distinct().join(reps.select("rep", "n_shingles"), "rep").join(main, "rep")
        open_ = open_.join(whose, "pivot", "left").withColumn("pivot_component", F.coalesce("_own", "pivot")).drop("_own")
        rest = _rare_pairs(materialize(open_, "open"), docs).join(starred, ["a", "b"], "left_anti")
        found = _joined(found, _linked(rest, reps, docs))

    classes = reps.join(found, reps["rep"] == found["node"], "left").select("key", F.coalesce("component", "rep").alias("component_id"), "copies")
    linked = spread_join(rows.where("doc_id is not null and key is not null"), classes, ["key"], "copies").select("doc_id", "n_shingles", "component_id")
    alone = rows.where("doc_id is null or key is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of docs whose document stays: one of each group of near duplicates.

    Rows with a null doc_id stay; rows that repeat a doc_id share its fate. All columns pass through.
    """
    fate = materialize(near_duplicates(docs).where("not kept").select("doc_id").distinct(), "duplicates")
    return docs.join(fate, "doc_id", "left_anti").select(*[f"`{c}`" for c in docs.columns])


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text"))


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) END AS shingles
  FROM w),
n AS (SELECT doc_id, len(shingles)::BIGINT AS n FROM s),
e AS (SELECT doc_id, unnest(shingles) AS shingle FROM s),
c AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
  FROM e AS x JOIN e AS y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY ALL),
l AS (
  SELECT a, b FROM c JOIN n AS p ON p.doc_id = a JOIN n AS q ON q.doc_id = b
  WHERE 100 * common >= 75 * (p.n + q.n - common)),
reach AS (
  SELECT doc_id AS root, doc_id AS node FROM n
  UNION
  SELECT root, b FROM reach JOIN l ON node = a)
SELECT n.doc_id, n.n AS n_shingles, m.component_id, n.doc_id = m.component_id AS kept
FROM n JOIN (SELECT root, min(node) AS component_id FROM reach GROUP BY root) AS m ON n.doc_id = m.root
"""
