"""Compression of vectors to short codes: product quantisation with ball k-means in whole numbers."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import delete_path, materialize, scratch_path
from ..spread import spread_join
from .common import read
from .vectors import LARGEST, digest_text, integer_vectors, matrix, packed, squared, unpacked

SCALE, DIMS, PARTS, ENTRIES, ROUNDS = 4096, 64, 8, 16, 6
_STATE = "vec_id long, label string, ints binary, codes binary, position int, entry int, n long, radius long, totals array<long>"


@dataclass
class Balls:
    """Entries of one codebook and what is known of the balls around them.

    between: squared distances of entries; order: by entry, its neighbours by distance; their squared distances sorted.
    A part at distance d from its own entry can only belong to an entry at most 2 * d away from that one.
    """

    entries: np.ndarray
    between: np.ndarray
    order: list[np.ndarray]
    rings: list[np.ndarray]


def balls(entries: np.ndarray, radii: np.ndarray | None) -> Balls:
    """radii: by entry, an upper bound of its parts' distances; only entries closer than twice that are its neighbours."""
    between = np.stack([squared(entries, e) for e in entries]) if len(entries) else np.zeros((0, 0), np.int64)
    order, rings = [], []
    for i in range(len(entries)):
        near = np.array([j for j in np.argsort(between[i], kind="stable") if j != i and (radii is None or between[i, j] <= 4 * radii[i] ** 2)], np.int64)
        order.append(near)
        rings.append(between[i, near])
    return Balls(entries, between, order, rings)


def assign_all(rows: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of each part and its squared distance, all entries measured; ties go to the lower index."""
    code, best = np.zeros(len(rows), np.int64), squared(rows, entries[0])
    for j in range(1, len(entries)):
        distance = squared(rows, entries[j])
        closer = distance < best
        code[closer], best[closer] = j, distance[closer]
    return code, best


def assign_near(rows: np.ndarray, own: np.ndarray, book: Balls) -> tuple[np.ndarray, np.ndarray]:
    """The same, from the entries that parts had before: only what a part's ring leaves is measured.

    A part closer to its entry than half the way to the next neighbour is in the stable core and keeps it unmeasured.
    Others have as candidates the neighbours up to twice their distance, the rings inside their own.
    """
    code, best = own.copy(), squared(rows, book.entries[own])
    for i in range(len(book.entries)):
        if not len(book.order[i]):
            continue
        mine = np.flatnonzero(own == i)
        inside = np.searchsorted(book.rings[i], 4 * best[mine], "right")
        for k, j in enumerate(book.order[i][: inside.max(initial=0)]):
            left = mine[inside > k]
            distance = squared(rows[left], book.entries[j])
            closer = (distance < best[left]) | ((distance == best[left]) & (j < code[left]))
            code[left[closer]], best[left[closer]] = j, distance[closer]
    return code, best


@dataclass
class Compressed:
    """codes: vec_id, label (as text), code (array of one index for each part) and error of each vector; codebooks: part, entry, component."""

    codes: DataFrame
    codebooks: np.ndarray


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, dims: int = DIMS) -> Compressed:
    """Codes and codebooks of vectors (vec_id, embedding and label; other columns are ignored).

    Rows whose vector is null, holds a null or non-finite component or hasn't dims components are dropped; component x
    becomes floor(scale * x), held between -2^27 and 2^27. Codebooks start as the parts of the vectors with the least
    vec_ids (null last, ties by components), fewer if fewer are kept. Rows that repeat a vec_id are vectors like any
    other. Each round is one pass that reads the vectors with the codes of the round before and writes them with the
    new ones; counts, sums and radii by entry are a few rows of each task. Without kept vectors there are no rows.
    """
    spark, wide = vectors.sparkSession, dims // parts
    kept = integer_vectors(vectors, scale, dims, F.col("label").cast("string").alias("label"))
    first = np.array([r["ints"] for r in kept.orderBy(F.col("vec_id").asc_nulls_last(), "ints").limit(entries).collect()], np.int64).reshape(-1, dims)
    books = np.ascontiguousarray(first.reshape(-1, parts, wide).transpose(1, 0, 2))
    radii: np.ndarray | None = None

    def assigned(batch: pa.RecordBatch, known: list[Balls], again: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rows = unpacked(batch.column("ints"), np.int32, dims) if again else matrix(batch.column("ints"))
        rows = rows.astype(np.int64)
        before = unpacked(batch.column("codes"), np.uint8, parts).astype(np.int64) if again else None
        found = [assign_near(x, before[:, p], known[p]) if again else assign_all(x, known[p].entries) for p in range(parts) for x in [rows[:, p * wide : (p + 1) * wide]]]
        return rows, np.stack([c for c, _ in found], axis=1), np.stack([d for _, d in found], axis=1)

    def nulls(n: int, *names: str) -> dict[str, pa.Array]:
        kinds = {"position": pa.int32(), "entry": pa.int32(), "n": pa.int64(), "radius": pa.int64(), "totals": pa.list_(pa.int64()), "vec_id": pa.int64(), "label": pa.string(), "ints": pa.binary(), "codes": pa.binary()}
        return {x: pa.nulls(n, kinds[x]) for x in names}

    def step(batches: Iterator[pa.RecordBatch], known: list[Balls], again: bool) -> Iterator[pa.RecordBatch]:
        names = ["vec_id", "label", "ints", "codes", "position", "entry", "n", "radius", "totals"]
        size = len(known[0].entries)
        count, most, total = np.zeros((parts, size), np.int64), np.zeros((parts, size), np.int64), np.zeros((parts, size, wide), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            rows, codes, far = assigned(batch, known, again)
            for p in range(parts):
                count[p] += np.bincount(codes[:, p], minlength=size)
                np.maximum.at(most[p], codes[:, p], far[:, p])
                for j in np.unique(codes[:, p]):
                    total[p, j] += rows[codes[:, p] == j, p * wide : (p + 1) * wide].sum(0)
            own = {"vec_id": batch.column("vec_id"), "label": batch.column("label"), "ints": packed(rows.astype(np.int32)), "codes": packed(codes.astype(np.uint8))}
            own |= nulls(batch.num_rows, "position", "entry", "n", "radius", "totals")
            yield pa.RecordBatch.from_arrays([own[x] for x in names], names=names)
        p, j = np.nonzero(count)
        if len(p):
            sums = {"position": pa.array(p.astype(np.int32)), "entry": pa.array(j.astype(np.int32)), "n": pa.array(count[p, j]), "radius": pa.array(most[p, j]), "totals": pa.array(list(total[p, j]), pa.list_(pa.int64()))}
            sums |= nulls(len(p), "vec_id", "label", "ints", "codes")
            yield pa.RecordBatch.from_arrays([sums[x] for x in names], names=names)

    state, path = kept, None
    for r in range(rounds):
        if not len(first):
            break
        known = [balls(books[p], None if radii is None else radii[p]) for p in range(parts)]
        target = scratch_path(spark, "codes")
        state.mapInArrow(lambda b, k=known, again=r > 0: step(b, k, again), _STATE).write.parquet(target)
        table = spark.read.schema(_STATE).parquet(target)
        of_entry = table.where("n IS NOT NULL").groupBy("position", "entry")
        sums = of_entry.agg(F.sum("n").alias("n"), F.max("radius").alias("radius"), *[F.sum(F.col("totals")[i].cast("decimal(38,0)")).alias(f"t{i}") for i in range(wide)]).collect()  # one row for each entry at most
        new, radii = books.copy(), np.zeros(books.shape[:2])
        for s in sums:
            new[s["position"], s["entry"]] = [int(s[f"t{i}"]) // s["n"] for i in range(wide)]
            radii[s["position"], s["entry"]] = np.sqrt(s["radius"])
        # parts of an entry are at most as far from it as before and the way that it moved; rounding only widens this
        radii = (radii + np.sqrt([squared(new[p], books[p]) for p in range(parts)])) * (1 + 1e-9) + 1e-6
        if path:
            delete_path(spark, path)
        books, state, path = new, table.where("n IS NULL").select("vec_id", "label", "ints", "codes"), target
    known = [balls(books[p], None if radii is None else radii[p]) for p in range(parts)]
    again = radii is not None

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and len(known[0].entries):
                _, codes, far = assigned(batch, known, again)
                code = pa.ListArray.from_arrays(pa.array(np.arange(len(codes) + 1, dtype=np.int32) * parts), pa.array(codes.astype(np.int32).ravel()))
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), code, pa.array(far.sum(1))], names=["vec_id", "label", "code", "error"])

    codes = materialize(state.mapInArrow(final, "vec_id long, label string, code array<int>, error long"), "codes")
    if path:
        delete_path(spark, path)
    return Compressed(codes, books)


def rebuilt(code: Column, codebooks: np.ndarray) -> Column:
    """The integer vector that a code stands for."""
    books = F.array(*[F.array(*[F.array(*[F.lit(int(x)) for x in entry]) for entry in book]) for book in codebooks])
    return F.flatten(F.transform(code, lambda c, p: books[p][c]))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = compress(read(spark, sf_dir, "embeddings"))
    rows = found.codes.select("vec_id", F.coalesce("label", F.lit("")).alias("label"), F.col("label").isNull().alias("unlabelled"), "code", "error")
    by_label = rows.groupBy("label", "unlabelled").agg(F.sum("error").alias("label_error"), F.count("*").alias("n"))
    digest = hashlib.sha256(digest_text(found.codebooks).encode()).hexdigest()
    code = F.array_join(F.transform("code", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    return spread_join(rows, by_label, ["label", "unlabelled"]).select("vec_id", code.alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _oracle() -> str:
    """Unrolled rounds over long tables: one row per vector, part and component."""
    wide = DIMS // PARTS
    steps = [
        f"""kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: greatest(-{LARGEST}, least({LARGEST}, floor({SCALE} * x::DOUBLE)))::BIGINT) AS v
  FROM embeddings WHERE len(embedding) = {DIMS} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"long AS MATERIALIZED (SELECT vec_id, (place // {wide})::INTEGER AS p, (place % {wide})::INTEGER AS i, v[place + 1] AS x FROM kept, (SELECT unnest(range({DIMS})) AS place))",
        f"""c0 AS MATERIALIZED (SELECT j, p, i, x AS y FROM long JOIN (
  SELECT vec_id, row_number() OVER (ORDER BY vec_id, v) - 1 AS j FROM kept QUALIFY j < {ENTRIES}) USING (vec_id))""",
    ]
    for t in range(ROUNDS + 1):
        steps.append(f"d{t} AS MATERIALIZED (SELECT vec_id, p, j, sum((x - y) * (x - y))::BIGINT AS d FROM long JOIN c{t} USING (p, i) GROUP BY vec_id, p, j)")
        steps.append(f"a{t} AS MATERIALIZED (SELECT vec_id, p, j, d FROM d{t} QUALIFY row_number() OVER (PARTITION BY vec_id, p ORDER BY d, j) = 1)")
        if t < ROUNDS:
            steps.append(f"s{t} AS MATERIALIZED (SELECT j, p, i, sum(x) AS s, count(*) AS n FROM long JOIN a{t} USING (vec_id, p) GROUP BY j, p, i)")
            steps.append(f"c{t + 1} AS MATERIALIZED (SELECT j, p, i, CASE WHEN n IS NULL THEN y ELSE ((s - ((s % n) + n) % n) // n)::BIGINT END AS y FROM c{t} LEFT JOIN s{t} USING (j, p, i))")
    return f"""WITH {", ".join(steps)},
book AS (SELECT sha256(string_agg(y::VARCHAR, ',' ORDER BY p, j, i)) AS codebooks_sha256 FROM c{ROUNDS}),
coded AS (SELECT vec_id, string_agg(printf('%02x', j::INTEGER), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a{ROUNDS} GROUP BY vec_id)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM coded JOIN kept USING (vec_id), book"""


ORACLE = _oracle()
