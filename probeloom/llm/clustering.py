"""Centroid clustering of integer vectors with a table of distances to fixed pivots."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import materialize
from .common import read
from .vectors import LARGEST, digest_text, integer_vectors, matrix, packed, squared, unpacked

SCALE, DIMS, CLUSTERS, ROUNDS = 64, 64, 16, 3
#: So many pivots, chosen among so many vectors at most; the choice changes no result.
PIVOTS, PIVOT_SAMPLE = 8, 256
#: Distances are square roots in floating point: bounds give way by this share of them.
_SLACK = 1e-9


@dataclass
class Clusters:
    """assigned: vec_id, cluster and distance (squared) of each vector; centroids: their integer components, by number."""

    assigned: DataFrame
    centroids: np.ndarray


def choose_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Vectors of the sample far from each other: each next one has the greatest sum of distances to those before."""
    if not len(sample):
        return sample
    chosen, total = [0], np.sqrt(squared(sample, sample[0]))
    while len(chosen) < min(count, len(sample)):
        total[chosen] = -1
        chosen.append(int(total.argmax()))
        total += np.sqrt(squared(sample, sample[chosen[-1]]))
    return sample[chosen]


def to_pivots(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.stack([np.sqrt(squared(rows, p)) for p in pivots], axis=1)


def nearest(rows: np.ndarray, far: np.ndarray, centroids: np.ndarray, far_centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and exact squared distance of each row's nearest centroid; ties go to the smaller number.

    far: distances to the pivots. A centroid is at least as far from a row as their distances to any pivot differ, so
    only centroids whose bound isn't above the best distance so far are measured; the least bound comes first.
    """
    n = len(rows)
    bound = np.zeros((n, len(centroids)))
    for p in range(far.shape[1]):
        differ = np.abs(far[:, p, None] - far_centroids[None, :, p]) - _SLACK * (far[:, p, None] + far_centroids[None, :, p])
        np.maximum(bound, differ, out=bound)
    bound *= bound
    cluster = bound.argmin(1)
    best = squared(rows, centroids[cluster])
    first = cluster.copy()
    for j in range(len(centroids)):
        left = np.flatnonzero((bound[:, j] <= best) & (first != j))
        distance = squared(rows[left], centroids[j])
        closer = (distance < best[left]) | ((distance == best[left]) & (j < cluster[left]))
        cluster[left[closer]], best[left[closer]] = j, distance[closer]
    return cluster, best


def cluster_vectors(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, scale: int = SCALE, dims: int = DIMS) -> Clusters:
    """k-means in whole numbers of vectors (vec_id and embedding; other columns are ignored).

    Only vectors of dims components, none null or not finite, are kept; component x becomes floor(scale * x), held
    between -2^27 and 2^27. The first centroids are the vectors with the least sha256 of '1:<vec_id>' (a null vec_id
    counts as an empty text; ties by components), fewer if fewer are kept. Rows that repeat a vec_id are vectors like
    any other. A table of each vector's distances to fixed pivots is written once; each round reads it, and only counts
    and sums by centroid leave the tasks. Without kept vectors there are no rows and no centroids.
    """
    kept = integer_vectors(vectors, scale, dims)
    key = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = np.array([r["ints"] for r in kept.select(key.alias("key"), "ints").orderBy("key", "ints").limit(max(clusters, PIVOT_SAMPLE)).collect()], np.int64).reshape(-1, dims)
    centroids, pivots = first[:clusters], choose_pivots(first[:PIVOT_SAMPLE], PIVOTS)
    width = len(pivots)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and width:
                rows = matrix(batch.column("ints"))
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), packed(rows.astype(np.int32)), packed(to_pivots(rows, pivots))], names=["vec_id", "ints", "far"])

    table = materialize(kept.mapInArrow(measured, "vec_id long, ints binary, far binary"), "pivot-distances")

    def assigned(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
        away = to_pivots(centroids, pivots) if width else None
        for batch in batches:
            if batch.num_rows:
                rows = unpacked(batch.column("ints"), np.int32, dims).astype(np.int64)
                yield batch, rows, *nearest(rows, unpacked(batch.column("far"), np.float64, width), centroids, away)

    def sums(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(len(centroids), np.int64), np.zeros((len(centroids), dims), np.int64)
        for _, rows, cluster, _ in assigned(batches, centroids):
            count += np.bincount(cluster, minlength=len(count))
            for j in np.unique(cluster):
                total[j] += rows[cluster == j].sum(0)
        used = np.flatnonzero(count)
        each = [pa.array(np.repeat(used, dims).astype(np.int32)), pa.array(np.tile(np.arange(dims, dtype=np.int32), len(used))), pa.array(np.repeat(count[used], dims)), pa.array(total[used].ravel())]
        yield pa.RecordBatch.from_arrays(each, names=["cluster", "place", "n", "total"])

    for _ in range(rounds):
        found = table.mapInArrow(lambda b, c=centroids: sums(b, c), "cluster int, place int, n long, total long")
        new = centroids.copy()
        for r in found.groupBy("cluster", "place").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect():  # at most clusters * dims rows
            new[r["cluster"], r["place"]] = int(r["total"]) // r["n"]
        centroids = new

    def final(batches: Iterator[pa.RecordBatch], centroids: np.ndarray = centroids) -> Iterator[pa.RecordBatch]:
        for batch, _, cluster, distance in assigned(batches, centroids):
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(cluster.astype(np.int32)), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    return Clusters(materialize(table.mapInArrow(final, "vec_id long, cluster int, distance long"), "clusters"), centroids)


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cluster_vectors(read(spark, sf_dir, "embeddings"))
    inertia = {r["cluster"]: r["s"] for r in found.assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    whole = sum(inertia.values())
    names = [(j, inertia.get(j, 0), whole, hashlib.sha256(digest_text(c).encode()).hexdigest()) for j, c in enumerate(found.centroids)]
    about = spark.createDataFrame(names, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.assigned.join(F.broadcast(about), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _oracle() -> str:
    """Unrolled rounds over long tables: one row per vector and component."""
    steps = [
        f"""kept AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: greatest(-{LARGEST}, least({LARGEST}, floor({SCALE} * x::DOUBLE)))::BIGINT) AS v
  FROM embeddings WHERE len(embedding) = {DIMS} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        "long AS MATERIALIZED (SELECT vec_id, place, v[place] AS x FROM kept, (SELECT unnest(range(1, 65)) AS place))",
        f"""c0 AS MATERIALIZED (SELECT j, place, v[place] AS y FROM (
  SELECT v, row_number() OVER (ORDER BY sha256('1:' || coalesce(vec_id::VARCHAR, '')), v) - 1 AS j FROM kept QUALIFY j < {CLUSTERS}), (SELECT unnest(range(1, 65)) AS place))""",
    ]
    for t in range(ROUNDS + 1):
        steps.append(f"d{t} AS MATERIALIZED (SELECT vec_id, j, sum((x - y) * (x - y))::BIGINT AS d FROM long JOIN c{t} USING (place) GROUP BY vec_id, j)")
        steps.append(f"a{t} AS MATERIALIZED (SELECT vec_id, j, d FROM d{t} QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, j) = 1)")
        if t < ROUNDS:
            steps.append(f"s{t} AS MATERIALIZED (SELECT j, place, sum(x) AS s, count(*) AS n FROM long JOIN a{t} USING (vec_id) GROUP BY j, place)")
            steps.append(f"c{t + 1} AS MATERIALIZED (SELECT j, place, CASE WHEN n IS NULL THEN y ELSE ((s - ((s % n) + n) % n) // n)::BIGINT END AS y FROM c{t} LEFT JOIN s{t} USING (j, place))")
    last = ROUNDS
    return f"""WITH {", ".join(steps)},
names AS (SELECT j, sha256(string_agg(y::VARCHAR, ',' ORDER BY place)) AS centroid_sha256 FROM c{last} GROUP BY j)
SELECT vec_id, j::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY j))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia, centroid_sha256
FROM a{last} JOIN names USING (j)"""


ORACLE = _oracle()
