"""Sharding on a consistent-hash ring with virtual nodes and bounded loads."""

from __future__ import annotations

from collections import deque

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import free_prefix, read

N_SHARDS = 24
VIRTUAL_NODES = 64


def ring_nodes(spark: SparkSession, n_shards: int, virtual_nodes: int) -> tuple[int, list[tuple[int, int]]]:
    """The ring's number of cells, and (cell, shard) of each virtual node clockwise. Their number is fixed by the arguments."""
    cells = 1 << (8 * n_shards * virtual_nodes - 1).bit_length()
    node = spark.range(n_shards * virtual_nodes).select((F.col("id") % n_shards).cast("int").alias("shard"), F.floor(F.col("id") / n_shards).alias("v"))
    placed = node.select("shard", F.pmod(F.xxhash64(F.lit("node"), "shard", "v"), F.lit(cells)).cast("int").alias("cell"), F.xxhash64("v", "shard").alias("tie"))
    return cells, [(r["cell"], r["shard"]) for r in sorted(placed.collect(), key=lambda r: (r["cell"], r["tie"]))]


def fill_ring(counts: dict[int, int], nodes: list[tuple[int, int]], n_shards: int) -> list[tuple[int, int, int, int, int]]:
    """Which rows of each cell go where: (cell, first rank, end rank, shard, first slot).

    Works on the counts by cell alone, so its size is fixed by the ring and not by the data. Walks clockwise: a node
    takes what waits for it until its shard is full, and the rest continues to the next node. Every shard's load is
    bounded by the mean, rounded up for the first (total mod n_shards) shards and down for the others.
    """
    total = sum(counts.values())
    room = [total // n_shards + (s < total % n_shards) for s in range(n_shards)]
    filled = [0] * n_shards
    arrivals: dict[int, list[int]] = {}
    at = 0
    for cell in sorted(counts):
        while at < len(nodes) and nodes[at][0] < cell:
            at += 1
        arrivals.setdefault(at % len(nodes), []).append(cell)
    waiting: deque[list[int]] = deque()
    flows = []
    late = [c for c in arrivals.get(0, []) if c > nodes[0][0]]  # beyond the last node: they wrap around, after all others
    arrivals[0] = [c for c in arrivals.get(0, []) if c <= nodes[0][0]]
    for turn in range(2):
        for i, (_, shard) in enumerate(nodes):
            if not turn:
                waiting.extend([c, 0, counts[c]] for c in arrivals.get(i, []))
            while waiting and room[shard]:
                head = waiting[0]
                n = min(room[shard], head[2] - head[1])
                flows.append((head[0], head[1], head[1] + n, shard, filled[shard]))
                head[1] += n
                filled[shard] += n
                room[shard] -= n
                if head[1] == head[2]:
                    waiting.popleft()
        if not turn:
            waiting.extend([c, 0, counts[c]] for c in late)
    return flows


def shard(docs: DataFrame, keys: list[Column], n_shards: int = N_SHARDS, virtual_nodes: int = VIRTUAL_NODES) -> DataFrame:
    """Each row of docs with shard (int) and slot (long, gapless from 0 in a shard).

    A row sits on the ring at the hash of its keys and belongs to the next virtual node clockwise; rows for a full
    shard continue clockwise. Shards' row counts differ by one at most. Rows are ordered on the ring by cell, then by
    hash; rows with equal keys are interchangeable, and each gets a slot of its own. Nulls hash like any value. An
    empty table gives no rows. Clashing columns named shard or slot are replaced.
    """
    cells, nodes = ring_nodes(docs.sparkSession, n_shards, virtual_nodes)
    spark, prefix = docs.sparkSession, free_prefix(docs)
    at, cell, rank, to, lo, hi, first = (f"{prefix}{x}" for x in ("hash", "cell", "rank", "to", "lo", "hi", "slot"))
    placed = docs.withColumn(at, F.xxhash64(F.lit("key"), *keys)).withColumn(cell, F.pmod(at, F.lit(cells)).cast("int"))
    counts = {r[cell]: r["n"] for r in placed.groupBy(cell).agg(F.count("*").alias("n")).collect()}
    flows = fill_ring(counts, nodes, n_shards)
    plan = spark.createDataFrame(flows, f"{to} int, {lo} long, {hi} long, shard int, {first} long")
    ranked = placed.withColumn(rank, F.row_number().over(Window.partitionBy(cell).orderBy(at, *keys)) - F.lit(1)).drop("shard", "slot")
    # the plan has at most one row for each cell and one for each node: the ring bounds its size
    rows = ranked.join(F.broadcast(plan), (F.col(cell) == F.col(to)) & (F.col(rank) >= F.col(lo)) & (F.col(rank) < F.col(hi)))
    return rows.withColumn("slot", F.col(first) + F.col(rank) - F.col(lo)).drop(at, cell, rank, to, lo, hi, first)


def op6_shard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.coalesce(F.encode("text", "UTF-8"), F.encode(F.lit(""), "UTF-8"))
    docs = read(spark, sf_dir, "documents").select("doc_id", (F.octet_length(raw) + 8).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"), F.lit("rows").alias("law"))
    rows = shard(docs, [F.col("doc_id"), F.col("text_crc32")])
    return rows.select("doc_id", "size", "text_crc32", "law", "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
