"""Portable microhaplotype documents: representative and detected haplotypes and the panel, as nested columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def pmo_representatives(calls: DataFrame, order: str = "ord") -> DataFrame:
    """locus, sequence and id 'locus.i', counted by first appearance within the locus."""
    first = calls.groupBy("locus", "sequence").agg(F.min(order).alias("_first"))
    place = F.row_number().over(Window.partitionBy("locus").orderBy("_first", "sequence")) - 1
    return first.select("locus", "sequence", F.concat_ws(".", "locus", place).alias("microhaplotype_id"))


def pmo_detected(calls: DataFrame, representatives: DataFrame, extra: Sequence[str] = (), order: str = "ord") -> DataFrame:
    """sample_id and targets: map of locus to map of haplotype id to its counts; the last of repeated rows wins."""
    last = calls.groupBy("sample_id", "locus", "sequence").agg(F.max(F.struct(order, "read_count", *extra)).alias("r"))
    named = last.join(representatives, ["locus", "sequence"])
    value = F.struct(F.col("r.read_count").alias("read_count"), *[F.col(f"r.{c}").alias(c) for c in extra])
    entries = lambda k, v: F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col(k).alias("key"), v.alias("value")))))
    by_locus = named.groupBy("sample_id", "locus").agg(entries("microhaplotype_id", value).alias("haplotypes"))
    locus = F.collect_list(F.struct(F.col("locus").alias("key"), F.col("haplotypes").alias("value")))
    return by_locus.groupBy("sample_id").agg(F.map_from_entries(F.array_sort(locus, lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0))).alias("targets"))


def pmo_panel(arms: DataFrame) -> DataFrame:
    """Per target: gene, and sorted lists of its forward and reverse primers."""
    listed = lambda c: F.sort_array(F.collect_set(c))
    return arms.groupBy("target_id").agg(F.min("gene_id").alias("gene_id"), listed("forward_primer").alias("forward_primers"), listed("reverse_primer").alias("reverse_primers"))


def pmo_checks(arms: DataFrame, unique: Sequence[str], locations: Sequence[str], required: Sequence[str]) -> DataFrame:
    """Targets with more than one value of an attribute that must be single. Columns are checked first."""
    missing = [c for c in required if c not in arms.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    present = [c for c in locations if c in arms.columns]
    if present and len(present) != len(locations):
        raise ValueError(f"location columns come together: {sorted(set(locations) - set(present))} are missing")
    counts = arms.groupBy("target_id").agg(*[F.countDistinct(c).alias(c) for c in unique])
    return counts.unpivot(["target_id"], list(unique), "attribute", "values").where("values > 1")


def pmo_document(panel: DataFrame, detected: DataFrame, representatives: DataFrame, panel_id: str, run_id: str) -> DataFrame:
    """One JSON text per part row: kind and json. A document is read by joining parts; no task holds all samples."""
    part = lambda df, kind: df.select(F.lit(kind).alias("kind"), F.lit(panel_id).alias("panel_id"), F.lit(run_id).alias("run_id"), F.to_json(F.struct(*df.columns)).alias("json"))
    return part(panel, "panel").unionByName(part(detected, "detected")).unionByName(part(representatives, "representative"))
