"""Queries: operators applied to the star-schema tables, with SQL to compare."""

from . import candidate_queries, copy_number_queries, haplotype_queries, interval_queries, sample_queries, source_queries, variant_queries  # noqa: F401
from .registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
