"""Operators for large text corpora: deduplication, extraction, decontamination, mixing, sharding and labelling."""
