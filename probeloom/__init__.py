"""Spark-first operators for targeted-sequencing tables."""
