"""A local session for tests, tools and benchmarks; clusters bring their own."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cores: int | None = None, memory: str = "8g", partitions: int | None = None) -> SparkSession:
    cores = cores or int(os.environ.get("BENCH_CPUS", 8))
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("probeloom")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions or cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
