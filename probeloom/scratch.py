"""The shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Paths made since the innermost temporary_tables() began.
_MADE: ContextVar[list[str] | None] = ContextVar("made", default=None)


def scratch_root(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session. Where it is unset, a temporary folder, on a local master only.

    On a cluster executors would write to a folder of their own machines, so the setting is required there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="spark-scratch-")
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared scratch folder; what is written there goes when the application ends."""
    jvm = spark.sparkContext._jvm
    top = f"{scratch_root(spark)}/probeloom-{spark.sparkContext.applicationId}"
    path = jvm.org.apache.hadoop.fs.Path(top)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return f"{top}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet below the shared scratch folder and read it back: cuts lineage, survives lost executors."""
    target = scratch_path(df.sparkSession, name)
    df.write.parquet(target)
    made = _MADE.get()
    if made is not None:
        made.append(target)
    return df.sparkSession.read.schema(df.schema).parquet(target)


def delete_path(spark: SparkSession, target: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[list[str]]:
    """Tables that materialize() writes inside are deleted at the end: nothing may read them afterwards. Gives their paths, the last one last."""
    made: list[str] = []
    token = _MADE.set(made)
    try:
        yield made
    finally:
        _MADE.reset(token)
        for target in made:
            delete_path(spark, target)


def last_table(spark: SparkSession, make: Callable[[], DataFrame]) -> DataFrame:
    """What make() returns, the table that it writes last; the others that it writes are deleted."""
    with temporary_tables(spark) as made:
        out = make()
        last = made.pop()
    outer = _MADE.get()
    if outer is not None:
        outer.append(last)
    return out
