"""Tables that are replaced as a whole, and never half.

A write goes into a folder of its own, ``<path>/_versions/<name>``; only when it is complete does the pointer file
``<path>/_current`` name it, by a rename over the old one. Readers follow the pointer: one that
started before the change reads the version before, which stays until the write after the next. A
write that fails leaves the table as it was, and its remains go with the next write that succeeds. One writer at a time.
A table without a pointer (written before, or by another tool) is read as it stands."""
from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from . import files

POINTER, VERSIONS = "_current", "_versions"
KEEP = 2       # versions that stay: the current one, and the one that running readers may still read


def table_path(spark: SparkSession, path: str) -> str:
    """Where the current version of the table stands."""
    root = path.rstrip("/")
    name = files.read_text(spark, f"{root}/{POINTER}")
    return f"{root}/{VERSIONS}/{name}" if name else root


def has_table(spark: SparkSession, path: str) -> bool:
    """Whether a table was ever written at ``path``."""
    root = path.rstrip("/")
    return files.exists(spark, f"{root}/{POINTER}") or any(not n.startswith(("_", ".")) for n in files.names(spark, root))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(table_path(spark, path))


def replace_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Write ``df`` as the table's next version. ``df`` may read the table itself."""
    spark, root = df.sparkSession, path.rstrip("/")
    name = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"          # in order of time
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{root}/{VERSIONS}/{name}")
    before = files.read_text(spark, f"{root}/{POINTER}")
    files.replace_text(spark, f"{root}/{POINTER}", name)
    kept = {name, before} if KEEP > 1 else {name}
    for old in files.names(spark, f"{root}/{VERSIONS}") - kept:
        # a version newer than this one is another writer's, still at work
        if not old.startswith(".") and old < name:
            files.remove(spark, f"{root}/{VERSIONS}/{old}")
    for old in files.names(spark, root):
        if not old.startswith(("_", ".")) or old == "_SUCCESS":      # the table as it was before it had versions
            files.remove(spark, f"{root}/{old}")
