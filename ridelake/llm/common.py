"""Helpers shared by the operators of this folder: written work tables, free column names, word pattern."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_path

# The white space that separates words (space, tab to carriage return).
BLANKS = " \t\n\x0b\f\r"


def written(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """``df`` as a Parquet table in the shared work folder, read back. Cuts the
    lineage, survives lost executors, and gives the planner real sizes."""
    path = work_path(df.sparkSession, name)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with underscores in front until no column of ``df`` is called so
    (column names are compared without case, as Spark does)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def words(text: Column) -> Column:
    """The words of ``text`` (runs without blanks), an empty array for null or blank text."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[ \\t-\\r]+"))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
