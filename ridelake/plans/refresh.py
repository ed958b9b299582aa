"""Gold kept up to date: partial aggregates per source, added up.

What the marts share (hourly profile, zone pairs, price cells, fee sums) are sums and counts, so the
aggregate of all trips is the sum of its sources' parts. The parts of every source (type, month of the bronze
file) are stored below the gold folder, ``_parts/<name>/vtype=/source_month=``, with a ledger of each source's silver files
as they were. A refresh compares the ledger with the silver table's listing, reads the
trips of changed sources only, replaces their parts, removes those of sources that are gone, and
builds the marts from the parts, whose size is bounded by the calendar and the zones, not by the trips. The ledger is
written last: a refresh that stops half way is done again.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import files
from ..sources.lake import parquet_files
from ..sources.versions import has_table, read_table, replace_table
from . import marts as M
from .gold import write_gold
from .silver import SOURCE_COL

SOURCE = ("vtype", SOURCE_COL)
# name: (builder, its own keys, what is added up)
PARTS = {
    "profile": (lambda t: M.hourly_profile(t, (SOURCE_COL,)), ("vtype", "ts"), ("n_all", "n_zone", "s", "n")),
    "pairs": (lambda t: M.zone_pairs(t, SOURCE), ("pickup_location_id", "dropoff_location_id"), ("n_all", "n_scope")),
    "cells": (lambda t: M.price_cells(t, SOURCE), ("zone", "y", "m", "bin"), ("n",)),
    "fees": (lambda t: M.fee_sums(t, (SOURCE_COL,)), ("y", "m", "vtype"), tuple(f"{n}_{c}" for c in M.FEE_AVG_COLS for n in ("sum", "n"))),
}


def source_states(spark: SparkSession, silver_path: str) -> DataFrame:
    """``vtype, source_month, files, state``: each source's silver files, as a number and a digest of paths, lengths and times."""
    listed = parquet_files(spark, silver_path)
    return listed.groupBy(F.col("vtype").cast("string").alias("vtype"), F.col(SOURCE_COL).cast("string").alias(SOURCE_COL)).agg(
        F.count(F.lit(1)).alias("files"), F.bit_xor(F.xxhash64("path", "length", "modificationTime")).alias("state"))


def trips_of(spark: SparkSession, silver_path: str, sources: list[tuple[str, str]]) -> DataFrame:
    """The trips of some sources, by partition filters: no file of another source is read."""
    months: dict[str, list[str]] = {}
    for vtype, month in sources:
        months.setdefault(vtype, []).append(month)
    wanted = [(F.col("vtype") == v) & F.col(SOURCE_COL).isin(ms) for v, ms in sorted(months.items())]
    return spark.read.parquet(silver_path).where(reduce(lambda a, b: a | b, wanted))


def refresh_parts(spark: SparkSession, silver_path: str, root: str) -> tuple[list[tuple[str, str]], list[tuple[str, str]]]:
    """Bring the parts below ``root`` up to date; the sources that were read, and those that are gone."""
    ledger, now = f"{root}/_sources", source_states(spark, silver_path).checkpoint()
    was = read_table(spark, ledger) if has_table(spark, ledger) else now.limit(0)
    # one row a type and month
    changed = [tuple(r) for r in now.join(was, list(now.columns), "left_anti").select(*SOURCE).collect()]
    gone = [tuple(r) for r in was.join(now, list(SOURCE), "left_anti").select(*SOURCE).collect()]
    if changed:
        trips = trips_of(spark, silver_path, changed)
        for name, (build, _, _) in PARTS.items():
            # dealt by source: a file or two a source, not one a task and source
            (build(trips).hint("rebalance", *SOURCE).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                .partitionBy(*SOURCE).parquet(f"{root}/{name}"))
    for vtype, month in gone:
        for name in PARTS:
            files.remove(spark, f"{root}/{name}/vtype={vtype}/{SOURCE_COL}={month}")
    if changed or gone:
        replace_table(now, ledger)
    return changed, gone


def merged(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The aggregate of all trips from its sources' parts."""
    _, keys, sums = PARTS[name]
    return spark.read.parquet(f"{root}/{name}").groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])


def refresh_gold(spark: SparkSession, silver_path: str, zones: DataFrame, weather: DataFrame, gold: str) -> int:
    """Bring all marts of ``gold`` up to date with the silver table (partitioned by ``source_month``) and the
    given zones and weather; the number of sources whose trips were read. Same tables as ``write_gold``."""
    root = f"{gold.rstrip('/')}/_parts"
    changed, _ = refresh_parts(spark, silver_path, root)
    write_gold(spark, None, zones, weather, gold, given={
        "profile": lambda: merged(spark, root, "profile"), "pairs": lambda: merged(spark, root, "pairs"),
        "hist": lambda: M.price_histogram_from_cells(merged(spark, root, "cells"), zones),
        "monthly": lambda: M.fees_from_sums(merged(spark, root, "fees"))})
    return len(changed)
