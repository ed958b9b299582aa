"""Silver build: raw monthly files of any era -> one typed, cleaned, geocoded table.

One plan for all input eras (``unionByName`` of canonical projections), two
lookups against the grid (broadcast when the size check passes), one filter,
one partitioned write. No shuffle at all on the broadcast path (the write
only sorts locally by partition columns); an optional rebalance exists for
unclustered inputs.

Rows are partitioned by pickup month, and a monthly file may hold rides of the
neighbouring month. Batch loads therefore carry the month of the bronze file
each row came from (``source_month``) as the innermost partition level, so
re-running some files replaces exactly those files' rows, wherever their
pickup month put them, and leaves every other file's rows alone.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.columns import hour_number
from ..operators import clean, geo
from ..session import release_shuffles
from ..sources import files
from ..sources.lake import (changed_files, check_layout, file_schemas, listed_files, loaded_files, parquet_files,
                            record_files)


SOURCE_COL = "source_month"
SORT_COL, HOUR_COL, PAGE_ROWS = "pickup_datetime", "pickup_hour", 4096
SILVER_PARTITIONS = ("vtype", "year", "month")


def tag_source(raw: DataFrame, file_month: F.Column | None = None) -> DataFrame:
    """Label each raw row with the month of the bronze file it sits in
    ('yyyy-MM'); by default from the bronze partition columns ``year``/``month``,
    which are then dropped (silver derives its own from the pickup time)."""
    if file_month is None:
        file_month = F.format_string("%04d-%02d", F.col("year"), F.col("month"))
    return raw.withColumn(SOURCE_COL, file_month).drop("year", "month")


def silver_trips_by_source(raw_frames: list[DataFrame], grid: DataFrame,
                           strict: bool = False) -> DataFrame:
    """Silver rows of bronze frames read from ``vtype=/year=/month=`` folders,
    each row keeping its ``source_month`` for replace-by-source writes."""
    return silver_trips([tag_source(r) for r in raw_frames], grid, strict,
                        keep=("vtype", SOURCE_COL))


def silver_trips(raw_frames: list[DataFrame], grid: DataFrame, strict: bool = False,
                 keep: tuple[str, ...] = ("vtype",)) -> DataFrame:
    # files of an era without coordinates take no part in the lookups, which shuffle rows beside a large grid
    with_points = [f for f in raw_frames if clean.has_points(f.columns)]
    without = [f for f in raw_frames if not clean.has_points(f.columns)]
    parts = [(frames, zones) for frames, zones in ((with_points, geo.geocode), (without, geo.published_zones)) if frames]
    located = [zones(clean.clean_values(clean.era_union(frames, keep=keep)), grid) for frames, zones in parts]
    kept = clean.quality_filter(reduce(lambda a, b: a.unionByName(b), located), strict=strict)
    extra = [k for k in keep if k != "vtype"]
    return clean.with_partition_columns(kept).select(*S.FINAL_COLS, "year", "month", *extra)


def write_silver(df: DataFrame, path: str, partition_cols: tuple[str, ...] | None = None,
                 rebalance: bool = False, mode: str = "overwrite") -> None:
    """Partitioned Parquet write. Dynamic partition overwrite replaces only the
    partitions present in ``df``. With a ``source_month`` column (default
    layout ``vtype=/year=/month=/source_month=``) a partition holds one source
    file's rows of one pickup month, so re-running any subset of bronze files
    is idempotent: their rows are replaced, other files' rows in the same
    pickup month stay. Without it a re-run must cover whole pickup months.

    Monthly bronze files are already clustered by month, so each task writes
    to about one partition folder and no shuffle is needed. ``rebalance=True``
    adds an AQE rebalance on the partition columns (one full shuffle) for
    inputs that are not clustered, to avoid many small files. ``mode="append"`` adds to what is there.

    Within a file rows are in order of pickup time, in pages of ``PAGE_ROWS`` rows, and carry the
    number of their pickup hour: a lookup of one hour reads the pages whose index meets it, not the month."""
    if partition_cols is None:
        partition_cols = SILVER_PARTITIONS + ((SOURCE_COL,) if SOURCE_COL in df.columns else ())
    out = df.hint("rebalance", *partition_cols) if rebalance else df
    if SORT_COL in df.columns:      # the write sorts by the partition columns anyway
        out = out.withColumn(HOUR_COL, hour_number(SORT_COL)).sortWithinPartitions(*partition_cols, SORT_COL)
    (out.write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .option("parquet.page.row.count.limit", PAGE_ROWS)
        .partitionBy(*partition_cols)
        .parquet(path))


def read_silver(spark, path: str) -> DataFrame:
    """Read a partitioned silver table back; partition columns are discovered."""
    return spark.read.parquet(path)


def read_by_schema(spark: SparkSession, root: str, wanted: DataFrame, by_folder: bool = True) -> list[DataFrame]:
    """Bronze files ``wanted`` (column ``path``) of one tree as one DataFrame per Parquet schema.

    The footers are read by one distributed job; what comes to the driver is one row per
    schema and folder (a folder stands for its files when they share a schema and
    all are wanted, else the files are named), which the reader needs there anyway.
    ``by_folder=False`` names every file: a file that arrives meanwhile stays out.
    ``basePath`` keeps ``vtype``/``year``/``month`` as partition columns."""
    folder = F.regexp_replace("path", "/[^/]*$", "")
    found = file_schemas(wanted).groupBy(folder.alias("folder"), "schema").agg(F.sort_array(F.collect_list("path")).alias("paths"))
    if by_folder:
        here = parquet_files(spark, root).groupBy(folder.alias("folder")).agg(F.count(F.lit(1)).alias("files"))
        found = found.join(here, "folder").select("schema", F.when(F.size("paths") == F.col("files"), F.array("folder"))
                                                  .otherwise(F.col("paths")).alias("paths"))
    rows = found.select("schema", "paths").collect()
    groups: dict[str, list[str]] = {}
    for r in rows:
        groups.setdefault(r["schema"], []).extend(r["paths"])
    return [spark.read.option("basePath", root).parquet(*sorted(paths)) for _, paths in sorted(groups.items())]


def _source_folders(spark: SparkSession, silver_path: str, sources: list[tuple[str, str]]) -> dict[str, set[str]]:
    """Folders of the silver table that hold rows of ``sources`` (type, source month), with their files'
    names: a source has one for each pickup month in it, a handful. Only folders of the sources' types are listed."""
    months: dict[str, list[str]] = {}
    for vtype, month in sources:
        months.setdefault(vtype, []).append(month)
    out = {}
    for vtype, wanted in months.items():
        pattern = f"{silver_path.rstrip('/')}/vtype={vtype}/year=*/month=*/{SOURCE_COL}={{{','.join(sorted(wanted))}}}"
        out.update({folder: files.names(spark, folder) for folder in files.matching(spark, pattern)})
    return out


def replace_sources(spark: SparkSession, silver_path: str, sources: list[tuple[str, str]], rows: DataFrame | None) -> None:
    """Write ``rows``, which are all rows of ``sources`` (None: they have no file any more), in place of
    what the table held of them. Pickup months in which a source has no row any more are not touched
    by the write; their folders, still with the files they had before, are removed.

    Beside a grid too large to broadcast the lookups deal rows by cell, whatever months they came from: rows are dealt
    by folder before the write, so that the table's files grow with its bytes, not with folders times tasks."""
    before = _source_folders(spark, silver_path, sources)
    if rows is not None:
        write_silver(rows, silver_path, rebalance=True)
    after = _source_folders(spark, silver_path, sources) if before else {}
    for folder, held in before.items():
        if after.get(folder) == held:
            files.remove(spark, folder)


LOAD_BYTES = 1 << 30     # of bronze files in one plan: what its shuffles leave on the executors' disks is a few times that


def load_portions(sources: DataFrame, todo: DataFrame) -> list[list[tuple[str, str]]]:
    """``sources`` (type, source month) in portions whose files in ``todo`` (with ``length``) hold ``LOAD_BYTES``, or one
    source each that holds more. A load goes through them one after another, so that the room its shuffles take
    doesn't grow with the history."""
    held = todo.groupBy("vtype", SOURCE_COL).agg(F.sum("length").alias("bytes"))
    portions, room = [], 0
    for r in sorted(sources.join(held, ["vtype", SOURCE_COL], "left").collect(), key=str):     # one row a type and month
        size = r["bytes"] or 0
        if not portions or size > room:
            portions.append([])
            room = LOAD_BYTES
        portions[-1].append((r["vtype"], r[SOURCE_COL]))
        room -= size
    return portions


def of_portion(rows: DataFrame, portion: list[tuple[str, str]], portions: list) -> DataFrame:
    """Those of ``rows`` that belong to the sources of ``portion``."""
    if len(portions) == 1:
        return rows
    months: dict[str, list[str]] = {}
    for vtype, month in portion:
        months.setdefault(vtype, []).append(month)
    return rows.where(reduce(lambda a, b: a | b, [F.col("vtype").eqNullSafe(v) & F.col(SOURCE_COL).isin(*m) for v, m in months.items()]))


def load_bronze_tree(spark: SparkSession, root: str, grid: DataFrame, silver_path: str) -> int:
    """Batch incremental silver load of a bronze tree ``<root>/vtype=/year=/month=``
    whose monthly files have drifting schemas.

    A hidden ledger beside the table names every bronze file (path, length, time) that is
    in it, and is written after the commit; output folders never count. A source (type, month)
    with any change against the ledger (a new file, a rewritten one, a vanished one) is built again from all of its
    files and replaced as a whole: a file that arrives late, a file that was rewritten, a file that was deleted and
    a load that stopped half way through its commit all end in the same table. Pending sources of up to ``LOAD_BYTES``
    together are one plan, read one DataFrame per schema, and are committed together. Returns the number of sources loaded."""
    check_layout(spark, silver_path)
    listed = listed_files(spark, root)
    changes = changed_files(listed, loaded_files(spark, silver_path)).checkpoint()
    sources = changes.select("vtype", SOURCE_COL).distinct()
    todo = listed.join(sources, ["vtype", SOURCE_COL], "left_semi")
    portions = load_portions(sources, todo)
    for portion in portions:
        frames = read_by_schema(spark, root, of_portion(todo, portion, portions))
        replace_sources(spark, silver_path, portion, silver_trips_by_source(frames, grid) if frames else None)
        record_files(spark, silver_path, of_portion(changes, portion, portions))
        if len(portions) > 1:
            release_shuffles(spark)
    return sum(map(len, portions))


def compact_silver(spark: SparkSession, silver_path: str, target_bytes: int = 128 << 20) -> int:
    """Rewrite the folders of a table loaded by ``load_bronze_tree`` that hold more files than their bytes need at
    ``target_bytes`` a file; the number of folders rewritten. Others are not read.

    A folder holds one source's rows of one pickup month, and stays so: rows are dealt to its new files by
    their day, in order of time. The sources concerned leave the ledger first and come back into it last, so a
    rewrite that stops half way is made good by the next load, which builds them from bronze again."""
    keys = [*SILVER_PARTITIONS, SOURCE_COL]
    listed = parquet_files(spark, silver_path).select("length", *[F.col(k).cast("string").alias(k) for k in keys])
    folders = listed.groupBy(*keys).agg(F.count(F.lit(1)).alias("files"), F.ceil(F.sum("length") / target_bytes).cast("int").alias("fit"))
    todo = folders.where("files > fit").checkpoint()
    rows = todo.collect()        # one row a folder to rewrite: (type, source month) and a pickup month
    if not rows:
        return 0
    sources = todo.select("vtype", SOURCE_COL).distinct()
    known = loaded_files(spark, silver_path).join(sources, ["vtype", SOURCE_COL], "left_semi").checkpoint()
    record_files(spark, silver_path, known.withColumn("present", F.lit(False)))
    wanted = [F.struct(*[F.lit(r[k]) for k in keys]) for r in rows]
    trips = spark.read.parquet(silver_path)
    here = trips.where(F.struct(*[F.col(k).cast("string") for k in keys]).isin(*wanted))
    fit = todo.select(*[F.col(k).cast(trips.schema[k].dataType).alias(k) for k in keys], "fit")
    slot = F.floor((F.dayofmonth(SORT_COL) - 1) / 31 * F.col("fit"))
    dealt = here.join(F.broadcast(fit), keys).repartition(sum(r["fit"] for r in rows), *keys, slot)     # folders: as many rows as ``rows``
    write_silver(dealt.select(*trips.columns), silver_path)
    record_files(spark, silver_path, known.withColumn("present", F.lit(True)))
    return len(rows)
