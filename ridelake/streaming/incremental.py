"""Incremental, idempotent silver load with Structured Streaming.

The bronze lake is one or more trees of monthly Parquet files. What a load has to do is found
by comparing each tree's listing with the tree's own ledger, not with a file source's memory (which
forgets old files, takes a name that it has seen for done, and never notices a deletion).
The ledger is a log of changes: path, length, time and whether the file is there. A new file
of any date, a file rewritten under its name and a file that vanished are each a row of it. The stream
reads that log, whose own files are written once and never change, with
``trigger(availableNow=True)``: one call processes the changes found since the last
call and then stops.

A source is the (type, month) that a file belongs to. Each micro-batch rebuilds the sources of its changes from all
of their files, as the newest listing names them, and replaces them as a whole: rows stand in
``vtype=/year=/month=/source_month=<month>.<era>`` partitions, so a replay after a failure, or a second change
of a source, replaces its own output instead of appending a second copy, and a source without files
leaves nothing. So it ends in the same table as the tree load. Files are read grouped by their own
schema. Rows are partitioned by pickup month, never by the month of the file they came from, so a stray ride
of the next month cannot mark that month as "done".
"""
from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.silver import SOURCE_COL, load_portions, of_portion, read_by_schema, replace_sources, silver_trips_by_source
from ..session import release_shuffles
from ..sources.lake import CHANGE_SCHEMA, changed_files, check_layout, files_or_none, known_files, listed_files, logged


BRONZE_PARTITIONS = ("vtype", "year", "month")


def append_bronze(frame: DataFrame, root: str, mode: str = "append", dealt: bool = False) -> None:
    """Write rows below ``root/vtype=/year=/month=``. Rows that come out of a join are not clustered by month: they are
    dealt by folder first, or every task would leave a file in every folder, and each load has to list and open them all.
    ``dealt``: they are by now."""
    out = frame if dealt else frame.hint("rebalance", *BRONZE_PARTITIONS)
    out.write.mode(mode).option("partitionOverwriteMode", "static").partitionBy(*BRONZE_PARTITIONS).parquet(root)


def write_bronze(frames: list[DataFrame], root: str, month_col: str = "_file_ts",
                 mode: str = "overwrite") -> list[str]:
    """Write raw era frames as a bronze lake ``<root>/era<i>/vtype=/year=/month=``.
    ``month_col`` (a timestamp column) gives the month of the file a row sits in;
    ``mode="append"`` adds newly arrived files next to the existing ones."""
    paths = []
    for i, f in enumerate(frames, start=1):
        path = f"{root.rstrip('/')}/era{i}"
        append_bronze(f.withColumns({"year": F.year(month_col), "month": F.month(month_col)}).drop(month_col), path, mode)
        paths.append(path)
    return paths


LISTED = "path string, vtype string, source_month string, length long, load long"


def log_changes(spark: SparkSession, bronze_path: str, ledger: str, max_files: int | None = None) -> bool:
    """Compare the tree with the ledger and log what differs (``max_files`` rows a file of the
    log); whether the log holds anything. The files of every source concerned are listed first: a load that
    stops in between logs nothing, and its listing is superseded by the next one. One listing of the tree a load."""
    files = listed_files(spark, bronze_path)
    known = logged(spark, f"{ledger}/changes", CHANGE_SCHEMA)
    changes = changed_files(files, known_files(known)).checkpoint()
    if changes.isEmpty():
        return files_or_none(spark, f"{ledger}/changes") is not None
    load = (logged(spark, f"{ledger}/listing", LISTED).agg(F.max("load")).first()[0] or 0) + 1
    sources = changes.select("vtype", "source_month").distinct()
    # a source without any file left is listed with a null path
    here = sources.join(files.select("path", "vtype", "source_month", "length"), ["vtype", "source_month"], "left")
    here.select("path", "vtype", "source_month", "length", F.lit(load).cast("long").alias("load")).coalesce(1).write.mode("append").parquet(f"{ledger}/listing")
    (changes.withColumn("load", F.lit(load).cast("long")).orderBy("vtype", "source_month", "path").coalesce(1)
        .write.mode("append").option("maxRecordsPerFile", max_files or 0).parquet(f"{ledger}/changes"))
    return True


def start_era_stream(spark: SparkSession, bronze_path: str, grid: DataFrame, silver_path: str,
                     checkpoint: str, era_name: str, max_files_per_trigger: int | None = None):
    """Log what changed in one era's tree and start the stream over it; returns (query, list of processed batch ids)."""
    ledger = f"{checkpoint.rstrip('/')}_files"
    if not log_changes(spark, bronze_path, ledger, max_files_per_trigger):
        return None, []
    # the log's files are never purged from the source's memory
    reader = spark.readStream.schema(CHANGE_SCHEMA).option("maxFileAge", "36500d")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", 1)
    stream = reader.parquet(f"{ledger}/changes").select("vtype", "source_month")
    batches: list[int] = []

    def process(batch: DataFrame, batch_id: int) -> None:
        spark, label = batch.sparkSession, F.concat(SOURCE_COL, F.lit(f".{era_name}"))
        listed = logged(spark, f"{ledger}/listing", LISTED).join(batch.distinct(), ["vtype", "source_month"], "left_semi")
        newest = listed.groupBy("vtype", "source_month").agg(F.max("load").alias("load"))
        files = listed.join(newest, ["vtype", "source_month", "load"]).checkpoint()
        portions = load_portions(files.select("vtype", SOURCE_COL).distinct(), files)
        for portion in portions:
            here = of_portion(files, portion, portions).where("path is not null")
            frames = read_by_schema(spark, bronze_path, here, by_folder=False)
            replace_sources(spark, silver_path, [(vtype, f"{month}.{era_name}") for vtype, month in portion],
                            silver_trips_by_source(frames, grid).withColumn(SOURCE_COL, label) if frames else None)
            if len(portions) > 1:
                release_shuffles(spark)
        batches.append(batch_id)

    q = (stream.writeStream.foreachBatch(process)
               .queryName(f"silver-{era_name}-{abs(hash(checkpoint)) % 10**8}")
               .option("checkpointLocation", checkpoint)
               .trigger(availableNow=True)
               .start())
    return q, batches


def load_era_stream(spark: SparkSession, bronze_path: str, grid: DataFrame, silver_path: str,
                    checkpoint: str, era_name: str, max_files_per_trigger: int | None = None) -> int:
    """Process every change of one era's tree since the last load with this ``checkpoint``; returns the
    number of micro-batches run (0 when nothing had changed)."""
    q, batches = start_era_stream(spark, bronze_path, grid, silver_path, checkpoint, era_name,
                                  max_files_per_trigger)
    if q:
        q.awaitTermination()
    return len(batches)


def incremental_load(spark: SparkSession, bronze_paths: list[str], grid: DataFrame,
                     silver_path: str, checkpoint_root: str,
                     max_files_per_trigger: int | None = None) -> int:
    """Run every era stream once, concurrently (each writes only its own
    ``source_month=`` partitions); returns the total number of batches processed.

    ``max_files_per_trigger`` bounds the changes of a micro-batch (``availableNow`` still
    processes everything new, in several batches). For a first load of the
    whole history this keeps each batch's job a bounded share of the input: a failure reruns only
    the batch in flight."""
    check_layout(spark, silver_path)
    def start(i: int):
        return start_era_stream(spark, bronze_paths[i], grid, silver_path, f"{checkpoint_root.rstrip('/')}/era{i + 1}",
                                f"era{i + 1}", max_files_per_trigger)

    with ThreadPoolExecutor(max(1, len(bronze_paths))) as pool:      # the trees are listed at the same time
        started = list(pool.map(start, range(len(bronze_paths))))
    for q, _ in started:
        if q:
            q.awaitTermination()
    return sum(len(b) for _, b in started)
