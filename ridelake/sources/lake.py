"""Lake bookkeeping as Spark jobs: partition inventory, file periods, expected
month calendar, missing months and coverage per vehicle type."""
from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PERIOD_PATTERN = r"(\d{4})-(\d{2})\.parquet$"


def partition_inventory(df: DataFrame) -> DataFrame:
    """Distinct (vtype, year, month) present. On a partitioned lake only the
    partition columns are read (no data column in ReadSchema)."""
    return df.select("vtype", F.col("year").cast("int"), F.col("month").cast("int")).distinct()


def partition_inventory_at(spark: SparkSession, root: str) -> DataFrame:
    """``partition_inventory`` of a partitioned table on disk from its file
    listing: one row per file instead of one per record (a scan of partition
    columns alone still yields every row), and no file is opened."""
    return (parquet_files(spark, root)
            .select("vtype", F.col("year").cast("int"), F.col("month").cast("int")).distinct())


def parse_file_period(files: DataFrame, name_col: str = "file_name") -> DataFrame:
    """(vtype, year, month) from names ending in ``YYYY-MM.parquet``; other names
    are skipped; the plan is set-deduplicated."""
    y = F.regexp_extract(F.col(name_col), PERIOD_PATTERN, 1)
    m = F.regexp_extract(F.col(name_col), PERIOD_PATTERN, 2)
    return (files.where(F.col(name_col).rlike(PERIOD_PATTERN))
                 .select("vtype", y.cast("int").alias("year"), m.cast("int").alias("month"))
                 .distinct())


def month_calendar(inventory: DataFrame, first_months: dict[str, str] | None = None,
                   last_month: str | None = None) -> DataFrame:
    """Expected months per vtype: from its first month (published start when given,
    else the first month present) to the last month (given, else the latest
    month present in the whole inventory), one row per month."""
    inv = inventory.withColumn("m", F.make_date("year", "month", F.lit(1)))
    firsts = inv.groupBy("vtype").agg(F.min("m").alias("first"))
    if first_months:
        pairs = F.create_map(*[x for k, v in first_months.items() for x in (F.lit(k), F.lit(v + "-01"))])
        firsts = firsts.withColumn("first", F.coalesce(F.to_date(pairs[F.col("vtype")]), F.col("first")))
    if last_month:
        last = F.to_date(F.lit(last_month + "-01"))
    else:
        # the newest month of any type, a scalar of the small inventory
        last = inv.agg(F.max("m")).scalar()
    cal = firsts.select("vtype", "first", last.alias("last")).select(
        "vtype", F.explode(F.sequence("first", "last", F.expr("INTERVAL 1 MONTH"))).alias("m"))
    return cal.select("vtype", F.year("m").alias("year"), F.month("m").alias("month"))


def missing_months(calendar: DataFrame, inventory: DataFrame) -> DataFrame:
    """Planned months without any data (anti join on the three keys)."""
    return calendar.join(inventory, ["vtype", "year", "month"], "left_anti")


def coverage_summary(inventory: DataFrame) -> DataFrame:
    """Per vtype: number of months present, first and last as 'yyyy-MM'."""
    ym = F.format_string("%04d-%02d", F.col("year"), F.col("month"))
    return (inventory.groupBy("vtype")
                     .agg(F.count(F.lit(1)).alias("months"),
                          F.min(ym).alias("first_month"), F.max(ym).alias("last_month")))


def parquet_files(spark: SparkSession, root: str) -> DataFrame:
    """One row per Parquet file under a partitioned ``root``: path, length, modificationTime
    and the partition columns. Listed by the binary-file source with the content
    column pruned: no file is opened, so files of unlike schemas never meet."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
                 .load(root).drop("content"))


def bronze_files(spark: SparkSession, root: str) -> DataFrame:
    """Files of a bronze tree ``<root>/vtype=/year=/month=/*.parquet``: ``path, length,
    modificationTime, vtype, year, month, source_month`` ('yyyy-MM' of the file's month)."""
    y, m = F.col("year").cast("int"), F.col("month").cast("int")
    return parquet_files(spark, root).select(
        "path", "length", "modificationTime", "vtype", y.alias("year"), m.alias("month"),
        F.format_string("%04d-%02d", y, m).alias("source_month"))


LEDGER_DIR = "_loaded_files"     # hidden from readers of the table (leading underscore)
FILE_KEY = ["path", "length", "modificationTime"]
LEDGER_SCHEMA = "path string, length long, modificationTime timestamp, vtype string, source_month string"
CHANGE_SCHEMA = LEDGER_SCHEMA + ", present boolean, load long"       # ``present`` false: the file vanished


def files_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """``parquet_files`` of ``path``, None when the path does not exist."""
    try:
        return parquet_files(spark, path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def check_layout(spark: SparkSession, silver_path: str) -> None:
    """Refuse a table that is not partitioned by ``source_month``: its rows can't be replaced by source."""
    files = files_or_none(spark, silver_path)
    if files is not None and "source_month" not in files.columns and not files.isEmpty():
        raise ValueError(f"{silver_path} is not partitioned by source_month; "
                         "load a bronze tree into a table of its own layout")


def logged(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows logged so far under ``path``, none when nothing was."""
    if files_or_none(spark, path) is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def known_files(changes: DataFrame) -> DataFrame:
    """The files of a log of changes as it left them (``LEDGER_SCHEMA``): the last row of each path,
    unless that says that the file vanished."""
    load = F.coalesce("load", F.lit(0))
    last = changes.groupBy("path").agg(F.max_by(F.struct(*changes.columns[1:]), load).alias("was")).select("path", "was.*")
    return last.where(F.coalesce("present", F.lit(True))).drop("present", "load")


def changed_files(files: DataFrame, known: DataFrame) -> DataFrame:
    """What differs between a listing and the known files (both ``LEDGER_SCHEMA``): new files of any date
    and files of another length or time with ``present`` true, vanished ones with false."""
    came = files.join(known, FILE_KEY, "left_anti").withColumn("present", F.lit(True))
    gone = known.join(files, "path", "left_anti").withColumn("present", F.lit(False))
    return came.unionByName(gone)


def listed_files(spark: SparkSession, root: str) -> DataFrame:
    """The files of a bronze tree (``LEDGER_SCHEMA``); a tree may have lost its last file."""
    if "vtype" not in parquet_files(spark, root).columns:
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return bronze_files(spark, root).select(*FILE_KEY, "vtype", "source_month")


def loaded_files(spark: SparkSession, silver_path: str) -> DataFrame:
    """The table's ledger: every bronze file (path, length, modification time) whose source
    was committed as it is now. Output folders never count: a commit may stop half way."""
    return known_files(logged(spark, f"{silver_path.rstrip('/')}/{LEDGER_DIR}", CHANGE_SCHEMA))


def record_files(spark: SparkSession, silver_path: str, changes: DataFrame) -> None:
    """Append changes to the ledger, after the commit of their rows: a failure before that
    only means that their sources are built and replaced again."""
    path = f"{silver_path.rstrip('/')}/{LEDGER_DIR}"
    load = (logged(spark, path, CHANGE_SCHEMA).agg(F.max("load")).first()[0] or 0) + 1
    changes.withColumn("load", F.lit(load).cast("long")).coalesce(1).write.mode("append").parquet(path)


ARROW_SCHEMES = ("file", "hdfs", "gs", "gcs", "s3")     # fixed value: what footers are read from on the executors
FOOTER_THREADS = 32


def file_schemas(files: DataFrame) -> DataFrame:
    """``path, schema`` of each file, whose text names columns and types in order.

    One job reads the footers on the executors, however many files there are. On a file system that
    only Hadoop knows (s3a, abfss, viewfs, ...) the driver reads them through Hadoop, with the
    session's own settings and credentials, ``FOOTER_THREADS`` at a time."""
    def footers(batches):      # self-contained: the executors need not have this library
        import pyarrow as pa
        import pyarrow.fs as pafs
        import pyarrow.parquet as pq
        for batch in batches:
            paths = batch.column(0).to_pylist()
            texts = []
            for p in paths:
                fs, local = (pafs.LocalFileSystem(), "/" + p[5:].lstrip("/")) if p.startswith("file:") else pafs.FileSystem.from_uri(p)
                schema = pq.read_schema(local, filesystem=fs)
                texts.append("; ".join(f"{f.name} {f.type}" for f in schema))
            yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(texts, pa.string())], ["path", "schema"])

    spark, scheme = files.sparkSession, F.regexp_extract("path", "^([A-Za-z0-9+.-]+):", 1)
    some = files.select(scheme.alias("scheme")).first()
    if some is None or some["scheme"] in ("", *ARROW_SCHEMES):
        return files.select("path").mapInArrow(footers, "path string, schema string")
    conf = spark._jsc.hadoopConfiguration()

    def footer(path: str) -> tuple[str, str]:
        return path, spark._jvm.org.apache.parquet.hadoop.ParquetFileReader.readFooter(
            conf, spark._jvm.org.apache.hadoop.fs.Path(path)).getFileMetaData().getSchema().toString()

    with ThreadPoolExecutor(FOOTER_THREADS) as pool:
        rows = list(pool.map(footer, [r["path"] for r in files.select("path").collect()]))
    return spark.createDataFrame(rows, "path string, schema string")


LAG_MONTHS = 2      # fixed value: the announced publication delay


def last_published_month(today: str, lag: int = LAG_MONTHS) -> str:
    """'yyyy-MM' of the newest month that should be there on ``today`` ('yyyy-MM-dd'): a month
    appears ``lag`` months after its end, so ``lag`` whole months lie between it and today's."""
    year, month = int(today[:4]), int(today[5:7])
    at = year * 12 + (month - 1) - lag - 1
    return f"{at // 12:04d}-{at % 12 + 1:02d}"
