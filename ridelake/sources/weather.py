"""Weather: raw yearly JSON documents (parallel hourly arrays) -> hourly rows."""
from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import columns as C
from ..operators.clean import one_per_key
from .versions import replace_table


def explode_hourly(raw: DataFrame) -> DataFrame:
    """One row per hour from ``hourly{time[], <measure>[]...}``; index-aligned
    (``arrays_zip``), missing values stay NULL, measures renamed and typed.
    Duplicate hours are reduced here, once, to the row with the most measures (ties: the
    smallest values), so a later join cannot multiply trips and all marts see one row."""
    h = F.col("hourly")
    zipped = F.arrays_zip(*[h[v].alias(v) for v in ["time"] + S.WEATHER_VARS])
    rows = raw.select(F.inline(zipped))
    out = rows.select(
        F.to_timestamp_ntz(F.col("time")).alias("ts"),
        *[F.col(v).cast("double").alias(c) for v, c in zip(S.WEATHER_VARS[:-1], S.WEATHER_COLS[:-1])],
        F.col("weather_code").cast("int").alias("code_meteo"))
    return one_per_key(out.where(F.col("ts").isNotNull()), ["ts"])


def read_weather_json(spark: SparkSession, path: str) -> DataFrame:
    """Read every ``year=*/`` JSON document under ``path`` with the declared schema
    (one document per file, possibly pretty-printed) and explode it."""
    raw = spark.read.schema(S.WEATHER_JSON_SCHEMA).option("multiLine", True).json(path)
    return explode_hourly(raw)


def weather_documents(hourly: DataFrame) -> DataFrame:
    """Inverse shape, used to produce bronze documents: one JSON string per year.
    A year holds at most 8,784 hours, so each group is bounded by the calendar."""
    v = hourly.withColumn("year", F.year("ts"))
    items = F.array_sort(F.collect_list(F.struct(
        C.iso_minute("ts").alias("time"),
        *[F.col(c).alias(var) for var, c in zip(S.WEATHER_VARS, S.WEATHER_COLS)])))
    docs = v.groupBy("year").agg(items.alias("items"))

    def field(name):
        return F.transform("items", lambda x: x[name]).alias(name)

    hourly_struct = F.struct(*[field(k) for k in ["time"] + S.WEATHER_VARS])
    return docs.select("year", F.to_json(F.struct(hourly_struct.alias("hourly"))).alias("value"))


def write_weather_documents(hourly: DataFrame, path: str) -> None:
    """Bronze layout ``year=YYYY/part-*.txt``: one JSON document per year."""
    (weather_documents(hourly).write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy("year").text(path))


def write_weather(hourly: DataFrame, path: str) -> None:
    """Silver weather: the whole table is replaced in one step, partitioned by year (read with ``read_table``)."""
    replace_table(hourly.withColumn("year", F.year("ts")), path, ("year",))


def weather_head(hourly: DataFrame, n: int = 3) -> DataFrame:
    """The first ``n`` hours, in order of time (a sorted head)."""
    return hourly.orderBy("ts").limit(n)


def has_documents(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists and holds any file."""
    try:
        return not spark.read.format("binaryFile").load(path).select("path").isEmpty()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return False


def years_needed(trip_years: DataFrame, weather_years: DataFrame) -> DataFrame:
    """Trip years with no weather yet (empty when nothing is to be fetched)."""
    return (trip_years.select("year").distinct()
            .join(weather_years.select("year").distinct(), "year", "left_anti"))
