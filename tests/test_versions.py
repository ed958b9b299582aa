"""Tables replaced as a whole: a failed write leaves the old one, readers follow the pointer."""
import pytest
from pyspark.sql import functions as F

from ridelake.session import work_path
from ridelake.sources import files
from ridelake.sources import weather as WX
from ridelake.sources.versions import VERSIONS, has_table, read_table, replace_table


def hours(spark, n, year=2021):
    return spark.range(n).select(F.expr(f"timestamp_ntz '{year}-01-01 00:00:00' + make_interval(0, 0, 0, 0, CAST(id AS INT))").alias("ts"),
                                 F.col("id").cast("double").alias("temperature_c"))


def test_a_write_that_fails_leaves_the_old_table(spark):
    path = work_path(spark, "versions")
    assert not has_table(spark, path)
    WX.write_weather(hours(spark, 100), path)
    broken = hours(spark, 50, 2022).withColumn("temperature_c", F.when(F.col("temperature_c") > 40, F.raise_error("disk")).otherwise(F.col("temperature_c")))
    with pytest.raises(Exception, match="disk"):
        WX.write_weather(broken, path)
    assert read_table(spark, path).count() == 100 and has_table(spark, path)
    WX.write_weather(hours(spark, 7, 2022), path)
    got = read_table(spark, path)
    assert got.count() == 7 and {r["year"] for r in got.select("year").distinct().collect()} == {2022}


def test_readers_keep_their_version_and_old_ones_go(spark):
    path = work_path(spark, "versions")
    replace_table(spark.range(3), path)
    first = read_table(spark, path)
    replace_table(spark.range(5), path)
    assert first.count() == 3 and read_table(spark, path).count() == 5
    replace_table(read_table(spark, path).withColumn("id", F.col("id") + 1), path)      # reads itself
    assert sorted(r[0] for r in read_table(spark, path).collect()) == [1, 2, 3, 4, 5]
    assert len([n for n in files.names(spark, f"{path}/{VERSIONS}") if not n.startswith(".")]) == 2


def test_a_table_without_pointer_is_read_and_taken_over(spark):
    path = work_path(spark, "versions")
    spark.range(4).write.parquet(path)
    assert has_table(spark, path) and read_table(spark, path).count() == 4
    replace_table(spark.range(2), path)
    assert read_table(spark, path).count() == 2
    assert all(n.startswith(("_", ".")) and n != "_SUCCESS" for n in files.names(spark, path))
