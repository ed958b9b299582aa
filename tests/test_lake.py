"""Lake bookkeeping, weather documents and the streaming incremental load."""
from datetime import datetime

from ridelake.session import work_path
from ridelake.sources import lake
from ridelake.sources import weather as WX


def test_calendar_gaps_and_coverage(spark):
    inv = spark.createDataFrame([("yellow", 2020, 1), ("yellow", 2020, 3), ("green", 2020, 2)],
                                "vtype string, year int, month int")
    cal = lake.month_calendar(inv)
    assert sorted(tuple(r) for r in cal.collect()) == [
        ("green", 2020, 2), ("green", 2020, 3),
        ("yellow", 2020, 1), ("yellow", 2020, 2), ("yellow", 2020, 3)]
    miss = sorted(tuple(r) for r in lake.missing_months(cal, inv).collect())
    assert miss == [("green", 2020, 3), ("yellow", 2020, 2)]
    pub = lake.month_calendar(inv, first_months={"yellow": "2019-11"}, last_month="2020-03")
    assert pub.where("vtype = 'yellow'").count() == 5
    cov = {r["vtype"]: (r["months"], r["first_month"], r["last_month"])
           for r in lake.coverage_summary(inv).collect()}
    assert cov["yellow"] == (2, "2020-01", "2020-03")


def test_file_period_parse_skips_other_names(spark):
    files = spark.createDataFrame(
        [("yellow", "yellow_tripdata_2009-01.parquet"), ("yellow", "yellow_tripdata_2009-01.parquet"),
         ("green", "green_tripdata_2014-12.parquet.part"), ("green", "readme.txt")],
        "vtype string, file_name string")
    assert [tuple(r) for r in lake.parse_file_period(files).collect()] == [("yellow", 2009, 1)]


def test_weather_json_roundtrip_keeps_nulls(spark):
    path = work_path(spark, "test-weather")
    rows = [(datetime(2020, 1, 1, 0), 1.5, 80.0, None, 0.0, 0.0, 10.0, 3),
            (datetime(2020, 1, 1, 1), None, 81.0, 0.4, 0.3, 0.0, 12.0, None),
            (datetime(2021, 6, 1, 5), 20.0, 50.0, 0.0, 0.0, 0.0, 5.0, 0)]
    hourly = spark.createDataFrame(rows, WX.S.WEATHER_SCHEMA)
    WX.write_weather_documents(hourly, path)
    back = sorted(tuple(r) for r in WX.read_weather_json(spark, path).collect())
    assert back == sorted(rows)
    need = WX.years_needed(spark.createDataFrame([(2020,), (2022,)], "year int"),
                           hourly.selectExpr("year(ts) AS year"))
    assert [r["year"] for r in need.collect()] == [2022]


def test_inventory_from_the_file_listing_equals_the_scan(spark):
    from ridelake.plans import silver as SV
    from ridelake.sources.fixtures import Fixtures
    fx = Fixtures(spark, "/root/testdata/sf0.001")
    path = work_path(spark, "inv-trips")
    SV.write_silver(fx.trips, path)
    listed = lake.partition_inventory_at(spark, path)
    scanned = lake.partition_inventory(spark.read.parquet(path))
    assert sorted(map(tuple, listed.collect())) == sorted(map(tuple, scanned.collect()))
    assert listed.schema == scanned.schema


def test_last_published_month():
    from ridelake.sources.lake import last_published_month
    assert [last_published_month(d) for d in ("2026-06-10", "2026-03-01", "2026-02-28", "2026-01-31")] == \
        ["2026-03", "2025-12", "2025-11", "2025-10"]
    assert last_published_month("2026-06-10", lag=0) == "2026-05"
