"""Span grid, sorted silver files, footers on a file system that only Hadoop knows."""
import contextlib
import io
import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from ridelake import schema as S
from ridelake.functions import columns as C
from ridelake.operators import geo
from ridelake.plans import marts as M
from ridelake.plans import silver as SV
from ridelake.session import work_path


def ring(x, y, w, h):
    return [(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)]


def points(spark, n=4000):
    r = random.Random(4)
    rows = [(datetime(2021, 1, 1) + timedelta(seconds=i), None, r.uniform(-74.03, -73.95), r.uniform(40.58, 40.67), r.uniform(-74.03, -73.95),
             r.uniform(40.58, 40.67), i % 7, None) for i in range(n)] + [(None, None, None, None, 0.0, 0.0, 3, 4), (None, None, 500.0, 40.6, -74.0, -900.0, None, 5)]
    return spark.createDataFrame(rows, "pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, pickup_longitude double, pickup_latitude double, "
                                       "dropoff_longitude double, dropoff_latitude double, pub_pickup_zone int, pub_dropoff_zone int")


def test_spans_give_the_zones_of_the_cells_in_a_smaller_table(spark):
    zones = [(i, i % 5 + 1, ring(-74.02 + 0.015 * (i % 4), 40.59 + 0.02 * (i // 4), 0.0173, 0.0217)) for i in range(12)]
    zones += [(20, 9, [(-74.0, 40.6), (-73.97, 40.62), (-74.01, 40.66), (-73.98, 40.62), (-74.0, 40.6)])]      # a thin bow, holes between runs
    rings, pts = spark.createDataFrame(zones, S.RING_SCHEMA), points(spark)
    for step in (1000, 10_000, 500):
        grid = geo.zone_grid(rings, step=step).checkpoint()
        spans = geo.grid_spans(grid, step).checkpoint()
        assert sorted(map(tuple, geo.geocode(pts, spans, step).collect()), key=repr) == sorted(map(tuple, geo.geocode(pts, grid, step).collect()), key=repr)
        if step >= 1000:
            assert spans.count() * 20 < grid.count()


def test_fine_spans_are_looked_up_without_a_shuffle(spark):
    path, step = work_path(spark, "fine-spans"), 10_000
    geo.grid_spans(geo.zone_grid(spark.createDataFrame([(1, 42, ring(-74.0, 40.6, 0.05, 0.05))], S.RING_SCHEMA), step=step), step).write.parquet(path)
    pts = work_path(spark, "fine-points")
    points(spark).write.parquet(pts)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        geo.geocode(spark.read.parquet(pts), spark.read.parquet(path), step).explain(mode="formatted")
    assert "BroadcastHashJoin" in buf.getvalue() and "hashpartitioning" not in buf.getvalue() and "Python" not in buf.getvalue()


def rows_read(df):
    """Rows that the scan of a plan without shuffles gave out."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().get("numOutputRows").get().value()


def test_an_hour_reads_a_part_of_its_month(spark):
    path = work_path(spark, "sorted-silver")
    t = F.expr("timestamp_ntz '2021-07-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, CAST(pmod(xxhash64(id), 2600000) AS INT))")
    trips = spark.range(120_000).select(t.alias("pickup_datetime"), F.col("id").cast("double").alias("fare_amount"), F.lit("yellow").alias("vtype"),
                                        F.lit(2021).alias("year"), F.lit(7).alias("month")).coalesce(1)
    SV.write_silver(trips, path)
    lake = spark.read.parquet(path).withColumn("pickup_location_id", F.lit(1))
    zones = spark.createDataFrame([(1, "z")], "location_id int, zone_name string")
    weather = spark.createDataFrame([(datetime(2021, 7, 15, 8), 20.0, 0.0)], "ts timestamp_ntz, temperature_c double, precipitation_mm double")
    got = M.weather_at_trip(lake, zones, weather, hour="2021-07-15 08:00:00")
    want = trips.where("pickup_datetime >= timestamp_ntz '2021-07-15 08:00:00' AND pickup_datetime < timestamp_ntz '2021-07-15 09:00:00'").count()
    assert got.count() == want > 0
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        got.explain(mode="formatted")
    assert "EqualTo(pickup_hour," in buf.getvalue()
    hour = lake.where(F.col("pickup_hour") == C.hour_number(F.lit("2021-07-15 08:00:00").cast("timestamp_ntz")))
    assert hour.count() == want and rows_read(hour) <= 4 * SV.PAGE_ROWS < 120_000


def test_hour_number(spark):
    rows = [(datetime(1970, 1, 1, 0, 59, 59), 0), (datetime(1969, 12, 31, 23, 0), -1), (datetime(2021, 7, 15, 8, 30), 451_760), (None, None)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, n int")
    assert [tuple(r) for r in df.select(C.hour_number("ts"), "n").collect()] == [(n, n) for _, n in rows]


def test_a_tree_on_a_file_system_that_only_hadoop_knows(spark):
    root = work_path(spark, "far-bronze").replace("file:", "")
    rows = [(datetime(2021, 1, d, 8), datetime(2021, 1, d, 9), -73.995, 40.605, 5.0, float(d)) for d in (1, 2)]
    schema = ("tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, pickup_longitude double, pickup_latitude double, "
              "fare_amount double, total_amount double")
    spark.createDataFrame(rows, schema).write.parquet(f"file:{root}/vtype=yellow/year=2021/month=01")
    spark.createDataFrame(rows, schema).withColumn("congestion_surcharge", F.lit(2.5)).write.parquet(f"file:{root}/vtype=yellow/year=2021/month=02")
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.spans.link./in", f"file://{root}")
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.spans.link./out", f"file://{work_path(spark, 'far-out').replace('file:', '')}")
    grid = geo.zone_grid(spark.createDataFrame([(1, 42, ring(-74.0005, 40.6005, 0.01, 0.01))], S.RING_SCHEMA)).checkpoint()
    silver = work_path(spark, "far-silver")
    assert SV.load_bronze_tree(spark, "viewfs://spans/in", grid, silver) == 2
    got = spark.read.parquet(silver)
    assert got.count() == 4 and got.where("congestion_surcharge = 2.5").count() == 2
    assert SV.load_bronze_tree(spark, "viewfs://spans/in", grid, silver) == 0


def test_cells_that_the_grid_names_several_times_match_as_often_in_spans(spark):
    cells = [(x, y, z) for x in (*range(-74020, -74004), *range(-73990, -73970)) for y in range(40590, 40640) for z in (1, 2) if (x + y) % 7 != z]
    cells += [c for c in cells if c[0] % 3] + [c for c in cells if c[0] == -74010 and c[1] % 2] + [(-74007, 40600, None)]
    grid = spark.createDataFrame(cells, "lon_key int, lat_key int, location_id int")
    pts = points(spark)
    by_cell, by_span = geo.geocode(pts, grid), geo.geocode(pts, geo.grid_spans(grid))
    want = sorted(map(tuple, by_cell.collect()), key=repr)
    assert len(want) > pts.count() and sorted(map(tuple, by_span.collect()), key=repr) == want and by_span.dtypes == by_cell.dtypes


def test_rows_of_files_without_coordinates_are_not_shuffled(spark):
    ids = work_path(spark, "ids-only")
    spark.sql("select 'fhv' vtype, timestamp_ntz'2023-03-01 08:00:00' pickup_datetime, timestamp_ntz'2023-03-01 08:30:00' dropOff_datetime, "
              "4 PULocationID, cast(null as int) DOLocationID, id / 2 trip_miles from range(40)").write.parquet(ids)
    rings = spark.createDataFrame([(1, 42, ring(-74.0, 40.6, 0.05, 0.05))], S.RING_SCHEMA)
    gps = spark.createDataFrame([("yellow", datetime(2021, 3, 1, 8), datetime(2021, 3, 1, 9), -73.98, 40.62, None, 5.0)] * 3,
                                "vtype string, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, pickup_longitude double, "
                                "pickup_latitude double, dropoff_longitude double, dropoff_latitude double")
    cells = geo.zone_grid(rings).checkpoint()
    name = "spark.sql.autoBroadcastJoinThreshold"
    for grid in (cells, geo.grid_spans(cells).checkpoint()):
        old = spark.conf.get(name)
        spark.conf.set(name, "-1")
        try:
            buf = io.StringIO()
            with contextlib.redirect_stdout(buf):
                SV.silver_trips([spark.read.parquet(ids)], grid).explain()
            assert "hashpartitioning" not in buf.getvalue() and "Join" not in buf.getvalue()
        finally:
            spark.conf.set(name, old)
        found = SV.silver_trips([spark.read.parquet(ids), gps], grid)
        assert sorted((r["vtype"], r["pickup_location_id"], r["dropoff_location_id"], r["n"]) for r in found.groupBy(
            "vtype", "pickup_location_id", "dropoff_location_id").agg(F.count(F.lit(1)).alias("n")).collect()) == [("fhv", 4, None, 40), ("yellow", 42, None, 3)]
