"""Whole lake build on the smallest tables: bronze -> silver -> gold."""
from ridelake.operators import geo
from ridelake.plans import marts as M
from ridelake.plans.medallion import LakePaths, build_lake, build_weather, quality_report
from ridelake.plans.silver import silver_trips
from ridelake.session import work_path
from ridelake.sources.versions import read_table
from ridelake.sources import weather as WX
from ridelake.sources.fixtures import Fixtures
from ridelake.streaming.incremental import write_bronze

SF = "/root/testdata/sf0.001"


def test_build_lake_end_to_end(spark):
    fx = Fixtures(spark, SF)
    bronze = write_bronze(fx.raw_eras(keep_file_month=True), work_path(spark, "m-bronze"))
    bronze_weather = work_path(spark, "m-bronze-weather")
    WX.write_weather_documents(fx.weather, bronze_weather)
    paths = build_lake(spark, bronze, fx.rings(), fx.zones, bronze_weather, work_path(spark, "m-lake"))

    trips = spark.read.parquet(paths.trips)
    want = silver_trips(fx.raw_eras(), geo.zone_grid(fx.rings(), fx.zones))
    assert trips.count() == want.count()
    assert read_table(spark, paths.weather).count() == fx.weather.count()
    zones = read_table(spark, paths.zones)
    assert {"location_id", "borough", "zone_name", "center_lon", "center_lat"} <= set(zones.columns)
    kpi = read_table(spark, f"{paths.gold}/kpi_cards").first()
    assert kpi["total_courses"] == trips.count()
    rep = quality_report(trips, zones)
    assert rep["volumes"].agg({"courses": "sum"}).first()[0] == trips.count()
    assert M.top_zones(trips, zones).count() <= 10


def test_weather_without_input_writes_nothing(spark):
    paths = LakePaths(work_path(spark, "m-empty"))
    assert build_weather(spark, work_path(spark, "m-missing"), paths) is False


def _rows(df):
    def norm(v):
        return float(f"{v:.9g}") if isinstance(v, float) else v
    return sorted((tuple(norm(x) for x in r) for r in df.collect()), key=repr)


def test_gold_marts_from_shared_aggregates_equal_direct_queries(spark):
    from ridelake.plans.gold import marts
    fx = Fixtures(spark, SF)
    trips, zones, weather = fx.trips, fx.zones, fx.weather
    built = marts(spark, trips, zones, weather)
    direct = {
        "volumes": M.volumes_by_type_year(trips),
        "fees_by_month": M.fees_by_month(trips),
        "fee_series": M.fee_series(trips),
        "flow_nodes": M.flow_nodes(M.zone_flows(trips, zones)),
        "flow_ribbons": M.flow_ribbons(M.zone_flows(trips, zones)),
        "price_ridgeline": M.price_ridgeline(M.price_histogram(trips, zones)),
        "price_by_weather": M.price_by_weather(trips, weather),
        "heatmap": M.heatmap_dense(M.heatmap_year(trips)),
        "top_zones": M.top_zones(trips, zones),
        "zone_flows": M.zone_flows(trips, zones),
        "flow_matrix": M.flow_matrix(M.zone_flows(trips, zones)),
        "price_histogram": M.price_histogram(trips, zones),
        "kpi_cards": M.kpi_cards(spark, trips, weather),
    }
    for name, want in direct.items():
        got = built[name]()
        assert got.columns == want.columns, name
        assert _rows(got) == _rows(want), name


def test_trips_from_a_bronze_tree_equal_the_silver_build(spark):
    from pyspark.sql import functions as F
    from ridelake.plans.medallion import build_trips_from_tree, build_zones
    from ridelake.schema import FINAL_COLS
    fx = Fixtures(spark, SF)
    tree = work_path(spark, "m-tree")
    for era in fx.raw_eras(keep_file_month=True):
        (era.withColumns({"year": F.year("_file_ts"), "month": F.month("_file_ts")}).drop("_file_ts")
            .write.mode("append").partitionBy("vtype", "year", "month").parquet(tree))
    paths = LakePaths(work_path(spark, "m-tree-lake"))
    build_zones(fx.rings(), fx.zones, paths)
    n = build_trips_from_tree(spark, tree, paths)
    assert n == spark.read.parquet(tree).select("vtype", "year", "month").distinct().count()
    assert build_trips_from_tree(spark, tree, paths) == 0
    got = spark.read.parquet(paths.trips).select(*FINAL_COLS, "year", "month")
    want = silver_trips(fx.raw_eras(), geo.zone_grid(fx.rings(), fx.zones))
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_build_lake_from_a_tree_and_state_plane_rings(spark):
    from pyspark.sql import functions as F
    from ridelake.functions.projection import NY_LONG_ISLAND_FTUS, to_easting_northing
    fx = Fixtures(spark, SF)
    tree = work_path(spark, "bl-tree")
    for era in fx.raw_eras(keep_file_month=True):
        (era.withColumns({"year": F.year("_file_ts"), "month": F.month("_file_ts")}).drop("_file_ts")
            .write.mode("append").partitionBy("vtype", "year", "month").parquet(tree))

    def to_feet(p):
        x, y = to_easting_northing(p["lon"], p["lat"])
        return F.struct(x.alias("lon"), y.alias("lat"))
    feet = fx.rings().withColumn("pts", F.transform("pts", to_feet))
    bronze_weather = work_path(spark, "bl-weather")
    WX.write_weather_documents(fx.weather, bronze_weather)
    paths = build_lake(spark, [], feet, fx.zones, bronze_weather, work_path(spark, "bl-lake"),
                       bronze_tree=tree, crs=NY_LONG_ISLAND_FTUS)
    trips = spark.read.parquet(paths.trips)
    assert "source_month" in trips.columns
    kpi = read_table(spark, f"{paths.gold}/kpi_cards").first()
    assert kpi["total_courses"] == trips.count() > 0


def test_weather_table_is_replaced_and_never_wiped_by_no_input(spark):
    from pyspark.sql import functions as F
    fx = Fixtures(spark, SF)
    paths, bronze, empty = LakePaths(work_path(spark, "w-lake")), work_path(spark, "w-bronze"), work_path(spark, "w-empty")
    for years in (F.year("ts") < 2021, F.year("ts") >= 2021):
        WX.write_weather_documents(fx.weather.where(years), bronze)
        assert build_weather(spark, bronze, paths) is True
    want = fx.weather.where(F.year("ts") >= 2021).count()
    assert read_table(spark, paths.weather).count() == want
    spark.createDataFrame([], "value string").write.text(empty)      # a folder without a document
    assert build_weather(spark, empty, paths) is False
    assert read_table(spark, paths.weather).count() == want


def test_duplicate_hours_keep_the_row_with_measures(spark):
    from datetime import datetime
    from ridelake.schema import WEATHER_SCHEMA
    at = datetime(2021, 1, 1, 5)
    rows = [(at, None, None, None, None, None, None, None), (at, 1.0, 2.0, 5.0, 5.0, 0.0, 3.0, 4), (at, 0.5, None, 0.0, None, None, None, None)]
    path = work_path(spark, "dup-hours")
    WX.write_weather_documents(spark.createDataFrame(rows, WEATHER_SCHEMA), path)
    got = WX.read_weather_json(spark, path).collect()
    assert len(got) == 1 and (got[0]["precipitation_mm"], got[0]["code_meteo"]) == (5.0, 4)


def test_lake_builds_without_weather(spark):
    fx = Fixtures(spark, SF)
    bronze = write_bronze(fx.raw_eras(keep_file_month=True), work_path(spark, "nw-bronze"))
    paths = build_lake(spark, bronze, fx.rings(), fx.zones, work_path(spark, "nw-none"), work_path(spark, "nw-lake"))
    assert read_table(spark, f"{paths.gold}/price_by_weather").count() == 0
    assert read_table(spark, f"{paths.gold}/kpi_cards").first()["delta_pluie"] == 0.0
