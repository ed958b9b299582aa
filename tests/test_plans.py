"""Physical-plan properties that matter at scale: pushdown, pruning, broadcast, no Python."""
import contextlib
import io
import uuid

import pytest

from ridelake.plans import marts as M
from ridelake.plans import silver as SV
from ridelake.operators import geo
from ridelake.session import work_path
from ridelake.sources.versions import read_table
from ridelake.sources.fixtures import Fixtures

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def lake(spark):
    fx = Fixtures(spark, SF)
    paths = {n: work_path(spark, f"plans-{n}") for n in ("trips", "zones", "weather")}
    SV.write_silver(fx.trips, paths["trips"])
    fx.zones.write.parquet(paths["zones"])
    fx.weather.write.parquet(paths["weather"])
    return {n: spark.read.parquet(p) for n, p in paths.items()}


def test_price_histogram_scans_the_trips_once(spark, lake):
    for kw in ({}, {"location_id": 3}, {"zone_name": "NATION_19"}):
        q = M.price_histogram(lake["trips"], lake["zones"], **kw)
        assert q.collect()              # the adaptive plan is final after execution
        p = plan(q)
        final = p[p.index("Final Plan"):p.index("Initial Plan")]
        # trips, and zones unless the zone is given by its id
        assert final.count("Scan parquet") == (1 if "location_id" in kw else 2) and "ReusedExchange" in final
        scans = [line for line in p.splitlines() if line.startswith("ReadSchema:")]
        assert "ReadSchema: struct<pickup_datetime:timestamp_ntz,trip_distance:double," \
               "pickup_location_id:int,fare_amount:double>" in scans
        assert "partial_count" in p and "Subqueries" not in p


def test_price_histogram_chooses_the_zone_on_counts(spark, lake):
    # zone cells never meet in one row: lists of cells are nowhere in the plan
    p = plan(M.price_histogram(lake["trips"], lake["zones"]))
    assert "collect_list" not in p and "collect_set" not in p


def test_kpi_row_scans_the_trips_once(spark, lake):
    p = plan(M.kpi_cards(spark, lake["trips"], lake["weather"]))
    assert len([line for line in p.splitlines() if line.startswith("ReadSchema:")]) == 2       # trips and weather


def test_weather_is_broadcast_after_hourly_preaggregation(lake):
    p = plan(M.price_by_weather(lake["trips"], lake["weather"]))
    assert "BroadcastHashJoin" in p
    assert "partial_sum" in p
    assert "ReadSchema: struct<pickup_datetime:timestamp_ntz,trip_distance:double,fare_amount:double>" in p


def test_year_lookup_prunes_partitions(lake):
    p = plan(M.heatmap_year(lake["trips"], year=2021))
    assert "PartitionFilters: [isnotnull(year" in p and "(year#" in p and "= 2021)" in p


def test_hour_lookup_prunes_and_pushes(lake):
    q = M.weather_at_trip(lake["trips"], lake["zones"], lake["weather"], hour="2021-07-15 08:00:00")
    p = plan(q)
    assert "PartitionFilters" in p and "= 7)" in p
    assert "GreaterThanOrEqual(pickup_datetime" in p
    rows = q.collect()
    assert all(r["pickup_datetime"].strftime("%Y-%m-%d %H") == "2021-07-15 08" for r in rows)


def test_top_zones_aggregates_before_the_join(lake):
    p = plan(M.top_zones(lake["trips"], lake["zones"]))
    head = p.split("\n\n")[0]
    # the partial aggregate on pickup_location_id sits below the (broadcast) join
    assert head.index("BroadcastHashJoin") < head.rindex("HashAggregate")
    assert "TakeOrderedAndProject" in p


def test_silver_plan_has_no_python_and_no_shuffle(spark):
    fx = Fixtures(spark, SF)
    grid_path = work_path(spark, "plans-grid")
    geo.zone_grid(fx.rings(), fx.zones).write.parquet(grid_path)
    bronze = work_path(spark, "plans-bronze")
    for i, e in enumerate(fx.raw_eras(), start=1):
        e.write.parquet(f"{bronze}/era{i}")
    raw = [spark.read.parquet(f"{bronze}/era{i}") for i in (1, 2, 3)]
    p = plan(SV.silver_trips(raw, spark.read.parquet(grid_path)))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p
    # the only exchanges are the broadcasts of the grid
    # (the grid's bounding box is a one-row subquery beside the plan)
    p = p.split("===== Subqueries =====")[0]
    exchanges = [line for line in p.splitlines() if "Exchange" in line and "(" in line and "+-" in line]
    assert exchanges and all("BroadcastExchange" in e for e in exchanges)


def test_gold_marts_write_and_read_back(spark, lake):
    from ridelake.plans.gold import write_gold
    root = work_path(spark, "plans-gold")
    names = write_gold(spark, lake["trips"], lake["zones"], lake["weather"], root,
                       names=["volumes", "top_zones", "kpi_cards"])
    assert names == ["volumes", "top_zones", "kpi_cards"]
    assert read_table(spark, f"{root}/kpi_cards").count() == 1
    assert read_table(spark, f"{root}/top_zones").count() <= 10


def test_grid_broadcast_is_built_once(spark):
    fx = Fixtures(spark, SF)
    grid_path = work_path(spark, "plans-grid2")
    geo.zone_grid(fx.rings(), fx.zones).write.parquet(grid_path)
    q = SV.silver_trips(fx.raw_eras()[:2], spark.read.parquet(grid_path))
    q.collect()                       # the adaptive plan is final after execution
    p = plan(q)
    assert "ReusedExchange" in p


def jobs_of(spark, build):
    """Number of Spark jobs that ``build`` starts."""
    group = f"jobs-{uuid.uuid4()}"
    spark.sparkContext.setJobGroup(group, "test")
    try:
        build()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_building_a_query_runs_no_job(spark, lake):
    fx = Fixtures(spark, SF)
    grid = spark.createDataFrame([(0, 0, 1)], "lon_key int, lat_key int, location_id int")
    eras = fx.raw_eras()
    for build in (lambda: SV.silver_trips(eras, grid), lambda: M.top_zones(lake["trips"], lake["zones"]),
                  lambda: M.price_by_weather(lake["trips"], lake["weather"]), lambda: M.price_histogram(lake["trips"], lake["zones"]),
                  lambda: M.price_ridgeline(M.price_histogram(lake["trips"], lake["zones"])),
                  lambda: M.weather_at_trip(lake["trips"], lake["zones"], lake["weather"]), lambda: M.zone_flows(lake["trips"], lake["zones"]),
                  lambda: M.flow_ribbons(M.zone_flows(lake["trips"], lake["zones"])),
                  lambda: M.flow_matrix(M.zone_flows(lake["trips"], lake["zones"]), ["a", "b"]),
                  lambda: M.kpi_cards(spark, lake["trips"], lake["weather"])):
        assert jobs_of(spark, build) == 0
    assert jobs_of(spark, lambda: lake["trips"].count()) > 0


def test_rasteriser_shuffles_crossings_not_rings(spark):
    fx = Fixtures(spark, SF)
    p = plan(geo.scanline_cells(spark.createDataFrame(fx.rings().limit(3).collect(), fx.rings().schema)))
    for block in p.split("\n\n"):
        if "Exchange" in block.split("\n")[0]:
            assert "pts" not in block


def test_junk_points_get_salted_keys(spark):
    grid = spark.createDataFrame([(-73995, 40605, 42)], "lon_key int, lat_key int, location_id int")
    pts = [(0.0, 0.0)] * 50 + [(None, None)] * 50 + [(-73.995, 40.605)] * 5
    df = spark.createDataFrame([(i, *p, *p, 7, None) for i, p in enumerate(pts)],
                               "i int, pickup_longitude double, pickup_latitude double, dropoff_longitude double, "
                               "dropoff_latitude double, pub_pickup_zone int, pub_dropoff_zone int")
    out = geo.geocode(df, grid)
    got = [(r["pickup_location_id"], r["dropoff_location_id"]) for r in out.orderBy("i").collect()]
    assert got == [(7, None)] * 100 + [(42, 42)] * 5


def test_quality_filter_runs_below_the_grid_lookups(spark):
    fx = Fixtures(spark, SF)
    grid_path = work_path(spark, "plans-grid3")
    geo.zone_grid(fx.rings(), fx.zones).write.parquet(grid_path)
    bronze = work_path(spark, "plans-bronze3")
    fx.raw_eras()[1].write.parquet(bronze)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        SV.silver_trips([spark.read.parquet(bronze)], spark.read.parquet(grid_path)).explain()
    lines = buf.getvalue().splitlines()
    joins = [i for i, line in enumerate(lines) if "BroadcastHashJoin" in line]
    quality = [i for i, line in enumerate(lines) if "Filter" in line and "tpep_pickup_datetime" in line]
    # the tree prints parents first: the trip filter is deeper than both lookups
    assert len(joins) == 2 and quality and min(quality) > max(joins)
