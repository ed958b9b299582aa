"""Gold refreshed from parts per source equals a full build, and reads changed sources only."""
from pyspark.sql import functions as F

from ridelake.plans import refresh as R
from ridelake.plans import silver as SV
from ridelake.plans.gold import write_gold
from ridelake.session import work_path
from ridelake.sources import files
from ridelake.sources.fixtures import Fixtures
from ridelake.sources.versions import read_table

SF = "/root/testdata/sf0.001"
MARTS = ("volumes", "fees_by_month", "zone_flows", "price_ridgeline", "price_by_weather", "top_zones", "kpi_cards", "heatmap")


def rows(df):
    def norm(v):
        return float(f"{v:.9g}") if isinstance(v, float) else v
    return sorted((tuple(norm(x) for x in r) for r in df.collect()), key=repr)


def test_refresh_equals_a_full_build_and_reads_changed_sources_only(spark, monkeypatch):
    fx = Fixtures(spark, SF)
    silver, gold, whole = (work_path(spark, n) for n in ("r-silver", "r-gold", "r-whole"))
    trips = fx.trips.where("year = 2021").withColumn(SV.SOURCE_COL, F.format_string("%04d-%02d", "year", "month")).checkpoint()
    n = trips.select(*R.SOURCE).distinct().count()
    SV.write_silver(trips, silver, rebalance=True)
    assert R.refresh_gold(spark, silver, fx.zones, fx.weather, gold) == n > 5
    assert R.refresh_parts(spark, silver, f"{gold}/_parts") == ([], [])

    # one source is rewritten with fewer rows, another one vanishes
    a, b = sorted(tuple(r) for r in trips.select(*R.SOURCE).distinct().collect())[:2]
    less = trips.where((F.col("vtype") == a[0]) & (F.col(SV.SOURCE_COL) == a[1]) & (F.dayofmonth("pickup_datetime") > 9))
    assert less.count() > 0
    SV.write_silver(less, silver)
    for folder in files.matching(spark, f"{silver}/vtype={b[0]}/*/*/{SV.SOURCE_COL}={b[1]}"):
        files.remove(spark, folder)
    read = []
    monkeypatch.setattr(R, "trips_of", lambda *x, f=R.trips_of: read.append(f(*x)) or read[-1])
    assert R.refresh_gold(spark, silver, fx.zones, fx.weather, gold) == 1
    (df,) = read
    # the scan's partition filters leave the files of that source
    assert {tuple(r) for r in df.select(*R.SOURCE).distinct().collect()} == {a}
    assert all(f"vtype={a[0]}/" in p and f"{SV.SOURCE_COL}={a[1]}/" in p for p in
               (r[0] for r in df.select(F.input_file_name()).distinct().collect()))
    assert "PartitionFilters" in df._jdf.queryExecution().executedPlan().toString()

    now = spark.read.parquet(silver)
    write_gold(spark, now, fx.zones, fx.weather, whole, names=list(MARTS))
    for name in MARTS:
        assert rows(read_table(spark, f"{gold}/{name}")) == rows(read_table(spark, f"{whole}/{name}")), name


def test_parts_are_one_file_a_source(spark):
    """However many tasks build the parts, a source's part is not a file of each of them."""
    fx = Fixtures(spark, SF)
    silver, root = work_path(spark, "parts-silver"), work_path(spark, "parts-root")
    trips = fx.trips.where("year = 2021").withColumn(SV.SOURCE_COL, F.format_string("%04d-%02d", "year", "month"))
    SV.write_silver(trips, silver, rebalance=True)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        changed, _ = R.refresh_parts(spark, silver, root)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for name in R.PARTS:
        held = R.parquet_files(spark, f"{root}/{name}").groupBy(*R.SOURCE).count().collect()
        assert 0 < len(held) <= len(changed) and all(r["count"] == 1 for r in held), name
