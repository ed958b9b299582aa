"""Registry: query key -> ``(spark, sf_dir) -> DataFrame`` over the fixture views."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schema as SC
from .functions.columns import normalize_category, normalize_flag, sentinel_to_null, year_month
from .functions.projection import rings_to_wgs84, to_easting_northing
from .operators import clean, geo
from .plans import marts as M
from .plans import silver as SV
from .plans.refresh import refresh_gold
from .plans.medallion import LakePaths, build_zones
from .session import apply_session_conf, release_shuffles, work_path
from .sources import files, lake
from .sources import weather as WX
from .sources.fixtures import Fixtures
from .sources.versions import read_table
from .streaming.incremental import BRONZE_PARTITIONS, append_bronze, incremental_load, write_bronze

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_session_conf(spark)
            return fn(Fixtures(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        REGISTRY[name] = run
        return fn
    return deco


# --------------------------------------------------------------- gold over fx_trips
@register("top_zones")
def _top_zones(fx: Fixtures) -> DataFrame:
    return M.top_zones(fx.trips, fx.zones)


@register("top_zone_in_scope")
def _top_zone_in_scope(fx: Fixtures) -> DataFrame:
    return M.top_zone_in_scope(fx.trips, fx.zones)


@register("volumes_by_type_year")
def _volumes_by_type_year(fx: Fixtures) -> DataFrame:
    return M.volumes_by_type_year(fx.trips)


@register("volumes_by_type_month")
def _volumes_by_type_month(fx: Fixtures) -> DataFrame:
    return M.volumes_by_type_month(fx.trips)


@register("distinct_years")
def _distinct_years(fx: Fixtures) -> DataFrame:
    return M.distinct_years(fx.trips)


@register("fees_by_year")
def _fees_by_year(fx: Fixtures) -> DataFrame:
    return M.fees_by_year(fx.trips)


@register("fees_by_month")
def _fees_by_month(fx: Fixtures) -> DataFrame:
    return M.fees_by_month(fx.trips)


@register("fees_by_month_head")
def _fees_by_month_head(fx: Fixtures) -> DataFrame:
    return M.fees_by_month_head(fx.trips)


@register("fee_series")
def _fee_series(fx: Fixtures) -> DataFrame:
    return M.fee_series(fx.trips)


@register("fee_applicability")
def _fee_applicability(fx: Fixtures) -> DataFrame:
    return M.fee_applicability(fx.trips)


@register("fee_status")
def _fee_status(fx: Fixtures) -> DataFrame:
    return M.fee_status(fx.trips)


@register("zone_flows")
def _zone_flows(fx: Fixtures) -> DataFrame:
    return M.zone_flows(fx.trips, fx.zones)


@register("flow_nodes")
def _flow_nodes(fx: Fixtures) -> DataFrame:
    return M.flow_nodes(M.zone_flows(fx.trips, fx.zones))


@register("flow_ribbons")
def _flow_ribbons(fx: Fixtures) -> DataFrame:
    return M.flow_ribbons(M.zone_flows(fx.trips, fx.zones))


@register("flow_matrix")
def _flow_matrix(fx: Fixtures) -> DataFrame:
    return M.flow_matrix(M.zone_flows(fx.trips, fx.zones), M.borough_labels(fx.zones))


@register("price_per_distance")
def _price_per_distance(fx: Fixtures) -> DataFrame:
    return M.price_per_distance(fx.trips)


@register("price_histogram")
def _price_histogram(fx: Fixtures) -> DataFrame:
    return M.price_histogram(fx.trips, fx.zones)


@register("price_density")
def _price_density(fx: Fixtures) -> DataFrame:
    return M.price_density(M.price_histogram(fx.trips, fx.zones))


@register("price_ridgeline")
def _price_ridgeline(fx: Fixtures) -> DataFrame:
    return M.price_ridgeline(M.price_histogram(fx.trips, fx.zones))


@register("heatmap_year")
def _heatmap_year(fx: Fixtures) -> DataFrame:
    return M.heatmap_year(fx.trips)


@register("heatmap_dense")
def _heatmap_dense(fx: Fixtures) -> DataFrame:
    return M.heatmap_dense(M.heatmap_year(fx.trips))


@register("price_by_weather")
def _price_by_weather(fx: Fixtures) -> DataFrame:
    return M.price_by_weather(fx.trips, fx.weather)


@register("weather_at_trip")
def _weather_at_trip(fx: Fixtures) -> DataFrame:
    return M.weather_at_trip(fx.trips, fx.zones, fx.weather)


@register("kpi_cards")
def _kpi_cards(fx: Fixtures) -> DataFrame:
    return M.kpi_cards(fx.spark, fx.trips, fx.weather)


@register("sentinel_dates")
def _sentinel_dates(fx: Fixtures) -> DataFrame:
    return fx.trips.select("vtype", "pickup_datetime",
                           sentinel_to_null("dropoff_datetime").alias("dropoff_datetime"))


def _sentinel_cleaned(fx: Fixtures) -> DataFrame:
    return fx.trips.select("vtype", "pickup_datetime",
                           sentinel_to_null("dropoff_datetime").alias("dropoff_datetime"),
                           "total_amount")


@register("quality_filter")
def _quality_filter(fx: Fixtures) -> DataFrame:
    return clean.quality_filter(_sentinel_cleaned(fx))


@register("quality_filter_strict")
def _quality_filter_strict(fx: Fixtures) -> DataFrame:
    return clean.quality_filter(_sentinel_cleaned(fx), strict=True)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw eras -> silver (canonical, cleaned, geocoded, filtered) -> top-10 pickup zones."""
    apply_session_conf(spark)
    fx = Fixtures(spark, sf_dir)
    trips = SV.silver_trips(fx.raw_eras(), geo.zone_grid(fx.rings(), fx.zones))
    return M.top_zones(trips, fx.zones)


# --------------------------------------------------------------- geo and silver


def _grid(fx: Fixtures) -> DataFrame:
    return geo.zone_grid(fx.rings(), fx.zones)


@register("zone_grid")
def _zone_grid(fx: Fixtures) -> DataFrame:
    return _grid(fx)


@register("grid_coverage")
def _grid_coverage(fx: Fixtures) -> DataFrame:
    return geo.grid_coverage(fx.rings(), _grid(fx))


@register("zone_centroids")
def _zone_centroids(fx: Fixtures) -> DataFrame:
    return geo.zone_centroids(fx.rings(), fx.zones)


@register("zone_centroids_state_plane")
def _zone_centroids_state_plane(fx: Fixtures) -> DataFrame:
    """Zone rings as published, in EPSG:2263 feet (the fixture rings projected
    forward), brought back to degrees by the library's reprojection: the
    centroids must be those of the rings in degrees (6 decimals)."""
    def to_feet(p):
        x, y = to_easting_northing(p["lon"], p["lat"])
        return F.struct(x.alias("lon"), y.alias("lat"))
    feet = fx.rings().withColumn("pts", F.transform("pts", to_feet))
    return geo.zone_centroids(feet.withColumn("pts", rings_to_wgs84("pts")), fx.zones, digits=6)


@register("zones_per_borough")
def _zones_per_borough(fx: Fixtures) -> DataFrame:
    # the zone table holds the zones that have geometry (one row per zone with a valid ring)
    return geo.zones_per_borough(geo.zone_centroids(fx.rings(), fx.zones))


@register("era_union")
def _era_union(fx: Fixtures) -> DataFrame:
    return clean.era_union(fx.raw_eras())


@register("clean_values")
def _clean_values(fx: Fixtures) -> DataFrame:
    c = clean.clean_values(clean.era_union(fx.raw_eras()))
    return c.select("vtype", "pickup_datetime", "dropoff_datetime", "trip_distance", "rate_code_id",
                    "store_and_fwd_flag", "payment_type", "improvement_surcharge_applicable",
                    "congestion_surcharge_applicable", "airport_fee_applicable",
                    "cbd_convenience_fee_applicable")


@register("normalize_flag")
def _normalize_flag(fx: Fixtures) -> DataFrame:
    u = clean.era_union(fx.raw_eras())
    return (u.groupBy("store_and_fwd_raw", normalize_flag("store_and_fwd_raw").alias("store_and_fwd_flag"))
             .agg(F.count(F.lit(1)).alias("n")))


@register("normalize_category")
def _normalize_category(fx: Fixtures) -> DataFrame:
    u = clean.era_union(fx.raw_eras())
    return (u.groupBy("payment_type_raw", normalize_category("payment_type_raw").alias("payment_type"))
             .agg(F.count(F.lit(1)).alias("n")))


@register("geocode")
def _geocode(fx: Fixtures) -> DataFrame:
    c = clean.clean_values(clean.era_union(fx.raw_eras()))
    return geo.geocode(c, _grid(fx)).select("vtype", "pickup_datetime", "pickup_location_id",
                                            "dropoff_location_id")


@register("geocode_spans")
def _geocode_spans(fx: Fixtures) -> DataFrame:
    """The lookup in the grid's spans gives what the lookup in its cells gives."""
    c = clean.clean_values(clean.era_union(fx.raw_eras()))
    return geo.geocode(c, geo.grid_spans(_grid(fx))).select("vtype", "pickup_datetime", "pickup_location_id", "dropoff_location_id")


@register("silver_trips")
def _silver_trips(fx: Fixtures) -> DataFrame:
    return SV.silver_trips(fx.raw_eras(), _grid(fx))


# --------------------------------------------------------------- lake bookkeeping


def _inventory(fx: Fixtures) -> DataFrame:
    return lake.partition_inventory(fx.trips)


@register("partition_inventory")
def _partition_inventory(fx: Fixtures) -> DataFrame:
    return _inventory(fx)


@register("coverage_summary")
def _coverage_summary(fx: Fixtures) -> DataFrame:
    return lake.coverage_summary(_inventory(fx))


@register("month_calendar")
def _month_calendar(fx: Fixtures) -> DataFrame:
    return lake.month_calendar(_inventory(fx), first_months=SC.VEHICLES)


@register("missing_months")
def _missing_months(fx: Fixtures) -> DataFrame:
    inv = _inventory(fx).checkpoint()     # small; read by the calendar and the anti join
    return lake.missing_months(lake.month_calendar(inv, first_months=SC.VEHICLES), inv)


@register("file_period_parse")
def _file_period_parse(fx: Fixtures) -> DataFrame:
    return lake.parse_file_period(fx.view("fx_file_names"))


@register("weather_years_needed")
def _weather_years_needed(fx: Fixtures) -> DataFrame:
    return WX.years_needed(fx.trips, fx.weather.select(F.year("ts").alias("year")))


# --------------------------------------------------------------- sources and sinks (written, read back)
def _file_months(fx: Fixtures) -> list[DataFrame]:
    """The raw eras with the year and month of the file that each row sits in, dealt by file."""
    return [e.withColumns({"year": F.year("_file_ts"), "month": F.month("_file_ts")}).drop("_file_ts")
            for e in fx.raw_eras(keep_file_month=True, dealt=True)]


def _deliveries(fx: Fixtures) -> str:
    """A folder with the raw eras in two deliveries, ``era<i>/late=<true or false>/vtype=/year=/month=``: the tables are read
    and joined once for both. Every row is in one of them."""
    aside = work_path(fx.spark, "deliveries")
    for i, era in enumerate(_file_months(fx), start=1):
        late = F.pmod(F.xxhash64(*era.columns), F.lit(3)) == 0
        era.withColumn("late", late).write.partitionBy("late", *BRONZE_PARTITIONS).parquet(f"{aside}/era{i}")
        release_shuffles(fx.spark)
    return aside


def _deliver(fx: Fixtures, aside: str, late: bool, root: str) -> None:
    for era in sorted(files.matching(fx.spark, f"{aside}/era*")):
        files.move_tree(fx.spark, f"{era}/late={str(late).lower()}", root, "late-" if late else "")


def _written_spans(fx: Fixtures) -> DataFrame:
    """The grid's spans, written once and read by every load: a row for up to 64 cells, and of a size that Spark knows."""
    path = work_path(fx.spark, "spans")
    geo.grid_spans(_grid(fx)).write.parquet(path)
    return fx.spark.read.parquet(path)


@register("weather_json_explode")
def _weather_json_explode(fx: Fixtures) -> DataFrame:
    path = work_path(fx.spark, "bronze-weather")
    WX.write_weather_documents(fx.weather, path)
    return WX.read_weather_json(fx.spark, path)


@register("weather_roundtrip")
def _weather_roundtrip(fx: Fixtures) -> DataFrame:
    path = work_path(fx.spark, "silver-weather")
    WX.write_weather(fx.weather, path)
    return read_table(fx.spark, path)


@register("silver_roundtrip")
def _silver_roundtrip(fx: Fixtures) -> DataFrame:
    path = work_path(fx.spark, "silver-trips")
    # each row keeps the month of the file it came from (replace-by-source layout)
    eras = [SV.tag_source(e, year_month("_file_ts")).drop("_file_ts")
            for e in fx.raw_eras(keep_file_month=True)]
    grid = _written_spans(fx)
    # one era after another, so that the shuffles of one are gone when the next one's begin. The fixture rows come
    # out of a join, not clustered by month: rebalance first
    for i, era in enumerate(eras):
        SV.write_silver(SV.silver_trips([era], grid, keep=("vtype", SV.SOURCE_COL)), path, rebalance=True,
                        mode="append" if i else "overwrite")
        release_shuffles(fx.spark)
    return SV.read_silver(fx.spark, path).select(*SC.FINAL_COLS, "year", "month")


@register("bronze_tree_load")
def _bronze_tree_load(fx: Fixtures) -> DataFrame:
    spark = fx.spark
    # the reference's bronze layout: one vtype=/year=/month= tree (month of the file),
    # files of all schema eras side by side
    root = work_path(spark, "bronze-tree")
    for era in _file_months(fx):
        append_bronze(era, root, dealt=True)
        release_shuffles(spark)
    silver = work_path(spark, "silver-tree")
    grid = _written_spans(fx)     # computed once, read by both loads
    SV.load_bronze_tree(spark, root, grid, silver)
    SV.load_bronze_tree(spark, root, grid, silver)   # a rerun finds nothing pending
    return spark.read.parquet(silver).select(*SC.FINAL_COLS, "year", "month")


@register("incremental_load")
def _incremental_load(fx: Fixtures) -> DataFrame:
    spark = fx.spark
    bronze = write_bronze(fx.raw_eras(keep_file_month=True), work_path(spark, "bronze-trips"))
    silver, ckpt = work_path(spark, "silver-stream"), work_path(spark, "stream-ckpt")
    grid = _grid(fx).checkpoint()     # cut lineage: computed once, reused by every batch
    incremental_load(spark, bronze, grid, silver, ckpt)
    incremental_load(spark, bronze, grid, silver, ckpt)   # a rerun finds nothing new
    return spark.read.parquet(silver).select(*SC.FINAL_COLS, "year", "month")


@register("bronze_tree_late_file")
def _bronze_tree_late_file(fx: Fixtures) -> DataFrame:
    """Files that arrive later in months already loaded: the second load rebuilds those sources."""
    spark, root, silver = fx.spark, work_path(fx.spark, "late-tree"), work_path(fx.spark, "late-silver")
    grid, aside = _written_spans(fx), _deliveries(fx)
    for late in (False, True):
        _deliver(fx, aside, late, root)
        SV.load_bronze_tree(spark, root, grid, silver)
    return spark.read.parquet(silver).select(*SC.FINAL_COLS, "year", "month")


@register("incremental_schema_drift")
def _incremental_schema_drift(fx: Fixtures) -> DataFrame:
    """One bronze tree whose later files bring fee columns that the first ones lack."""
    spark, root = fx.spark, work_path(fx.spark, "drift-tree")
    silver, ckpt = work_path(spark, "drift-silver"), work_path(spark, "drift-ckpt")
    grid = _written_spans(fx)
    for era in _file_months(fx):
        append_bronze(era, root, dealt=True)
        incremental_load(spark, [root], grid, silver, ckpt)
    return spark.read.parquet(silver).select(*SC.FINAL_COLS, "year", "month")


@register("incremental_old_file")
def _incremental_old_file(fx: Fixtures) -> DataFrame:
    """The stream beside files that a source's memory would lose: the second delivery is dated years back, a file of
    the first is rewritten under its name, and a type that was loaded by mistake is deleted."""
    spark, root = fx.spark, work_path(fx.spark, "old-tree")
    silver, ckpt = work_path(spark, "old-silver"), work_path(spark, "old-ckpt")
    grid, deliveries = _written_spans(fx), _deliveries(fx)
    mistake = spark.read.parquet(f"{deliveries}/era1").where("vtype = 'yellow'").drop("late").withColumn("vtype", F.lit("mistake"))
    append_bronze(mistake, root, dealt=True)
    _deliver(fx, deliveries, False, root)
    # one file holds, for now, what another one of its type holds, and gets its own content later
    name, other = lake.parquet_files(spark, root).where("vtype = 'yellow'").agg(F.min("path"), F.max("path")).first()
    aside = f"{root}/_aside"
    files.move(spark, name, aside)
    files.copy(spark, other, name)
    incremental_load(spark, [root], grid, silver, ckpt)
    before = {r["path"] for r in lake.parquet_files(spark, root).select("path").collect()}
    files.remove(spark, name)
    files.move(spark, aside, name)
    files.redate(spark, [name], 1_400_000_000)
    _deliver(fx, deliveries, True, root)
    came = [r["path"] for r in lake.parquet_files(spark, root).select("path").collect() if r["path"] not in before]
    files.redate(spark, came, 1_400_000_000)
    files.remove(spark, f"{root}/vtype=mistake")
    incremental_load(spark, [root], grid, silver, ckpt)
    return spark.read.parquet(silver).select(*SC.FINAL_COLS, "year", "month")


@register("weather_duplicate_hours")
def _weather_duplicate_hours(fx: Fixtures) -> DataFrame:
    """Documents that hold each hour twice, once without measures: the full row counts."""
    path, silver = work_path(fx.spark, "dup-weather"), work_path(fx.spark, "dup-silver")
    empty = fx.weather.select("ts", *[F.lit(None).cast(t).alias(c) for c, t in fx.weather.dtypes if c != "ts"])
    WX.write_weather_documents(empty.unionByName(fx.weather), path)
    WX.write_weather(WX.read_weather_json(fx.spark, path), silver)
    return M.price_by_weather(fx.trips, read_table(fx.spark, silver))


@register("weather_overwrite")
def _weather_overwrite(fx: Fixtures) -> DataFrame:
    """The second write replaces the whole table, also years that it does not hold."""
    path = work_path(fx.spark, "weather-overwrite")
    for years in (F.year("ts") < 2022, F.year("ts") >= 2022):
        WX.write_weather(fx.weather.where(years), path)
    return read_table(fx.spark, path)


@register("weather_head")
def _weather_head(fx: Fixtures) -> DataFrame:
    return WX.weather_head(fx.weather)


@register("weather_at_hour")
def _weather_at_hour(fx: Fixtures) -> DataFrame:
    return M.weather_at_trip(fx.trips, fx.zones, fx.weather, hour="2021-07-15 08:00:00", head=5)


@register("weather_at_trip_head")
def _weather_at_trip_head(fx: Fixtures) -> DataFrame:
    return M.weather_at_trip(fx.trips, fx.zones, fx.weather, head=5)


@register("heatmap_one_year")
def _heatmap_one_year(fx: Fixtures) -> DataFrame:
    return M.heatmap_year(fx.trips, year=2021)


@register("price_histogram_zone")
def _price_histogram_zone(fx: Fixtures) -> DataFrame:
    return M.price_histogram(fx.trips, fx.zones, zone_name="NATION_19")


@register("dimension_roundtrip")
def _dimension_roundtrip(fx: Fixtures) -> DataFrame:
    """Zone table and grid as the lake build writes them (unpartitioned), read back."""
    paths = LakePaths(work_path(fx.spark, "dimensions"))
    build_zones(fx.rings(), fx.zones, paths)
    cells = read_table(fx.spark, paths.grid).groupBy("location_id").agg(F.count(F.lit(1)).alias("cells"))
    return read_table(fx.spark, paths.zones).join(cells, "location_id", "left")


@register("inventory_from_listing")
def _inventory_from_listing(fx: Fixtures) -> DataFrame:
    path = work_path(fx.spark, "listing")
    SV.write_silver(fx.trips, path, rebalance=True)
    return lake.partition_inventory_at(fx.spark, path)


@register("last_published_month")
def _last_published_month(fx: Fixtures) -> DataFrame:
    """Months missing up to the newest one that should be published on a given day."""
    inv = _inventory(fx).checkpoint()
    last = lake.last_published_month("2026-06-10")
    return lake.missing_months(lake.month_calendar(inv, first_months=SC.VEHICLES, last_month=last), inv)


@register("zone_centroids_nested")
def _zone_centroids_nested(fx: Fixtures) -> DataFrame:
    """Per supplier a square with smaller squares off its centre inside: the centre is the square's."""
    k = F.col("s_suppkey").cast("double")

    def square(ring, x, y, side):
        p = [F.struct((x + dx * side).alias("lon"), (y + dy * side).alias("lat")) for dx, dy in ((0, 0), (1, 0), (1, 1), (0, 1), (0, 0))]
        return F.struct((F.col("s_suppkey") * 3 + ring).cast("long").alias("ring_id"), F.array(*p).alias("pts"))

    x, y = -74 + F.pmod(k, F.lit(50.0)) / 64, 40 + F.floor(k / 50) / 64
    rings = F.array(square(0, x + 1 / 1024, y + 1 / 1024, 1 / 512), square(1, x, y, 1 / 128), square(2, x + 1 / 512, y + 1 / 512, 1 / 1024))
    return geo.zone_centroids(fx.tables.supplier.select(F.col("s_suppkey").cast("int").alias("location_id"), F.inline(rings)), digits=6)


@register("zone_centroids_overlapping")
def _zone_centroids_overlapping(fx: Fixtures) -> DataFrame:
    """Per supplier a square, a smaller one inside that shares two of its sides, one that overlaps it by half, a triangle across
    both and a copy of the first: the union is a rectangle of one and a half squares, and so is the centre."""
    k = F.col("s_suppkey").cast("double")
    x, y, u = -74 + F.pmod(k, F.lit(50.0)) / 32, 40 + F.floor(k / 50) / 32, 1 / 128

    def ring(n, *points):
        p = [F.struct((x + px * u).alias("lon"), (y + py * u).alias("lat")) for px, py in (*points, points[0])]
        return F.struct((F.col("s_suppkey") * 5 + n).cast("long").alias("ring_id"), F.array(*p).alias("pts"))

    whole = ((0, 0), (1, 0), (1, 1), (0, 1))
    rings = F.array(ring(0, *whole), ring(1, (0.5, 0.5), (1, 0.5), (1, 1), (0.5, 1)), ring(2, (0.5, 0), (1.5, 0), (1.5, 1), (0.5, 1)),
                    ring(3, (0.25, 0.25), (1.25, 0.75), (0.5, 1)), ring(4, *reversed(whole)))
    return geo.zone_centroids(fx.tables.supplier.select(F.col("s_suppkey").cast("int").alias("location_id"), F.inline(rings)), digits=6)


@register("gold_refresh")
def _gold_refresh(fx: Fixtures) -> DataFrame:
    """Gold brought up to date after a second delivery of months, from the parts of the first and the trips of the second."""
    spark, silver, gold = fx.spark, work_path(fx.spark, "refresh-silver"), work_path(fx.spark, "refresh-gold")
    trips = fx.trips.withColumn(SV.SOURCE_COL, year_month("pickup_datetime"))
    for late in (False, True):
        SV.write_silver(trips.where((F.col("month") % 3 == 0) == late), silver, rebalance=True)
        refresh_gold(spark, silver, fx.zones, fx.weather, gold)
    return read_table(spark, f"{gold}/fees_by_month")
