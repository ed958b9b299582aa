"""End-to-end lake build in the reference's order: zones -> trips -> weather ->
quality report -> gold. Each step reads what the previous one wrote, so a
step can be re-run on its own; every step is a Spark job (no driver-side rows).
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..functions.projection import ConicConformal, rings_to_wgs84
from ..operators import geo
from ..schema import WEATHER_SCHEMA
from ..sources import weather as WX
from ..sources.versions import has_table, read_table, replace_table
from ..streaming.incremental import incremental_load
from . import marts as M
from .gold import write_gold


@dataclass
class LakePaths:
    root: str

    def __post_init__(self):
        self.root = self.root.rstrip("/")

    @property
    def grid(self) -> str:
        return f"{self.root}/silver/ref/grid_zones"

    @property
    def spans(self) -> str:
        return f"{self.root}/silver/ref/grid_spans"

    @property
    def zones(self) -> str:
        return f"{self.root}/silver/ref/zones"

    @property
    def trips(self) -> str:
        return f"{self.root}/silver/trips"

    @property
    def weather(self) -> str:
        return f"{self.root}/silver/weather_hourly"

    @property
    def stream_checkpoint(self) -> str:
        return f"{self.root}/_checkpoints/silver_trips"

    @property
    def gold(self) -> str:
        return f"{self.root}/gold"


def build_zones(rings: DataFrame, names: DataFrame, paths: LakePaths,
                crs: ConicConformal | None = None) -> None:
    """Zone table (id, borough, name, centroid), the grid and its spans (what trips are looked up in), all written.
    With ``crs`` the ring vertices are (easting, northing) in that projection
    (the published polygons use EPSG:2263, ``NY_LONG_ISLAND_FTUS``) and are
    brought to degrees first, vertex by vertex, as built-in expressions."""
    if crs is not None:
        rings = rings.withColumn("pts", rings_to_wgs84("pts", crs))
    replace_table(geo.zone_centroids(rings, names), paths.zones)
    replace_table(geo.zone_grid(rings, names), paths.grid)
    replace_table(geo.grid_spans(read_table(rings.sparkSession, paths.grid)), paths.spans)


def build_trips(spark: SparkSession, bronze_eras: list[str], paths: LakePaths,
                max_files_per_trigger: int | None = None) -> int:
    """Incremental silver load of every bronze file not yet processed (in
    micro-batches of at most ``max_files_per_trigger`` files when given)."""
    return incremental_load(spark, bronze_eras, read_table(spark, paths.spans), paths.trips, paths.stream_checkpoint,
                            max_files_per_trigger)


def build_trips_from_tree(spark: SparkSession, bronze_root: str, paths: LakePaths) -> int:
    """Batch incremental silver load of a bronze tree in the reference's layout
    (``vtype=/year=/month=``, drifting schemas): every month not yet in silver."""
    from .silver import load_bronze_tree
    return load_bronze_tree(spark, bronze_root, read_table(spark, paths.spans), paths.trips)


def build_weather(spark: SparkSession, bronze_weather: str, paths: LakePaths) -> bool:
    """Weather JSON -> hourly table (full overwrite). No document, or none with an hour:
    nothing is written and the table stays as it is."""
    if not WX.has_documents(spark, bronze_weather):
        return False
    hourly = WX.read_weather_json(spark, bronze_weather)
    if hourly.isEmpty():
        return False
    WX.write_weather(hourly, paths.weather)
    return True


def read_weather(spark: SparkSession, paths: LakePaths) -> DataFrame:
    """The hourly table, or an empty one of its schema when no weather was ever loaded."""
    if not has_table(spark, paths.weather):
        return spark.createDataFrame([], WEATHER_SCHEMA)
    return read_table(spark, paths.weather)


def quality_report(trips: DataFrame, zones: DataFrame) -> dict[str, DataFrame]:
    """Volumes (with months and zone fill rate), top-10 pickup zones and fee
    averages by year (NULL means the fee did not exist yet)."""
    return {"volumes": M.volumes_by_type_year(trips),
            "top_zones": M.top_zones(trips, zones),
            "fees_by_year": M.fees_by_year(trips)}


def build_lake(spark: SparkSession, bronze_eras: list[str], rings: DataFrame, names: DataFrame,
               bronze_weather: str, root: str, max_files_per_trigger: int | None = None,
               bronze_tree: str | None = None, crs: ConicConformal | None = None) -> LakePaths:
    """Whole lake. Trips come from era folders through the streaming load, or,
    with ``bronze_tree``, from one ``vtype=/year=/month=`` tree in the
    reference's layout through the batch tree load; ``crs`` names the
    projection of the ring vertices when they are not in degrees."""
    paths = LakePaths(root)
    build_zones(rings, names, paths, crs)
    if bronze_tree is not None:
        build_trips_from_tree(spark, bronze_tree, paths)
    else:
        build_trips(spark, bronze_eras, paths, max_files_per_trigger)
    build_weather(spark, bronze_weather, paths)
    trips = spark.read.parquet(paths.trips)
    zones = read_table(spark, paths.zones)
    weather = read_weather(spark, paths)
    write_gold(spark, trips, zones, weather, paths.gold)
    return paths
