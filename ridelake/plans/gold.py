"""Gold layer: every mart computed from the silver tables, optionally written.

The reference queries silver directly and renders the results; here each mart
is a DataFrame that can also be materialised as its own Parquet table (small:
all marts are aggregates bounded by types x months, zones or bins).
"""
from __future__ import annotations

import threading
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir
from ..sources.versions import replace_table
from . import marts as M


def marts(spark: SparkSession, trips: DataFrame | None, zones: DataFrame, weather: DataFrame,
          given: dict[str, Callable[[], DataFrame]] | None = None) -> dict[str, Callable[[], DataFrame]]:
    """Name -> builder of each gold mart (lazy: nothing runs until a builder is called).

    Several marts are views of the same small aggregate: the hourly profile
    (volumes, heatmap, price by weather, KPI row), the zone-pair counts
    (borough flows with matrix, nodes and ribbons; top zones; the histogram's
    zone), the price histogram (histogram, ridgeline) and the monthly fee
    table (fees, fee series). Each is computed from the trips once, on first
    use, and checkpointed (it is bounded by the calendar, the zones or the
    bins, not by the trip volume), so building all marts scans the trip
    table four times instead of once or more per mart. ``given`` names builders of shared aggregates
    (``profile, pairs, hist, monthly``) to use in place of those that read the trips.
    """
    ensure_checkpoint_dir(spark)     # shared aggregates are checkpointed there
    shared: dict[str, DataFrame] = {}

    def once(name: str, build: Callable[[], DataFrame]) -> Callable[[], DataFrame]:
        lock = threading.Lock()      # marts may be built from several threads

        def get() -> DataFrame:
            with lock:
                if name not in shared:
                    shared[name] = build().checkpoint()
            return shared[name]
        return get

    given = given or {}
    prof = once("profile", given.get("profile", lambda: M.hourly_profile(trips)))
    pairs = once("pairs", given.get("pairs", lambda: M.zone_pairs(trips)))
    flows = once("flows", lambda: M.zone_flows_from_pairs(pairs(), zones))
    hist = once("hist", given.get("hist", lambda: M.price_histogram(trips, zones)))
    monthly = once("monthly", given.get("monthly", lambda: M.fees_by_month(trips)))
    return {
        "volumes": lambda: M.volumes_from_profile(prof()),
        "fees_by_month": monthly,
        "fee_series": lambda: M.fee_series_from_monthly(monthly()),
        "zone_flows": flows,
        "flow_matrix": lambda: M.flow_matrix(flows(), M.borough_labels(zones)),
        "flow_nodes": lambda: M.flow_nodes(flows()),
        "flow_ribbons": lambda: M.flow_ribbons(flows()),
        "price_histogram": hist,
        "price_ridgeline": lambda: M.price_ridgeline(hist()),
        "heatmap": lambda: M.heatmap_dense(M.heatmap_from_profile(prof())),
        "price_by_weather": lambda: M.price_by_weather_from_profile(prof(), weather),
        "top_zones": lambda: M.top_zones_from_pairs(pairs(), zones),
        "kpi_cards": lambda: M.kpi_cards_from_profile(spark, prof(), weather),
    }


def write_gold(spark: SparkSession, trips: DataFrame | None, zones: DataFrame, weather: DataFrame,
               root: str, names: list[str] | None = None, parallel: int = 4,
               given: dict[str, Callable[[], DataFrame]] | None = None) -> list[str]:
    """Write the chosen marts (default: all) as ``<root>/<name>`` Parquet tables, each replaced in one
    step (read them with ``read_table``).

    The marts are independent jobs: ``parallel`` driver threads submit them at
    once, so Spark overlaps their scans and fills the task slots one job's
    tail leaves idle. Each shared aggregate is still computed once."""
    built = marts(spark, trips, zones, weather, given)
    chosen = names or list(built)

    def write(name: str) -> str:
        replace_table(built[name](), f"{root.rstrip('/')}/{name}")
        return name

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        return list(pool.map(write, chosen))
