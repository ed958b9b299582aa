"""Ride-shaped test views derived from the driver's TPC-H-like tables.

Each view is one SQL text that runs unchanged in Spark SQL and in DuckDB (the
only dialect switches are the naive-timestamp literal keyword and the name of
the make-timestamp function), so the Spark operators and the DuckDB oracle
read identical input. No expression goes through the session time zone.
All views are derived from ``lineitem`` / ``orders`` / ``customer`` /
``supplier`` / ``nation`` / ``region`` and grow with them.

Timestamps are the ship dates moved forward 24 years (1995-2001 -> 2019-2025)
so the fee introduction dates of the ride data fall inside the range; a 24-year
shift keeps every 29 February a 29 February.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import Tables

SPARK = {"ntz": "TIMESTAMP_NTZ", "mk_ts": "make_timestamp_ntz"}
DUCK = {"ntz": "TIMESTAMP", "mk_ts": "make_timestamp"}

# One row per line item with the keys the ride views need.
FX_BASE = """
SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_quantity,
       l.l_extendedprice, l.l_discount, l.l_tax,
       s.s_nationkey, c.c_nationkey,
       l.l_shipdate + INTERVAL '24' YEAR
         + INTERVAL '1' SECOND * ((l.l_partkey * 7919 + l.l_suppkey * 104729) % 86400) AS pu,
       CASE l.l_linenumber % 4 WHEN 0 THEN 'fhv' WHEN 1 THEN 'yellow'
            WHEN 2 THEN 'green' ELSE 'fhvhv' END AS vtype
FROM {lineitem} l
JOIN {orders} o ON l.l_orderkey = o.o_orderkey
JOIN {customer} c ON o.o_custkey = c.c_custkey
JOIN {supplier} s ON l.l_suppkey = s.s_suppkey
"""

# Silver-shaped trips (already canonical), still holding dirty rows for the filters.
FX_TRIPS = """
SELECT vtype,
  CASE WHEN vtype IN ('fhv', 'fhvhv') THEN 'B0' || CAST(l_suppkey % 40 AS STRING)
       ELSE CAST(l_suppkey % 2 + 1 AS STRING) END AS vendor_id,
  pu AS pickup_datetime,
  CASE WHEN l_partkey % 97 = 0 THEN {ntz} '1989-01-01 00:00:00'
       WHEN l_partkey % 89 = 0 THEN pu + INTERVAL '1' SECOND * 90000
       WHEN l_partkey % 83 = 0 THEN pu - INTERVAL '1' SECOND * 60
       ELSE pu + INTERVAL '1' SECOND * (CAST(l_quantity AS BIGINT) * 300) END AS dropoff_datetime,
  CASE WHEN vtype IN ('yellow', 'green') THEN CAST(l_quantity AS INT) % 6 + 1 END AS passenger_count,
  CASE WHEN vtype <> 'fhv' THEN CAST(l_partkey % 700 AS DOUBLE) / 10 - 3 END AS trip_distance,
  CASE WHEN l_suppkey % 13 <> 0 THEN s_nationkey END AS pickup_location_id,
  CASE WHEN l_orderkey % 53 = 0 THEN c_nationkey + 30 ELSE c_nationkey END AS dropoff_location_id,
  CASE WHEN vtype IN ('yellow', 'green') THEN CAST(l_partkey % 6 + 1 AS INT) END AS rate_code_id,
  CASE WHEN vtype IN ('yellow', 'green') THEN
       CASE WHEN l_orderkey % 10 = 0 THEN 'Y' ELSE 'N' END END AS store_and_fwd_flag,
  CASE WHEN vtype IN ('yellow', 'green') THEN
       CASE l_orderkey % 7 WHEN 0 THEN 'carte' WHEN 1 THEN 'especes' WHEN 2 THEN 'sans_frais'
            WHEN 3 THEN 'litige' WHEN 4 THEN 'inconnu' WHEN 5 THEN 'annule' ELSE 'autre' END
       END AS payment_type,
  CASE WHEN vtype <> 'fhv' THEN l_extendedprice / 1500 END AS fare_amount,
  CASE WHEN vtype IN ('yellow', 'green') THEN l_discount * 10 END AS extra,
  CASE WHEN vtype IN ('yellow', 'green') THEN CAST(0.5 AS DOUBLE) END AS mta_tax,
  CASE WHEN vtype <> 'fhv' THEN l_extendedprice / 1500 * l_discount END AS tip_amount,
  CASE WHEN vtype <> 'fhv' THEN
       CASE WHEN l_partkey % 10 = 0 THEN CAST(6.55 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END END AS tolls_amount,
  CASE WHEN vtype IN ('yellow', 'green') AND CAST(pu AS DATE) >= DATE '2015-07-01' THEN
       CASE WHEN l_partkey % 5 = 0 THEN CAST(0 AS DOUBLE) ELSE l_tax * 10 END END AS improvement_surcharge,
  CASE WHEN vtype <> 'fhv' AND CAST(pu AS DATE) >= DATE '2019-02-01' THEN
       CASE WHEN l_partkey % 4 = 0 THEN CAST(0 AS DOUBLE) ELSE l_tax * 30 END END AS congestion_surcharge,
  CASE WHEN vtype <> 'fhv' AND CAST(pu AS DATE) >= DATE '2022-07-01' THEN
       CASE WHEN l_partkey % 3 = 0 THEN l_tax * 20 ELSE CAST(0 AS DOUBLE) END END AS airport_fee,
  CASE WHEN vtype <> 'fhv' AND CAST(pu AS DATE) >= DATE '2025-01-05' THEN
       CASE WHEN l_linenumber = 3 THEN CAST(0 AS DOUBLE) ELSE l_tax * 9 END END AS cbd_convenience_fee,
  CASE WHEN vtype = 'fhv' THEN NULL
       WHEN l_partkey % 79 = 0 THEN CAST(-1 AS DOUBLE)
       ELSE l_extendedprice / 1500 + l_discount * 10 + CAST(0.5 AS DOUBLE) END AS total_amount,
  CAST(pu AS DATE) >= DATE '2015-07-01' AS improvement_surcharge_applicable,
  CAST(pu AS DATE) >= DATE '2019-02-01' AS congestion_surcharge_applicable,
  CAST(pu AS DATE) >= DATE '2022-07-01' AS airport_fee_applicable,
  CAST(pu AS DATE) >= DATE '2025-01-05' AS cbd_convenience_fee_applicable,
  CAST(year(pu) AS INT) AS year,
  CAST(month(pu) AS INT) AS month
FROM {fx_base}
"""

# Zone dimension: a nation is a zone, its region the borough.
FX_ZONES = """
SELECT n.n_nationkey AS location_id, r.r_name AS borough, n.n_name AS zone_name
FROM {nation} n JOIN {region} r ON n.n_regionkey = r.r_regionkey
"""

# Hourly weather for every hour in which some trip starts, except a few
# missing hours and the latest year (not fetched yet); measures are functions
# of an hour number h.
FX_WEATHER = """
SELECT ts,
  CAST(h % 400 AS DOUBLE) / 10 - 5 AS temperature_c,
  CAST(h * 7 % 100 AS DOUBLE) AS humidite_pct,
  CASE WHEN h % 101 = 0 THEN NULL ELSE CAST(h * 37 % 11 AS DOUBLE) / 20 END AS precipitation_mm,
  CASE WHEN h % 101 = 0 THEN NULL ELSE CAST(h * 37 % 11 AS DOUBLE) / 25 END AS pluie_mm,
  CASE WHEN month(ts) IN (1, 2, 12) THEN CAST(h % 3 AS DOUBLE) / 10 ELSE CAST(0 AS DOUBLE) END AS neige_mm,
  CAST(h * 11 % 60 AS DOUBLE) / 2 AS vent_kmh,
  CAST(h % 4 AS INT) AS code_meteo
FROM (
  SELECT ts, (CAST(year(ts) AS BIGINT) * 366 + dayofyear(ts)) * 24 + hour(ts) AS h
  FROM (SELECT DISTINCT {mk_ts}(year(pu), month(pu), day(pu), hour(pu), 0, 0) AS ts FROM {fx_base}) d
) w
WHERE h % 211 <> 0 AND year(ts) < 2025
"""

# Zone rings in vertex form (units of 1e-4 degree, closed rings): one rectangle
# per supplier (side 0.02 deg, 0.005 deg for every fifth), a triangle with a
# higher ring id in some rectangles (the lower ring id owns shared cells) and a
# degenerate three-point ring that must be skipped.
FX_RING_PARAMS = """
SELECT s_suppkey AS k, s_nationkey AS nk,
       -740005 + 200 * (s_suppkey % 50) AS x0,
       406005 + 200 * CAST((s_suppkey - s_suppkey % 50) / 50 AS BIGINT) AS y0,
       CASE WHEN s_suppkey % 5 = 4 THEN 50 ELSE 200 END AS sd
FROM {supplier}
"""

FX_RING_VERTICES = """
SELECT ring_id, location_id, idx, CAST(x AS DOUBLE) / 10000 AS lon, CAST(y AS DOUBLE) / 10000 AS lat
FROM (
  SELECT 3 * k AS ring_id, nk AS location_id, 0 AS idx, x0 AS x, y0 AS y FROM {fx_ring_params}
  UNION ALL SELECT 3 * k, nk, 1, x0 + sd, y0 FROM {fx_ring_params}
  UNION ALL SELECT 3 * k, nk, 2, x0 + sd, y0 + sd FROM {fx_ring_params}
  UNION ALL SELECT 3 * k, nk, 3, x0, y0 + sd FROM {fx_ring_params}
  UNION ALL SELECT 3 * k, nk, 4, x0, y0 FROM {fx_ring_params}
  UNION ALL SELECT 3 * k + 1, (nk + 1) % 25, 0, x0 + 2, y0 + 2 FROM {fx_ring_params} WHERE k % 7 = 3
  UNION ALL SELECT 3 * k + 1, (nk + 1) % 25, 1, x0 + 102, y0 + 2 FROM {fx_ring_params} WHERE k % 7 = 3
  UNION ALL SELECT 3 * k + 1, (nk + 1) % 25, 2, x0 + 52, y0 + 102 FROM {fx_ring_params} WHERE k % 7 = 3
  UNION ALL SELECT 3 * k + 1, (nk + 1) % 25, 3, x0 + 2, y0 + 2 FROM {fx_ring_params} WHERE k % 7 = 3
  UNION ALL SELECT 3 * k + 2, nk, 0, x0, y0 FROM {fx_ring_params} WHERE k % 11 = 5
  UNION ALL SELECT 3 * k + 2, nk, 1, x0 + 10, y0 + 10 FROM {fx_ring_params} WHERE k % 11 = 5
  UNION ALL SELECT 3 * k + 2, nk, 2, x0, y0 FROM {fx_ring_params} WHERE k % 11 = 5
) v
"""

# Raw monthly files under three historical schemas, split by pickup year.
# GPS points fall inside the rectangle of supplier l_suppkey (pick-up) and of
# supplier l_suppkey + l_linenumber (drop-off; beyond the last supplier there
# is no ring, so the point stays unresolved); latitude 935 is junk.
_GPS = """
  (-740005 + 200 * (l_suppkey % 50) + 1
     + l_orderkey % (CASE WHEN l_suppkey % 5 = 4 THEN 48 ELSE 198 END)) AS pux,
  CASE WHEN l_partkey % 37 = 0 THEN 9350000 ELSE
  (406005 + 200 * CAST((l_suppkey - l_suppkey % 50) / 50 AS BIGINT) + 1
     + l_partkey % (CASE WHEN l_suppkey % 5 = 4 THEN 48 ELSE 198 END)) END AS puy,
  (-740005 + 200 * ((l_suppkey + l_linenumber) % 50) + 1
     + l_partkey % (CASE WHEN (l_suppkey + l_linenumber) % 5 = 4 THEN 48 ELSE 198 END)) AS dox,
  (406005 + 200 * CAST(((l_suppkey + l_linenumber) - (l_suppkey + l_linenumber) % 50) / 50 AS BIGINT) + 1
     + l_orderkey % (CASE WHEN (l_suppkey + l_linenumber) % 5 = 4 THEN 48 ELSE 198 END)) AS doy
"""

FILE_TS = "CASE WHEN day(pu) = 1 AND l_orderkey % 3 = 0 THEN pu - INTERVAL '1' DAY ELSE pu END"

FX_RAW_ROWS = """
SELECT b.*, """ + _GPS + """,
  CASE WHEN l_partkey % 97 = 0 THEN {ntz} '1989-01-01 00:00:00'
       WHEN l_partkey % 89 = 0 THEN pu + INTERVAL '1' SECOND * 90000
       WHEN l_partkey % 83 = 0 THEN pu - INTERVAL '1' SECOND * 60
       ELSE pu + INTERVAL '1' SECOND * (CAST(l_quantity AS BIGINT) * 300) END AS dof,
  CASE WHEN l_partkey % 41 = 0 THEN CAST(250 AS DOUBLE)
       ELSE CAST(l_partkey % 700 AS DOUBLE) / 10 - 3 END AS dist,
  l_extendedprice / 1500 AS fare,
  l_extendedprice / 1500 + l_discount * 10 + CAST(0.5 AS DOUBLE) AS tot,
  """ + FILE_TS + """ AS file_ts
FROM {fx_base} b
"""

FX_RAW_ERA1 = """
SELECT vtype, file_ts AS _file_ts,
  CASE WHEN l_orderkey % 43 = 0 THEN 'n/a' ELSE CAST(pu AS STRING) END AS Trip_Pickup_DateTime,
  CAST(dof AS STRING) AS Trip_Dropoff_DateTime,
  CASE l_suppkey % 3 WHEN 0 THEN 'VTS' WHEN 1 THEN 'CMT' ELSE 'DDS' END AS vendor_name,
  CAST(l_quantity AS BIGINT) % 6 AS Passenger_Count,
  CASE WHEN l_orderkey % 31 = 0 THEN CAST('NaN' AS DOUBLE) ELSE dist END AS Trip_Distance,
  CAST(pux AS DOUBLE) / 10000 AS Start_Lon, CAST(puy AS DOUBLE) / 10000 AS Start_Lat,
  CAST(dox AS DOUBLE) / 10000 AS End_Lon, CAST(doy AS DOUBLE) / 10000 AS End_Lat,
  CASE WHEN l_orderkey % 17 = 0 THEN 'x' ELSE CAST(l_partkey % 6 + 1 AS STRING) END AS Rate_Code,
  CASE l_orderkey % 6 WHEN 0 THEN '1' WHEN 1 THEN '0' WHEN 2 THEN 'true' WHEN 3 THEN ' n '
       WHEN 4 THEN 'x' ELSE NULL END AS store_and_forward,
  CASE l_orderkey % 8 WHEN 0 THEN ' Credit' WHEN 1 THEN 'CASH' WHEN 2 THEN 'No Charge'
       WHEN 3 THEN 'Dispute' WHEN 4 THEN 'foo' WHEN 5 THEN 'Unknown' WHEN 6 THEN '2'
       ELSE NULL END AS Payment_Type,
  CASE WHEN vtype = 'fhv' THEN NULL WHEN l_orderkey % 29 = 0 THEN CAST('NaN' AS DOUBLE)
       ELSE fare END AS Fare_Amt,
  CASE WHEN vtype = 'fhv' THEN NULL ELSE l_discount * 10 END AS surcharge,
  CASE WHEN vtype = 'fhv' THEN NULL ELSE CAST(0.5 AS DOUBLE) END AS mta_tax,
  CASE WHEN vtype = 'fhv' THEN NULL ELSE fare * l_discount END AS Tip_Amt,
  CASE WHEN vtype = 'fhv' THEN NULL ELSE CAST(l_partkey % 3 AS DOUBLE) END AS Tolls_Amt,
  CASE WHEN vtype = 'fhv' THEN NULL WHEN l_partkey % 79 = 0 THEN CAST(-1 AS DOUBLE)
       WHEN l_orderkey % 23 = 0 THEN CAST('NaN' AS DOUBLE) ELSE tot END AS Total_Amt
FROM {fx_raw_rows}
WHERE year(pu) < 2021
"""

FX_RAW_ERA2 = """
SELECT vtype, file_ts AS _file_ts,
  pu AS tpep_pickup_datetime,
  dof AS tpep_dropoff_datetime,
  l_suppkey % 2 + 1 AS VendorID,
  CASE WHEN l_orderkey % 19 = 0 THEN CAST('NaN' AS DOUBLE)
       ELSE CAST(CAST(l_quantity AS BIGINT) % 6 AS DOUBLE) END AS passenger_count,
  dist AS trip_distance,
  CAST(pux AS DOUBLE) / 10000 AS pickup_longitude, CAST(puy AS DOUBLE) / 10000 AS pickup_latitude,
  CAST(dox AS DOUBLE) / 10000 AS dropoff_longitude, CAST(doy AS DOUBLE) / 10000 AS dropoff_latitude,
  CASE WHEN l_orderkey % 17 = 0 THEN CAST('NaN' AS DOUBLE)
       ELSE CAST(l_partkey % 6 + 1 AS DOUBLE) END AS RatecodeID,
  CASE WHEN l_orderkey % 10 = 0 THEN 'Y' WHEN l_orderkey % 10 = 1 THEN NULL ELSE 'N' END AS store_and_fwd_flag,
  l_orderkey % 7 AS payment_type,
  CASE WHEN vtype = 'fhv' THEN NULL ELSE fare END AS fare_amount,
  CASE WHEN vtype = 'fhv' THEN NULL ELSE l_discount * 10 END AS extra,
  CASE WHEN vtype = 'fhv' THEN NULL ELSE CAST(0.5 AS DOUBLE) END AS mta_tax,
  CASE WHEN vtype = 'fhv' THEN NULL ELSE fare * l_discount END AS tip_amount,
  CASE WHEN vtype = 'fhv' THEN NULL ELSE CAST(l_partkey % 3 AS DOUBLE) END AS tolls_amount,
  CASE WHEN vtype = 'fhv' THEN NULL WHEN l_partkey % 5 = 0 THEN CAST(0 AS DOUBLE)
       ELSE l_tax * 10 END AS improvement_surcharge,
  CASE WHEN vtype = 'fhv' THEN NULL WHEN l_partkey % 79 = 0 THEN CAST(-1 AS DOUBLE)
       ELSE tot END AS total_amount
FROM {fx_raw_rows}
WHERE year(pu) BETWEEN 2021 AND 2022
"""

FX_RAW_ERA3 = """
SELECT vtype, file_ts AS _file_ts,
  pu AS pickup_datetime,
  dof AS dropOff_datetime,
  'HV000' || CAST(l_suppkey % 4 + 2 AS STRING) AS hvfhs_license_num,
  CASE WHEN vtype = 'fhv' THEN NULL ELSE dist END AS trip_miles,
  CASE WHEN l_suppkey % 13 <> 0 THEN CAST(s_nationkey AS BIGINT) END AS PULocationID,
  CAST(c_nationkey AS BIGINT) AS DOLocationID,
  CASE WHEN vtype = 'fhv' THEN NULL ELSE fare END AS base_passenger_fare,
  CASE WHEN vtype = 'fhv' THEN NULL ELSE fare * l_discount END AS tips,
  CASE WHEN vtype = 'fhv' THEN NULL ELSE CAST(l_partkey % 3 AS DOUBLE) END AS tolls,
  CASE WHEN vtype = 'fhv' THEN NULL WHEN l_partkey % 4 = 0 THEN CAST(0 AS DOUBLE)
       ELSE l_tax * 30 END AS congestion_surcharge,
  CASE WHEN vtype = 'fhv' THEN NULL WHEN l_partkey % 3 = 0 THEN l_tax * 20
       ELSE CAST(0 AS DOUBLE) END AS Airport_fee,
  CASE WHEN vtype = 'fhv' OR CAST(pu AS DATE) < DATE '2025-01-05' THEN NULL
       WHEN l_orderkey % 9 = 0 THEN CAST('NaN' AS DOUBLE) ELSE l_tax * 9 END AS cbd_convenience_fee,
  CASE WHEN vtype = 'fhv' THEN NULL WHEN l_partkey % 79 = 0 THEN CAST(-1 AS DOUBLE)
       ELSE tot END AS total_amount
FROM {fx_raw_rows}
WHERE year(pu) >= 2023
"""

# Monthly file names as published ("<type>_tripdata_YYYY-MM.parquet"), one per
# line item, plus unfinished downloads whose names must not match.
FX_FILE_NAMES = """
SELECT vtype,
  vtype || '_tripdata_' || CAST(year(pu) AS STRING) || '-' || lpad(CAST(month(pu) AS STRING), 2, '0')
    || CASE WHEN l_orderkey % 97 = 0 THEN '.parquet.part' ELSE '.parquet' END AS file_name
FROM {fx_base}
"""

# name -> (sql, names of the inputs it reads)
VIEWS = {
    "fx_base": (FX_BASE, ["lineitem", "orders", "customer", "supplier"]),
    "fx_trips": (FX_TRIPS, ["fx_base"]),
    "fx_zones": (FX_ZONES, ["nation", "region"]),
    "fx_weather_hourly": (FX_WEATHER, ["fx_base"]),
    "fx_ring_params": (FX_RING_PARAMS, ["supplier"]),
    "fx_ring_vertices": (FX_RING_VERTICES, ["fx_ring_params"]),
    "fx_raw_rows": (FX_RAW_ROWS, ["fx_base"]),
    "fx_file_names": (FX_FILE_NAMES, ["fx_base"]),
    "fx_raw_era1": (FX_RAW_ERA1, ["fx_raw_rows"]),
    "fx_raw_era2": (FX_RAW_ERA2, ["fx_raw_rows"]),
    "fx_raw_era3": (FX_RAW_ERA3, ["fx_raw_rows"]),
}
BASE_TABLES = {"lineitem", "orders", "customer", "supplier", "nation", "region"}


def duck_cte(*names: str) -> str:
    """``WITH`` clause defining the named views (and what they read) for DuckDB."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in BASE_TABLES or n in order:
            return
        for dep in VIEWS[n][1]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    parts = []
    for n in order:
        sql, deps = VIEWS[n]
        text = sql.format(**DUCK, **{d: d for d in deps})
        parts.append(f"{n} AS ({text})")
    return "WITH " + ",\n".join(parts) + "\n"


class Fixtures:
    """Spark DataFrames of the views above for one table root."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.tables = Tables(spark, root)
        self._cache: dict[str, DataFrame] = {}

    def view(self, name: str) -> DataFrame:
        if name in self._cache:
            return self._cache[name]
        if name in BASE_TABLES:
            df = self.tables.read(name)
        else:
            sql, deps = VIEWS[name]
            df = self.spark.sql(sql.format(**SPARK, **{d: "{" + d + "}" for d in deps}),
                                **{d: self.view(d) for d in deps})
        self._cache[name] = df
        return df

    @property
    def trips(self) -> DataFrame:
        return self.view("fx_trips")

    @property
    def zones(self) -> DataFrame:
        return self.view("fx_zones")

    @property
    def weather(self) -> DataFrame:
        return self.view("fx_weather_hourly")

    def raw_eras(self, keep_file_month: bool = False, dealt: bool = False) -> list[DataFrame]:
        """The three raw schema eras; ``_file_ts`` (month of the file a row sits in)
        is kept only for writing a bronze lake. ``dealt``: rows come clustered by the type and month of their file, dealt
        as the narrow rows of the base and not as the wide ones of the eras."""
        if dealt:
            here = Fixtures(self.spark, self.tables.root)
            base = here.view("fx_base").withColumns({"_year": F.expr(f"year({FILE_TS})"), "_month": F.expr(f"month({FILE_TS})")})
            here._cache["fx_base"] = base.hint("rebalance", "vtype", "_year", "_month").drop("_year", "_month")
            return here.raw_eras(keep_file_month)
        eras = [self.view(f"fx_raw_era{i}") for i in (1, 2, 3)]
        return eras if keep_file_month else [e.drop("_file_ts") for e in eras]

    def rings(self) -> DataFrame:
        """Rings as ``ring_id, location_id, pts array<struct<lon,lat>>`` (vertices in order)."""
        v = self.view("fx_ring_vertices")
        return (v.groupBy("ring_id", "location_id")
                 .agg(F.array_sort(F.collect_list(F.struct("idx", "lon", "lat"))).alias("v"))
                 .select(F.col("ring_id").cast("long").alias("ring_id"),
                         F.col("location_id").cast("int").alias("location_id"),
                         F.transform("v", lambda p: F.struct(p["lon"].alias("lon"),
                                                             p["lat"].alias("lat"))).alias("pts")))
