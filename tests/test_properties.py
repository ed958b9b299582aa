"""Property tests: rasterising and value rules against plain-Python models."""
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ridelake import schema as S
from ridelake.functions import columns as C
from ridelake.operators import geo

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def python_ray_cast(pts, px, py):
    inside = False
    for (xi, yi), (xj, yj) in zip(pts[:-1], pts[1:]):
        if (yi > py) != (yj > py) and px < (xj - xi) * (py - yi) / (yj - yi) + xi:
            inside = not inside
    return inside


@st.composite
def polygons(draw):
    n = draw(st.integers(min_value=3, max_value=12))
    cx = draw(st.floats(min_value=-74.1, max_value=-73.8))
    cy = draw(st.floats(min_value=40.5, max_value=40.9))
    radii = draw(st.lists(st.floats(min_value=0.001, max_value=0.012), min_size=n, max_size=n))
    pts = [(cx + r * math.cos(2 * math.pi * k / n), cy + r * math.sin(2 * math.pi * k / n))
           for k, r in enumerate(radii)]
    return pts + [pts[0]]


@SETTINGS
@given(polys=st.lists(polygons(), min_size=1, max_size=3))
def test_scanline_cells_match_python_ray_cast(spark, polys):
    rings = spark.createDataFrame([(i, 100 + i, p) for i, p in enumerate(polys)], S.RING_SCHEMA)
    got = {(r["lon_key"], r["lat_key"]): r["location_id"] for r in geo.zone_grid(rings).collect()}
    want = {}
    for i, p in enumerate(polys):
        xs, ys = [x for x, _ in p], [y for _, y in p]
        for kx in range(math.floor(min(xs) * 1000), math.ceil(max(xs) * 1000) + 1):
            for ky in range(math.floor(min(ys) * 1000), math.ceil(max(ys) * 1000) + 1):
                if (kx, ky) not in want and python_ray_cast(p, kx / 1000, ky / 1000):
                    want[(kx, ky)] = 100 + i
    assert got == want


@SETTINGS
@given(values=st.lists(st.one_of(st.none(), st.sampled_from(
    ["1", "0", "y", "N", " TRUE ", "false", "x", "", " 1"])), min_size=1, max_size=20))
def test_flag_rule_matches_model(spark, values):
    def model(v):
        if v is None:
            return None
        t = v.strip().upper()
        return "Y" if t in ("1", "Y", "TRUE") else "N" if t in ("0", "N", "FALSE") else None
    df = spark.createDataFrame([(v,) for v in values], "x string")
    assert [r[0] for r in df.select(C.normalize_flag("x")).collect()] == [model(v) for v in values]


def test_state_plane_round_trip_over_the_city(spark):
    import numpy as np
    from pyspark.sql import functions as F
    from ridelake.functions.projection import to_easting_northing, to_lon_lat
    rng = np.random.default_rng(11)
    pts = [(float(x), float(y)) for x, y in zip(rng.uniform(-74.30, -73.65, 2000), rng.uniform(40.45, 40.95, 2000))]
    df = spark.createDataFrame(pts, "lon double, lat double")
    x, y = to_easting_northing(F.col("lon"), F.col("lat"))
    lon, lat = to_lon_lat(x, y)
    worst = df.select(F.max(F.greatest(F.abs(lon - F.col("lon")), F.abs(lat - F.col("lat"))))).first()[0]
    assert worst < 1e-9
    # northings of the city, in US survey feet north of the false origin (40°10' N)
    ys = df.select(F.min(y), F.max(y)).first()
    assert 100_000 < ys[0] < ys[1] < 350_000
