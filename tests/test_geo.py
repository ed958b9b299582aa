"""Rasterising, centroids and point lookup on hand-made rings."""
import contextlib
import math

from pyspark.sql import functions as F

from ridelake import schema as S
from ridelake.operators import geo


@contextlib.contextmanager
def without_broadcast(spark):
    """Joins take the shuffle path."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {n: spark.conf.get(n, None) for n in names}
    try:
        for n in names:
            spark.conf.set(n, "-1")
        yield
    finally:
        for n, v in old.items():
            spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def rings_df(spark, rings):
    rows = [(rid, loc, [(x, y) for x, y in pts]) for rid, loc, pts in rings]
    return spark.createDataFrame(rows, S.RING_SCHEMA)


def square(x0, y0, side):
    return [(x0, y0), (x0 + side, y0), (x0 + side, y0 + side), (x0, y0 + side), (x0, y0)]


def test_square_cells_and_first_ring_wins(spark):
    rings = rings_df(spark, [
        (1, 10, square(-74.0005, 40.6005, 0.01)),                        # 10 x 10 centres
        (2, 20, [(-74.0003, 40.6007), (-73.9903, 40.6007), (-73.9953, 40.6107), (-74.0003, 40.6007)]),
        (3, 30, [(-73.0, 40.0), (-72.9, 40.1), (-73.0, 40.0)]),          # 3 points: skipped
    ])
    grid = geo.zone_grid(rings).collect()
    owners = {(r["lon_key"], r["lat_key"]): r["location_id"] for r in grid}
    assert len(owners) == 100                       # the triangle lies inside the square
    assert set(owners.values()) == {10}
    assert (-74000, 40601) in owners and (-73991, 40610) in owners


def test_cell_counts_scale_with_tiles(spark):
    big = rings_df(spark, [(1, 1, square(-74.0005, 40.6005, 0.1))])   # 100 x 100 centres, many tiles
    assert geo.zone_grid(big, tile=16).count() == 10000


def test_centroid_of_square_and_orientation(spark):
    cw = list(reversed(square(-74.0, 40.0, 0.02)))
    rings = rings_df(spark, [(1, 5, square(-74.0, 40.0, 0.02)), (2, 6, cw)])
    got = {r["location_id"]: (r["center_lon"], r["center_lat"]) for r in geo.zone_centroids(rings).collect()}
    assert got[5] == (-73.99, 40.01) and got[6] == (-73.99, 40.01)


def test_centroid_is_area_weighted_over_rings(spark):
    rings = rings_df(spark, [(1, 5, square(0.0, 0.0, 1.0)), (2, 5, square(3.0, 0.0, 2.0))])
    (r,) = geo.zone_centroids(rings).collect()
    # areas 1 and 4, centres (0.5, 0.5) and (4, 1) -> ((0.5 + 16) / 5, (0.5 + 4) / 5)
    assert abs(r["center_lon"] - 3.3) < 1e-9 and abs(r["center_lat"] - 0.9) < 1e-9


def _points(spark):
    rows = [(-73.9955, 40.6055, None, None, None, None),   # inside the square
            (-73.9955, 935.0, None, None, 7, 8),            # junk latitude: falls back to published ids
            (None, None, None, None, 3, None),             # no GPS at all
            (10.0, 10.0, -73.9990, 40.6010, None, 4)]      # outside; drop-off inside
    return spark.createDataFrame(rows, "pickup_longitude double, pickup_latitude double, "
                                       "dropoff_longitude double, dropoff_latitude double, "
                                       "pub_pickup_zone int, pub_dropoff_zone int")


def test_geocode_priority_and_row_count(spark):
    grid = geo.zone_grid(rings_df(spark, [(1, 10, square(-74.0005, 40.6005, 0.01))]))
    pts = _points(spark)
    out = geo.geocode(pts, grid)
    rows = out.collect()
    assert len(rows) == pts.count()
    got = sorted(((r["pickup_location_id"], r["dropoff_location_id"]) for r in rows), key=repr)
    assert got == sorted([(10, None), (7, 8), (3, None), (None, 10)], key=repr)
    assert "pickup_longitude" not in out.columns


def test_geocode_shuffle_path_equals_broadcast_path(spark):
    grid = geo.zone_grid(rings_df(spark, [(1, 10, square(-74.0005, 40.6005, 0.01))]))
    pts = _points(spark)
    a = sorted(map(tuple, geo.geocode(pts, grid).collect()), key=repr)
    with without_broadcast(spark):
        b = sorted(map(tuple, geo.geocode(pts, grid).collect()), key=repr)
    assert a == b


def test_grid_coverage_share(spark):
    rings = rings_df(spark, [(1, 10, square(-74.0005, 40.6005, 0.01))])
    (r,) = geo.grid_coverage(rings, geo.zone_grid(rings)).collect()
    assert r["assigned_cells"] == 100

    def half_away(x):
        return math.copysign(math.floor(abs(x) + 0.5), x)

    lo_x, hi_x = -74.0005 - 0.002, -73.9905 + 0.002
    lo_y, hi_y = 40.6005 - 0.002, 40.6105 + 0.002
    nx = half_away(hi_x * 1000) - half_away(lo_x * 1000) + 1
    ny = half_away(hi_y * 1000) - half_away(lo_y * 1000) + 1
    assert r["total_cells"] == nx * ny
    assert abs(r["share_assigned"] - round(100 / (nx * ny), 6)) < 1e-12


def test_zones_per_borough(spark):
    z = spark.createDataFrame([(1, "A", "a"), (2, "A", "b"), (3, "B", "c")], S.ZONES_SCHEMA)
    got = {r["borough"]: r["zones"] for r in geo.zones_per_borough(z).collect()}
    assert got == {"A": 2, "B": 1}
    assert geo.valid_rings(rings_df(spark, [(1, 1, [(0.0, 0.0)] * 3)])).count() == 0
    assert F is not None


def test_scanline_equals_raycast_on_irregular_rings(spark):
    import random
    rnd = random.Random(3)
    rings = []
    for rid in range(6):
        cx, cy = -74.0 + 0.03 * rid, 40.7 + 0.01 * (rid % 2)
        pts = []
        for k in range(9):      # star-shaped, non-convex polygon
            import math as m
            ang = 2 * m.pi * k / 9
            r = 0.01 + 0.006 * rnd.random()
            pts.append((cx + r * m.cos(ang), cy + r * m.sin(ang)))
        pts.append(pts[0])
        rings.append((rid, rid % 3, pts))
    rings.append((10, 7, list(reversed(square(-74.0005, 40.6905, 0.02)))))   # clockwise, overlaps
    r = rings_df(spark, rings)
    a = sorted(map(tuple, geo.zone_grid(r, method="scanline").collect()))
    b = sorted(map(tuple, geo.zone_grid(r, method="raycast").collect()))
    assert a == b and len(a) > 1000


def test_geocode_with_a_hot_cell_and_many_missing_points(spark):
    # a third of the rows in one cell, a third without GPS: both join paths agree
    grid = geo.zone_grid(rings_df(spark, [(1, 10, square(-74.0005, 40.6005, 0.01)),
                                          (2, 11, square(-73.9805, 40.6005, 0.01))]))
    rows = []
    for i in range(3000):
        if i % 3 == 0:
            rows.append((-73.9955, 40.6055, None, None, None, 5))
        elif i % 3 == 1:
            rows.append((None, None, None, None, i % 7, None))
        else:
            rows.append((-73.9805 + 0.0001 * (i % 90), 40.6010 + 0.0001 * (i % 80), -73.9955, 40.6055, None, None))
    pts = spark.createDataFrame(rows, "pickup_longitude double, pickup_latitude double, "
                                      "dropoff_longitude double, dropoff_latitude double, "
                                      "pub_pickup_zone int, pub_dropoff_zone int")
    def counts():
        found = geo.geocode(pts, grid).groupBy("pickup_location_id", "dropoff_location_id").count()
        return sorted(map(tuple, found.collect()), key=repr)

    ra = counts()
    with without_broadcast(spark):
        rb = counts()
    assert ra == rb
    assert sum(r[2] for r in ra) == 3000
    assert dict(((r[0], r[1]), r[2]) for r in ra)[(10, 5)] == 1000


def test_state_plane_rings_come_back_to_degrees(spark):
    from pyspark.sql import functions as F
    from ridelake.functions.projection import NY_LONG_ISLAND_FTUS as NY_LONG_ISLAND
    from ridelake.functions.projection import (US_SURVEY_FOOT_M, ConicConformal, rings_to_wgs84,
                                               to_easting_northing, to_lon_lat)
    from ridelake.plans.medallion import LakePaths, build_zones
    from ridelake.session import work_path
    from ridelake.sources.versions import read_table
    from ridelake.sources.fixtures import Fixtures

    # the worked example for a two-parallel conic conformal projection published
    # with the EPSG guidance (Texas South Central, Clarke 1866, US survey feet)
    texas = ConicConformal(a=6378206.4, inv_f=294.9786982, lat1=28 + 23 / 60, lat2=30 + 17 / 60,
                           lat0=27 + 50 / 60, lon0=-99.0, false_easting=2000000.0, false_northing=0.0,
                           unit=US_SURVEY_FOOT_M)
    one = spark.range(1)
    x, y = to_easting_northing(F.lit(-96.0), F.lit(28.5), texas)
    r = one.select(x.alias("x"), y.alias("y")).first()
    assert abs(r["x"] - 2963503.91) < 0.005 and abs(r["y"] - 254759.80) < 0.005
    lon, lat = to_lon_lat(F.lit(r["x"]), F.lit(r["y"]), texas)
    back = one.select(lon.alias("lon"), lat.alias("lat")).first()
    assert abs(back["lon"] + 96.0) < 1e-9 and abs(back["lat"] - 28.5) < 1e-9

    # fixture rings written in EPSG:2263 feet, as the zone polygons are published
    fx = Fixtures(spark, "/root/testdata/sf0.001")
    rings = fx.rings()

    def to_feet(p):
        px, py = to_easting_northing(p["lon"], p["lat"])
        return F.struct(px.alias("lon"), py.alias("lat"))
    feet = rings.withColumn("pts", F.transform("pts", to_feet))
    again = feet.withColumn("pts", rings_to_wgs84("pts"))
    pairs = (rings.select("ring_id", F.col("pts").alias("p1"))
             .join(again.select("ring_id", F.col("pts").alias("p2")), "ring_id"))
    worst = (pairs.select(F.explode(F.arrays_zip("p1", "p2")).alias("z"))
             .select(F.max(F.greatest(F.abs(F.col("z.p1.lon") - F.col("z.p2.lon")),
                                      F.abs(F.col("z.p1.lat") - F.col("z.p2.lat"))))).first()[0])
    assert worst < 1e-9

    paths = LakePaths(work_path(spark, "g-feet"))
    build_zones(feet, fx.zones, paths, crs=NY_LONG_ISLAND)
    got = read_table(spark, paths.grid).select("lon_key", "lat_key", "location_id")
    want = geo.zone_grid(rings, fx.zones).select("lon_key", "lat_key", "location_id")
    # cells whose centre lies on an edge may flip under a 1e-11 degree change; nothing else
    differ = got.exceptAll(want).count() + want.exceptAll(got).count()
    assert differ <= 0.01 * want.count()


def _square(x, y, side):
    return [(x, y), (x + side, y), (x + side, y + side), (x, y + side), (x, y)]


def test_centroid_is_of_the_union_of_nested_and_repeated_rings(spark):
    rings = [(1, 5, _square(0.0, 0.0, 10.0)), (2, 5, _square(6.0, 6.0, 2.0)), (3, 5, _square(0.0, 0.0, 10.0)),
             (4, 6, _square(0.0, 0.0, 2.0)), (5, 6, _square(8.0, 0.0, 2.0)), (6, 7, [(1.0, 1.0), (2.0, 2.0), (3.0, 3.0), (1.0, 1.0)]),
             (7, 8, _square(6.0, 6.0, 2.0))]
    got = {r["location_id"]: (r["center_lon"], r["center_lat"])
           for r in geo.zone_centroids(spark.createDataFrame(rings, S.RING_SCHEMA)).collect()}
    # an inner ring of the same zone adds nothing, one of another zone hides nothing; no area: no centre
    assert got == {5: (5.0, 5.0), 6: (5.0, 1.0), 7: (None, None), 8: (7.0, 7.0)}


def test_centroid_of_touching_and_overlapping_rings(spark):
    """Rectangles on whole numbers against a count of unit cells, and shapes with known centres."""
    import random
    r = random.Random(11)
    rings, want = [], {}
    for zone in range(12):
        cells = set()
        for k in range(r.randint(2, 7)):
            x, y, w, h = r.randint(0, 9), r.randint(0, 9), r.randint(1, 6), r.randint(1, 6)
            cells |= {(i, j) for i in range(x, x + w) for j in range(y, y + h)}
            pts = [(x, y), (x + w, y), (x + w, y + h), (x, y + h)]
            if r.random() < 0.5:
                pts.reverse()
            rings.append((zone * 10 + k, zone, [(float(a), float(b)) for a, b in [*pts, pts[0]]]))
        want[zone] = tuple(sum(c[i] + 0.5 for c in cells) / len(cells) for i in (0, 1))
    # shares two sides with the square around it; two triangles that cross; a triangle cut by a square's edge
    rings += [(900, 90, _square(0.0, 0.0, 10.0)), (901, 90, _square(6.0, 6.0, 4.0)),
              (902, 91, [(0.0, 0.0), (4.0, 0.0), (2.0, 3.0), (0.0, 0.0)]), (903, 91, [(0.0, 2.0), (4.0, 2.0), (2.0, -1.0), (0.0, 2.0)]),
              (904, 92, _square(0.0, 0.0, 2.0)), (905, 92, [(1.0, 0.5), (1.0, 1.5), (3.0, 1.0), (1.0, 0.5)])]
    want |= {90: (5.0, 5.0), 91: (2.0, 1.0)}
    # the square, and of the triangle the part beyond its side: height 1, base 0.5 at x = 2
    want[92] = ((4 * 1 + 0.25 * (2 + 1 / 3)) / 4.25, 1.0)
    got = {x["location_id"]: (x["center_lon"], x["center_lat"]) for x in geo.zone_centroids(spark.createDataFrame(rings, S.RING_SCHEMA)).collect()}
    assert got.keys() == want.keys()
    for z, c in want.items():
        assert abs(got[z][0] - c[0]) < 1e-8 and abs(got[z][1] - c[1]) < 1e-8, (z, got[z], c)


def test_sweep_of_many_small_zones_stays_off_the_driver(spark):
    """Rings made from a short table of keys look small to Spark: nothing that is made from them is broadcast, and a zone
    of a few edges is one band, not one for each 256th of its height."""
    from pyspark.sql import functions as F
    k = F.col("id").cast("double")

    def square(n, x, y, side):
        p = [F.struct((x + dx * side).alias("lon"), (y + dy * side).alias("lat")) for dx, dy in ((0, 0), (1, 0), (1, 1), (0, 1), (0, 0))]
        return F.struct((F.col("id") * 2 + n).alias("ring_id"), F.array(*p).alias("pts"))

    rings = spark.range(300).select(F.col("id").cast("int").alias("location_id"),
                                    F.inline(F.array(square(0, k, k, 1.0), square(1, k + 0.5, k, 1.0))))
    df = geo.zone_centroids(rings)
    assert "BroadcastHashJoin" not in df._jdf.queryExecution().sparkPlan().toString()
    assert {(r[0], r[1], r[2]) for r in df.collect()} == {(i, i + 0.75, i + 0.5) for i in range(300)}
    zone = rings.select(F.lit(0.0).alias("floor"), F.lit(8.0).alias("height"), F.lit(1).alias("bands"), F.lit(0.0).alias("lo"), F.lit(8.0).alias("hi"))
    assert geo._banded(zone, "lo", "hi").count() == zone.count()


def test_cells_are_made_by_as_many_tasks_as_shuffles_have_partitions(spark):
    # the crossings of a large grid fit one coalesced partition, its cells don't
    rings = rings_df(spark, [(i, i, square(-74.0005 + 0.01 * i, 40.6005, 0.01)) for i in range(8)])
    cells = geo.scanline_cells(rings)
    assert cells.count() == 800 and cells.select(F.spark_partition_id().alias("p")).distinct().count() > 3
