"""Zone lookup: rings -> grid cells (rasterise), zone centroids, point -> zone.

Rasterising is an explode, never a nested loop or a join of cells with
edges: each edge emits its crossings with the grid rows that it spans, and the
cells between pairs of a row's crossings are emitted (even-odd rule).
The per-cell ray cast (``point_in_ring``, a higher-order ``aggregate`` over
the edges) is kept as the reference form and gives the same cells.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import schema as S
from ..functions import columns as C

TILE = 32  # cells per tile side: a tile is at most 1,024 candidate cells


def valid_rings(rings: DataFrame) -> DataFrame:
    """Rings with fewer than 4 points (3 distinct + closing point) are skipped."""
    return rings.where(F.size("pts") >= 4)


def _bbox(rings: DataFrame) -> DataFrame:
    return rings.withColumns({
        "min_lon": F.array_min(F.transform("pts", lambda p: p["lon"])),
        "max_lon": F.array_max(F.transform("pts", lambda p: p["lon"])),
        "min_lat": F.array_min(F.transform("pts", lambda p: p["lat"])),
        "max_lat": F.array_max(F.transform("pts", lambda p: p["lat"])),
    })


def point_in_ring(pts: Column, px: Column, py: Column) -> Column:
    """Even-odd ray cast of (px, py) against a closed ring (last point = first)."""
    def step(acc, i):
        a, b = F.element_at(pts, i + 1), F.element_at(pts, i + 2)
        xi, yi, xj, yj = a["lon"], a["lat"], b["lon"], b["lat"]
        crosses = F.when((yi > py) != (yj > py),
                         px < (xj - xi) * (py - yi) / (yj - yi) + xi).otherwise(F.lit(False))
        return acc + F.when(crosses, F.lit(1)).otherwise(F.lit(0))

    n_edges = F.size(pts) - 1
    crossings = F.aggregate(F.sequence(F.lit(0), n_edges - 1), F.lit(0), step)
    return (crossings % 2) == 1


def candidate_cells(rings: DataFrame, step: int = S.GRID_STEP, tile: int = TILE,
                    partitions: int | None = None) -> DataFrame:
    """(ring_id, location_id, lon_key, lat_key) for every grid point of each ring's box."""
    b = _bbox(valid_rings(rings)).withColumns({
        "lon_lo": F.floor(F.col("min_lon") * step), "lon_hi": F.ceil(F.col("max_lon") * step),
        "lat_lo": F.floor(F.col("min_lat") * step), "lat_hi": F.ceil(F.col("max_lat") * step),
    })
    tiles = (b.withColumn("tx", F.explode(F.sequence(F.lit(0), F.floor((F.col("lon_hi") - F.col("lon_lo")) / tile))))
              .withColumn("ty", F.explode(F.sequence(F.lit(0), F.floor((F.col("lat_hi") - F.col("lat_lo")) / tile)))))
    # spread tiles of big rings over tasks before the per-cell fan-out
    tiles = tiles.repartition(partitions, "ring_id", "tx", "ty") if partitions else \
        tiles.repartition("ring_id", "tx", "ty")
    x0 = F.col("lon_lo") + F.col("tx") * tile
    y0 = F.col("lat_lo") + F.col("ty") * tile
    cells = (tiles
             .withColumn("lon_key", F.explode(F.sequence(x0, F.least(x0 + (tile - 1), F.col("lon_hi")))))
             .withColumn("lat_key", F.explode(F.sequence(y0, F.least(y0 + (tile - 1), F.col("lat_hi"))))))
    return cells.select("ring_id", "location_id", "pts",
                        F.col("lon_key").cast("int").alias("lon_key"),
                        F.col("lat_key").cast("int").alias("lat_key"))


def scanline_cells(rings: DataFrame, step: int = S.GRID_STEP) -> DataFrame:
    """(ring_id, location_id, lon_key, lat_key) of every cell centre inside each ring.

    Each edge is a row and emits its crossings with the grid rows that it spans, so what is
    shuffled is one narrow row per crossing, never a ring's vertices. Per ring and
    grid row the crossings are sorted and the cells between consecutive pairs are
    emitted. A centre ``px`` is inside when ``x[2j] <= px < x[2j+1]``: exactly the
    even-odd ray cast of ``point_in_ring`` (same crossing arithmetic).
    """
    def edge(i):
        a, b = F.element_at("pts", i + 1), F.element_at("pts", i + 2)
        return F.struct(a["lon"].alias("xi"), a["lat"].alias("yi"), b["lon"].alias("xj"), b["lat"].alias("yj"))

    edges = valid_rings(rings).select("ring_id", "location_id", F.inline(F.transform(F.sequence(F.lit(0), F.size("pts") - 2), edge)))
    low, high = F.least("yi", "yj"), F.greatest("yi", "yj")
    crossed = edges.withColumn("lat_key", F.explode(F.sequence(F.floor(low * step), F.ceil(high * step))))
    py = F.col("lat_key").cast("double") / step
    crossed = crossed.where((F.col("yi") > py) != (F.col("yj") > py)).select(
        "ring_id", "location_id", "lat_key",
        ((F.col("xj") - F.col("xi")) * (py - F.col("yi")) / (F.col("yj") - F.col("yi")) + F.col("xi")).alias("x"))
    # a crossing is a few bytes and its row's cells are many: a number of partitions that is named is not made smaller
    keys, tasks = ["ring_id", "location_id", "lat_key"], int(rings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    with_xs = crossed.repartition(tasks, *keys).groupBy(*keys).agg(F.sort_array(F.collect_list("x")).alias("xs"))
    pairs = F.transform(F.sequence(F.lit(0), (F.size("xs") / 2).cast("int") - 1),
                        lambda j: F.struct(F.element_at("xs", j * 2 + 1).alias("x_in"), F.element_at("xs", j * 2 + 2).alias("x_out")))
    spans = with_xs.select("ring_id", "location_id", "lat_key", F.inline(pairs))
    cells = spans.select("ring_id", "location_id", "lat_key", "x_in", "x_out",
                         F.explode(F.sequence(F.floor(F.col("x_in") * step), F.ceil(F.col("x_out") * step))).alias("lon_key"))
    px = F.col("lon_key").cast("double") / step
    return (cells.where((px >= F.col("x_in")) & (px < F.col("x_out")))
                 .select("ring_id", "location_id", F.col("lon_key").cast("int").alias("lon_key"),
                         F.col("lat_key").cast("int").alias("lat_key")))


def zone_grid(rings: DataFrame, zones: DataFrame | None = None, step: int = S.GRID_STEP,
              tile: int = TILE, method: str = "scanline") -> DataFrame:
    """Grid lookup table ``lon_key, lat_key, location_id[, borough]``.

    A cell belongs to the ring with the lowest ``ring_id`` whose interior
    contains the cell centre ``(lon_key/step, lat_key/step)``; each ring is its
    own filled polygon (holes count as inside). ``method="scanline"`` (default)
    emits inside cells row by row; ``method="raycast"`` tests every candidate
    cell of the ring's box against all edges (same result, more work).
    """
    if method == "scanline":
        inside = scanline_cells(rings, step)
    else:
        cells = candidate_cells(rings, step, tile)
        px = F.col("lon_key").cast("double") / step
        py = F.col("lat_key").cast("double") / step
        inside = cells.where(point_in_ring(F.col("pts"), px, py))
    grid = (inside.groupBy("lon_key", "lat_key")
                  .agg(F.min_by("location_id", "ring_id").alias("location_id")))
    if zones is not None:
        z = zones.select("location_id", "borough")
        grid = grid.join(z, "location_id", "left")
        grid = grid.select("lon_key", "lat_key", "location_id", "borough")
    return grid


def ring_moments(rings: DataFrame) -> DataFrame:
    """Shoelace sums per ring, oriented counter-clockwise.

    Coordinates are taken relative to the ring's first vertex so that the
    cross products stay small (no cancellation between ~-74 x 40 terms).
    Returns ``wa`` (twice the area) and ``wx``/``wy`` such that a zone's
    centroid is ``sum(wx) / (3 * sum(wa))`` over its rings."""
    x0, y0 = F.element_at("pts", 1)["lon"], F.element_at("pts", 1)["lat"]

    def sums(acc, i):
        a, b = F.element_at("pts", i + 1), F.element_at("pts", i + 2)
        xi, yi, xj, yj = a["lon"] - x0, a["lat"] - y0, b["lon"] - x0, b["lat"] - y0
        cross = xi * yj - xj * yi
        return F.struct((acc["a2"] + cross).alias("a2"),
                        (acc["cx"] + (xi + xj) * cross).alias("cx"),
                        (acc["cy"] + (yi + yj) * cross).alias("cy"))

    zero = F.struct(F.lit(0.0).alias("a2"), F.lit(0.0).alias("cx"), F.lit(0.0).alias("cy"))
    m = valid_rings(rings).withColumns({
        "m": F.aggregate(F.sequence(F.lit(0), F.size("pts") - 2), zero, sums),
        "x0": x0, "y0": y0})
    a2, sign = F.col("m.a2"), F.signum(F.col("m.a2"))
    return m.select("ring_id", "location_id",
                    (a2 * sign).alias("wa"),
                    ((a2 * 3 * F.col("x0") + F.col("m.cx")) * sign).alias("wx"),
                    ((a2 * 3 * F.col("y0") + F.col("m.cy")) * sign).alias("wy"))


SWEEP_BANDS = 256    # at most so many bands of a zone's height in which edges are compared
BAND_EDGES = 64      # edges of a zone for each band: a zone of a few edges is one band


def _banded(df: DataFrame, low: str, high: str) -> DataFrame:
    """A row for each band of its zone's height (columns ``floor, height, bands``) that it reaches into."""
    def band(c: str) -> Column:
        return F.least(F.floor((F.col(c) - F.col("floor")) / F.col("height") * F.col("bands")), F.col("bands") - 1)
    return df.withColumn("band", F.explode(F.sequence(band(low), band(high))))


def swept_moments(rings: DataFrame) -> DataFrame:
    """``location_id, wa, wx, wy`` (as ``ring_moments``) of the union of each zone's rings, whatever way they
    touch, overlap or repeat one another; each ring is filled by the even-odd rule.

    The heights of all vertices and of all crossings of edges cut a zone into slabs, in which edges don't cross. Per
    slab, the edges in order of x are entries and exits of their rings; where the number of rings
    around goes from none to one or back, an edge bounds the union, and its integrals over the slab
    count. Edges meet only in the band of the zone's height that both reach into, and the more edges a zone has, the
    more bands. Edges and slabs are made from a small table of rings, by whose size Spark would take them for small
    and send them all to the driver to broadcast: the joins are told to shuffle."""
    def edge(i):
        a, b = F.element_at("pts", i + 1), F.element_at("pts", i + 2)
        up = a["lat"] < b["lat"]
        return F.struct(F.when(up, a["lon"]).otherwise(b["lon"]).alias("x1"), F.least(a["lat"], b["lat"]).alias("y1"),
                        F.when(up, b["lon"]).otherwise(a["lon"]).alias("x2"), F.greatest(a["lat"], b["lat"]).alias("y2"))

    base = _bbox(valid_rings(rings)).groupBy("location_id").agg(
        F.min("min_lon").alias("x0"), F.min("min_lat").alias("floor"), (F.max("max_lat") - F.min("min_lat")).alias("height"),
        F.least(F.ceil(F.sum(F.size("pts")) / BAND_EDGES), F.lit(SWEEP_BANDS)).alias("bands"))
    edges = valid_rings(rings).select("ring_id", "location_id", F.inline(F.transform(F.sequence(F.lit(0), F.size("pts") - 2), edge)))
    edges = edges.where("y1 < y2").join(base.hint("merge"), "location_id")         # a level edge bounds no slab
    edges = edges.withColumns({"x1": F.col("x1") - F.col("x0"), "x2": F.col("x2") - F.col("x0"), "y1": F.col("y1") - F.col("floor"),
                               "y2": F.col("y2") - F.col("floor"), "y0": F.col("floor"), "floor": F.lit(0.0),
                               "id": F.struct("ring_id", "x1", "y1", "x2", "y2")})
    there = _banded(edges, "y1", "y2")
    other = there.select("location_id", "band", *[F.col(c).alias(f"o_{c}") for c in ("id", "x1", "y1", "x2", "y2")])
    met = there.join(other.hint("merge"), ["location_id", "band"]).where(
        (F.col("id") < F.col("o_id")) & (F.col("y1") < F.col("o_y2")) & (F.col("o_y1") < F.col("y2"))
        & (F.least("x1", "x2") <= F.greatest("o_x1", "o_x2")) & (F.least("o_x1", "o_x2") <= F.greatest("x1", "x2")))
    slope, o_slope = (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1")), (F.col("o_x2") - F.col("o_x1")) / (F.col("o_y2") - F.col("o_y1"))
    at = F.try_divide(F.col("o_x1") - o_slope * F.col("o_y1") - F.col("x1") + slope * F.col("y1"), slope - o_slope)
    zone = ["location_id", "floor", "height", "bands"]
    crossed = met.withColumn("y", at).where((F.col("y") > F.greatest("y1", "o_y1")) & (F.col("y") < F.least("y2", "o_y2"))).select(*zone, "y")
    heights = edges.select(*zone, F.col("y1").alias("y")).unionByName(edges.select(*zone, F.col("y2").alias("y"))).unionByName(crossed).distinct()
    slabs = heights.withColumn("top", F.lead("y").over(Window.partitionBy("location_id").orderBy("y"))).where("top is not null")
    slabs = _banded(slabs, "y", "y").select("location_id", "band", F.col("y").alias("lo"), F.col("top").alias("hi"))
    cut = there.join(slabs.hint("merge"), ["location_id", "band"]).where((F.col("y1") <= F.col("lo")) & (F.col("y2") >= F.col("hi")))
    cut = cut.select("location_id", "ring_id", "x0", "y0", "lo", "hi", (F.col("x1") + slope * (F.col("lo") - F.col("y1"))).alias("xl"),
                     (F.col("x1") + slope * (F.col("hi") - F.col("y1"))).alias("xh")).withColumn("mid", F.col("xl") + F.col("xh"))
    slab = ["location_id", "lo"]
    nth = F.row_number().over(Window.partitionBy(*slab, "ring_id").orderBy("mid"))
    cut = cut.withColumn("turn", F.when(nth % 2 == 1, 1).otherwise(-1))
    along = Window.partitionBy(*slab).orderBy("mid", F.col("turn").desc(), "ring_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = cut.withColumn("around", F.sum("turn").over(along))
    side = F.when((F.col("turn") == 1) & (F.col("around") == 1), -1.0).when((F.col("turn") == -1) & (F.col("around") == 0), 1.0).otherwise(0.0)
    h, xl, xh, lo, hi = F.col("hi") - F.col("lo"), F.col("xl"), F.col("xh"), F.col("lo"), F.col("hi")
    sums = cut.groupBy("location_id", "x0", "y0").agg(
        F.sum(side * h * (xl + xh) / 2).alias("a"), F.sum(side * h * (xl * xl + xl * xh + xh * xh) / 6).alias("mx"),
        F.sum(side * h * (xl * (lo * 2 + hi) + xh * (lo + hi * 2)) / 6).alias("my"))
    a = F.col("a")
    return sums.select("location_id", (a * 2).alias("wa"), ((F.col("mx") + a * F.col("x0")) * 6).alias("wx"), ((F.col("my") + a * F.col("y0")) * 6).alias("wy"))


def union_moments(rings: DataFrame) -> DataFrame:
    """``location_id, wa, wx, wy`` of each zone's union, in parts to be added: rings whose box meets no other
    ring's box of their zone by their own sums, the others by a sweep."""
    b = _bbox(valid_rings(rings))
    box = ("min_lon", "max_lon", "min_lat", "max_lat")
    other = b.select("location_id", F.col("ring_id").alias("o_id"), *[F.col(c).alias(f"o_{c}") for c in box])
    meets = ((F.col("min_lon") <= F.col("o_max_lon")) & (F.col("o_min_lon") <= F.col("max_lon"))
             & (F.col("min_lat") <= F.col("o_max_lat")) & (F.col("o_min_lat") <= F.col("max_lat")))
    mixed = (b.join(other.hint("merge"), "location_id").where((F.col("ring_id") != F.col("o_id")) & meets)
              .select(F.col("ring_id").alias("mixed_id")).distinct())
    mixed = mixed.hint("merge")       # as many rows as rings, but taken for few
    own = rings.join(mixed, F.col("ring_id") == F.col("mixed_id"), "left_anti")
    together = rings.join(mixed, F.col("ring_id") == F.col("mixed_id"), "left_semi")
    return ring_moments(own).drop("ring_id").unionByName(swept_moments(together))


def zone_centroids(rings: DataFrame, zones: DataFrame | None = None, digits: int = 9) -> DataFrame:
    """Centroid of the union of each zone's rings (nested, touching and overlapping rings count once).
    A zone whose rings have no area keeps its row, with NULL centre."""
    m = union_moments(rings)
    area = F.nullif(F.col("wa"), F.lit(0.0)) * 3
    c = (m.groupBy("location_id")
          .agg(F.sum("wa").alias("wa"), F.sum("wx").alias("wx"), F.sum("wy").alias("wy"))
          .select("location_id",
                  F.round(F.col("wx") / area, digits).alias("center_lon"),
                  F.round(F.col("wy") / area, digits).alias("center_lat")))
    if zones is not None:
        c = zones.select("location_id", "borough", "zone_name").join(c, "location_id", "inner")
    return c


def span_width(step: int) -> int:
    """Cells of a span table's block: about 0.064 degrees, whatever the step."""
    return max(1, 64 * step // 1000)


def grid_spans(grid: DataFrame, step: int = S.GRID_STEP) -> DataFrame:
    """The grid as spans: a row per (grid row, block of ``span_width`` columns) with the runs of neighbouring cells of one
    zone in it, ``spans`` (from, to, location_id) in order. The same cells in a table that is
    smaller by the length of the runs, so that finer grids still fit a broadcast. A cell that
    the grid names several times is in as many spans."""
    width = span_width(step)
    cells = grid.select("lat_key", F.floor(F.col("lon_key") / width).cast("int").alias("block"), "lon_key", "location_id")
    along = Window.partitionBy("lat_key", "block", "location_id").orderBy("lon_key")
    cells = cells.withColumn("copies", F.count(F.lit(1)).over(along.rangeBetween(0, 0)))
    begins = (F.col("lon_key") - F.lag("lon_key").over(along) > 1) | (F.col("copies") != F.lag("copies").over(along))
    cells = cells.withColumn("begins", F.when(begins, 1).otherwise(0))
    cells = cells.withColumn("run", F.sum("begins").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    runs = cells.groupBy("lat_key", "block", "location_id", "run").agg(
        F.min("lon_key").alias("from"), F.max("lon_key").alias("to"), F.max("copies").alias("copies"))
    span = F.array_repeat(F.struct("from", "to", "location_id"), F.col("copies").cast("int"))
    return runs.groupBy("lat_key", "block").agg(F.array_sort(F.flatten(F.collect_list(span))).alias("spans"))


POINT_COLS = ("pub_pickup_zone", "pub_dropoff_zone", "pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude")


def geocode(df: DataFrame, grid: DataFrame, step: int = S.GRID_STEP) -> DataFrame:
    """GPS point -> grid cell -> zone, else the published id, else NULL.

    ``grid`` is a table of cells (``zone_grid``) or of spans (``grid_spans``, of the same ``step``).
    Spark picks the join form from the grid's size (broadcast below its threshold,
    else a shuffle that AQE may split). Points outside the grid's bounding box, missing
    points and junk such as (0, 0) among them, get a salted key (|key| > 1e8) that no
    cell has, so on the shuffle path they don't pile up in one partition.
    """
    by_span = "spans" in grid.columns
    width = span_width(step)
    if by_span:
        g = grid.select(F.col("block").alias("lon_key"), "lat_key", "spans")
    else:
        g = grid.select("lon_key", "lat_key", "location_id")
    box = g.agg(F.struct(F.min("lon_key").alias("w"), F.max("lon_key").alias("e"),
                         F.min("lat_key").alias("s"), F.max("lat_key").alias("n"))).scalar()
    keyed = df.withColumns({
        "pu_lon_k": C.grid_key("pickup_longitude", step), "pu_lat_k": C.grid_key("pickup_latitude", step),
        "do_lon_k": C.grid_key("dropoff_longitude", step), "do_lat_k": C.grid_key("dropoff_latitude", step),
    })
    # the salt only spreads points that match nothing: any columns that differ from row to row will do
    unlike = [c for c in ("pickup_datetime", "dropoff_datetime") if c in df.columns] or df.columns
    salt = (F.lit(200_000_000) + F.pmod(F.xxhash64(*unlike), F.lit(1_000_000))).cast("int")
    for role in ("pu", "do"):
        lon, lat = F.col(f"{role}_lon_k"), F.col(f"{role}_lat_k")
        key = F.floor(lon / width).cast("int") if by_span else lon
        inside = key.between(box["w"], box["e"]) & lat.between(box["s"], box["n"])
        keyed = keyed.withColumns({f"{role}_cell": lon, f"{role}_lon_k": F.when(inside, key).otherwise(salt)})
    # one grid, two roles (pickup and drop-off), as two aliases of the same plan:
    # a broadcast is built once and reused by the second lookup (ReusedExchange)
    gp, gd = g.alias("gp"), g.alias("gd")
    on_pu = (F.col("pu_lon_k") == F.col("gp.lon_key")) & (F.col("pu_lat_k") == F.col("gp.lat_key"))
    on_do = (F.col("do_lon_k") == F.col("gd.lon_key")) & (F.col("do_lat_k") == F.col("gd.lat_key"))

    def zones(side: str, role: str) -> Column:
        cell = F.col(f"t.{role}_cell")
        return F.transform(F.filter(f"{side}.spans", lambda x: cell.between(x["from"], x["to"])), lambda x: x["location_id"])

    keep = [c for c in df.columns if c not in POINT_COLS]
    found = keyed.alias("t").join(gp, on_pu, "left").join(gd, on_do, "left")
    kept = [F.col(f"t.{c}") for c in (*keep, "pub_pickup_zone", "pub_dropoff_zone")]
    if by_span:      # as the join with cells: a row for each time that the grid names the point's cell, else one
        found = found.select(*kept, F.explode_outer(zones("gp", "pu")).alias("pu_zone"), zones("gd", "do").alias("do_zones"))
        found = found.withColumn("do_zone", F.explode_outer("do_zones"))
    else:
        found = found.select(*kept, F.col("gp.location_id").alias("pu_zone"), F.col("gd.location_id").alias("do_zone"))
    return found.select(*keep, F.coalesce("pu_zone", "pub_pickup_zone").alias("pickup_location_id"),
                        F.coalesce("do_zone", "pub_dropoff_zone").alias("dropoff_location_id"))


def published_zones(df: DataFrame, grid: DataFrame) -> DataFrame:
    """``geocode`` of rows without any point, without the lookups: the published ids, in the type that ``geocode`` gives."""
    zone = F.element_at("spans", 1)["location_id"] if "spans" in grid.columns else F.col("location_id")
    kind = grid.select(zone.alias("z")).schema["z"].dataType
    ids = [F.coalesce(F.lit(None).cast(kind), F.col(f"pub_{role}_zone")).alias(f"{role}_location_id") for role in ("pickup", "dropoff")]
    return df.select(*[c for c in df.columns if c not in POINT_COLS], *ids)


def grid_coverage(rings: DataFrame, grid: DataFrame, step: int = S.GRID_STEP,
                  margin: float = S.GRID_MARGIN_DEG) -> DataFrame:
    """Bounding box of all valid rings +- margin, its cell count and the share assigned.

    Ring boxes and grid cells are stacked into one frame so a single global
    aggregate (partial per task, one tiny final merge) yields everything.
    """
    boxes = _bbox(valid_rings(rings)).select(
        "min_lon", "min_lat", "max_lon", "max_lat", F.lit(0).alias("cell"))
    cells = grid.select(*[F.lit(None).cast("double").alias(c)
                          for c in ("min_lon", "min_lat", "max_lon", "max_lat")],
                        F.lit(1).alias("cell"))
    b = boxes.unionByName(cells).agg(
        (F.min("min_lon") - margin).alias("lon_min"), (F.min("min_lat") - margin).alias("lat_min"),
        (F.max("max_lon") + margin).alias("lon_max"), (F.max("max_lat") + margin).alias("lat_max"),
        F.sum("cell").cast("long").alias("assigned_cells"))
    nx = F.round(F.col("lon_max") * step) - F.round(F.col("lon_min") * step) + 1
    ny = F.round(F.col("lat_max") * step) - F.round(F.col("lat_min") * step) + 1
    return b.select(F.round("lon_min", 6).alias("lon_min"), F.round("lat_min", 6).alias("lat_min"),
                    F.round("lon_max", 6).alias("lon_max"), F.round("lat_max", 6).alias("lat_max"),
                    (nx * ny).cast("long").alias("total_cells"),
                    F.col("assigned_cells"),
                    F.round(F.col("assigned_cells") / (nx * ny), 6).alias("share_assigned"))


def zones_per_borough(zones: DataFrame) -> DataFrame:
    return zones.groupBy("borough").agg(F.count(F.lit(1)).alias("zones"))
