"""Gold analyses over silver trips, zones and hourly weather.

Each function is ``DataFrame(s) -> DataFrame``. Facts are only ever grouped
(partial + final hash aggregation, so a hot key is combined map-side) or
joined to dimensions after that; windows run on small aggregated
frames only (a few hundred rows at most, bounded by the calendar or by the
number of zones), never on facts.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import columns as C

FEE_AVG_COLS = {
    "extra": "surcharge_soir_nuit",
    "mta_tax": "mta_tax",
    "improvement_surcharge": "amelioration",
    "congestion_surcharge": "congestion",
    "airport_fee": "aeroport",
    "cbd_convenience_fee": "cbd",
}


def _count() -> F.Column:
    return F.count(F.lit(1))


# --------------------------------------------------------------- volumes
def volumes_by_type_year(trips: DataFrame) -> DataFrame:
    """Trips, distinct months and pickup-zone fill rate by (vtype, year)."""
    return (trips.groupBy("vtype", "year")
                 .agg(_count().alias("courses"),
                      F.count_distinct("month").alias("mois"),
                      F.round(F.count("pickup_location_id") / _count() * 100, 1).alias("pct_zone_resolue"))
                 .orderBy("vtype", "year"))


def volumes_from_profile(prof: DataFrame) -> DataFrame:
    """``volumes_by_type_year`` from the hourly profile (same counts: the profile
    keeps, per type and hour, all trips and those with a pickup zone)."""
    return (prof.groupBy("vtype", F.year("ts").alias("year"))
                .agg(F.sum("n_all").alias("courses"),
                     F.count_distinct(F.month("ts")).alias("mois"),
                     F.round(F.sum("n_zone") / F.sum("n_all") * 100, 1).alias("pct_zone_resolue"))
                .orderBy("vtype", "year"))


def volumes_by_type_month(trips: DataFrame) -> DataFrame:
    return (trips.groupBy("vtype", "year", "month")
                 .agg(_count().alias("courses"),
                      F.round(F.count("pickup_location_id") / _count() * 100, 1).alias("pct_zone_resolue"))
                 .orderBy("vtype", "year", "month"))


def distinct_years(trips: DataFrame) -> DataFrame:
    """Sorted distinct years, each row carrying the number of distinct years."""
    years = trips.agg(F.collect_set("year").alias("years"))     # one row, bounded by the calendar
    return (years.select(F.explode("years").alias("year"), F.size("years").cast("long").alias("n_years"))
                 .orderBy("year"))


# --------------------------------------------------------------- fees
def fees_by_year(trips: DataFrame) -> DataFrame:
    """Average fee by (vtype, year), rounded to 3; NULL means 'did not exist'."""
    cols = ["extra", "mta_tax", "improvement_surcharge", "congestion_surcharge"]
    return (trips.groupBy("vtype", "year")
                 .agg(*[F.round(F.avg(c), 3).alias(FEE_AVG_COLS[c]) for c in cols])
                 .orderBy("vtype", "year"))


def fees_by_month(trips: DataFrame, digits: int = 6) -> DataFrame:
    """Average and total collected of each fee by (yyyy-MM, vtype)."""
    aggs = []
    for c, name in FEE_AVG_COLS.items():
        aggs.append(F.round(F.avg(c), digits).alias(name))
        aggs.append(F.round(F.sum(c), digits - 2).alias(f"{name}_total"))
    # group on integer fields; the 'yyyy-MM' text is built per group, not per trip
    t = F.col("pickup_datetime")
    return (trips.groupBy(F.year(t).alias("y"), F.month(t).alias("m"), "vtype")
                 .agg(*aggs)
                 .select(F.format_string("%04d-%02d", "y", "m").alias("mois"), "vtype",
                         *[c for n in FEE_AVG_COLS.values() for c in (n, f"{n}_total")])
                 .orderBy("mois", "vtype"))


def fee_sums(trips: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Sum and number of amounts of each fee by (year, month, vtype), and by ``by``: parts that can be added up."""
    t = F.col("pickup_datetime")
    return trips.groupBy(F.year(t).alias("y"), F.month(t).alias("m"), "vtype", *by).agg(
        *[f(c).alias(f"{n}_{c}") for c in FEE_AVG_COLS for n, f in (("sum", F.sum), ("n", F.count))])


def fees_from_sums(sums: DataFrame, digits: int = 6) -> DataFrame:
    """``fees_by_month`` from the fees' sums."""
    out = []
    for c, name in FEE_AVG_COLS.items():
        out.append(F.round(F.try_divide(F.sum(f"sum_{c}"), F.sum(f"n_{c}")), digits).alias(name))
        out.append(F.round(F.sum(f"sum_{c}"), digits - 2).alias(f"{name}_total"))
    return (sums.groupBy("y", "m", "vtype").agg(*out)
                .select(F.format_string("%04d-%02d", "y", "m").alias("mois"), "vtype",
                        *[c for n in FEE_AVG_COLS.values() for c in (n, f"{n}_total")])
                .orderBy("mois", "vtype"))


def fees_by_month_head(trips: DataFrame, vtype: str = "yellow", n: int = 14) -> DataFrame:
    """First ``n`` months of one type's fee history (a head of a sorted report)."""
    return (fees_by_month(trips.where(F.col("vtype") == vtype))
            .orderBy("mois").limit(n))


def fee_series(trips: DataFrame) -> DataFrame:
    """Monthly fee averages as a long series; all-NULL points dropped; a type with
    no amount at all gets one row with ``has_amounts = false``. The monthly
    aggregate (types x months x 6 fees) is read once."""
    return fee_series_from_monthly(fees_by_month(trips))


def fee_series_from_monthly(monthly: DataFrame) -> DataFrame:
    """``fee_series`` from an already computed ``fees_by_month`` table."""
    monthly = monthly.select("mois", "vtype", *FEE_AVG_COLS.values())
    long = monthly.unpivot(["mois", "vtype"], list(FEE_AVG_COLS.values()), "fee", "value")
    per_type = Window.partitionBy("vtype")
    flagged = long.withColumns({
        "has_amounts": F.max(F.col("value").isNotNull()).over(per_type),
        "k": F.row_number().over(per_type.orderBy("mois", "fee"))})
    keep = F.col("value").isNotNull() | (~F.col("has_amounts") & (F.col("k") == 1))
    return flagged.where(keep).select(
        F.when(F.col("has_amounts"), F.col("mois")).alias("mois"), "vtype",
        F.when(F.col("has_amounts"), F.col("fee")).alias("fee"), "value", "has_amounts")


def fee_applicability(trips: DataFrame) -> DataFrame:
    """Applicability flags recomputed from the pickup day, counted by month."""
    from ..operators.clean import with_fee_applicability
    flags = [f"{f}_applicable" for f in S.FEES]
    return (with_fee_applicability(trips.select("pickup_datetime", "year", "month"))
            .groupBy("year", "month", *flags).agg(_count().alias("courses")))


def fee_status(trips: DataFrame) -> DataFrame:
    """Three-state status of each fee ('not_yet' / 'not_charged' / 'charged') by type.

    One aggregation with a conditional count per (fee, status) instead of one
    row per trip and fee: trips are neither multiplied nor shuffled, only the
    per-type counters are; empty (fee, status) pairs are dropped afterwards."""
    states = ("not_yet", "not_charged", "charged")
    counts = [F.count(F.when(C.fee_status(f, f"{f}_applicable") == s, F.lit(1))).alias(f"{f}:{s}")
              for f in S.FEES for s in states]
    wide = trips.groupBy("vtype").agg(*counts)
    items = F.array(*[F.struct(F.lit(f).alias("fee"), F.lit(s).alias("status"),
                               F.col(f"`{f}:{s}`").alias("courses")) for f in S.FEES for s in states])
    return wide.select("vtype", F.inline(items)).where(F.col("courses") > 0)


# --------------------------------------------------------------- zones / flows
def zone_pairs(trips: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Trips and in-scope trips per (pickup id, drop-off id), NULL ids included.
    Bounded by the square of the number of zones, whatever the trip volume; the
    flows, the top zones and the top in-scope zone all derive from it."""
    return (trips.groupBy("pickup_location_id", "dropoff_location_id", *by)
                 .agg(_count().alias("n_all"),
                      F.count(F.when(C.in_scope(), F.lit(1))).alias("n_scope")))


def _top_named(counts: DataFrame, zones: DataFrame, k: int) -> DataFrame:
    """Top-k of per-pickup-zone counts ``courses`` by (borough, zone name)."""
    z = zones.select("location_id", "borough", "zone_name")
    named = counts.join(z, counts.pickup_location_id == z.location_id, "inner")
    per_name = named.groupBy("borough", "zone_name").agg(F.sum("courses").alias("courses"))
    return per_name.orderBy(F.desc("courses"), "borough", "zone_name").limit(k)


def top_zones(trips: DataFrame, zones: DataFrame, k: int = 10) -> DataFrame:
    """Top-k pickup zones over all trips (ties broken by borough, zone name)."""
    counts = (trips.where(F.col("pickup_location_id").isNotNull())
                   .groupBy("pickup_location_id").agg(_count().alias("courses")))
    return _top_named(counts, zones, k)


def top_zones_from_pairs(pairs: DataFrame, zones: DataFrame, k: int = 10) -> DataFrame:
    """``top_zones`` from the zone-pair counts."""
    counts = (pairs.where(F.col("pickup_location_id").isNotNull())
                   .groupBy("pickup_location_id").agg(F.sum("n_all").alias("courses")))
    return _top_named(counts, zones, k)


def _named_in_scope(counts: DataFrame, zones: DataFrame) -> DataFrame:
    z = zones.select("location_id", "zone_name")
    return (counts.join(z, counts.pickup_location_id == z.location_id, "inner")
                  .select("location_id", "zone_name", "courses"))


def zone_counts_in_scope(trips: DataFrame, zones: DataFrame) -> DataFrame:
    counts = (trips.where(C.in_scope() & F.col("pickup_location_id").isNotNull())
                   .groupBy("pickup_location_id").agg(_count().alias("courses")))
    return _named_in_scope(counts, zones)


def top_zone_in_scope(trips: DataFrame, zones: DataFrame, k: int = 1) -> DataFrame:
    """Most frequent pickup zone among in-scope trips, chosen by id (ties: lowest id)."""
    return (zone_counts_in_scope(trips, zones)
            .orderBy(F.desc("courses"), "location_id").limit(k))


def top_zone_in_scope_from_pairs(pairs: DataFrame, zones: DataFrame, k: int = 1) -> DataFrame:
    """``top_zone_in_scope`` from the zone-pair counts (zones without an in-scope trip left out)."""
    counts = (pairs.where(F.col("pickup_location_id").isNotNull())
                   .groupBy("pickup_location_id").agg(F.sum("n_scope").alias("courses"))
                   .where(F.col("courses") > 0))
    return _named_in_scope(counts, zones).orderBy(F.desc("courses"), "location_id").limit(k)


def _flows(pairs: DataFrame, zones: DataFrame) -> DataFrame:
    """Borough flows from per-(pickup id, drop-off id) counts ``n`` of different zones."""
    z = zones.select("location_id", "borough")
    zb = z.withColumnsRenamed({"location_id": "pu_id", "borough": "depart"})
    zd = z.withColumnsRenamed({"location_id": "do_id", "borough": "arrivee"})
    return (pairs.join(zb, pairs.pickup_location_id == zb.pu_id, "inner")
                 .join(zd, pairs.dropoff_location_id == zd.do_id, "inner")
                 .groupBy("depart", "arrivee").agg(F.sum("n").alias("courses")))


def zone_flows(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Trips between boroughs (origin zone <> destination zone), zones joined twice."""
    pairs = (trips.where(F.col("pickup_location_id") != F.col("dropoff_location_id"))
                  .groupBy("pickup_location_id", "dropoff_location_id")
                  .agg(_count().alias("n")))
    return _flows(pairs, zones)


def zone_flows_from_pairs(pairs: DataFrame, zones: DataFrame) -> DataFrame:
    """``zone_flows`` from the zone-pair counts."""
    return _flows(pairs.where(F.col("pickup_location_id") != F.col("dropoff_location_id"))
                       .select("pickup_location_id", "dropoff_location_id", F.col("n_all").alias("n")),
                  zones)


def flow_nodes(flows: DataFrame, digits: int = 6) -> DataFrame:
    """Chord sectors: node size = outgoing + incoming (diagonal counted twice),
    share of the total, sector [angle_start, angle_end] clockwise from 90 deg
    in label order. Cumulative sums are taken on exact integer counts."""
    # one pass over flows: each flow counts for its origin and its destination
    roles = F.array(F.struct(F.col("depart").alias("label"), F.col("courses").alias("c")),
                    F.struct(F.col("arrivee").alias("label"), F.col("courses").alias("c")))
    sizes = (flows.select(F.inline(roles))
                  .groupBy("label").agg(F.sum("c").alias("node_size")))
    # labels are boroughs: one row holds them all, in order
    row = sizes.agg(F.sort_array(F.collect_list(F.struct("label", "node_size"))).alias("all"), F.sum("node_size").alias("total"))
    each = row.select("all", "total", F.posexplode("all").alias("k", "node"))
    cum = F.aggregate(F.slice("all", 1, F.col("k") + 1), F.lit(0).cast("long"), lambda s, x: s + x["node_size"])
    each = each.select("total", cum.alias("cum"), "node.label", "node.node_size")
    return (each.select("label", "node_size",
                         F.round(F.col("node_size") / F.col("total"), digits).alias("share"),
                         F.round(F.lit(90.0) - F.col("cum") * 360.0 / F.col("total"), digits).alias("angle_start"),
                         F.round(F.lit(90.0) - (F.col("cum") - F.col("node_size")) * 360.0 / F.col("total"),
                                 digits).alias("angle_end")))


def flow_ribbons(flows: DataFrame, digits: int = 6) -> DataFrame:
    """Ribbon end angles: outgoing cursor per origin in destination order, incoming
    cursor per destination in origin order, both from the sector's start angle;
    internal flows consume angle but are not drawn. Null labels sort first and have no ribbon.

    Flows are boroughs squared: one row holds them all, so that sizes, sector starts and
    cursors are sums over that row and the flows' input is read once."""
    row = flows.agg(F.collect_list(F.struct("depart", "arrivee", "courses")).alias("all"))
    f = row.select("all", F.inline("all")).where(
        (F.col("courses") > 0) & F.col("depart").isNotNull() & F.col("arrivee").isNotNull())

    def total(part) -> F.Column:
        return F.aggregate("all", F.lit(0).cast("long"), lambda s, x: s + x["courses"] * part(x))

    def number(test: F.Column, unknown: bool) -> F.Column:
        return F.coalesce(test, F.lit(unknown)).cast("long")

    def size(label: F.Column) -> F.Column:
        return total(lambda x: number(x["depart"] == label, False) + number(x["arrivee"] == label, False))

    def upto(label: F.Column) -> F.Column:
        return total(lambda x: number(x["depart"] <= label, True) + number(x["arrivee"] <= label, True))

    d, a = F.col("depart"), F.col("arrivee")
    f = f.select("depart", "arrivee", "courses", total(lambda x: F.lit(2).cast("long")).alias("total"),
                 size(d).alias("o_size"), upto(d).alias("o_cum"), size(a).alias("d_size"), upto(a).alias("d_cum"),
                 total(lambda x: number(x["depart"] == d, False) * number(x["arrivee"] < a, True)).alias("out_before"),
                 total(lambda x: number(x["arrivee"] == a, False) * number(x["depart"] < d, True)).alias("in_before"))

    def angle(role: str, before: F.Column) -> F.Column:
        start = F.round(F.lit(90.0) - F.col(f"{role}_cum") * 360.0 / F.col("total"), 12)
        return F.round(start + before * 360.0 / F.col(f"{role}_size"), digits)

    out, into = F.col("out_before"), F.col("in_before")
    return f.select("depart", "arrivee", "courses",
                    angle("o", out).alias("out_start"), angle("o", out + F.col("courses")).alias("out_end"),
                    angle("d", into).alias("in_start"), angle("d", into + F.col("courses")).alias("in_end"),
                    (F.col("depart") != F.col("arrivee")).alias("drawn"))


def borough_labels(zones: DataFrame) -> list[str]:
    """The boroughs of the zone table, in order (a few names; a job on that table alone)."""
    return [r[0] for r in zones.where(F.col("borough").isNotNull()).select("borough").distinct().orderBy("borough").collect()]


def flow_matrix(flows: DataFrame, labels: list[str] | None = None) -> DataFrame:
    """Dense origin x destination matrix (pivot, missing cells 0).

    With ``labels`` (those of ``borough_labels``, say) the matrix has these rows and columns and building it
    runs no job. Without, rows and columns are the union of origin and destination labels: every flow
    also emits a zero self-cell for both of its labels, and the pivot asks for the labels
    first, so the small flows are checkpointed: their input is read once."""
    if labels is not None:
        spark = flows.sparkSession
        empty = spark.createDataFrame([(x,) for x in labels], "d string").select("d", F.col("d").alias("a"), F.lit(0).cast("long").alias("c"))
        cells = flows.select(F.col("depart").alias("d"), F.col("arrivee").alias("a"), F.col("courses").cast("long").alias("c"))
        return (cells.where(F.col("d").isin(labels)).unionByName(empty)
                     .groupBy(F.col("d").alias("depart")).pivot("a", labels).agg(F.sum("c"))
                     .na.fill(0).orderBy("depart"))
    flows = flows.checkpoint()
    cells = F.array(
        F.struct(F.col("depart").alias("d"), F.col("arrivee").alias("a"), F.col("courses").cast("long").alias("c")),
        F.struct(F.col("depart").alias("d"), F.col("depart").alias("a"), F.lit(0).cast("long").alias("c")),
        F.struct(F.col("arrivee").alias("d"), F.col("arrivee").alias("a"), F.lit(0).cast("long").alias("c")))
    return (flows.select(F.inline(cells))
                 .groupBy(F.col("d").alias("depart")).pivot("a").agg(F.sum("c"))
                 .na.fill(0)
                 .orderBy("depart"))


# --------------------------------------------------------------- price per distance
def scoped_ratio(trips: DataFrame) -> DataFrame:
    return trips.where(C.in_scope()).withColumn("prix_km", C.ratio("fare_amount", "trip_distance"))


def price_per_distance(trips: DataFrame, digits: int = 9) -> DataFrame:
    """Global mean fare per distance and count over all in-scope trips."""
    return (scoped_ratio(trips)
            .agg(F.round(F.avg("prix_km"), digits).alias("prix_km_moyen"), _count().alias("courses")))


def price_cells(trips: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Trips per (start zone, year, month, price bin): zone is NULL out of scope, bin is NULL
    out of scope or at the ratio cap. Bounded by zones x months x bins."""
    scope = C.in_scope()
    ratio = C.ratio("fare_amount", "trip_distance")
    t = F.col("pickup_datetime")
    return (trips.select(F.when(scope, F.col("pickup_location_id")).alias("zone"), F.year(t).alias("y"), F.month(t).alias("m"),
                         F.when(scope & (ratio < S.RATIO_CAP), C.price_bin(ratio)).alias("bin"), *by)
                 .groupBy("zone", "y", "m", "bin", *by).agg(_count().alias("n")))


def price_histogram(trips: DataFrame, zones: DataFrame, location_id: int | None = None, zone_name: str | None = None) -> DataFrame:
    """Histogram of fare/distance (bins of 0.5, ratio < 20) of one start zone per period
    ('yyyy-MM' when the data holds one year, else 'yyyy').

    The zone is ``location_id``, or the one called ``zone_name``, or by default the most
    frequent in-scope zone (of several: most trips, then lowest id). It is chosen on one row per zone
    (zone, count); its cells are then taken from the same aggregate, whose shuffle is used twice,
    so trips are scanned once."""
    return price_histogram_from_cells(price_cells(trips), zones, location_id, zone_name)


def price_histogram_from_cells(cells: DataFrame, zones: DataFrame, location_id: int | None = None, zone_name: str | None = None) -> DataFrame:
    """``price_histogram`` from the price cells."""
    per_zone = cells.groupBy("zone").agg(F.sum("n").alias("courses"), F.min("y").alias("y0"), F.max("y").alias("y1"))
    named = per_zone.join(zones.select("location_id", "zone_name"), F.col("zone") == F.col("location_id"), "left")
    if location_id is not None:
        wanted = F.col("zone") == int(location_id)
    else:
        wanted = F.col("zone_name") == zone_name if zone_name is not None else F.col("location_id").isNotNull()
    best = F.max(F.when(wanted, F.struct("courses", (-F.col("zone")).alias("minus"))))
    choice = (named.agg(best.alias("best"), (F.min("y0") == F.max("y1")).alias("one_year"))
                   .where(F.col("best").isNotNull()).select((-F.col("best.minus")).alias("chosen"), "one_year"))
    # null-safe equality and a test on the sum, not the bin: a filter that could move below the
    # aggregate would make its two uses differ, and the trips would be read twice
    own = cells.join(choice, F.col("zone").eqNullSafe(F.col("chosen")))
    period = F.when(F.col("one_year"), F.format_string("%04d-%02d", "y", "m")).otherwise(F.format_string("%04d", "y"))
    return (own.groupBy(period.alias("periode"), "bin").agg(F.sum(F.when(F.col("bin").isNotNull(), F.col("n"))).alias("n"))
               .where(F.col("n").isNotNull()))


def price_density(hist: DataFrame, digits: int = 9) -> DataFrame:
    """Density per period on a dense bin axis (global min..max bin, gaps 0):
    n / (sum(n) * bin_width). ``hist`` is small (periods x bins, bins bounded by
    the ratio cap) and is read once: each period's bins become one map."""
    per = hist.groupBy("periode").agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("m"),
        F.min("bin").alias("pmin"), F.max("bin").alias("pmax"), F.sum("n").alias("total"))
    bounds = (per.agg(F.collect_list(F.struct("periode", "m", "total")).alias("periods"), F.min("pmin").alias("lo"), F.max("pmax").alias("hi"))
                 .select("lo", "hi", F.inline("periods")))
    axis = bounds.select("periode", "m", "total", F.explode(F.sequence("lo", "hi")).alias("bin"))
    dense = axis.select("periode", "bin", "total",
                        F.coalesce(F.col("m")[F.col("bin")], F.lit(0)).cast("long").alias("n"))
    return dense.select("periode", "bin", "n",
                        F.round(F.col("n") / (F.col("total") * S.PRICE_BIN_WIDTH), digits).alias("density"))


def smooth(col: str, order: Window) -> F.Column:
    """One pass of the [1,4,6,4,1]/16 kernel, zero-padded, same length."""
    k = S.SMOOTHING_KERNEL
    terms = [F.lag(col, 2, 0.0).over(order) * k[0], F.lag(col, 1, 0.0).over(order) * k[1],
             F.col(col) * k[2],
             F.lead(col, 1, 0.0).over(order) * k[3], F.lead(col, 2, 0.0).over(order) * k[4]]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return total / float(sum(k))


def price_ridgeline(hist: DataFrame, digits: int = 9) -> DataFrame:
    """Smoothed (two kernel passes), globally scaled density curves, stacked by
    period: baseline = n_periods - 1 - rank(period)."""
    dens = price_density(hist, digits=17).withColumn(
        "d", F.col("n") / (F.sum("n").over(Window.partitionBy("periode")) * S.PRICE_BIN_WIDTH))
    # (d is recomputed unrounded from the exact integer counts)
    order = Window.partitionBy("periode").orderBy("bin")
    s1 = dens.withColumn("s1", smooth("d", order))
    s2 = s1.withColumn("y", smooth("s1", order))
    curves = s2.groupBy("periode").agg(F.collect_list(F.struct("bin", "y")).alias("points"), F.max("y").alias("top"))
    row = curves.agg(F.sort_array(F.collect_list(F.struct("periode", "points"))).alias("curves"), F.max("top").alias("ymax"))
    ranked = row.select("ymax", F.size("curves").alias("n_periods"), F.posexplode("curves").alias("k", "curve"))
    ranked = ranked.select("ymax", "n_periods", "k", "curve.periode", F.inline("curve.points"))
    return ranked.select(
        "periode", "bin",
        (F.col("bin") * S.PRICE_BIN_WIDTH + S.PRICE_BIN_WIDTH / 2).alias("x"),
        F.round("y", digits).alias("y"),
        F.round(F.col("y") / F.col("ymax"), digits).alias("y_scaled"),
        (F.col("n_periods") - 1 - F.col("k")).cast("int").alias("baseline"))


# --------------------------------------------------------------- time of day
def heatmap_year(trips: DataFrame, year: int | None = None) -> DataFrame:
    """Trips by (year, vtype, weekday 0=Monday, hour): one grouped query for all years
    (or one year, pruned by the partition filter)."""
    t = trips if year is None else trips.where(F.col("year") == year)
    return (t.groupBy("year", "vtype",
                      C.weekday_index("pickup_datetime").alias("jour"),
                      F.hour("pickup_datetime").alias("heure"))
             .agg(_count().alias("courses")))


def heatmap_from_profile(prof: DataFrame) -> DataFrame:
    """``heatmap_year`` (all years) from the hourly profile: an hour start has the
    year, weekday and hour of every pickup in it, so the counts are the same."""
    return (prof.groupBy(F.year("ts").alias("year"), "vtype",
                         C.weekday_index("ts").alias("jour"), F.hour("ts").alias("heure"))
                .agg(F.sum("n_all").alias("courses")))


def heatmap_dense(heat: DataFrame) -> DataFrame:
    """Dense 7 x 24 grid per (year, vtype) with 0 for empty cells and weekday names.
    ``heat`` is read once: each group's cells become one map (at most 168 entries)."""
    per = heat.groupBy("year", "vtype").agg(F.map_from_entries(F.collect_list(
        F.struct((F.col("jour") * 24 + F.col("heure")).alias("c"), F.col("courses")))).alias("m"))
    cells = per.select("year", "vtype", "m", F.explode(F.sequence(F.lit(0), F.lit(7 * 24 - 1))).alias("c"))
    jour = (F.col("c") / 24).cast("int")
    return cells.select("year", "vtype", jour.alias("jour"), C.weekday_name(jour).alias("jour_nom"),
                        (F.col("c") % 24).cast("int").alias("heure"),
                        F.coalesce(F.col("m")[F.col("c")], F.lit(0)).cast("long").alias("courses"))


# --------------------------------------------------------------- weather
def price_by_weather(trips: DataFrame, weather: DataFrame, digits: int = 6) -> DataFrame:
    """Mean fare per distance under rain (> 0.2 mm) vs dry, and the deviation from
    the mean over all in-scope trips (also those without a weather hour).

    Trips are first reduced to one row per pickup hour (sum, count): the
    weather join then touches at most one row per hour, and both the class
    means and the baseline come from that one pre-aggregate (mean = sum/count).
    """
    hourly = (scoped_ratio(trips)
              .groupBy(C.hour_start("pickup_datetime").alias("ts"))
              .agg(F.sum("prix_km").alias("s"), _count().alias("n")))
    return price_by_weather_hourly(hourly, weather, digits)


def price_by_weather_from_profile(prof: DataFrame, weather: DataFrame, digits: int = 6) -> DataFrame:
    """``price_by_weather`` from the hourly profile (in-scope sums per hour)."""
    hourly = (prof.where(F.col("n") > 0).groupBy("ts")
                  .agg(F.sum("s").alias("s"), F.sum("n").alias("n")))
    return price_by_weather_hourly(hourly, weather, digits)


def price_by_weather_hourly(hourly: DataFrame, weather: DataFrame, digits: int = 6) -> DataFrame:
    """Class means and deviation from in-scope ratio sums ``s`` and counts ``n`` per hour ``ts``."""
    w = weather.select("ts", "precipitation_mm", F.lit(True).alias("has_weather"))
    classes = (hourly.join(w, "ts", "left")
                     .withColumn("conditions", F.when(F.col("has_weather"),
                                                      C.weather_condition("precipitation_mm")))
                     .groupBy("conditions").agg(F.sum("s").alias("s"), F.sum("n").alias("n")))
    row = classes.agg(F.collect_list(F.struct("conditions", "s", "n")).alias("classes"),
                      (F.sum("s") / F.sum("n")).alias("mean_all"))
    base = row.select("mean_all", F.inline("classes"))
    return (base.where(F.col("conditions").isNotNull())
                .select("conditions", F.col("n").alias("courses"),
                        F.round(F.col("s") / F.col("n"), digits).alias("prix_km_moyen"),
                        F.round(100 * (F.col("s") / F.col("n") / F.col("mean_all") - 1), digits).alias("ecart_pct")))


def weather_at_trip(trips: DataFrame, zones: DataFrame, weather: DataFrame,
                    hour: str | None = None, head: int | None = None) -> DataFrame:
    """Weather at the pickup hour of each trip with its zone (trip x zone x weather).
    With ``hour`` ('yyyy-MM-dd HH:00:00') only trips picked up in that hour, as a
    half-open range on the pickup time so it stays pushable. With ``head`` the first rows
    in order of time, zone and measures (a sample that is the same every time)."""
    t = trips
    if hour is not None:
        start = F.lit(hour).cast("timestamp_ntz")
        t = t.where((F.col("pickup_datetime") >= start)
                    & (F.col("pickup_datetime") < start + F.expr("INTERVAL 1 HOUR")))
        if {"year", "month"} <= set(trips.columns):
            # the lake is partitioned by pickup year/month: prune to one folder
            y, m = int(hour[0:4]), int(hour[5:7])
            t = t.where((F.col("year") == y) & (F.col("month") == m))
        if "pickup_hour" in trips.columns:
            # written silver is sorted by time: the pages of that hour
            t = t.where(F.col("pickup_hour") == C.hour_number(start))
    z = zones.select("location_id", "zone_name")
    w = weather.select("ts", "temperature_c", "precipitation_mm")
    return (t.select("pickup_datetime", "pickup_location_id")
             .join(z, F.col("pickup_location_id") == z.location_id, "inner")
             .join(w, C.hour_start("pickup_datetime") == w.ts, "inner")
             .select("pickup_datetime", "zone_name", "temperature_c", "precipitation_mm")
             .transform(lambda d: d if head is None else d.orderBy(*d.columns).limit(head)))


# --------------------------------------------------------------- KPI row
def hourly_profile(trips: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """One row per (vtype, pickup hour) with every count the KPI row needs:
    all trips, trips with a pickup zone, in-scope trips and their ratio sum.
    Bounded by types x hours of the calendar, whatever the trip volume."""
    scope = C.in_scope()
    r = C.ratio("fare_amount", "trip_distance")
    return (trips.groupBy("vtype", C.hour_start("pickup_datetime").alias("ts"), *by)
                 .agg(_count().alias("n_all"), F.count("pickup_location_id").alias("n_zone"),
                      F.sum(F.when(scope, r)).alias("s"), F.count(F.when(scope, F.lit(1))).alias("n")))


def kpi_cards(spark: SparkSession, trips: DataFrame, weather: DataFrame) -> DataFrame:
    """The six headline values (numbers and their display strings) in one row.

    Trips are scanned once, into the hourly profile; volumes by (type, year), the zone
    fill rate, the global mean fare per distance and the rain deviation all come from it
    (means as sum / count)."""
    return kpi_cards_from_profile(spark, hourly_profile(trips), weather)


def kpi_cards_from_profile(spark: SparkSession, prof: DataFrame, weather: DataFrame) -> DataFrame:
    """``kpi_cards`` from the hourly profile, which is read once: the weather joins it (one row
    an hour at most), sums per type and year follow, and one aggregate over those."""
    rainy = weather.groupBy("ts").agg(F.max(F.col("precipitation_mm") > S.RAIN_THRESHOLD_MM).alias("rainy"))
    rain = F.col("rainy")
    vol = (prof.join(rainy, "ts", "left").groupBy("vtype", F.year("ts").alias("year"))
               .agg(F.sum("n_all").alias("courses"), F.round(F.sum("n_zone") / F.sum("n_all") * 100, 1).alias("pct"),
                    F.sum("s").alias("s"), F.sum("n").alias("n"),
                    F.sum(F.when(rain, F.col("s"))).alias("rain_s"), F.sum(F.when(rain, F.col("n"))).alias("rain_n")))
    first, last = F.min("year").cast("string"), F.max("year").cast("string")
    scope = F.transform(F.array_sort(F.collect_list(F.struct("vtype", "year"))),
                        lambda x: F.concat_ws(" ", x["vtype"], x["year"].cast("string")))
    mean = F.sum("s") / F.sum("n")
    row = vol.agg(F.sum("courses").cast("long").alias("total_courses"), F.countDistinct("vtype").alias("n_types"),
                  F.when(first == last, first).otherwise(F.concat(first, F.lit("-"), last)).alias("periode"),
                  F.array_join(scope, ", ").alias("perimetre"),
                  F.round(F.sum(F.col("courses") * F.col("pct")) / F.sum("courses"), 1).alias("pct_global"),
                  F.round(mean, 6).alias("prix_km_moyen"),
                  F.round(F.coalesce(100 * (F.sum("rain_s") / F.sum("rain_n") / mean - 1), F.lit(0.0)), 6).alias("delta_pluie"))
    return row.select("*", F.format_string("%.2f $/km", "prix_km_moyen").alias("prix_txt"),
                      F.format_string("%+.1f %%", "delta_pluie").alias("pluie_txt"),
                      F.format_string("%.1f %%", "pct_global").alias("pct_txt"),
                      C.thousands("total_courses").alias("total_txt"))
