"""Silver cleaning: era canonicalisation, value cleaning, quality filter.

Every step is a single ``select`` of built-in expressions inside the scan's whole-stage codegen, with
no shuffle; what the quality filter reads is computed once a row.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import columns as C


def pick_source(columns: list[str], candidates: list[str]) -> str | None:
    """First candidate present in ``columns``, matched case-insensitively, in map order."""
    lower = {c.lower(): c for c in columns}
    for cand in candidates:
        if cand.lower() in lower:
            return lower[cand.lower()]
    return None


def canonicalize(df: DataFrame, keep: tuple[str, ...] = ("vtype",)) -> DataFrame:
    """Project one historical schema onto the canonical work columns.

    Absent columns become NULLs of the declared type (never 0); present ones
    are cast with ``try_cast`` so a bad value is NULL instead of a failed job.
    """
    exprs: list[Column] = [F.col(k) for k in keep if k in df.columns]
    for name, candidates in S.COLMAP.items():
        src = pick_source(df.columns, candidates)
        typ = S.WORK_TYPES[name]
        if src is None:
            exprs.append(F.lit(None).cast(typ).alias(name))
        elif name in ("rate_code_id", "passenger_count") or typ == "double":
            # numbers may arrive as strings or NaN: NaN -> NULL before any int cast
            x = C.money(src)
            exprs.append((x if typ == "double" else x.try_cast(typ)).alias(name))
        else:
            exprs.append(F.col(src).try_cast(typ).alias(name))
    return df.select(*exprs)


def has_points(columns: list[str]) -> bool:
    """Whether files with these columns can hold a GPS point: both coordinates of the pick-up or of the drop-off."""
    return any(all(pick_source(columns, S.COLMAP[f"{role}_{axis}"]) for axis in ("longitude", "latitude")) for role in ("pickup", "dropoff"))


def era_union(frames: list[DataFrame], keep: tuple[str, ...] = ("vtype",)) -> DataFrame:
    """Canonicalise each schema era and concatenate them by name (one plan, one write)."""
    canon = [canonicalize(f, keep) for f in frames]
    return reduce(lambda a, b: a.unionByName(b), canon)


def computed_once(df: DataFrame, *names: str) -> DataFrame:
    """The same rows; ``names`` are computed once a row. A condition on them that comes later would else be moved below the
    joins of ``df``, to the scan, with their whole expressions (text to time among them) in place of each mention of them:
    conditions on what a generator gives stay behind it."""
    rest = [c for c in df.columns if c not in names]
    return df.select(*rest, F.inline(F.array(F.struct(*names)))).select(*df.columns)


def clean_values(df: DataFrame) -> DataFrame:
    """Value rules on canonical columns: range guard, rate code, flag, category,
    sentinel drop-off, fee applicability."""
    df = computed_once(df, "pickup_datetime", "dropoff_datetime", "total_amount")
    out = {
        "trip_distance": C.in_range("trip_distance", 0.0, S.MAX_DISTANCE),
        "rate_code_id": C.rate_code("rate_code_id"),
        "store_and_fwd_flag": C.normalize_flag("store_and_fwd_raw"),
        "payment_type": C.normalize_category("payment_type_raw"),
        "dropoff_datetime": C.sentinel_to_null("dropoff_datetime"),
    }
    for fee, since in S.INTRO_DATE.items():
        out[f"{fee}_applicable"] = C.applicable("pickup_datetime", since)
    return df.withColumns(out).drop("store_and_fwd_raw", "payment_type_raw")


def quality_condition(strict: bool = False) -> Column:
    """Pickup known; drop-off (if known, or always when strict) not before pickup and at
    most 24 h later (inclusive); total NULL or >= 0."""
    pu, do = F.col("pickup_datetime"), F.col("dropoff_datetime")
    duration_ok = (do >= pu) & (C.duration_seconds(pu, do) <= F.lit(S.MAX_DURATION_S))
    drop_ok = (do.isNotNull() & duration_ok) if strict else (do.isNull() | duration_ok)
    total = F.col("total_amount")
    return pu.isNotNull() & drop_ok & (total.isNull() | (total >= 0))


def quality_filter(df: DataFrame, strict: bool = False) -> DataFrame:
    return df.where(quality_condition(strict))


def with_fee_applicability(df: DataFrame, intro: dict | None = None) -> DataFrame:
    intro = intro or S.INTRO_DATE
    return df.withColumns({f"{fee}_applicable": C.applicable("pickup_datetime", d)
                           for fee, d in intro.items()})


def with_partition_columns(df: DataFrame, ts: str = "pickup_datetime") -> DataFrame:
    return df.withColumns({"year": F.year(ts), "month": F.month(ts)})


def one_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: the one with the fewest NULLs, of those the smallest by the other
    columns in order (NULL last). Unlike ``dropDuplicates`` the choice does not depend
    on the order rows arrive in, so a partition recomputed after a lost executor keeps
    the same row as the first attempt. ``min`` of a struct is a sort-based
    aggregate: meant for tables bounded by the calendar or the zones (weather
    hours), not for facts."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    nulls = reduce(lambda a, b: a + b, [F.col(c).isNull().cast("int") for c in rest])
    order = F.struct(nulls.alias("nulls"), *[F.struct(F.col(c).isNull().alias("null"), F.col(c).alias("value")).alias(c) for c in rest])
    return (df.groupBy(*keys).agg(F.min(order).alias("_row"))
              .select(*keys, *[F.col(f"_row.{c}.value").alias(c) for c in rest]))
