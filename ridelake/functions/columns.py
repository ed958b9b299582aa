"""Column expressions (all built-in Spark functions, so they stay in codegen)."""
from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schema as S


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: str | Column) -> Column:
    """To double, NaN -> NULL."""
    x = col_of(c).try_cast("double")
    return F.when(~F.isnan(x), x)


def in_range(c: str | Column, lo: float, hi: float) -> Column:
    """Value when inside [lo, hi], else NULL (the row is kept)."""
    x = col_of(c)
    return F.when(x.between(F.lit(lo), F.lit(hi)), x)


def normalize_flag(c: str | Column) -> Column:
    """trim + upper; {1,Y,TRUE} -> 'Y', {0,N,FALSE} -> 'N', anything else -> NULL."""
    s = F.upper(F.trim(col_of(c).cast("string")))
    return F.when(s.isin(*S.FLAG_YES), F.lit("Y")).when(s.isin(*S.FLAG_NO), F.lit("N"))


def normalize_category(c: str | Column) -> Column:
    """trim + lower, then the payment category table; other non-null -> 'autre'."""
    s = F.lower(F.trim(col_of(c).cast("string")))
    out = None
    for spellings, label in S.PAYMENT_CATEGORIES:
        cond = s.isin(*spellings)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.when(s.isNotNull(), F.lit(S.PAYMENT_OTHER))


def rate_code(c: str | Column) -> Column:
    """Rate code as int, NULL when not numeric or NaN."""
    return money(c).try_cast("int")


def sentinel_to_null(c: str | Column, before: str = S.SENTINEL_BEFORE) -> Column:
    """A timestamp before the sentinel date means unknown: NULL, row kept."""
    x = col_of(c)
    return F.when(x < F.lit(before).cast("timestamp_ntz"), F.lit(None)).otherwise(x)


def applicable(pickup: str | Column, since: date) -> Column:
    """Fee applicability: pickup day on or after its introduction date."""
    return F.to_date(col_of(pickup)) >= F.lit(since)


def fee_status(amount: str | Column, is_applicable: str | Column) -> Column:
    """Three states: 'not_yet' (before introduction), 'not_charged' (NULL or 0), 'charged'."""
    a = col_of(amount)
    return (F.when(~col_of(is_applicable), F.lit("not_yet"))
             .when(F.coalesce(a, F.lit(0.0)) == 0, F.lit("not_charged"))
             .otherwise(F.lit("charged")))


def duration_seconds(start: str | Column, end: str | Column) -> Column:
    """Whole seconds between two naive timestamps (exact, no time zone involved)."""
    return F.timestamp_diff("SECOND", col_of(start), col_of(end))


def grid_key(c: str | Column, step: int = S.GRID_STEP) -> Column:
    """Cell index of a coordinate: round(x * step), half away from zero; NULL if out of int range."""
    return F.round(col_of(c) * F.lit(step)).try_cast("int")


def ratio(num: str | Column, den: str | Column) -> Column:
    """num / den, NULL when den is 0 (ANSI-safe)."""
    return F.try_divide(col_of(num), col_of(den))


def weekday_index(ts: str | Column) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.pmod(F.dayofweek(col_of(ts)) + F.lit(5), F.lit(7))


def weekday_name(idx: str | Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in S.WEEKDAYS]), col_of(idx) + 1)


def hour_start(ts: str | Column) -> Column:
    """Start of the hour as a naive local timestamp, built from the fields so no
    session time zone (and no DST gap) is involved."""
    t = col_of(ts)
    return F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), F.lit(0), F.lit(0))


def year_month(ts: str | Column) -> Column:
    """'yyyy-MM' of a naive timestamp, from its fields (no session time zone)."""
    t = col_of(ts)
    return F.format_string("%04d-%02d", F.year(t), F.month(t))


def iso_minute(ts: str | Column) -> Column:
    """'yyyy-MM-ddTHH:mm' of a naive timestamp, from its fields."""
    t = col_of(ts)
    return F.format_string("%04d-%02d-%02dT%02d:%02d", F.year(t), F.month(t), F.dayofmonth(t),
                           F.hour(t), F.minute(t))


def in_scope(distance: str | Column = "trip_distance", fare: str | Column = "fare_amount") -> Column:
    """Analysis scope: distance in [0.5, 50] and fare > 2.5 (both pushable to the scan)."""
    return (col_of(distance).between(F.lit(S.SCOPE_MIN_DISTANCE), F.lit(S.SCOPE_MAX_DISTANCE))
            & (col_of(fare) > F.lit(S.SCOPE_MIN_FARE)))


def price_bin(r: str | Column, width: float = S.PRICE_BIN_WIDTH) -> Column:
    return F.floor(col_of(r) / F.lit(width)).cast("int")


def weather_condition(precip: str | Column) -> Column:
    """'pluie' when precipitation > 0.2 mm, else 'sec' (missing counts as dry)."""
    return F.when(col_of(precip) > F.lit(S.RAIN_THRESHOLD_MM), F.lit("pluie")).otherwise(F.lit("sec"))


def thousands(n: str | Column) -> Column:
    """Integer with a space as thousands separator: 1234567 -> '1 234 567'."""
    return F.translate(F.format_number(col_of(n).cast("long"), 0), ",", " ")


def hour_number(ts: Column | str) -> Column:
    """Hours from 1970 to a naive timestamp, as an integer: Parquet's page statistics are compared with integers,
    but not with timestamps without a zone."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    hours = F.timestamp_diff("HOUR", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.date_trunc("HOUR", ts).cast("timestamp_ntz"))
    return hours.cast("int")
