"""Cleaning rules on hand-made edge rows."""
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from ridelake import schema as S
from ridelake.functions import columns as C
from ridelake.operators import clean


def one_col(spark, values, typ):
    return spark.createDataFrame([(v,) for v in values], f"x {typ}")


def test_money_nan_to_null_and_strings(spark):
    df = one_col(spark, ["1.5", "NaN", "abc", None, "  2 "], "string")
    got = [r[0] for r in df.select(C.money("x")).collect()]
    assert got[0] == 1.5 and got[1] is None and got[2] is None and got[3] is None
    assert got[4] == 2.0


def test_distance_range_guard(spark):
    df = one_col(spark, [-0.1, 0.0, 200.0, 200.1, float("nan")], "double")
    got = [r[0] for r in df.select(C.in_range(C.money("x"), 0.0, S.MAX_DISTANCE)).collect()]
    assert got == [None, 0.0, 200.0, None, None]


def test_flag_normalisation(spark):
    df = one_col(spark, ["1", "Y", " true ", "0", " n ", "FALSE", "x", None], "string")
    got = [r[0] for r in df.select(C.normalize_flag("x")).collect()]
    assert got == ["Y", "Y", "Y", "N", "N", "N", None, None]


def test_category_normalisation(spark):
    raw = [" Credit", "1", "CASH", "2", "No Charge", "3", "Dispute", "4", "Unknown", "5", "6",
           "foo", "0", None]
    want = ["carte", "carte", "especes", "especes", "sans_frais", "sans_frais", "litige", "litige",
            "inconnu", "inconnu", "annule", "autre", "autre", None]
    df = one_col(spark, raw, "string")
    assert [r[0] for r in df.select(C.normalize_category("x")).collect()] == want


def test_rate_code(spark):
    df = one_col(spark, ["1", "5.0", "x", "NaN", None], "string")
    assert [r[0] for r in df.select(C.rate_code("x")).collect()] == [1, 5, None, None, None]


def test_sentinel_keeps_row(spark):
    df = spark.createDataFrame([(datetime(1989, 1, 1),), (datetime(1990, 1, 1),), (None,)],
                               "x timestamp_ntz")
    got = [r[0] for r in df.select(C.sentinel_to_null("x")).collect()]
    assert got == [None, datetime(1990, 1, 1), None]


@pytest.mark.parametrize("fee", list(S.INTRO_DATE))
def test_applicability_boundary(spark, fee):
    d0 = S.INTRO_DATE[fee]
    start = datetime(d0.year, d0.month, d0.day)
    rows = [(start - timedelta(minutes=1),), (start,)]
    df = spark.createDataFrame(rows, "pickup_datetime timestamp_ntz")
    got = [r[0] for r in df.select(C.applicable("pickup_datetime", d0)).collect()]
    assert got == [False, True]


def test_fee_status_three_states(spark):
    df = spark.createDataFrame([(None, False), (None, True), (0.0, True), (2.5, True)],
                               "amount double, app boolean")
    got = [r[0] for r in df.select(C.fee_status("amount", "app")).collect()]
    assert got == ["not_yet", "not_charged", "not_charged", "charged"]


def _trip(pu, do, total):
    return Row(pickup_datetime=pu, dropoff_datetime=do, total_amount=total)


def test_quality_filter_boundaries(spark):
    t0 = datetime(2020, 5, 1, 12, 0, 0)
    def sec(n):
        return t0 + timedelta(seconds=n)

    rows = [
        _trip(t0, sec(-1), 1.0),        # negative duration: out
        _trip(t0, sec(0), 1.0),         # zero: in
        _trip(t0, sec(86400), 1.0),     # exactly 24 h: in
        _trip(t0, sec(86401), 1.0),     # over 24 h: out
        _trip(t0, None, 1.0),           # unknown drop-off: in (out when strict)
        _trip(None, sec(10), 1.0),      # no pickup: out
        _trip(t0, sec(60), -0.01),      # negative total: out
        _trip(t0, sec(60), 0.0),        # zero total: in
        _trip(t0, sec(60), None),       # unknown total: in
    ]
    df = spark.createDataFrame(rows, "pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, "
                                     "total_amount double")
    kept = clean.quality_filter(df).count()
    strict = clean.quality_filter(df, strict=True).count()
    assert kept == 5
    assert strict == 4


def test_canonicalize_case_insensitive_and_typed_nulls(spark):
    raw = spark.createDataFrame(
        [("fhvhv", datetime(2023, 1, 1, 1, 0), datetime(2023, 1, 1, 1, 30), "HV0003", 1.5, 7)],
        "vtype string, PICKUP_DATETIME timestamp_ntz, dropOff_datetime timestamp_ntz, "
        "hvfhs_license_num string, Airport_fee double, PULocationID bigint")
    out = clean.canonicalize(raw)
    types = dict(out.dtypes)
    assert types["passenger_count"] == "int" and types["vendor_id"] == "string"
    assert types["fare_amount"] == "double" and types["pickup_datetime"] == "timestamp_ntz"
    r = out.first()
    assert r["airport_fee"] == 1.5 and r["pub_pickup_zone"] == 7 and r["fare_amount"] is None
    assert r["pickup_datetime"] == datetime(2023, 1, 1, 1, 0)


def test_era_union_of_unlike_schemas(spark):
    a = spark.createDataFrame([("yellow", "2009-01-02 03:04:05", "x", "1.0")],
                              "vtype string, Trip_Pickup_DateTime string, Rate_Code string, Fare_Amt string")
    b = spark.createDataFrame([("green", datetime(2015, 1, 1), 2.0, 9)],
                              "vtype string, lpep_pickup_datetime timestamp_ntz, RatecodeID double, VendorID int")
    u = clean.clean_values(clean.era_union([a, b]))
    rows = {r["vtype"]: r for r in u.collect()}
    assert rows["yellow"]["pickup_datetime"] == datetime(2009, 1, 2, 3, 4, 5)
    assert rows["yellow"]["rate_code_id"] is None and rows["green"]["rate_code_id"] == 2
    assert rows["green"]["vendor_id"] == "9" and rows["yellow"]["fare_amount"] == 1.0


def test_scope_boundaries(spark):
    rows = [(0.49, 10.0), (0.5, 10.0), (50.0, 10.0), (50.1, 10.0), (5.0, 2.5), (5.0, 2.51)]
    df = spark.createDataFrame(rows, "trip_distance double, fare_amount double")
    got = [r[0] for r in df.select(C.in_scope()).collect()]
    assert got == [False, True, True, False, False, True]


def test_rain_threshold(spark):
    df = one_col(spark, [0.2, 0.21, None], "double")
    assert [r[0] for r in df.select(C.weather_condition("x")).collect()] == ["sec", "pluie", "sec"]


def test_hour_start_stays_local_on_dst_day(spark):
    # 02:30 on a spring-forward day does not exist in New York; naive time keeps it.
    df = spark.createDataFrame([(datetime(2024, 3, 10, 2, 30),)], "x timestamp_ntz")
    r = df.select(C.hour_start("x").alias("h")).first()
    assert r["h"] == datetime(2024, 3, 10, 2, 0)
    assert dict(df.select(C.hour_start("x").alias("h")).dtypes)["h"] == "timestamp_ntz"


def test_weekday_index_monday_zero(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1),), (datetime(2024, 1, 7),)], "x timestamp_ntz")
    got = df.select(C.weekday_index("x").alias("d"), C.weekday_name(C.weekday_index("x")).alias("n")).collect()
    assert [(r["d"], r["n"]) for r in got] == [(0, "Lundi"), (6, "Dimanche")]


def test_thousands_format(spark):
    df = one_col(spark, [1234567, 12], "bigint")
    assert [r[0] for r in df.select(C.thousands("x")).collect()] == ["1 234 567", "12"]


def test_fixture_intro_dates_are_library_dates():
    assert S.INTRO_DATE["congestion_surcharge"] == date(2019, 2, 1)


def test_time_helpers_ignore_session_time_zone(spark):
    # 02:30 on 2024-03-10 does not exist in New York; every helper must keep it
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(datetime(2024, 3, 10, 2, 30),)], "x timestamp_ntz")
        r = df.select(C.hour_start("x").alias("h"), C.year_month("x").alias("ym"),
                      C.iso_minute("x").alias("iso"), F.hour("x").alias("hh")).first()
        assert r["h"] == datetime(2024, 3, 10, 2, 0)
        assert (r["ym"], r["iso"], r["hh"]) == ("2024-03", "2024-03-10T02:30", 2)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_one_per_key_keeps_the_same_row_whatever_the_order(spark):
    from ridelake.operators.clean import one_per_key
    rows = [(1, 0.5, None), (1, 0.2, 3.0), (1, 0.2, 1.0), (2, None, 7.0), (2, 0.1, 2.0)]
    schema = "ts int, precipitation_mm double, temperature_c double"
    outs = []
    for order in (rows, rows[::-1], rows[2:] + rows[:2]):
        df = spark.createDataFrame(order, schema).repartition(3)
        outs.append(sorted(tuple(r) for r in one_per_key(df, ["ts"]).collect()))
    assert outs[0] == outs[1] == outs[2] == [(1, 0.2, 1.0), (2, 0.1, 2.0)]


def test_filter_reads_computed_times_above_the_join(spark):
    """The quality filter's times are computed once a row, not anew in a condition moved to the scan for each mention of them."""
    n = F.col("id")
    left = spark.range(40).select(
        "id", F.lit("yellow").alias("vtype"), F.when(n % 4 == 0, "n/a").otherwise(F.format_string("2021-01-01 10:%02d:00", n)).alias("Trip_Pickup_DateTime"),
        F.when(n % 5 == 0, F.lit(None)).otherwise(F.format_string("2021-01-01 11:%02d:00", n)).alias("Trip_Dropoff_DateTime"),
        F.when(n % 7 == 0, -1.0).otherwise(3.0).alias("Total_Amt"))
    raw = left.join(spark.range(40).hint("merge"), "id")
    df = clean.quality_filter(clean.clean_values(clean.era_union([raw])))
    filters = [x for x in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Filter" in x]
    assert any("pickup_datetime" in x for x in filters) and not any("n/a" in x for x in filters), filters
    assert df.count() == sum(i % 4 != 0 and i % 7 != 0 for i in range(40))
    assert df.columns == clean.clean_values(clean.era_union([raw])).columns
