"""Incremental load: a rerun adds nothing, arrival order does not matter."""
from datetime import datetime

from pyspark.sql import functions as F

from ridelake.operators import geo
from ridelake.plans.silver import SOURCE_COL, silver_trips, silver_trips_by_source, write_silver
from ridelake.schema import RING_SCHEMA
from ridelake.session import work_path
from ridelake.streaming.incremental import incremental_load, write_bronze

RAW = ("vtype string, _file_ts timestamp_ntz, tpep_pickup_datetime timestamp_ntz, "
       "tpep_dropoff_datetime timestamp_ntz, pickup_longitude double, pickup_latitude double, "
       "fare_amount double, total_amount double")


def raw_rows(spark, rows):
    return spark.createDataFrame(rows, RAW)


def grid(spark):
    sq = [(-74.0005, 40.6005), (-73.9905, 40.6005), (-73.9905, 40.6105), (-74.0005, 40.6105), (-74.0005, 40.6005)]
    return geo.zone_grid(spark.createDataFrame([(1, 42, sq)], RING_SCHEMA))


def month_file(spark, month, stray=False):
    f = datetime(2021, month, 15)
    rows = [("yellow", f, datetime(2021, month, d, 8), datetime(2021, month, d, 9), -73.995, 40.605, 10.0, 12.0)
            for d in (3, 4, 5)]
    if stray:   # a ride of the next month inside this month's file
        rows.append(("yellow", f, datetime(2021, month + 1, 1, 0, 5), datetime(2021, month + 1, 1, 0, 20),
                     -73.995, 40.605, 7.0, 8.0))
    return raw_rows(spark, rows)


def read_sorted(spark, path):
    return sorted(tuple(r) for r in spark.read.parquet(path)
                  .select("pickup_datetime", "pickup_location_id", "fare_amount", "year", "month").collect())


def test_rerun_adds_nothing_and_order_does_not_matter(spark):
    g = grid(spark).checkpoint()
    bronze_root, silver, ckpt = (work_path(spark, n) for n in ("t-bronze", "t-silver", "t-ckpt"))
    # month 2 arrives first, then month 1 holding a stray ride of month 2
    (era,) = write_bronze([month_file(spark, 2)], bronze_root)
    assert incremental_load(spark, [era], g, silver, ckpt) == 1
    write_bronze([month_file(spark, 1, stray=True)], bronze_root, mode="append")
    assert incremental_load(spark, [era], g, silver, ckpt) == 1
    assert incremental_load(spark, [era], g, silver, ckpt) == 0      # nothing new
    got = read_sorted(spark, silver)

    batch = silver_trips([month_file(spark, 1, stray=True).drop("_file_ts"),
                          month_file(spark, 2).drop("_file_ts")], g)
    want = sorted(tuple(r) for r in batch.select("pickup_datetime", "pickup_location_id", "fare_amount",
                                                  "year", "month").collect())
    assert got == want
    assert len(got) == 7 and all(r[1] == 42 for r in got)
    assert sum(1 for r in got if r[4] == 2) == 4      # the stray landed in its pickup month


def test_batch_rerun_of_one_file_replaces_only_its_rows(spark):
    g = grid(spark).checkpoint()
    bronze_root, silver, flat = (work_path(spark, n) for n in ("b-bronze", "b-silver", "b-flat"))
    (era,) = write_bronze([month_file(spark, 1, stray=True).unionByName(month_file(spark, 2))], bronze_root)
    write_silver(silver_trips_by_source([spark.read.parquet(era)], g), silver)
    full = read_sorted(spark, silver)
    assert len(full) == 7
    assert {r[SOURCE_COL] for r in spark.read.parquet(silver).where("month = 2").collect()} == \
        {"2021-01", "2021-02"}

    # January's file again, alone: its stray ride sits in pickup month 2
    january = spark.read.parquet(era).where("year = 2021 AND month = 1")
    write_silver(silver_trips_by_source([january], g), silver)
    assert read_sorted(spark, silver) == full

    # without the source level, the same re-run replaces all of pickup month 2
    write_silver(silver_trips_by_source([spark.read.parquet(era)], g).drop(SOURCE_COL), flat)
    write_silver(silver_trips_by_source([january], g).drop(SOURCE_COL), flat)
    assert len(read_sorted(spark, flat)) == 4


def test_bounded_micro_batches_give_the_same_table(spark):
    g = grid(spark).checkpoint()
    root, one, many = (work_path(spark, n) for n in ("mb-bronze", "mb-one", "mb-many"))
    (era,) = write_bronze([month_file(spark, 1, stray=True)], root)
    for m in (2, 3):
        write_bronze([month_file(spark, m, stray=True)], root, mode="append")
    n_files = len(spark.read.parquet(era).inputFiles())
    assert incremental_load(spark, [era], g, one, work_path(spark, "mb-ck1")) == 1
    assert incremental_load(spark, [era], g, many, work_path(spark, "mb-ck2"),
                            max_files_per_trigger=1) == n_files
    assert read_sorted(spark, many) == read_sorted(spark, one)
    assert len(read_sorted(spark, many)) == 12


def test_bronze_tree_of_unlike_schemas_loads_pending_months_only(spark):
    from ridelake.plans.silver import load_bronze_tree, read_by_schema
    from ridelake.sources.lake import parquet_files
    g = grid(spark).checkpoint()
    root, silver = work_path(spark, "tree-bronze"), work_path(spark, "tree-silver")
    old = ("Trip_Pickup_DateTime string, Trip_Dropoff_DateTime string, Passenger_Count string, "
           "Start_Lon double, Start_Lat double, Fare_Amt double, Total_Amt double")
    new = ("tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, passenger_count bigint, "
           "pickup_longitude double, pickup_latitude double, fare_amount double, total_amount double")

    def write(vtype, year, month, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/vtype={vtype}/year={year}/month={month:02d}")

    write("yellow", 2009, 1, [("2009-01-05 08:00:00", "2009-01-05 08:30:00", "1", -73.995, 40.605, 9.0, 10.0),
                              ("2009-02-01 00:05:00", "2009-02-01 00:20:00", "2", -73.995, 40.605, 7.0, 8.0)], old)
    write("yellow", 2009, 2, [("2009-02-03 09:00:00", "2009-02-03 09:10:00", "x", -73.995, 40.605, 5.0, 6.0)], old)
    write("yellow", 2015, 1, [(datetime(2015, 1, 2, 7), datetime(2015, 1, 2, 7, 20), 3, -73.995, 40.605, 11.0, 12.0)],
          new)
    assert len(read_by_schema(spark, root, parquet_files(spark, root))) == 2            # two schema eras

    assert load_bronze_tree(spark, root, g, silver) == 3
    assert load_bronze_tree(spark, root, g, silver) == 0           # nothing new
    write("yellow", 2015, 2, [(datetime(2015, 2, 2, 7), datetime(2015, 2, 2, 7, 20), 1, -73.995, 40.605, 4.0, 5.0)],
          new)
    assert load_bronze_tree(spark, root, g, silver) == 1           # only the new month
    got = spark.read.parquet(silver)
    assert got.count() == 5
    assert sorted((r["year"], r["month"], r["source_month"]) for r in got.collect()) == [
        (2009, 1, "2009-01"), (2009, 2, "2009-01"), (2009, 2, "2009-02"), (2015, 1, "2015-01"), (2015, 2, "2015-02")]
    assert {r["pickup_location_id"] for r in got.collect()} == {42}
    assert sorted((r["passenger_count"] for r in got.collect() if r["year"] == 2009),
                  key=lambda v: -1 if v is None else v) == [None, 1, 2]   # 'x' is not a number


def test_tree_load_refuses_a_table_of_another_layout(spark):
    import pytest
    from ridelake.sources.lake import check_layout, loaded_files
    missing = work_path(spark, "no-such-table")
    check_layout(spark, missing)
    assert loaded_files(spark, missing).count() == 0
    other = work_path(spark, "flat-table")
    spark.createDataFrame([("yellow", 2021, 1, 1.0)], "vtype string, year int, month int, x double") \
        .write.partitionBy("vtype", "year", "month").parquet(other)
    with pytest.raises(ValueError):
        check_layout(spark, other)


def test_tree_month_with_every_row_rejected_is_loaded_once(spark):
    from ridelake.plans.silver import load_bronze_tree
    g = grid(spark).checkpoint()
    root, silver = work_path(spark, "rej-bronze"), work_path(spark, "rej-silver")
    # drop-off before pickup: the quality filter rejects the only ride
    spark.createDataFrame([(datetime(2021, 3, 2, 9), datetime(2021, 3, 2, 8), -73.995, 40.605, 5.0, 6.0)],
                          "tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
                          "pickup_longitude double, pickup_latitude double, fare_amount double, "
                          "total_amount double") \
        .write.parquet(f"{root}/vtype=yellow/year=2021/month=03")
    assert load_bronze_tree(spark, root, g, silver) == 1
    assert load_bronze_tree(spark, root, g, silver) == 0
    # a normal month arrives
    month_file(spark, 4).drop("vtype", "_file_ts").write.parquet(f"{root}/vtype=yellow/year=2021/month=04")
    assert load_bronze_tree(spark, root, g, silver) == 1
    assert spark.read.parquet(silver).count() == 3


def test_tree_arrival_order_does_not_matter(spark):
    from ridelake.plans.silver import load_bronze_tree
    g = grid(spark).checkpoint()

    def put(root, m):   # month m's file, holding one ride of month m + 1
        month_file(spark, m, stray=True).drop("vtype", "_file_ts") \
            .write.parquet(f"{root}/vtype=yellow/year=2021/month={m:02d}")

    tables = []
    for order in ([1, 2, 3], [3, 1, 2], [2, 3, 1]):
        root, silver = work_path(spark, "ord-bronze"), work_path(spark, "ord-silver")
        for m in order:
            put(root, m)
            assert load_bronze_tree(spark, root, g, silver) == 1
        assert load_bronze_tree(spark, root, g, silver) == 0
        tables.append(read_sorted(spark, silver))
    assert tables[0] == tables[1] == tables[2]
    assert len(tables[0]) == 12 and sum(1 for r in tables[0] if r[4] == 4) == 1


def put(spark, root, month, days, part="a", hour=8, fee=None, stray=0):
    """One file of a month with a ride per day (and one per stray in the next month); ``fee`` adds a column."""
    rows = [(datetime(2021, month, d, hour), datetime(2021, month, d, hour, 30), -73.995, 40.605, 5.0, float(d)) for d in days]
    rows += [(datetime(2021, month + 1, d + 1, hour), datetime(2021, month + 1, d + 1, hour, 30), -73.995, 40.605, 5.0, 50.0 + d) for d in range(stray)]
    df = spark.createDataFrame(rows, "tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
                                     "pickup_longitude double, pickup_latitude double, fare_amount double, total_amount double")
    if fee is not None:
        from pyspark.sql import functions as F
        df = df.withColumn("congestion_surcharge", F.lit(fee))
    df.coalesce(1).write.mode("append").parquet(f"{root}/vtype=yellow/year=2021/month={month:02d}")


def totals(spark, path):
    return sorted((r["month"], r["total_amount"]) for r in spark.read.parquet(path).collect())


def test_tree_file_arriving_late_in_a_loaded_month(spark):
    from ridelake.plans.silver import load_bronze_tree
    g = grid(spark).checkpoint()
    root, silver = work_path(spark, "late-bronze"), work_path(spark, "late-silver")
    put(spark, root, 1, [1], stray=1)
    assert load_bronze_tree(spark, root, g, silver) == 1
    put(spark, root, 1, [2, 3])
    put(spark, root, 2, [9])
    assert load_bronze_tree(spark, root, g, silver) == 2
    assert load_bronze_tree(spark, root, g, silver) == 0
    assert totals(spark, silver) == [(1, 1.0), (1, 2.0), (1, 3.0), (2, 9.0), (2, 50.0)]


def test_tree_commit_that_stopped_half_way_is_done_again(spark):
    from pyspark.sql import functions as F
    from ridelake.plans.silver import load_bronze_tree
    g = grid(spark).checkpoint()
    root, silver, whole = (work_path(spark, n) for n in ("half-bronze", "half-silver", "half-whole"))
    put(spark, root, 1, [1, 2], stray=1)
    assert load_bronze_tree(spark, root, g, whole) == 1
    # only the January folder of the source was moved into place, and no ledger was written
    (spark.read.parquet(whole).where(F.col("month") == 1).write.partitionBy("vtype", "year", "month", "source_month").parquet(silver))
    assert load_bronze_tree(spark, root, g, silver) == 1
    assert totals(spark, silver) == totals(spark, whole) == [(1, 1.0), (1, 2.0), (2, 50.0)]


def test_tree_file_that_is_rewritten_leaves_no_stale_month(spark):
    from ridelake.plans.silver import load_bronze_tree
    g = grid(spark).checkpoint()
    root, silver = work_path(spark, "rw-bronze"), work_path(spark, "rw-silver")
    put(spark, root, 1, [1], stray=2)
    put(spark, root, 2, [4])
    assert load_bronze_tree(spark, root, g, silver) == 2
    spark.createDataFrame([(datetime(2021, 1, 7, 8), datetime(2021, 1, 7, 9), -73.995, 40.605, 5.0, 7.0)],
                          "tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, pickup_longitude double, "
                          "pickup_latitude double, fare_amount double, total_amount double") \
        .write.mode("overwrite").parquet(f"{root}/vtype=yellow/year=2021/month=01")
    assert load_bronze_tree(spark, root, g, silver) == 1
    assert totals(spark, silver) == [(1, 7.0), (2, 4.0)]


def test_number_of_jobs_does_not_grow_with_the_files(spark):
    from ridelake.plans.silver import read_by_schema
    from ridelake.sources.lake import parquet_files
    from test_plans import jobs_of
    few, many = work_path(spark, "few"), work_path(spark, "many")
    put(spark, few, 1, [1])
    put(spark, few, 2, [1], fee=1.0)
    for m in range(1, 7):
        for d in (1, 2):
            put(spark, many, m, [d], fee=1.0 if m > 3 else None)
    n = [jobs_of(spark, lambda r=r: read_by_schema(spark, r, parquet_files(spark, r))) for r in (few, many)]
    assert n[1] <= n[0]


def test_stream_reads_each_file_by_its_own_schema(spark):
    g = grid(spark).checkpoint()
    root, silver, ckpt = (work_path(spark, n) for n in ("drift-bronze", "drift-silver", "drift-ckpt"))
    put(spark, root, 1, [1])
    put(spark, root, 2, [2], fee=2.5)
    assert incremental_load(spark, [root], g, silver, ckpt) == 1
    put(spark, root, 1, [3], fee=1.5)
    assert incremental_load(spark, [root], g, silver, ckpt) == 1
    got = sorted((r["total_amount"], r["congestion_surcharge"]) for r in spark.read.parquet(silver).collect())
    assert got == [(1.0, None), (2.0, 2.5), (3.0, 1.5)]


def write_lake_changes(spark, root):
    """Deliveries that a stream's own memory loses: (what to do, number of sources that change)."""
    from ridelake.sources import files, lake

    def first():
        put(spark, root, 1, [1, 2], stray=1)
        put(spark, root, 2, [9])

    def old():         # a file much older than those already loaded, in a loaded month and in a new one
        before = files.matching(spark, f"{root}/*/*/*/*.parquet")
        put(spark, root, 1, [3])
        put(spark, root, 3, [4])
        files.redate(spark, [p for p in files.matching(spark, f"{root}/*/*/*/*.parquet") if p not in before], 1_000_000_000)

    def rewritten():   # other content under the same name
        (name,) = files.matching(spark, f"{root}/vtype=yellow/year=2021/month=02/*.parquet")
        put(spark, root, 2, [9, 10, 11])
        other = next(p for p in files.matching(spark, f"{root}/vtype=yellow/year=2021/month=02/*.parquet") if p != name)
        files.remove(spark, name)
        files.move(spark, other, name)

    def deleted():     # the file with the stray ride, and a whole month
        paths = [r["path"] for r in lake.parquet_files(spark, root).where("month = 1").orderBy("modificationTime").collect()]
        files.remove(spark, paths[-1])
        files.remove(spark, f"{root}/vtype=yellow/year=2021/month=03")

    return [(first, 2), (old, 2), (rewritten, 1), (deleted, 2)]


def test_stream_and_tree_end_in_the_same_table_whatever_happens_to_the_files(spark):
    from ridelake.plans.silver import load_bronze_tree
    g = grid(spark).checkpoint()
    root, silver, tree, ckpt = (work_path(spark, n) for n in ("any-bronze", "any-silver", "any-tree", "any-ckpt"))
    for change, n in write_lake_changes(spark, root):
        change()
        assert incremental_load(spark, [root], g, silver, ckpt) == 1
        assert load_bronze_tree(spark, root, g, tree) == n
        whole = work_path(spark, "any-whole")
        load_bronze_tree(spark, root, g, whole)
        assert totals(spark, silver) == totals(spark, tree) == totals(spark, whole), change.__name__
    assert incremental_load(spark, [root], g, silver, ckpt) == 0 and load_bronze_tree(spark, root, g, tree) == 0
    assert totals(spark, silver) == [(1, 3.0), (2, 9.0), (2, 10.0), (2, 11.0)]


def test_a_batch_that_failed_is_done_by_the_next_load(spark, monkeypatch):
    import pytest
    from pyspark.errors import StreamingQueryException

    from ridelake.streaming import incremental as I
    g = grid(spark).checkpoint()
    root, silver, ckpt = (work_path(spark, n) for n in ("fail-bronze", "fail-silver", "fail-ckpt"))
    put(spark, root, 1, [1], stray=1)
    done = I.replace_sources

    def stops(*args):       # after the write, before the batch counts as done
        done(*args)
        raise RuntimeError("lost")

    monkeypatch.setattr(I, "replace_sources", stops)
    with pytest.raises(StreamingQueryException):
        incremental_load(spark, [root], g, silver, ckpt)
    monkeypatch.setattr(I, "replace_sources", done)
    put(spark, root, 1, [2])
    assert incremental_load(spark, [root], g, silver, ckpt) >= 1
    assert totals(spark, silver) == [(1, 1.0), (1, 2.0), (2, 50.0)]


def test_compaction_keeps_rows_and_replacement_by_source(spark, monkeypatch):
    import pytest

    from ridelake.plans import silver as SV
    from ridelake.sources.lake import parquet_files
    g = grid(spark).checkpoint()
    root, silver = work_path(spark, "cp-bronze"), work_path(spark, "cp-silver")
    for d in (1, 2, 3):
        put(spark, root, 1, [d], stray=d % 2)
    put(spark, root, 2, [9])
    assert SV.load_bronze_tree(spark, root, g, silver) == 2
    # many small files, as a load with more tasks leaves them
    spark.read.parquet(silver).where(f"{SOURCE_COL} = '2021-01'").repartition(7).write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy("vtype", "year", "month", SOURCE_COL).parquet(silver)
    want = totals(spark, silver)
    files_in = lambda: {r[0]: r[1] for r in parquet_files(spark, silver).groupBy(SOURCE_COL).count().collect()}      # noqa: E731
    assert files_in()["2021-01"] > 2

    done = SV.write_silver
    monkeypatch.setattr(SV, "write_silver", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        SV.compact_silver(spark, silver)
    monkeypatch.setattr(SV, "write_silver", done)
    assert SV.load_bronze_tree(spark, root, g, silver) == 1          # the source is built again
    assert totals(spark, silver) == want

    spark.read.parquet(silver).where(f"{SOURCE_COL} = '2021-01'").repartition(7).write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy("vtype", "year", "month", SOURCE_COL).parquet(silver)
    assert SV.compact_silver(spark, silver) >= 1 and SV.compact_silver(spark, silver) == 0
    assert files_in() == {"2021-01": 2, "2021-02": 1} and totals(spark, silver) == want
    assert SV.load_bronze_tree(spark, root, g, silver) == 0
    put(spark, root, 1, [4])
    assert SV.load_bronze_tree(spark, root, g, silver) == 1
    assert totals(spark, silver) == sorted([*want, (1, 4.0)])


def test_rows_that_are_not_clustered_by_month_leave_one_file_a_folder(spark):
    """Bronze and silver files grow with bytes, not with tasks times folders."""
    from pyspark.sql import functions as F
    from ridelake.plans.silver import replace_sources
    from ridelake.sources.lake import parquet_files
    month = (F.col("id") % 6 + 1).cast("int")
    ts = F.make_timestamp_ntz(F.lit(2021), month, F.lit(15), F.lit(8), F.lit(0), F.lit(0))
    raw = spark.range(240, numPartitions=8).select(
        F.lit("yellow").alias("vtype"), ts.alias("_file_ts"), ts.alias("tpep_pickup_datetime"), ts.alias("tpep_dropoff_datetime"),
        F.lit(-73.995).alias("pickup_longitude"), F.lit(40.605).alias("pickup_latitude"), F.lit(1.0).alias("fare_amount"), F.lit(2.0).alias("total_amount"))
    [era] = write_bronze([raw], work_path(spark, "dealt-bronze"))
    assert parquet_files(spark, era).count() == 6 and spark.read.parquet(era).count() == 240
    silver = work_path(spark, "dealt-silver")
    unclustered = spark.read.parquet(era).repartition(8)
    replace_sources(spark, silver, [("yellow", f"2021-{m:02d}") for m in range(1, 7)], silver_trips_by_source([unclustered], grid(spark)))
    assert parquet_files(spark, silver).count() == 6 and spark.read.parquet(silver).count() == 240


def test_shuffle_files_of_finished_jobs_are_removed(spark):
    import time

    from ridelake.session import release_shuffles

    def shuffle_files():
        kept = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
        return {f.rpartition("/")[2] for f in kept.split("\n") if "shuffle_" in f and f.endswith(".data")}

    before = shuffle_files()
    spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count().write.parquet(work_path(spark, "released"))
    mine, until = shuffle_files() - before, time.time() + 20
    assert mine
    release_shuffles(spark)
    while mine & shuffle_files() and time.time() < until:
        time.sleep(0.2)
    assert not mine & shuffle_files()


def test_two_deliveries_hold_every_row_once(spark):
    """Rows dealt as the base's narrow ones and written once for both deliveries are the rows of the eras."""
    from ridelake import queries as Q
    from ridelake.sources.fixtures import Fixtures
    from ridelake.sources.lake import parquet_files
    fx = Fixtures(spark, "/root/testdata/sf0.001")
    aside, root = Q._deliveries(fx), work_path(spark, "dl-tree")
    plain = [e.withColumns({"year": F.year("_file_ts"), "month": F.month("_file_ts")}).drop("_file_ts") for e in fx.raw_eras(keep_file_month=True)]
    held = lambda frames: sum((f.agg(F.coalesce(F.sum(F.xxhash64(*sorted(f.columns)).cast("decimal(38,0)")), F.lit(0))).first()[0] for f in frames))     # noqa: E731
    early = [e.where(F.pmod(F.xxhash64(*e.columns), F.lit(3)) != 0) for e in plain]
    for late, want in ((False, early), (True, plain)):
        Q._deliver(fx, aside, late, root)
        here = read_by_schema_of(spark, root)
        assert sum(f.count() for f in here) == sum(f.count() for f in want) and held(here) == held(want)
    assert parquet_files(spark, aside).count() == 0
    # the tables are read once an era, and rows are dealt before they grow to the era's columns
    for era in fx.raw_eras(keep_file_month=True, dealt=True):
        text = era._jdf.queryExecution().optimizedPlan().toString()
        assert text.index("RebalancePartitions") > text.index("Project") and "pux" not in text[text.index("RebalancePartitions"):]


def read_by_schema_of(spark, root):
    from ridelake.plans.silver import read_by_schema
    from ridelake.sources.lake import parquet_files
    return read_by_schema(spark, root, parquet_files(spark, root))


def test_loads_go_through_the_sources_in_portions(spark, monkeypatch):
    """However long the history is, one plan reads ``LOAD_BYTES`` of it; what is committed stays when a later portion fails."""
    import pytest

    from ridelake.plans import silver as SV
    from ridelake.sources.lake import loaded_files
    from ridelake.streaming import incremental as I
    g = grid(spark).checkpoint()
    root = work_path(spark, "pt-bronze")
    for month in (1, 2, 3):
        put(spark, root, month, [3, 4], stray=True)
    whole, silver, stream = (work_path(spark, f"pt-{n}") for n in ("whole", "silver", "stream"))
    assert SV.load_bronze_tree(spark, root, g, whole) == 3
    monkeypatch.setattr(SV, "LOAD_BYTES", 1)
    written, real = [], SV.replace_sources

    def replace(spark, path, sources, rows):
        if len(written) == 2 and path == silver:
            written.append("lost")
            raise RuntimeError("lost")
        real(spark, path, sources, rows)
        written.append(sources)

    monkeypatch.setattr(SV, "replace_sources", replace)
    monkeypatch.setattr(I, "replace_sources", replace)
    with pytest.raises(RuntimeError):
        SV.load_bronze_tree(spark, root, g, silver)
    assert written == [[("yellow", "2021-01")], [("yellow", "2021-02")], "lost"] and loaded_files(spark, silver).count() == 2
    assert SV.load_bronze_tree(spark, root, g, silver) == 1 and SV.load_bronze_tree(spark, root, g, silver) == 0
    assert totals(spark, silver) == totals(spark, whole)
    written.clear()
    assert incremental_load(spark, [root], g, stream, work_path(spark, "pt-ckpt")) == 1
    assert written == [[("yellow", f"2021-{m:02d}.era1")] for m in (1, 2, 3)] and totals(spark, stream) == totals(spark, whole)


def test_rows_are_added_to_a_written_table(spark):
    g = grid(spark).checkpoint()
    silver = work_path(spark, "added")
    for mode in ("overwrite", "append"):
        [era] = write_bronze([month_file(spark, 3)], work_path(spark, "added-bronze"))
        write_silver(silver_trips_by_source([spark.read.parquet(era)], g), silver, rebalance=True, mode=mode)
    assert spark.read.parquet(silver).count() == 6
