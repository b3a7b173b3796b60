"""Purging stored tables, and runs found by their folders."""

import os

from pyspark.sql import functions as F

from milepost.plans import daily, pipeline, purge, store, tables
from milepost.session import scratch_dir
from milepost.sources import runs


def filled(spark, bed):
    house = pipeline.Warehouse(scratch_dir(spark, "warehouse"))
    tables.write_table(bed.driver, house.driver)
    tables.write_table(bed.driver_score, house.driver_score)
    tables.write_table(daily.with_end_day(bed.trip_score), house.trip_score)
    trip = bed.trip_score.select("trip_id")
    for k, table in enumerate(house.points):
        points = trip.select(
            "trip_id", F.lit(1).cast("long").alias("account_id"),
            (F.lit(1_700_000_000_000) + F.pmod(F.xxhash64("trip_id"), F.lit(90)) * 86_400_000).alias("timestamp_ms"),
            F.lit(1.0).alias("latitude"), F.lit(2.0).alias("longitude"), *([F.lit("N").alias("incident_type")] if k else []),
        )
        tables.write_table(daily.with_point_month(points), table)
    return house


def lines(done):
    return {r["table_name"]: (r["rows_removed"], r["rows_left"], r["partitions_written"]) for r in done.counts.collect()}


def test_purge_follows_the_links(spark, bed):
    house = filled(spark, bed)
    some = [r[0] for r in bed.trip_score.groupBy("driver_id").count().orderBy("count", "driver_id").select("driver_id").limit(2).collect()]
    gone = spark.createDataFrame([(d, 1) for d in [*some, None, "nobody", some[0]]], "driver_id string, more int")
    trips = tables.read_table(spark, house.trip_score.path)
    lost = {r[0] for r in trips.filter(F.col("driver_id").isin(some)).select("trip_id").collect()}
    before = store.latest(spark, house.trip_score.path).folders
    args = (house.driver, house.driver_score, house.trip_score, house.points)
    done = purge.purge_drivers(spark, gone, *args)
    got = lines(done)
    assert got["trip_score"][0] == got["trip_location"][0] == got["trip_incident"][0] == len(lost) > 0
    assert got["driver"][0] == bed.driver.filter(F.col("driver_id").isin(some)).count()
    left = tables.read_table(spark, house.trip_score.path)
    assert left.filter(F.col("driver_id").isin(some)).count() == 0 and left.count() == trips.count() - len(lost)
    for table in house.points:
        ids = {r[0] for r in tables.read_table(spark, table.path).select("trip_id").collect()}
        assert not ids & lost and ids
    after = store.latest(spark, house.trip_score.path).folders
    days = {r[0] for r in trips.filter(F.col("driver_id").isin(some)).select(F.col("end_day").cast("string")).collect()}
    assert {d for d in before if before[d] != after.get(d)} == days
    assert done.trips.changes.agg(F.sum("_sign")).first()[0] == -len(lost)
    # again: nothing to do, nothing written
    again = purge.purge_drivers(spark, gone, *args)
    assert set(lines(again).values()) == {(0, 0, 0)} and again.trips is None
    assert store.latest(spark, house.trip_score.path).folders == after


def test_purge_that_broke_off_is_finished(spark, bed, monkeypatch):
    """The points went, the trips did not: a second run finds the rest by the links that are still there."""
    house = filled(spark, bed)
    some = bed.trip_score.select("driver_id").distinct().orderBy("driver_id").limit(3)
    real = purge.remove_keys

    def broken(spark_, table, *rest):
        if table.name == "trip_score":
            raise RuntimeError("lost")
        return real(spark_, table, *rest)

    args = (house.driver, house.driver_score, house.trip_score, house.points)
    monkeypatch.setattr(purge, "remove_keys", broken)
    try:
        purge.purge_drivers(spark, some, *args)
        raise AssertionError
    except RuntimeError:
        pass
    monkeypatch.setattr(purge, "remove_keys", real)
    got = lines(purge.purge_drivers(spark, some, *args))
    assert got["trip_location"][0] == 0 and got["trip_score"][0] > 0
    for table in (house.driver, house.driver_score, house.trip_score):
        assert tables.read_table(spark, table.path).join(some, "driver_id", "left_semi").count() == 0


def test_empty_warehouse(spark):
    house = pipeline.Warehouse(scratch_dir(spark, "empty"))
    gone = spark.createDataFrame([("a",)], "driver_id string")
    done = purge.purge_drivers(spark, gone, house.driver, house.driver_score, house.trip_score, house.points)
    assert done.trips is None and {v[0] for v in lines(done).values()} == {0}


def test_latest_runs_by_folder(spark):
    """Only the latest folders are scanned; an empty run is passed over; names may hold odd characters."""
    root = scratch_dir(spark, "runs").removeprefix("file:")
    rows = [("1", "2024-01-01_00:00", 1), ("1", "2024-01-02_00:00", 2), ("2", "b%20", 3), ("2", "a/b", 4), (None, "z", 5)]
    schema = "fleet_id string, run_ts string, v long"
    spark.createDataFrame(rows, schema).write.partitionBy("fleet_id", "run_ts").json(root)
    empty = f"{root}/fleet_id=1/run_ts=2024-01-03_00%3A00"
    os.makedirs(empty)
    open(f"{empty}/_SUCCESS", "w").close()
    got = runs.read_latest_run(spark, root, schema)
    assert sorted(((r.fleet_id, r.run_ts, r.v) for r in got.collect()), key=repr) == sorted(
        [("1", "2024-01-02_00:00", 2), ("2", "b%20", 3), (None, "z", 5)], key=repr
    )
    assert len(got.inputFiles()) == 3
    assert runs.read_latest_run(spark, f"{root}/nothing", "v long").columns == ["v", "fleet_id", "run_ts"]
