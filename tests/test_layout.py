"""The stored trip list is laid out for drill-downs."""

import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from milepost.operators import rollups
from milepost.plans import serving, store, tables
from milepost.session import scratch_dir


def test_drill_down_skips_other_drivers(spark, bed):
    """Files are in the order of company and driver, and the filters reach their scan."""
    out = scratch_dir(spark, "rollups")
    eligible = rollups.eligible_companies(bed.subscription, bed.company_subscription)
    listed = rollups.driver_trip_list(bed.trip_score, eligible, bed.driver, bed.app_user)
    tables.store_trip_list(listed, out, None)
    folders = store.latest(spark, f"{out}/driver_trip_list").folders
    for folder in folders.values():
        for path in glob.glob(f"{folder.removeprefix('file:')}/*.parquet"):
            rows = pq.read_table(path, columns=["company_id", "driver_id", "end_date_datetime"]).to_pylist()
            keys = [(r["company_id"], r["driver_id"]) for r in rows]
            assert keys == sorted(keys) and rows
            ends = [r["end_date_datetime"] for r in rows]
            assert all(a >= b for a, b, k, m in zip(ends, ends[1:], keys, keys[1:]) if k == m)
    busy = listed.groupBy("company_id", "driver_id").count().orderBy(F.desc("count"), "driver_id").first()
    days = sorted(folders)
    got = serving.stored_recent_trips(spark, out, busy.company_id, busy.driver_id, days[1], days[-2])
    want = listed.filter((F.col("company_id") == busy.company_id) & (F.col("driver_id") == busy.driver_id)).filter(
        F.col("end_date_datetime").cast("date").cast("string").between(days[1], days[-2])
    )
    assert [r.trip_id for r in got.collect()] == [
        r.trip_id for r in want.orderBy(F.desc("end_date_datetime"), "trip_id").collect()
    ]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert f"EqualTo(driver_id,{busy.driver_id})" in plan and f"EqualTo(company_id,{busy.company_id})" in plan
    read = {os.path.dirname(f).rpartition("_part=")[2] for f in got.inputFiles()}
    assert len(read) == len(days) - 2


def test_sorted_files_hold_narrow_pages(spark, tmp_path):
    """What the order is for: with many drivers, a filter on one reads a small share of the rows."""
    out = str(tmp_path / "list")
    rows = spark.range(60_000).select(
        F.lit(1).alias("company_id"), F.concat(F.lit("D"), F.pmod(F.xxhash64("id"), F.lit(500))).alias("driver_id"),
        F.expr("timestampadd(SECOND, cast(id % 3600 AS int), TIMESTAMP_NTZ'2024-01-01')").alias("end_date_datetime"),
    )
    spark.conf.set("parquet.block.size", str(64 << 10))
    try:
        tables.store_trip_list(rows, out, None)
    finally:
        spark.conf.unset("parquet.block.size")
    groups = hit = 0
    for path in glob.glob(f"{out}/driver_trip_list/data/*/*/*.parquet"):
        meta = pq.ParquetFile(path).metadata
        column = meta.schema.names.index("driver_id")
        for k in range(meta.num_row_groups):
            statistics = meta.row_group(k).column(column).statistics
            groups += 1
            hit += statistics.min <= "D77" <= statistics.max
    assert groups > 5 and hit <= 2


def scan_rows(df):
    """Rows of a DataFrame, and how many its scan of Parquet files gave to get them."""
    found = df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    scans = [leaves.apply(k) for k in range(leaves.size())]
    return found, sum(s.metrics().apply("numOutputRows").value() for s in scans if "parquet" in s.nodeName())


@pytest.fixture
def moving(spark, tmp_path):
    """100,000 rows by day in many row groups; keys say nothing about the day."""
    table = tables.StoredTable("t", str(tmp_path / "t"), ["k"], ["v", "day"], partition="day")
    rows = spark.range(100_000).select(
        F.sha1(F.col("id").cast("string")).alias("k"), F.col("id").alias("v"),
        F.concat(F.lit("d"), F.floor(F.col("id") / 2_500)).alias("day"),
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("parquet.block.size", str(64 << 10))
    try:
        tables.write_table(rows, table)
        yield table, rows
    finally:
        spark.conf.unset("parquet.block.size")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("batch", ["v BETWEEN 40000 AND 40099", "v % 50000 = 77"])
def test_small_batch_skips_row_groups(spark, moving, batch):
    """A batch of a thousandth, or of rows anywhere, reads a small share of the stored keys."""
    table, rows = moving
    change = rows.filter(batch)
    target = tables.read_table(spark, table.path)
    found, read = scan_rows(tables.held_rows(table, target, change))
    assert sorted(r.k for r in found) == sorted(r.k for r in change.collect())
    assert read < 5_000
    assert scan_rows(tables.held_rows(table, target, change, pushed=1))[1] == 100_000


def test_large_batch_and_odd_keys(spark, moving):
    table, rows = moving
    target = tables.read_table(spark, table.path)
    large = rows.filter("v < 12000")
    assert tables.held_rows(table, target, large).count() == 12_000
    odd = spark.createDataFrame([(None, 1, "d1"), ("", 2, "d1"), ("no such key", 3, "d1")], "k string, v long, day string")
    assert tables.held_rows(table, target, odd).count() == 0
    assert tables.held_rows(table, target, odd.filter("false")).count() == 0


def test_keys_of_several_columns(spark, tmp_path):
    """Each column's values are filtered, the pairs are matched by the join; doubles aren't filtered."""
    table = tables.StoredTable("t", str(tmp_path / "pairs"), ["a", "b", "c"], ["day"], partition="day")
    rows = [("x", 1, 0.5, "d1"), ("x", 2, 0.5, "d2"), ("y", 1, 0.5, "d3"), ("y", 2, float("nan"), "d4"), (None, 1, 0.5, "d5")]
    df = spark.createDataFrame(rows, "a string, b int, c double, day string")
    tables.write_table(df, table)
    target = tables.read_table(spark, table.path)
    want = df.filter("day IN ('d1', 'd4', 'd5')").withColumn("day", F.lit("d9"))
    assert sorted(r.day for r in tables.held_rows(table, target, want).collect()) == ["d1", "d4"]
    assert sorted(tables.touched_partitions(table, target, want)) == ["d1", "d4", "d9"]


def job_tasks(spark, group):
    """Tasks of the stages that ran in a job group."""
    tracker = spark.sparkContext.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}
    return [i.numTasks for i in map(tracker.getStageInfo, stages) if i is not None and i.numCompletedTasks]


def test_many_folders_are_listed_by_few_tasks(spark, tmp_path):
    """Reading a version of many days lists several folders in a task."""
    rows = spark.range(3_000).select(F.col("id").alias("v"), F.concat(F.lit("d"), F.col("id") % 150).alias("day"))
    table = tables.StoredTable("t", str(tmp_path / "t"), ["v"], ["day"], partition="day")
    tables.write_table(rows, table)
    version = store.latest(spark, table.path)
    spark.sparkContext.setJobGroup("listing", "listing")
    try:
        found = store.read_version(spark, version)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(version.folders) == 150 and found.exceptAll(rows).count() == 0 and found.count() == 3_000
    assert job_tasks(spark, "listing") == [64]


def test_group_rollups_read_many_small_files_in_few_tasks(spark, bed, tmp_path):
    """The tasks that read a stored day rollup follow its bytes, not its days."""
    combined = rollups.trip_event_day_rollup(
        bed.trip_score, rollups.eligible_companies(bed.subscription, bed.company_subscription), bed.company, bed.driver,
        bed.app_user, with_bucket=True,
    )
    far = combined.withColumn("reporting_day", F.expr("date_add(reporting_day, cast(driver_account_id % 8 * 30 AS int))"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16m")
    spark.sparkContext.setJobGroup("groups", "groups")
    try:
        stored = tables.store_day_rollups(far, str(tmp_path / "rollups"), None)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    days = far.select("reporting_day").distinct().count()
    assert days > 100 and max(n for n in job_tasks(spark, "groups") if n != 64) < days / 8
    assert spark.conf.get("spark.sql.files.openCostInBytes").startswith("4194304")
    want = rollups.trip_event_groups(rollups.split_day_rollups(far)[1])
    assert want.exceptAll(stored["trip_event_groups"].select(*want.columns)).count() == 0
    assert stored["trip_event_groups"].count() == want.count()
