import os
from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from milepost.operators import conform
from milepost.plans import pipeline, tables
from milepost.schemas import ROLLUP_KEYS
from milepost.session import scratch_dir
from testbed.pipeline_queries import WINDOW, inputs

RUN_AT = datetime(2024, 2, 1)


@pytest.fixture(scope="module")
def run_inputs(bed):
    return inputs(bed)


def run(spark, run_inputs, warehouse, **options):
    report = pipeline.run_daily(
        spark, *run_inputs, warehouse, WINDOW, RUN_AT, F.lit(999), **options
    )
    lines = {r["entity"]: r for r in report.frame(spark).collect()}
    for entity, total, resolved, *others in report.conversions:
        assert total == resolved + sum(others) and min(others) >= 0, report.conversions
        # repeated scores and trips are kept as rejects, repeated fleets, drivers and points are not
        assert lines[entity]["rejected_rows"] in (sum(others), sum(others[:2])), report.conversions
    return lines


def test_second_run_changes_no_business_rows(spark, run_inputs):
    warehouse = pipeline.Warehouse(scratch_dir(spark, "warehouse"))
    first = run(spark, run_inputs, warehouse)
    assert {r["status"] for r in first.values()} == {"ok"}
    assert tables.read_watermark(spark, warehouse.path("watermark"), "daily") == RUN_AT
    rollup = tables.read_table(spark, warehouse.path("rollups/trip_day_rollup"))
    trips = rollup.agg(F.sum("trip_count")).first()[0]
    second = run(spark, run_inputs, warehouse)
    for entity in ("drivers", "driver_scores", "trip_scores"):
        assert first[entity]["rows_inserted"] == second[entity]["rows_skipped"] > 0
        assert second[entity]["rows_inserted"] == second[entity]["rows_updated"] == 0
    assert second["trip_location"]["rows_updated"] == first["trip_location"]["rows_inserted"]
    again = tables.read_table(spark, warehouse.path("rollups/trip_day_rollup"))
    assert again.agg(F.sum("trip_count")).first()[0] == trips
    rejects_and_scratch(spark, warehouse, first)
    dimensions_move_rollups(spark, run_inputs, warehouse)


def rejects_and_scratch(spark, warehouse, lines):
    stored = pipeline.read_rejects(spark, warehouse).groupBy("entity").count().collect()
    want = {e: r["rejected_rows"] for e, r in lines.items() if e not in ("discovery", "rollups") and r["rejected_rows"]}
    assert {r["entity"]: r["count"] for r in stored} == want
    root = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    assert not [d for d in os.listdir(root) if d.startswith("run-daily") and len(os.listdir(f"{root}/{d}")) == 0]


def dimensions_move_rollups(spark, run_inputs, warehouse):
    """Users and subscriptions change, no trip lands: the rollups equal a full rebuild."""
    landed, directory = run_inputs
    changed = replace(
        directory,
        users=directory.users.withColumn("email", F.concat(F.lit("new-"), "email")),
        company_subscriptions=directory.company_subscriptions.filter("company_id % 3 <> 0"),
    )
    quiet = replace(landed, trip_scores=landed.trip_scores.limit(0), driver_scores=landed.driver_scores.limit(0))
    run(spark, (quiet, changed), warehouse)
    fresh = scratch_dir(spark, "fresh")
    tables.refresh_rollups(
        conform.derive_trip_times(tables.read_table(spark, warehouse.trip_score.path)), changed.subscriptions,
        changed.company_subscriptions, changed.companies, tables.read_table(spark, warehouse.driver.path),
        changed.users, fresh,
    )
    for name in ROLLUP_KEYS:
        a, b = tables.read_table(spark, warehouse.path(f"rollups/{name}")), tables.read_table(spark, f"{fresh}/{name}")
        assert a.count() == b.count() > 0 and a.exceptAll(b).count() == 0, name


def test_dry_run_stores_nothing(spark, run_inputs):
    warehouse = pipeline.Warehouse(scratch_dir(spark, "dry"))
    got = run(spark, run_inputs, warehouse, dry_run=True)
    assert got["drivers"]["rows_inserted"] > 0 and got["trip_scores"]["rows_inserted"] > 0
    assert "rollups" not in got
    for name in ("fleet", "driver", "trip_score", "trip_location", "watermark"):
        assert tables.read_table(spark, warehouse.path(name)) is None


def test_dry_run_counts_are_those_of_the_real_run(spark, run_inputs):
    """Half of the trips and drivers first, so that the second run meets a filled warehouse."""
    landed, directory = run_inputs
    half = replace(
        landed, drivers=landed.drivers.filter("pmod(xxhash64(accountId), 2) = 0"),
        trip_scores=landed.trip_scores.filter("position % 2 = 0"),
    )
    warehouse = pipeline.Warehouse(scratch_dir(spark, "half"))
    run(spark, (half, directory), warehouse)
    later = replace(landed, drivers=landed.drivers.filter("pmod(xxhash64(accountId), 2) = 1"))
    dry = run(spark, (later, directory), warehouse, dry_run=True)
    real = run(spark, (later, directory), warehouse)
    counts = ("status", "rows_inserted", "rows_updated", "rows_skipped", "rejected_rows")
    for entity, line in dry.items():
        assert [line[c] for c in counts] == [real[entity][c] for c in counts], entity
    assert dry["trip_scores"]["rows_inserted"] > 0


def test_failed_drivers_skip_scores_but_not_points(spark, run_inputs, monkeypatch):
    def broken(*_):
        raise AnalysisException("no drivers today")

    real = pipeline.merge

    def merge(spark_, table, *args, **options):
        if table.name == "driver":
            broken()
        return real(spark_, table, *args, **options)

    monkeypatch.setattr(pipeline, "merge", merge)
    warehouse = pipeline.Warehouse(scratch_dir(spark, "broken"))
    got = run(spark, run_inputs, warehouse)
    assert got["drivers"]["status"] == "error" and "no drivers" in got["drivers"]["message"]
    assert got["trip_scores"]["status"] == got["driver_scores"]["status"] == "skipped"
    assert got["trip_location"]["status"] == "ok"
    assert tables.read_watermark(spark, warehouse.path("watermark"), "daily") is None


def test_partial_refresh_drops_emptied_days(spark, bed):
    out = scratch_dir(spark, "rollups")
    sides = (bed.subscription, bed.company_subscription, bed.company, bed.driver, bed.app_user)
    tables.refresh_rollups(bed.trip_score, *sides, out)
    path = f"{out}/trip_day_rollup"
    days = sorted(r[0] for r in tables.read_table(spark, path).select("reporting_day").distinct().collect())
    gone, kept = days[0], days[1]
    rest = bed.trip_score.filter(F.col("end_date_datetime").cast("date") != F.lit(gone))
    tables.refresh_rollups(rest, *sides, out, days=[gone, kept])
    for name in ("trip_day_rollup", "driver_trip_list", "trip_event_groups"):
        left = tables.read_table(spark, f"{out}/{name}").select("reporting_day").distinct().collect()
        assert sorted(r[0] for r in left) == days[1:], name
