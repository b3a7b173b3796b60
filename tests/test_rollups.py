import pytest
from pyspark.sql import functions as F

from milepost.functions.measures import epoch_ms_to_timestamp
from milepost.operators import rollups
from milepost.schemas import METRICS
from testbed import rollup_queries as rq


@pytest.fixture()
def tables(spark):
    trips = spark.createDataFrame(
        [("a", "D1", None, 95.0), ("b", "D1", None, 95.0), ("c", "D2", 80466, 95.0),
         ("d", "D3", 80467, 95.0), ("e", "D4", 50000, 89.9), ("f", "D5", 1, None)],
        "trip_id string, driver_id string, distance_meters long, overall_score double",
    )
    trips = trips.withColumns(
        {
            "company_id": F.lit(1).cast("long"), "retailer_location_id": F.lit(10).cast("long"),
            "fleet_id": F.lit("f"), "fleet_name": F.lit("F"), "account_id": F.lit(5).cast("long"),
            "start_date_datetime": epoch_ms_to_timestamp(F.lit(0)),
            "end_date_datetime": epoch_ms_to_timestamp(F.lit(1000)),
            **{f"{m}_score": F.lit(1.0) for m in METRICS},
            **{f"{m}_incidents": F.lit(1.0) for m in METRICS},
        }
    )
    drivers = spark.createDataFrame([(f"D{i}", i) for i in range(1, 5)],
                                    "driver_id string, user_id long")
    users = spark.createDataFrame([(i, f"u{i}") for i in range(1, 5)], "id long, email string")
    companies = spark.createDataFrame([(1, "C")], "id long, company_name string")
    eligible = spark.createDataFrame([(1,)], "company_id long")
    return trips, eligible, companies, drivers, users


def test_bucket_edges(tables):
    got = {r["driver_id"]: r for r in rollups.trip_day_rollup(*tables).collect()}
    assert set(got) == {"D1", "D2", "D3", "D4"}  # D5 is no known driver
    assert got["D1"]["performance_bucket"] == "Excellent"
    assert float(got["D1"]["total_distance_miles"]) == 0.0 and got["D1"]["trip_count"] == 2
    assert got["D2"]["performance_bucket"] == "Low distance"
    assert got["D3"]["performance_bucket"] == "Excellent"
    assert got["D4"]["performance_bucket"] == "Low distance"


@pytest.mark.parametrize("limit", [200_000, 0])
def test_both_company_filters_agree(tables, monkeypatch, limit):
    monkeypatch.setattr(rollups, "BROADCAST_COMPANIES", limit)
    trips, _, companies, drivers, users = tables
    other = trips.withColumn("company_id", F.lit(2).cast("long"))
    got = rollups.trip_day_rollup(trips.union(other.select(trips.columns)), *tables[1:])
    assert got.agg(F.sum("trip_count")).first()[0] == 5


def test_large_company_set_does_not_gather_trips_by_company(bed, monkeypatch, spark):
    """Beyond the broadcast limit trips are grouped by all their keys and filtered afterwards."""
    monkeypatch.setattr(rollups, "BROADCAST_COMPANIES", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        days = rollups._day_aggregates(bed.trip_score, rq.eligible(bed), False)
        plan = days._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchange = [x for x in plan.splitlines() if "hashpartitioning(company_id" in x]
    assert any("driver_id" in x and "reporting_day" in x for x in exchange)
    assert plan.index("LeftSemi") < plan.index("partial_count")


def test_group_totals_equal_day_totals(bed):
    days, events = rq.day_rollup(bed), rq.event_rollup(bed)
    a = days.agg(F.count("*"), F.sum("trip_count"), F.sum("total_distance_meters")).first()
    b = rollups.performance_groups(days).agg(
        F.sum("driver_day_count"), F.sum("total_trip_count"), F.sum("total_distance_meters")
    ).first()
    c = rollups.trip_event_groups(events).agg(
        F.sum("driver_day_count"), F.sum("total_trip_count"), F.sum("total_distance_meters")
    ).first()
    assert tuple(a) == tuple(b) == tuple(c)


def test_trips_are_scanned_for_needed_columns_only(bed):
    plan = rq.day_rollup(bed)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "EvalPython" not in plan
    scans = [line for line in plan.splitlines() if "FileScan" in line and "event_id" in line]
    assert scans and all("event_type" not in line and "value#" not in line for line in scans)


def test_split_of_the_combined_pass(bed):
    combined = rollups.trip_event_day_rollup(
        bed.trip_score, rq.eligible(bed), bed.company, bed.driver, bed.app_user, with_bucket=True
    )
    days, events = rollups.split_day_rollups(combined)
    assert days.exceptAll(rq.day_rollup(bed)).count() == 0
    assert set(events.columns) == set(rq.event_rollup(bed).columns)
