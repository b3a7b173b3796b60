from datetime import datetime

from pyspark.sql import functions as F

from milepost.operators import lookups, quality, reports
from milepost.operators.dedup import first_by
from milepost.operators.merge import discovered_fleet_rows
from tests.helpers import fleets, ntz, rows


def test_left_lookup_keeps_rows_without_key(spark):
    table = spark.createDataFrame([("a", 1), ("\x00" + "5", 2)], "k string, v long")
    data = [(i, None) for i in range(500)] + [(1000, "a"), (1001, "zz")]
    probe = spark.createDataFrame(data, "i long, k2 string")
    got = lookups.left_lookup(probe, F.col("k2"), table, "k", ["v"])
    assert got.count() == 502
    assert rows(got.filter("v IS NOT NULL").select("i", "v")) == [(1000, 1)]


def test_fleet_identity_lowest_location_wins(spark):
    extra = spark.createDataFrame([(90, "fleet-1", "Old", 5, True), (91, "fleet-3", "x", None, True)],
                                  fleets(spark).schema)
    probe = spark.createDataFrame([(" fleet-1 ",), ("fleet-3",), (None,)], "fleet_id string")
    got = lookups.resolve_fleet_identity(probe, fleets(spark).union(extra), "fleet_id")
    assert {r["fleet_id"]: (r["retailer_location_id"], r["company_id"]) for r in got.collect()} == {
        " fleet-1 ": (90, 5), "fleet-3": (None, None), None: (None, None)}


def test_unknown_and_known_drivers(spark):
    trips = spark.createDataFrame([("a",), ("a",), (" b ",), (None,), (" ",)], "driver_id string")
    known = spark.createDataFrame([("b",)], "driver_id string")
    assert rows(lookups.unknown_driver_ids(trips, known, "driver_id")) == [("a", 2)]
    assert rows(lookups.known_driver_rows(trips, known, "driver_id")) == [(" b ",)]


def test_reconcile_outcomes(spark):
    found = spark.createDataFrame(
        [('{"internalId":"fleet-1","id":5}',), ('{"id":"11","name":" "}',), ('{"id":"x12"}',),
         ('{"fleetId":"13","fleetName":"N"}',), ('{"b":1,"a":null}',)],
        "payload string",
    )
    companies = spark.createDataFrame(
        [(1, '{"eventInfo":{"flAccountId":11}}'), (2, '{"eventInfo":{"flAccountId":13}}')],
        "id long, focus_data string",
    )
    normal = lookups.normalize_discovered_fleet(found)
    got = lookups.reconcile_fleets(normal, fleets(spark), companies)
    outcome = {r["internal_id"]: (r["name"], r["outcome"]) for r in got.collect()}
    assert outcome == {
        "fleet-1": ("fleet-1", "known"), "11": ("11", "insertable"), "x12": ("x12", "pending"),
        "13": ("N", "insertable"), '{"a":null,"b":1}': ('{"a":null,"b":1}', "pending"),
    }
    assert tuple(reports.discovery_summary(got).first()) == (5, 1, 2, 2)
    assert rows(discovered_fleet_rows(got).select("retailer_location_id", "company_id")) == [
        (11, 1), (13, 2)]


def test_repair_company_ids(spark):
    scores = spark.createDataFrame([("fleet-1", None), ("fleet-1", 7), ("fleet-2", 1), ("other", 3)],
                                   "fleet_id string, company_id long")
    got = lookups.repair_company_ids(scores, fleets(spark))
    assert sorted((r["fleet_id"], r["company_id"], r["repaired"]) for r in got.collect()) == [
        ("fleet-1", 7, False), ("fleet-1", 7, True), ("fleet-2", 8, True), ("other", 3, False)]


def test_worklist_and_missing_details(spark):
    trips = spark.createDataFrame(
        [("a", 1, 1), (" a", 2, 2), ("b", None, 1), ("c", 3, 9), ("d", 4, 3)],
        "trip_id string, account_id long, m int",
    ).withColumn("end_date_datetime", F.expr("timestampadd(MINUTE, m, TIMESTAMP_NTZ'2024-01-01')"))
    work = lookups.trip_detail_worklist(trips, datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 9))
    assert rows(work.select("trip_id", "account_id")) == [("a", 1), ("d", 4)]
    details = spark.createDataFrame([("d",)], "trip_id string")
    assert rows(lookups.trips_missing_details(work, details).select("trip_id")) == [("a",)]


def test_first_by_limits_groups_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    got = first_by(df, ["k"], [F.col("id").desc()])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert rows(got) == [(0, 999), (1, 997), (2, 998)]


def test_orphans_count_rows_and_keys(spark):
    child = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    parent = spark.createDataFrame([("b",)], "k string")
    assert tuple(quality.orphan_counts(child, parent, "k", "k", "r").first()) == ("r", 1, 2)


def test_run_status_codes(spark):
    def status(*values):
        df = spark.createDataFrame([(v,) for v in values], "fleet_status string")
        row = reports.run_status(df).first()
        return row["exit_code"], row["run_status"]

    assert status() == (2, "error")
    assert status("error", "skipped") == (1, "error")
    assert status("skipped") == (0, "ok")
    assert status("ok", "error") == (0, "partial")
    assert status("ok", "partial") == (0, "ok")


def test_fleet_statuses(spark):
    steps = spark.createDataFrame(
        [("a", "convert", "ok", 0), ("b", "convert", "error", 1), ("c", "convert", "error", 1),
         ("d", "import", "ok", 1)],
        "fleet_id string, step string, status string, errors long",
    )
    pulls = spark.createDataFrame(
        [("a", "ok", 0), ("b", "ok", 0), ("c", "error", 1), ("d", "ok", 0), ("e", "partial", 2)],
        "fleet_id string, pull_status string, errors long",
    )
    got = {r["fleet_id"]: r["fleet_status"] for r in
           reports.fleet_statuses(steps, pulls).collect()}
    assert got == {"a": "ok", "b": "partial", "c": "error", "d": "partial", "e": "partial"}


def test_unlink_fleets(spark):
    kept = quality.unlink_fleets(
        spark.createDataFrame([(1, 101), (2, 102), (3, None)], "d long, retailer_location_id long"),
        fleets(spark).filter("name = 'Hub'"),
    )
    assert sorted(map(tuple, kept.collect())) == [(1, None), (2, 102), (3, None)]


def test_ntz_helper(spark):
    assert spark.range(1).select(ntz("2024-01-01 00:00:00")).first()[0] == datetime(2024, 1, 1)


def test_found_fleets_are_read_once(spark):
    """All members come from one pass over the document."""
    found = spark.createDataFrame([('{"id":1}', 7), (None, 8), ("[1]", 9)], "payload string, n int")
    out = lookups.normalize_discovered_fleet(found)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("json_tuple") == 1 and "get_json_object" not in plan
    assert rows(out) == [(7, "1", "1", 1, '{"id":1}'), (8, None, None, None, None), (9, "[1]", "[1]", None, "[1]")]
