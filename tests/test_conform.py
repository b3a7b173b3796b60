import os
from datetime import date, datetime

from pyspark.sql import functions as F

from milepost.operators import conform, reports
from tests.helpers import drivers, fleets, landed, rows

TRIP = {
    "tripId": "trip-1", "accountId": 123, "fleetId": "fleet-1", "thirdPartyId": "tp-1",
    "tripType": "driver", "distance": 42, "startDate": 1000, "endDate": 2000,
    "startLatitude": 1.5, "startLongitude": 2.5, "startDescription": "Start",
    "endLatitude": 3.5, "endLongitude": 4.5, "endDescription": "End",
    "weatherCode": 113, "weatherTempLow": 10, "weatherTempHigh": 20, "weatherWind": 5,
}
NO_GEO = {k: None for k in TRIP if k.startswith(("start", "end")) and not k.endswith("Date")}


def trips(spark, *changes, known=("tp-1",)):
    raw = landed(spark, "trip_scores", [{**TRIP, **c} for c in changes])
    return conform.conform_trip_score(raw, fleets(spark), drivers(spark, *known), "position")


def test_geo_and_weather(spark):
    got = conform.accepted(trips(spark, {})).first()
    assert got["geo"].asDict() == {
        "startLatitude": 1.5, "startLongitude": 2.5, "startDescription": "Start",
        "endLatitude": 3.5, "endLongitude": 4.5, "endDescription": "End",
    }
    assert got["weather"].asDict() == {
        "weatherCode": "113", "weatherTempLow": 10.0, "weatherTempHigh": 20.0, "weatherWind": 5.0,
    }
    assert (got["retailer_location_id"], got["company_id"], got["driver_id"]) == (101, 7, "tp-1")


def test_empty_geo_is_null(spark):
    got = conform.accepted(trips(spark, NO_GEO)).first()
    assert got["geo"] is None and got["weather"] is not None


def test_trip_rejects(spark):
    judged = trips(
        spark,
        {"tripId": "a", "endDate": 999},
        {"tripId": "b", "startDate": None},
        {"tripId": " "},
        {"tripId": "c", "driverId": "  "},
        {"tripId": "d", "driverId": "stranger"},
        {"tripId": "e", "fleetId": "nowhere"},
        {"tripId": "f", "driverId": ""},
    )
    got = {r["trip_id"]: (r["_status"], r["_reason"]) for r in judged.collect()}
    assert got == {
        "a": ("skipped", "invalid_trip_window"),
        "b": ("skipped", "missing_trip_window"),
        None: ("skipped", "missing_trip_id_or_driver_id"),
        "c": ("skipped", "missing_trip_id_or_driver_id"),
        "d": ("filtered", "unknown_driver"),
        "e": ("skipped", "unresolved_company"),
        "f": ("resolved", None),
    }


def test_first_usable_duplicate_trip_wins(spark):
    judged = trips(
        spark, {"endDate": 1, "overallScore": 1}, {"overallScore": 2}, {"overallScore": 3}
    )
    assert [r["overall_score"] for r in conform.accepted(judged).collect()] == [2.0]
    summary = reports.conversion_summary(judged, "trips").first()
    assert tuple(summary)[1:] == (3, 1, 1, 0, 1)


def test_hot_duplicate_key_keeps_one(spark):
    """A third of all rows may share one trip id."""
    raw = landed(spark, "trip_scores", [{**TRIP, "tripId": f"t{i % 200 if i % 3 else 0}"}
                                        for i in range(900)])
    judged = conform.conform_trip_score(raw, fleets(spark), drivers(spark, "tp-1"), "position")
    kept = conform.accepted(judged).select("trip_id")
    assert kept.count() == kept.distinct().count()
    assert judged.count() == 900


SCORE = {
    "accountId": 3634735, "fleetId": "fleet-1", "thirdPartyId": "tp-1", "distance": 271673,
    "overallScore": 25.27075, "accelIncidents": 27, "lastAccelIncident": 1780334653000,
    "lastCollisionIncident": None,
}


def scores(spark, *changes):
    raw = landed(spark, "driver_scores", [{**SCORE, **c} for c in changes])
    return conform.conform_driver_score(
        raw, fleets(spark), drivers(spark, "tp-1"), date(2026, 6, 8), "position"
    )


def test_example_score(spark):
    got = conform.derive_incident_times(conform.accepted(scores(spark, {}))).first()
    assert got["snapshot_date"] == date(2026, 6, 8)
    assert got["source_group_key"] == "GL_REPORT_DATA" and got["source_row_index"] == 1
    assert got["overall_score"] == 25.27075 and got["accel_incidents"] == 27.0
    assert got["last_accel_incident_datetime"] == datetime(2026, 6, 1, 17, 24, 13)
    assert got["last_collision_incident_datetime"] is None


def test_scores_last_row_of_a_day_wins(spark):
    judged = scores(
        spark, {"snapshotDate": "2026-06-01", "overallScore": 1},
        {"snapshotDate": "2026-06-01", "overallScore": 2},
        {"snapshotDate": "2026-06-01T00:00", "overallScore": 3},
        {"sourceRowIndex": "x"}, {"fleetId": " "},
    )
    got = {r["snapshot_date"]: r["overall_score"] for r in conform.accepted(judged).collect()}
    assert got == {date(2026, 6, 1): 2.0, date(2026, 6, 8): 3.0}
    reasons = sorted(r["_reason"] for r in conform.rejected(judged).collect())
    assert reasons == ["duplicate_key", "missing_fleet", "missing_row_index"]


def test_points_need_every_field(spark):
    point = {"tripId": " t ", "accountId": 1, "timestamp": "5", "latitude": 1, "longitude": "2.5"}
    raw = landed(spark, "trip_incidents",
                 [{**point, "type": "x"}, {**point, "type": " "}, {**point, "latitude": "north"}],
                 position=False)
    got = conform.accepted(conform.conform_trip_incident(raw))
    assert rows(got) == [("t", 1, 5, 1.0, 2.5, "x")]
    assert conform.rejected(conform.conform_trip_incident(raw)).count() == 2


def users(spark):
    return spark.createDataFrame(
        [(1, "ann@x", '{"DriverId":"D1"}'), (2, "ANN@x", "{}"), (3, "bo@x", '{"DriverId":"D1"}'),
         (4, None, None)],
        "id long, email string, focus_data string",
    )


def test_driver_rejects_and_matches(spark):
    blob = '{"appBlob":{"driverId":"R1"}}'
    raw = landed(
        spark, "drivers",
        [
            {"accountId": 1, "focus_data": '{"DriverId":"D1"}', "appInfo": blob},
            {"accountId": 2, "contactEmail": " Ann@X ", "appInfo": blob},
            {"accountId": 3, "focus_data": '{"DriverId":"D9"}', "contactEmail": "bo@x",
             "appInfo": blob},
            {"accountId": 4, "appInfo": blob},
            {"accountId": 5, "contactEmail": "who@x", "appInfo": blob},
            {"accountId": 6, "contactEmail": "bo@x", "appInfo": '{"appBlob":"{bad"}'},
        ],
        position=False,
    )
    judged = conform.conform_driver(raw, users(spark), F.lit(9))
    got = {r["account_id"]: r["user_id"] for r in conform.accepted(judged).collect()}
    assert got == {1: 1, 2: 1, 3: 3}
    rejects = {r["account_id"]: r["reason"] for r in conform.rejected_drivers(judged).collect()}
    assert rejects == {4: "no_driver_identity", 5: "user_not_found", 6: "missing_driver_id"}


def test_fleet_needs_a_company(spark):
    companies = spark.createDataFrame(
        [(1, '{"eventInfo":{"flAccountId":" 11 "}}'), (2, '{"eventInfo":{"flAccountId":11}}'),
         (3, '{"eventInfo":{"flAccountId":"x"}}'), (4, None)],
        "id long, focus_data string",
    )
    raw = landed(
        spark, "fleet",
        [{"retailerLocationId": "11", "metaData": "not json", "favoriteCount": "2",
          "latitude": "12.3456789"},
         {"retailerLocationId": "12"}],
        position=False,
    )
    judged = conform.conform_fleet(raw, companies)
    got = conform.accepted(judged).first()
    assert got["company_id"] == 1 and got["meta_data"] == '{"raw":"not json"}'
    assert str(got["latitude"]) == "12.345679"
    assert got["stats"].startswith('{"favorite":null,"favoriteCount":2,"noteCount":null')
    assert [r["_reason"] for r in conform.rejected(judged).collect()] == ["unresolved_company"]


def test_daily_stamp_counts_across_pages(spark):
    data = [(date(2024, 1, d), p, i) for d in (1, 2) for p in (0, 1, 4096, 9000) for i in range(3)]
    df = spark.createDataFrame(data, "day date, page long, pos int")
    got = conform.stamp_daily_scores(df, "day", "page", "pos").collect()
    by_day = {}
    for r in got:
        by_day.setdefault(r["day"], []).append((r["page"], r["pos"], r["sourceRowIndex"]))
        assert r["sourceGroupKey"] == f"GL_REPORT_DATA:{r['snapshotDate']}"
    for stamped in by_day.values():
        assert [i for _, _, i in sorted(stamped)] == list(range(1, 13))


def test_asked_columns_alone_are_written(spark):
    """Rejects of some columns are those of all columns, and the others don't reach the written rows."""
    changes = [{"tripId": "a"}, {"tripId": "a"}, {"tripId": "b", "endDate": 999}, {"tripId": "c", "driverId": "x"}, {"tripId": " "}]
    raw = landed(spark, "trip_scores", [{**TRIP, **c} for c in changes])
    for columns in (["trip_id", "driver_id", "fleet_id"], ["trip_id", "overall_score", "company_id"], ["geo"]):
        got = conform.conform_trip_score(raw, fleets(spark), drivers(spark, "tp-1"), "position", columns=columns)
        assert got.columns == [*columns, "_status", "_reason"]
        whole = conform.conform_trip_score(raw, fleets(spark), drivers(spark, "tp-1"), "position")
        assert sorted(map(str, got.collect())) == sorted(map(str, whole.select(*got.columns).collect()))
        written = spark.read.parquet(os.path.dirname(got.inputFiles()[0])).schema.simpleString()
        assert "weather" not in written and ("overall_score" in written) == ("overall_score" in columns)
