"""Rollups, serving queries and joins over conformed tables."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from milepost.functions.measures import meters_to_miles, trip_class
from milepost.operators import lookups, reports, rollups
from milepost.operators.dedup import duplicate_keys
from milepost.plans import serving, tables
from milepost.session import scratch_dir
from testbed.registry import query
from testbed.views import Bed
from testbed.views_sql import MILES

E = F.expr


def eligible(b: Bed):
    return rollups.eligible_companies(b.subscription, b.company_subscription)


def day_rollup(b: Bed):
    return rollups.trip_day_rollup(b.trip_score, eligible(b), b.company, b.driver, b.app_user)


def event_rollup(b: Bed):
    return rollups.trip_event_day_rollup(
        b.trip_score, eligible(b), b.company, b.driver, b.app_user
    )


def trip_list(b: Bed):
    return rollups.driver_trip_list(b.trip_score, eligible(b), b.driver, b.app_user)


query("trip_day_rollup", "SELECT * FROM trip_day_rollup", ("trip_day_rollup",))(day_rollup)
query("trip_event_day_rollup", "SELECT * FROM trip_event_day_rollup", ("trip_event_day_rollup",))(
    event_rollup
)
query("driver_trip_list", "SELECT * FROM driver_trip_list", ("driver_trip_list",))(trip_list)
query("eligible_companies", "SELECT company_id FROM eligible", ("eligible",))(eligible)


@query("performance_groups", "SELECT * FROM performance_groups", ("performance_groups",))
def performance_groups(b: Bed):
    return rollups.performance_groups(day_rollup(b))


@query("trip_event_groups", "SELECT * FROM trip_event_groups", ("trip_event_groups",))
def trip_event_groups(b: Bed):
    return rollups.trip_event_groups(event_rollup(b))


@query(
    "driver_activity",
    """SELECT d.account_id, d.driver_id, d.user_id, d.retailer_location_id, f.company_id,
  u.is_active
FROM driver d JOIN app_user u ON u.id = d.user_id AND NOT u.deleted
  JOIN fleet f ON f.retailer_location_id = d.retailer_location_id""",
    ("driver", "app_user", "fleet"),
)
def driver_activity(b: Bed):
    return lookups.driver_activity(b.driver, b.app_user, b.fleet)


# --- serving --------------------------------------------------------------------------------------


@query(
    "driver_recent_trips",
    """SELECT trip_id, driver_display_name, end_date_datetime, distance_miles, duration_minutes,
  performance_class FROM driver_trip_list WHERE company_id = 0 AND driver_id = 'D3'""",
    ("driver_trip_list",),
)
def driver_recent_trips(b: Bed):
    mine = serving.driver_recent_trips(trip_list(b), 0, "D3")
    return mine.select(
        "trip_id", "driver_display_name", "end_date_datetime", "distance_miles",
        "duration_minutes", "performance_class",
    )


@query(
    "stored_recent_trips",
    """SELECT trip_id, driver_display_name, end_date_datetime, distance_miles, duration_minutes,
  performance_class FROM driver_trip_list WHERE company_id = 0 AND driver_id = 'D3'
  AND end_date_datetime >= TIMESTAMP '2024-01-05' AND end_date_datetime < TIMESTAMP '2024-01-26'""",
    ("driver_trip_list",),
)
def stored_recent_trips(b: Bed):
    """The drill-down on the stored list: days by folder, the driver by the files' order."""
    out = scratch_dir(b.spark, "rollups")
    tables.store_trip_list(trip_list(b), out, None)
    mine = serving.stored_recent_trips(b.spark, out, 0, "D3", date(2024, 1, 5), date(2024, 1, 25))
    return mine.select(
        "trip_id", "driver_display_name", "end_date_datetime", "distance_miles",
        "duration_minutes", "performance_class",
    )


@query(
    "top_scores",
    """SELECT trip_id, driver_id, overall_score FROM trip_score
ORDER BY overall_score DESC NULLS LAST, trip_id LIMIT 20""",
    ("trip_score",),
)
def top_scores(b: Bed):
    rows = b.trip_score.select("trip_id", "driver_id", "overall_score")
    return serving.top_scores(rows, "overall_score", "trip_id", 20)


@query(
    "performance_cards",
    """SELECT * FROM performance_groups WHERE company_id = 1
AND reporting_day BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'""",
    ("performance_groups",),
)
def performance_cards(b: Bed):
    groups = rollups.performance_groups(day_rollup(b))
    return serving.performance_cards(groups, 1, date(2024, 1, 5), date(2024, 1, 20))


_ROSTER = """SELECT retailer_location_id, internal_id, name, active FROM site
WHERE active AND retailer_location_id IN (SELECT retailer_location_id FROM claim)"""


@query("active_roster", _ROSTER, ("site", "claim"))
def active_roster(b: Bed):
    return lookups.active_roster(b.site, b.company_account)


@query(
    "active_roster_top_n",
    _ROSTER + " ORDER BY retailer_location_id LIMIT 10",
    ("site", "claim"),
)
def active_roster_top_n(b: Bed):
    return serving.roster_top_n(b.site, b.company_account, 10)


# --- lookups --------------------------------------------------------------------------------------


@query(
    "trips_in_window",
    """SELECT trip_id, driver_id, end_date_datetime FROM trip_score
WHERE end_date_datetime >= TIMESTAMP '2024-01-10 06:00:00'
  AND end_date_datetime < TIMESTAMP '2024-01-12 18:30:00'""",
    ("trip_score",),
)
def trips_in_window(b: Bed):
    return lookups.trips_in_window(
        b.trip_score, datetime(2024, 1, 10, 6), datetime(2024, 1, 12, 18, 30)
    ).select("trip_id", "driver_id", "end_date_datetime")


@query(
    "resolve_fleet_identity",
    """SELECT l.position, l.fleet_id, f.retailer_location_id, f.company_id
FROM landed_trip l LEFT JOIN fleet f ON f.internal_id = l.fleet_id""",
    ("landed_trip", "fleet"),
)
def resolve_fleet_identity(b: Bed):
    rows = b.raw_trip.select("position", E("trim(fleetId)").alias("fleet_id"))
    return lookups.resolve_fleet_identity(rows, b.fleet, "fleet_id")


@query(
    "resolve_company_by_location",
    """SELECT s.retailer_location_id, s.internal_id, c.company_id, c.conflicting_companies
FROM site s LEFT JOIN company_of c USING (retailer_location_id)""",
    ("site", "company_of"),
)
def resolve_company_by_location(b: Bed):
    rows = b.site.select("retailer_location_id", "internal_id")
    return lookups.resolve_company(rows, b.company_account, "retailer_location_id")


@query(
    "resolve_driver_user",
    """SELECT driver_id, CASE WHEN (focus_driver_id IS NOT NULL OR contact_email IS NOT NULL)
  AND user_id IN (SELECT id FROM app_user) THEN user_id END AS user_id FROM driver""",
    ("driver", "app_user"),
)
def resolve_driver_user(b: Bed):
    rows = b.driver.select("driver_id", "focus_driver_id", "contact_email")
    found = lookups.resolve_driver_user(
        rows, b.app_user, F.col("focus_driver_id"), F.col("contact_email")
    )
    return found.select("driver_id", "user_id")


@query(
    "known_driver_trips",
    """SELECT trip_id, driver_id FROM trip_score
WHERE driver_id IN (SELECT driver_id FROM known_driver)""",
    ("trip_score", "known_driver"),
)
def known_driver_trips(b: Bed):
    rows = b.trip_score.select("trip_id", "driver_id")
    return lookups.known_driver_rows(rows, b.known_driver, "driver_id")


@query(
    "unknown_driver_ids",
    """SELECT driver_id, count(*) AS filtered_rows FROM trip_score
WHERE driver_id NOT IN (SELECT driver_id FROM known_driver) GROUP BY 1""",
    ("trip_score", "known_driver"),
)
def unknown_driver_ids(b: Bed):
    return lookups.unknown_driver_ids(b.trip_score, b.known_driver, "driver_id")


@query(
    "normalize_discovered_fleet",
    "SELECT p_partkey, internal_id, name, retailer_location_id FROM found_fleet",
    ("found_fleet",),
)
def normalize_discovered_fleet(b: Bed):
    return lookups.normalize_discovered_fleet(b.found_fleet).drop("raw")


def reconciled(b: Bed):
    found = lookups.normalize_discovered_fleet(b.found_fleet)
    return lookups.reconcile_fleets(found, b.site, b.company_account)


_OUTCOMES = "SELECT internal_id, name, retailer_location_id, company_id, outcome FROM reconciled"


@query("reconcile_fleets", _OUTCOMES, ("reconciled",))
def reconcile_fleets(b: Bed):
    return reconciled(b).select(
        "internal_id", "name", "retailer_location_id", "company_id", "outcome"
    )


@query(
    "discovery_summary",
    """SELECT count(*) AS seen, count(*) FILTER (outcome = 'known') AS known,
  count(*) FILTER (outcome = 'insertable') AS inserted,
  count(*) FILTER (outcome = 'pending') AS pending FROM reconciled""",
    ("reconciled",),
)
def discovery_summary(b: Bed):
    return reports.discovery_summary(reconciled(b))


def _misassigned(b: Bed):
    """Scores whose company is wrong or missing for some fleets."""
    wrong = E(
        "CASE WHEN retailer_location_id % 3 = 0 THEN NULL WHEN retailer_location_id % 3 = 1"
        " THEN company_id + 1 ELSE company_id END"
    )
    return b.driver_score.select(
        "snapshot_date", "fleet_id", "driver_id", wrong.alias("company_id")
    )


@query(
    "repair_company_ids",
    """SELECT d.snapshot_date, d.fleet_id, d.driver_id, f.company_id,
  d.retailer_location_id % 3 <> 2 AS repaired
FROM driver_score d JOIN fleet f ON f.internal_id = d.fleet_id""",
    ("driver_score", "fleet"),
)
def repair_company_ids(b: Bed):
    return lookups.repair_company_ids(_misassigned(b), b.fleet)


@query(
    "company_mapping_counts",
    "SELECT fleet_id, company_id, count(*) AS row_count FROM trip_score GROUP BY 1, 2",
    ("trip_score",),
)
def company_mapping_counts(b: Bed):
    return reports.company_mapping_counts(b.trip_score)


@query(
    "driver_lookup",
    """SELECT blob_id AS driver_id, CASE
    WHEN c_custkey % 4 = 1 THEN c_name
    WHEN c_custkey % 7 < 3 THEN c_mktsegment
    WHEN c_custkey % 7 = 3 THEN lower(c_name) || '@x.test'
    WHEN c_custkey % 5 = 0 THEN upper(c_name) || '@X.test'
    ELSE lower(c_name) END AS driver_name, c_custkey + 500000 AS driver_account_id
FROM landed_driver WHERE blob_id IS NOT NULL AND user_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY blob_id ORDER BY position DESC) = 1""",
    ("landed_driver",),
)
def driver_lookup(b: Bed):
    return lookups.driver_lookup(b.raw_driver, b.app_user, "position")


@query(
    "enrich_report_rows",
    """SELECT l.position, l.fleet_id AS "fleetId", f.internal_id AS "fleetInternalId",
  f.name AS "fleetName", k.driver_id AS "driverId", k.driver_name AS "driverName",
  k.account AS "driverAccountId"
FROM landed_trip l JOIN fleet f ON f.internal_id = l.fleet_id
  JOIN (SELECT driver_id, 'Driver ' || user_id AS driver_name, account_id AS account FROM driver
        WHERE driver_id IN (SELECT driver_id FROM known_driver)) k
    ON k.driver_id = 'D' || l.user_id
WHERE f.active AND l.event_id % 59 <> 4""",
    ("landed_trip", "fleet", "driver", "known_driver"),
)
def enrich_report_rows(b: Bed):
    lookup = b.known_driver.select(
        "driver_id",
        E("concat('Driver ', user_id)").alias("driver_name"),
        F.col("account_id").alias("driver_account_id"),
    )
    rows = b.raw_trip.select("position", "fleetId", "thirdPartyId", "fleetName")
    enriched = lookups.enrich_report_rows(rows, b.fleet.filter("active"), lookup)
    return enriched.withColumn("fleetId", F.trim("fleetId")).drop("thirdPartyId")


_WORKLIST = """SELECT trip_id, account_id, end_date_datetime FROM trip_score
WHERE end_date_datetime >= TIMESTAMP '2024-01-08' AND end_date_datetime < TIMESTAMP '2024-01-23'"""


def worklist(b: Bed):
    return lookups.trip_detail_worklist(
        b.trip_score, datetime(2024, 1, 8), datetime(2024, 1, 23)
    )


@query("trip_detail_worklist", _WORKLIST, ("trip_score",))
def trip_detail_worklist(b: Bed):
    return lookups.in_load_order(worklist(b))


@query(
    "trips_missing_details",
    _WORKLIST + " AND trip_id NOT IN (SELECT trip_id FROM point)",
    ("trip_score", "point"),
)
def trips_missing_details(b: Bed):
    return lookups.trips_missing_details(worklist(b), b.trip_location)


@query(
    "worklist_details",
    f"SELECT p.* FROM point p WHERE p.trip_id IN (SELECT trip_id FROM ({_WORKLIST}))",
    ("trip_score", "point"),
)
def worklist_details(b: Bed):
    details = b.trip_incident.drop("timestamp_datetime")
    return lookups.details_for_worklist(details, worklist(b))


@query(
    "backfill_driver_id",
    """SELECT account_id, CASE WHEN user_id % 10 = 4 THEN 'kept' WHEN user_id % 23 = 0 THEN 'top'
  ELSE driver_id END AS driver_id FROM driver""",
    ("driver",),
)
def backfill_driver_id(b: Bed):
    blank = b.driver.select(
        "account_id",
        E("CASE WHEN user_id % 10 = 4 THEN 'kept' WHEN user_id % 10 < 4 THEN '  ' END").alias(
            "driver_id"
        ),
        "app_info",
    )
    return lookups.backfill_driver_id(blank).drop("app_info")


# --- small measures -------------------------------------------------------------------------------


@query(
    "trip_performance_class",
    """SELECT trip_id, CASE WHEN coalesce(overall_score, 0) >= 90 THEN 'Excellent'
  WHEN coalesce(overall_score, 0) >= 72 THEN 'Fair' ELSE 'Risky' END AS performance_class
FROM trip_score""",
    ("trip_score",),
)
def trip_performance_class(b: Bed):
    return b.trip_score.select(
        "trip_id", trip_class(F.col("overall_score")).alias("performance_class")
    )


@query(
    "meters_to_miles",
    f"""SELECT o_orderkey, o_orderkey * 12573 + o_custkey AS meters,
  {MILES.format('o_orderkey * 12573 + o_custkey')} AS miles FROM orders""",
)
def miles(b: Bed):
    meters = E("o_orderkey * 12573 + o_custkey")
    return b.table("orders").select(
        "o_orderkey", meters.alias("meters"), meters_to_miles(meters).alias("miles")
    )


@query(
    "duplicate_score_keys",
    """SELECT ts::DATE AS snapshot_date, 'fleet_' || c_nationkey AS fleet_id,
  'D' || user_id AS driver_id, count(*) AS row_count
FROM event GROUP BY 1, 2, 3 HAVING count(*) > 1""",
    ("event",),
)
def duplicate_score_keys(b: Bed):
    rows = b.event.select(
        F.col("ts").cast("date").alias("snapshot_date"),
        E("concat('fleet_', c_nationkey)").alias("fleet_id"),
        E("concat('D', user_id)").alias("driver_id"),
    )
    return duplicate_keys(rows, ["snapshot_date", "fleet_id", "driver_id"])
