"""Conforming projections, rejects and their accounting."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from milepost.operators import conform, reports
from milepost.operators.dedup import first_by
from milepost.schemas import DRIVER_SCORE_KEY, METRICS, TRIP_KEY
from testbed.registry import query
from testbed.views import Bed

E = F.expr
SNAPSHOT = date(2024, 2, 1)

_METRIC_SQL = ", ".join(
    [f"{m}_score" for m in METRICS] + [f"{m}_incidents" for m in METRICS]
    + [f"last_{m}_incident" for m in METRICS]
)


# --- fleets and drivers ---------------------------------------------------------------------------


def fleets(b: Bed):
    return conform.conform_fleet(b.raw_fleet, b.company_account)


_FLEET = """SELECT p_partkey + 1000 AS retailer_location_id, 'site_' || p_partkey AS internal_id,
  p_name AS name, p_type AS location_type,
  CASE p_size % 3 WHEN 0 THEN true WHEN 1 THEN false END AS public_location,
  'https://qr.test/' || p_partkey AS qr_code_url, NULL::VARCHAR AS location_token,
  p_size > 8 AS active,
  CASE WHEN p_size <> 50 THEN (p_size * 3.25 - 80)::DOUBLE END AS latitude,
  (p_partkey % 360 - 180.5)::DOUBLE AS longitude,
  '{"id":' || p_partkey || '}' AS manager, '["' || p_brand || '"]' AS categories,
  NULL::VARCHAR AS filters, '{}' AS billable_entity,
  '{"name":"' || p_name || '","n":null}' AS retailer, '[]' AS offers,
  CASE p_size % 4 WHEN 1 THEN '{"raw":"' || p_name || '"}' WHEN 2 THEN '{"size":' || p_size || '}'
    END AS meta_data,
  '{"contactInfo":{}}' AS contact,
  '{"favorite":' || (p_size % 2 = 0)::VARCHAR || ',"favoriteCount":' || p_size
    || ',"noteCount":null,"sharedCount":' || p_size
    || ',"likeCount":null,"dislikeCount":0,"hasRatings":null}' AS stats,
  c.company_id
FROM part JOIN company_of c ON c.retailer_location_id = p_partkey + 1000"""


@query("conform_fleet", _FLEET, ("company_of",))
def conform_fleet(b: Bed):
    return conform.accepted(fleets(b))


def drivers(b: Bed):
    return conform.conform_driver(b.raw_driver, b.app_user, F.lit(999))


@query(
    "conform_driver",
    """SELECT c_custkey + 500000 AS account_id, blob_id AS driver_id, user_id,
  CASE WHEN c_custkey % 6 <> 0 THEN c_nationkey + 1000 ELSE 999 END::BIGINT
    AS retailer_location_id,
  CASE WHEN c_custkey % 4 = 1 THEN ' ' || c_name || ' ' WHEN c_custkey % 4 = 2 THEN '  ' END
    AS display,
  lower(c_name) AS username, c_mktsegment AS account_type, contact_email,
  'Hub ' || c_nationkey AS location_display, c_acctbal > 0 AS active,
  c_nationkey * 2.5::DOUBLE AS latitude, (-c_nationkey)::DOUBLE AS longitude,
  1 AS location_count, focus_id
FROM judged_driver WHERE reason IS NULL""",
    ("judged_driver",),
)
def conform_driver(b: Bed):
    return conform.accepted(drivers(b)).select(
        "account_id", "driver_id", "user_id", "retailer_location_id", "display", "username",
        "account_type", "contact_email", "location_display", "active", "latitude", "longitude",
        "location_count", F.col("_focus_id").alias("focus_id"),
    )


@query(
    "rejected_drivers",
    """SELECT c_custkey + 500000 AS account_id,
  CASE WHEN c_custkey % 4 = 1 THEN ' ' || c_name || ' ' WHEN c_custkey % 4 = 2 THEN '  ' END
    AS display,
  CASE WHEN reason <> 'missing_driver_id' THEN focus_id END AS driver_id, contact_email, reason
FROM judged_driver WHERE reason IS NOT NULL""",
    ("judged_driver",),
)
def rejected_drivers(b: Bed):
    return conform.rejected_drivers(drivers(b))


# --- scores and trips -----------------------------------------------------------------------------


def scores(b: Bed):
    return conform.conform_driver_score(b.raw_score, b.fleet, b.known_driver, SNAPSHOT, "position")


@query(
    "conform_driver_score",
    f"""SELECT s.driver_id, user_id + 500000 AS account_id, snapshot_date, source_group_key,
  row_index AS source_row_index, s.fleet_id, n_name AS fleet_name,
  CASE WHEN event_id % 59 <> 4 THEN 'D' || user_id END AS third_party_id,
  NULL::VARCHAR AS driver_name, distance_meters, overall_score,
  {", ".join(f"{m}_score, {m}_incidents" for m in METRICS)},
  {", ".join(f"CASE WHEN event_id % 5 <> 0 THEN last_{m}_incident END AS last_{m}_incident"
             for m in METRICS)},
  f.retailer_location_id, f.company_id
FROM status_score s JOIN fleet f ON f.internal_id = s.fleet_id WHERE status = 'resolved'""",
    ("status_score", "fleet"),
)
def conform_driver_score(b: Bed):
    return conform.accepted(scores(b))


def trips(b: Bed, columns: list[str] | None = None):
    return conform.conform_trip_score(b.raw_trip, b.fleet, b.known_driver, "position", columns=columns)


@query(
    "conform_trip_score",
    f"""SELECT trip_id, user_id + 500000 AS account_id, s.driver_id, s.fleet_id,
  n_name AS fleet_name, CASE WHEN event_id % 59 <> 4 THEN 'D' || user_id END AS third_party_id,
  CASE WHEN event_id % 3 = 1 THEN 'Name ' || user_id END AS driver_name,
  event_type AS trip_type, start_ms AS start_date, end_ms AS end_date,
  CASE WHEN event_id % 101 <> 9 THEN distance_meters END AS distance_meters,
  overall_score + again AS overall_score, {_METRIC_SQL},
  f.retailer_location_id, f.company_id,
  CASE WHEN event_id % 31 <> 0 THEN (event_id % 180 - 90)::DOUBLE END AS start_latitude,
  CASE WHEN event_id % 31 <> 0 AND event_id % 2 = 0 THEN n_name END AS end_description,
  event_id % 31 = 0 AS no_geo, event_id % 17 = 0 AS no_weather,
  CASE WHEN event_id % 17 <> 0 THEN (100 + event_id % 20)::VARCHAR END AS weather_code,
  CASE WHEN event_id % 17 <> 0 AND event_id % 6 <> 0 THEN (event_id % 90) / 4.0::DOUBLE END
    AS weather_wind
FROM status_trip s JOIN fleet f ON f.internal_id = s.fleet_id WHERE status = 'resolved'""",
    ("status_trip", "fleet"),
)
def conform_trip_score(b: Bed):
    good = conform.accepted(trips(b))
    return good.select(
        *[c for c in good.columns if c not in ("geo", "weather")],
        F.col("geo.startLatitude").alias("start_latitude"),
        F.col("geo.endDescription").alias("end_description"),
        F.col("geo").isNull().alias("no_geo"),
        F.col("weather").isNull().alias("no_weather"),
        F.col("weather.weatherCode").alias("weather_code"),
        F.col("weather.weatherWind").alias("weather_wind"),
    )


@query(
    "reject_trips",
    """SELECT trip_id, driver_id, fleet_id, status, reason FROM status_trip
WHERE status <> 'resolved'""",
    ("status_trip",),
)
def reject_trips(b: Bed):
    columns = ["trip_id", "driver_id", "fleet_id"]
    return conform.rejected(trips(b, columns)).select(
        *columns,
        F.col("_status").alias("status"), F.col("_reason").alias("reason"),
    )


@query(
    "dedup_trips_first",
    """SELECT trip_id, position, overall_score + again AS overall_score FROM landed_trip
WHERE trip_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY trip_id ORDER BY position) = 1""",
    ("landed_trip",),
)
def dedup_trips_first(b: Bed):
    rows = b.raw_trip.select(
        E("nullif(btrim(tripId, ' \\t'), '')").alias("trip_id"), "position",
        E("CAST(trim(overallScore) AS DOUBLE)").alias("overall_score"),
    ).filter("trip_id IS NOT NULL")
    return first_by(rows, ["trip_id"], [F.col("position")])


@query(
    "derive_trip_times",
    f"""SELECT trip_id, start_date_datetime, end_date_datetime,
  ((end_date - start_date) // 1000)::INTEGER AS duration_seconds,
  {", ".join(f"last_{m}_incident_datetime" for m in METRICS)} FROM trip_score""",
    ("trip_score",),
)
def derive_trip_times(b: Bed):
    return b.trip_score.select(
        "trip_id", "start_date_datetime", "end_date_datetime", "duration_seconds",
        *[f"last_{m}_incident_datetime" for m in METRICS],
    )


@query(
    "stamp_daily_scores",
    """SELECT event_id, strftime(ts, '%Y-%m-%d') AS "snapshotDate",
  'GL_REPORT_DATA:' || strftime(ts, '%Y-%m-%d') AS "sourceGroupKey",
  row_number() OVER (PARTITION BY ts::DATE ORDER BY event_id) AS "sourceRowIndex" FROM events""",
)
def stamp_daily_scores(b: Bed):
    rows = b.table("events").select(
        "event_id", F.col("ts").cast("date").alias("day"), E("event_id DIV 100").alias("page")
    )
    return conform.stamp_daily_scores(rows, "day", "page", "event_id").drop("day", "page")


# --- points ---------------------------------------------------------------------------------------

_GOOD_POINT = (
    "l_linenumber <> 7 AND l_tax <> 0.08 AND l_discount <> 0.1 AND l_quantity <> 50"
)
_POINT = """SELECT 'T' || l_orderkey AS trip_id, l_suppkey + 500000 AS account_id,
  epoch_us(l_shipdate) // 1000 AS timestamp_ms, l_quantity AS latitude,
  (l_partkey % 180)::DOUBLE AS longitude"""


def locations(b: Bed):
    return conform.conform_trip_location(b.raw_point)


def incidents(b: Bed):
    return conform.conform_trip_incident(b.raw_point)


@query("conform_trip_location", f"{_POINT} FROM lineitem WHERE {_GOOD_POINT}")
def conform_trip_location(b: Bed):
    return conform.accepted(locations(b))


_GOOD_INCIDENT = f"{_GOOD_POINT} AND NOT (l_linestatus = 'O' AND l_quantity < 5)"


@query(
    "conform_trip_incident",
    f"{_POINT}, l_returnflag AS incident_type FROM lineitem WHERE {_GOOD_INCIDENT}",
)
def conform_trip_incident(b: Bed):
    return conform.accepted(incidents(b))


@query(
    "dedup_locations",
    "SELECT DISTINCT trip_id, account_id, timestamp_ms, latitude, longitude FROM point",
    ("point",),
)
def dedup_locations(b: Bed):
    return conform.dedup_locations(b.trip_location)


@query("dedup_incidents", "SELECT DISTINCT * FROM point", ("point",))
def dedup_incidents(b: Bed):
    return conform.dedup_incidents(b.trip_incident)


# --- accounting -----------------------------------------------------------------------------------


def _status_counts(table: str, entity: str, filtered: bool = True) -> str:
    return f"""SELECT '{entity}' AS entity, count(*) AS total,
  count(*) FILTER (status = 'resolved') AS resolved, count(*) FILTER (status = 'skipped') AS skipped,
  count(*) FILTER (status = 'filtered') AS filtered, count(*) FILTER (status = 'deduped') AS deduped
FROM {table}"""


@query(
    "conversion_summary",
    " UNION ALL ".join(
        [
            _status_counts("status_trip", "trip_scores"),
            _status_counts("status_score", "driver_scores"),
            _status_counts(
                "(SELECT CASE WHEN reason IS NULL THEN 'resolved' ELSE 'skipped' END AS status"
                " FROM judged_driver)",
                "drivers",
            ),
            _status_counts(
                f"(SELECT CASE WHEN {_GOOD_POINT} THEN 'resolved' ELSE 'skipped' END AS status"
                " FROM lineitem)",
                "trip_locations",
            ),
        ]
    ),
    ("status_trip", "status_score", "judged_driver"),
)
def conversion_summary(b: Bed):
    return reports.union_all(
        [
            reports.conversion_counts(
                conform.judge_trip_scores(b.raw_trip, b.fleet, b.known_driver, "position"), "trip_scores", TRIP_KEY
            ),
            reports.conversion_counts(
                conform.judge_driver_scores(b.raw_score, b.fleet, b.known_driver, SNAPSHOT, "position"),
                "driver_scores", DRIVER_SCORE_KEY,
            ),
            reports.conversion_summary(drivers(b), "drivers"),
            reports.conversion_summary(locations(b), "trip_locations"),
        ]
    )


@query(
    "lookup_coverage",
    """SELECT 'fleet' AS lookup, count(*) AS requested, count(f.internal_id) AS resolved,
  count(*) - count(f.internal_id) AS unresolved
FROM (SELECT DISTINCT fleet_id FROM landed_trip WHERE fleet_id IS NOT NULL) k
  LEFT JOIN fleet f ON f.internal_id = k.fleet_id
UNION ALL
SELECT 'driver', count(*), count(k.driver_id), count(*) - count(k.driver_id)
FROM (SELECT DISTINCT driver_id FROM landed_trip WHERE driver_id IS NOT NULL) r
  LEFT JOIN known_driver k USING (driver_id)""",
    ("landed_trip", "fleet", "known_driver"),
)
def lookup_coverage(b: Bed):
    mapped = conform.map_trip_rows(b.raw_trip, "position").select("fleet_id", "driver_id")
    fleets = b.fleet.select(F.col("internal_id").alias("fleet_id"))
    return reports.union_all(
        [
            reports.lookup_coverage(mapped, fleets, "fleet_id", "fleet"),
            reports.lookup_coverage(mapped, b.known_driver, "driver_id", "driver"),
        ]
    )


@query(
    "build_geo_weather",
    """SELECT position, event_id % 31 = 0 AS no_geo, event_id % 17 = 0 AS no_weather,
  CASE WHEN event_id % 31 <> 0 THEN to_json({'startLatitude': (event_id % 180 - 90)::DOUBLE,
    'startLongitude': (event_id % 360 - 180)::DOUBLE, 'startDescription': 'Start ' || event_id,
    'endLatitude': NULL, 'endLongitude': NULL,
    'endDescription': CASE WHEN event_id % 2 = 0 THEN n_name END})::VARCHAR END AS geo,
  CASE WHEN event_id % 17 <> 0 THEN to_json({'weatherCode': (100 + event_id % 20)::VARCHAR,
    'weatherTempLow': (event_id % 40 - 10)::DOUBLE, 'weatherTempHigh': NULL,
    'weatherWind': CASE WHEN event_id % 6 <> 0 THEN (event_id % 90) / 4.0::DOUBLE END})::VARCHAR
    END AS weather
FROM landed_trip""",
    ("landed_trip",),
)
def build_geo_weather(b: Bed):
    from milepost.functions.jsontext import to_json_text

    rows = conform.map_trip_rows(b.raw_trip, "position").select(
        F.col("_position").alias("position"), "geo", "weather"
    )
    return rows.select(
        "position",
        F.col("geo").isNull().alias("no_geo"),
        F.col("weather").isNull().alias("no_weather"),
        to_json_text(F.col("geo")).alias("geo"),
        to_json_text(F.col("weather")).alias("weather"),
    )
