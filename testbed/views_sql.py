"""DuckDB side of the derived tables, as common table expressions."""

from __future__ import annotations

from milepost.schemas import METRICS

_SCORES = ",\n  ".join(
    f"CASE WHEN (event_id + {i}) % 13 <> 0 THEN 40 + (event_id * ({i} + 5)) % 61"
    f" + 0.25::DOUBLE * ((event_id + {i}) % 4) END AS {m}_score,"
    f" CASE WHEN (event_id + {i}) % 7 <> 0 THEN ((event_id * ({i} + 3)) % 5)::DOUBLE END"
    f" AS {m}_incidents,"
    f" epoch_us(ts) // 1000 - {i} * 60000 AS last_{m}_incident"
    for i, m in enumerate(METRICS)
)
_MS = "make_timestamp(({}) * 1000)"
_LAST_TIMES = ", ".join(
    f"{_MS.format(f'last_{m}_incident')} AS last_{m}_incident_datetime" for m in METRICS
)
_METRIC_NAMES = ", ".join(
    [f"{m}_score" for m in METRICS]
    + [f"{m}_incidents" for m in METRICS]
    + [f"last_{m}_incident" for m in METRICS]
)

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "company": ((), "SELECT r_regionkey::BIGINT AS id, r_name AS company_name FROM region"),
    "subscription": (
        (),
        "SELECT r_regionkey::BIGINT AS id, CASE WHEN r_regionkey = 0 THEN 'Mobile App'"
        " ELSE 'Other' END AS subscription_name FROM region WHERE r_name IN ('AFRICA', 'AMERICA')",
    ),
    "company_subscription": (
        (),
        "SELECT n_regionkey::BIGINT AS company_id, CASE WHEN n_regionkey IN (0, 1, 3)"
        " THEN s_suppkey % 2 ELSE 1 END AS subscription_id"
        " FROM supplier JOIN nation ON s_nationkey = n_nationkey",
    ),
    "eligible": (
        ("subscription", "company_subscription"),
        "SELECT DISTINCT company_id FROM company_subscription WHERE subscription_id ="
        " (SELECT min(id) FROM subscription WHERE subscription_name = 'Mobile App')",
    ),
    # location claimed by each company that holds a readable account id
    "claim": (
        (),
        "SELECT c_custkey AS company_id, 1000 + (c_custkey * 3) // 5 AS retailer_location_id"
        " FROM customer WHERE c_acctbal > 0 AND c_mktsegment <> 'FURNITURE'",
    ),
    "company_of": (
        ("claim",),
        "SELECT retailer_location_id, min(company_id) AS company_id,"
        " count(*) - 1 AS conflicting_companies FROM claim GROUP BY 1",
    ),
    "fleet": (
        (),
        "SELECT (n_nationkey + 1000)::BIGINT AS retailer_location_id,"
        " 'fleet_' || n_nationkey AS internal_id, n_name AS name,"
        " n_regionkey::BIGINT AS company_id, n_nationkey % 7 <> 6 AS active FROM nation",
    ),
    "site": (
        (),
        "SELECT p_partkey + 1000 AS retailer_location_id, 'site_' || p_partkey AS internal_id,"
        " p_name AS name, (p_size % 5)::BIGINT AS company_id, p_size > 8 AS active FROM part",
    ),
    "app_user": (
        (),
        "SELECT c_custkey AS id, lower(c_name) || '@x.test' AS email,"
        " CASE WHEN c_custkey % 5 = 0 THEN '  ' WHEN c_custkey % 5 = 1 THEN NULL ELSE c_name END"
        " AS display_name, CASE WHEN c_custkey % 10 <> 6 THEN c_mktsegment END AS first_name,"
        " c_name AS last_name, 'D' || c_custkey AS focus_id, c_acctbal > 0 AS is_active,"
        " c_custkey % 17 = 0 AS deleted FROM customer WHERE c_acctbal > -500",
    ),
    "driver": (
        (),
        "SELECT 'D' || c_custkey AS driver_id, c_custkey + 500000 AS account_id,"
        " c_custkey AS user_id, (c_nationkey + 1000)::BIGINT AS retailer_location_id,"
        " CASE WHEN c_custkey % 4 = 0 THEN 'D' || c_custkey END AS focus_driver_id,"
        " CASE WHEN c_custkey % 3 = 0 THEN upper(c_name || '@x.test') END AS contact_email"
        " FROM customer",
    ),
    "known_driver": (
        (),
        "SELECT 'D' || c_custkey AS driver_id FROM customer WHERE c_mktsegment <> 'FURNITURE'",
    ),
    "event": (
        (),
        f"""SELECT event_id, ts, user_id, event_type, value, c_mktsegment, c_nationkey, n_name,
  n_regionkey, epoch_us(ts) // 1000 AS end_date,
  epoch_us(ts) // 1000 - ((5 + event_id % 55) * 60000 + event_id % 1000) AS start_date,
  CASE WHEN event_id % 19 <> 0 THEN json_extract_string(props, '$.k')::BIGINT * 1000
    + event_id % 1000 END AS distance_meters,
  CASE WHEN event_id % 11 <> 0 THEN 50 + (event_id * 37) % 51 + 0.25::DOUBLE * (event_id % 4) END
    AS overall_score,
  {_SCORES}
FROM events JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    ),
    "trip_score": (
        ("event",),
        f"""SELECT event_id, 'T' || event_id AS trip_id, 'D' || user_id AS driver_id, user_id,
  user_id + 500000 AS account_id, 'fleet_' || c_nationkey AS fleet_id, n_name AS fleet_name,
  n_regionkey::BIGINT AS company_id, (c_nationkey + 1000)::BIGINT AS retailer_location_id,
  CASE event_id % 3 WHEN 0 THEN '  ' WHEN 1 THEN ' Name ' || user_id || ' ' END AS driver_name,
  event_type AS trip_type, distance_meters, start_date, end_date, overall_score,
  {_METRIC_NAMES},
  {_MS.format('start_date')} AS start_date_datetime, {_MS.format('end_date')} AS end_date_datetime,
  {_LAST_TIMES}, n_name
FROM event""",
    ),
    "driver_score": (
        ("trip_score",),
        "SELECT end_date_datetime::DATE AS snapshot_date, fleet_id, driver_id, account_id,"
        " company_id, retailer_location_id, fleet_name,"
        " sum(distance_meters)::BIGINT AS distance_meters, avg(overall_score) AS overall_score"
        " FROM trip_score GROUP BY ALL",
    ),
    "point": (
        (),
        "SELECT 'T' || l_orderkey AS trip_id, l_suppkey + 500000 AS account_id,"
        " epoch_us(l_shipdate) // 1000 AS timestamp_ms, l_quantity AS latitude,"
        " (l_partkey % 180)::DOUBLE AS longitude, l_returnflag AS incident_type FROM lineitem",
    ),
    # trip rows as landed, already classified: what each row should turn into
    "landed_trip": (
        ("event", "known_driver"),
        f"""SELECT e.event_id * 2 + again AS position, e.*, again,
  CASE WHEN e.event_id % 97 <> 5 THEN 'T' || e.event_id END AS trip_id,
  CASE WHEN e.event_id % 53 = 3 THEN NULL
       WHEN e.event_id % 2 = 1 THEN 'D' || user_id
       WHEN e.event_id % 59 <> 4 THEN 'D' || user_id END AS driver_id,
  CASE WHEN e.event_id % 83 <> 1 THEN start_date END AS start_ms,
  CASE WHEN e.event_id % 89 = 7 THEN start_date - 1 ELSE end_date END AS end_ms,
  CASE WHEN e.event_id % 71 = 2 THEN 'fleet_none' WHEN e.event_id % 73 = 8 THEN NULL
       ELSE 'fleet_' || c_nationkey END AS fleet_id,
  c_mktsegment <> 'FURNITURE' AS is_known
FROM event e CROSS JOIN (VALUES (0), (1)) v(again)
WHERE again = 0 OR event_type = 'purchase'""",
    ),
    "judged_trip": (
        ("landed_trip",),
        """SELECT *, CASE
    WHEN trip_id IS NULL OR driver_id IS NULL THEN 'missing_trip_id_or_driver_id'
    WHEN NOT is_known THEN 'unknown_driver'
    WHEN start_ms IS NULL THEN 'missing_trip_window'
    WHEN end_ms < start_ms THEN 'invalid_trip_window'
    WHEN fleet_id IS NULL OR fleet_id = 'fleet_none' THEN 'unresolved_company'
  END AS problem FROM landed_trip""",
    ),
    "status_trip": (
        ("judged_trip",),
        """SELECT *, coalesce(problem, CASE WHEN rn > 1 THEN 'duplicate_key' END) AS reason,
  CASE WHEN problem = 'unknown_driver' THEN 'filtered' WHEN problem IS NOT NULL THEN 'skipped'
       WHEN rn > 1 THEN 'deduped' ELSE 'resolved' END AS status
FROM (SELECT *, row_number() OVER (PARTITION BY problem, trip_id ORDER BY position) AS rn
      FROM judged_trip)""",
    ),
    "judged_score": (
        ("event",),
        """SELECT *, CASE
    WHEN driver_id IS NULL THEN 'missing_driver_id'
    WHEN c_mktsegment = 'FURNITURE' THEN 'unknown_driver'
    WHEN row_index IS NULL THEN 'missing_row_index'
    WHEN fleet_id IS NULL THEN 'missing_fleet'
    WHEN fleet_id = 'fleet_none' THEN 'unresolved_company' END AS problem
FROM (SELECT *, event_id + 1 AS position,
  CASE WHEN event_id % 53 = 3 THEN NULL WHEN event_id % 2 = 1 OR event_id % 59 <> 4
       THEN 'D' || user_id END AS driver_id,
  CASE WHEN event_id % 71 = 2 THEN 'fleet_none' WHEN event_id % 73 = 8 THEN NULL
       ELSE 'fleet_' || c_nationkey END AS fleet_id,
  CASE WHEN event_id % 9 < 2 THEN DATE '2024-02-01' ELSE ts::DATE END AS snapshot_date,
  CASE WHEN event_id % 3 = 0 THEN 'day' ELSE 'GL_REPORT_DATA' END AS source_group_key,
  CASE WHEN event_id % 91 = 6 THEN NULL WHEN event_id % 3 = 1 THEN 7 ELSE event_id + 1 END
    AS row_index
  FROM event)""",
    ),
    "status_score": (
        ("judged_score",),
        """SELECT *, coalesce(problem, CASE WHEN rn > 1 THEN 'duplicate_key' END) AS reason,
  CASE WHEN problem = 'unknown_driver' THEN 'filtered' WHEN problem IS NOT NULL THEN 'skipped'
       WHEN rn > 1 THEN 'deduped' ELSE 'resolved' END AS status
FROM (SELECT *, row_number() OVER (PARTITION BY problem, snapshot_date, fleet_id, driver_id
                                   ORDER BY position DESC) AS rn FROM judged_score)""",
    ),
    # drivers as landed, with what should be found for each
    "landed_driver": (
        (),
        """SELECT c.*, c_custkey AS position,
  CASE WHEN c_custkey % 23 <> 0 THEN 'D' || (c_custkey - c_custkey % 2) END AS blob_id,
  CASE WHEN c_custkey % 4 = 0 THEN 'D' || c_custkey END AS focus_id,
  CASE WHEN c_custkey % 5 = 0 THEN upper(c_name) || '@X.test'
       WHEN c_custkey % 7 <= 3 THEN lower(c_name) || '@x.test' END AS contact_email,
  CASE WHEN c_acctbal > -500 AND (c_custkey % 4 = 0 OR c_custkey % 5 = 0 OR c_custkey % 7 <= 3)
       THEN c_custkey END AS user_id
FROM customer c""",
    ),
    "judged_driver": (
        ("landed_driver",),
        """SELECT *, CASE
    WHEN user_id IS NULL AND focus_id IS NULL AND contact_email IS NULL THEN 'no_driver_identity'
    WHEN user_id IS NULL THEN 'user_not_found'
    WHEN blob_id IS NULL THEN 'missing_driver_id' END AS reason FROM landed_driver""",
    ),
    "found_fleet": (
        (),
        """SELECT p_partkey, p_name, p_size % 5 AS shape,
  CASE p_size % 5 WHEN 0 THEN 'site_' || p_partkey WHEN 1 THEN (p_partkey + 1000)::VARCHAR
    WHEN 2 THEN 'new_' || p_partkey WHEN 3 THEN (p_partkey + 1000)::VARCHAR
    ELSE '{"display":"' || p_name || '","zone":' || p_partkey || '}' END AS internal_id,
  CASE p_size % 5 WHEN 3 THEN (p_partkey + 1000)::VARCHAR ELSE p_name END AS name,
  CASE WHEN p_size % 5 <> 4 THEN p_partkey + 1000 END AS retailer_location_id
FROM part""",
    ),
    "reconciled": (
        ("found_fleet", "company_of"),
        """SELECT f.*, c.company_id, CASE WHEN shape = 0 THEN 'known'
    WHEN c.company_id IS NULL THEN 'pending' ELSE 'insertable' END AS outcome
FROM found_fleet f LEFT JOIN company_of c USING (retailer_location_id)""",
    ),
}

# exact half-up rounding of meters to miles and of means, as doubles
MILES = "((({0})::HUGEINT * 2000000 + 1609344) // (2 * 1609344))::DOUBLE / 1000.0"
MEAN = "round(coalesce({0}, 0)::DECIMAL(30,12), 3)::DOUBLE"
# mean of three-place values: exact, by whole thousandths
MEAN3 = (
    "((2 * sum(round({0} * 1000)::HUGEINT) + count(*)) // (2 * count(*)))::DOUBLE / 1000.0"
)

_BUCKET = """CASE WHEN n_dist > 0 AND meters < 80467 THEN 'Low distance'
    WHEN coalesce(mean_score, 0) >= 90 THEN 'Excellent'
    WHEN coalesce(mean_score, 0) >= 72 THEN 'Fair' ELSE 'Risky' END"""

VIEWS["trip_day"] = (
    ("trip_score", "eligible", "company", "driver", "app_user"),
    f"""SELECT t.company_id, c.company_name, t.retailer_location_id, t.fleet_id AS fleet_internal_id,
  t.fleet_name, t.driver_id, t.account_id AS driver_account_id, d.user_id, u.email AS user_email,
  t.end_date_datetime::DATE AS reporting_day, count(*) AS trip_count,
  count(distance_meters) AS n_dist, count(overall_score) AS n_score,
  sum(distance_meters)::BIGINT AS meters, avg(overall_score) AS mean_score,
  min(start_date_datetime) AS first_trip_start_datetime,
  max(end_date_datetime) AS last_trip_end_datetime,
  {", ".join(f"sum(coalesce({m}_incidents, 0)) AS inc_{m}, count({m}_score) AS n_{m},"
             f" avg({m}_score) AS mean_{m}" for m in METRICS)}
FROM trip_score t JOIN eligible USING (company_id) JOIN company c ON c.id = t.company_id
  JOIN driver d ON d.driver_id = t.driver_id JOIN app_user u ON u.id = d.user_id
WHERE t.end_date_datetime IS NOT NULL
GROUP BY ALL""",
)
VIEWS["trip_day_rollup"] = (
    ("trip_day",),
    f"""SELECT company_id, company_name, retailer_location_id, fleet_internal_id, fleet_name,
  driver_id, driver_account_id, user_id, user_email, reporting_day, trip_count,
  n_dist AS distance_sample_count, n_score AS score_sample_count,
  coalesce(meters, 0) AS total_distance_meters,
  {MILES.format('coalesce(meters, 0)')} AS total_distance_miles,
  {MEAN.format('mean_score')} AS average_overall_score,
  first_trip_start_datetime, last_trip_end_datetime, {_BUCKET} AS performance_bucket
FROM trip_day""",
)
VIEWS["trip_event_day_rollup"] = (
    ("trip_day",),
    f"""SELECT company_id, company_name, retailer_location_id, fleet_internal_id, fleet_name,
  driver_id, driver_account_id, user_id, user_email, reporting_day, trip_count,
  n_dist AS distance_sample_count, n_score AS score_sample_count,
  coalesce(meters, 0) AS total_distance_meters,
  {MILES.format('coalesce(meters, 0)')} AS total_distance_miles,
  {MEAN.format('mean_score')} AS average_overall_score,
  {", ".join(f"inc_{m}::BIGINT AS total_{m}_incidents, n_{m} AS {m}_score_sample_count,"
             f" {MEAN.format(f'mean_{m}')} AS average_{m}_score" for m in METRICS)},
  ({" + ".join(f"inc_{m}" for m in METRICS)})::BIGINT AS total_event_incidents,
  first_trip_start_datetime, last_trip_end_datetime
FROM trip_day""",
)
_FLEET_DAY = (
    "company_id, company_name, retailer_location_id, fleet_internal_id, fleet_name, reporting_day"
)
VIEWS["performance_groups"] = (
    ("trip_day_rollup",),
    f"""SELECT {_FLEET_DAY}, performance_bucket, count(*) AS driver_day_count,
  sum(trip_count)::BIGINT AS total_trip_count,
  sum(total_distance_meters)::BIGINT AS total_distance_meters,
  {MILES.format('sum(total_distance_meters)')} AS total_distance_miles,
  {MEAN3.format('average_overall_score')} AS average_daily_overall_score
FROM trip_day_rollup GROUP BY {_FLEET_DAY}, performance_bucket""",
)
VIEWS["trip_event_groups"] = (
    ("trip_event_day_rollup",),
    f"""SELECT {_FLEET_DAY}, count(*) AS driver_day_count,
  sum(trip_count)::BIGINT AS total_trip_count,
  sum(distance_sample_count)::BIGINT AS distance_sample_count,
  sum(score_sample_count)::BIGINT AS score_sample_count,
  sum(total_distance_meters)::BIGINT AS total_distance_meters,
  {MILES.format('sum(total_distance_meters)')} AS total_distance_miles,
  {MEAN3.format('average_overall_score')} AS average_daily_overall_score,
  {", ".join(f"sum(total_{m}_incidents)::BIGINT AS total_{m}_incidents,"
             f" sum({m}_score_sample_count)::BIGINT AS {m}_score_sample_count,"
             f" {MEAN3.format(f'average_{m}_score')} AS average_daily_{m}_score"
             for m in METRICS)},
  sum(total_event_incidents)::BIGINT AS total_event_incidents
FROM trip_event_day_rollup GROUP BY {_FLEET_DAY}""",
)
VIEWS["driver_trip_list"] = (
    ("trip_score", "eligible", "driver", "app_user"),
    f"""SELECT t.company_id, t.driver_id, t.account_id AS driver_account_id,
  CASE WHEN trim(t.driver_name) <> '' THEN trim(t.driver_name)
       WHEN trim(u.display_name) <> '' THEN trim(u.display_name)
       WHEN trim(concat_ws(' ', u.first_name, u.last_name)) <> ''
       THEN trim(concat_ws(' ', u.first_name, u.last_name)) END AS driver_display_name,
  t.fleet_id AS fleet_internal_id, t.fleet_name, t.trip_id, t.start_date_datetime,
  t.end_date_datetime, {MILES.format('coalesce(distance_meters, 0)')} AS distance_miles,
  ((2 * (end_date - start_date) + 60) // 120)::DOUBLE / 1000.0 AS duration_minutes,
  overall_score,
  {", ".join(f"coalesce({m}_incidents, 0)::BIGINT AS {m}_incidents" for m in METRICS)},
  ({" + ".join(f"coalesce({m}_incidents, 0)" for m in METRICS)})::BIGINT
    AS total_event_incidents,
  {", ".join(f"{m}_score" for m in METRICS)},
  CASE WHEN coalesce(overall_score, 0) >= 90 THEN 'Excellent'
       WHEN coalesce(overall_score, 0) >= 72 THEN 'Fair' ELSE 'Risky' END AS performance_class,
  CASE WHEN event_id % 31 <> 0 THEN 'Start ' || event_id END AS geo_start_description,
  CASE WHEN event_id % 31 <> 0 AND event_id % 2 = 0 THEN n_name END AS geo_end_description,
  CASE WHEN event_id % 17 <> 0 AND event_id % 6 <> 0 THEN (event_id % 90) / 4.0::DOUBLE END
    AS weather_wind,
  CASE WHEN event_id % 17 <> 0 THEN (event_id % 40 - 10)::DOUBLE END AS weather_temp_low,
  CASE WHEN event_id % 17 <> 0 THEN (event_id % 40 - 5)::DOUBLE END AS weather_temp_high,
  {", ".join(f"last_{m}_incident_datetime" for m in METRICS)}
FROM trip_score t JOIN eligible USING (company_id) JOIN driver d ON d.driver_id = t.driver_id
  LEFT JOIN app_user u ON u.id = d.user_id
WHERE t.end_date_datetime IS NOT NULL""",
)


def with_views(body: str, *names: str) -> str:
    """``body`` preceded by the definitions it needs, dependencies first."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for dependency in VIEWS[name][0]:
            visit(dependency)
        ordered.append(name)

    for name in names:
        visit(name)
    if not ordered:
        return body
    ctes = ",\n".join(f"{n} AS (\n{VIEWS[n][1]}\n)" for n in ordered)
    if body.startswith("WITH "):
        return f"WITH {ctes},\n{body.removeprefix('WITH ')}"
    return f"WITH {ctes}\n{body}"
