"""Sources, sinks, merges, quality rules, windows and whole loads."""

from __future__ import annotations

from datetime import datetime, timedelta
from typing import Any

from pyspark.sql import functions as F

from milepost.operators import conform, merge, quality, reports, rollups
from milepost.operators.lookups import trips_in_window
from milepost.plans import daily, maintenance, pipeline, purge, tables, windows
from milepost.schemas import (
    INCIDENT_KEY, LANDED, LOCATION_KEY, ROLLUP_KEYS, TRIP_KEY,
)
from milepost.session import cut_lineage, scratch_dir
from milepost.sources import entity, exports, pages, runs
from milepost.streaming import landing
from testbed.conform_queries import drivers as conformed_drivers
from testbed.conform_queries import trips as conformed_trips
from testbed.registry import query
from testbed.rollup_queries import (
    day_rollup, eligible, event_rollup, reconciled, trip_list,
)
from testbed.views import LANDED_FILES, Bed

E = F.expr

# --- sources --------------------------------------------------------------------------------------


@query(
    "flatten_grouped_payload",
    """SELECT o_orderkey // 50 AS page, 'T' || o_orderkey AS "tripId", CASE
    WHEN o_orderstatus = 'P' THEN 'own' WHEN (o_orderkey // 50) % 4 = 0 THEN NULL
    WHEN o_orderpriority = '5-LOW' THEN 'GL_TRIP_DATA' ELSE o_orderpriority END AS "sourceGroupKey",
  row_number() OVER (PARTITION BY o_orderkey // 50,
    CASE WHEN (o_orderkey // 50) % 4 <> 0 THEN o_orderpriority END ORDER BY o_orderkey) - 1
    AS row_index,
  CASE WHEN o_orderstatus <> 'P' THEN o_custkey::VARCHAR END AS "accountId"
FROM orders""",
)
def flatten_grouped_payload(b: Bed):
    rows = entity.rows_of_documents(b.grouped_document, "trip_scores")
    return rows.select(
        "page", "tripId", "sourceGroupKey", F.col("row_index").cast("bigint").alias("row_index"),
        "accountId",
    )


_PAGE = "o_orderkey // 50"


@query(
    "explode_report_pages",
    f"""SELECT {_PAGE} AS page, row_number() OVER (PARTITION BY {_PAGE} ORDER BY o_orderkey) - 1
    AS row_index, 'T' || o_orderkey AS trip_id, ({_PAGE}) % 2 = 0 AS has_more,
  NULL::VARCHAR AS error FROM orders WHERE ({_PAGE}) % 10 < 8
UNION ALL SELECT DISTINCT {_PAGE}, NULL, NULL, NULL, CASE ({_PAGE}) % 10
  WHEN 9 THEN 'denied (errorCode=E7)' ELSE 'Reporting API returned an invalid response' END
FROM orders WHERE ({_PAGE}) % 10 >= 8""",
)
def explode_report_pages(b: Bed):
    rows, errors = pages.explode_pages(b.report_page)
    good = rows.select(
        "page", F.col("row_index").cast("bigint").alias("row_index"),
        F.get_json_object("row_json", "$.tripId").alias("trip_id"), "has_more",
    )
    return reports.union_all([good, errors])


@query(
    "explode_search_pages",
    f"""SELECT {_PAGE} AS page, row_number() OVER (PARTITION BY {_PAGE} ORDER BY o_orderkey) - 1
    AS row_index, 'T' || o_orderkey AS trip_id, NULL::VARCHAR AS error
FROM orders WHERE ({_PAGE}) % 7 < 6
UNION ALL SELECT DISTINCT {_PAGE}, NULL, NULL, 'missing fleet list' FROM orders
WHERE ({_PAGE}) % 7 = 6""",
)
def explode_search_pages(b: Bed):
    rows, errors = pages.explode_search(b.search_page)
    good = rows.select(
        "page", F.col("row_index").cast("bigint").alias("row_index"),
        F.get_json_object("row_json", "$.tripId").alias("trip_id"),
    )
    return reports.union_all([good, errors])


@query(
    "latest_run_per_fleet",
    """SELECT o_custkey + 1000 AS fleet_id,
  strftime(o_orderdate, '%Y-%m-%d_%H-%M-%S') || '_UTC' AS run_ts, 'T' || o_orderkey AS trip_id
FROM orders QUALIFY rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC) = 1""",
)
def latest_run_per_fleet(b: Bed):
    return runs.latest_run(b.run_row)


@query(
    "latest_run_files",
    """SELECT o_custkey % 25 + 1000 AS fleet_id, strftime(o_orderdate, '%Y') AS run_ts,
  'T' || o_orderkey AS trip_id FROM orders WHERE o_orderkey % 9 > 0
QUALIFY rank() OVER (PARTITION BY o_custkey % 25 ORDER BY strftime(o_orderdate, '%Y') DESC) = 1""",
)
def latest_run_files(b: Bed):
    """Yearly runs of each fleet landed as JSON; the latest are found by their folders' names."""
    path = scratch_dir(b.spark, "runs")
    rows = b.table("orders").filter("o_orderkey % 9 > 0").select(
        E("o_custkey % 25 + 1000 AS fleet_id"), E("date_format(o_orderdate, 'yyyy') AS run_ts"),
        E("concat('T', o_orderkey) AS trip_id"),
    )
    exports.write_json(rows.repartition("run_ts"), path)
    return runs.read_latest_run(b.spark, path, rows.schema)


@query(
    "read_entity_json",
    """SELECT 'row' AS kind, (c_custkey + 500000)::VARCHAR AS account_id, lower(c_name) AS username,
  CASE WHEN c_custkey % 7 <= 3 THEN lower(c_name) || '@x.test' END AS nested_email,
  NULL::VARCHAR AS content FROM customer
UNION ALL SELECT 'not_an_object', NULL, NULL, NULL, c_custkey::VARCHAR FROM customer
UNION ALL SELECT 'not_json', NULL, NULL, NULL, '{' || c_name FROM customer""",
)
def read_entity_json(b: Bed):
    """Driver documents (one list per line) written to the shared folder and read back."""
    path = scratch_dir(b.spark, "landed-drivers")
    names = LANDED["drivers"].fieldNames()
    nested = ["contact", "appInfo", "locations", "focus_data", "employer"]
    plain_json = F.to_json(F.struct(*[n for n in names if n not in nested]))
    members = [F.lit("")] + [
        F.when(F.col(n).isNotNull(), F.concat(F.lit(f',"{n}":'), F.col(n))) for n in nested
    ]
    row = F.concat(F.expr("'{'"), plain_json.substr(F.lit(2), F.length(plain_json) - 2),
                   F.concat_ws("", *members), F.lit("}"))
    good = b.raw_driver.select(F.concat(F.lit("["), row, F.lit(","), "position", F.lit("]")))
    bad = b.table("customer").select(F.concat(F.lit("{"), "c_name"))
    good.union(bad).write.text(path)
    rows, quarantine = entity.read_entity(b.spark, path, "drivers", layout="lines")
    return reports.union_all(
        [
            rows.select(
                F.lit("row").alias("kind"), F.col("accountId").alias("account_id"), "username",
                F.get_json_object("contact", "$.contactInfo.emailAddress").alias("nested_email"),
            ),
            quarantine.select(F.col("reason").alias("kind"), "content"),
        ]
    )


@query(
    "union_batches",
    """SELECT trip_id, driver_id, distance_meters, overall_score, NULL::VARCHAR AS batch_note
FROM trip_score WHERE event_type_is_view
UNION ALL SELECT trip_id, NULL, distance_meters, NULL, 'late' FROM trip_score
WHERE NOT event_type_is_view""".replace("event_type_is_view", "trip_type = 'view'"),
    ("trip_score",),
)
def union_batches(b: Bed):
    first = b.trip_score.filter("trip_type = 'view'").select(
        "trip_id", "driver_id", "distance_meters", "overall_score"
    )
    second = b.trip_score.filter("trip_type <> 'view'").select(
        "distance_meters", "trip_id", F.lit("late").alias("batch_note")
    )
    return reports.union_all([first, second])


# --- sinks and exports ----------------------------------------------------------------------------


@query(
    "json_roundtrip",
    """SELECT o_custkey % 25 + 1000 AS fleet_id, strftime(o_orderdate, '%Y') AS run_ts,
  'T' || o_orderkey AS trip_id, CASE WHEN o_orderstatus <> 'O' THEN o_orderstatus END AS status,
  o_totalprice AS price, o_orderpriority AS first_tag FROM orders""",
)
def json_roundtrip(b: Bed):
    path = scratch_dir(b.spark, "json")
    rows = b.table("orders").select(
        E("o_custkey % 25 + 1000 AS fleet_id"),
        E("date_format(o_orderdate, 'yyyy') AS run_ts"),
        E("concat('T', o_orderkey) AS trip_id"),
        F.struct(
            E("CASE WHEN o_orderstatus <> 'O' THEN o_orderstatus END").alias("status"),
            F.col("o_totalprice").alias("price"),
            F.array("o_orderpriority").alias("tags"),
        ).alias("detail"),
    )
    exports.write_json(rows.hint("rebalance", F.col("run_ts")), path)
    read = exports.read_json(b.spark, path, rows.schema)
    return read.select(
        "fleet_id", "run_ts", "trip_id", "detail.status", "detail.price",
        F.col("detail.tags")[0].alias("first_tag"),
    )


_EXPORT_FLEET = """SELECT ' ' || (p_partkey + 1000) || ' ' AS retailer_location_id,
  'site_' || p_partkey AS internal_id, p_name AS name, p_type AS location_type,
  CASE p_size % 3 WHEN 0 THEN 'yes' WHEN 1 THEN 'false' ELSE 'maybe' END AS public_location,
  'https://qr.test/' || p_partkey AS qr_code_url, NULL::VARCHAR AS location_token,
  (p_size > 8)::VARCHAR AS active,
  CASE WHEN p_size = 50 THEN 'north' ELSE (p_size * 3.25 - 80)::DECIMAL(9,2)::VARCHAR END
    AS latitude, (p_partkey % 360 - 180.5)::VARCHAR AS longitude,
  '{"id":' || p_partkey || '}' AS manager, '["' || p_brand || '"]' AS categories,
  NULL::VARCHAR AS filters, '{}' AS billable_entity,
  '{"name":"' || p_name || '","n":null}' AS retailer, '[]' AS offers,
  CASE p_size % 4 WHEN 0 THEN '' WHEN 1 THEN p_name WHEN 2 THEN '{"size":' || p_size || '}' END
    AS meta_data, '{"contactInfo":{}}' AS contact,
  '{"favorite":' || (p_size % 2 = 0)::VARCHAR || ',"favoriteCount":' || p_size
    || ',"noteCount":null,"sharedCount":' || p_size
    || ',"likeCount":null,"dislikeCount":0,"hasRatings":null}' AS stats
FROM part"""


@query("export_fleet", _EXPORT_FLEET)
def export_fleet(b: Bed):
    return exports.export_fleet(b.raw_fleet)


@query(
    "export_drivers",
    """SELECT (c_custkey + 500000)::VARCHAR AS account_id, blob_id AS driver_id,
  CASE WHEN c_custkey % 6 <> 0 THEN (c_nationkey + 1000)::VARCHAR END AS retailer_location_id,
  lower(c_name) AS username,
  CASE WHEN c_custkey % 5 = 0 THEN ' ' || upper(c_name) || '@X.test '
       WHEN c_custkey % 7 <= 3 THEN lower(c_name) || '@x.test' END AS contact_email,
  blob_id AS app_blob_driver_id,
  CASE WHEN c_custkey % 23 <> 0 THEN c_nationkey::VARCHAR END AS app_blob_work_shift_audience_id,
  CASE WHEN c_custkey % 23 <> 0 THEN 'a;' || c_nationkey || ';' ELSE '' END
    AS app_blob_additional_services
FROM landed_driver""",
    ("landed_driver",),
)
def export_drivers(b: Bed):
    return exports.export_drivers(b.raw_driver).select(
        "account_id", "driver_id", "retailer_location_id", "username", "contact_email",
        "app_blob_driver_id", "app_blob_work_shift_audience_id", "app_blob_additional_services",
    )


@query(
    "export_scores_columns",
    """SELECT position, CASE WHEN event_id % 53 = 3 THEN '   ' WHEN event_id % 2 = 0 THEN ''
    ELSE 'D' || user_id END AS "driverId", n_name AS "fleetName", start_ms::VARCHAR AS "startDate",
  strftime(make_timestamp(start_ms * 1000), '%Y-%m-%d %H:%M:%S') AS "startDateDatetime",
  strftime(make_timestamp(last_turn_incident * 1000), '%Y-%m-%d %H:%M:%S')
    AS "lastTurnIncidentDatetime",
  'driverId,driverName,fleetId,fleetName,thirdPartyId,accountId,position,tripId' AS leading_columns
FROM landed_trip""",
    ("landed_trip",),
)
def export_scores_columns(b: Bed):
    out = exports.export_rows(b.raw_trip, exports.SCORE_LEAD, readable_times=True)
    return out.select(
        "position", "driverId", "fleetName", "startDate", "startDateDatetime",
        "lastTurnIncidentDatetime", F.lit(",".join(out.columns[:8])).alias("leading_columns"),
    )


@query(
    "export_landed_columns",
    """SELECT 'T' || o_orderkey AS "tripId", o_custkey::VARCHAR AS "accountId",
  CASE WHEN o_orderkey % 2 = 1 THEN (o_orderkey * 1000)::VARCHAR END AS "timestamp",
  CASE WHEN o_orderkey % 2 = 0 THEN (o_orderkey % 90)::VARCHAR END AS speed,
  CASE WHEN o_orderkey % 2 = 0 THEN '{"code":' || o_orderkey % 7 || ',"tags":["' || o_orderstatus || '"]}' END AS extra,
  CASE WHEN o_orderkey % 3 = 1 THEN o_orderpriority END AS heading,
  CASE WHEN o_orderkey % 2 = 1 THEN o_orderstatus END AS position,
  'tripId,accountId,timestamp,speed,extra,heading,position' AS column_order FROM orders""",
)
def export_landed_columns(b: Bed):
    """Two landed batches whose rows have different members, some of them in no schema: all are exported."""
    o, path = b.table("orders"), scratch_dir(b.spark, "landed-batches")
    trip, account = E("concat('T', o_orderkey) AS tripId"), E("CAST(o_custkey AS STRING) AS accountId")
    heading = E("CASE WHEN o_orderkey % 3 = 1 THEN o_orderpriority END AS heading")
    first = F.struct(
        trip, E("o_orderkey % 90 AS speed"), account,
        E("named_struct('code', o_orderkey % 7, 'tags', array(o_orderstatus)) AS extra"), heading,
    )
    second = F.struct(
        heading, trip, E("o_orderstatus AS position"), account, E("CAST(o_orderkey * 1000 AS STRING) AS timestamp")
    )
    batches = []
    for number, (rows, row) in enumerate(((o.filter("o_orderkey % 2 = 0"), first), (o.filter("o_orderkey % 2 = 1"), second))):
        rows.select(F.to_json(row)).write.text(f"{path}/batch_{number}")
        batches.append(
            entity.read_entity(b.spark, f"{path}/batch_{number}", "trip_locations", layout="rows", more=True)[0]
        )
    out = exports.export_landed(reports.union_all(batches), "trip_locations", exports.LOCATION_LEAD)
    return out.withColumn("column_order", F.lit(",".join(out.columns)))


@query(
    "replay_exports",
    """SELECT 'fleet' AS export, 'site_' || p_partkey AS key, p_name AS label,
  CASE p_size % 4 WHEN 1 THEN p_name WHEN 2 THEN '{"size":' || p_size || '}' END AS detail FROM part
UNION ALL SELECT 'drivers', (c_custkey + 500000)::VARCHAR, lower(c_name),
  CASE WHEN c_custkey % 23 <> 0 THEN 'D' || (c_custkey - c_custkey % 2) END FROM customer""",
)
def replay_exports(b: Bed):
    """Lands fleets and drivers as JSON, rebuilds the CSV exports and reads those back."""
    run, out = scratch_dir(b.spark, "run"), scratch_dir(b.spark, "exports")
    for name, df in (("fleet", b.raw_fleet), ("drivers", b.raw_driver.drop("position"))):
        row = F.to_json(F.struct("*"))
        payload = row if name == "fleet" else F.concat(F.lit("["), row, F.lit("]"))
        df.select(payload).write.text(f"{run}/{name}")
    exports.replay_exports(b.spark, run, out, layout="lines")
    read = b.spark.read.options(**exports.CSV_OPTIONS).option("multiLine", "true")
    fleet = read.csv(f"{out}/fleet").select(
        F.lit("fleet").alias("export"), F.col("internal_id").alias("key"),
        F.col("name").alias("label"), F.nullif("meta_data", F.lit("")).alias("detail"),
    )
    drivers = read.csv(f"{out}/drivers").select(
        F.lit("drivers").alias("export"), F.col("account_id").alias("key"),
        F.col("username").alias("label"), F.nullif("driver_id", F.lit("")).alias("detail"),
    )
    return fleet.unionByName(drivers)


# --- merges ---------------------------------------------------------------------------------------

_OLD, _NEW = datetime(2024, 2, 1), datetime(2024, 3, 1, 12)


def _with_audit(df, stamp=_OLD):
    moment = F.lit(stamp.isoformat(sep=" ")).cast("timestamp_ntz")
    return df.withColumns({c: moment for c in merge.AUDIT})


def trip_actions(b: Bed):
    """Stored trips (all but sign-ups) merged with a batch of views, purchases and sign-ups.

    Purchases come with another score, views unchanged.
    """
    stored = _with_audit(b.trip_score.filter("trip_type <> 'signup'"))
    batch = b.trip_score.filter("trip_type IN ('signup', 'view', 'purchase')").withColumn(
        "overall_score",
        E("CASE WHEN trip_type = 'purchase' THEN overall_score + 1 ELSE overall_score END"),
    )
    generated = tuple(c for c in stored.columns if c.endswith("_datetime")) + ("duration_seconds",)
    return merge.upsert(
        stored, batch, TRIP_KEY, daily.TRIP_UPDATE_COLUMNS, _NEW, generated, whole=True
    )


_TRIP_ACTION = """CASE WHEN trip_type = 'signup' THEN 'insert'
  WHEN trip_type = 'purchase' AND overall_score IS NOT NULL THEN 'update'
  WHEN trip_type IN ('purchase', 'view') THEN 'unchanged' ELSE 'keep' END"""


@query(
    "upsert_trips",
    f"""SELECT trip_id, driver_id, trip_type, distance_meters, end_date, end_date_datetime,
  CASE WHEN trip_type = 'purchase' THEN overall_score + 1 ELSE overall_score END AS overall_score,
  CASE WHEN trip_type = 'signup' THEN TIMESTAMP '2024-03-01 12:00:00'
       ELSE TIMESTAMP '2024-02-01' END AS created_at,
  CASE WHEN {_TRIP_ACTION} IN ('insert', 'update') THEN TIMESTAMP '2024-03-01 12:00:00'
       ELSE TIMESTAMP '2024-02-01' END AS updated_at,
  CASE WHEN {_TRIP_ACTION} IN ('insert', 'update') THEN TIMESTAMP '2024-03-01 12:00:00'
       ELSE TIMESTAMP '2024-02-01' END AS last_synced_at,
  {_TRIP_ACTION} AS action FROM trip_score""",
    ("trip_score",),
)
def upsert_trips(b: Bed):
    merged = conform.derive_trip_times(trip_actions(b))
    return merged.select(
        "trip_id", "driver_id", "trip_type", "distance_meters", "end_date", "end_date_datetime",
        "overall_score", *merge.AUDIT, F.col("_action").alias("action"),
    )


def point_actions(b: Bed):
    """Stored points of finished lines, touched by a batch of all points."""
    flags = b.trip_incident.filter("incident_type <> 'N'")
    stored = _with_audit(conform.dedup_incidents(flags))
    return merge.upsert(stored, conform.dedup_incidents(b.trip_incident), INCIDENT_KEY, [], _NEW, whole=True)


@query(
    "upsert_touch_points",
    """SELECT trip_id, account_id, timestamp_ms, latitude, longitude, incident_type,
  CASE WHEN incident_type = 'N' THEN 'insert' ELSE 'update' END AS action,
  CASE WHEN incident_type = 'N' THEN TIMESTAMP '2024-03-01 12:00:00'
       ELSE TIMESTAMP '2024-02-01' END AS created_at,
  TIMESTAMP '2024-03-01 12:00:00' AS last_synced_at FROM (SELECT DISTINCT * FROM point)""",
    ("point",),
)
def upsert_touch_points(b: Bed):
    return point_actions(b).select(
        *INCIDENT_KEY, F.col("_action").alias("action"), "created_at", "last_synced_at"
    )


def fleet_actions(b: Bed):
    stored = _with_audit(
        b.site.filter("active").withColumns(
            {"meta_data": F.lit(None).cast("string"), "stats": F.lit("{}")}
        )
    )
    batch = merge.discovered_fleet_rows(reconciled(b))
    return merge.upsert(
        stored, batch, ["retailer_location_id"], merge.DISCOVERED_FLEET_COLUMNS, _NEW
    )


@query(
    "upsert_discovered_fleets",
    """SELECT coalesce(s.retailer_location_id, r.retailer_location_id) AS retailer_location_id,
  coalesce(r.internal_id, s.internal_id) AS internal_id, coalesce(r.name, s.name) AS name,
  CASE WHEN r.outcome IS NULL THEN s.company_id ELSE r.company_id END AS company_id,
  true AS active, CASE WHEN s.internal_id IS NOT NULL THEN '{}' END AS stats,
  CASE WHEN s.internal_id IS NULL THEN 'insert' WHEN r.outcome IS NULL THEN 'keep'
    ELSE 'update' END AS action,
  CASE WHEN r.outcome IS NULL THEN TIMESTAMP '2024-02-01' ELSE TIMESTAMP '2024-03-01 12:00:00' END
    AS last_synced_at
FROM (SELECT * FROM site WHERE active) s FULL JOIN (SELECT * FROM reconciled
  WHERE outcome = 'insertable') r USING (retailer_location_id)""",
    ("site", "reconciled"),
)
def upsert_discovered_fleets(b: Bed):
    return fleet_actions(b).select(
        "retailer_location_id", "internal_id", "name", "company_id", "active", "stats",
        F.col("_action").alias("action"), "last_synced_at",
    )


_MERGE_COUNTS = f"""SELECT 'trip_score' AS table_name,
  count(*) FILTER (a = 'insert') AS rows_inserted, count(*) FILTER (a = 'update') AS rows_updated,
  count(*) FILTER (a = 'unchanged') AS rows_skipped
FROM (SELECT {_TRIP_ACTION} AS a FROM trip_score)
UNION ALL SELECT 'trip_incident', count(*) FILTER (incident_type = 'N'),
  count(*) FILTER (incident_type <> 'N'), 0 FROM (SELECT DISTINCT * FROM point)"""


def merge_results(b: Bed):
    return reports.union_all(
        [
            merge.merge_counts(trip_actions(b), "trip_score"),
            merge.merge_counts(point_actions(b), "trip_incident"),
        ]
    )


@query("merge_counts", _MERGE_COUNTS, ("trip_score", "point"))
def merge_counts(b: Bed):
    return merge_results(b)


@query(
    "import_report",
    f"""WITH r AS ({_MERGE_COUNTS}), j AS (SELECT count(*) AS n FROM judged_driver
  WHERE reason IS NOT NULL)
SELECT table_name, rows_inserted, rows_updated, rows_skipped, 1 AS tables, 0 AS skipped_records
FROM r
UNION ALL SELECT 'total', sum(rows_inserted)::BIGINT, sum(rows_updated)::BIGINT,
  sum(rows_skipped)::BIGINT, count(*), (SELECT n FROM j) FROM r""",
    ("trip_score", "point", "judged_driver"),
)
def import_report(b: Bed):
    rejects = conform.rejected(conformed_drivers(b)).agg(F.count("*").alias("rejected"))
    return reports.import_report(merge_results(b), rejects)


@query(
    "dry_run_counts",
    """SELECT * FROM (SELECT 'dry run' AS step, count(*) FILTER (l_returnflag = 'N') AS rows_inserted,
  count(*) FILTER (l_returnflag <> 'N') AS rows_updated, 0 AS rows_skipped FROM (
    SELECT DISTINCT l_orderkey, l_suppkey, l_shipdate, l_quantity, l_partkey % 180, l_returnflag
    FROM lineitem)
UNION ALL SELECT 'rows after dry run', count(*), 0, 0 FROM (
    SELECT DISTINCT l_orderkey, l_suppkey, l_shipdate, l_quantity, l_partkey % 180, l_returnflag
    FROM lineitem WHERE l_returnflag <> 'N'))""",
)
def dry_run_counts(b: Bed):
    """Counts of a merge that is not written; the stored rows afterwards show that."""
    _, table = daily.point_tables(*(scratch_dir(b.spark, n) for n in ("locations", "incidents")))
    stored = _with_audit(
        conform.dedup_incidents(b.trip_incident.filter("incident_type <> 'N'"))
    )
    tables.write_table(daily.with_point_month(stored), table)
    batch = daily.with_point_month(conform.dedup_incidents(b.trip_incident))
    counts = tables.merge_into(b.spark, table, batch, _NEW, dry_run=True)
    after = tables.read_table(b.spark, table.path).agg(F.count("*").alias("rows_inserted"))
    zero = F.lit(0).cast("bigint")
    return counts.select(
        F.lit("dry run").alias("step"), "rows_inserted", "rows_updated", "rows_skipped"
    ).unionByName(
        after.select(
            F.lit("rows after dry run").alias("step"), "rows_inserted",
            zero.alias("rows_updated"), zero.alias("rows_skipped"),
        )
    )


_KEYED = """SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END AS part,
  CASE WHEN o_orderkey % 3 = 0 THEN o_custkey + 1 ELSE o_custkey END AS v FROM orders
  WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 = 0"""


def _keyed_table(b: Bed, label: str) -> tuple[tables.StoredTable, Any]:
    rows = b.table("orders").select(
        "o_orderkey", E("CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END AS part"), F.col("o_custkey").alias("v")
    )
    return tables.StoredTable("keyed", scratch_dir(b.spark, label), ["o_orderkey"], ["v"], partition="part"), rows


@query("merge_null_partition", _KEYED)
def merge_null_partition(b: Bed):
    """Two merges whose rows partly have no partition value; the second changes and adds such rows."""
    table, rows = _keyed_table(b, "null-partition")
    tables.merge_into(b.spark, table, rows.filter("o_orderkey % 2 = 0"), _NEW)
    change = rows.filter("o_orderkey % 3 = 0").withColumn("v", F.col("v") + 1)
    tables.merge_into(b.spark, table, change, _NEW)
    return tables.read_table(b.spark, table.path).select("o_orderkey", "part", "v")


@query("merge_after_empty_load", "SELECT o_orderkey, o_custkey AS v FROM orders")
def merge_after_empty_load(b: Bed):
    """A first load without rows, and a second with all of them."""
    table, rows = _keyed_table(b, "empty-load")
    tables.merge_into(b.spark, table, rows.filter("false"), _NEW)
    tables.merge_into(b.spark, table, rows, _NEW)
    return tables.read_table(b.spark, table.path).select("o_orderkey", "v")


@query(
    "correct_moved_rows",
    """SELECT o_orderkey, o_custkey + CASE WHEN last THEN 1 ELSE 0 END AS v,
  strftime(o_orderdate + CASE WHEN last THEN 1 ELSE 0 END, '%Y-%m') AS month
FROM (SELECT *, o_orderdate::DATE = max(o_orderdate::DATE) OVER () AS last FROM
  (SELECT o_orderkey, o_custkey, o_orderdate::DATE AS o_orderdate FROM orders))""",
)
def correct_moved_rows(b: Bed):
    """All orders by month, and a small batch that corrects those of the last day and moves them by one."""
    days = b.table("orders").select("o_orderkey", "o_custkey", E("cast(o_orderdate AS date) AS day"))
    last = days.agg(F.max("day").alias("day"))
    moved = E("date_format(day, 'yyyy-MM') AS month")
    table = tables.StoredTable("orders", scratch_dir(b.spark, "moved"), ["o_orderkey"], ["v", "month"], partition="month")
    tables.merge_into(b.spark, table, days.select("o_orderkey", F.col("o_custkey").alias("v"), moved), _NEW)
    change = days.join(last, "day", "left_semi").withColumn("day", E("date_add(day, 1)"))
    tables.merge_into(b.spark, table, change.select("o_orderkey", (F.col("o_custkey") + 1).alias("v"), moved), _NEW)
    return tables.read_table(b.spark, table.path).select("o_orderkey", "v", "month")


# --- whole loads ----------------------------------------------------------------------------------


@query(
    "refresh_all_rollups",
    """SELECT 'driver_trip_list' AS table_name, count(*) AS row_count, count(*) AS trip_count
FROM driver_trip_list
UNION ALL SELECT 'trip_day_rollup', count(*), sum(trip_count)::BIGINT FROM trip_day_rollup
UNION ALL SELECT 'performance_groups', count(*), sum(total_trip_count)::BIGINT
FROM performance_groups
UNION ALL SELECT 'trip_event_day_rollup', count(*), sum(trip_count)::BIGINT
FROM trip_event_day_rollup
UNION ALL SELECT 'trip_event_groups', count(*), sum(total_trip_count)::BIGINT
FROM trip_event_groups""",
    ("driver_trip_list", "performance_groups", "trip_event_groups"),
)
def refresh_all_rollups(b: Bed):
    stored = tables.refresh_rollups(
        b.trip_score, b.subscription, b.company_subscription, b.company, b.driver, b.app_user,
        scratch_dir(b.spark, "rollups"),
    )
    return tables.rollup_totals(stored)


@query(
    "refreshed_event_groups",
    "SELECT * FROM trip_event_groups",
    ("trip_event_groups",),
)
def refreshed_event_groups(b: Bed):
    """The last rollup of the chain as stored: every stage before it was written and read."""
    stored = tables.refresh_rollups(
        b.trip_score, b.subscription, b.company_subscription, b.company, b.driver, b.app_user,
        scratch_dir(b.spark, "rollups"),
    )
    return stored["trip_event_groups"]


_LOADED = """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY trip_id ORDER BY run DESC) AS newest
  FROM (SELECT *, position % 3 AS run,
      row_number() OVER (PARTITION BY trip_id, position % 3 ORDER BY position) AS k
    FROM judged_trip WHERE problem IS NULL) WHERE k = 1) WHERE newest = 1"""


@query(
    "incremental_load",
    f"SELECT trip_id, start_ms AS start_date, end_ms AS end_date, fleet_id, overall_score + again AS overall_score"
    f" FROM ({_LOADED})",
    ("judged_trip",),
)
def incremental_load(b: Bed):
    """Three landed runs, each with trips of any age, loaded one after the other; the second and third
    window start at the watermark, and trips that ended before it are loaded all the same."""
    table = daily.trip_table(scratch_dir(b.spark, "trips"))
    marks, landing_path = scratch_dir(b.spark, "marks"), scratch_dir(b.spark, "landed-trips")
    run = E("element_at(array('2024-01-12', '2024-01-19', '2024-01-27'), cast(position % 3 + 1 AS int))")
    b.raw_trip.withColumn("run_ts", run).write.options(**LANDED_FILES).partitionBy("run_ts").json(landing_path)
    landed = b.spark.read.schema(b.raw_trip.withColumn("run_ts", run).schema).json(landing_path)
    runs_at = [datetime(2024, 1, 13), datetime(2024, 1, 20), datetime(2024, 1, 28)]
    for i, now in enumerate(runs_at):
        daily.load_trips(
            b.spark, landed, b.fleet, b.known_driver, "position", table, marks, now,
            mode="since_last_success" if i else "rolling_7d",
        )
    return tables.read_table(b.spark, table.path).select(
        "trip_id", "start_date", "end_date", "fleet_id", "overall_score"
    )


@query(
    "streaming_load",
    "SELECT DISTINCT trip_id, account_id, timestamp_ms, latitude, longitude FROM point",
    ("point",),
)
def streaming_load(b: Bed):
    """Landed points streamed into a stored table in two micro-batches; files grow in number, not in size."""
    landed, parts = scratch_dir(b.spark, "landed"), b.parts("lineitem", 16)
    b.trip_location.select(
        F.col("trip_id").alias("tripId"),
        F.col("account_id").cast("string").alias("accountId"),
        F.col("timestamp_ms").cast("string").alias("timestamp"),
        F.col("latitude").cast("string").alias("latitude"),
        F.col("longitude").cast("string").alias("longitude"),
    ).repartition(parts, "tripId").write.option("compression", "gzip").json(landed)
    table, _ = daily.point_tables(scratch_dir(b.spark, "points"), scratch_dir(b.spark, "incidents"))
    query_ = landing.stream_into(
        landing.landed_stream(b.spark, landed, "trip_locations", files_per_batch=-(-parts // 2)),
        lambda rows: daily.conform_points(rows, table),
        table,
        scratch_dir(b.spark, "stream-state"),
        lambda: _NEW,
    )
    query_.awaitTermination()
    return tables.read_table(b.spark, table.path).select(*LOCATION_KEY)


# --- windows --------------------------------------------------------------------------------------


@query(
    "window_modes",
    """WITH now AS (SELECT date_trunc('second', max(ts)) AS n FROM events),
w AS (SELECT 'rolling_24h' AS window_source, n - INTERVAL 1 DAY AS window_start, n AS window_end FROM now
UNION ALL SELECT 'rolling_7d', n - INTERVAL 7 DAY, n FROM now
UNION ALL SELECT 'rolling_36h', n - INTERVAL 36 HOUR, n FROM now
UNION ALL SELECT 'since_last_success', n - INTERVAL 30 DAY, n FROM now
UNION ALL SELECT 'utc_day', date_trunc('day', n), date_trunc('day', n) + INTERVAL 1 DAY FROM now
UNION ALL SELECT 'env', date_trunc('day', n) - INTERVAL 10 DAY, date_trunc('day', n) FROM now)
SELECT window_source, window_start::TIMESTAMP AS window_start, window_end::TIMESTAMP AS window_end,
  count(*) AS trips
FROM w JOIN trip_score ON end_date_datetime >= window_start AND end_date_datetime < window_end
GROUP BY ALL""",
    ("trip_score",),
)
def window_modes(b: Bed):
    """Trips per window mode, seen from the time of the newest event."""
    now = b.table("events").agg(F.max("ts")).first()[0].replace(microsecond=0)
    day = datetime(now.year, now.month, now.day)
    modes = [
        windows.window_of("rolling_24h", now),
        windows.window_of("rolling_7d", now),
        windows.window_of("rolling_hours", now, hours=36),
        windows.window_of("since_last_success", now, watermark=now - timedelta(days=60)),
        windows.window_of("utc_day", now),
        windows.window_of("env", now, start=day - timedelta(days=10), end=day),
    ]
    parts = []
    for w in modes:
        start, end = w.start.replace(tzinfo=None), w.end.replace(tzinfo=None)
        count = trips_in_window(b.trip_score, start, end).agg(F.count("*").alias("trips"))
        parts.append(count.select(
            F.lit(w.source).alias("window_source"),
            F.lit(str(start)).cast("timestamp_ntz").alias("window_start"),
            F.lit(str(end)).cast("timestamp_ntz").alias("window_end"),
            "trips",
        ))
    return reports.union_all(parts)


@query(
    "since_last_success_window",
    """SELECT user_id, mark, CASE WHEN mark IS NULL THEN TIMESTAMP '2024-02-13'
    ELSE least(greatest(mark, TIMESTAMP '2024-01-15'), TIMESTAMP '2024-02-14') END AS window_start,
  CASE WHEN mark IS NULL THEN 'rolling_24h' ELSE 'since_last_success' END AS window_source
FROM (SELECT user_id, max(ts) FILTER (event_type <> 'signup') AS mark FROM events GROUP BY 1)""",
)
def since_last_success_window(b: Bed):
    marks = b.table("events").groupBy("user_id").agg(
        F.max(F.when(F.col("event_type") != "signup", F.col("ts"))).alias("mark")
    )
    now = F.lit("2024-02-14 00:00:00").cast("timestamp_ntz")
    return windows.since_watermark(marks, "mark", now).drop("window_end")


_RANGES = """SELECT o_orderkey, o_orderdate + (o_custkey % 24) * INTERVAL 1 HOUR AS a,
  o_orderdate + (o_custkey % 24) * INTERVAL 1 HOUR + (o_orderkey % 4) * INTERVAL 20 HOUR AS z
FROM orders"""


def _ranges(b: Bed, span: str):
    start = E("o_orderdate + make_dt_interval(0, CAST(o_custkey % 24 AS INT), 0, 0)")
    return b.table("orders").select("o_orderkey", start.alias("range_start")).withColumn(
        "range_end", E(f"range_start + {span}")
    )


@query(
    "daily_windows",
    f"""SELECT o_orderkey, day::DATE AS day, greatest(a, day) AS day_start,
  least(z, day + INTERVAL 1 DAY) AS day_end
FROM (SELECT *, unnest(generate_series(date_trunc('day', a)::TIMESTAMP,
    date_trunc('day', z)::TIMESTAMP, INTERVAL 1 DAY)) AS day FROM ({_RANGES}))
WHERE greatest(a, day) <> least(z, day + INTERVAL 1 DAY)""",
)
def daily_windows(b: Bed):
    ranges = _ranges(b, "make_dt_interval(0, CAST(o_orderkey % 4 * 20 AS INT), 0, 0)")
    return windows.daily_windows(ranges, "range_start", "range_end").select(
        "o_orderkey", "day", "day_start", "day_end"
    )


@query(
    "range_check",
    """SELECT o_orderkey, CASE WHEN o_custkey % 60 < 3 THEN 'invalid'
  WHEN o_custkey % 60 - 3 > 45 THEN 'over_45_days' ELSE 'ok' END AS range_status FROM orders""",
)
def range_check(b: Bed):
    ranges = b.table("orders").select(
        "o_orderkey", F.col("o_orderdate").alias("range_start"),
        E("o_orderdate + make_dt_interval(CAST(o_custkey % 60 - 3 AS INT), 0, 0, 0)").alias(
            "range_end"
        ),
    )
    return windows.range_check(ranges, "range_start", "range_end").select(
        "o_orderkey", "range_status"
    )


# --- quality --------------------------------------------------------------------------------------


@query(
    "check_lat_lon",
    """SELECT p_partkey, p_size * 3.0::DOUBLE AS latitude, (p_partkey % 400 - 200)::DOUBLE AS longitude
FROM part WHERE p_size * 3.0 NOT BETWEEN -90 AND 90 OR p_partkey % 400 - 200 NOT BETWEEN -180 AND 180""",
)
def check_lat_lon(b: Bed):
    rows = b.table("part").select(
        "p_partkey", E("p_size * 3D AS latitude"),
        E("CAST(p_partkey % 400 - 200 AS DOUBLE) AS longitude"),
    )
    return quality.lat_lon_violations(rows)


@query(
    "check_trip_window",
    """SELECT position, start_ms AS start_date, end_ms AS end_date FROM landed_trip
WHERE end_ms < start_ms""",
    ("landed_trip",),
)
def check_trip_window(b: Bed):
    rows = conform.map_trip_rows(b.raw_trip, "position").select(
        F.col("_position").alias("position"), "start_date", "end_date"
    )
    return quality.trip_window_violations(rows)


@query(
    "check_not_null",
    """SELECT 'landed_trip' AS table_name, unnest(['trip_id', 'driver_id', 'start_date', 'fleet_id'])
    AS column_name, unnest([count(*) FILTER (trip_id IS NULL), count(*) FILTER (driver_id IS NULL),
    count(*) FILTER (start_ms IS NULL), count(*) FILTER (fleet_id IS NULL)]) AS null_count
FROM landed_trip""",
    ("landed_trip",),
)
def check_not_null(b: Bed):
    mapped = conform.map_trip_rows(b.raw_trip, "position")
    return quality.null_counts(
        mapped, "landed_trip", ["trip_id", "driver_id", "start_date", "fleet_id"]
    )


@query(
    "fk_orphans",
    """SELECT 'trip_score.driver_id' AS rule_name, count(DISTINCT driver_id) AS orphan_keys,
  count(*) AS orphan_rows FROM trip_score
  WHERE driver_id NOT IN (SELECT driver_id FROM known_driver)
UNION ALL SELECT 'trip_location.trip_id', count(DISTINCT trip_id), count(*) FROM point
  WHERE trip_id NOT IN (SELECT trip_id FROM trip_score)
UNION ALL SELECT 'driver.user_id', count(DISTINCT user_id), count(*) FROM driver
  WHERE user_id NOT IN (SELECT id FROM app_user)
UNION ALL SELECT 'driver.retailer_location_id', count(DISTINCT retailer_location_id), count(*)
  FROM driver WHERE retailer_location_id NOT IN (SELECT retailer_location_id FROM fleet)""",
    ("trip_score", "known_driver", "point", "driver", "app_user", "fleet"),
)
def fk_orphans(b: Bed):
    rule = quality.orphan_counts
    return reports.union_all(
        [
            rule(b.trip_score, b.known_driver, "driver_id", "driver_id", "trip_score.driver_id"),
            rule(b.trip_location, b.trip_score, "trip_id", "trip_id", "trip_location.trip_id"),
            rule(b.driver, b.app_user, "user_id", "id", "driver.user_id"),
            rule(b.driver, b.fleet, "retailer_location_id", "retailer_location_id",
                 "driver.retailer_location_id"),
        ]
    )


def _violations_sql(table: str, keys: list[str], name: str | None = None) -> str:
    k = ", ".join(keys)
    return (
        f"SELECT '{name or table}' AS table_name, count(*) AS duplicate_keys,"
        f" coalesce(sum(n), 0)::BIGINT AS rows_involved FROM (SELECT {k}, count(*) AS n"
        f" FROM {table} GROUP BY {k} HAVING count(*) > 1)"
    )


#: The testbed's view of each table that the declared rules name.
_RULE_VIEWS = {
    "trip_score": "trip_score", "driver": "known_driver", "company": "company", "fleet": "fleet",
    "trip_location": "point", "trip_incident": "point",
}


def _rules_sql() -> str:
    view, parts = _RULE_VIEWS.get, []
    for name, columns in quality.REQUIRED.items():
        for c in columns if view(name) else []:
            n = f"count(*) FILTER ({c} IS NULL)"
            parts.append(f"SELECT 'required' AS rule, '{name}.{c}' AS rule_name, {n} AS bad_keys, {n} AS bad_rows"
                         f" FROM {view(name)}")
    for child, c, parent, key in quality.LINKS:
        if view(child) and view(parent):
            parts.append(f"SELECT 'link', '{child}.{c}', count(DISTINCT {c}), count(*) FROM {view(child)}"
                         f" WHERE {c} NOT IN (SELECT {key} FROM {view(parent)})")
    for name, keys in quality.UNIQUE.items():
        if view(name):
            k = ", ".join(keys)
            parts.append(f"SELECT 'unique', '{name}', count(*), coalesce(sum(n), 0)::BIGINT FROM (SELECT {k},"
                         f" count(*) AS n FROM {view(name)} GROUP BY {k} HAVING count(*) > 1)")
    return " UNION ALL ".join(parts)


@query("declared_rules", _rules_sql(), ("trip_score", "known_driver", "company", "fleet", "point"))
def declared_rules(b: Bed):
    return quality.check_declared(
        {
            "trip_score": b.trip_score, "driver": b.known_driver, "company": b.company, "fleet": b.fleet,
            "trip_location": b.trip_location, "trip_incident": b.trip_incident,
        }
    )


@query(
    "rollup_key_violations",
    " UNION ALL ".join(
        [_violations_sql(n, k) for n, k in ROLLUP_KEYS.items()]
        + [_violations_sql("point", INCIDENT_KEY, "trip_incident")]
    ),
    tuple(ROLLUP_KEYS) + ("point",),
)
def rollup_key_violations(b: Bed):
    days, events = day_rollup(b), event_rollup(b)
    frames = {
        "driver_trip_list": trip_list(b),
        "trip_day_rollup": days,
        "performance_groups": rollups.performance_groups(days),
        "trip_event_day_rollup": events,
        "trip_event_groups": rollups.trip_event_groups(events),
    }
    checks = {name: (frames[name], keys) for name, keys in ROLLUP_KEYS.items()}
    checks["trip_incident"] = (b.trip_incident, INCIDENT_KEY)
    return quality.key_violations(checks)


@query(
    "cascade_purge",
    """SELECT 'trip_score' AS table_name, count(*) AS remaining FROM trip_score WHERE kept
UNION ALL SELECT 'driver_score', count(*) FROM driver_score WHERE kept
UNION ALL SELECT 'trip_location', count(*) FROM point WHERE trip_id NOT IN
  (SELECT trip_id FROM trip_score WHERE NOT kept)
UNION ALL SELECT 'trip_incident', count(*) FROM point WHERE trip_id NOT IN
  (SELECT trip_id FROM trip_score WHERE NOT kept)
UNION ALL SELECT 'driver without fleet', count(*) FROM driver
  WHERE retailer_location_id IN (SELECT retailer_location_id FROM fleet WHERE NOT active)""".replace(
        "NOT kept", "driver_id NOT IN (SELECT driver_id FROM known_driver)"
    ).replace("kept", "driver_id IN (SELECT driver_id FROM known_driver)"),
    ("trip_score", "driver_score", "point", "known_driver", "driver", "fleet"),
)
def cascade_purge(b: Bed):
    gone = b.driver.join(b.known_driver.select("driver_id"), "driver_id", "left_anti")
    left = quality.purge_drivers(
        gone, b.trip_score, b.driver_score, b.trip_location, b.trip_incident
    )
    unlinked = quality.unlink_fleets(b.driver, b.fleet.filter("NOT active"))
    left["driver without fleet"] = unlinked.filter("retailer_location_id IS NULL")
    return reports.union_all(
        [
            df.agg(F.count("*").alias("remaining")).select(
                F.lit(name).alias("table_name"), "remaining"
            )
            for name, df in left.items()
        ]
    )


# --- run accounting -------------------------------------------------------------------------------


@query(
    "purge_stored",
    """SELECT 'trip_score' AS table_name, count(*) AS remaining FROM trip_score WHERE kept
UNION ALL SELECT 'driver_score', count(*) FROM driver_score WHERE kept
UNION ALL SELECT 'driver', count(*) FROM driver WHERE kept
UNION ALL SELECT 'trip_location', count(*) FROM (SELECT DISTINCT trip_id, account_id, timestamp_ms, latitude,
  longitude FROM point) WHERE trip_id NOT IN (SELECT trip_id FROM trip_score WHERE NOT kept)
UNION ALL SELECT 'trip_incident', count(*) FROM (SELECT DISTINCT * FROM point) WHERE trip_id NOT IN
  (SELECT trip_id FROM trip_score WHERE NOT kept)
UNION ALL SELECT 'rollup trips', coalesce(sum(trip_count), 0)::BIGINT FROM trip_day_rollup WHERE kept""".replace(
        "NOT kept", "driver_id NOT IN (SELECT driver_id FROM known_driver)"
    ).replace("kept", "driver_id IN (SELECT driver_id FROM known_driver)"),
    ("trip_score", "driver_score", "point", "known_driver", "driver", "trip_day_rollup"),
)
def purge_stored(b: Bed):
    """A stored warehouse with rollups, from which the drivers that are not known are purged."""
    spark, house = b.spark, pipeline.Warehouse(scratch_dir(b.spark, "warehouse"))
    tables.write_table(b.driver, house.driver)
    tables.write_table(b.driver_score, house.driver_score)
    tables.write_table(daily.with_end_day(b.trip_score), house.trip_score)
    for table, points in zip(house.points, (conform.dedup_locations(b.trip_location), conform.dedup_incidents(b.trip_incident))):
        tables.write_table(daily.with_point_month(points), table)

    def sides() -> maintenance.Sides:
        drivers = tables.read_table(spark, house.driver.path)
        return maintenance.Sides(b.subscription, b.company_subscription, b.company, drivers, b.app_user)

    maintenance.refresh(spark, house.trip_score.path, sides(), house.path("rollups"))
    gone = b.driver.join(b.known_driver.select("driver_id"), "driver_id", "left_anti")
    done = purge.purge_drivers(spark, gone, house.driver, house.driver_score, house.trip_score, house.points)
    maintenance.refresh(spark, house.trip_score.path, sides(), house.path("rollups"), done.trips)
    stored = {t.name: tables.read_table(spark, t.path) for t in (house.driver, house.driver_score, house.trip_score, *house.points)}
    counts = [df.agg(F.lit(name).alias("table_name"), F.count("*").alias("remaining")) for name, df in stored.items()]
    rolled = tables.read_table(spark, house.path("rollups/trip_day_rollup"))
    total = F.coalesce(F.sum("trip_count"), F.lit(0)).alias("remaining")
    return reports.union_all([*counts, rolled.agg(F.lit("rollup trips").alias("table_name"), total)])


def fleet_outcomes(b: Bed):
    """Counters per fleet of one run, from landed trips and their conversion."""
    judged = conformed_trips(b)
    per_fleet = judged.groupBy(F.coalesce("fleet_id", F.lit("none")).alias("fleet_id")).agg(
        F.count("*").alias("trip_scores"),
        F.count_if(F.col("_status") == "resolved").alias("sql_inserted"),
        F.count_if(F.col("_status") == "skipped").alias("sql_skipped"),
    )
    failed = F.col("fleet_id") == "none"
    zero = F.lit(0).cast("bigint")
    return per_fleet.select(
        "fleet_id", "trip_scores", "sql_inserted", zero.alias("sql_updated"), "sql_skipped",
        *[zero.alias(c) for c in ("drivers", "driver_scores", "trip_locations", "trip_incidents")],
        F.when(failed, F.lit(1)).otherwise(F.when(F.col("sql_skipped") > 20, 1).otherwise(0))
        .cast("bigint").alias("errors"),
        reports.pull_status(
            F.when(F.col("sql_skipped") > 20, 1).otherwise(0), failed
        ).alias("pull_status"),
    )


_OUTCOMES_SQL = """(SELECT coalesce(fleet_id, 'none') AS fleet_id, count(*) AS trip_scores,
  count(*) FILTER (status = 'resolved') AS resolved, count(*) FILTER (status = 'skipped') AS skipped,
  CASE WHEN coalesce(fleet_id, 'none') = 'none' THEN 'error'
    WHEN count(*) FILTER (status = 'skipped') > 20 THEN 'partial' ELSE 'ok' END AS pull_status
FROM status_trip GROUP BY 1)"""


@query(
    "run_totals",
    f"""SELECT count(*) AS fleets_total, count(*) FILTER (pull_status = 'ok') AS fleets_ok,
  count(*) FILTER (pull_status = 'partial') AS fleets_partial,
  count(*) FILTER (pull_status = 'error') AS fleets_error, 0 AS fleets_skipped, 0 AS driver_count,
  0 AS driver_score_count, sum(trip_scores)::BIGINT AS trip_score_count, 0 AS trip_location_count,
  0 AS trip_incident_count, sum(resolved)::BIGINT AS sql_inserted, 0 AS sql_updated,
  sum(skipped)::BIGINT AS sql_skipped, 0 AS discovery_errors
FROM {_OUTCOMES_SQL}""",
    ("status_trip",),
)
def run_totals(b: Bed):
    return reports.run_totals(fleet_outcomes(b))


@query(
    "run_status",
    f"""SELECT fleet_id, CASE WHEN pull_status = 'ok' THEN 0 ELSE 1 END
    + (resolved < trip_scores - skipped)::INTEGER AS error_count,
  CASE WHEN pull_status = 'ok' AND resolved < trip_scores - skipped THEN 'partial'
    ELSE pull_status END AS fleet_status, NULL::VARCHAR AS run_status, NULL::INTEGER AS exit_code
FROM {_OUTCOMES_SQL}
UNION ALL SELECT NULL, NULL, NULL, CASE WHEN fleets = 0 OR attempted > 0 AND loaded = 0 THEN 'error'
    WHEN failed > 0 THEN 'partial' ELSE 'ok' END,
  CASE WHEN fleets = 0 THEN 2 WHEN attempted > 0 AND loaded = 0 THEN 1 ELSE 0 END
FROM (SELECT count(*) AS fleets, count(*) FILTER (s <> 'skipped') AS attempted,
    count(*) FILTER (s IN ('ok', 'partial')) AS loaded, count(*) FILTER (s = 'error') AS failed
  FROM (SELECT CASE WHEN pull_status = 'ok' AND resolved < trip_scores - skipped THEN 'partial'
      ELSE pull_status END AS s FROM {_OUTCOMES_SQL}))""",
    ("status_trip",),
)
def run_status(b: Bed):
    """Status per fleet (a conversion step that filtered or dropped rows counts as an error)."""
    pulls = cut_lineage(fleet_outcomes(b), "fleet-outcomes", "zstd")  # one row per fleet, read four times
    lost = F.col("sql_inserted") < F.col("trip_scores") - F.col("sql_skipped")
    steps = pulls.select(
        "fleet_id", F.lit("convert").alias("step"),
        F.when(lost, "error").otherwise("ok").alias("status"),
        lost.cast("bigint").alias("errors"),
    )
    statuses = reports.fleet_statuses(steps, pulls)
    overall = reports.run_status(statuses)
    none = F.lit(None)
    return statuses.select(
        "fleet_id", "error_count", "fleet_status", none.cast("string").alias("run_status"), none.cast("int").alias("exit_code")
    ).unionByName(
        overall.select(
            none.cast(statuses.schema["fleet_id"].dataType).alias("fleet_id"), none.cast("bigint").alias("error_count"),
            none.cast("string").alias("fleet_status"), "run_status", F.col("exit_code").cast("int").alias("exit_code"),
        )
    )


@query(
    "table_profile",
    """SELECT 'trip_score' AS table_name, (SELECT count(*) FROM trip_score) AS row_count,
  (SELECT to_json(list({'trip_id': trip_id} ORDER BY trip_id))::VARCHAR FROM
    (SELECT trip_id FROM trip_score ORDER BY trip_id LIMIT 3)) AS sample_keys
UNION ALL SELECT 'fleet', (SELECT count(*) FROM site), (SELECT to_json(list(
    {'retailer_location_id': retailer_location_id} ORDER BY retailer_location_id))::VARCHAR FROM
    (SELECT retailer_location_id FROM site ORDER BY 1 LIMIT 3))
UNION ALL SELECT 'trip_incident', (SELECT count(*) FROM point), (SELECT to_json(list(
    {'trip_id': trip_id, 'timestamp_ms': timestamp_ms} ORDER BY trip_id, timestamp_ms))::VARCHAR
    FROM (SELECT trip_id, timestamp_ms FROM point ORDER BY 1, 2 LIMIT 3))""",
    ("trip_score", "site", "point"),
)
def table_profile(b: Bed):
    return reports.table_profile(
        {
            "trip_score": (b.trip_score, ["trip_id"]),
            "fleet": (b.site, ["retailer_location_id"]),
            "trip_incident": (b.trip_incident, ["trip_id", "timestamp_ms"]),
        }
    )
