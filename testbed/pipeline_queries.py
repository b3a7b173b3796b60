"""The daily run as a whole, and the details back-fill."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from milepost.operators import reports
from milepost.plans import daily, maintenance, pipeline, tables
from milepost.plans.windows import RunWindow
from milepost.session import scratch_dir
from testbed.conform_queries import _GOOD_INCIDENT, _GOOD_POINT
from testbed.registry import query
from testbed.views import LANDED_FILES, Bed

E = F.expr
WINDOW = RunWindow(
    datetime(2023, 12, 1, tzinfo=timezone.utc), datetime(2024, 2, 1, tzinfo=timezone.utc), "env"
)


def inputs(b: Bed) -> tuple[pipeline.Landed, pipeline.Directory]:
    """Landed rows whose fleets are the sites, so that loaded fleets resolve loaded trips."""
    site = E("concat('site_', substr(thirdPartyId, 2))")

    def land(name: str, df):
        path = scratch_dir(b.spark, f"landed-{name}")
        df.write.options(**LANDED_FILES).json(path)
        return b.spark.read.schema(df.schema).json(path)

    landed = pipeline.Landed(
        fleet_search=b.found_fleet,
        fleets=b.raw_fleet,
        drivers=b.raw_driver.drop("position"),
        driver_scores=land(
            "scores", b.raw_score.drop("event_id", "ts").withColumn("fleetId", site)
        ),
        trip_scores=land("trips", b.raw_trip.withColumn("fleetId", site)),
        trip_locations=b.raw_point,
        trip_incidents=b.raw_point,
    )
    customer = b.table("customer")
    names = customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("company_name"))
    directory = pipeline.Directory(
        companies=b.company_account.join(names, "id"),
        users=b.app_user,
        subscriptions=b.subscription,
        company_subscriptions=customer.select(
            F.col("c_custkey").alias("company_id"), E("c_custkey % 2 AS subscription_id")
        ),
    )
    return landed, directory


# landed trips and scores judged against what the run itself has loaded
_RUN_VIEWS = """stored_driver AS (SELECT DISTINCT blob_id AS driver_id FROM judged_driver
  WHERE reason IS NULL),
run_trip AS (SELECT t.trip_id, t.end_ms, c.company_id, CASE
    WHEN t.trip_id IS NULL OR t.driver_id IS NULL THEN 'skipped'
    WHEN d.driver_id IS NULL THEN 'filtered' WHEN start_ms IS NULL OR end_ms < start_ms
      OR c.company_id IS NULL OR event_id % 59 = 4 OR user_id >= (SELECT count(*) FROM part)
    THEN 'skipped' END AS problem
  FROM landed_trip t LEFT JOIN stored_driver d USING (driver_id)
    LEFT JOIN company_of c ON c.retailer_location_id = 1000 + user_id),
run_score AS (SELECT s.driver_id, s.user_id, snapshot_date, CASE WHEN s.driver_id IS NULL THEN 'skipped'
    WHEN d.driver_id IS NULL THEN 'filtered' WHEN row_index IS NULL OR c.company_id IS NULL
      OR event_id % 59 = 4 OR user_id >= (SELECT count(*) FROM part) THEN 'skipped' END AS problem
  FROM judged_score s LEFT JOIN stored_driver d USING (driver_id)
    LEFT JOIN company_of c ON c.retailer_location_id = 1000 + user_id),
claimed_part AS (SELECT p.* FROM part p JOIN company_of c
  ON c.retailer_location_id = p_partkey + 1000)"""


@query(
    "daily_run",
    f"""WITH {_RUN_VIEWS}
SELECT 'discovery' AS entity, 'ok' AS status,
  count(*) FILTER (p_size % 5 <> 4) AS rows_inserted, 0 AS rows_updated, 0 AS rows_skipped,
  (SELECT count(*) FROM part) - count(*) FILTER (p_size % 5 <> 4) AS rejected_rows
FROM claimed_part
UNION ALL SELECT 'fleets', 'ok', count(*) FILTER (p_size % 5 = 4),
  count(*) FILTER (p_size % 5 <> 4), 0, (SELECT count(*) FROM part) - count(*) FROM claimed_part
UNION ALL SELECT 'drivers', 'ok', (SELECT count(*) FROM stored_driver), 0, 0,
  count(*) FILTER (reason IS NOT NULL) FROM judged_driver
UNION ALL SELECT 'driver_scores', 'ok',
  count(DISTINCT (snapshot_date, driver_id)) FILTER (problem IS NULL), 0, 0,
  count(*) - count(DISTINCT (snapshot_date, driver_id)) FILTER (problem IS NULL) FROM run_score
UNION ALL SELECT 'trip_scores', 'ok', count(DISTINCT trip_id) FILTER (problem IS NULL), 0, 0,
  count(*) - count(DISTINCT trip_id) FILTER (problem IS NULL) FROM run_trip
UNION ALL SELECT 'trip_location', 'ok', (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_suppkey,
    l_shipdate, l_quantity, l_partkey % 180 FROM lineitem WHERE {_GOOD_POINT})), 0, 0,
  count(*) FILTER (NOT ({_GOOD_POINT})) FROM lineitem
UNION ALL SELECT 'trip_incident', 'ok', (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_suppkey,
    l_shipdate, l_quantity, l_partkey % 180, l_returnflag FROM lineitem WHERE {_GOOD_INCIDENT})),
  0, 0, count(*) FILTER (NOT ({_GOOD_INCIDENT})) FROM lineitem
UNION ALL SELECT 'rollup trips', 'ok', count(DISTINCT trip_id), 0, 0, 0 FROM run_trip
WHERE problem IS NULL AND company_id % 2 = 0""",
    ("judged_driver", "landed_trip", "judged_score", "company_of"),
)
def daily_run(b: Bed):
    """First run into an empty warehouse: what each step inserted, updated and rejected."""
    landed, directory = inputs(b)
    report = pipeline.run_daily(
        b.spark, landed, directory, pipeline.Warehouse(scratch_dir(b.spark, "warehouse")), WINDOW,
        datetime(2024, 2, 1), F.lit(999),
    )
    frame = report.frame(b.spark)
    rollup = F.col("entity") == "rollups"
    zero = F.lit(0).cast("bigint")
    return frame.select(
        F.when(rollup, "rollup trips").otherwise(F.col("entity")).alias("entity"),
        "status",
        "rows_inserted",
        F.when(rollup, zero).otherwise(F.col("rows_updated")).alias("rows_updated"),
        "rows_skipped",
        "rejected_rows",
    )


@query(
    "trip_details_backfill",
    f"""WITH w AS (SELECT trip_id FROM trip_score WHERE end_date_datetime >= TIMESTAMP '2024-01-08'
    AND end_date_datetime < TIMESTAMP '2024-01-23')
SELECT 'trip_location' AS table_name, count(*) AS rows_inserted, 0 AS rows_updated, 0 AS rows_skipped
FROM (SELECT DISTINCT l_orderkey, l_suppkey, l_shipdate, l_quantity, l_partkey % 180 FROM lineitem
  WHERE {_GOOD_POINT} AND 'T' || l_orderkey IN (SELECT trip_id FROM w))
UNION ALL SELECT 'trip_incident', count(*), 0, 0
FROM (SELECT DISTINCT l_orderkey, l_suppkey, l_shipdate, l_quantity, l_partkey % 180, l_returnflag
  FROM lineitem WHERE {_GOOD_INCIDENT} AND 'T' || l_orderkey IN (SELECT trip_id FROM w))""",
    ("trip_score",),
)
def trip_details_backfill(b: Bed):
    root = scratch_dir(b.spark, "details")
    stored = daily.point_tables(f"{root}/locations", f"{root}/incidents")
    return reports.union_all(
        [
            daily.backfill_details(
                b.spark, b.trip_score, b.raw_point, b.raw_point, stored,
                datetime(2024, 1, 8), datetime(2024, 1, 23), datetime(2024, 2, 1),
            )
        ]
    )


@query("incremental_rollups", "SELECT * FROM trip_event_groups", ("trip_event_groups",))
def incremental_rollups(b: Bed):
    """Three loads with rollups kept from their change rows: most trips; the rest and some with wrong days,
    drivers and scores; the corrections. Users and subscriptions change with the last one."""
    derived = [c for c in b.trip_score.columns if c.endswith("_datetime") or c in ("duration_seconds", "end_day")]
    trips = b.trip_score.drop(*derived)
    part = E("pmod(xxhash64(trip_id), 10)")
    wrong = trips.filter(part.isin(0, 1, 2)).withColumns({
        "end_date": F.when(part == 0, F.col("end_date") + 86_400_000).otherwise(F.col("end_date")),
        "driver_id": F.when(part == 1, F.lit("D1")).otherwise(F.col("driver_id")),
        "overall_score": F.when(part == 2, F.lit(0.0)).otherwise(F.col("overall_score")),
    })
    early = maintenance.Sides(
        b.subscription, b.company_subscription.filter("company_id % 4 <> 0"), b.company, b.driver,
        b.app_user.withColumn("email", F.lower("first_name")),
    )
    now = maintenance.Sides(b.subscription, b.company_subscription, b.company, b.driver, b.app_user)
    table = daily.trip_table(scratch_dir(b.spark, "trips"))
    out = scratch_dir(b.spark, "kept-rollups")
    loads = [
        (trips.filter(part > 1), early), (wrong.unionByName(trips.filter(part == 9)), early),
        (trips.filter(part < 4), now),
    ]
    for day, (batch, sides) in enumerate(loads, 1):
        done = tables.merge(b.spark, table, daily.with_end_day(batch), datetime(2024, 2, day))
        maintenance.refresh(b.spark, table.path, sides, out, done)
    return tables.read_table(b.spark, f"{out}/trip_event_groups")
