"""The incremental load of trips: window, conform, merge, advance the watermark."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from milepost.functions.measures import epoch_ms_to_timestamp
from milepost.operators import conform, dedup
from milepost.operators.merge import DISCOVERED_FLEET_COLUMNS
from milepost.operators.lookups import details_for_worklist, trip_detail_worklist
from milepost.operators.accounting import outcome_watch
from milepost.operators.reports import CONVERSIONS, conversion_line, union_all
from milepost.plans.tables import (
    StoredTable, advance_watermark, merge, merge_into, read_watermark,
)
from milepost.plans.windows import RunWindow, window_of
from milepost.schemas import (
    DRIVER_KEY, DRIVER_SCORE_KEY, FLEET_KEY, INCIDENT_COLUMNS, INCIDENT_KEY, LAST_INCIDENT_COLUMNS,
    LOCATION_KEY, SCORE_COLUMNS, TRIP_KEY,
)
from milepost.session import cut_lineage

TRIP_UPDATE_COLUMNS = (
    ["driver_id", "account_id", "company_id", "retailer_location_id", "fleet_id", "fleet_name",
     "third_party_id", "driver_name", "trip_type", "distance_meters", "start_date", "end_date",
     "overall_score"]
    + SCORE_COLUMNS + INCIDENT_COLUMNS + LAST_INCIDENT_COLUMNS + ["geo", "weather"]
)
DRIVER_SCORE_UPDATE_COLUMNS = (
    ["account_id", "company_id", "retailer_location_id", "fleet_name", "third_party_id",
     "driver_name", "distance_meters", "overall_score"]
    + SCORE_COLUMNS + INCIDENT_COLUMNS + LAST_INCIDENT_COLUMNS
)
FLEET_UPDATE_COLUMNS = [
    "company_id", "internal_id", "name", "location_type", "public_location", "qr_code_url",
    "location_token", "active", "latitude", "longitude", "manager", "categories", "filters",
    "billable_entity", "retailer", "offers", "meta_data", "contact", "stats",
]
DRIVER_UPDATE_COLUMNS = [
    "account_id", "user_id", "retailer_location_id", "display", "username", "account_type",
    "contact_email", "location_display", "active", "latitude", "longitude", "location_count",
    "manager", "contact", "employer", "app_info", "locations",
]


def trip_table(path: str) -> StoredTable:
    """Trips by end day, which a correction may change."""
    return StoredTable(
        "trip_score", path, TRIP_KEY, TRIP_UPDATE_COLUMNS + ["end_day"], partition="end_day"
    )


def with_end_day(trips: DataFrame) -> DataFrame:
    return trips.withColumn("end_day", epoch_ms_to_timestamp(F.col("end_date")).cast("date"))


def score_table(path: str) -> StoredTable:
    """Driver scores by snapshot date, which belongs to the key."""
    return StoredTable(
        "driver_score", path, DRIVER_SCORE_KEY, DRIVER_SCORE_UPDATE_COLUMNS,
        partition="snapshot_date",
    )


def fleet_table(path: str, buckets: int = 8) -> StoredTable:
    return StoredTable("fleet", path, FLEET_KEY, FLEET_UPDATE_COLUMNS, buckets=buckets)


def discovered_fleet_table(path: str, buckets: int = 8) -> StoredTable:
    """The fleet table as seen by discovery: five compared columns, stats set on insert only."""
    return StoredTable("fleet", path, FLEET_KEY, DISCOVERED_FLEET_COLUMNS, buckets=buckets)


def driver_table(path: str, buckets: int = 64) -> StoredTable:
    return StoredTable("driver", path, DRIVER_KEY, DRIVER_UPDATE_COLUMNS, buckets=buckets)


def point_tables(location_path: str, incident_path: str) -> tuple[StoredTable, StoredTable]:
    """Point tables by month: the timestamp belongs to the key, and years of points stay few folders."""
    return (
        StoredTable("trip_location", location_path, LOCATION_KEY, [], partition="point_month"),
        StoredTable("trip_incident", incident_path, INCIDENT_KEY, [], partition="point_month"),
    )


def with_point_month(points: DataFrame) -> DataFrame:
    moment = epoch_ms_to_timestamp(F.col("timestamp_ms"))
    return points.withColumn("point_month", F.trunc(moment.cast("date"), "month"))


def landed_in_window(raw: DataFrame, window: RunWindow, run: str = "run_ts") -> DataFrame:
    """Rows of the landed runs that began in the window.

    A window selects runs. No row is left out for its own times: a trip that ended long before it was
    landed is loaded with the run that brought it. Rows of a run without a readable time stay, and so
    do all rows where landed data has no runs.
    """
    if run not in raw.columns:
        return raw
    began = F.col(run).cast("timestamp_ntz")
    start, end = (F.lit(str(v.replace(tzinfo=None))).cast("timestamp_ntz") for v in (window.start, window.end))
    return raw.filter(began.isNull() | ((began >= start) & (began < end)))


def source_order(raw: DataFrame) -> str | None:
    """The column that orders all rows, where the source has made one."""
    return "source_order" if "source_order" in raw.columns else None


def load_trips(
    spark: SparkSession,
    raw: DataFrame,
    fleets: DataFrame,
    drivers: DataFrame,
    position: str,
    table: StoredTable,
    watermark_path: str,
    now: datetime,
    mode: str = "since_last_success",
    dry_run: bool = False,
    job: str = "trip_scores",
    **window_options,
) -> tuple[RunWindow, DataFrame, DataFrame]:
    """One run of the trip load; returns the window, the merge counts and the conversion summary.

    The watermark moves only after the merge has been written, and never in a dry run, so a run
    that fails is repeated over the same window. The merge is idempotent.
    """
    if mode == "since_last_success":
        window_options["watermark"] = read_watermark(spark, watermark_path, job)
    window = window_of(mode, now, **window_options)
    rows = landed_in_window(raw, window)
    seen = outcome_watch()
    judged = conform.conform_trip_score(rows, fleets, drivers, position, source_order(raw), seen)
    batch = with_end_day(conform.accepted(judged))
    done = merge(spark, table, batch, window.end.replace(tzinfo=None), dry_run)
    if not dry_run:
        advance_watermark(spark, watermark_path, job, window.end, now)
    line = conversion_line("trip_scores", seen, done.batch_rows)
    return window, done.counts, spark.createDataFrame([line], CONVERSIONS)


def judge_points(raw: DataFrame, table: StoredTable) -> DataFrame:
    """Every landed point of the table's kind with its status."""
    incidents = table.keys == INCIDENT_KEY
    return (conform.conform_trip_incident if incidents else conform.conform_trip_location)(raw)


def distinct_points(judged: DataFrame, table: StoredTable) -> DataFrame:
    """Usable, distinct points."""
    return with_point_month(dedup.distinct_points(conform.accepted(judged), table.keys))


def conform_points(raw: DataFrame, table: StoredTable) -> DataFrame:
    return distinct_points(judge_points(raw, table), table)


def points_of_trips(raw: DataFrame, table: StoredTable, worklist: DataFrame) -> DataFrame:
    """Usable, distinct points of the trips of a worklist.

    The trips are picked before equal points are dropped: only what is picked is deduplicated, and the trip id,
    by which a join of two large sides deals the points, is part of their key, so that they move once.
    """
    return distinct_points(details_for_worklist(judge_points(raw, table), worklist), table)


def load_points(
    spark: SparkSession, raw: DataFrame, table: StoredTable, stamp: datetime, dry_run: bool = False
) -> DataFrame:
    """Conforms, deduplicates and touch-merges landed points."""
    return merge_into(spark, table, conform_points(raw, table), stamp, dry_run)


def backfill_details(
    spark: SparkSession,
    trips: DataFrame,
    raw_locations: DataFrame,
    raw_incidents: DataFrame,
    point_tables: tuple[StoredTable, StoredTable],
    start: datetime,
    end: datetime,
    stamp: datetime,
    dry_run: bool = False,
) -> DataFrame:
    """Loads the landed points of the trips that ended in a range; returns the merge counts."""
    worklist = cut_lineage(trip_detail_worklist(trips, start, end), "worklist", "zstd")
    counts = []
    for raw, table in zip((raw_locations, raw_incidents), point_tables):
        counts.append(merge_into(spark, table, points_of_trips(raw, table, worklist), stamp, dry_run))
    return union_all(counts)
