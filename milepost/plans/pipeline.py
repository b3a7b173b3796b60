"""The whole daily run: discovery, entities in order, rollups, report, watermark.

All fleets go through one job per entity; a fleet is a column, not an iteration.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from milepost.functions.jsontext import to_json_text
from milepost.operators import conform, lookups
from milepost.operators.accounting import Watch, outcome_watch, row_watch
from milepost.operators.dedup import first_by
from milepost.operators.merge import discovered_fleet_rows
from milepost.operators.reports import CONVERSIONS, conversion_line
from milepost.plans import daily, maintenance
from milepost.plans.tables import (
    Merge, StoredTable, advance_watermark, merge, read_table, refresh_rollups,
)
from milepost.plans.windows import RunWindow, snapshot_date
from milepost.schemas import DRIVER_KEY, FLEET_KEY
from milepost.session import cut_lineage, run_scratch


REJECTS = "status string, reason string, row string"


@dataclass(frozen=True)
class Landed:
    """Landed rows per entity as text columns, as ``sources.entity.read_entity`` gives them.

    Score and trip rows carry ``position`` and, where there are several documents, ``source_order``.
    Rows with a ``run_ts`` belong to a landed run.
    """

    fleet_search: DataFrame
    fleets: DataFrame
    drivers: DataFrame
    driver_scores: DataFrame
    trip_scores: DataFrame
    trip_locations: DataFrame
    trip_incidents: DataFrame


@dataclass(frozen=True)
class Directory:
    """Tables kept by others: companies, users and subscriptions."""

    companies: DataFrame
    users: DataFrame
    subscriptions: DataFrame
    company_subscriptions: DataFrame


@dataclass(frozen=True)
class Warehouse:
    """Where the conformed tables, the rollups and the watermark are stored."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    @property
    def fleet(self) -> StoredTable:
        return daily.fleet_table(self.path("fleet"))

    @property
    def driver(self) -> StoredTable:
        return daily.driver_table(self.path("driver"))

    @property
    def driver_score(self) -> StoredTable:
        return daily.score_table(self.path("driver_score"))

    @property
    def trip_score(self) -> StoredTable:
        return daily.trip_table(self.path("trip_score"))

    @property
    def points(self) -> tuple[StoredTable, StoredTable]:
        return daily.point_tables(self.path("trip_location"), self.path("trip_incident"))


@dataclass
class RunReport:
    """One line per step, kept on the driver: entity, status, counts, rejected rows, message."""

    steps: list[tuple] = field(default_factory=list)
    conversions: list[tuple] = field(default_factory=list)

    SCHEMA = (
        "entity string, status string, rows_inserted long, rows_updated long, rows_skipped long,"
        " rejected_rows long, message string"
    )

    def step(self, entity: str, action: Callable[[], tuple[DataFrame, int]]) -> bool:
        """Runs one step; a failure is recorded and the run goes on."""
        try:
            counts, rejects = action()
            self.steps.append((entity, "ok", *counts.first()[1:], rejects, None))
            return True
        except (PySparkException, Py4JError) as exc:
            self.steps.append((entity, "error", 0, 0, 0, 0, str(exc)))
            return False

    def converted(self, entity: str, seen: Watch, kept: int) -> None:
        """Accounts for the judged rows of an entity, of whose resolved rows ``kept`` were loaded."""
        self.conversions.append(conversion_line(entity, seen, kept))

    def conversion_frame(self, spark: SparkSession) -> DataFrame:
        """Input rows by outcome per entity; the four outcomes add up to the total."""
        return spark.createDataFrame(self.conversions, CONVERSIONS)

    def skip(self, entity: str, why: str) -> None:
        self.steps.append((entity, "skipped", 0, 0, 0, 0, why))

    @property
    def failed(self) -> bool:
        return any(s[1] == "error" for s in self.steps)

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.steps, self.SCHEMA)


def _complete(df: DataFrame, like: DataFrame) -> DataFrame:
    """``df`` with the columns of ``like``; those it lacks are NULL."""
    return df.select(
        *[
            F.col(f.name).cast(f.dataType) if f.name in df.columns
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in like.schema.fields
        ]
    )


def _keep_rejects(
    warehouse: Warehouse, entity: str, run_at: datetime, judged: DataFrame, dry_run: bool
) -> int:
    """Stores the rows that a step rejects, with status and reason, and counts them.

    They go to a folder of the run and the entity, which a repeated run replaces, and are counted as they
    are written.
    """
    rejects = conform.rejected(judged)
    if dry_run:
        return rejects.count()
    values = [c for c in rejects.columns if c not in ("_status", "_reason")]
    path = f"{warehouse.path('rejects')}/run_at={run_at:%Y%m%dT%H%M%S}/entity={entity}"
    watch = row_watch()
    watch.on(rejects.select(
        F.col("_status").alias("status"), F.col("_reason").alias("reason"), to_json_text(F.struct(*values)).alias("row")
    )).write.mode("overwrite").option("compression", "zstd").parquet(path)
    return watch["rows"]


def read_rejects(spark: SparkSession, warehouse: Warehouse) -> DataFrame:
    """Rejected rows of all runs: run_at, entity, status, reason, row (JSON)."""
    return spark.read.schema(REJECTS + ", run_at string, entity string").parquet(warehouse.path("rejects"))


def run_daily(
    spark: SparkSession,
    landed: Landed,
    directory: Directory,
    warehouse: Warehouse,
    window: RunWindow,
    run_at: datetime,
    default_location: Column,
    dry_run: bool = False,
    job: str = "daily",
    refresh: str = "changes",
) -> RunReport:
    """One run over a window of landed runs; every row of a run is loaded or kept as a reject.

    When the drivers cannot be loaded, scores and trips are skipped, as they refer to them; points
    are still loaded. Rollups follow what the merge changed, and changed companies, subscriptions, drivers
    and users (`plans.maintenance`); ``refresh="all"`` rebuilds them from all trips, ``refresh="touched"``
    from the trips of the loaded trips' days, whatever else has changed. The watermark moves only if no step failed, and not in a dry run. A dry run judges
    every step against the tables as the steps before would leave them.
    """
    if refresh not in ("changes", "all", "touched"):
        raise ValueError(f"refresh is 'changes', 'all' or 'touched', not {refresh!r}")
    with run_scratch(spark, f"run-{job}") as scratch:
        report = _steps(
            spark, landed, directory, warehouse, window, run_at, default_location, dry_run, job, refresh
        )
        scratch["keep"] = report.failed
    return report


def _steps(
    spark: SparkSession,
    landed: Landed,
    directory: Directory,
    warehouse: Warehouse,
    window: RunWindow,
    run_at: datetime,
    default_location: Column,
    dry_run: bool,
    job: str,
    refresh: str,
) -> RunReport:
    report = RunReport()
    stamp = window.end.replace(tzinfo=None)
    views: dict[str, DataFrame] = {}
    merges: dict[str, Merge] = {}

    seen: dict[str, Watch] = {}
    seen_fleets: list[Watch] = []

    def watch(entity: str) -> Watch:
        return seen.setdefault(entity, outcome_watch())

    def load(entity: str, table: StoredTable, batch: DataFrame, rejects: int) -> tuple[DataFrame, int]:
        before = merges[entity].version if dry_run and entity in merges else None
        done = merge(spark, table, batch, stamp, dry_run, before)
        views[entity], merges[entity] = done.table, done
        if entity in seen:
            report.converted(entity, seen.pop(entity), done.batch_rows)
        return done.counts, rejects

    def keep(entity: str, judged: DataFrame) -> int:
        return _keep_rejects(warehouse, entity, run_at, judged, dry_run)

    def rows_in_window(raw: DataFrame) -> DataFrame:
        return daily.landed_in_window(raw, window)

    def judged_fleets() -> DataFrame:
        if "fleet rows" not in views:
            rows = conform.conform_fleet(rows_in_window(landed.fleets), directory.companies)
            seen_fleets.append(outcome_watch())
            views["fleet rows"] = cut_lineage(rows, "fleets", "zstd", seen_fleets[0])
        return views["fleet rows"]

    def fleet_batch() -> DataFrame:
        return first_by(conform.accepted(judged_fleets()), FLEET_KEY, [F.col("internal_id")])

    def discover() -> tuple[DataFrame, int]:
        like = fleet_batch().limit(0)
        known = read_table(spark, warehouse.fleet.path)
        reconciled = cut_lineage(
            lookups.reconcile_fleets(
                lookups.normalize_discovered_fleet(landed.fleet_search),
                like if known is None else known, directory.companies,
            ),
            "reconciled", "zstd",
        )
        batch = _complete(discovered_fleet_rows(reconciled), like)
        table = daily.discovered_fleet_table(warehouse.fleet.path)
        return load("fleets", table, batch, reconciled.filter("outcome = 'pending'").count())

    def load_fleets() -> tuple[DataFrame, int]:
        rejects = keep("fleets", judged_fleets())
        seen["fleets"] = seen_fleets[0]
        return load("fleets", warehouse.fleet, fleet_batch(), rejects)

    def load_drivers() -> tuple[DataFrame, int]:
        rows = conform.conform_driver(rows_in_window(landed.drivers), directory.users, default_location)
        judged = cut_lineage(rows, "drivers", "zstd", watch("drivers"))
        batch = first_by(conform.accepted(judged), DRIVER_KEY, [F.col("account_id")])
        return load("drivers", warehouse.driver, batch.drop("_focus_id"), keep("drivers", judged))

    def load_scores() -> tuple[DataFrame, int]:
        day = snapshot_date("end_date", end=window.end, now=run_at)
        raw = rows_in_window(landed.driver_scores)
        judged = conform.conform_driver_score(
            raw, views["fleets"], views["drivers"], day, "position", daily.source_order(raw), watch("driver_scores")
        )
        return load("driver_scores", warehouse.driver_score, conform.accepted(judged), keep("driver_scores", judged))

    def load_trips() -> tuple[DataFrame, int]:
        raw = rows_in_window(landed.trip_scores)
        judged = conform.conform_trip_score(
            raw, views["fleets"], views["drivers"], "position", daily.source_order(raw), watch("trip_scores")
        )
        batch = daily.with_end_day(conform.accepted(judged))
        return load("trip_scores", warehouse.trip_score, batch, keep("trip_scores", judged))

    report.step("discovery", discover)
    fleets_loaded = report.step("fleets", load_fleets)
    if not fleets_loaded and "fleets" not in views:
        stored = read_table(spark, warehouse.fleet.path)
        if stored is not None:
            views["fleets"] = stored
    if report.step("drivers", load_drivers) and "fleets" in views:
        report.step("driver_scores", load_scores)
        report.step("trip_scores", load_trips)
    else:
        missing = "drivers" if "drivers" not in views else "fleets"
        for entity in ("driver_scores", "trip_scores"):
            report.skip(entity, f"{missing} were not loaded")

    for table, raw in zip(warehouse.points, (landed.trip_locations, landed.trip_incidents)):
        def load_points(table=table, raw=raw) -> tuple[DataFrame, int]:
            judged = cut_lineage(daily.judge_points(rows_in_window(raw), table), "points", "zstd", watch(table.name))
            return load(table.name, table, daily.distinct_points(judged, table), keep(table.name, judged))

        report.step(table.name, load_points)

    if not dry_run and "trip_scores" in merges:
        trips = merges["trip_scores"]
        if refresh != "touched":
            report.step("rollups", lambda: _refresh(spark, directory, warehouse, trips, refresh == "all"))
        elif days := sorted(d for d in trips.touched if d is not None):
            report.step("rollups", lambda: _refresh_days(spark, directory, warehouse, days))
    if not dry_run and not report.failed:
        advance_watermark(spark, warehouse.path("watermark"), job, window.end, run_at)
    return report


def _refresh(
    spark: SparkSession, directory: Directory, warehouse: Warehouse, trips: Merge, rebuild: bool
) -> tuple[DataFrame, int]:
    """Rollups from what changed, or from all trips."""
    sides = maintenance.Sides(
        directory.subscriptions, directory.company_subscriptions, directory.companies,
        read_table(spark, warehouse.driver.path), directory.users,
    )
    done = maintenance.refresh(
        spark, warehouse.trip_score.path, sides, warehouse.path("rollups"), trips, rebuild
    )
    return _rollup_counts(spark, done.stored)


def _refresh_days(
    spark: SparkSession, directory: Directory, warehouse: Warehouse, days: list[str]
) -> tuple[DataFrame, int]:
    """Rollups of some days from their trips."""
    stored = refresh_rollups(
        conform.derive_trip_times(read_table(spark, warehouse.trip_score.path, days)), directory.subscriptions,
        directory.company_subscriptions, directory.companies,
        read_table(spark, warehouse.driver.path), directory.users, warehouse.path("rollups"),
        days=days,
    )
    return _rollup_counts(spark, stored)


def _rollup_counts(spark: SparkSession, stored: dict[str, DataFrame]) -> tuple[DataFrame, int]:
    """The counts are trips and driver-days of the day rollup that were written."""
    days = stored.get("trip_day_rollup", spark.createDataFrame([], "trip_count long"))
    counts = days.agg(
        F.lit("rollups"), F.coalesce(F.sum("trip_count"), F.lit(0)), F.count("*"),
        F.lit(0).cast("bigint"),
    )
    return counts, 0
