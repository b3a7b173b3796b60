"""Rollups kept up to date from what a merge changed.

Next to the rollups lies a table of partial states per driver-day (``driver_day_state``), over the trips of all
companies. A merge's change rows are applied to it by day:

* inserted trips are aggregated and merged into the states of their driver-days;
* a driver-day that loses a trip (it was corrected, or moved to another day or driver) can't be told from
  sums and extremes, so it alone is aggregated anew from the trips of its day;
* other days, and other driver-days of the same day, are not read from the trips again.

The rollups depend on companies, subscriptions, drivers and users too. A table of marks remembers, per driver and
company, a hash of what the rollups took from them; where a mark differs from the present one, the driver's or company's
days are found in the states and built anew from them. Only days with changed trips or changed names go through the
trips again for the trip list.

Marks name the version of the trips that the states hold and are written last. Whenever that isn't the version
a merge began from (first run, a run that broke off, another writer), everything is rebuilt from the trips.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from milepost.operators import conform, rollups
from milepost.plans import store
from milepost.plans.tables import (
    Merge, partition_values, read_table, store_day_rollups, store_trip_list, stored_eligible, write_partitions,
)
from milepost.session import cut_lineage

STATE, MARKS = "driver_day_state", "rollup_marks"


@dataclass(frozen=True)
class Sides:
    """The tables that rollups are joined with."""

    subscriptions: DataFrame
    company_subscriptions: DataFrame
    companies: DataFrame
    drivers: DataFrame
    users: DataFrame
    subscription_name: str = rollups.DEFAULT_SUBSCRIPTION


@dataclass(frozen=True)
class Refresh:
    """What a refresh did: the rollups it wrote (all days, or those listed), and which days those were."""

    stored: dict[str, DataFrame]
    rollup_days: list[str] | None
    list_days: list[str] | None


def _mark(*columns: Column) -> Column:
    return F.xxhash64(*[F.to_json(F.struct(c), {"ignoreNullFields": "false"}) for c in columns])


def present_marks(sides: Sides, eligible: DataFrame) -> DataFrame:
    """kind, key, and hashes of what the rollups and the trip list take from each driver and company."""
    users = sides.users.select(
        F.col("id").alias("user_id"), F.col("email"), "display_name", "first_name", "last_name", F.lit(True).alias("known")
    )
    drivers = sides.drivers.select("driver_id", "user_id").join(users, "user_id", "left")
    names = [F.col(c) for c in ("display_name", "first_name", "last_name")]
    companies = sides.companies.select(F.col("id").alias("company_id"), "company_name").join(
        eligible.withColumn("eligible", F.lit(True)), "company_id", "full"
    )
    return drivers.select(
        F.lit("driver").alias("kind"), F.col("driver_id").cast("string").alias("key"),
        _mark(F.col("user_id"), F.col("known"), F.col("email")).alias("rollup_mark"),
        _mark(F.coalesce("known", F.lit(False)), *names).alias("list_mark"),
    ).union(
        companies.select(
            F.lit("company"), F.col("company_id").cast("string"), _mark(F.col("company_name"), F.col("eligible")),
            _mark(F.col("eligible")),
        )
    )


def _moved_keys(before: DataFrame, now: DataFrame, mark: str) -> DataFrame:
    """kind, key of drivers and companies that came, went or have another mark."""
    old, new = (df.groupBy("kind", "key").agg(F.min(mark).alias(m)) for df, m in ((before, "_a"), (now, "_b")))
    return old.join(new, ["kind", "key"], "full").filter(~F.col("_a").eqNullSafe(F.col("_b"))).select("kind", "key")


def _days_of(states: DataFrame, moved: DataFrame) -> list[str | None]:
    """Days on which a moved driver or company has trips."""
    days = None
    for kind, column in (("driver", "driver_id"), ("company", "company_id")):
        keys = moved.filter(F.col("kind") == kind).select(F.col("key").alias(column))
        hit = states.select(F.col(column).cast("string").alias(column), "reporting_day").distinct().join(
            keys, column, "left_semi"
        ).select("reporting_day")
        days = hit if days is None else days.union(hit)
    return partition_values(days, "reporting_day")


def _anti_or_semi(rows: DataFrame, groups: DataFrame, how: str) -> DataFrame:
    return rows.alias("r").join(groups.alias("g"), rollups.same_group("r", "g"), how)


def apply_changes(spark: SparkSession, trip_path: str, changes: DataFrame, out_path: str) -> list[str | None]:
    """Brings the states up to date with the merge's change rows; gives the days that it rewrote."""
    changed = conform.derive_trip_times(changes)
    # written as states and driver-days: of the rows as they were, only the keys of their groups are read and moved
    added = cut_lineage(rollups.day_states(changed.filter("_sign > 0")), "added-states", "zstd")
    lost = cut_lineage(rollups.state_groups(changed.filter("_sign < 0")), "lost-trips", "zstd")
    days = partition_values(added.select("reporting_day").union(lost.select("reporting_day")), "reporting_day")
    if not days:
        return []
    held = read_table(spark, f"{out_path}/{STATE}", days)
    if lost.isEmpty():
        states = rollups.merge_states(held.unionByName(added))
    else:
        kept = _anti_or_semi(held.unionByName(added), lost, "left_anti")
        lost_days = partition_values(lost, "reporting_day")
        trips = read_table(spark, trip_path, lost_days)
        again = rollups.with_reporting_day(conform.derive_trip_times(trips))
        anew = rollups.day_states(_anti_or_semi(again, lost, "left_semi").drop("reporting_day"))
        states = rollups.merge_states(kept).unionByName(anew)
    write_partitions(states, f"{out_path}/{STATE}", "reporting_day", days)
    return days


def _trips_version(marks: store.Version | None) -> int | None:
    """The trips' version that the states hold: the partition of the marks."""
    return None if marks is None or not marks.folders else int(next(iter(marks.folders)))


def refresh(
    spark: SparkSession, trip_path: str, sides: Sides, out_path: str, done: Merge | None = None,
    rebuild: bool = False,
) -> Refresh:
    """Makes the rollups at ``out_path`` those of the stored trips and the sides.

    ``done`` is the merge that made the trips' newest version. Without it, the trips count as unchanged
    since the last refresh if their version is the one that the states hold.
    """
    current = store.latest(spark, trip_path)
    if current is None:
        raise ValueError(f"no trips are stored at {trip_path}")
    eligible = stored_eligible(sides.subscriptions, sides.company_subscriptions, sides.subscription_name)
    marks = cut_lineage(present_marks(sides, eligible), "rollup-marks", "zstd")
    marks_path, state_path = f"{out_path}/{MARKS}", f"{out_path}/{STATE}"
    last = store.latest(spark, marks_path)
    held = _trips_version(last)
    follows = held is not None and (
        held == current.number or (done is not None and done.version.number == current.number and held == done.before)
    )
    rollup_days: list[str | None] | None = None
    list_days: list[str | None] | None = None
    if follows and not rebuild:
        touched = [] if held == current.number else apply_changes(spark, trip_path, done.changes, out_path)
        before, states = store.read_version(spark, last), read_table(spark, state_path)
        rollup_days, list_days = (
            sorted({*touched, *_days_of(states, _moved_keys(before, marks, mark))})
            for mark in ("rollup_mark", "list_mark")
        )
    else:
        trips = store.read_version(spark, current)
        write_partitions(rollups.day_states(conform.derive_trip_times(trips)), state_path, "reporting_day")
    stored = {}
    if rollup_days is None or rollup_days:
        combined = rollups.event_rollup_of_states(
            read_table(spark, state_path, rollup_days), eligible, sides.companies, sides.drivers, sides.users
        )
        stored |= store_day_rollups(combined, out_path, rollup_days)
    if list_days is None or list_days:
        # a trip's partition is its end day
        trips = conform.derive_trip_times(read_table(spark, trip_path, list_days))
        trip_list = rollups.driver_trip_list(trips, eligible, sides.drivers, sides.users)
        stored |= store_trip_list(trip_list, out_path, list_days)
    write_partitions(marks.withColumn("trips_version", F.lit(current.number)), marks_path, "trips_version")
    return Refresh(stored, rollup_days, list_days)
