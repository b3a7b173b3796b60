"""Queries behind the dashboards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from milepost.operators.lookups import active_roster
from milepost.plans import store


def roster_top_n(fleets: DataFrame, companies: DataFrame, limit: int) -> DataFrame:
    """First fleets of the roster by location."""
    return active_roster(fleets, companies).orderBy("retailer_location_id").limit(limit)


def driver_recent_trips(trip_list: DataFrame, company_id, driver_id: str) -> DataFrame:
    """A driver's trips, newest first."""
    mine = trip_list.filter(
        (F.col("company_id") == company_id) & (F.col("driver_id") == driver_id)
    )
    return mine.orderBy(F.col("end_date_datetime").desc(), "trip_id")


def top_scores(scored: DataFrame, score: str, tie: str, limit: int) -> DataFrame:
    """Best scores first, missing scores last; ties by id."""
    return scored.orderBy(F.col(score).desc_nulls_last(), tie).limit(limit)


def performance_cards(groups: DataFrame, company_id, first_day, last_day) -> DataFrame:
    """A company's day cards, newest day first."""
    day = F.col("reporting_day")
    chosen = groups.filter(
        (F.col("company_id") == company_id) & day.between(F.lit(first_day), F.lit(last_day))
    )
    return chosen.orderBy(day.desc(), "retailer_location_id", "performance_bucket")


def stored_recent_trips(
    spark: SparkSession, rollups_path: str, company_id, driver_id: str, first_day=None, last_day=None
) -> DataFrame:
    """A driver's trips from the stored list, newest first, of all days or of some.

    Days outside the range are not opened. Files are sorted by company and driver, so of the others only
    the pages whose statistics allow the driver are read.
    """
    version = store.latest(spark, f"{rollups_path}/driver_trip_list")
    if version is None:
        raise ValueError(f"no rollups are stored at {rollups_path}")
    days = [
        d for d in version.folders
        if d is not None and (first_day is None or str(first_day) <= d) and (last_day is None or d <= str(last_day))
    ]
    return driver_recent_trips(store.read_version(spark, version, days), company_id, driver_id)
