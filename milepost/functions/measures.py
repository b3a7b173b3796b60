"""Distances, means, durations, buckets and epoch times with exact decimal rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from milepost.schemas import INCIDENT_COLUMNS

# Thresholds and labels of the dashboard buckets.
METERS_PER_MILE = "1609.344"
LOW_DISTANCE_METERS = 80467
EXCELLENT_FROM = 90
FAIR_FROM = 72
LOW_DISTANCE, EXCELLENT, FAIR, RISKY = "Low distance", "Excellent", "Fair", "Risky"

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _dec(c: Column, precision: int, scale: int) -> Column:
    return c.cast(f"decimal({precision},{scale})")


# First and last millisecond of the years 1 to 9999.
FIRST_MS, LAST_MS = -62135596800000, 253402300799999


def epoch_in_range(c: Column) -> Column:
    """Whether epoch milliseconds are a time at all; NULL for NULL."""
    return c.between(FIRST_MS, LAST_MS)


def epoch_ms_to_timestamp(c: Column) -> Column:
    """UTC wall-clock time of epoch milliseconds, independent of the session time zone.

    NULL outside the years 1 to 9999: adding such a number would end the whole job.
    """
    return F.timestamp_add("MILLISECOND", F.when(epoch_in_range(c), c), F.expr(_EPOCH))


def timestamp_to_epoch_ms(c: Column) -> Column:
    return F.timestamp_diff("MILLISECOND", F.expr(_EPOCH), c.cast("timestamp_ntz"))


def epoch_ms_text(c: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of epoch milliseconds given as number or text, NULL for junk."""
    from milepost.functions.coerce import to_double

    ms = to_double(c.cast("string"))
    moment = epoch_ms_to_timestamp(F.when(epoch_in_range(ms), F.floor(ms)))
    return F.date_format(moment, "yyyy-MM-dd HH:mm:ss")


def meters_to_miles(meters: Column) -> Column:
    """Miles to three places, half away from zero.

    The quotient keeps 8 places. Quotients that are not ties are at least 4e-8 away from one, so
    the intermediate rounding never decides a tie.
    """
    return _dec(F.round(_dec(meters, 20, 0) / F.expr(METERS_PER_MILE + "BD"), 3), 20, 3)


def duration_minutes(start_ms: Column, end_ms: Column) -> Column:
    return _dec(F.round(_dec(end_ms - start_ms, 20, 0) / F.expr("60000BD"), 3), 20, 3)


def round_mean(mean: Column) -> Column:
    """A double mean to three places; 12 decimal places first, so binary noise decides no tie."""
    return _dec(F.round(_dec(F.coalesce(mean, F.lit(0.0)), 30, 12), 3), 18, 3)


def mean_of_decimals(c: Column) -> Column:
    """Exact mean of a ``decimal(18,3)`` column, to three places."""
    total = _dec(F.sum(c), 24, 3)
    return _dec(F.round(total / _dec(F.count(c), 12, 0), 3), 18, 3)


def count_to_long(c: Column) -> Column:
    """Double count as bigint, rounded half to even; NULL counts as 0."""
    return F.rint(F.coalesce(c, F.lit(0.0))).cast("bigint")


def incident_total(prefix: str = "") -> Column:
    total = F.lit(0).cast("bigint")
    for name in INCIDENT_COLUMNS:
        total = total + count_to_long(F.col(prefix + name))
    return total


def trip_class(score: Column) -> Column:
    s = F.coalesce(score, F.lit(0.0))
    return F.when(s >= EXCELLENT_FROM, EXCELLENT).when(s >= FAIR_FROM, FAIR).otherwise(RISKY)


def day_bucket(distance_samples: Column, meters: Column, mean_score: Column) -> Column:
    """Bucket of one driver-day, from the unrounded sum and mean."""
    short = (distance_samples > 0) & (meters < LOW_DISTANCE_METERS)
    return F.when(short, LOW_DISTANCE).otherwise(trip_class(mean_score))
