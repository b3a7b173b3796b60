"""Time windows of a run, the high watermark, and the days a window touches."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta, timezone
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# How far back a stale watermark reaches, the window of a first run, the default range
# and the length from which a range is flagged.
LOOKBACK = timedelta(days=30)
FIRST_RUN = timedelta(days=1)
DEFAULT_RANGE = timedelta(days=30)
LONG_RANGE = timedelta(days=45)


class RunWindow(NamedTuple):
    """Half-open UTC window ``[start, end)`` and the name of the rule that made it."""

    start: datetime
    end: datetime
    source: str


def moment(value: datetime | str) -> datetime:
    """A date-time, or one in ISO format, as UTC to the second; without a zone it is UTC already."""
    given = datetime.fromisoformat(value) if isinstance(value, str) else value
    zoned = given if given.tzinfo else given.replace(tzinfo=timezone.utc)
    return zoned.astimezone(timezone.utc).replace(microsecond=0)


def checked(start: datetime | str, end: datetime | str, source: str) -> RunWindow:
    """The window between two moments in order."""
    window = RunWindow(moment(start), moment(end), source)
    if window.start > window.end:
        raise ValueError(f"{source}: {window.start} is after {window.end}")
    return window


def _start_after(mark, now, earlier: Callable, later: Callable):
    """Start rule of the watermark: within the look-back, and not in the future."""
    return earlier(later(mark, now - (LOOKBACK if isinstance(now, datetime) else F.lit(LOOKBACK))), now)


def _trailing(length: timedelta, source: str) -> Callable[..., RunWindow]:
    return lambda now: checked(now - length, now, source)


def _hours(now: datetime, hours: int = 24) -> RunWindow:
    if hours < 1:
        raise ValueError(f"a window of {hours} hours is empty")
    return checked(now - timedelta(hours=hours), now, f"rolling_{hours}h")


def _since(now: datetime, watermark: datetime | str | None = None) -> RunWindow:
    if watermark is None:
        return checked(now - FIRST_RUN, now, "rolling_24h")
    return checked(_start_after(moment(watermark), now, min, max), now, "since_last_success")


def _day(now: datetime) -> RunWindow:
    midnight = now.replace(hour=0, minute=0, second=0)
    return checked(midnight, midnight + timedelta(days=1), "utc_day")


def _given(now: datetime, start: datetime | str, end: datetime | str) -> RunWindow:
    return checked(start, end, "env")


#: Rule of each mode; a rule takes the present moment and the options of its mode.
MODES: dict[str, Callable[..., RunWindow]] = {
    "rolling_24h": _trailing(timedelta(hours=24), "rolling_24h"),
    "rolling_7d": _trailing(timedelta(days=7), "rolling_7d"),
    "rolling_hours": _hours,
    "since_last_success": _since,
    "utc_day": _day,
    "env": _given,
}


def window_of(mode: str, now: datetime, **options) -> RunWindow:
    """Window of a run that starts now: a mode of :data:`MODES` and its options."""
    if mode not in MODES:
        raise ValueError(f"no window mode {mode!r}; there are {', '.join(MODES)}")
    return MODES[mode](moment(now), **options)


def default_range(now: datetime, start=None, end=None) -> RunWindow:
    """Given bounds, or the last 30 days when neither is given."""
    given = [x for x in (start, end) if x is not None]
    if len(given) == 1:
        raise ValueError("a range needs both bounds or none")
    return checked(*given, "env") if given else checked(moment(now) - DEFAULT_RANGE, now, "default")


def snapshot_date(mode: str, *, end: datetime, now: datetime, custom: date | None = None) -> date:
    """Snapshot date of score rows that carry none: end of the range, run date or a given date."""
    dates = {"end_date": end.date(), "run_date": now.date(), "custom": custom}
    if dates.get(mode) is None:
        raise ValueError(f"no snapshot date for mode {mode!r}")
    return dates[mode]


def since_watermark(marks: DataFrame, mark: str, now: Column) -> DataFrame:
    """Start of the next window for a table of watermarks: not older than 30 days, not in the future.

    A missing watermark gives the last 24 hours.
    """
    first = F.col(mark).isNull()
    start = _start_after(F.col(mark), now, F.least, F.greatest)
    return marks.withColumns(
        {
            "window_start": F.when(first, now - F.lit(FIRST_RUN)).otherwise(start),
            "window_end": now,
            "window_source": F.when(first, "rolling_24h").otherwise("since_last_success"),
        }
    )


def range_check(ranges: DataFrame, start: str, end: str) -> DataFrame:
    """Marks ranges that end before they start or span more than 45 days."""
    long = F.col(end) - F.lit(LONG_RANGE) > F.col(start)
    status = F.when(F.col(end) < F.col(start), "invalid").when(long, "over_45_days").otherwise("ok")
    return ranges.withColumn("range_status", status)


def daily_windows(ranges: DataFrame, start: str, end: str) -> DataFrame:
    """One row per UTC day a range touches, clamped to the range; empty days are left out."""
    days = F.sequence(F.col(start).cast("date"), F.col(end).cast("date"))
    exploded = ranges.withColumn("day", F.explode(days))
    day_start = F.col("day").cast("timestamp_ntz")
    return exploded.withColumns(
        {
            "day_start": F.greatest(F.col(start), day_start),
            "day_end": F.least(F.col(end), day_start + F.expr("INTERVAL 1 DAY")),
        }
    ).filter("day_start <> day_end")


def windows_frame(spark: SparkSession, windows: list[RunWindow]) -> DataFrame:
    rows = [
        (w.start.replace(tzinfo=None), w.end.replace(tzinfo=None), w.source) for w in windows
    ]
    return spark.createDataFrame(
        rows, "window_start timestamp_ntz, window_end timestamp_ntz, window_source string"
    )
