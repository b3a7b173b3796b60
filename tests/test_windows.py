from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from milepost.plans import windows
from milepost.plans.windows import RunWindow, window_of

NOW = datetime(2026, 6, 15, 12, 30, tzinfo=timezone.utc)


def utc(*args):
    return datetime(*args, tzinfo=timezone.utc)


@pytest.mark.parametrize(
    "mode, options, start, end, source",
    [
        ("rolling_24h", {}, utc(2026, 6, 14, 12, 30), NOW, "rolling_24h"),
        ("rolling_7d", {}, utc(2026, 6, 8, 12, 30), NOW, "rolling_7d"),
        ("rolling_hours", {}, utc(2026, 6, 14, 12, 30), NOW, "rolling_24h"),
        ("rolling_hours", {"hours": 6}, utc(2026, 6, 15, 6, 30), NOW, "rolling_6h"),
        ("since_last_success", {"watermark": "2026-06-10T08:00:12Z"}, utc(2026, 6, 10, 8, 0, 12),
         NOW, "since_last_success"),
        ("since_last_success", {}, utc(2026, 6, 14, 12, 30), NOW, "rolling_24h"),
        ("since_last_success", {"watermark": NOW - timedelta(days=60)}, utc(2026, 5, 16, 12, 30),
         NOW, "since_last_success"),
        ("since_last_success", {"watermark": NOW + timedelta(days=1)}, NOW, NOW,
         "since_last_success"),
        ("utc_day", {}, utc(2026, 6, 15), utc(2026, 6, 16), "utc_day"),
        ("env", {"start": "2026-06-01 00:00:00", "end": "2026-06-15"}, utc(2026, 6, 1),
         utc(2026, 6, 15), "env"),
    ],
)
def test_modes(mode, options, start, end, source):
    assert window_of(mode, NOW, **options) == RunWindow(start, end, source)


def test_bad_windows():
    with pytest.raises(ValueError):
        window_of("env", NOW, start="2026-06-02", end="2026-06-01")
    with pytest.raises(ValueError):
        window_of("rolling_hours", NOW, hours=0)
    with pytest.raises(ValueError):
        window_of("sometimes", NOW)
    with pytest.raises(ValueError):
        windows.default_range(NOW, start="2026-06-01")


def test_default_range_and_snapshot():
    assert windows.default_range(NOW).start == NOW - timedelta(days=30)
    end = utc(2026, 6, 9)
    assert windows.snapshot_date("end_date", end=end, now=NOW) == date(2026, 6, 9)
    assert windows.snapshot_date("run_date", end=end, now=NOW) == date(2026, 6, 15)
    assert windows.snapshot_date("custom", end=end, now=NOW, custom=date(2020, 1, 1)) == date(
        2020, 1, 1)


def test_daily_windows_are_clamped(spark):
    frame = windows.windows_frame(
        spark, [RunWindow(utc(2026, 6, 1, 18), utc(2026, 6, 3), "env")]
    )
    got = windows.daily_windows(frame, "window_start", "window_end").orderBy("day").collect()
    assert [(r["day"], r["day_start"], r["day_end"]) for r in got] == [
        (date(2026, 6, 1), datetime(2026, 6, 1, 18), datetime(2026, 6, 2)),
        (date(2026, 6, 2), datetime(2026, 6, 2), datetime(2026, 6, 3)),
    ]


def test_range_check(spark):
    frame = windows.windows_frame(
        spark,
        [RunWindow(utc(2026, 1, 1), utc(2026, 2, 15), "a"),
         RunWindow(utc(2026, 1, 1), utc(2026, 2, 15, 0, 0, 1), "b")],
    )
    got = windows.range_check(frame, "window_start", "window_end")
    assert {r["window_source"]: r["range_status"] for r in got.collect()} == {
        "a": "ok", "b": "over_45_days"}
    swapped = windows.range_check(frame, "window_end", "window_start")
    assert swapped.filter("range_status = 'invalid'").count() == 2


def test_since_watermark(spark):
    marks = spark.createDataFrame(
        [("a", datetime(2026, 6, 10)), ("b", datetime(2020, 1, 1)), ("c", datetime(2030, 1, 1)),
         ("d", None)], "j string, mark timestamp_ntz",
    )
    now = F.lit("2026-06-15 00:00:00").cast("timestamp_ntz")
    got = {r["j"]: r["window_start"] for r in
           windows.since_watermark(marks, "mark", now).collect()}
    assert got == {"a": datetime(2026, 6, 10), "b": datetime(2026, 5, 16),
                   "c": datetime(2026, 6, 15), "d": datetime(2026, 6, 14)}
