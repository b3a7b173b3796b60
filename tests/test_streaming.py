from datetime import datetime

from pyspark.sql import functions as F

from milepost.operators import conform
from milepost.plans import daily, tables
from milepost.session import scratch_dir
from milepost.streaming import landing
from tests.helpers import drivers, fleets, landed
from tests.test_conform import TRIP

STAMP = datetime(2024, 3, 1)


def run(spark, path, table, checkpoint):
    query = landing.stream_into(
        landing.landed_stream(spark, path, "trip_scores", "position long", files_per_batch=1),
        lambda rows: daily.with_end_day(
            conform.accepted(
                conform.conform_trip_score(rows, fleets(spark), drivers(spark, "tp-1"), "position")
            )
        ),
        table,
        checkpoint,
        lambda: STAMP,
    )
    query.awaitTermination()
    assert query.exception() is None
    return query


def test_restart_takes_only_new_files(spark):
    path, checkpoint = scratch_dir(spark, "landed"), scratch_dir(spark, "checkpoint")
    table = daily.trip_table(scratch_dir(spark, "trips"))
    first = landed(spark, "trip_scores", [{**TRIP, "tripId": "a"}, {**TRIP, "tripId": "b"}])
    first.coalesce(1).write.mode("append").json(path)
    run(spark, path, table, checkpoint)
    second = landed(
        spark, "trip_scores",
        [{**TRIP, "tripId": "b", "endDate": 90_000_000}, {**TRIP, "tripId": "c"}],
    )
    second.coalesce(1).write.mode("append").json(path)
    again = run(spark, path, table, checkpoint)
    assert len([p for p in again.recentProgress if p["numInputRows"]]) == 1
    stored = {r["trip_id"]: r for r in tables.read_table(spark, table.path).collect()}
    assert sorted(stored) == ["a", "b", "c"]
    assert stored["b"]["end_date"] == 90_000_000
    count = tables.read_table(spark, table.path).filter(F.col("trip_id") == "b").count()
    assert count == 1


def points(spark, ids):
    return daily.with_point_month(spark.createDataFrame(
        [(t, 1, 1_700_000_000_000, 1.0, 2.0) for t in ids],
        "trip_id string, account_id long, timestamp_ms long, latitude double, longitude double",
    ))


def test_repeated_batch_is_skipped(spark):
    """A touch merge that was committed: the batch comes again, no stamp moves and nothing is counted."""
    table, _ = daily.point_tables(scratch_dir(spark, "points"), scratch_dir(spark, "incidents"))
    batches = scratch_dir(spark, "batches")
    first = landing.merge_once(points(spark, "ab"), 0, table, batches, STAMP)
    assert tuple(first.first())[1:] == (2, 0, 0)
    second = landing.merge_once(points(spark, "bc"), 1, table, batches, STAMP)
    assert tuple(second.first())[1:] == (1, 1, 0)
    stamps = {r.trip_id: r.last_synced_at for r in tables.read_table(spark, table.path).collect()}
    assert stamps["a"] == STAMP < stamps["b"] == stamps["c"]
    assert landing.merge_once(points(spark, "bc"), 1, table, batches, datetime(2024, 3, 2)) is None
    assert {r.trip_id: r.last_synced_at for r in tables.read_table(spark, table.path).collect()} == stamps


def test_batch_that_broke_off_is_merged(spark, monkeypatch):
    """The list has it, the table doesn't: it is merged with the stamp it was given first."""
    table, _ = daily.point_tables(scratch_dir(spark, "points"), scratch_dir(spark, "incidents"))
    batches = scratch_dir(spark, "batches")
    landing.merge_once(points(spark, "a"), 0, table, batches, STAMP)

    def broken(*_):
        raise RuntimeError("lost")

    real = landing.merge_into
    monkeypatch.setattr(landing, "merge_into", broken)
    try:
        landing.merge_once(points(spark, "b"), 1, table, batches, datetime(2024, 3, 2))
        raise AssertionError
    except RuntimeError:
        pass
    monkeypatch.setattr(landing, "merge_into", real)
    done = landing.merge_once(points(spark, "b"), 1, table, batches, datetime(2024, 3, 9))
    assert tuple(done.first())[1:] == (1, 0, 0)
    stored = {r.trip_id: r.last_synced_at for r in tables.read_table(spark, table.path).collect()}
    assert stored == {"a": STAMP, "b": datetime(2024, 3, 2)}
    assert landing.begun_batch(spark, batches, 0) == (STAMP, datetime(2024, 3, 2))


def test_landed_parts_grow_with_the_table(spark, tmp_path):
    """A fixed number of parts makes each part, and the task that writes it, grow with the table."""
    from testbed.views import Bed

    (tmp_path / "lineitem.parquet").mkdir()
    (tmp_path / "lineitem.parquet" / "part-0.parquet").write_bytes(bytes(9 << 20))
    bed = Bed(spark, str(tmp_path))
    assert (bed.parts("lineitem", 16), bed.parts("lineitem", 1)) == (4, 9)
