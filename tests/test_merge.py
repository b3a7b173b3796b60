from datetime import datetime

from pyspark.sql import functions as F

from milepost.operators import merge
from milepost.plans import store, tables
from milepost.session import scratch_dir

OLD, NEW = datetime(2024, 1, 1), datetime(2024, 2, 2)


def stored(spark, data):
    df = spark.createDataFrame(data, "k string, a long, g struct<x:double,y:string>, extra string")
    moment = F.lit(str(OLD)).cast("timestamp_ntz")
    return df.withColumns({c: moment for c in merge.AUDIT})


def batch(spark, data):
    return spark.createDataFrame(data, "k string, a long, g struct<x:double,y:string>")


ROWS = [("same", 1, (1.0, None), "e"), ("nulls", None, None, "e"), ("diff", 1, None, "e"),
        ("quiet", 5, None, "e")]


def test_actions_and_stamps(spark):
    got = merge.upsert(
        stored(spark, ROWS),
        batch(spark, [("same", 1, (1.0, None)), ("nulls", None, None), ("diff", 1, (2.0, "z")),
                      ("new", 9, None)]),
        ["k"], ["a", "g"], NEW,
    )
    rows = {r["k"]: r for r in got.collect()}
    assert {k: r["_action"] for k, r in rows.items()} == {
        "same": "unchanged", "nulls": "unchanged", "diff": "update", "new": "insert",
        "quiet": "keep",
    }
    assert rows["diff"]["g"].x == 2.0 and rows["diff"]["updated_at"] == NEW
    assert rows["diff"]["created_at"] == OLD and rows["diff"]["extra"] == "e"
    assert rows["same"]["last_synced_at"] == OLD and rows["new"]["created_at"] == NEW
    assert rows["new"]["extra"] is None


def test_second_run_changes_nothing(spark):
    source = batch(spark, [("same", 2, None), ("new", 9, (0.5, "q"))])
    once = merge.merged_table(merge.upsert(stored(spark, ROWS), source, ["k"], ["a", "g"], NEW))
    again = merge.merge_counts(merge.upsert(once, source, ["k"], ["a", "g"], NEW), "t").first()
    assert tuple(again) == ("t", 0, 0, 2)


def test_touch_merge_updates_every_match(spark):
    got = merge.upsert(stored(spark, ROWS), batch(spark, [("same", 7, None)]), ["k"], [], NEW)
    row = got.filter("k = 'same'").first()
    assert (row["_action"], row["a"], row["last_synced_at"]) == ("update", 1, NEW)


def test_null_keys_never_match(spark):
    got = merge.upsert(
        stored(spark, [(None, 1, None, "e")]), batch(spark, [(None, 1, None)]), ["k"], ["a"], NEW
    )
    assert sorted(r["_action"] for r in got.collect()) == ["insert", "keep"]


def test_small_batch_does_not_shuffle_the_target(spark):
    target, source = scratch_dir(spark, "t"), scratch_dir(spark, "s")
    stored(spark, ROWS).write.parquet(target)
    batch(spark, [("same", 7, None)]).write.parquet(source)
    plan = merge.upsert(
        spark.read.parquet(target), spark.read.parquet(source), ["k"], ["a", "g"], NEW
    )._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 3


def test_merge_into_rewrites_only_touched_partitions(spark):
    table = tables.StoredTable("t", scratch_dir(spark, "tab"), ["k"], ["a"], buckets=16)
    first = spark.createDataFrame([(f"k{i}", i) for i in range(200)], "k string, a long")
    assert tuple(tables.merge_into(spark, table, first, OLD).first()) == ("t", 200, 0, 0)

    def files():
        return {r[0] for r in tables.read_table(spark, table.path).select(
            F.col("_metadata.file_path")).distinct().collect()}

    before = files()
    change = spark.createDataFrame([("k3", 99), ("k4", 4), ("new", 1)], "k string, a long")
    assert tuple(tables.merge_into(spark, table, change, NEW, dry_run=True).first()) == (
        "t", 1, 1, 1)
    assert files() == before
    assert tuple(tables.merge_into(spark, table, change, NEW).first()) == ("t", 1, 1, 1)
    kept = before & files()
    assert len(before) - 3 <= len(kept) < len(before)
    table_now = tables.read_table(spark, table.path)
    assert table_now.count() == 201
    assert table_now.filter("k = 'k3'").first()["a"] == 99
    assert tuple(tables.merge_into(spark, table, change, NEW).first()) == ("t", 0, 0, 3)


def test_watermark(spark):
    path = scratch_dir(spark, "marks")
    assert tables.read_watermark(spark, path, "j") is None
    tables.advance_watermark(spark, path, "j", OLD, NEW)
    tables.advance_watermark(spark, path, "j", NEW, NEW)
    tables.advance_watermark(spark, path, "other", datetime(2030, 1, 1), NEW)
    assert tables.read_watermark(spark, path, "j") == NEW


def test_rows_that_move_leave_their_old_partition(spark):
    table = tables.StoredTable("t", scratch_dir(spark, "moving"), ["k"], ["d"], partition="d")
    first = spark.createDataFrame([("a", 1), ("b", 2), ("c", 2)], "k string, d int")
    tables.merge_into(spark, table, first, OLD)
    change = spark.createDataFrame([("a", 3), ("b", 3)], "k string, d int")
    assert tuple(tables.merge_into(spark, table, change, NEW).first()) == ("t", 0, 2, 0)
    now = tables.read_table(spark, table.path)
    assert sorted((r["k"], r["d"]) for r in now.collect()) == [("a", 3), ("b", 3), ("c", 2)]
    assert now.filter("k = 'a'").first()["created_at"] == OLD


def frame(spark, data):
    return spark.createDataFrame(data, "k string, d string, a long")


def test_first_load_without_rows_is_a_table(spark):
    table = tables.StoredTable("t", scratch_dir(spark, "empty"), ["k"], ["a"], partition="d")
    assert tables.read_table(spark, table.path) is None
    assert tuple(tables.merge_into(spark, table, frame(spark, []), OLD).first()) == ("t", 0, 0, 0)
    assert tables.read_table(spark, table.path).count() == 0
    assert tuple(tables.merge_into(spark, table, frame(spark, [("x", "1", 1)]), NEW).first()) == ("t", 1, 0, 0)
    assert tables.read_table(spark, table.path).count() == 1


def test_null_partition_keeps_its_rows(spark):
    table = tables.StoredTable("t", scratch_dir(spark, "nulls"), ["k"], ["a", "d"], partition="d")
    tables.merge_into(spark, table, frame(spark, [("x", None, 1), ("y", "1", 1)]), OLD)
    done = tables.merge_into(spark, table, frame(spark, [("z", None, 2), ("y", None, 5)]), NEW)
    assert tuple(done.first()) == ("t", 1, 1, 0)
    now = tables.read_table(spark, table.path)
    assert sorted((r["k"], r["d"], r["a"]) for r in now.collect()) == [
        ("x", None, 1), ("y", None, 5), ("z", None, 2)]


def test_a_merge_that_breaks_off_leaves_the_old_version(spark, monkeypatch):
    table = tables.StoredTable("t", scratch_dir(spark, "broken"), ["k"], ["a", "d"], partition="d")
    tables.merge_into(spark, table, frame(spark, [("x", "1", 1), ("y", "2", 1)]), OLD)
    real = tables.store.commit

    def broken(*_):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(tables.store, "commit", broken)
    change = frame(spark, [("x", "3", 7)])
    try:
        tables.merge_into(spark, table, change, NEW)
    except RuntimeError:
        pass
    seen = tables.read_table(spark, table.path)
    assert sorted((r["k"], r["d"]) for r in seen.collect()) == [("x", "1"), ("y", "2")]
    monkeypatch.setattr(tables.store, "commit", real)
    assert tuple(tables.merge_into(spark, table, change, NEW).first()) == ("t", 0, 1, 0)
    row = tables.read_table(spark, table.path).filter("k = 'x'").first()
    assert (row["d"], row["created_at"]) == ("3", OLD)
    assert tables.store.vacuum(spark, table.path) >= 1
    assert tables.read_table(spark, table.path).count() == 2


def test_two_writers_of_one_version(spark):
    path = scratch_dir(spark, "race")
    first = tables.store.commit(spark, path, None, frame(spark, []).schema, {})
    for _ in range(2):
        try:
            tables.store.commit(spark, path, first, frame(spark, []).schema, {})
        except RuntimeError as exc:
            assert "another writer" in str(exc)
            break
    else:
        raise AssertionError("both writers made version 2")


def test_whole_join_is_the_same_merge(spark):
    source = [("same", 1, (1.0, None)), ("nulls", None, None), ("diff", 1, (2.0, "z")), ("new", 9, None), (None, 3, None)]
    target = ROWS + [(None, 1, None, "e"), ("diff", 4, None, "twice")]
    for columns in (["a", "g"], []):
        few, whole = (
            merge.upsert(stored(spark, target), batch(spark, source), ["k"], columns, NEW, whole=w) for w in (False, True)
        )
        assert few.columns == whole.columns
        assert sorted(map(str, few.collect())) == sorted(map(str, whole.collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = whole._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Join ") == 1


def test_large_batches_take_the_whole_join(spark, monkeypatch):
    monkeypatch.setattr(tables, "WHOLE_JOIN_ROWS", 1)
    table = tables.StoredTable("t", scratch_dir(spark, "whole"), ["k"], ["d", "a"], partition="d")
    first = spark.createDataFrame([("a", 1, 1), ("b", 2, 1), ("c", 2, 1)], "k string, d int, a long")
    tables.merge_into(spark, table, first, OLD)
    change = spark.createDataFrame([("a", 3, 1), ("b", 2, 1), ("n", 2, 5)], "k string, d int, a long")
    done = tables.merge(spark, table, change, NEW)
    assert tuple(done.counts.first()) == ("t", 1, 1, 1) and done.batch_rows == 3
    kept = {tuple(r) for r in tables.read_table(spark, table.path).select("k", "d", "a", "created_at").collect()}
    assert kept == {("a", 3, 1, OLD), ("b", 2, 1, OLD), ("c", 2, 1, OLD), ("n", 2, 5, NEW)}
    signs = {(r["k"], r["d"], r["_sign"]) for r in done.changes.collect()}
    assert signs == {("a", 3, 1), ("a", 1, -1), ("n", 2, 1)}


def test_a_first_load_joins_nothing_and_is_compressed(spark, monkeypatch):
    def no_join(*_, **__):
        raise AssertionError("a first load was joined")

    monkeypatch.setattr(tables, "upsert", no_join)
    table = tables.StoredTable("t", scratch_dir(spark, "first"), ["k"], ["a", "d"], partition="d")
    rows = spark.createDataFrame([("a", 1, 1), (None, 2, 1), ("c", None, 1)], "k string, d int, a long")
    done = tables.merge(spark, table, rows, NEW)
    assert tuple(done.counts.first()) == ("t", 3, 0, 0) and set(done.touched) == {"1", "2", None}
    assert done.batch_rows == 3 and done.changes.filter("_sign = 1").count() == 3
    read = tables.read_table(spark, table.path)
    assert read.columns == ["k", "a", "d", *merge.AUDIT]
    assert all(r[0].endswith(".zstd.parquet") for r in read.select(F.col("_metadata.file_path")).collect())


def test_dry_run_counts_write_no_rows(spark):
    table = tables.StoredTable("t", scratch_dir(spark, "dry"), ["k"], ["a"], buckets=4)
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "k string, a long")
    assert tuple(tables.merge_into(spark, table, rows, OLD, dry_run=True).first()) == ("t", 2, 0, 0)
    assert tables.read_table(spark, table.path) is None
    tables.merge_into(spark, table, rows, OLD)
    change = spark.createDataFrame([("a", 1), ("b", 3), ("c", 4)], "k string, a long")
    got = tables.merge_into(spark, table, change, NEW, dry_run=True)
    assert tuple(got.first()) == ("t", 1, 1, 1) and got.schema.simpleString().count("bigint") == 3
    assert store.vacuum(spark, table.path) == 0
    assert sorted(r[0] for r in tables.read_table(spark, table.path).select("a").collect()) == [1, 2]
