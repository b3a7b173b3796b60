"""Stored tables: merging a batch, the watermark, and the rollup refresh."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StringType

from milepost.operators import rollups
from milepost.operators.accounting import action_watch, row_watch
from milepost.operators.merge import INSERT, UPDATE, inserted, merge_counts, merged_table, upsert
from milepost.operators.reports import union_all
from milepost.plans import store
from milepost.session import cut_lineage, small_files


#: Most keys of a batch that become filters of the scan that looks for them.
PUSHED_KEYS = 10_000

#: A batch of more rows is merged by one full join; rows of any table here would not be broadcast at that number.
WHOLE_JOIN_ROWS = 200_000


@dataclass(frozen=True)
class StoredTable:
    """A Parquet table with its merge rules.

    ``partition`` names the partition column. Its value is either a function of the key, so that a
    row never changes its partition, or one of the ``update_columns``, so that it may (the end day of
    a trip). A table without such a column is partitioned by a hash of the key into ``buckets``.
    """

    name: str
    path: str
    keys: list[str]
    update_columns: list[str]
    partition: str = "merge_bucket"
    buckets: int = 64
    generated: tuple[str, ...] = field(default=())

    @property
    def rows_move(self) -> bool:
        return self.partition in self.update_columns

    @property
    def sought(self) -> list[str]:
        """Columns by which stored rows are looked for: the keys of rows that may be anywhere."""
        return self.keys if self.rows_move else []

    def with_partition(self, df: DataFrame) -> DataFrame:
        if self.partition in df.columns:
            return df
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        return df.withColumn(self.partition, bucket)


def read_table(spark: SparkSession, path: str, values: list[str | None] | None = None) -> DataFrame | None:
    """The stored table (or some of its partitions, by their values as text); None before its first load."""
    version = store.latest(spark, path)
    return None if version is None else store.read_version(spark, version, values)


def partition_values(df: DataFrame, partition: str) -> list[str | None]:
    """Distinct partition values as text: one per folder, not per row."""
    return [r[0] for r in df.select(F.col(partition).cast("string")).distinct().collect()]


def write_partitions(
    df: DataFrame, path: str, partition: str, replaced: list[str | None] | None = None, order: list | None = None,
    sought: list[str] | None = None, watch=None,
) -> DataFrame:
    """Replaces a stored table, or only the given partitions of it, and returns what was written.

    Replaced partitions for which there are no rows go. The new version counts once it is complete. A ``watch``
    (`operators.accounting`) counts the rows as they are written.
    """
    spark = df.sparkSession
    before = store.latest(spark, path)
    written = store.write_folders(df, path, partition, watch, order=order, sought=sought)
    kept = {} if before is None or replaced is None else {
        v: f for v, f in before.folders.items() if v not in set(replaced) | set(written)
    }
    version = store.commit(spark, path, before, df.schema, kept | written)
    return store.read_version(spark, version, list(written))


def write_table(df: DataFrame, table: StoredTable) -> None:
    write_partitions(table.with_partition(df), table.path, table.partition, sought=table.sought)


def touched_partitions(table: StoredTable, target: DataFrame, batch: DataFrame) -> list[str | None]:
    """Partitions the batch goes to, and those its keys are stored in now (where rows can move)."""
    values = batch.select(table.partition)
    if table.rows_move:
        values = values.union(held_rows(table, target, batch).select(table.partition))
    return partition_values(values, table.partition)


def held_rows(table: StoredTable, target: DataFrame, batch: DataFrame, pushed: int = PUSHED_KEYS) -> DataFrame:
    """Keys and partition of the stored rows whose keys the batch has.

    Only the key columns are read. The values of a batch of up to ``pushed`` keys are filters of the scan, which
    leaves out each row group whose Bloom filters have none of them. A larger batch would find some of
    its keys in nearly every row group, so all are read. Either way the batch is the build side of the
    exact join, so a small one shuffles nothing. A NULL in a key matches nothing.
    """
    stored = target.select(*table.keys, table.partition)
    keys = batch.select(*table.keys)
    some = keys.limit(pushed + 1).collect()
    if len(some) <= pushed:
        for at, f in enumerate(keys.schema.fields):
            if isinstance(f.dataType, (StringType, IntegralType)):
                stored = stored.filter(F.col(f.name).isin([v for v in {r[at] for r in some} if v is not None]))
    return stored.join(keys, table.keys, "left_semi")


COUNTS = "table_name string, rows_inserted long, rows_updated long, rows_skipped long"


@dataclass(frozen=True)
class Merge:
    """What a merge did: its counts, the table as it is (or, after a dry run, would be), the
    partitions that it touched, the rows of the batch, and the number of the version it began from (0: none).
    The counts were gathered as the rows were written.

    ``changes`` are the rows that it inserted or updated, with ``_sign`` 1, and the updated rows as they
    were, with ``_sign`` -1. They are read from the touched partitions of both versions.
    """

    counts: DataFrame
    table: DataFrame
    touched: list[str | None]
    version: store.Version
    batch_rows: int
    before: int
    changes: DataFrame


def merge(
    spark: SparkSession,
    table: StoredTable,
    batch: DataFrame,
    stamp: datetime,
    dry_run: bool = False,
    before: store.Version | None = None,
) -> Merge:
    """Merges a batch (one row per key) into a stored table.

    Only partitions that the batch touches are read and written, each into a new folder, once, with
    the action of each row; counts come from that column. A first load is written as it is, without a join. The new version counts when its manifest is
    there. A dry run goes the same way and makes no version; its folders stay for :attr:`Merge.table`
    and are named by none (``store.vacuum`` removes them). ``before`` takes the place of the stored
    version: the second dry run on a table goes on from the first one's.
    """
    before = before or store.latest(spark, table.path)
    counted = action_watch()
    actions, touched, target, batch_rows = _actions(spark, table, batch, stamp, before)
    written = store.write_folders(actions, table.path, table.partition, counted, sought=table.sought)
    found = store.read_folders(spark, actions.schema, sorted(written.values()))
    names = ("rows_inserted", "rows_updated", "rows_skipped")
    counts = spark.createDataFrame([(table.name, *[counted[n] for n in names])], COUNTS)
    if before is None:
        touched, batch_rows, kept = list(written), counted["rows_inserted"], {}
    else:
        kept = {v: f for v, f in before.folders.items() if v not in touched}
    schema = merged_table(actions).schema
    if dry_run:
        version = store.Version(0, schema, kept | written)
    else:
        version = store.commit(spark, table.path, before, schema, kept | written)
    moved = found.filter(F.col("_action").isin(INSERT, UPDATE))
    changes = merged_table(moved).withColumn("_sign", F.lit(1))
    if before is not None:
        updated = found.filter(F.col("_action") == UPDATE).select(*table.keys)
        changes = changes.unionByName(
            target.join(updated, table.keys, "left_semi").withColumn("_sign", F.lit(-1)), allowMissingColumns=True
        )
    return Merge(
        counts, store.read_version(spark, version), touched, version, batch_rows,
        0 if before is None else before.number, changes,
    )


def _actions(
    spark: SparkSession, table: StoredTable, batch: DataFrame, stamp: datetime, before: store.Version | None
) -> tuple[DataFrame, list[str | None], DataFrame | None, int]:
    """The rows of a merge with their actions, the partitions that the batch touches, their stored rows and the rows
    of the batch. Before the first load there are no partitions and no stored rows, and the batch isn't counted."""
    batch = table.with_partition(batch)
    if before is None:
        return inserted(batch, table.update_columns, table.keys, stamp, table.generated), [], None, 0
    batch_watch = row_watch()
    batch = cut_lineage(batch, f"{table.name}-batch", "zstd", batch_watch)
    touched = touched_partitions(table, store.read_version(spark, before), batch)
    target = store.read_version(spark, before, touched)
    actions = upsert(
        target, batch, table.keys, table.update_columns, stamp, table.generated,
        whole=batch_watch["rows"] > WHOLE_JOIN_ROWS,
    )
    return actions, touched, target, batch_watch["rows"]


def merge_into(
    spark: SparkSession, table: StoredTable, batch: DataFrame, stamp: datetime, dry_run: bool = False
) -> DataFrame:
    """The counts of :func:`merge`. Nobody reads the rows of a dry run here, so they are counted where they are joined
    and not written."""
    if not dry_run:
        return merge(spark, table, batch, stamp).counts
    actions = _actions(spark, table, batch, stamp, store.latest(spark, table.path))[0]
    return spark.createDataFrame([tuple(merge_counts(actions, table.name).first())], COUNTS)


# --- watermark ------------------------------------------------------------------------------------

_MARKS = "job string, last_success_end timestamp_ntz, last_run_at timestamp_ntz"


def read_watermark(spark: SparkSession, path: str, job: str) -> datetime | None:
    """End of the last successful window of a job."""
    try:
        marks = spark.read.schema(_MARKS).parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return marks.filter(F.col("job") == job).agg(F.max("last_success_end")).first()[0]


def advance_watermark(
    spark: SparkSession, path: str, job: str, window_end: datetime, run_at: datetime
) -> None:
    """Appends the new mark; the latest one counts."""
    row = (job, window_end.replace(tzinfo=None), run_at.replace(tzinfo=None))
    spark.createDataFrame([row], _MARKS).coalesce(1).write.mode("append").parquet(path)


# --- rollups --------------------------------------------------------------------------------------


def refresh_rollups(
    trips: DataFrame,
    subscriptions: DataFrame,
    company_subscriptions: DataFrame,
    companies: DataFrame,
    drivers: DataFrame,
    users: DataFrame,
    out_path: str,
    subscription_name: str = rollups.DEFAULT_SUBSCRIPTION,
    days: list | None = None,
) -> dict[str, DataFrame]:
    """Rebuilds the five rollup tables in dependency order and returns them as stored.

    Both day rollups come from one pass over the trips, and the group rollups read what was stored.
    With ``days`` only trips that ended on those days are read and only those days are replaced.
    """
    eligible = stored_eligible(subscriptions, company_subscriptions, subscription_name)
    if days is not None:
        ended_on = F.col("end_date_datetime").cast("date")
        trips = trips.filter(ended_on.cast("string").isin([str(d) for d in days]))
    replaced = None if days is None else [str(d) for d in days]
    trip_list = rollups.driver_trip_list(trips, eligible, drivers, users)
    combined = rollups.trip_event_day_rollup(
        trips, eligible, companies, drivers, users, with_bucket=True
    )
    return store_trip_list(trip_list, out_path, replaced) | store_day_rollups(combined, out_path, replaced)


def stored_eligible(
    subscriptions: DataFrame, company_subscriptions: DataFrame, subscription_name: str
) -> DataFrame:
    return cut_lineage(
        rollups.eligible_companies(subscriptions, company_subscriptions, subscription_name),
        "eligible", "zstd",
    )


def store_trip_list(trip_list: DataFrame, out_path: str, replaced: list | None) -> dict[str, DataFrame]:
    """Stores the trip list by day: all of it, or the given days.

    Files are sorted by company and driver, so that a drill-down (`plans.serving`) skips what their
    statistics rule out.
    """
    by_day = trip_list.withColumn("reporting_day", F.col("end_date_datetime").cast("date"))
    order = ["company_id", "driver_id", F.desc("end_date_datetime")]
    kept = write_partitions(by_day, f"{out_path}/driver_trip_list", "reporting_day", replaced, order)
    return {"driver_trip_list": kept}


def store_day_rollups(combined: DataFrame, out_path: str, replaced: list | None) -> dict[str, DataFrame]:
    """Stores both day rollups from their combined form, and the group rollups from what was stored.

    A stored day rollup has a small file for each of what may be thousands of days.
    """
    spark = combined.sparkSession

    def keep(name: str, df: DataFrame) -> DataFrame:
        order = [c for c in ("company_id", "retailer_location_id", "driver_id") if c in df.columns]
        return write_partitions(df, f"{out_path}/{name}", "reporting_day", replaced, order)

    stored = {}
    plain, events = rollups.split_day_rollups(cut_lineage(combined, "day-rollups", "zstd"))
    stored["trip_day_rollup"] = keep("trip_day_rollup", plain)
    with small_files(spark):
        stored["performance_groups"] = keep(
            "performance_groups", rollups.performance_groups(stored["trip_day_rollup"])
        )
    stored["trip_event_day_rollup"] = keep("trip_event_day_rollup", events)
    with small_files(spark):
        stored["trip_event_groups"] = keep(
            "trip_event_groups", rollups.trip_event_groups(stored["trip_event_day_rollup"])
        )
    return stored


def rollup_totals(stored: dict[str, DataFrame]) -> DataFrame:
    """Rows and trips of each rollup table."""
    trips = {
        "driver_trip_list": F.count("*"),
        "trip_day_rollup": F.sum("trip_count"),
        "performance_groups": F.sum("total_trip_count"),
        "trip_event_day_rollup": F.sum("trip_count"),
        "trip_event_groups": F.sum("total_trip_count"),
    }
    return union_all(
        [
            stored[name]
            .agg(F.count("*").alias("row_count"), trips[name].alias("trip_count"))
            .select(F.lit(name).alias("table_name"), "row_count", "trip_count")
            for name in trips
        ]
    )


__all__ = [
    "Merge", "StoredTable", "advance_watermark", "held_rows", "merge", "merge_into", "read_table", "read_watermark",
    "refresh_rollups", "rollup_totals", "store_day_rollups", "store_trip_list", "stored_eligible",
    "touched_partitions", "write_partitions", "write_table",
]
