"""Purging drivers from the stored tables: their scores, their trips and the trips' points.

The key sets follow the links: gone drivers, then the trips that refer to them, then the points of those trips.
They are written once, so every table is judged against the same keys. Of each table a scan of its key and
partition columns finds the partitions that hold lost rows, and only those are written anew.

Tables are purged from the leaves up, points first, drivers last. A run that breaks off leaves every row still reachable
whose link is there, and a repeated run finishes: the trips that name the points go after them, the
drivers after everything. Nothing is left that refers to what is gone at any time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from milepost.operators.accounting import row_watch
from milepost.operators.skew import one_per_key
from milepost.plans import store
from milepost.plans.tables import Merge, StoredTable, read_table, write_partitions
from milepost.session import cut_lineage

COUNTS = "table_name string, rows_removed long, rows_left long, partitions_written long"


@dataclass(frozen=True)
class Purge:
    """Lines per table (:data:`COUNTS`), and the trips' change as rollup maintenance takes it (None: no trip went)."""

    counts: DataFrame
    trips: Merge | None


def remove_keys(spark: SparkSession, table: StoredTable, lost: DataFrame, key: str) -> tuple[tuple, list]:
    """Removes the rows of a stored table whose ``key`` is among ``lost`` (one column, unique).

    Gives a line of counts and the partitions written. Partitions without lost rows are not touched; of those with
    some, what stays is counted as it is written.
    """
    stored = read_table(spark, table.path)
    if stored is None:
        return (table.name, 0, 0, 0), []
    keys = lost.withColumnRenamed(lost.columns[0], key)
    hit = stored.select(key, table.partition).join(keys, key, "left_semi").groupBy(
        F.col(table.partition).cast("string").alias("value")
    ).agg(F.count("*").alias("rows"))
    found = {r["value"]: r["rows"] for r in hit.collect()}  # one row per partition folder
    if not found:
        return (table.name, 0, 0, 0), []
    watch = row_watch()
    rest = read_table(spark, table.path, list(found)).join(keys, key, "left_anti")
    write_partitions(rest, table.path, table.partition, list(found), watch=watch)
    return (table.name, sum(found.values()), watch["rows"], len(found)), list(found)


def purge_drivers(
    spark: SparkSession, gone: DataFrame, drivers: StoredTable, scores: StoredTable, trips: StoredTable,
    points: tuple[StoredTable, ...],
) -> Purge:
    """Deletes the drivers in ``gone`` (``driver_id``) and whatever refers to them, table by table."""
    ids = cut_lineage(one_per_key(gone.select("driver_id").filter("driver_id IS NOT NULL"), ["driver_id"]), "gone-drivers", "zstd")
    lines, change = [], None
    before = store.latest(spark, trips.path)
    if before is not None:
        lost = cut_lineage(
            store.read_version(spark, before).join(ids, "driver_id", "left_semi"), "lost-trips", "zstd"
        )
        keys = cut_lineage(one_per_key(lost.select("trip_id"), ["trip_id"]), "lost-trip-ids", "zstd")
        for table in points:
            lines.append(remove_keys(spark, table, keys, "trip_id")[0])
        line, touched = remove_keys(spark, trips, keys, "trip_id")
        if touched:
            now = store.latest(spark, trips.path)
            change = Merge(
                spark.createDataFrame([line], COUNTS), store.read_version(spark, now), touched, now, 0, before.number,
                lost.withColumn("_sign", F.lit(-1)),
            )
        lines.append(line)
    lines.append(remove_keys(spark, scores, ids, "driver_id")[0])
    lines.append(remove_keys(spark, drivers, ids, "driver_id")[0])
    return Purge(spark.createDataFrame(lines, COUNTS), change)
