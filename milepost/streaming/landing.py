"""Stream of landed rows into a stored table.

The checkpoint remembers which files were loaded, so it takes the place of the watermark. Each
micro-batch is conformed and merged by the same functions as a batch run.

A stream that stops after a merge and before its checkpoint delivers the batch again. Before a batch is merged, its
number and its stamp are written down next to the checkpoint, and stamps of batches always grow. A repeated batch
finds its number there: if the table has rows with its stamp, the merge was committed (it moves the stamp of
every row that it inserts or updates) and the batch is skipped; if not, it is merged with the stamp it had. So a
batch counts once, also in touch merges, where a second merge would move all stamps again.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from milepost.plans.tables import StoredTable, merge_into, read_table
from milepost.schemas import LANDED

_BATCHES = "batch long, stamp timestamp_ntz"


def landed_stream(
    spark: SparkSession,
    path: str,
    entity: str,
    more_fields: str = "",
    files_per_batch: int = 1000,
) -> DataFrame:
    """Landed JSON rows (one per line) as a stream of text columns.

    ``more_fields`` (DDL) names fields beyond the entity's own, such as ``position long``.
    """
    fields = list(LANDED[entity].fields)
    if more_fields:
        fields += StructType.fromDDL(more_fields).fields
    reader = spark.readStream.schema(StructType(fields))
    return reader.option("maxFilesPerTrigger", files_per_batch).json(path)


def begun_batch(spark: SparkSession, path: str, number: int) -> tuple[datetime | None, datetime | None]:
    """The stamp of a batch that was begun, and the latest stamp of any, by the list at ``path``."""
    try:
        lines = spark.read.schema(_BATCHES).parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return None, None
    return tuple(lines.agg(F.max(F.when(F.col("batch") == number, F.col("stamp"))), F.max("stamp")).first())


def merge_once(
    rows: DataFrame, number: int, table: StoredTable, batches_path: str, stamp: datetime
) -> DataFrame | None:
    """Merges a batch unless it has been merged; its counts, or None if it was skipped.

    One stream at a time writes to ``batches_path``. Other writers of the table are allowed, with other stamps.
    """
    spark = rows.sparkSession
    begun, latest = begun_batch(spark, batches_path, number)
    if begun is not None:
        moment = F.lit(begun.isoformat(sep=" ")).cast("timestamp_ntz")
        stored = read_table(spark, table.path)
        if stored is not None and not stored.filter(F.col("last_synced_at") == moment).isEmpty():
            return None
        return merge_into(spark, table, rows, begun)
    if latest is not None:
        stamp = max(stamp, latest + timedelta(microseconds=1))
    line = spark.createDataFrame([(number, stamp)], _BATCHES)
    line.coalesce(1).write.mode("append").parquet(batches_path)
    return merge_into(spark, table, rows, stamp)


def stream_into(
    stream: DataFrame,
    to_rows: Callable[[DataFrame], DataFrame],
    table: StoredTable,
    checkpoint: str,
    stamp: Callable[[], datetime],
) -> StreamingQuery:
    """Merges everything that has landed, one micro-batch after the other, then stops."""

    def merge_batch(batch: DataFrame, number: int) -> None:
        merge_once(to_rows(batch), number, table, f"{checkpoint}-batches", stamp())

    return (
        stream.writeStream.foreachBatch(merge_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
