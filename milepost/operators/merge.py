"""Upsert with change detection, as a pure DataFrame function.

The result is the merged table plus ``_action`` per row:

``insert``     new key
``update``     known key, some compared column differs (or the merge is a touch merge)
``unchanged``  known key, nothing differs
``keep``       row of the target that the batch does not mention
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INSERT, UPDATE, UNCHANGED, KEEP = "insert", "update", "unchanged", "keep"
AUDIT = ("created_at", "updated_at", "last_synced_at")


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    update_columns: list[str],
    stamp: datetime | Column,
    generated: tuple[str, ...] = (),
    whole: bool = False,
) -> DataFrame:
    """Merge ``source`` (one row per key) into ``target``.

    * New keys are inserted with every column the batch carries; columns known to one side only
      are NULL on the other.
    * Known keys take ``update_columns`` from the batch when at least one of them differs, and only
      then move ``updated_at`` and ``last_synced_at``. With no update columns every match moves the
      stamps and counts as an update (touch merge).
    * ``generated`` columns never come from the batch; derive them from the result.

    The target is on the left of a left join and new keys are found against the matched keys alone,
    so with a batch under the broadcast threshold the target is scanned in place, not shuffled. ``whole`` is
    for a batch that is far over it: one full join moves each side once, where the two joins of a small batch
    would move the target twice and the batch three times.
    """
    batch = source.drop(*AUDIT, *generated)
    target = target.drop(*generated)
    business = [c for c in target.columns if c not in AUDIT]
    added = [c for c in batch.columns if c not in business]
    audit = [c for c in AUDIT if c in target.columns]
    compared = [c for c in update_columns if c in batch.columns and c not in keys]

    known_types = {f.name: f.dataType for f in target.schema.fields}

    def now(column: str) -> Column:
        value = F.lit(stamp.isoformat(sep=" ")) if isinstance(stamp, datetime) else stamp
        return value.cast(known_types[column])

    new_types = {f.name: f.dataType for f in batch.schema.fields}
    for c in added:
        target = target.withColumn(c, F.lit(None).cast(new_types[c]))
    for c in business:
        if c not in batch.columns:
            batch = batch.withColumn(c, F.lit(None).cast(known_types[c]))
    everything = business + added
    fixed = [c for c in everything if c not in compared]

    # The compared columns travel as one struct per side: one comparison (NULL equals NULL) and one
    # choice instead of one per column.
    stored = target.select(*fixed, *audit, _pack(compared).alias("_stored"))
    incoming = batch.select(*keys, _pack(compared).alias("_incoming"), F.lit(True).alias("_in_batch"))
    on_keys = F.lit(True)
    for k in keys:
        on_keys = on_keys & (F.col(f"t.{k}") == F.col(f"s.{k}"))
    differs = ~F.col("t._stored").eqNullSafe(F.col("s._incoming")) if compared else F.lit(True)
    if whole:
        joined = stored.withColumn("_in_table", F.lit(True)).alias("t").join(
            batch.select(*fixed, _pack(compared).alias("_incoming"), F.lit(True).alias("_in_batch")).alias("s"),
            on_keys, "full",
        )
        known, given = F.col("t._in_table").isNotNull(), F.col("s._in_batch").isNotNull()
        marked = joined.select(
            *[F.when(known, F.col(f"t.{c}")).otherwise(F.col(f"s.{c}")).alias(c) for c in fixed],
            *[F.col(f"t.{c}").alias(c) for c in audit],
            "_stored",
            "_incoming",
            (~known).alias("_new"),
            (known & given).alias("_matched"),
            (known & given & differs).alias("_changed"),
        )
        new, move = F.col("_new"), F.col("_changed")
        action = F.when(new, INSERT).when(~F.col("_matched"), KEEP).when(move, UPDATE).otherwise(UNCHANGED)
        return marked.select(
            *fixed,
            F.when(new | move, F.col("_incoming")).otherwise(F.col("_stored")).alias("_row"),
            *[F.when(new if c == "created_at" else new | move, now(c)).otherwise(F.col(c)).alias(c) for c in audit],
            action.alias("_action"),
        ).select(*fixed, *[F.col(f"_row.{c}").alias(c) for c in compared], *audit, "_action")

    joined = stored.alias("t").join(incoming.alias("s"), on_keys, "left")
    matched = F.col("s._in_batch").isNotNull()
    marked = joined.select(
        *[F.col(f"t.{c}").alias(c) for c in fixed + audit],
        "_stored",
        "_incoming",
        matched.alias("_matched"),
        (matched & differs).alias("_changed"),
    )
    move = F.col("_changed")
    stamps = [
        (F.col(c) if c == "created_at" else F.when(move, now(c)).otherwise(F.col(c))).alias(c)
        for c in audit
    ]
    action = F.when(~F.col("_matched"), KEEP).when(move, UPDATE).otherwise(UNCHANGED)
    old_rows = marked.select(
        *fixed,
        F.when(move, F.col("_incoming")).otherwise(F.col("_stored")).alias("_row"),
        *stamps,
        action.alias("_action"),
    ).select(*fixed, *[F.col(f"_row.{c}").alias(c) for c in compared], *audit, "_action")

    known_keys = target.select(*keys).join(batch.select(*keys), keys, "left_semi")
    new_rows = batch.join(known_keys, keys, "left_anti").select(
        *everything,
        *[now(c).alias(c) for c in audit],
        F.lit(INSERT).alias("_action"),
    )
    return old_rows.unionByName(new_rows)


def inserted(source: DataFrame, update_columns: list[str], keys: list[str], stamp: datetime, generated: tuple[str, ...] = ()) -> DataFrame:
    """:func:`upsert` into a table without rows: every row of the batch is new, so nothing is joined."""
    batch = source.drop(*AUDIT, *generated)
    compared = [c for c in update_columns if c in batch.columns and c not in keys]
    moment = F.lit(stamp.isoformat(sep=" ")).cast("timestamp_ntz")
    return batch.select(
        *[c for c in batch.columns if c not in compared], *compared, *[moment.alias(c) for c in AUDIT],
        F.lit(INSERT).alias("_action"),
    )


def _pack(columns: list[str]) -> Column:
    return F.struct(*columns) if columns else F.lit(True)


def merged_table(actions: DataFrame) -> DataFrame:
    return actions.drop("_action")


def merge_counts(actions: DataFrame, table: str) -> DataFrame:
    """Inserted, updated and skipped rows of one merge; skipped are batch rows without effect."""
    return actions.agg(
        F.count_if(F.col("_action") == INSERT).alias("rows_inserted"),
        F.count_if(F.col("_action") == UPDATE).alias("rows_updated"),
        F.count_if(F.col("_action") == UNCHANGED).alias("rows_skipped"),
    ).select(F.lit(table).alias("table_name"), "rows_inserted", "rows_updated", "rows_skipped")


# Compared columns of a discovered fleet; its ``stats`` is set on insert only.
DISCOVERED_FLEET_COLUMNS = ["company_id", "internal_id", "name", "active", "meta_data"]


def discovered_fleet_rows(reconciled: DataFrame) -> DataFrame:
    """Insertable discovered fleets in table form, one row per location (lowest id wins)."""
    picked = F.min(F.struct("internal_id", "name", "company_id", "raw")).alias("p")
    rows = (
        reconciled.filter(F.col("outcome") == "insertable")
        .groupBy("retailer_location_id")
        .agg(picked)
    )
    return rows.select(
        "retailer_location_id",
        "p.company_id",
        "p.internal_id",
        "p.name",
        F.lit(True).alias("active"),
        F.to_json(F.try_parse_json("p.raw")).alias("meta_data"),
        F.lit(None).cast("string").alias("stats"),
    )
