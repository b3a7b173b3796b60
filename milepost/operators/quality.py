"""Data-quality rules as DataFrame checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from milepost.operators.dedup import duplicate_keys
from milepost.operators.skew import one_per_key
from milepost.schemas import (
    DRIVER_KEY, DRIVER_SCORE_KEY, FLEET_KEY, INCIDENT_KEY, LOCATION_KEY, TRIP_KEY,
)

# What the table definitions ask for.
REQUIRED = {
    "trip_score": ["trip_id", "driver_id", "company_id"],
    "driver_score": [
        "driver_id", "company_id", "snapshot_date", "source_group_key", "source_row_index", "fleet_id",
    ],
    "trip_location": LOCATION_KEY,
    "trip_incident": INCIDENT_KEY,
}
LINKS = [
    ("trip_score", "driver_id", "driver", "driver_id"),
    ("trip_score", "company_id", "company", "id"),
    ("trip_score", "retailer_location_id", "fleet", "retailer_location_id"),
    ("driver_score", "driver_id", "driver", "driver_id"),
    ("driver_score", "company_id", "company", "id"),
    ("driver_score", "retailer_location_id", "fleet", "retailer_location_id"),
    ("trip_location", "trip_id", "trip_score", "trip_id"),
    ("trip_incident", "trip_id", "trip_score", "trip_id"),
]
UNIQUE = {
    "fleet": FLEET_KEY, "driver": DRIVER_KEY, "driver_score": DRIVER_SCORE_KEY, "trip_score": TRIP_KEY,
    "trip_location": LOCATION_KEY, "trip_incident": INCIDENT_KEY,
}


def lat_lon_violations(df: DataFrame, latitude="latitude", longitude="longitude") -> DataFrame:
    """Rows outside the globe; missing coordinates are fine."""
    outside = ~F.col(latitude).between(-90, 90) | ~F.col(longitude).between(-180, 180)
    return df.filter(outside)


def trip_window_violations(df: DataFrame) -> DataFrame:
    return df.filter("end_date < start_date")


def null_counts(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """NULLs per required column, from one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in columns]
    )
    return counts.select(F.lit(table).alias("table_name"), F.inline(pairs))


def orphan_counts(
    child: DataFrame, parent: DataFrame, child_key: str, parent_key: str, rule: str
) -> DataFrame:
    """Rows and distinct keys of ``child`` without a parent.

    Child rows are counted per key before the anti join, so the join never sees a frequent key more
    than once.
    """
    counts = (
        child.filter(F.col(child_key).isNotNull())
        .groupBy(F.col(child_key).alias("_key"))
        .agg(F.count("*").alias("_rows"))
    )
    parents = parent.select(F.col(parent_key).alias("_key"))
    return (
        counts.join(parents, "_key", "left_anti")
        .agg(
            F.count("*").alias("orphan_keys"),
            F.coalesce(F.sum("_rows"), F.lit(0)).alias("orphan_rows"),
        )
        .select(F.lit(rule).alias("rule_name"), "orphan_keys", "orphan_rows")
    )


def key_violations(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """Repeated keys per table: how many keys, how many rows carry them."""
    parts = [
        duplicate_keys(df, keys)
        .agg(
            F.count("*").alias("duplicate_keys"),
            F.coalesce(F.sum("row_count"), F.lit(0)).alias("rows_involved"),
        )
        .select(F.lit(name).alias("table_name"), "duplicate_keys", "rows_involved")
        for name, (df, keys) in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def purge_drivers(
    gone: DataFrame, trips: DataFrame, scores: DataFrame, locations: DataFrame,
    incidents: DataFrame,
) -> dict[str, DataFrame]:
    """What remains after drivers are deleted: their trips and scores go, and the trips' points."""
    ids = one_per_key(gone.select("driver_id"), ["driver_id"])
    lost_trips = trips.join(ids, "driver_id", "left_semi").select("trip_id")
    return {
        "trip_score": trips.join(ids, "driver_id", "left_anti"),
        "driver_score": scores.join(ids, "driver_id", "left_anti"),
        "trip_location": locations.join(lost_trips, "trip_id", "left_anti"),
        "trip_incident": incidents.join(lost_trips, "trip_id", "left_anti"),
    }


def unlink_fleets(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """Clears the location link of rows whose fleet was deleted; the rows stay."""
    lost = one_per_key(gone.select(F.col("retailer_location_id").alias("_gone")), ["_gone"])
    joined = rows.join(lost, F.col("retailer_location_id") == F.col("_gone"), "left")
    kept = F.when(F.col("_gone").isNull(), F.col("retailer_location_id"))
    return joined.withColumn("retailer_location_id", kept).drop("_gone")


def check_declared(tables: dict[str, DataFrame]) -> DataFrame:
    """All declared rules over the given tables: rule, rule_name, bad_keys, bad_rows.

    ``required`` counts NULLs, ``link`` keys and rows without a parent, ``unique`` repeated keys and
    the rows that carry them. Rules of tables that are not given are left out.
    """
    parts = []
    for name, columns in REQUIRED.items():
        if name in tables:
            found = null_counts(tables[name], name, columns)
            rule = F.concat_ws(".", "table_name", "column_name")
            parts.append(found.select(
                F.lit("required").alias("rule"), rule.alias("rule_name"),
                F.col("null_count").alias("bad_keys"), F.col("null_count").alias("bad_rows"),
            ))
    for child, column, parent, key in LINKS:
        if child in tables and parent in tables:
            found = orphan_counts(tables[child], tables[parent], column, key, f"{child}.{column}")
            parts.append(found.select(F.lit("link").alias("rule"), "rule_name", "orphan_keys", "orphan_rows"))
    keyed = {n: (tables[n], k) for n, k in UNIQUE.items() if n in tables}
    if keyed:
        parts.append(key_violations(keyed).select(
            F.lit("unique").alias("rule"), "table_name", "duplicate_keys", "rows_involved"
        ))
    names = ["rule", "rule_name", "bad_keys", "bad_rows"]
    return reduce(DataFrame.unionByName, [p.toDF(*names) for p in parts])
