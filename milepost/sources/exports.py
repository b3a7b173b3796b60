"""Artifact sinks and flat exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from milepost.functions.jsontext import app_blob_driver_id, app_blob_value, json_path, to_json_text
from milepost.functions.render import csv_cells, render_json_list
from milepost.functions.measures import epoch_ms_text
from milepost.operators.conform import fleet_stats
from milepost.schemas import LANDED, METRICS, camel
from milepost.sources.entity import read_entity

# Leading columns of the row exports.
SCORE_LEAD = ["driverId", "driverName", "fleetId", "fleetName", "thirdPartyId", "accountId"]
LOCATION_LEAD = ["tripId", "accountId", "timestamp", "latitude", "longitude"]
INCIDENT_LEAD = ["tripId", "accountId", "timestamp", "type", "latitude", "longitude"]
# Columns that hold epoch milliseconds.
EPOCH_FIELDS = ["startDate", "endDate"] + [f"last{camel(m)}Incident" for m in METRICS]

CSV_OPTIONS = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def write_json(df: DataFrame, path: str, partitions=("fleet_id", "run_ts")) -> None:
    """JSON lines below ``fleet_id=/run_ts=`` folders; null fields are kept."""
    df.write.partitionBy(*partitions).option("ignoreNullFields", "false").json(path)


def read_json(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, quotes doubled, blanks kept and empty cells for NULL."""
    csv_cells(df).write.options(**CSV_OPTIONS).option("emptyValue", "").csv(path)


def write_report(df: DataFrame, path: str) -> None:
    """A run or import report (a handful of lines) as one JSON file."""
    df.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def export_fleet(raw: DataFrame) -> DataFrame:
    """19 columns per fleet: scalars as landed, nested members as JSON text, counters in stats."""
    scalars = {
        "retailer_location_id": "retailerLocationId", "internal_id": "internalId", "name": "name",
        "location_type": "locationType", "public_location": "publicLocation",
        "qr_code_url": "qrCodeUrl", "location_token": "locationToken", "active": "active",
        "latitude": "latitude", "longitude": "longitude",
    }
    nested = {
        "manager": "manager", "categories": "categories", "filters": "filters",
        "billable_entity": "billableEntity", "retailer": "retailer", "offers": "offers",
        "meta_data": "metaData", "contact": "contact",
    }
    return raw.select(
        *[F.col(src).alias(dst) for dst, src in (scalars | nested).items()],
        to_json_text(fleet_stats()).alias("stats"),
    )


def export_drivers(raw: DataFrame) -> DataFrame:
    """20 columns per driver, with three values taken from the app blob."""
    info = F.col("appInfo")
    email = F.coalesce(
        F.nullif(F.col("contactEmail"), F.lit("")),
        F.nullif(json_path(F.col("contact"), "contactInfo.emailAddress"), F.lit("")),
    )
    return raw.select(
        F.col("accountId").alias("account_id"),
        app_blob_driver_id(info).alias("driver_id"),
        json_path(F.col("locations"), "[0].retailerLocationId").alias("retailer_location_id"),
        "display",
        "username",
        F.col("accountType").alias("account_type"),
        email.alias("contact_email"),
        F.col("locationDisplay").alias("location_display"),
        "active",
        "latitude",
        "longitude",
        F.col("locationCount").alias("location_count"),
        "manager",
        "contact",
        "employer",
        info.alias("app_info"),
        "locations",
        app_blob_value(info, "driverId").alias("app_blob_driver_id"),
        app_blob_value(info, "workShiftAudienceId").alias("app_blob_work_shift_audience_id"),
        render_json_list(app_blob_value(info, "additionalServices")).alias(
            "app_blob_additional_services"
        ),
    )


def export_columns(columns: list[str], lead: list[str]) -> list[str]:
    """Leading columns first (those that exist), then the rest in their order."""
    first = [c for c in lead if c in columns]
    return first + [c for c in columns if c not in first]


def export_rows(df: DataFrame, lead: list[str], readable_times: bool = False) -> DataFrame:
    """Row export with its leading columns first.

    ``readable_times`` adds a UTC text column after each epoch column.
    """
    out = []
    for name in export_columns(df.columns, lead):
        out.append(F.col(name))
        if readable_times and name in EPOCH_FIELDS:
            out.append(epoch_ms_text(F.col(name)).alias(f"{name}Datetime"))
    return df.select(*out)


def landed_columns(rows: DataFrame, lead: list[str], order: str = "source_order") -> list[str]:
    """Columns of landed rows: leading ones that occur, then all others in the order in which they are first seen.

    Rows come from ``read_entity(..., more=True)``, of one batch or of several in a union. Only the names come to the
    driver, one row per name and not per row: they become columns. Without rows the leading columns are all there is.
    """
    seen = (
        rows.select(F.col(order).alias("_row"), F.posexplode("member_names").alias("_at", "name"))
        .groupBy("name").agg(F.min(F.struct("_row", "_at")).alias("first")).orderBy("first", "name")
    )
    names = [r["name"] for r in seen.select("name").collect()]
    return export_columns(names, lead) if names else list(lead)


def export_landed(rows: DataFrame, entity: str, lead: list[str], order: str = "source_order") -> DataFrame:
    """Every member of every landed row as a text column (:func:`landed_columns`); NULL where a row lacks it."""
    listed = set(LANDED[entity].fieldNames())

    def member(name: str) -> Column:
        return F.col(f"`{name}`") if name in listed else F.col("more_members")[name]

    return rows.select(*[member(name).alias(name) for name in landed_columns(rows, lead, order)])


def replay_exports(
    spark: SparkSession, run_path: str, out_path: str, layout: str = "files"
) -> None:
    """Rebuilds the fleet and driver CSV exports from landed JSON."""
    fleet, _ = read_entity(spark, f"{run_path}/fleet", "fleet", layout)
    drivers, _ = read_entity(spark, f"{run_path}/drivers", "drivers", layout)
    write_csv(export_fleet(fleet), f"{out_path}/fleet")
    write_csv(export_drivers(drivers), f"{out_path}/drivers")
