"""Lookup joins: companies, fleets, users, drivers and trip details.

The looked-up tables are first reduced to one row per key, in a way that leaves the join an exchange of
its own (`skew`). Sides are not marked for broadcast; Spark broadcasts those under its size threshold and splits
skewed partitions of the others.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from milepost.functions.coerce import first_non_blank, strip, text_or_null, to_long
from milepost.functions.jsontext import app_blob_driver_id, app_blob_value, json_path
from milepost.functions.people import contact_email, focus_driver_id, report_driver_name
from milepost.operators.dedup import last_by
from milepost.operators.skew import one_per_key


def left_lookup(
    rows: DataFrame, key: Column, table: DataFrame, table_key: str, columns: list[str],
    spread_by: list[str] | None = None,
) -> DataFrame:
    """Left join on a text key that is unique in ``table``.

    Rows without a key match nothing, yet a plain join would send all of them to one partition.
    They get a stand-in key spread by the hash of ``spread_by`` (default: the whole row); whatever
    a stand-in finds is blanked out again.
    """
    spread = F.pmod(F.xxhash64(*(spread_by or rows.columns)), F.lit(4096)).cast("string")
    probe = rows.withColumn("_key", key)
    probe = probe.withColumn("_probe", F.coalesce("_key", F.concat(F.lit("\x00"), spread)))
    side = table.select(
        F.col(table_key).alias("_table_key"), *[F.col(c).alias(f"_found_{c}") for c in columns]
    )
    joined = probe.join(side, F.col("_probe") == F.col("_table_key"), "left")
    found = [
        F.when(F.col("_key").isNotNull(), F.col(f"_found_{c}")).alias(c) for c in columns
    ]
    return joined.select(*rows.columns, *found)


# --- companies and fleets -------------------------------------------------------------------------


def company_by_location(companies: DataFrame) -> DataFrame:
    """Location id -> company, read from the account id inside the company's JSON.

    Several companies may claim one location: the lowest company id wins, the others are counted.
    """
    location = to_long(json_path(F.col("focus_data"), "eventInfo.flAccountId"))
    claims = companies.select(location.alias("retailer_location_id"), F.col("id").alias("company_id")).filter(
        "retailer_location_id IS NOT NULL AND company_id IS NOT NULL"
    )
    return one_per_key(
        claims, ["retailer_location_id"], F.min("company_id").alias("company_id"),
        (F.count_distinct("company_id") - 1).alias("conflicting_companies"),
    )


def resolve_company(rows: DataFrame, companies: DataFrame, location: str) -> DataFrame:
    """Adds ``company_id`` (NULL when unresolved) and ``conflicting_companies``."""
    table = company_by_location(companies).withColumn(
        "_location", F.col("retailer_location_id").cast("string")
    )
    return left_lookup(
        rows,
        F.col(location).cast("string"),
        table,
        "_location",
        ["company_id", "conflicting_companies"],
    )


def fleet_identities(fleets: DataFrame) -> DataFrame:
    """Internal id -> location and company; on a repeated internal id the lowest location wins."""
    pair = F.struct("retailer_location_id", "company_id")
    whole = fleets.filter(
        "internal_id IS NOT NULL AND retailer_location_id IS NOT NULL AND company_id IS NOT NULL"
    )
    return one_per_key(whole, ["internal_id"], F.min(pair).alias("p")).select(
        "internal_id", "p.retailer_location_id", "p.company_id"
    )


def resolve_fleet_identity(
    rows: DataFrame, fleets: DataFrame, fleet_key: str, spread_by: list[str] | None = None
) -> DataFrame:
    """Adds ``retailer_location_id`` and ``company_id`` of the row's fleet, NULL if unresolved."""
    return left_lookup(
        rows,
        text_or_null(fleet_key),
        fleet_identities(fleets),
        "internal_id",
        ["retailer_location_id", "company_id"],
        spread_by,
    )


def active_roster(fleets: DataFrame, companies: DataFrame) -> DataFrame:
    """Active fleets that some company claims by account id."""
    claimed = one_per_key(
        companies.select(json_path(F.col("focus_data"), "eventInfo.flAccountId").alias("_account")), ["_account"]
    )
    return (
        fleets.filter("active")
        .join(claimed, F.col("retailer_location_id").cast("string") == F.col("_account"),
              "left_semi")
        .select("retailer_location_id", "internal_id", "name", "active")
    )


def repair_company_ids(rows: DataFrame, fleets: DataFrame) -> DataFrame:
    """Sets ``company_id`` to the fleet's where they differ; ``repaired`` marks changed rows."""
    side = fleets.select(
        F.col("internal_id").alias("_internal"), F.col("company_id").alias("_company")
    )
    side = one_per_key(side, ["_internal"], F.min("_company").alias("_company"))
    joined = left_lookup(rows, F.col("fleet_id"), side.withColumn("_hit", F.lit(True)),
                         "_internal", ["_company", "_hit"])
    differs = F.coalesce(F.col("_hit"), F.lit(False)) & ~F.col("company_id").eqNullSafe(
        F.col("_company")
    )
    return joined.select(
        *[c for c in rows.columns if c != "company_id"],
        F.when(differs, F.col("_company")).otherwise(F.col("company_id")).alias("company_id"),
        differs.alias("repaired"),
    )


# --- users and drivers ----------------------------------------------------------------------------


def users_by_focus_id(users: DataFrame) -> DataFrame:
    key = focus_driver_id(F.col("focus_data"))
    keyed = users.select(key.alias("focus_id"), F.col("id").alias("user_id")).filter("focus_id IS NOT NULL")
    return one_per_key(keyed, ["focus_id"], F.min("user_id").alias("user_id"))


def users_by_email(users: DataFrame) -> DataFrame:
    key = F.lower(text_or_null("email"))
    keyed = users.select(key.alias("email_key"), F.col("id").alias("user_id")).filter("email_key IS NOT NULL")
    return one_per_key(keyed, ["email_key"], F.min("user_id").alias("user_id"))


def resolve_driver_user(
    rows: DataFrame, users: DataFrame, focus_id: Column, email: Column
) -> DataFrame:
    """Adds ``user_id``: by focus id first, else by e-mail regardless of case."""
    keyed = rows.withColumn("_focus", focus_id).withColumn("_email", F.lower(email))
    by_focus = users_by_focus_id(users).withColumnRenamed("user_id", "_user_by_focus")
    by_email = users_by_email(users).withColumnRenamed("user_id", "_user_by_email")
    joined = left_lookup(keyed, F.col("_focus"), by_focus, "focus_id", ["_user_by_focus"])
    joined = left_lookup(joined, F.col("_email"), by_email, "email_key", ["_user_by_email"])
    return joined.select(
        *rows.columns, F.coalesce("_user_by_focus", "_user_by_email").alias("user_id")
    )


def known_driver_rows(rows: DataFrame, drivers: DataFrame, driver_id: str) -> DataFrame:
    """Rows whose driver exists."""
    known = one_per_key(drivers.select(F.col("driver_id").alias("_known")), ["_known"])
    return rows.join(known, text_or_null(driver_id) == F.col("_known"), "left_semi")


def unknown_driver_ids(rows: DataFrame, drivers: DataFrame, driver_id: str) -> DataFrame:
    """Driver ids that occur in ``rows`` but not among the drivers, with their row count.

    Rows are counted per id before the anti join, so a frequent id costs one row.
    """
    known = drivers.select(F.col("driver_id").alias("_known"))
    counts = (
        rows.select(text_or_null(driver_id).alias("driver_id"))
        .filter("driver_id IS NOT NULL")
        .groupBy("driver_id")
        .agg(F.count("*").alias("filtered_rows"))
    )
    return counts.join(known, F.col("driver_id") == F.col("_known"), "left_anti")


def driver_lookup(raw_drivers: DataFrame, users: DataFrame, position: str) -> DataFrame:
    """Report identity -> driver name and account, for drivers that match a user.

    When two drivers carry one identity, the later one in source order wins.
    """
    email = contact_email(F.col("contactEmail"), F.col("contact"))
    keyed = raw_drivers.withColumn("driver_id", app_blob_driver_id(F.col("appInfo"))).filter(
        "driver_id IS NOT NULL"
    )
    matched = resolve_driver_user(
        keyed, users, focus_driver_id(F.col("focus_data")), email
    ).filter("user_id IS NOT NULL")
    name = report_driver_name(
        F.col("display"), F.col("contact"), F.col("contactEmail"), F.col("username")
    )
    return last_by(matched, ["driver_id"], position, as_side=True).select(
        "driver_id",
        name.alias("driver_name"),
        to_long("accountId").alias("driver_account_id"),
    )


def backfill_driver_id(drivers: DataFrame) -> DataFrame:
    """Fills a blank ``driver_id`` from the app info: the blob's id, else a top-level one."""
    info = F.col("app_info")
    found = F.nullif(
        F.coalesce(
            app_blob_value(info, "driverId"),
            F.get_json_object(info, "$.driverId"),
        ),
        F.lit(""),
    )
    blank = F.col("driver_id").isNull() | (F.trim("driver_id") == "")
    return drivers.withColumn("driver_id", F.when(blank, found).otherwise(F.col("driver_id")))


def driver_activity(drivers: DataFrame, users: DataFrame, fleets: DataFrame) -> DataFrame:
    """Active flag of each driver with a live user and an assigned fleet."""
    live = users.filter("deleted_at IS NULL").select(
        F.col("id").alias("user_id"), "is_active"
    )
    assigned = fleets.select("retailer_location_id", "company_id")
    return (
        drivers.select("account_id", "driver_id", "user_id", "retailer_location_id")
        .join(live, "user_id")
        .join(assigned, "retailer_location_id")
        .select(
            "account_id", "driver_id", "user_id", "retailer_location_id", "company_id",
            "is_active",
        )
    )


def enrich_report_rows(rows: DataFrame, fleets: DataFrame, lookup: DataFrame) -> DataFrame:
    """Report rows of known fleets and drivers, with driver and fleet names added.

    ``fleets`` holds the fleets being loaded, so one job serves all of them.
    """
    fleet_side = fleets.select(
        strip("internal_id").alias("_fleet"),
        F.col("internal_id").alias("fleetInternalId"),
        F.col("name").alias("_fleet_name"),
    )
    driver_side = lookup.select(
        F.col("driver_id").alias("_driver"), "driver_name", "driver_account_id"
    )
    kept = [c for c in rows.columns if c not in ("driverId", "driverName", "fleetName")]
    return (
        rows.withColumn("_third_party", text_or_null("thirdPartyId"))
        .filter("_third_party IS NOT NULL")
        .join(fleet_side, strip("fleetId") == F.col("_fleet"))
        .join(driver_side, F.col("_third_party") == F.col("_driver"))
        .select(
            *kept,
            F.col("_driver").alias("driverId"),
            F.col("driver_name").alias("driverName"),
            F.col("_fleet_name").alias("fleetName"),
            "fleetInternalId",
            F.col("driver_account_id").alias("driverAccountId"),
        )
    )


# --- discovery ------------------------------------------------------------------------------------


def normalize_discovered_fleet(rows: DataFrame, payload: str = "payload") -> DataFrame:
    """Id and name of a fleet-search row, whichever of several keys carries them.

    The document is read once for all members (``json_tuple``); only one without an id is parsed again, for
    its canonical text.
    """
    p = F.col(payload)
    rest = [c for c in rows.columns if c != payload]
    ids = ["internal_id", "internalId", "id", "fleetId"]
    names = ["name", "fleetName", "display", "title"]
    places = ["retailerLocationId", "retailer_location_id", "locationId"]
    members = {n: f"_member_{k}" for k, n in enumerate([*ids, *names, *places])}
    read = rows.select(*rest, p.alias("raw"), F.json_tuple(p, *members).alias(*members.values()))

    def member(name: str) -> Column:
        return F.col(members[name])

    internal = F.coalesce(
        first_non_blank(*map(member, ids)), F.to_json(F.try_parse_json(F.col("raw")))
    )
    name = F.coalesce(first_non_blank(*map(member, names)), internal)
    location = F.coalesce(
        *[strip(member(n)).try_cast("bigint") for n in [*places, "id"]],
        strip(
            F.coalesce(*[F.nullif(member(n), F.lit("")) for n in ("internalId", "internal_id", "fleetId")])
        ).try_cast("bigint"),
    )
    return read.select(
        *rest,
        internal.alias("internal_id"),
        name.alias("name"),
        location.alias("retailer_location_id"),
        "raw",
    )


def reconcile_fleets(discovered: DataFrame, fleets: DataFrame, companies: DataFrame) -> DataFrame:
    """Adds ``company_id`` and ``outcome``: known, insertable or pending."""
    known = one_per_key(fleets.select(F.col("internal_id").alias("_id")), ["_id"]).withColumn(
        "_known", F.lit(True)
    )
    flagged = left_lookup(discovered, F.col("internal_id"), known, "_id", ["_known"])
    resolved = resolve_company(flagged, companies, "retailer_location_id")
    outcome = (
        F.when(F.col("_known"), "known")
        .when(F.col("company_id").isNull(), "pending")
        .otherwise("insertable")
    )
    return resolved.select(
        *discovered.columns, "company_id", outcome.alias("outcome")
    )


# --- trip details ---------------------------------------------------------------------------------


def trips_in_window(
    trips: DataFrame, start: datetime, end: datetime, moment: str = "end_date_datetime"
) -> DataFrame:
    """Half-open UTC range scan: start <= moment < end. The bounds reach the file scan."""
    low, high = (F.lit(v.isoformat(sep=" ")).cast("timestamp_ntz") for v in (start, end))
    return trips.filter((F.col(moment) >= low) & (F.col(moment) < high))


def trip_detail_worklist(trips: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Trips of the window whose details are to be loaded: one row per trip with an account."""
    rows = trips_in_window(trips, start, end).select(
        text_or_null("trip_id").alias("trip_id"), "account_id", "end_date_datetime"
    )
    rows = rows.filter("trip_id IS NOT NULL AND account_id IS NOT NULL")
    first = F.min(F.struct("end_date_datetime", "account_id")).alias("f")
    return rows.groupBy("trip_id").agg(first).select(
        "trip_id", "f.account_id", "f.end_date_datetime"
    )


def in_load_order(worklist: DataFrame) -> DataFrame:
    return worklist.orderBy("end_date_datetime", "trip_id")


def details_for_worklist(details: DataFrame, worklist: DataFrame) -> DataFrame:
    """Landed detail rows that belong to trips of the worklist."""
    return details.join(worklist.select("trip_id"), "trip_id", "left_semi")


def trips_missing_details(worklist: DataFrame, details: DataFrame) -> DataFrame:
    """Worklist trips without any landed detail row."""
    return worklist.join(details.select("trip_id").distinct(), "trip_id", "left_anti")
