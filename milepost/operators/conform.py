"""Landed text rows -> conformed, typed rows.

Each ``conform_*`` keeps every input row and adds ``_status`` (``resolved``, ``skipped``,
``filtered`` or ``deduped``) and ``_reason``; :func:`accepted` and :func:`rejected` split the
result. One pass thus feeds the table, the reject output and the accounting.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from milepost.functions.coerce import (
    first_filled, iso_date, number_to_double, number_to_long, strip, text_or_null, to_bool,
    to_long, with_number_text,
)
from milepost.functions.jsontext import (
    app_blob_driver_id, canonical_json, parse_metadata, to_json_text,
)
from milepost.functions.measures import epoch_in_range, epoch_ms_to_timestamp
from milepost.functions.people import contact_email, focus_driver_id, location_id
from milepost.operators.accounting import Watch
from milepost.operators.dedup import distinct_points
from milepost.operators.lookups import (
    left_lookup, resolve_company, resolve_driver_user, resolve_fleet_identity,
)
from milepost.operators.skew import one_per_key
from milepost.session import cut_lineage
from milepost.schemas import (
    DRIVER_SCORE_KEY, INCIDENT_KEY, LAST_INCIDENT_COLUMNS, LOCATION_KEY, METRICS, TRIP_KEY, camel,
)

# Group keys of rows that carry none.
SCORE_GROUP = "GL_REPORT_DATA"
TRIP_GROUP = "GL_TRIP_DATA"

RESOLVED, SKIPPED, FILTERED, DEDUPED = "resolved", "skipped", "filtered", "deduped"


def accepted(df: DataFrame) -> DataFrame:
    return df.filter(F.col("_status") == RESOLVED).drop("_status", "_reason")


def rejected(df: DataFrame) -> DataFrame:
    return df.filter(F.col("_status") != RESOLVED)


def _status(df: DataFrame, *rules: tuple[Column, str, str]) -> DataFrame:
    """First rule that holds decides; no rule means resolved."""
    status, reason = F.lit(RESOLVED), F.lit(None).cast("string")
    for holds, name, why in reversed(rules):
        status = F.when(holds, F.lit(name)).otherwise(status)
        reason = F.when(holds, F.lit(why)).otherwise(reason)
    return df.withColumn("_status", status).withColumn("_reason", reason)


def _pack(df: DataFrame, keep: list[str]) -> DataFrame:
    """Columns that only pass through the lookups, as one struct: the joins stay narrow."""
    rest = [c for c in df.columns if c not in keep]
    return df.select(*keep, *([F.struct(*rest).alias("_row")] if rest else []))


def _unpack(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in df.columns if c != "_row"], "_row.*") if "_row" in df.columns else df


def _evaluate_once(df: DataFrame) -> DataFrame:
    """Keeps later filters from being pushed below, where they would coerce every column again."""
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def _metric_columns() -> list[Column]:
    return (
        [_long("distance").alias("distance_meters"), _double("overallScore").alias("overall_score")]
        + [_double(f"{m}Score").alias(f"{m}_score") for m in METRICS]
        + [_double(f"{m}Incidents").alias(f"{m}_incidents") for m in METRICS]
        + [_long(f"last{camel(m)}Incident").alias(f"last_{m}_incident") for m in METRICS]
    )


_METRIC_FIELDS = (
    ["accountId", "distance", "overallScore"]
    + [f"{m}Score" for m in METRICS]
    + [f"{m}Incidents" for m in METRICS]
    + [f"last{camel(m)}Incident" for m in METRICS]
)
_GEO_NUMBERS = ["startLatitude", "startLongitude", "endLatitude", "endLongitude"]
_WEATHER_NUMBERS = ["weatherTempLow", "weatherTempHigh", "weatherWind"]


def _long(name: str) -> Column:
    return number_to_long(F.col(name))


def _double(name: str) -> Column:
    return number_to_double(F.col(name))


def report_driver_id() -> Column:
    return text_or_null(first_filled(F.col("driverId"), F.col("thirdPartyId")))


def _with_known_flag(df: DataFrame, drivers: DataFrame) -> DataFrame:
    known = one_per_key(drivers.select(F.col("driver_id").alias("_id")), ["_id"])
    flagged = left_lookup(df, F.col("driver_id"), known.withColumn("_known", F.lit(True)), "_id",
                          ["_known"], spread_by=["_position"])
    return flagged.withColumn("_known", F.coalesce("_known", F.lit(False)))


# --- fleets and drivers ---------------------------------------------------------------------------

_COUNTERS = ("favoriteCount", "noteCount", "sharedCount", "likeCount", "dislikeCount")


def fleet_stats() -> Column:
    """Seven counters folded into one struct."""
    return F.struct(
        to_bool("favorite").alias("favorite"),
        *[to_long(c).alias(c) for c in _COUNTERS],
        to_bool("hasRatings").alias("hasRatings"),
    )


def conform_fleet(raw: DataFrame, companies: DataFrame) -> DataFrame:
    """Fleet rows; a fleet that no company claims is skipped."""
    blobs = {
        "manager": "manager", "categories": "categories", "filters": "filters",
        "billable_entity": "billableEntity", "retailer": "retailer", "offers": "offers",
    }
    mapped = raw.select(
        to_long("retailerLocationId").alias("retailer_location_id"),
        F.col("internalId").alias("internal_id"),
        "name",
        F.col("locationType").alias("location_type"),
        to_bool("publicLocation").alias("public_location"),
        F.col("qrCodeUrl").alias("qr_code_url"),
        F.col("locationToken").alias("location_token"),
        to_bool("active").alias("active"),
        strip("latitude").try_cast("decimal(9,6)").alias("latitude"),
        strip("longitude").try_cast("decimal(9,6)").alias("longitude"),
        *[F.col(src).alias(dst) for dst, src in blobs.items()],
        parse_metadata(F.col("metaData")).alias("meta_data"),
        "contact",
        to_json_text(fleet_stats()).alias("stats"),
    )
    resolved = resolve_company(mapped, companies, "retailer_location_id")
    return _status(
        resolved.drop("conflicting_companies"),
        (F.col("company_id").isNull(), SKIPPED, "unresolved_company"),
    )


def conform_driver(raw: DataFrame, users: DataFrame, default_location: Column) -> DataFrame:
    """Driver rows; a driver without a matching user or report identity is skipped."""
    keyed = raw.withColumn("_focus_id", focus_driver_id(F.col("focus_data"))).withColumn(
        "_contact_email", contact_email(F.col("contactEmail"), F.col("contact"))
    )
    resolved = resolve_driver_user(keyed, users, F.col("_focus_id"), F.col("_contact_email"))
    mapped = resolved.select(
        to_long("accountId").alias("account_id"),
        app_blob_driver_id(F.col("appInfo")).alias("driver_id"),
        "user_id",
        location_id(F.col("locations"), default_location).alias("retailer_location_id"),
        "display",
        "username",
        F.col("accountType").alias("account_type"),
        F.col("_contact_email").alias("contact_email"),
        F.col("locationDisplay").alias("location_display"),
        to_bool("active").alias("active"),
        strip("latitude").try_cast("decimal(9,6)").alias("latitude"),
        strip("longitude").try_cast("decimal(9,6)").alias("longitude"),
        to_long("locationCount").cast("int").alias("location_count"),
        "manager",
        "contact",
        "employer",
        F.col("appInfo").alias("app_info"),
        "locations",
        "_focus_id",
    )
    no_user = F.col("user_id").isNull()
    no_identity = F.col("_focus_id").isNull() & F.col("contact_email").isNull()
    return _status(
        mapped,
        (no_user & no_identity, SKIPPED, "no_driver_identity"),
        (no_user, SKIPPED, "user_not_found"),
        (F.col("driver_id").isNull(), SKIPPED, "missing_driver_id"),
    )


def rejected_drivers(conformed: DataFrame) -> DataFrame:
    """Reject table: identity as far as known, and the reason."""
    lost_later = F.col("_reason") == "missing_driver_id"
    return rejected(conformed).select(
        "account_id",
        "display",
        F.when(~lost_later, F.col("_focus_id")).alias("driver_id"),
        "contact_email",
        F.col("_reason").alias("reason"),
    )


# --- scores and trips -----------------------------------------------------------------------------


def conform_driver_score(
    raw: DataFrame, fleets: DataFrame, drivers: DataFrame, snapshot_date: date, position: str,
    order: str | None = None, watch: Watch | None = None,
) -> DataFrame:
    """Daily driver scores; when a key repeats, the last source row is kept (:func:`judge_driver_scores`)."""
    judged = judge_driver_scores(raw, fleets, drivers, snapshot_date, position, order)
    marked = mark_duplicates(judged, DRIVER_SCORE_KEY, "last", watch)
    return _unpack(marked.drop("_known", "_position"))


def judge_driver_scores(
    raw: DataFrame, fleets: DataFrame, drivers: DataFrame, snapshot_date: date, position: str,
    order: str | None = None,
) -> DataFrame:
    """Driver scores with their status, repeated keys not told apart yet.

    ``position`` is the 1-based row number in the source document; ``order`` orders all rows, where
    that differs.
    """
    given = F.col("sourceRowIndex")
    mapped = with_number_text(raw, _METRIC_FIELDS + ["sourceRowIndex"]).select(
        report_driver_id().alias("driver_id"),
        _long("accountId").alias("account_id"),
        F.coalesce(iso_date("snapshotDate"), F.lit(snapshot_date)).alias("snapshot_date"),
        F.coalesce(text_or_null("sourceGroupKey"), F.lit(SCORE_GROUP)).alias("source_group_key"),
        F.when(given.isNull(), F.col(position)).otherwise(number_to_long(given)).alias("source_row_index"),
        text_or_null("fleetId").alias("fleet_id"),
        text_or_null("fleetName").alias("fleet_name"),
        text_or_null("thirdPartyId").alias("third_party_id"),
        text_or_null("driverName").alias("driver_name"),
        *_metric_columns(),
        F.col(order or position).alias("_position"),
    )
    mapped = _pack(mapped, [*DRIVER_SCORE_KEY, "source_row_index", "_position"])
    flagged = _with_known_flag(
        resolve_fleet_identity(mapped, fleets, "fleet_id", spread_by=["_position"]), drivers
    )
    return _status(
        flagged,
        (F.col("driver_id").isNull(), SKIPPED, "missing_driver_id"),
        (~F.col("_known"), FILTERED, "unknown_driver"),
        (F.col("source_row_index").isNull(), SKIPPED, "missing_row_index"),
        (F.col("fleet_id").isNull(), SKIPPED, "missing_fleet"),
        (F.col("company_id").isNull(), SKIPPED, "unresolved_company"),
    )


def geo_struct() -> Column:
    """Trip end points from number text columns, NULL when all parts are missing."""
    parts = [
        _double("startLatitude").alias("startLatitude"),
        _double("startLongitude").alias("startLongitude"),
        F.col("startDescription"),
        _double("endLatitude").alias("endLatitude"),
        _double("endLongitude").alias("endLongitude"),
        F.col("endDescription"),
    ]
    return _struct_or_null(parts)


def weather_struct() -> Column:
    """Weather from number text columns, NULL when all parts are missing."""
    parts = [
        F.col("weatherCode"),
        _double("weatherTempLow").alias("weatherTempLow"),
        _double("weatherTempHigh").alias("weatherTempHigh"),
        _double("weatherWind").alias("weatherWind"),
    ]
    return _struct_or_null(parts)


def _struct_or_null(parts: list[Column]) -> Column:
    any_filled = F.lit(False)
    for p in parts:
        any_filled = any_filled | p.isNotNull()
    return F.when(any_filled, F.struct(*parts))


def trip_window_reason(start: Column, end: Column) -> Column:
    """Why a trip's time window is unusable; NULL when it is fine."""
    return (
        F.when(start.isNull() | end.isNull(), "missing_trip_window")
        .when(~epoch_in_range(start) | ~epoch_in_range(end), "timestamp_out_of_range")
        .when(end < start, "invalid_trip_window")
    )


def map_trip_rows(raw: DataFrame, position: str) -> DataFrame:
    numbers = _METRIC_FIELDS + ["startDate", "endDate"] + _GEO_NUMBERS + _WEATHER_NUMBERS
    return with_number_text(raw, numbers).select(
        text_or_null("tripId").alias("trip_id"),
        _long("accountId").alias("account_id"),
        report_driver_id().alias("driver_id"),
        text_or_null("fleetId").alias("fleet_id"),
        text_or_null("fleetName").alias("fleet_name"),
        text_or_null("thirdPartyId").alias("third_party_id"),
        text_or_null("driverName").alias("driver_name"),
        text_or_null("tripType").alias("trip_type"),
        _long("startDate").alias("start_date"),
        _long("endDate").alias("end_date"),
        *_metric_columns(),
        geo_struct().alias("geo"),
        weather_struct().alias("weather"),
        F.col(position).alias("_position"),
    )


def conform_trip_score(
    raw: DataFrame, fleets: DataFrame, drivers: DataFrame, position: str, order: str | None = None,
    watch: Watch | None = None, columns: list[str] | None = None,
) -> DataFrame:
    """Trip scores; of rows with one trip id the first usable one in source order is kept.

    ``columns`` names those of the result that are asked for besides status and reason: all rows are judged by all
    rules, and only the columns that these need are moved and written on the way.
    """
    marked = mark_duplicates(
        judge_trip_scores(raw, fleets, drivers, position, order, columns), TRIP_KEY, "first", watch
    )
    found = _unpack(marked.drop("_known", "_position"))
    return found if columns is None else found.select(*columns, "_status", "_reason")


_TRIP_RULE_COLUMNS = ["trip_id", "driver_id", "fleet_id", "start_date", "end_date", "_position"]


def judge_trip_scores(
    raw: DataFrame, fleets: DataFrame, drivers: DataFrame, position: str, order: str | None = None,
    columns: list[str] | None = None,
) -> DataFrame:
    """Trip scores with their status, repeated trips not told apart yet; of the columns that no rule looks at,
    those named in ``columns`` (None: all)."""
    rows = map_trip_rows(raw, order or position)
    if columns is not None:
        rows = rows.select(*[c for c in rows.columns if c in _TRIP_RULE_COLUMNS or c in columns])
    mapped = _pack(rows, _TRIP_RULE_COLUMNS)
    flagged = _with_known_flag(
        resolve_fleet_identity(mapped, fleets, "fleet_id", spread_by=["_position"]), drivers
    )
    window = trip_window_reason(F.col("start_date"), F.col("end_date"))
    return _status(
        flagged,
        (F.col("trip_id").isNull() | F.col("driver_id").isNull(), SKIPPED,
         "missing_trip_id_or_driver_id"),
        (~F.col("_known"), FILTERED, "unknown_driver"),
        (window == "missing_trip_window", SKIPPED, "missing_trip_window"),
        (window == "timestamp_out_of_range", SKIPPED, "timestamp_out_of_range"),
        (window == "invalid_trip_window", SKIPPED, "invalid_trip_window"),
        (F.col("company_id").isNull(), SKIPPED, "unresolved_company"),
    )


def mark_duplicates(judged: DataFrame, keys: list[str], keep: str, watch: Watch | None = None) -> DataFrame:
    """Sets the status of all resolved rows but one per key (``keep`` first or last) to ``deduped``.

    The judged rows are written to the shared folder once: their keys and positions are read for the
    kept position per key, a partial aggregate which a frequent key does not slow down, and all of
    them for the join with it on the typed keys. Rows that are not resolved pass by the join. A ``watch``
    counts the judged rows as they are written.
    """
    judged = cut_lineage(judged, "judged", "zstd", watch)
    resolved = F.col("_status") == RESOLVED
    best = (F.min if keep == "first" else F.max)("_position").alias("_kept_position")
    usable = judged.filter(resolved)
    kept = one_per_key(usable, keys, best)
    extra = F.col("_position") != F.col("_kept_position")
    marked = usable.join(kept, keys).select(
        *[c for c in judged.columns if c not in ("_status", "_reason")],
        F.when(extra, DEDUPED).otherwise(F.col("_status")).alias("_status"),
        F.when(extra, "duplicate_key").otherwise(F.col("_reason")).alias("_reason"),
    )
    return marked.unionByName(judged.filter(~resolved))


# --- trip details ---------------------------------------------------------------------------------


def _conform_points(raw: DataFrame, keys: list[str]) -> DataFrame:
    columns = {
        "trip_id": text_or_null("tripId"),
        "account_id": _long("accountId"),
        "timestamp_ms": _long("timestamp"),
        "latitude": _double("latitude"),
        "longitude": _double("longitude"),
    }
    if "incident_type" in keys:
        columns["incident_type"] = text_or_null("type")
    stripped = with_number_text(raw, ["accountId", "timestamp", "latitude", "longitude"])
    mapped = _evaluate_once(stripped.select(*[columns[k].alias(k) for k in keys]))
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    return _status(
        mapped,
        (missing, SKIPPED, "missing_required_fields"),
        (~epoch_in_range(F.col("timestamp_ms")), SKIPPED, "timestamp_out_of_range"),
    )


def conform_trip_location(raw: DataFrame) -> DataFrame:
    return _conform_points(raw, LOCATION_KEY)


def conform_trip_incident(raw: DataFrame) -> DataFrame:
    return _conform_points(raw, INCIDENT_KEY)


def dedup_locations(points: DataFrame) -> DataFrame:
    return distinct_points(points, LOCATION_KEY)


def dedup_incidents(points: DataFrame) -> DataFrame:
    return distinct_points(points, INCIDENT_KEY)


# --- derived columns and stamping -----------------------------------------------------------------


def derive_incident_times(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {f"{c}_datetime": epoch_ms_to_timestamp(F.col(c)) for c in LAST_INCIDENT_COLUMNS}
    )


def derive_trip_times(df: DataFrame) -> DataFrame:
    """Wall-clock times and the whole-second duration, recomputed from the epoch columns."""
    return derive_incident_times(df).withColumns(
        {
            "start_date_datetime": epoch_ms_to_timestamp(F.col("start_date")),
            "end_date_datetime": epoch_ms_to_timestamp(F.col("end_date")),
            "duration_seconds": F.expr("CAST((end_date - start_date) DIV 1000 AS INT)"),
        }
    )


def derive_point_time(df: DataFrame) -> DataFrame:
    return df.withColumn("timestamp_datetime", epoch_ms_to_timestamp(F.col("timestamp_ms")))


# Pages are numbered in blocks of this many, so that no day's pages are summed up in one task.
PAGES_PER_BLOCK = 4096


def stamp_daily_scores(rows: DataFrame, day: str, page: str, position: str) -> DataFrame:
    """Snapshot date, group key per day and 1-based row index within the day.

    A day may be large, so it is not ranked as one group: rows are ranked within their page, pages
    start where the pages before them in their block end, and blocks likewise.
    """
    sizes = rows.groupBy(F.col(day).alias("_day"), F.col(page).alias("_page")).agg(
        F.count("*").alias("_size")
    )
    sizes = sizes.withColumn("_block", F.floor(F.col("_page") / PAGES_PER_BLOCK))

    def rows_before(*group: str, order: str, size: str) -> Column:
        earlier = Window.partitionBy(*group).orderBy(order).rowsBetween(
            Window.unboundedPreceding, -1
        )
        return F.coalesce(F.sum(size).over(earlier), F.lit(0))

    blocks = sizes.groupBy("_day", "_block").agg(F.sum("_size").alias("_block_size"))
    block_starts = blocks.select(
        "_day", "_block",
        rows_before("_day", order="_block", size="_block_size").alias("_block_start"),
    )
    page_starts = sizes.select(
        "_day", "_block", "_page",
        rows_before("_day", "_block", order="_page", size="_size").alias("_page_start"),
    )
    starts = page_starts.join(block_starts, ["_day", "_block"]).select(
        "_day", "_page", (F.col("_block_start") + F.col("_page_start")).alias("_start")
    )
    within = F.row_number().over(Window.partitionBy(day, page).orderBy(position))
    day_text = F.date_format(F.col(day), "yyyy-MM-dd")
    return (
        rows.withColumn("_within", within)
        .join(starts, (F.col(day) == F.col("_day")) & (F.col(page) == F.col("_page")))
        .select(
            *rows.columns,
            day_text.alias("snapshotDate"),
            F.concat(F.lit(SCORE_GROUP + ":"), day_text).alias("sourceGroupKey"),
            (F.col("_start") + F.col("_within")).alias("sourceRowIndex"),
        )
    )


def comparable_json(df: DataFrame, columns: list[str]) -> DataFrame:
    """JSON text columns in canonical form, so that a merge sees equal documents as unchanged."""
    return df.withColumns({c: canonical_json(F.col(c)) for c in columns})
