"""Column lists and schemas of the conformed tables."""

from __future__ import annotations

from pyspark.sql import types as T

# The six scored behaviours, in table order.
METRICS = ("accel", "brake", "collision", "phone", "speed", "turn")

SCORE_COLUMNS = [f"{m}_score" for m in METRICS]
INCIDENT_COLUMNS = [f"{m}_incidents" for m in METRICS]
LAST_INCIDENT_COLUMNS = [f"last_{m}_incident" for m in METRICS]

DRIVER_SCORE_KEY = ["snapshot_date", "fleet_id", "driver_id"]
TRIP_KEY = ["trip_id"]
FLEET_KEY = ["retailer_location_id"]
DRIVER_KEY = ["driver_id"]
LOCATION_KEY = ["trip_id", "account_id", "timestamp_ms", "latitude", "longitude"]
INCIDENT_KEY = LOCATION_KEY + ["incident_type"]

# Uniqueness rules of the rollups (narrower than their grouping keys).
ROLLUP_KEYS = {
    "driver_trip_list": ["trip_id"],
    "trip_day_rollup": ["company_id", "retailer_location_id", "driver_id", "reporting_day"],
    "performance_groups": [
        "company_id", "retailer_location_id", "reporting_day", "performance_bucket",
    ],
    "trip_event_day_rollup": ["company_id", "retailer_location_id", "driver_id", "reporting_day"],
    "trip_event_groups": ["company_id", "retailer_location_id", "reporting_day"],
}

GEO = T.StructType(
    [
        T.StructField("startLatitude", T.DoubleType()),
        T.StructField("startLongitude", T.DoubleType()),
        T.StructField("startDescription", T.StringType()),
        T.StructField("endLatitude", T.DoubleType()),
        T.StructField("endLongitude", T.DoubleType()),
        T.StructField("endDescription", T.StringType()),
    ]
)
WEATHER = T.StructType(
    [
        T.StructField("weatherCode", T.StringType()),
        T.StructField("weatherTempLow", T.DoubleType()),
        T.StructField("weatherTempHigh", T.DoubleType()),
        T.StructField("weatherWind", T.DoubleType()),
    ]
)


def camel(metric: str) -> str:
    return metric[:1].upper() + metric[1:]


def text_struct(names: list[str]) -> T.StructType:
    """A schema of text fields: landed JSON is read as text and coerced afterwards."""
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


_REPORT_FIELDS = (
    ["driverId", "thirdPartyId", "accountId", "fleetId", "fleetName", "driverName"]
    + ["distance", "overallScore"]
    + [f"{m}Score" for m in METRICS]
    + [f"{m}Incidents" for m in METRICS]
    + [f"last{camel(m)}Incident" for m in METRICS]
    + ["snapshotDate", "sourceGroupKey", "sourceRowIndex"]
)

# Field names of the landed JSON rows, all read as text.
LANDED = {
    "driver_scores": text_struct(_REPORT_FIELDS),
    "trip_scores": text_struct(
        ["tripId", "tripType", "startDate", "endDate"]
        + _REPORT_FIELDS
        + [f.name for f in GEO.fields]
        + [f.name for f in WEATHER.fields]
    ),
    "trip_locations": text_struct(["tripId", "accountId", "timestamp", "latitude", "longitude"]),
    "trip_incidents": text_struct(
        ["tripId", "accountId", "timestamp", "latitude", "longitude", "type"]
    ),
    "fleet": text_struct(
        [
            "retailerLocationId", "internalId", "name", "locationType", "publicLocation",
            "qrCodeUrl", "locationToken", "active", "latitude", "longitude", "manager",
            "categories", "filters", "billableEntity", "retailer", "offers", "metaData",
            "contact", "favorite", "favoriteCount", "noteCount", "sharedCount", "likeCount",
            "dislikeCount", "hasRatings",
        ]
    ),
    "drivers": text_struct(
        [
            "accountId", "display", "username", "accountType", "contactEmail",
            "locationDisplay", "active", "latitude", "longitude", "locationCount", "manager",
            "contact", "employer", "appInfo", "locations", "focus_data",
        ]
    ),
}
