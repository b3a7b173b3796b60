"""Dashboard rollups.

Trips are aggregated per driver and day before companies, drivers and users are joined: those
tables have one row per key, so joining them afterwards gives the same groups, and only driver-days
instead of trips meet the joins. A driver or fleet with a large share of the trips is reduced by the
partial aggregate of each input partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from milepost.functions.measures import (
    count_to_long, day_bucket, duration_minutes, incident_total, mean_of_decimals,
    meters_to_miles, round_mean, trip_class,
)
from milepost.functions.people import trip_driver_name
from milepost.operators.skew import one_per_key
from milepost.schemas import (
    INCIDENT_COLUMNS, LAST_INCIDENT_COLUMNS, METRICS, SCORE_COLUMNS,
)

DEFAULT_SUBSCRIPTION = "Mobile App"

_TRIP_KEYS = [
    "company_id", "retailer_location_id", "fleet_id", "fleet_name", "driver_id", "account_id",
    "reporting_day",
]
_FLEET_DAY = [
    "company_id", "company_name", "retailer_location_id", "fleet_internal_id", "fleet_name",
    "reporting_day",
]
_IDENTITY = [
    "company_id", "company_name", "retailer_location_id", "fleet_internal_id", "fleet_name",
    "driver_id", "driver_account_id", "user_id", "user_email", "reporting_day",
]
_COUNTS = ["trip_count", "distance_sample_count", "score_sample_count"]


def eligible_companies(
    subscriptions: DataFrame,
    company_subscriptions: DataFrame,
    subscription_name: str = DEFAULT_SUBSCRIPTION,
) -> DataFrame:
    """Companies that hold the named subscription (of several with that name, the lowest id)."""
    chosen = subscriptions.filter(F.col("subscription_name") == subscription_name).agg(
        F.min("id").alias("subscription_id")
    )
    holders = company_subscriptions.join(chosen, "subscription_id", "left_semi").select("company_id")
    return one_per_key(holders, ["company_id"])


# Company ids up to this number (a few MB) are broadcast to filter the trips.
BROADCAST_COMPANIES = 200_000


def counted_side(eligible: DataFrame) -> DataFrame | None:
    """The company ids marked for broadcast, or None when there are too many of them."""
    count = eligible.limit(BROADCAST_COMPANIES + 1).count()
    return F.broadcast(eligible) if count <= BROADCAST_COMPANIES else None


def ended_trips(trips: DataFrame, eligible: DataFrame) -> DataFrame:
    """Trips with an end time, of eligible companies."""
    side = counted_side(eligible)
    return trips.filter("end_date_datetime IS NOT NULL").join(
        eligible if side is None else side, "company_id", "left_semi"
    )


def _day_aggregates(trips: DataFrame, eligible: DataFrame, events: bool) -> DataFrame:
    """Trips per driver and day.

    A counted, small set of eligible companies filters the trips in place. A larger one filters the
    driver-days instead: joining the trips would bring each company's trips into one partition,
    which the aggregate would then take over.
    """
    ended = trips.filter("end_date_datetime IS NOT NULL")
    side = counted_side(eligible)
    if side is None:
        return _aggregate_days(ended, events).join(eligible, "company_id", "left_semi")
    return _aggregate_days(ended.join(side, "company_id", "left_semi"), events)


def _aggregate_days(trips: DataFrame, events: bool) -> DataFrame:
    aggregates: list[Column] = [
        F.count("*").alias("trip_count"),
        F.count("distance_meters").alias("distance_sample_count"),
        F.count("overall_score").alias("score_sample_count"),
        F.sum("distance_meters").alias("_meters"),
        F.avg("overall_score").alias("_mean_score"),
        F.min("start_date_datetime").alias("first_trip_start_datetime"),
        F.max("end_date_datetime").alias("last_trip_end_datetime"),
    ]
    if events:
        aggregates += [F.sum(F.coalesce(c, F.lit(0.0))).alias(f"_{c}") for c in INCIDENT_COLUMNS]
        aggregates += [F.count(c).alias(f"{c}_sample_count") for c in SCORE_COLUMNS]
        aggregates += [F.avg(c).alias(f"_{c}") for c in SCORE_COLUMNS]
    return (
        trips.withColumn("reporting_day", F.col("end_date_datetime").cast("date"))
        .groupBy(*_TRIP_KEYS)
        .agg(*aggregates)
    )


# --- partial states -------------------------------------------------------------------------------

_STATE_SUMS = (
    [*_COUNTS, "_meters", "_score"]
    + [f"_{c}" for c in INCIDENT_COLUMNS]
    + [f"{c}_sample_count" for c in SCORE_COLUMNS]
    + [f"_{c}" for c in SCORE_COLUMNS]
)


def day_states(trips: DataFrame) -> DataFrame:
    """Partial states per driver and day, of all companies: counts, sums, first start and last end.

    States of disjoint sets of trips merge to the state of their union (:func:`merge_states`).
    """
    aggregates = [
        F.count("*").alias("trip_count"),
        F.count("distance_meters").alias("distance_sample_count"),
        F.count("overall_score").alias("score_sample_count"),
        F.sum("distance_meters").alias("_meters"),
        F.sum("overall_score").alias("_score"),
        F.min("start_date_datetime").alias("first_trip_start_datetime"),
        F.max("end_date_datetime").alias("last_trip_end_datetime"),
        *[F.sum(F.coalesce(c, F.lit(0.0))).alias(f"_{c}") for c in INCIDENT_COLUMNS],
        *[F.count(c).alias(f"{c}_sample_count") for c in SCORE_COLUMNS],
        *[F.sum(c).alias(f"_{c}") for c in SCORE_COLUMNS],
    ]
    return with_reporting_day(trips).groupBy(*_TRIP_KEYS).agg(*aggregates)


def with_reporting_day(trips: DataFrame) -> DataFrame:
    """Ended trips with the day they count for."""
    return trips.filter("end_date_datetime IS NOT NULL").withColumn(
        "reporting_day", F.col("end_date_datetime").cast("date")
    )


def merge_states(states: DataFrame) -> DataFrame:
    """One state per driver and day from several."""
    return states.groupBy(*_TRIP_KEYS).agg(
        *[F.sum(c).alias(c) for c in _STATE_SUMS],
        F.min("first_trip_start_datetime").alias("first_trip_start_datetime"),
        F.max("last_trip_end_datetime").alias("last_trip_end_datetime"),
    )


def same_group(left: str, right: str) -> Column:
    """Whether two aliased rows belong to one driver-day; NULL equals NULL."""
    out = F.lit(True)
    for k in _TRIP_KEYS:
        out = out & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return out


def state_groups(trips: DataFrame) -> DataFrame:
    """The driver-days of some ended trips."""
    return with_reporting_day(trips).select(*_TRIP_KEYS).distinct()


def event_rollup_of_states(
    states: DataFrame, eligible: DataFrame, companies: DataFrame, drivers: DataFrame, users: DataFrame
) -> DataFrame:
    """What :func:`trip_event_day_rollup` gives for the trips of the states, bucket included."""
    days = states.join(eligible, "company_id", "left_semi")
    means = {"_mean_score": ("_score", "score_sample_count")}
    means |= {f"_{c}": (f"_{c}", f"{c}_sample_count") for c in SCORE_COLUMNS}
    for name, (total, count) in means.items():
        days = days.withColumn(name, F.when(F.col(count) > 0, F.col(total) / F.col(count)))
    return _event_rollup(days, companies, drivers, users, True)


def _with_identity(
    days: DataFrame, companies: DataFrame, drivers: DataFrame, users: DataFrame
) -> DataFrame:
    """Adds company name, user and e-mail. Drivers meet users first: one join on driver id less."""
    company_side = companies.select(F.col("id").alias("company_id"), "company_name")
    user_side = users.select(F.col("id").alias("user_id"), F.col("email").alias("user_email"))
    driver_side = drivers.select("driver_id", "user_id").join(user_side, "user_id")
    return (
        days.join(company_side, "company_id")
        .join(driver_side, "driver_id")
        .withColumnRenamed("fleet_id", "fleet_internal_id")
        .withColumnRenamed("account_id", "driver_account_id")
    )


def _distance_and_score() -> list[Column]:
    meters = F.coalesce("_meters", F.lit(0))
    return [
        meters.alias("total_distance_meters"),
        meters_to_miles(meters).alias("total_distance_miles"),
        round_mean(F.col("_mean_score")).alias("average_overall_score"),
    ]


def trip_day_rollup(
    trips: DataFrame, eligible: DataFrame, companies: DataFrame, drivers: DataFrame,
    users: DataFrame,
) -> DataFrame:
    """One row per company, fleet, driver and day: trips, distance, mean score and bucket."""
    days = _with_identity(_day_aggregates(trips, eligible, False), companies, drivers, users)
    return days.select(
        *_IDENTITY,
        *_COUNTS,
        *_distance_and_score(),
        "first_trip_start_datetime",
        "last_trip_end_datetime",
        day_bucket(F.col("distance_sample_count"), F.col("_meters"), F.col("_mean_score")).alias(
            "performance_bucket"
        ),
    )


def _event_columns() -> list[Column]:
    return (
        [count_to_long(F.col(f"_{m}_incidents")).alias(f"total_{m}_incidents") for m in METRICS]
        + [incident_total("_").alias("total_event_incidents")]
        + [F.col(f"{c}_sample_count") for c in SCORE_COLUMNS]
        + [round_mean(F.col(f"_{m}_score")).alias(f"average_{m}_score") for m in METRICS]
    )


def trip_event_day_rollup(
    trips: DataFrame, eligible: DataFrame, companies: DataFrame, drivers: DataFrame,
    users: DataFrame, with_bucket: bool = False,
) -> DataFrame:
    """The day rollup with incident totals and mean scores per behaviour.

    ``with_bucket`` adds the performance bucket, so that both day rollups can be taken from one
    pass over the trips.
    """
    return _event_rollup(_day_aggregates(trips, eligible, True), companies, drivers, users, with_bucket)


def _event_rollup(
    days: DataFrame, companies: DataFrame, drivers: DataFrame, users: DataFrame, with_bucket: bool
) -> DataFrame:
    days = _with_identity(days, companies, drivers, users)
    bucket = day_bucket(F.col("distance_sample_count"), F.col("_meters"), F.col("_mean_score"))
    return days.select(
        *_IDENTITY,
        *_COUNTS,
        *_distance_and_score(),
        *_event_columns(),
        "first_trip_start_datetime",
        "last_trip_end_datetime",
        *([bucket.alias("performance_bucket")] if with_bucket else []),
    )


def split_day_rollups(combined: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(day rollup, event day rollup) from the combined pass."""
    plain = combined.select(
        *_IDENTITY, *_COUNTS, "total_distance_meters", "total_distance_miles",
        "average_overall_score", "first_trip_start_datetime", "last_trip_end_datetime",
        "performance_bucket",
    )
    return plain, combined.drop("performance_bucket")


def performance_groups(day_rollup: DataFrame) -> DataFrame:
    """Driver-days per company, fleet, day and bucket."""
    groups = day_rollup.groupBy(*_FLEET_DAY, "performance_bucket").agg(
        F.count("*").alias("driver_day_count"),
        F.sum("trip_count").alias("total_trip_count"),
        F.sum("total_distance_meters").alias("total_distance_meters"),
        mean_of_decimals(F.col("average_overall_score")).alias("average_daily_overall_score"),
    )
    return groups.select(
        *_FLEET_DAY,
        "performance_bucket",
        "driver_day_count",
        "total_trip_count",
        "total_distance_meters",
        meters_to_miles(F.col("total_distance_meters")).alias("total_distance_miles"),
        "average_daily_overall_score",
    )


def trip_event_groups(event_rollup: DataFrame) -> DataFrame:
    """Driver-days per company, fleet and day with incident totals and mean daily scores."""
    summed = (
        ["distance_sample_count", "score_sample_count"]
        + [f"total_{m}_incidents" for m in METRICS]
        + ["total_event_incidents"]
        + [f"{c}_sample_count" for c in SCORE_COLUMNS]
    )
    groups = event_rollup.groupBy(*_FLEET_DAY).agg(
        F.count("*").alias("driver_day_count"),
        F.sum("trip_count").alias("total_trip_count"),
        F.sum("total_distance_meters").alias("total_distance_meters"),
        mean_of_decimals(F.col("average_overall_score")).alias("average_daily_overall_score"),
        *[F.sum(c).alias(c) for c in summed],
        *[
            mean_of_decimals(F.col(f"average_{m}_score")).alias(f"average_daily_{m}_score")
            for m in METRICS
        ],
    )
    return groups.withColumn(
        "total_distance_miles", meters_to_miles(F.col("total_distance_meters"))
    )


def driver_trip_list(
    trips: DataFrame, eligible: DataFrame, drivers: DataFrame, users: DataFrame
) -> DataFrame:
    """One row per trip with the driver's name, for dashboard tables."""
    user_side = users.select(
        F.col("id").alias("user_id"), "display_name", "first_name", "last_name"
    )
    driver_side = (
        drivers.select("driver_id", "user_id").join(user_side, "user_id", "left").drop("user_id")
    )
    joined = ended_trips(trips, eligible).join(driver_side, "driver_id")
    name = trip_driver_name(
        F.col("driver_name"), F.col("display_name"), F.col("first_name"), F.col("last_name")
    )
    return joined.select(
        "company_id",
        "driver_id",
        F.col("account_id").alias("driver_account_id"),
        name.alias("driver_display_name"),
        F.col("fleet_id").alias("fleet_internal_id"),
        "fleet_name",
        "trip_id",
        "start_date_datetime",
        "end_date_datetime",
        meters_to_miles(F.coalesce("distance_meters", F.lit(0))).alias("distance_miles"),
        duration_minutes(F.col("start_date"), F.col("end_date")).alias("duration_minutes"),
        "overall_score",
        *[count_to_long(F.col(c)).alias(c) for c in INCIDENT_COLUMNS],
        incident_total().alias("total_event_incidents"),
        *SCORE_COLUMNS,
        trip_class(F.col("overall_score")).alias("performance_class"),
        F.col("geo.startDescription").alias("geo_start_description"),
        F.col("geo.endDescription").alias("geo_end_description"),
        F.col("weather.weatherWind").alias("weather_wind"),
        F.col("weather.weatherTempLow").alias("weather_temp_low"),
        F.col("weather.weatherTempHigh").alias("weather_temp_high"),
        *[f"{c}_datetime" for c in LAST_INCIDENT_COLUMNS],
    )
