"""Names, e-mail addresses and locations of drivers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from milepost.functions.coerce import blank_trim, text_or_null, to_long
from milepost.functions.jsontext import json_path


def contact_email(top_level: Column, contact_json: Column) -> Column:
    nested = json_path(contact_json, "contactInfo.emailAddress")
    return F.coalesce(text_or_null(top_level), text_or_null(nested))


def focus_driver_id(focus_json: Column) -> Column:
    return text_or_null(json_path(focus_json, "DriverId"))


def location_id(locations_json: Column, default: Column) -> Column:
    """Id of the first listed location, else the default."""
    return F.coalesce(to_long(json_path(locations_json, "[0].retailerLocationId")), default)


def report_driver_name(
    display: Column, contact_json: Column, email: Column, username: Column
) -> Column:
    """Display name, else first and last name, else an e-mail address, else the user name."""
    joined = F.nullif(
        F.concat_ws(
            " ",
            text_or_null(json_path(contact_json, "firstName")),
            text_or_null(json_path(contact_json, "lastName")),
        ),
        F.lit(""),
    )
    return F.coalesce(
        text_or_null(display),
        joined,
        text_or_null(json_path(contact_json, "contactInfo.emailAddress")),
        text_or_null(email),
        text_or_null(username),
    )


def trip_driver_name(stored: Column, display: Column, first: Column, last: Column) -> Column:
    """Name for trip lists. A display name of blanks falls through to first and last name."""
    joined = F.concat_ws(" ", first, last)
    return F.coalesce(blank_trim(stored), blank_trim(display), blank_trim(joined))
