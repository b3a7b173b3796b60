"""JSON held as text: rendering, parsing with a fallback, nested lookups."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from milepost.functions.coerce import strip, text_or_null

_KEEP_NULLS = {"ignoreNullFields": "false"}


def to_json_text(c: Column) -> Column:
    """Compact JSON text; null fields stay visible."""
    return F.to_json(c, _KEEP_NULLS)


def json_path(c: Column, path: str) -> Column:
    """Value at a dotted path with array indices, such as ``locations[0].id``."""
    return F.get_json_object(c, "$" + path if path.startswith("[") else "$." + path)


def is_json(c: Column) -> Column:
    """True when the whole text is one JSON value.

    Spark's parsers stop after the first value and ignore what follows (``5 miles`` reads as 5).
    Inside both wrappers no text but a single value can be read to the end: what may follow a value
    in a list may not follow it in an object. Repeated keys are legal JSON but no VARIANT, so such
    texts get a second look by the list and object readers, which take single quotes too.
    """
    listed = F.concat(F.lit("["), c, F.lit("]"))
    keyed = F.concat(F.lit('{"v":'), c, F.lit("}"))
    strict = F.try_parse_json(listed).isNotNull() & F.try_parse_json(keyed).isNotNull()
    repeated_keys = (
        ~F.contains(c, F.lit("'"))
        & (F.json_array_length(listed) == 1)
        & F.json_object_keys(keyed).isNotNull()
    )
    return F.coalesce(strict | F.coalesce(repeated_keys, F.lit(False)), F.lit(False))


def canonical_json(c: Column) -> Column:
    """The same document with sorted keys and no blanks, so that equal documents compare equal."""
    return F.when(is_json(c), F.coalesce(F.to_json(F.try_parse_json(c)), c))


def parse_metadata(c: Column) -> Column:
    """JSON text is kept; text that is not JSON is wrapped as ``{"raw": text}``."""
    return (
        F.when(c.isNull() | (c == "") | (strip(c) == "null"), F.lit(None).cast("string"))
        .when(is_json(c), c)
        .otherwise(F.to_json(F.struct(c.alias("raw"))))
    )


def app_blob(app_info: Column) -> Column:
    """The ``appBlob`` member, whether it is an object or JSON text inside a string."""
    blob = F.get_json_object(app_info, "$.appBlob")
    return F.when(is_json(blob) & F.ltrim(blob).startswith("{"), blob)


def app_blob_value(app_info: Column, name: str) -> Column:
    return F.get_json_object(app_blob(app_info), "$." + name)


def app_blob_driver_id(app_info: Column) -> Column:
    return text_or_null(app_blob_value(app_info, "driverId"))
