"""Pages of report and search answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from milepost.functions.coerce import text_or_null
from milepost.functions.jsontext import is_json

_ENVELOPE = "valid boolean, message string, errorCode string, hasMoreResults boolean, hasMore boolean"


def _starts(c: Column, mark: str) -> Column:
    return F.coalesce(F.ltrim(c).startswith(mark), F.lit(False))


def explode_pages(pages: DataFrame, payload: str = "payload") -> tuple[DataFrame, DataFrame]:
    """(rows, errors) of report pages ``{valid, rows | items, hasMoreResults}``.

    A page gives rows or one error: an invalid page with its message and code, a page that is no JSON
    object, or whose rows are no list. A member that is no object gives an error of its own.
    """
    rest = [c for c in pages.columns if c != payload]
    p = F.col(payload)
    found = F.coalesce(F.get_json_object(p, "$.rows"), F.get_json_object(p, "$.items"))
    parsed = pages.select(
        *rest, F.from_json(p, _ENVELOPE).alias("e"), found.alias("_rows"),
        (F.coalesce(is_json(p), F.lit(False)) & _starts(p, "{")).alias("_object"),
    )
    message = F.coalesce(
        F.nullif(F.col("e.message"), F.lit("")),
        F.lit("Reporting API returned an invalid response"),
    )
    code = text_or_null("e.errorCode")
    problem = (
        F.when(~F.col("_object"), F.lit("the page is no JSON object"))
        .when(
            ~F.coalesce("e.valid", F.lit(True)),
            F.when(code.isNotNull(), F.concat(message, F.lit(" (errorCode="), code, F.lit(")"))).otherwise(message),
        )
        .when(F.col("_rows").isNotNull() & ~_starts(F.col("_rows"), "["), F.lit("rows is no list"))
    )
    judged = parsed.withColumn("error", problem)
    members = judged.filter("error IS NULL").select(
        *rest,
        F.coalesce("e.hasMoreResults", "e.hasMore", F.lit(False)).alias("has_more"),
        F.posexplode(F.from_json("_rows", "array<string>")).alias("row_index", "row_json"),
    )
    whole = _starts(F.col("row_json"), "{")
    odd = members.filter(~whole).select(
        *rest, F.concat(F.lit("row "), F.col("row_index"), F.lit(" is no object")).alias("error")
    )
    return members.filter(whole), judged.filter("error IS NOT NULL").select(*rest, "error").unionByName(odd)


def explode_search(pages: DataFrame, payload: str = "payload") -> tuple[DataFrame, DataFrame]:
    """(rows, errors) of search answers.

    An answer is a list, or an object with the list under the first of several keys. Members that are no
    objects are errors.
    """
    rest = [c for c in pages.columns if c != payload]
    p = F.col(payload)

    def list_at(path: str):
        found = F.get_json_object(p, path)
        return F.when(F.ltrim(found).startswith("["), F.from_json(found, "array<string>"))

    whole = F.when(F.ltrim(p).startswith("["), F.from_json(p, "array<string>"))
    # Keys in order of preference.
    keys = ("items", "results", "data", "rows", "item")
    found = pages.select(*rest, F.coalesce(whole, *[list_at(f"$.{k}") for k in keys]).alias("_l"))
    members = found.select(*rest, F.posexplode("_l").alias("row_index", "row_json"))
    whole = _starts(F.col("row_json"), "{")
    errors = found.filter("_l IS NULL").select(*rest, F.lit("missing fleet list").alias("error"))
    odd = members.filter(~whole).select(
        *rest, F.concat(F.lit("row "), F.col("row_index"), F.lit(" is no object")).alias("error")
    )
    return members.filter(whole), errors.unionByName(odd)
