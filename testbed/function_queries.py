"""Column functions over whole text and number columns of the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from milepost.functions import coerce, jsontext, people, render
from milepost.functions.measures import epoch_ms_text, timestamp_to_epoch_ms
from testbed.registry import query
from testbed.views import Bed

E = F.expr

# --- wild text: numbers in many spellings, and the whole text tables -------------------------------

_WILD_SPARK = """CASE p_size % 12
  WHEN 0 THEN '' WHEN 1 THEN concat('\\u00a0\\t ', p_partkey, ' \\n')
  WHEN 2 THEN CAST(p_retailprice AS STRING) WHEN 3 THEN p_name WHEN 4 THEN 'true'
  WHEN 5 THEN 'NaN' WHEN 6 THEN concat(p_size, 'e2') WHEN 7 THEN concat(p_size, 'd')
  WHEN 8 THEN concat('-', p_retailprice) WHEN 9 THEN '0x1p3' WHEN 10 THEN ' -inf'
  ELSE concat('+', p_partkey, '.') END"""
_WILD_SQL = """(SELECT 'part' AS origin, p_partkey AS id, CASE p_size % 12
  WHEN 0 THEN '' WHEN 1 THEN p_partkey::VARCHAR WHEN 2 THEN p_retailprice::VARCHAR
  WHEN 3 THEN p_name WHEN 4 THEN 'true' WHEN 5 THEN 'NaN' WHEN 6 THEN p_size || 'e2'
  WHEN 7 THEN p_size || 'd' WHEN 8 THEN '-' || p_retailprice WHEN 9 THEN '0x1p3'
  WHEN 10 THEN '-inf' ELSE '+' || p_partkey || '.' END AS t FROM part
UNION ALL SELECT 'documents', doc_id, text FROM documents
UNION ALL SELECT 'pages', page_id, url FROM pages
UNION ALL SELECT 'conversations', conv_id * 1000 + turn, text FROM conversations)"""
_NUMBER = r"'[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?'"


def wild(b: Bed) -> DataFrame:
    parts = [
        b.table("part").select(F.lit("part").alias("origin"), E("p_partkey AS id"),
                               E(_WILD_SPARK).alias("t")),
        b.table("documents").select(F.lit("documents"), "doc_id", "text"),
        b.table("pages").select(F.lit("pages"), "page_id", "url"),
        b.table("conversations").select(F.lit("conversations"), E("conv_id * 1000 + turn"), "text"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


@query(
    "coerce_int",
    f"""SELECT origin, id, CASE WHEN t = 'true' THEN 1
  WHEN regexp_full_match(t, '[+-]?\\d+') THEN t::BIGINT
  WHEN regexp_full_match(t, {_NUMBER}) THEN trunc(t::DOUBLE)::BIGINT END AS number
FROM {_WILD_SQL}""",
)
def coerce_int(b: Bed):
    return wild(b).select("origin", "id", coerce.to_long("t").alias("number"))


@query(
    "coerce_float",
    f"""SELECT origin, id, CASE WHEN t = 'true' THEN 1.0::DOUBLE
  WHEN regexp_full_match(t, {_NUMBER}) THEN t::DOUBLE END AS number,
  CASE t WHEN 'NaN' THEN 'NaN' WHEN '-inf' THEN '-Infinity' END AS special FROM {_WILD_SQL}""",
)
def coerce_float(b: Bed):
    number = coerce.to_double("t")
    special = F.isnan(number) | number.isin(float("inf"), float("-inf"))
    return wild(b).select(
        "origin", "id",
        F.when(~special, number).alias("number"),
        F.when(special, number.cast("string")).alias("special"),
    )


@query(
    "text_or_null",
    """SELECT 'documents' AS origin, doc_id AS id, md5(text) AS digest,
  length(text)::BIGINT AS chars FROM (SELECT doc_id,
    nullif(regexp_replace(text, '^[\\s\\x0b\\p{Z}]+|[\\s\\x0b\\p{Z}]+$', '', 'g'), '') AS text
    FROM documents)
UNION ALL SELECT 'pages', page_id, md5(html), length(html) FROM (SELECT page_id,
    nullif(regexp_replace(html, '^[\\s\\x0b\\p{Z}]+|[\\s\\x0b\\p{Z}]+$', '', 'g'), '') AS html
    FROM pages)
UNION ALL SELECT 'part', p_partkey, CASE WHEN p_size % 2 = 0 THEN md5(p_name) END,
  CASE WHEN p_size % 2 = 0 THEN length(p_name) END FROM part""",
)
def text_or_null(b: Bed):
    padded = "CASE WHEN p_size % 2 = 0 THEN concat('\\u3000 ', p_name, '\\r\\n') ELSE '\\u00a0\\t' END"
    rows = (
        b.table("documents").select(F.lit("documents").alias("origin"), E("doc_id AS id"), "text")
        .union(b.table("pages").select(F.lit("pages"), "page_id", "html"))
        .union(b.table("part").select(F.lit("part"), "p_partkey", E(padded)))
    )
    t = coerce.text_or_null("text")
    return rows.select(
        "origin", "id", F.md5(t.cast("binary")).alias("digest"),
        F.char_length(t).cast("bigint").alias("chars"),
    )


@query(
    "coerce_bool",
    """SELECT 'customer' AS origin, c_custkey AS id,
  CASE c_custkey % 8 WHEN 0 THEN true WHEN 1 THEN true WHEN 2 THEN false WHEN 3 THEN false
    WHEN 4 THEN true END AS flag, c_nationkey <> 0 AS nonzero FROM customer
UNION ALL SELECT 'orders', o_orderkey, CASE WHEN o_orderstatus = 'F' THEN false END,
  o_custkey <> 0 FROM orders""",
)
def coerce_bool(b: Bed):
    words = (
        "CASE c_custkey % 8 WHEN 0 THEN 'YES' WHEN 1 THEN ' on ' WHEN 2 THEN '0' WHEN 3 THEN 'n\\n'"
        " WHEN 4 THEN 'True' WHEN 5 THEN '2' WHEN 6 THEN '' END"
    )
    rows = b.table("customer").select(
        F.lit("customer").alias("origin"), E("c_custkey AS id"), E(words).alias("t"),
        E("CAST(c_nationkey AS BIGINT) AS n"),
    ).union(b.table("orders").select(F.lit("orders"), "o_orderkey", "o_orderstatus", "o_custkey"))
    return rows.select(
        "origin", "id", coerce.to_bool("t").alias("flag"),
        coerce.number_to_bool("n").alias("nonzero"),
    )


@query(
    "coerce_date",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 8 < 5 THEN o_orderdate::DATE END AS day,
  CASE WHEN o_orderkey % 8 < 2 THEN o_orderdate::DATE END AS plain_day FROM orders""",
)
def coerce_date(b: Bed):
    text = E(
        "CASE o_orderkey % 8 WHEN 0 THEN date_format(o_orderdate, ' yyyy-MM-dd')"
        " WHEN 1 THEN date_format(o_orderdate, 'yyyyMMdd')"
        " WHEN 2 THEN date_format(o_orderdate, \"yyyy-MM-dd'T23:59:00+02:00'\")"
        " WHEN 3 THEN date_format(o_orderdate, 'yyyy-MM-dd HH:mm')"
        " WHEN 4 THEN date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss.SSS'Z'\")"
        " WHEN 5 THEN date_format(o_orderdate, 'yyyy-MM') WHEN 6 THEN '2024-02-30'"
        " ELSE o_orderpriority END"
    )
    return b.table("orders").select(
        "o_orderkey", coerce.to_date(text).alias("day"), coerce.iso_date(text).alias("plain_day")
    )


# --- JSON text ------------------------------------------------------------------------------------


@query(
    "to_json_text",
    """SELECT o_orderkey, to_json({'key': o_orderkey, 'price': o_totalprice, 'note': NULL,
  'who': {'id': o_custkey, 'tags': [o_orderstatus, o_orderpriority]}})::VARCHAR AS doc FROM orders""",
)
def to_json_text(b: Bed):
    doc = F.struct(
        F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("price"),
        F.lit(None).cast("string").alias("note"),
        F.struct(
            F.col("o_custkey").alias("id"), F.array("o_orderstatus", "o_orderpriority").alias("tags")
        ).alias("who"),
    )
    return b.table("orders").select("o_orderkey", jsontext.to_json_text(doc).alias("doc"))


@query(
    "parse_metadata",
    """SELECT 'documents' AS origin, doc_id AS id, md5(to_json({'raw': text})::VARCHAR) AS digest
FROM documents
UNION ALL SELECT 'events', event_id, md5(props) FROM events
UNION ALL SELECT 'part', p_partkey, CASE p_size % 4 WHEN 1 THEN
    md5('{"raw":"' || p_name || '"}') WHEN 2 THEN md5('{"size":' || p_size || '}') END FROM part""",
)
def parse_metadata(b: Bed):
    rows = (
        b.table("documents").select(F.lit("documents").alias("origin"), E("doc_id AS id"), "text")
        .union(b.table("events").select(F.lit("events"), "event_id", "props"))
        .union(b.raw_fleet.select(F.lit("part"), E("CAST(trim(retailerLocationId) AS BIGINT) - 1000"),
                                  "metaData"))
    )
    parsed = jsontext.parse_metadata(F.col("text"))
    return rows.select("origin", "id", F.md5(parsed.cast("binary")).alias("digest"))


@query(
    "app_blob_driver_id",
    """SELECT account_id, CASE WHEN user_id % 23 <> 0 THEN driver_id END AS driver_id FROM driver""",
    ("driver",),
)
def app_blob_driver_id(b: Bed):
    return b.driver.select(
        "account_id", jsontext.app_blob_driver_id(F.col("app_info")).alias("driver_id")
    )


@query(
    "json_path_get",
    """SELECT c_custkey AS position,
  CASE WHEN c_custkey % 6 <> 0 THEN (c_nationkey + 1000)::VARCHAR END AS first_location,
  CASE WHEN c_custkey % 6 <> 0 THEN '1' END AS second_location,
  CASE WHEN c_custkey % 7 <= 3 THEN lower(c_name) || '@x.test' END AS nested_email,
  CASE WHEN c_custkey % 23 <> 0 THEN c_nationkey::VARCHAR END AS service
FROM customer""",
)
def json_path_get(b: Bed):
    path = jsontext.json_path
    return b.raw_driver.select(
        "position",
        path(F.col("locations"), "[0].retailerLocationId").alias("first_location"),
        path(F.col("locations"), "[1].retailerLocationId").alias("second_location"),
        path(F.col("contact"), "contactInfo.emailAddress").alias("nested_email"),
        path(jsontext.app_blob(F.col("appInfo")), "additionalServices[1]").alias("service"),
    )


@query(
    "contact_email",
    "SELECT position, contact_email FROM landed_driver",
    ("landed_driver",),
)
def contact_email(b: Bed):
    return b.raw_driver.select(
        "position",
        people.contact_email(F.col("contactEmail"), F.col("contact")).alias("contact_email"),
    )


@query(
    "driver_display_name",
    """SELECT position, CASE
    WHEN c_custkey % 4 = 1 THEN c_name
    WHEN c_custkey % 7 < 3 THEN c_mktsegment
    WHEN c_custkey % 7 = 3 THEN lower(c_name) || '@x.test'
    WHEN c_custkey % 5 = 0 THEN upper(c_name) || '@X.test'
    ELSE lower(c_name) END AS driver_name FROM landed_driver""",
    ("landed_driver",),
)
def driver_display_name(b: Bed):
    name = people.report_driver_name(
        F.col("display"), F.col("contact"), F.col("contactEmail"), F.col("username")
    )
    return b.raw_driver.select("position", name.alias("driver_name"))


# --- rendering ------------------------------------------------------------------------------------


@query(
    "epoch_ms_text",
    """SELECT event_id, CASE WHEN event_id % 6 < 3 THEN
  strftime(make_timestamp(epoch_us(ts) // 1000 * 1000), '%Y-%m-%d %H:%M:%S') END AS moment
FROM events""",
)
def epoch_text(b: Bed):
    ms = timestamp_to_epoch_ms(F.col("ts"))
    spelled = (
        F.when(E("event_id % 6 = 0"), ms.cast("string"))
        .when(E("event_id % 6 = 1"), F.concat(F.lit(" "), ms, F.lit(".9")))
        .when(E("event_id % 6 = 2"), ms.cast("double").cast("string"))
        .when(E("event_id % 6 = 3"), F.lit("nan"))
        .when(E("event_id % 6 = 4"), F.col("event_type"))
        .otherwise(F.lit(""))
    )
    return b.table("events").select("event_id", epoch_ms_text(spelled).alias("moment"))


@query(
    "render_list",
    """SELECT o_orderkey, o_orderstatus || ';;' || o_orderpriority AS scalars,
  '[{"k":' || o_custkey || ',"n":null}]' AS nested, '' AS nothing,
  'a;' || (o_custkey % 25) || ';' AS from_json, '[[1],' || o_orderkey || ']' AS from_nested_json
FROM orders""",
)
def render_list(b: Bed):
    text = "string"
    scalars = F.array("o_orderstatus", F.lit(None).cast(text), "o_orderpriority")
    pair = F.struct(F.col("o_custkey").alias("k"), F.lit(None).cast(text).alias("n"))
    rows = b.table("orders").select(
        "o_orderkey", scalars.alias("scalars"), F.array(pair).alias("nested"),
        F.array().cast("array<string>").alias("nothing"),
        E("concat('[\"a\",', o_custkey % 25, ',null]')").alias("j"),
        E("concat('[[1], ', o_orderkey, ']')").alias("jj"),
    )
    types = {f.name: f.dataType for f in rows.schema.fields}
    return rows.select(
        "o_orderkey",
        *[
            render.render_list(F.col(c), types[c].elementType).alias(c)
            for c in ("scalars", "nested", "nothing")
        ],
        render.render_json_list(F.col("j")).alias("from_json"),
        render.render_json_list(F.col("jj")).alias("from_nested_json"),
    )


@query(
    "flatten_struct",
    """SELECT trip_id, CASE WHEN event_id % 31 <> 0 THEN (event_id % 180 - 90)::DOUBLE END
    AS "geo__startLatitude",
  CASE WHEN event_id % 31 <> 0 THEN (event_id % 360 - 180)::DOUBLE END AS "geo__startLongitude",
  CASE WHEN event_id % 31 <> 0 THEN 'Start ' || event_id END AS "geo__startDescription",
  CASE WHEN event_id % 31 <> 0 THEN (event_id % 90)::DOUBLE END AS "geo__endLatitude",
  CASE WHEN event_id % 31 <> 0 THEN (event_id % 45)::DOUBLE END AS "geo__endLongitude",
  CASE WHEN event_id % 31 <> 0 AND event_id % 2 = 0 THEN n_name END AS "geo__endDescription",
  trip_type || ';' || driver_id AS tags
FROM trip_score""",
    ("trip_score",),
)
def flatten_struct(b: Bed):
    rows = b.trip_score.select("trip_id", "geo", F.array("trip_type", "driver_id").alias("tags"))
    return render.flatten_struct(rows, sep="__")


@query(
    "csv_cells",
    """SELECT trip_id, coalesce(distance_meters::VARCHAR, '') AS distance_meters,
  coalesce(overall_score::VARCHAR, '') AS overall_score,
  strftime(end_date_datetime, '%Y-%m-%dT%H:%M:%S') ||
    CASE WHEN end_date % 1000 <> 0 THEN strftime(end_date_datetime, '.%f') ELSE '' END
    AS end_date_datetime,
  strftime(end_date_datetime, '%Y-%m-%d') AS day,
  CASE WHEN event_id % 17 <> 0 THEN to_json({'weatherCode': (100 + event_id % 20)::VARCHAR,
    'weatherTempLow': (event_id % 40 - 10)::DOUBLE, 'weatherTempHigh': (event_id % 40 - 5)::DOUBLE,
    'weatherWind': CASE WHEN event_id % 6 <> 0 THEN (event_id % 90) / 4.0::DOUBLE END})::VARCHAR
    ELSE '' END AS weather,
  trip_type || ';' || driver_id AS tags,
  CASE WHEN overall_score > 90 THEN 'True' WHEN overall_score <= 90 THEN 'False' ELSE '' END AS good
FROM trip_score""",
    ("trip_score",),
)
def csv_cells(b: Bed):
    rows = b.trip_score.select(
        "trip_id", "distance_meters", "overall_score", "end_date_datetime",
        F.col("end_date_datetime").cast("date").alias("day"), "weather",
        F.array("trip_type", "driver_id").alias("tags"),
        (F.col("overall_score") > 90).alias("good"),
    )
    return render.csv_cells(rows)
