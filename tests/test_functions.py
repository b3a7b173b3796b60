import json
import math
from datetime import date, datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from milepost.functions import coerce, jsontext, measures, people, render
from tests.helpers import column, texts


def test_to_long_edge_rows(spark):
    df = texts(spark, None, "", " 42 ", "3.7", "-3.7", "abc", "true", "nan", "inf", "1e3", "1d",
               "0x1p3", "1_000", " 7\t", "99999999999999999999")
    assert column(df, coerce.to_long("t")) == [
        None, None, 42, 3, -3, None, 1, None, None, 1000, None, None, 1000, 7, None,
    ]


def test_to_double_keeps_nan_and_infinity(spark):
    df = texts(spark, " 2.50", "NaN", "-Infinity", "false", "2f", "1.", ".5", "+.5e1", "--1")
    got = column(df, coerce.to_double("t"))
    assert got[0] == 2.5 and math.isnan(got[1]) and got[2] == -math.inf
    assert got[3:] == [0.0, None, 1.0, 0.5, 5.0, None]


def _python_number(text):
    text = text.strip()
    try:
        return int(text)
    except ValueError:
        try:
            return float(text)
        except ValueError:
            return None


@settings(max_examples=15, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=" \t +-.0123456789eE_dfxinat", max_size=8), min_size=30,
                max_size=30))
def test_numbers_agree_with_python(spark, values):
    got = column(texts(spark, *values), F.struct(coerce.to_double("t"), coerce.to_long("t")))
    for text, (as_double, as_long) in zip(values, got):
        number = _python_number(text)
        if number is None:
            assert as_double is None and as_long is None, text
        elif math.isnan(number):
            assert math.isnan(as_double) and as_long is None
        else:
            assert as_double == float(number), text
            if not math.isinf(number) and abs(number) < 2**63:
                assert as_long == int(number), text


def test_strip_equals_python_strip(spark):
    edges = [chr(c) for c in range(0x3001) if chr(c).isspace()] + ["​", "﻿", "\x00"]
    values = [e + "a b" + e for e in edges]
    assert column(texts(spark, *values), coerce.strip("t")) == [v.strip() for v in values]
    assert column(texts(spark, " \t", "x"), coerce.text_or_null("t")) == [None, "x"]


def test_bool_words(spark):
    df = texts(spark, "1", " True", "T", "yes", "Y", "on", "0", "false", "F", "no", "n", "OFF",
               "2", "", None)
    assert column(df, coerce.to_bool("t")) == [True] * 6 + [False] * 6 + [None] * 3


def test_dates(spark):
    df = texts(spark, "2024-02-29", " 20240229 ", "2024-02-29T23:59:59.5+02:00", "2024-02-29 10",
               "2024-02-30", "2024-2-9", "2024-02", "2024-02-29T25:00", "")
    d = date(2024, 2, 29)
    assert column(df, coerce.to_date("t")) == [d, d, d, d, None, None, None, None, None]
    assert column(df, coerce.iso_date("t")) == [d, d] + [None] * 7


def test_first_filled_takes_blanks_but_not_empty(spark):
    df = texts(spark, "", None, "  ", "a")
    assert column(df, coerce.first_filled(F.col("t"), F.lit("b"))) == ["b", "b", "  ", "a"]


def test_metadata(spark):
    df = texts(spark, None, "", '{"a": 1}', "[1]", "not json", 'say "hi"', "null", "5")
    assert column(df, jsontext.parse_metadata(F.col("t"))) == [
        None, None, '{"a": 1}', "[1]", '{"raw":"not json"}', '{"raw":"say \\"hi\\""}', None, "5",
    ]


def _is_python_json(text):
    try:
        json.loads(text, parse_constant=lambda _: 1 / 0)
        return True
    except (ValueError, ZeroDivisionError):
        return False


JSON_EDGES = [
    "5 miles", '{"a":1} x', '{"a":1}}', "1,2", "1]", "1] , [2", '1} , {"k":2', '1,"k":2', '1,"k"',
    "", " ", "[1]", ' {"a":{"b":[]}} ', "'a'", "{'a':1}", '{"a":1,"a":2}', '"x"', "true", "nul",
    "-", "1.5e3", "01", "[1,]", '{"a":}', "\n{\n}\n", "[]]", '"a" "b"',
]


def test_is_json_agrees_with_python(spark):
    got = column(texts(spark, *JSON_EDGES), jsontext.is_json(F.col("t")))
    assert dict(zip(JSON_EDGES, got)) == {t: _is_python_json(t) for t in JSON_EDGES}


@settings(max_examples=15, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet='[]{},:"1a ', max_size=9), min_size=60, max_size=60))
def test_is_json_agrees_with_python_on_random_text(spark, values):
    got = column(texts(spark, *values), jsontext.is_json(F.col("t")))
    assert got == [_is_python_json(v) for v in values]


def test_app_blob_shapes(spark):
    df = texts(
        spark, '{"appBlob":{"driverId":" d1 "}}', '{"appBlob":"{\\"driverId\\":7}"}',
        '{"appBlob":"{bad"}', "{}", "{bad", None, '{"appBlob":{"driverId":null}}',
        '{"appBlob":"[1]"}', '{"appBlob":"{\\"driverId\\":7} x"}', """{"appBlob":"{'driverId':7}"}""",
    )
    assert column(df, jsontext.app_blob_driver_id(F.col("t"))) == ["d1", "7"] + [None] * 8


def test_json_path_and_canonical(spark):
    df = texts(spark, '{"a":{"b":[{"c":1},{"c":"x"}]}}', '[{"id":3}]')
    assert column(df, jsontext.json_path(F.col("t"), "a.b[1].c")) == ["x", None]
    assert column(df, jsontext.json_path(F.col("t"), "[0].id")) == [None, "3"]
    same = texts(spark, '{"b": 1, "a": [1, 2]}', '{"a":[1,2],"b":1}')
    assert len(set(column(same, jsontext.canonical_json(F.col("t"))))) == 1


def test_json_text_keeps_nulls(spark):
    df = texts(spark, None)
    c = jsontext.to_json_text(F.struct(F.col("t"), F.lit("é").alias("u")))
    assert column(df, c) == ['{"t":null,"u":"é"}']


def test_miles_ties_and_threshold(spark):
    df = spark.createDataFrame(
        [(0, 12573), (1, 37719), (2, 80467), (3, 0), (4, 10**12)], "i int, m long"
    )
    got = [float(v) for v in column(df, measures.meters_to_miles(F.col("m")))]
    assert got == [7.813, 23.438, 50.0, 0.0, 621371192.237]


@settings(max_examples=10, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 10**12), min_size=50, max_size=50))
def test_miles_are_exact(spark, meters):
    df = spark.createDataFrame(list(enumerate(meters)), "i int, m long")
    got = column(df, measures.meters_to_miles(F.col("m")))
    want = [(m * 2_000_000 + 1_609_344) // (2 * 1_609_344) for m in meters]
    assert [int(v * 1000) for v in got] == want


def test_mean_of_decimals_is_exact(spark):
    df = spark.createDataFrame([("70.001",), ("70.002",)], "t string").select(
        F.col("t").cast("decimal(18,3)").alias("d")
    )
    assert str(df.agg(measures.mean_of_decimals(F.col("d"))).first()[0]) == "70.002"


def test_buckets(spark):
    df = spark.createDataFrame(
        [(0, 2, 80466, 95.0), (1, 2, 80467, 95.0), (2, 0, None, 95.0), (3, 1, 90000, 89.9996),
         (4, 1, 90000, 72.0), (5, 1, 90000, 71.9), (6, 0, None, None)],
        "i int, n int, m long, s double",
    )
    got = column(df, measures.day_bucket(F.col("n"), F.col("m"), F.col("s")))
    assert got == ["Low distance", "Excellent", "Excellent", "Fair", "Fair", "Risky", "Risky"]
    assert column(df, measures.trip_class(F.col("s")))[0] == "Excellent"


def test_counts_round_half_to_even(spark):
    df = spark.createDataFrame([(0, 2.5), (1, 3.5), (2, None), (3, 2.4)], "i int, c double")
    assert column(df, measures.count_to_long(F.col("c"))) == [2, 4, 0, 2]


def test_epoch_times(spark):
    df = texts(spark, "1780334653000", "-1", "1780334653000.9", "nan", "x", "", None, "1e30")
    got = column(df, measures.epoch_ms_text(F.col("t")))
    assert got == ["2026-06-01 17:24:13", "1969-12-31 23:59:59", "2026-06-01 17:24:13"] + [None] * 5
    one = spark.createDataFrame([(0, 1780334653123)], "i int, m long")
    assert column(one, measures.epoch_ms_to_timestamp(F.col("m"))) == [
        datetime(2026, 6, 1, 17, 24, 13, 123000)
    ]


def test_epoch_times_ignore_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        one = spark.createDataFrame([(0, 1780334653123)], "i int, m long")
        c = measures.epoch_ms_to_timestamp(F.col("m"))
        assert column(one, c.cast("string")) == ["2026-06-01 17:24:13.123"]
        assert column(one, measures.timestamp_to_epoch_ms(c)) == [1780334653123]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_names_and_email(spark):
    df = spark.createDataFrame(
        [
            (0, " Ann ", None, None, "u0"),
            (1, " ", '{"firstName":" Bo ","lastName":" "}', None, "u1"),
            (2, None, '{"contactInfo":{"emailAddress":" c@x "}}', "d@x", "u2"),
            (3, None, "{}", " d@x ", "u3"),
            (4, None, None, "", " u4 "),
            (5, None, None, None, None),
        ],
        "i int, display string, contact string, email string, username string",
    )
    c = people.report_driver_name(
        F.col("display"), F.col("contact"), F.col("email"), F.col("username")
    )
    assert column(df, c) == ["Ann", "Bo", "c@x", "d@x", "u4", None]
    e = people.contact_email(F.col("email"), F.col("contact"))
    assert column(df, e) == [None, None, "d@x", "d@x", None, None]


def test_blank_display_name_falls_through(spark):
    df = spark.createDataFrame(
        [(0, " T ", "d", "f", "l"), (1, " ", "  ", "f", "l"), (2, None, None, "f", None),
         (3, None, None, None, None), (4, None, "\t", "f", "l")],
        "i int, stored string, display string, first string, last string",
    )
    c = people.trip_driver_name(*[F.col(n) for n in ("stored", "display", "first", "last")])
    assert column(df, c) == ["T", "f l", "f", None, "\t"]


def test_location_id(spark):
    df = texts(spark, '[{"retailerLocationId":" 12 "}]', '[{"retailerLocationId":"x"}]', "[]", None)
    assert column(df, people.location_id(F.col("t"), F.lit(9).cast("long"))) == [12, 9, 9, 9]


def test_lists_and_cells(spark):
    df = spark.createDataFrame(
        [(0, ["a", None, "b"], [(1, None)], True, datetime(2024, 1, 2, 3, 4, 5), None)],
        "i int, s array<string>, n array<struct<k:int,v:string>>, b boolean, t timestamp_ntz,"
        " x string",
    )
    got = render.csv_cells(df).first()
    assert got["s"] == "a;;b" and json.loads(got["n"]) == [{"k": 1, "v": None}]
    assert got["b"] == "True" and got["t"] == "2024-01-02T03:04:05" and got["x"] == ""
    parts = texts(spark, '["a",1,null]', '[{"k":1}]', "plain", None)
    assert column(parts, render.render_json_list(F.col("t"))) == ["a;1;", '[{"k":1}]', "plain", ""]


def test_flatten_struct(spark):
    df = spark.createDataFrame([((1, (2, ["x", "y"])),)], "a struct<b:int,c:struct<d:int,e:array<string>>>")
    flat = render.flatten_struct(df)
    assert flat.columns == ["a.b", "a.c.d", "a.c.e"]
    assert tuple(flat.first()) == (1, 2, "x;y")


def test_plain_text_and_numbers_take_the_short_way(spark):
    """A named column gives what the full rules give, whatever stands at the ends of the text."""
    ends = ["", " ", "\t", "\n", "\u2028", "\xa0", "\x1c", "\x00", "é"]
    df = texts(spark, None, *[a + v + b for v in ("", "T1", "a b", "7", "-2.50", "1d", "1e3") for a in ends for b in ends])
    assert column(df, coerce.strip("t")) == column(df, F.btrim("t", F.lit(coerce.WHITESPACE)))
    plans = [df.select(f("t"))._jdf.queryExecution().optimizedPlan().toString() for f in (coerce.strip, coerce.number_text)]
    assert all(p.upper().index("RLIKE") < p.index("Some(") for p in plans)
    spelled = F.regexp_extract(F.btrim("t", F.lit(coerce.WHITESPACE)), coerce._NUMBER, 0)
    full = F.when(F.col("t").rlike(coerce._PLAIN_NUMBER), F.col("t")).otherwise(spelled)
    assert column(df, coerce.number_text("t")) == column(df, full)
    assert column(df, coerce.number_to_double(coerce.number_text("t"))) == column(
        df, F.coalesce(full.try_cast("double"), F.when(full == "true", 1.0).when(full == "false", 0.0))
    )
