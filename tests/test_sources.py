import csv
import glob
import json
import os

from milepost.session import scratch_dir
from milepost.sources import entity, exports, pages, runs
from tests.helpers import landed, rows


def _write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.write(text)


def test_document_shapes(spark):
    folder = scratch_dir(spark, "docs")
    _write(folder, "a.json", json.dumps({"K": [{"tripId": "1"}, 5], " ": [{"tripId": 2}]}, indent=2))
    _write(folder, "b.json", json.dumps([{"tripId": "3", "sourceGroupKey": "own"}]))
    _write(folder, "c.json", "{broken")
    good, bad = entity.read_entity(spark, folder, "trip_scores", layout="files")
    assert rows(good.select("tripId", "sourceGroupKey").na.fill("-")) == [
        ("1", "K"), ("2", "GL_TRIP_DATA"), ("3", "own")]
    assert sorted(r["reason"] for r in bad.collect()) == ["not_an_object", "not_json"]


def test_nothing_of_the_wrong_shape_is_lost(spark):
    folder = scratch_dir(spark, "shapes")
    lines = ['[{"tripId":"1"}, 7, null, {"tripId":"2"}]', '{"K":[{"tripId":"3"}],"L":{"tripId":"x"},"M":null}',
             '{"tripId":"T4"}', '"text"', "{broken", "5 miles", "[]", "{}"]
    _write(folder, "a.json", "\n".join(lines))
    for name in ("trip_scores", "trip_locations", "drivers"):
        _, bad = entity.read_entity(spark, folder, name)
        assert rows(bad.select("reason", "content")) == [
            ("group_not_a_list", "T4"), ("group_not_a_list", "null"), ("group_not_a_list", '{"tripId":"x"}'),
            ("not_an_object", "7"), ("not_an_object", "null"), ("not_json", "5 miles"), ("not_json", "{broken"),
            ("wrong_shape", '"text"')]
    good, _ = entity.read_entity(spark, folder, "trip_locations")
    assert [(r.tripId, r.position) for r in good.orderBy("source_order").collect()] == [("1", 1), ("2", 4), ("3", 1)]
    fleets, bad = entity.read_entity(spark, folder, "fleet")
    assert bad.filter("reason = 'wrong_shape'").count() == 1 and fleets.count() >= 3


def test_rows_layout_quarantines_lines(spark):
    folder = scratch_dir(spark, "lines")
    _write(folder, "a.json", '{"tripId":"1"}\n{"tripId":"2"} x\n7\n')
    good, bad = entity.read_entity(spark, folder, "trip_locations", layout="rows")
    assert rows(good.select("tripId")) == [("1",)]
    assert rows(bad.select("content", "reason")) == [
        ("7", "not_an_object"), ('{"tripId":"2"} x', "not_json")]


def test_fleet_item_is_unwrapped(spark):
    folder = scratch_dir(spark, "fleet")
    fleet = {"retailerLocationId": 5, "manager": {"id": 1}}
    _write(folder, "a.json", json.dumps({"item": fleet}))
    _write(folder, "b.json", json.dumps({**fleet, "retailerLocationId": 6}))
    good, bad = entity.read_entity(spark, folder, "fleet")
    assert rows(good.select("retailerLocationId", "manager")) == [
        ("5", '{"id":1}'), ("6", '{"id":1}')]
    assert bad.count() == 0


def test_report_pages(spark):
    df = spark.createDataFrame(
        [(1, '{"valid":true,"rows":[{"a":1},{"a":2}],"hasMoreResults":true}'),
         (2, '{"items":[{"a":3}]}'), (3, '{"valid":false,"message":"no","errorCode":7}'),
         (4, '{"valid":false}'), (5, '{"rows":[]}'), (6, "<html>"), (7, None), (8, '{"rows":{"a":1}}'),
         (9, '{"rows":[{"a":9},1]}'), (10, "[]"), (11, "{}")],
        "page int, payload string",
    )
    good, bad = pages.explode_pages(df)
    assert rows(good.select("page", "row_index", "row_json", "has_more")) == [
        (1, 0, '{"a":1}', True), (1, 1, '{"a":2}', True), (2, 0, '{"a":3}', False),
        (9, 0, '{"a":9}', False)]
    assert rows(bad) == [(3, "no (errorCode=7)"),
                         (4, "Reporting API returned an invalid response"),
                         (6, "the page is no JSON object"), (7, "the page is no JSON object"),
                         (8, "rows is no list"), (9, "row 1 is no object"), (10, "the page is no JSON object")]


def test_search_pages_prefer_items(spark):
    df = spark.createDataFrame(
        [(1, '{"data":[{"a":1}],"results":[{"a":2}]}'), (2, '[{"a":3}]'), (3, '{"items":{}}'),
         (4, '{"item":[{"a":4}],"items":7}')],
        "page int, payload string",
    )
    good, bad = pages.explode_search(df)
    assert rows(good.select("page", "row_json")) == [
        (1, '{"a":2}'), (2, '{"a":3}'), (4, '{"a":4}')]
    assert [r["page"] for r in bad.collect()] == [3]


def test_latest_run(spark):
    df = spark.createDataFrame(
        [(1, "2024-01-02", "a"), (1, "2024-01-10", "b"), (1, "2024-01-10", "c"), (2, "x", "d")],
        "fleet_id int, run_ts string, v string",
    )
    assert rows(runs.latest_run(df).select("v")) == [("b",), ("c",), ("d",)]


def test_export_column_order(spark):
    cols = ["x", "accountId", "fleetId", "driverId"]
    assert exports.export_columns(cols, exports.SCORE_LEAD) == [
        "driverId", "fleetId", "accountId", "x"]


def test_csv_text_is_read_by_the_csv_module(spark):
    raw = landed(spark, "fleet", [{"retailerLocationId": " 5 ", "name": 'A "b", c',
                                   "manager": '{"id":1}', "favorite": "true"}], position=False)
    out = scratch_dir(spark, "csv")
    exports.write_csv(exports.export_fleet(raw).coalesce(1), out)
    (path,) = glob.glob(out + "/*.csv")
    with open(path, newline="", encoding="utf-8") as f:
        (row,) = csv.DictReader(f)
    assert row["retailer_location_id"] == " 5 " and row["name"] == 'A "b", c'
    assert row["manager"] == '{"id":1}' and row["offers"] == ""
    assert json.loads(row["stats"])["favorite"] is True
    assert len(row) == 19


def test_driver_export_has_twenty_columns(spark):
    raw = landed(spark, "drivers", [{"appInfo": '{"appBlob":{"driverId":"R","additionalServices":'
                                     '["x","y"]}}'}], position=False)
    out = exports.export_drivers(raw)
    assert len(out.columns) == 20
    got = out.first()
    assert got["driver_id"] == "R" and got["app_blob_additional_services"] == "x;y"


def test_report_is_one_file(spark):
    out = scratch_dir(spark, "report")
    exports.write_report(spark.createDataFrame([("t", 1, None), ("u", 2, "x")],
                                               "table_name string, n long, note string"), out)
    (path,) = glob.glob(out + "/*.json")
    with open(path, encoding="utf-8") as f:
        assert [json.loads(line) for line in f] == [
            {"table_name": "t", "n": 1, "note": None}, {"table_name": "u", "n": 2, "note": "x"}]


def test_unlisted_members_are_kept(spark):
    """In documents of all shapes: values as text, names in the rows' order, listed columns as before."""
    path = scratch_dir(spark, "more")
    documents = [
        '{"g": [{"tripId": "a", "zeta": 1, "accountId": "7"}, 5, {"alpha": {"x": [1, null]}, "tripId": "b"}]}',
        '[{"position": "p", "tripId": "c", "zeta": null, "beta": "t"}]',
    ]
    spark.createDataFrame([(d,) for d in documents], "value string").coalesce(1).write.text(path)
    rows, bad = entity.read_entity(spark, path, "trip_locations", more=True)
    got = {r["tripId"]: r for r in rows.collect()}
    assert got["a"]["more_members"] == {"zeta": "1"} and got["a"]["member_names"] == ["tripId", "zeta", "accountId"]
    assert got["b"]["more_members"] == {"alpha": '{"x":[1,null]}'}
    assert got["c"]["more_members"] == {"position": "p", "zeta": None, "beta": "t"} and got["c"]["position"] == 1
    assert [r["content"] for r in bad.collect()] == ["5"]
    out = exports.export_landed(rows, "trip_locations", exports.LOCATION_LEAD)
    assert out.columns == ["tripId", "accountId", "zeta", "alpha", "position", "beta"]
    assert {tuple(r) for r in out.collect()} == {
        ("a", "7", "1", None, None, None), ("b", None, None, '{"x":[1,null]}', None, None),
        ("c", None, None, None, "p", "t"),
    }
    plain, _ = entity.read_entity(spark, path, "trip_locations")
    assert "more_members" not in plain.columns
    assert exports.landed_columns(rows.limit(0), exports.LOCATION_LEAD) == exports.LOCATION_LEAD
