"""Entity JSON documents: an object, a list, or an object of lists per group.

Layouts: ``lines`` (one document per line, files can be split; the default), ``rows`` (one row per
line) and ``files`` (one document per file: a file is one row of one task, so this is for files that a
task can hold). Whatever is no row ends in the quarantine with a reason: ``not_json``, ``wrong_shape``
(a document that is neither object nor list), ``group_not_a_list`` and ``not_an_object``.

Rows carry ``position``, their number in their document from 1, and ``source_order``, which orders all
rows of a folder by file, place in the file and position.

Members that the entity's schema doesn't list are kept on request (``more=True``): ``more_members`` maps each to its
value as text (nested values as JSON), and ``member_names`` holds all names of a row in the row's order. Batches with
differing members thus have one schema, and `exports.landed_columns` finds the columns they have together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from milepost.functions.coerce import text_or_null
from milepost.functions.jsontext import is_json
from milepost.operators.conform import SCORE_GROUP, TRIP_GROUP
from milepost.operators.reports import union_all
from milepost.schemas import LANDED

# Default group key per grouped entity.
DEFAULT_GROUPS = {"driver_scores": SCORE_GROUP, "trip_scores": TRIP_GROUP}


def _is_object(c: Column) -> Column:
    return F.ltrim(c).startswith("{")


def _is_list(c: Column) -> Column:
    return F.ltrim(c).startswith("[")


def _groups(p: Column, default_group: str | None) -> Column:
    """``(key, rows)`` of each group of a document; a plain list is one group without a key."""
    return F.when(
        _is_list(p), F.array(F.struct(F.lit(None).cast("string").alias("key"), p.alias("rows")))
    ).otherwise(
        F.transform(
            F.map_entries(F.from_json(p, "map<string,string>")),
            lambda e: F.struct(
                F.coalesce(text_or_null(e["key"]), F.lit(default_group)).alias("key"), e["value"].alias("rows")
            ),
        )
    )


_NO_ROWS = "array<struct<key:string,group:int,row:int,json:string>>"


def flatten_grouped(
    documents: DataFrame, default_group: str | None, payload: str = "payload"
) -> DataFrame:
    """Rows of ``{group: [rows]}`` documents, or of plain lists, as JSON text.

    Adds ``group_key`` (the default when blank, NULL for plain lists), ``group_index``,
    ``row_index`` (in the group), ``position`` (in the document, from 1) and ``row_json``; keeps the
    other columns. Groups that are no lists have no rows; :func:`odd_groups` has them.
    """
    rest = [c for c in documents.columns if c != payload]
    per_group = F.transform(
        _groups(F.col(payload), default_group),
        lambda g, i: F.coalesce(
            F.transform(
                F.when(_is_list(g["rows"]), F.from_json(g["rows"], "array<string>")),
                lambda r, j: F.struct(g["key"].alias("key"), i.alias("group"), j.alias("row"), r.alias("json")),
            ),
            F.array().cast(_NO_ROWS),
        ),
    )
    rows = documents.select(*rest, F.posexplode(F.flatten(per_group)).alias("_at", "_r"))
    return rows.select(
        *rest, F.col("_r.key").alias("group_key"), F.col("_r.group").alias("group_index"),
        F.col("_r.row").alias("row_index"), (F.col("_at") + 1).cast("long").alias("position"),
        F.col("_r.json").alias("row_json"),
    )


def odd_groups(documents: DataFrame, payload: str = "payload") -> DataFrame:
    """Group values of object documents that are no lists, as ``content``; keeps the other columns."""
    rest = [c for c in documents.columns if c != payload]
    odd = F.filter(_groups(F.col(payload), None), lambda g: ~F.coalesce(_is_list(g["rows"]), F.lit(False)))
    return documents.select(*rest, F.explode(odd).alias("_g")).select(
        *rest, F.coalesce("_g.rows", F.lit("null")).alias("content")
    )


#: Columns that ``more=True`` adds.
MORE = ["more_members", "member_names"]


def _more_members(row_json: str, names: list[str]) -> list[Column]:
    """Unlisted members of a row, and all its members' names in its order; NULL for rows that are no objects."""
    listed = F.array(*map(F.lit, names))
    unlisted = F.map_filter(F.from_json(row_json, "map<string,string>"), lambda k, v: ~F.array_contains(listed, k))
    return [unlisted.alias(MORE[0]), F.json_object_keys(row_json).alias(MORE[1])]


def parse_rows(rows: DataFrame, entity: str, row_json: str = "row_json", more: bool = False) -> DataFrame:
    """Row JSON -> text columns of the entity; rows that are no objects are marked ``_corrupt``."""
    parsed = F.from_json(row_json, LANDED[entity])
    keep = [c for c in rows.columns if c != row_json]
    names = LANDED[entity].fieldNames()
    return rows.withColumn("_row", parsed).select(
        *keep,
        *[F.col(f"_row.{n}").alias(n) for n in names],
        *(_more_members(row_json, names) if more else []),
        F.when(
            ~F.coalesce(_is_object(F.col(row_json)), F.lit(False)), F.coalesce(row_json, F.lit("null"))
        ).alias("_corrupt"),
    )


def rows_of_documents(
    documents: DataFrame, entity: str, payload: str = "payload", more: bool = False
) -> DataFrame:
    """Typed-text rows of one entity, in any of its document shapes."""
    p = F.col(payload)
    if entity == "fleet":
        rest = [c for c in documents.columns if c != payload]
        item = F.get_json_object(p, "$.item")
        one = F.array(F.when(_is_object(item), item).otherwise(p))
        found = F.when(_is_list(p), F.from_json(p, "array<string>")).otherwise(one)
        rows = documents.select(*rest, F.posexplode(found).alias("row_index", "row_json"))
        return parse_rows(rows.withColumn("position", (F.col("row_index") + 1).cast("long")), entity, more=more)
    parsed = parse_rows(flatten_grouped(documents, DEFAULT_GROUPS.get(entity), payload), entity, more=more)
    if entity not in DEFAULT_GROUPS:
        return parsed
    return parsed.withColumn("sourceGroupKey", F.coalesce("sourceGroupKey", "group_key"))


def read_documents(spark: SparkSession, path: str, layout: str = "lines") -> DataFrame:
    """Landed files as ``source_file, source_order, payload``, with partition folders as columns."""
    raw = spark.read.text(path, wholetext=layout == "files")
    # ids grow within a task, and a task reads a split from its start
    place = F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )
    return raw.select(
        F.col("_metadata.file_path").alias("source_file"),
        place.alias("source_order"),
        F.col("value").alias("payload"),
        *[c for c in raw.columns if c != "value"],
    )


def read_entity(
    spark: SparkSession, path: str, entity: str, layout: str = "lines", more: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(rows, quarantine) of one entity; every document and row is in one of them, and with ``more`` every
    member of a row."""
    documents = read_documents(spark, path, layout)
    p = F.col("payload")
    shaped = _is_object(p) | _is_list(p)

    def out(df: DataFrame, content: Column, reason: str) -> DataFrame:
        return df.select("source_file", content.alias("content"), F.lit(reason).alias("reason"))

    usable = documents.filter(is_json(p))
    bad = [out(documents.filter(~is_json(p)), p, "not_json")]
    if layout == "rows":
        rest = [c for c in documents.columns if c != "payload"]
        lines = usable.select(
            *rest, F.lit(0).alias("row_index"), F.lit(1).cast("long").alias("position"), p.alias("row_json")
        )
        rows = parse_rows(lines, entity, more=more)
    else:
        bad.append(out(usable.filter(~shaped), p, "wrong_shape"))
        usable = usable.filter(shaped)
        rows = rows_of_documents(usable, entity, more=more)
        if entity != "fleet":
            bad.append(out(odd_groups(usable), F.col("content"), "group_not_a_list"))
    bad.append(out(rows.filter("_corrupt IS NOT NULL"), F.col("_corrupt"), "not_an_object"))
    order = F.struct("source_order.*", "position")
    good = rows.filter("_corrupt IS NULL").drop("_corrupt").withColumn("source_order", order)
    return good, union_all(bad)
