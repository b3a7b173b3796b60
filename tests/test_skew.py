"""Joins with a key that holds a third of all rows are split, whatever reduced the other side."""

import pytest
from pyspark.sql import functions as F

from milepost.operators import conform, dedup, lookups, quality
from milepost.operators.skew import one_per_key
from milepost.plans import daily
from milepost.sources.runs import latest_run

HOT = 30_000
TINY = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.shuffle.partitions": "12",
}


@pytest.fixture
def tiny(spark):
    before = {k: spark.conf.get(k) for k in TINY}
    for k, v in TINY.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    """A third of the rows has the key ``7``; the text keeps rows from being tiny."""
    path = str(tmp_path_factory.mktemp("hot") / "rows")
    key = F.when(F.col("id") % 3 == 0, F.lit("7")).otherwise((F.col("id") % 2000).cast("string"))
    spark.range(HOT, numPartitions=16).select(
        key.alias("k"), F.col("id").alias("position"), F.sha2(F.col("id").cast("string"), 256).alias("t")
    ).write.parquet(path)
    return spark.read.parquet(path)


def final_plan(df):
    """The plan as it ran, and a sum over all columns."""
    total = df.agg(F.count("*"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")))
    rows = total.collect()
    return total._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0], rows


def keys(spark, name):
    return spark.range(4000).select((F.col("id") % 2000).cast("string").alias(name), F.col("id").alias("n"))


def lookup_cases(spark, hot):
    number = F.col("n").cast("bigint")
    fleets = keys(spark, "internal_id").withColumns({"retailer_location_id": number, "company_id": number})
    focus = F.to_json(F.struct(F.struct(F.col("k").alias("flAccountId")).alias("eventInfo")))
    companies = keys(spark, "k").select(number.alias("id"), focus.alias("focus_data"))
    drivers = keys(spark, "driver_id")
    return {
        "fleet identity": lookups.resolve_fleet_identity(hot, fleets, "k"),
        "company": lookups.resolve_company(hot.withColumn("place", F.col("k").cast("long")), companies, "place"),
        "repair": lookups.repair_company_ids(hot.withColumnsRenamed({"k": "fleet_id"}).withColumn("company_id", F.lit(1)), fleets),
        "known drivers": lookups.known_driver_rows(hot, drivers, "k"),
        "purged trips": quality.purge_drivers(
            drivers.filter("driver_id <> '7'"), hot.select(F.col("k").alias("driver_id"), F.col("t").alias("trip_id")), *[hot.select(F.col("k").alias("driver_id"), F.col("t").alias("trip_id"))] * 3
        )["trip_score"],
        "latest run": latest_run(hot.withColumn("run_ts", F.lit("a")), "k"),
        "last driver": hot.join(dedup.last_by(keys(spark, "k"), ["k"], "n", as_side=True), "k"),
    }


@pytest.mark.parametrize(
    "case", ["fleet identity", "company", "repair", "known drivers", "purged trips", "latest run", "last driver"]
)
def test_lookups_split(tiny, hot, case):
    split, rows = final_plan(lookup_cases(tiny, hot)[case])
    assert "skew=true" in split and rows[0][0] > 0


def test_duplicates_split(tiny, hot):
    judged = hot.select(
        F.col("k").alias("trip_id"), F.col("position").alias("_position"), "t",
        F.lit(conform.RESOLVED).alias("_status"), F.lit(None).cast("string").alias("_reason"),
    )
    marked = conform.mark_duplicates(judged, ["trip_id"], "first")
    split, _ = final_plan(marked)
    assert "skew=true" in split
    assert marked.filter(F.col("_status") == conform.RESOLVED).count() == hot.select("k").distinct().count()


def test_groups_are_the_same(spark):
    rows = keys(spark, "k").withColumn("k", F.when(F.col("n") % 5 > 0, F.col("k")))
    want = {(r.k, r.n) for r in rows.groupBy("k").agg(F.max("n").alias("n")).collect()}
    got = one_per_key(rows, ["k"], F.max("n").alias("n"))
    assert {(r.k, r.n) for r in got.collect()} == want and got.columns == ["k", "n"]
    assert one_per_key(rows.select("k"), ["k"]).columns == ["k"]
    assert one_per_key(rows.select("k"), ["k"]).count() == len(want)


def test_plain_aggregate_is_not_split(tiny, hot):
    """What the reduced side is for: with a plain aggregate the hot key stays in one task."""
    side = keys(tiny, "k").groupBy("k").agg(F.max("n").alias("n"))
    assert "skew=true" not in final_plan(hot.join(side, "k", "left"))[0]


def hot_points(hot):
    """Landed points, each twice; a third of them belongs to one trip."""
    once = hot.select(
        F.concat(F.lit(" "), "k").alias("tripId"), F.lit("1").alias("accountId"), (F.col("position") * 1000).cast("string").alias("timestamp"),
        F.lit("2.5 ").alias("latitude"), F.lit("3").alias("longitude"),
    )
    return once.unionByName(once)


def test_points_of_trips_move_once(tiny, hot, tmp_path):
    """Points are dealt by trip for the join, and what is picked is deduplicated where it lies."""
    table, _ = daily.point_tables(str(tmp_path / "l"), str(tmp_path / "i"))
    hot.filter("position % 2000 < 40").select(F.col("k").alias("trip_id")).distinct().write.parquet(str(tmp_path / "w"))
    worklist = tiny.read.parquet(str(tmp_path / "w"))
    got = daily.points_of_trips(hot_points(hot), table, worklist)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(") == plan.count("Exchange hashpartitioning(trip_id") == 2
    split, _ = final_plan(got)
    assert "skew=true" in split
    picked = hot.join(worklist, F.col("k") == F.col("trip_id"), "left_semi").count()
    assert got.count() == got.distinct().count() == picked
