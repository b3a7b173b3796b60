"""Rollups from change rows against full rebuilds."""

from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from milepost.operators import conform, rollups
from milepost.plans import daily, maintenance, store, tables
from milepost.schemas import ROLLUP_KEYS
from milepost.session import scratch_dir

STAMP = datetime(2024, 2, 1)


@pytest.fixture(scope="module")
def sides(bed):
    return maintenance.Sides(bed.subscription, bed.company_subscription, bed.company, bed.driver, bed.app_user)


def digest(df):
    """Number of rows, and a sum over their hashes."""
    return tuple(df.agg(F.count("*"), F.sum(F.xxhash64(*sorted(df.columns)).cast("decimal(38,0)"))).first())


class House:
    """Stored trips with maintained rollups next to them."""

    def __init__(self, spark):
        self.spark = spark
        self.trips = daily.trip_table(scratch_dir(spark, "trips"))
        self.out = scratch_dir(spark, "kept-rollups")

    def load(self, batch, sides, **options):
        done = tables.merge(self.spark, self.trips, daily.with_end_day(batch), STAMP)
        return maintenance.refresh(self.spark, self.trips.path, sides, self.out, done, **options)

    def rollup(self, name):
        return tables.read_table(self.spark, f"{self.out}/{name}")

    def check(self, sides):
        """All five rollups equal those built from all trips."""
        fresh = scratch_dir(self.spark, "fresh")
        tables.refresh_rollups(
            conform.derive_trip_times(tables.read_table(self.spark, self.trips.path)), sides.subscriptions,
            sides.company_subscriptions, sides.companies, sides.drivers, sides.users, fresh,
        )
        for name in ROLLUP_KEYS:
            got, want = self.rollup(name), tables.read_table(self.spark, f"{fresh}/{name}")
            found, rebuilt = digest(got), digest(want)
            if found != rebuilt:
                got.exceptAll(want.select(*got.columns)).show(5, False)
            assert found == rebuilt and found[0] > 0, name

    def folders(self, name):
        return store.latest(self.spark, f"{self.out}/{name}").folders


@pytest.fixture(scope="module")
def base(bed):
    """Stored columns of the trips: derived times are left out."""
    keep = [c for c in bed.trip_score.columns if not c.endswith("_datetime") and c not in ("duration_seconds", "end_day")]
    return bed.trip_score.select(*keep)


def test_changes_equal_a_rebuild(spark, bed, base, sides):
    house = House(spark)
    first = house.load(base.filter("pmod(xxhash64(trip_id), 3) < 2"), sides)
    assert first.rollup_days is None
    house.check(sides)
    # inserts alone
    days = base.select(F.expr("date(timestamp_millis(end_date))").cast("string").alias("d")).distinct().collect()
    some = sorted(r.d for r in days if r.d)[3:5]
    late = base.filter("pmod(xxhash64(trip_id), 3) = 2").filter(F.expr("date(timestamp_millis(end_date))").cast("string").isin(some))
    before = {n: house.folders(n) for n in (*ROLLUP_KEYS, maintenance.STATE)}
    second = house.load(late, sides)
    assert second.rollup_days == second.list_days == some
    for name, old in before.items():
        new = house.folders(name)
        assert {d for d in old if old[d] != new.get(d)} <= set(some), name
    house.check(sides)
    # corrections: to another day, another driver, another score; some unchanged rows
    moved = base.filter("pmod(xxhash64(trip_id), 7) = 1").limit(40)
    other_day = moved.withColumn("end_date", F.col("end_date") + 86_400_000)
    other_driver = base.filter("pmod(xxhash64(trip_id), 7) = 2").limit(30).withColumn(
        "driver_id", F.lit(bed.driver.agg(F.min("driver_id")).first()[0])
    )
    scores = base.filter("pmod(xxhash64(trip_id), 7) = 3").limit(30).withColumn("overall_score", F.lit(1.25)).withColumn(
        "distance_meters", F.lit(None).cast("long")
    )
    same = base.filter("pmod(xxhash64(trip_id), 7) = 4").limit(30)
    third = house.load(other_day.unionByName(other_driver).unionByName(scores).unionByName(same), sides)
    assert third.rollup_days
    house.check(sides)
    # nothing but known rows
    fourth = house.load(same, sides)
    assert fourth.rollup_days == fourth.list_days == [] and not fourth.stored


def test_changed_sides(spark, bed, base, sides):
    house = House(spark)
    house.load(base, sides)
    user = bed.app_user.join(bed.driver, F.col("id") == F.col("user_id"), "left_semi").agg(F.min("id")).first()[0]
    hit = F.col("id") == user
    mail = replace(sides, users=bed.app_user.withColumn("email", F.when(hit, F.lit("new@x")).otherwise(F.col("email"))))
    done = maintenance.refresh(spark, house.trips.path, mail, house.out)
    assert done.rollup_days is not None and done.list_days == []
    house.check(mail)
    name = replace(mail, users=mail.users.withColumn("first_name", F.when(hit, F.lit("Renamed")).otherwise(F.col("first_name"))).withColumn("display_name", F.when(hit, F.lit(None)).otherwise(F.col("display_name"))))
    done = maintenance.refresh(spark, house.trips.path, name, house.out)
    assert done.rollup_days == []
    house.check(name)
    eligible = rollups.eligible_companies(bed.subscription, bed.company_subscription)
    gone = bed.trip_score.join(eligible, "company_id", "left_semi").agg(F.min("company_id")).first()[0]
    fewer = replace(
        name, company_subscriptions=bed.company_subscription.filter(F.col("company_id") != gone),
        drivers=bed.driver.filter("pmod(xxhash64(driver_id), 5) <> 0"),
        companies=bed.company.withColumn("company_name", F.concat("company_name", F.lit("!"))),
    )
    done = maintenance.refresh(spark, house.trips.path, fewer, house.out)
    assert done.rollup_days and done.list_days
    house.check(fewer)
    assert maintenance.refresh(spark, house.trips.path, fewer, house.out).rollup_days == []


def test_missed_versions_rebuild(spark, base, sides):
    """Another writer's merge, or a run that broke off before the marks, is noticed."""
    house = House(spark)
    house.load(base.filter("pmod(xxhash64(trip_id), 2) = 0"), sides)
    tables.merge(spark, house.trips, daily.with_end_day(base.filter("pmod(xxhash64(trip_id), 4) = 1")), STAMP)
    done = house.load(base.filter("pmod(xxhash64(trip_id), 4) = 3").limit(5), sides)
    assert done.rollup_days is None
    house.check(sides)


def test_states_merge_in_any_split(bed):
    """States of parts merge to the state of the whole."""
    trips = bed.trip_score
    whole = rollups.day_states(trips)
    parts = rollups.day_states(trips.filter("pmod(xxhash64(trip_id), 2) = 0")).unionByName(
        rollups.day_states(trips.filter("pmod(xxhash64(trip_id), 2) = 1"))
    )
    merged = rollups.merge_states(parts).select(*whole.columns)
    assert merged.count() == whole.count() and merged.exceptAll(whole).count() == 0
