"""Spark side of the derived tables. ``views_sql`` holds the same definitions for DuckDB."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from milepost.functions.jsontext import to_json_text
from milepost.functions.measures import timestamp_to_epoch_ms
from milepost.operators.conform import derive_incident_times, derive_point_time, derive_trip_times
from milepost.schemas import METRICS, camel
from milepost.session import tune

E = F.expr

#: How landed JSON is written: compressed, in files small enough to be read by many tasks.
LANDED_FILES = {"compression": "gzip", "maxRecordsPerFile": "50000"}


class Bed:
    """Lazily built fixture tables over one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = tune(spark), sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def parts(self, name: str, mb: int) -> int:
        """How many parts a table is dealt to when each is to take so many MB of its files, four at least."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.sf_dir}/{name}.parquet")
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return max(4, -(-files.getContentSummary(path).getLength() // (mb << 20)))

    # --- companies, subscriptions, fleets ---------------------------------------------------------

    @cached_property
    def company(self) -> DataFrame:
        return self.table("region").select(
            E("CAST(r_regionkey AS BIGINT) AS id"), E("r_name AS company_name")
        )

    @cached_property
    def subscription(self) -> DataFrame:
        return self.table("region").filter("r_name IN ('AFRICA', 'AMERICA')").select(
            E("CAST(r_regionkey AS BIGINT) AS id"),
            E("CASE WHEN r_regionkey = 0 THEN 'Mobile App' ELSE 'Other' END AS subscription_name"),
        )

    @cached_property
    def company_subscription(self) -> DataFrame:
        nation = self.table("nation").select("n_nationkey", "n_regionkey")
        return self.table("supplier").join(nation, E("s_nationkey = n_nationkey")).select(
            E("CAST(n_regionkey AS BIGINT) AS company_id"),
            E("CASE WHEN n_regionkey IN (0, 1, 3) THEN s_suppkey % 2 ELSE 1 END AS subscription_id"),
        )

    @cached_property
    def company_account(self) -> DataFrame:
        """Companies with the account id in their JSON; some share a location, some hold junk."""
        account = E(
            "CASE WHEN c_mktsegment = 'FURNITURE' THEN '\"n/a\"'"
            " ELSE CAST(1000 + (c_custkey * 3) DIV 5 AS STRING) END"
        )
        return self.table("customer").filter("c_acctbal > 0").select(
            E("c_custkey AS id"),
            F.concat(F.lit('{"eventInfo":{"flAccountId":'), account, F.lit("}}")).alias(
                "focus_data"
            ),
        )

    @cached_property
    def fleet(self) -> DataFrame:
        """The fleets that trips refer to."""
        return self.table("nation").select(
            E("CAST(n_nationkey + 1000 AS BIGINT) AS retailer_location_id"),
            E("concat('fleet_', n_nationkey) AS internal_id"),
            E("n_name AS name"),
            E("CAST(n_regionkey AS BIGINT) AS company_id"),
            E("n_nationkey % 7 <> 6 AS active"),
        )

    @cached_property
    def site(self) -> DataFrame:
        """A larger fleet table, one fleet per part."""
        return self.table("part").select(
            E("p_partkey + 1000 AS retailer_location_id"),
            E("concat('site_', p_partkey) AS internal_id"),
            E("p_name AS name"),
            E("CAST(p_size % 5 AS BIGINT) AS company_id"),
            E("p_size > 8 AS active"),
        )

    @cached_property
    def raw_fleet(self) -> DataFrame:
        """Fleet rows as landed (text), one per part."""
        return self.table("part").select(
            E("concat(' ', p_partkey + 1000, ' ') AS retailerLocationId"),
            E("concat('site_', p_partkey) AS internalId"),
            E("p_name AS name"),
            E("p_type AS locationType"),
            E("CASE WHEN p_size % 3 = 0 THEN 'yes' WHEN p_size % 3 = 1 THEN 'false' ELSE 'maybe' END"
              " AS publicLocation"),
            E("concat('https://qr.test/', p_partkey) AS qrCodeUrl"),
            E("CAST(NULL AS STRING) AS locationToken"),
            E("CASE WHEN p_size > 8 THEN 'true' ELSE 'false' END AS active"),
            E("CASE WHEN p_size = 50 THEN 'north' ELSE CAST(p_size * 3.25 - 80 AS STRING) END"
              " AS latitude"),
            E("CAST(p_partkey % 360 - 180.5 AS STRING) AS longitude"),
            E("concat('{\"id\":', p_partkey, '}') AS manager"),
            E("concat('[\"', p_brand, '\"]') AS categories"),
            E("CAST(NULL AS STRING) AS filters"),
            E("'{}' AS billableEntity"),
            E("concat('{\"name\":\"', p_name, '\",\"n\":null}') AS retailer"),
            E("'[]' AS offers"),
            E("CASE WHEN p_size % 4 = 0 THEN '' WHEN p_size % 4 = 1 THEN p_name"
              " WHEN p_size % 4 = 2 THEN concat('{\"size\":', p_size, '}') END AS metaData"),
            E("'{\"contactInfo\":{}}' AS contact"),
            E("CASE WHEN p_size % 2 = 0 THEN 'true' ELSE 'false' END AS favorite"),
            E("CAST(p_size AS STRING) AS favoriteCount"),
            E("'n/a' AS noteCount"),
            E("concat(p_size, '.9') AS sharedCount"),
            E("CAST(NULL AS STRING) AS likeCount"),
            E("'0' AS dislikeCount"),
            E("CAST(NULL AS STRING) AS hasRatings"),
        )

    @cached_property
    def found_fleet(self) -> DataFrame:
        """Fleet-search rows whose id and name sit under varying keys."""
        part = self.table("part")
        shape = F.col("p_size") % 5
        key, name = E("p_partkey + 1000"), F.col("p_name")
        payload = (
            F.when(shape == 0, F.to_json(F.struct(
                E("concat('site_', p_partkey)").alias("internalId"), name.alias("name"),
                key.alias("retailerLocationId"))))
            .when(shape == 1, F.to_json(F.struct(
                E("'  '").alias("internal_id"), key.alias("id"), E("' '").alias("name"),
                name.alias("fleetName"))))
            .when(shape == 2, F.to_json(F.struct(
                E("concat('new_', p_partkey)").alias("fleetId"), name.alias("title"),
                E("concat('x', p_partkey)").alias("retailerLocationId"),
                key.cast("string").alias("locationId"))))
            .when(shape == 3, F.to_json(F.struct(key.cast("string").alias("fleetId"))))
            .otherwise(F.to_json(F.struct(
                E("p_partkey").alias("zone"), name.alias("display"))))
        )
        return part.select("p_partkey", payload.alias("payload"))

    # --- users and drivers ------------------------------------------------------------------------

    @cached_property
    def app_user(self) -> DataFrame:
        return self.table("customer").filter("c_acctbal > -500").select(
            E("c_custkey AS id"),
            E("concat(lower(c_name), '@x.test') AS email"),
            E("CASE WHEN c_custkey % 5 = 0 THEN '  ' WHEN c_custkey % 5 = 1 THEN NULL"
              " ELSE c_name END AS display_name"),
            E("CASE WHEN c_custkey % 10 <> 6 THEN c_mktsegment END AS first_name"),
            E("c_name AS last_name"),
            E("concat('{\"DriverId\":\"D', c_custkey, '\"}') AS focus_data"),
            E("c_acctbal > 0 AS is_active"),
            E("CASE WHEN c_custkey % 17 = 0 THEN TIMESTAMP_NTZ'2024-01-15 00:00:00' END"
              " AS deleted_at"),
        )

    @cached_property
    def driver(self) -> DataFrame:
        blob = E("concat('{\"driverId\":\"D', c_custkey, '\",\"shift\":', c_nationkey, '}')")
        quoted = F.to_json(F.struct(blob.alias("appBlob")))
        info = (
            F.when(E("c_custkey % 23 = 0"), F.lit('{"appBlob":"{bad","driverId":"top"}'))
            .when(E("c_custkey % 2 = 0"), F.concat(F.lit('{"appBlob":'), blob, F.lit("}")))
            .otherwise(quoted)
        )
        return self.table("customer").select(
            E("concat('D', c_custkey) AS driver_id"),
            E("c_custkey + 500000 AS account_id"),
            E("c_custkey AS user_id"),
            E("CAST(c_nationkey + 1000 AS BIGINT) AS retailer_location_id"),
            info.alias("app_info"),
            E("CASE WHEN c_custkey % 4 = 0 THEN concat('D', c_custkey) END AS focus_driver_id"),
            E("CASE WHEN c_custkey % 3 = 0 THEN upper(concat(c_name, '@x.test')) END"
              " AS contact_email"),
        )

    @cached_property
    def known_driver(self) -> DataFrame:
        """The drivers already stored; some segments were never loaded."""
        return self.driver.join(
            self.table("customer").filter("c_mktsegment <> 'FURNITURE'").select(
                E("concat('D', c_custkey) AS driver_id")
            ),
            "driver_id",
            "left_semi",
        )

    @cached_property
    def raw_driver(self) -> DataFrame:
        """Driver rows as landed (text). ``position`` is the source order."""
        blob = E(
            "concat('{\"driverId\":\"D', c_custkey - c_custkey % 2, '\",\"workShiftAudienceId\":',"
            " c_nationkey, ',\"additionalServices\":[\"a\",', c_nationkey, ',null]}')"
        )
        info = (
            F.when(E("c_custkey % 23 = 0"), F.lit('{"appBlob":"{bad"}'))
            .when(E("c_custkey % 3 = 0"), F.concat(F.lit('{"appBlob":'), blob, F.lit("}")))
            .otherwise(F.to_json(F.struct(blob.alias("appBlob"))))
        )
        return self.table("customer").select(
            E("c_custkey AS position"),
            E("CAST(c_custkey + 500000 AS STRING) AS accountId"),
            E("CASE WHEN c_custkey % 4 = 1 THEN concat(' ', c_name, ' ') WHEN c_custkey % 4 = 2"
              " THEN '  ' END AS display"),
            E("lower(c_name) AS username"),
            E("c_mktsegment AS accountType"),
            E("CASE WHEN c_custkey % 5 = 0 THEN concat(' ', upper(c_name), '@X.test ')"
              " WHEN c_custkey % 5 = 1 THEN '' END AS contactEmail"),
            E("concat('Hub ', c_nationkey) AS locationDisplay"),
            E("CASE WHEN c_acctbal > 0 THEN 'true' ELSE 'false' END AS active"),
            E("CAST(c_nationkey * 2.5 AS STRING) AS latitude"),
            E("CAST(-c_nationkey AS STRING) AS longitude"),
            E("'1' AS locationCount"),
            E("CAST(NULL AS STRING) AS manager"),
            E("CASE WHEN c_custkey % 7 < 3 THEN concat('{\"firstName\":\"', c_mktsegment,"
              " '\",\"lastName\":\" \",\"contactInfo\":{\"emailAddress\":\"', lower(c_name),"
              " '@x.test\"}}') WHEN c_custkey % 7 = 3 THEN concat('{\"contactInfo\":"
              "{\"emailAddress\":\"', lower(c_name), '@x.test\"}}') END AS contact"),
            E("'{\"id\":1}' AS employer"),
            info.alias("appInfo"),
            E("CASE WHEN c_custkey % 6 <> 0 THEN concat('[{\"retailerLocationId\":',"
              " c_nationkey + 1000, '},{\"retailerLocationId\":1}]') END AS locations"),
            E("CASE WHEN c_custkey % 4 = 0 THEN concat('{\"DriverId\":\"D', c_custkey, '\"}') END"
              " AS focus_data"),
        )

    # --- trips and scores -------------------------------------------------------------------------

    @cached_property
    def event(self) -> DataFrame:
        """Events with the fleet of their user and the derived trip columns."""
        customer = self.table("customer").select("c_custkey", "c_nationkey", "c_mktsegment")
        nation = self.table("nation")
        joined = (
            self.table("events")
            .join(customer, E("user_id = c_custkey"))
            .join(nation, E("c_nationkey = n_nationkey"))
        )
        end = timestamp_to_epoch_ms(F.col("ts"))
        return joined.select(
            "event_id", "ts", "user_id", "event_type", "value", "c_mktsegment",
            "c_nationkey", "n_name", "n_regionkey",
            end.alias("end_date"),
            (end - E("(5 + event_id % 55) * 60000 + event_id % 1000")).alias("start_date"),
            E("CASE WHEN event_id % 19 <> 0 THEN CAST(get_json_object(props, '$.k') AS BIGINT)"
              " * 1000 + event_id % 1000 END AS distance_meters"),
            E("CASE WHEN event_id % 11 <> 0 THEN 50 + (event_id * 37) % 51"
              " + 0.25D * (event_id % 4) END AS overall_score"),
            *self._metric_columns(),
        )

    @staticmethod
    def _metric_columns() -> list[Column]:
        out = []
        for i, m in enumerate(METRICS):
            out += [
                E(f"CASE WHEN (event_id + {i}) % 13 <> 0 THEN 40 + (event_id * ({i} + 5)) % 61"
                  f" + 0.25D * ((event_id + {i}) % 4) END AS {m}_score"),
                E(f"CASE WHEN (event_id + {i}) % 7 <> 0 THEN"
                  f" CAST((event_id * ({i} + 3)) % 5 AS DOUBLE) END AS {m}_incidents"),
                (timestamp_to_epoch_ms(F.col("ts")) - i * 60000).alias(f"last_{m}_incident"),
            ]
        return out

    @cached_property
    def trip_score(self) -> DataFrame:
        """Conformed trips."""
        geo = E(
            "CASE WHEN event_id % 31 <> 0 THEN named_struct("
            "'startLatitude', CAST(event_id % 180 - 90 AS DOUBLE),"
            "'startLongitude', CAST(event_id % 360 - 180 AS DOUBLE),"
            "'startDescription', concat('Start ', event_id),"
            "'endLatitude', CAST(event_id % 90 AS DOUBLE),"
            "'endLongitude', CAST(event_id % 45 AS DOUBLE),"
            "'endDescription', CASE WHEN event_id % 2 = 0 THEN n_name END) END AS geo"
        )
        weather = E(
            "CASE WHEN event_id % 17 <> 0 THEN named_struct("
            "'weatherCode', CAST(100 + event_id % 20 AS STRING),"
            "'weatherTempLow', CAST(event_id % 40 - 10 AS DOUBLE),"
            "'weatherTempHigh', CAST(event_id % 40 - 5 AS DOUBLE),"
            "'weatherWind', CASE WHEN event_id % 6 <> 0 THEN event_id % 90 / 4D END) END AS weather"
        )
        rows = self.event.select(
            E("concat('T', event_id) AS trip_id"),
            E("concat('D', user_id) AS driver_id"),
            E("user_id + 500000 AS account_id"),
            E("concat('fleet_', c_nationkey) AS fleet_id"),
            E("n_name AS fleet_name"),
            E("CAST(n_regionkey AS BIGINT) AS company_id"),
            E("CAST(c_nationkey + 1000 AS BIGINT) AS retailer_location_id"),
            E("concat('D', user_id) AS third_party_id"),
            E("CASE event_id % 3 WHEN 0 THEN '  ' WHEN 1 THEN concat(' Name ', user_id, ' ') END"
              " AS driver_name"),
            E("event_type AS trip_type"),
            "distance_meters", "start_date", "end_date", "overall_score",
            *[f"{m}_score" for m in METRICS],
            *[f"{m}_incidents" for m in METRICS],
            *[f"last_{m}_incident" for m in METRICS],
            geo,
            weather,
        )
        return derive_trip_times(rows)

    @cached_property
    def raw_trip(self) -> DataFrame:
        """Trip rows as landed (text): blanks, junk, broken windows, repeated trips.

        ``position`` is the source order. Purchases are landed twice, the second time with another
        score.
        """
        first = self.event.withColumn("again", F.lit(0))
        second = self.event.filter("event_type = 'purchase'").withColumn("again", F.lit(1))
        e = first.unionByName(second)
        score = E("CAST(overall_score + again AS STRING)")
        return e.select(
            E("event_id * 2 + again AS position"),
            E("CASE WHEN event_id % 97 = 5 THEN '  ' WHEN event_id % 29 = 0 THEN"
              " concat('  T', event_id, '\\t') ELSE concat('T', event_id) END AS tripId"),
            E("event_type AS tripType"),
            E("CASE WHEN event_id % 83 <> 1 THEN CAST(start_date AS STRING) END AS startDate"),
            E("CASE WHEN event_id % 89 = 7 THEN CAST(start_date - 1 AS STRING)"
              " ELSE concat(' ', end_date) END AS endDate"),
            E("CASE WHEN event_id % 53 = 3 THEN '   ' WHEN event_id % 2 = 0 THEN ''"
              " ELSE concat('D', user_id) END AS driverId"),
            E("CASE WHEN event_id % 59 <> 4 THEN concat('D', user_id) END AS thirdPartyId"),
            E("CAST(user_id + 500000 AS STRING) AS accountId"),
            E("CASE WHEN event_id % 71 = 2 THEN 'fleet_none' WHEN event_id % 73 = 8 THEN NULL"
              " ELSE concat('fleet_', c_nationkey, ' ') END AS fleetId"),
            E("n_name AS fleetName"),
            E("CASE event_id % 3 WHEN 0 THEN '  ' WHEN 1 THEN concat(' Name ', user_id, ' ') END"
              " AS driverName"),
            E("CASE WHEN event_id % 101 = 9 THEN 'n/a' WHEN event_id % 7 = 0 THEN"
              " concat(distance_meters, '.7') ELSE CAST(distance_meters AS STRING) END"
              " AS distance"),
            F.concat(F.lit(" "), score, F.lit(" ")).alias("overallScore"),
            *[E(f"CAST({m}_score AS STRING) AS {m}Score") for m in METRICS],
            *[E(f"CAST({m}_incidents AS STRING) AS {m}Incidents") for m in METRICS],
            *[E(f"CAST(last_{m}_incident AS STRING) AS last{camel(m)}Incident") for m in METRICS],
            E("CAST(NULL AS STRING) AS snapshotDate"),
            E("CASE WHEN event_id % 2 = 0 THEN 'own' END AS sourceGroupKey"),
            E("CAST(NULL AS STRING) AS sourceRowIndex"),
            E("CASE WHEN event_id % 31 <> 0 THEN CAST(event_id % 180 - 90 AS STRING) END"
              " AS startLatitude"),
            E("CASE WHEN event_id % 31 <> 0 THEN CAST(event_id % 360 - 180 AS STRING) END"
              " AS startLongitude"),
            E("CASE WHEN event_id % 31 <> 0 THEN concat('Start ', event_id) END"
              " AS startDescription"),
            E("CAST(NULL AS STRING) AS endLatitude"),
            E("CASE WHEN event_id % 31 = 0 THEN 'east' END AS endLongitude"),
            E("CASE WHEN event_id % 62 <> 0 AND event_id % 2 = 0 THEN n_name END"
              " AS endDescription"),
            E("CASE WHEN event_id % 17 <> 0 THEN CAST(100 + event_id % 20 AS STRING) END"
              " AS weatherCode"),
            E("CASE WHEN event_id % 17 <> 0 THEN CAST(event_id % 40 - 10 AS STRING) END"
              " AS weatherTempLow"),
            E("CAST(NULL AS STRING) AS weatherTempHigh"),
            E("CASE WHEN event_id % 17 <> 0 AND event_id % 6 <> 0 THEN"
              " CAST(event_id % 90 / 4D AS STRING) END AS weatherWind"),
        )

    @cached_property
    def driver_score(self) -> DataFrame:
        """Conformed daily scores: trips by fleet, driver and day."""
        trips = self.trip_score.withColumn(
            "snapshot_date", F.col("end_date_datetime").cast("date")
        )
        rows = trips.groupBy(
            "snapshot_date", "fleet_id", "driver_id", "account_id", "company_id",
            "retailer_location_id", "fleet_name",
        ).agg(
            F.sum("distance_meters").alias("distance_meters"),
            F.avg("overall_score").alias("overall_score"),
            *[F.avg(f"{m}_score").alias(f"{m}_score") for m in METRICS],
            *[F.sum(f"{m}_incidents").alias(f"{m}_incidents") for m in METRICS],
            *[F.max(f"last_{m}_incident").alias(f"last_{m}_incident") for m in METRICS],
        )
        return derive_incident_times(rows)

    @cached_property
    def raw_score(self) -> DataFrame:
        """Daily score rows as landed (text): one per event, so that days repeat."""
        return self.event.select(
            E("event_id + 1 AS position"),
            "event_id", "ts",
            E("CASE WHEN event_id % 53 = 3 THEN '   ' WHEN event_id % 2 = 0 THEN ''"
              " ELSE concat('D', user_id) END AS driverId"),
            E("CASE WHEN event_id % 59 <> 4 THEN concat('D', user_id) END AS thirdPartyId"),
            E("CAST(user_id + 500000 AS STRING) AS accountId"),
            E("CASE WHEN event_id % 71 = 2 THEN 'fleet_none' WHEN event_id % 73 = 8 THEN ' '"
              " ELSE concat('fleet_', c_nationkey, ' ') END AS fleetId"),
            E("n_name AS fleetName"),
            E("CAST(NULL AS STRING) AS driverName"),
            E("CAST(distance_meters AS STRING) AS distance"),
            E("CAST(overall_score AS STRING) AS overallScore"),
            *[E(f"CAST({m}_score AS STRING) AS {m}Score") for m in METRICS],
            *[E(f"CAST({m}_incidents AS STRING) AS {m}Incidents") for m in METRICS],
            *[E(f"CASE WHEN event_id % 5 <> 0 THEN CAST(last_{m}_incident AS STRING) END"
                f" AS last{camel(m)}Incident") for m in METRICS],
            E("CASE WHEN event_id % 9 = 0 THEN NULL WHEN event_id % 9 = 1 THEN 'yesterday'"
              " WHEN event_id % 9 = 2 THEN date_format(ts, 'yyyyMMdd')"
              " ELSE date_format(ts, 'yyyy-MM-dd') END AS snapshotDate"),
            E("CASE WHEN event_id % 3 = 0 THEN 'day' END AS sourceGroupKey"),
            E("CASE WHEN event_id % 91 = 6 THEN 'x' WHEN event_id % 3 = 1 THEN '7' END"
              " AS sourceRowIndex"),
        )

    # --- trip details -----------------------------------------------------------------------------

    @cached_property
    def trip_location(self) -> DataFrame:
        rows = self.table("lineitem").select(
            E("concat('T', l_orderkey) AS trip_id"),
            E("l_suppkey + 500000 AS account_id"),
            timestamp_to_epoch_ms(F.col("l_shipdate")).alias("timestamp_ms"),
            E("l_quantity AS latitude"),
            E("CAST(l_partkey % 180 AS DOUBLE) AS longitude"),
        )
        return derive_point_time(rows)

    @cached_property
    def trip_incident(self) -> DataFrame:
        rows = self.table("lineitem").select(
            E("concat('T', l_orderkey) AS trip_id"),
            E("l_suppkey + 500000 AS account_id"),
            timestamp_to_epoch_ms(F.col("l_shipdate")).alias("timestamp_ms"),
            E("l_quantity AS latitude"),
            E("CAST(l_partkey % 180 AS DOUBLE) AS longitude"),
            E("l_returnflag AS incident_type"),
        )
        return derive_point_time(rows)

    @cached_property
    def raw_point(self) -> DataFrame:
        """Point rows as landed (text); some lack a field."""
        ms = timestamp_to_epoch_ms(F.col("l_shipdate")).cast("string")
        return self.table("lineitem").select(
            E("CASE WHEN l_linenumber = 7 THEN ' ' ELSE concat(' T', l_orderkey) END AS tripId"),
            E("CASE WHEN l_tax = 0.08 THEN 'n/a' ELSE CAST(l_suppkey + 500000 AS STRING) END"
              " AS accountId"),
            F.when(E("l_discount <> 0.1"), ms).alias("timestamp"),
            E("concat(CAST(l_quantity AS STRING), ' ') AS latitude"),
            E("CASE WHEN l_quantity <> 50 THEN CAST(l_partkey % 180 AS STRING) ELSE '1d' END"
              " AS longitude"),
            E("CASE WHEN l_linestatus = 'O' AND l_quantity < 5 THEN '\\n' ELSE l_returnflag END"
              " AS type"),
        )

    # --- documents and pages ----------------------------------------------------------------------

    @cached_property
    def order_row(self) -> DataFrame:
        """Orders as report rows in pages of at most 50."""
        row = to_json_text(F.struct(
            E("concat('T', o_orderkey)").alias("tripId"),
            E("o_custkey").alias("accountId"),
            E("o_totalprice").alias("distance"),
        ))
        own = F.to_json(F.struct(
            E("concat('T', o_orderkey)").alias("tripId"), F.lit("own").alias("sourceGroupKey")
        ))
        return self.table("orders").select(
            E("o_orderkey"), E("o_orderkey DIV 50 AS page"),
            E("CASE WHEN o_orderpriority = '5-LOW' THEN ' ' ELSE o_orderpriority END AS grp"),
            F.when(E("o_orderstatus = 'P'"), own).otherwise(row).alias("row_json"),
        )

    @staticmethod
    def _json_list(df: DataFrame, *keys: str) -> DataFrame:
        """Rows of a page (at most 50) as one JSON list in order."""
        ordered = F.transform(
            F.array_sort(F.collect_list(F.struct("o_orderkey", "row_json"))),
            lambda x: x["row_json"],
        )
        text = F.concat(F.lit("["), F.array_join(ordered, ","), F.lit("]"))
        return df.groupBy(*keys).agg(text.alias("list_json"))

    @cached_property
    def grouped_document(self) -> DataFrame:
        """``{group: [rows]}`` documents, and plain lists for some pages."""
        grouped = self._json_list(self.order_row.filter("page % 4 <> 0"), "page", "grp")
        member = F.concat(F.lit('"'), F.col("grp"), F.lit('":'), F.col("list_json"))
        members = F.array_join(F.array_sort(F.collect_list(member)), ",")
        objects = grouped.groupBy("page").agg(
            F.concat(F.lit("{"), members, F.lit("}")).alias("payload")
        )
        lists = self._json_list(self.order_row.filter("page % 4 = 0"), "page")
        return objects.unionByName(lists.withColumnRenamed("list_json", "payload"))

    @cached_property
    def report_page(self) -> DataFrame:
        pages = self._json_list(self.order_row, "page")
        rows, page = F.col("list_json"), F.col("page")
        payload = (
            F.when(page % 10 == 9, F.lit('{"valid":false,"message":"denied","errorCode":"E7"}'))
            .when(page % 10 == 8, F.lit('{"valid":false}'))
            .when(page % 2 == 0, F.concat(F.lit('{"valid":true,"rows":'), rows,
                                          F.lit(',"hasMoreResults":true}')))
            .otherwise(F.concat(F.lit('{"items":'), rows, F.lit("}")))
        )
        return pages.select("page", payload.alias("payload"))

    @cached_property
    def search_page(self) -> DataFrame:
        pages = self._json_list(self.order_row, "page")
        rows, page = F.col("list_json"), F.col("page")
        payload = F.when(page % 7 == 6, F.lit('{"items":5}')).when(page % 7 == 5, rows)
        for i, key in enumerate(("items", "results", "data", "rows", "item")):
            payload = payload.when(
                page % 7 == i, F.concat(F.lit('{"n":1,"' + key + '":'), rows, F.lit("}"))
            )
        return pages.select("page", payload.alias("payload"))

    @cached_property
    def run_row(self) -> DataFrame:
        """Landed rows with their fleet and run folder."""
        return self.table("orders").select(
            E("o_custkey + 1000 AS fleet_id"),
            E("concat(date_format(o_orderdate, 'yyyy-MM-dd_HH-mm-ss'), '_UTC') AS run_ts"),
            E("concat('T', o_orderkey) AS trip_id"),
        )
