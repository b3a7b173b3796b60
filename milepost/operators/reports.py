"""Accounting of conversions, lookups, merges and runs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from milepost.operators.accounting import Watch
from milepost.operators.conform import DEDUPED, FILTERED, RESOLVED, SKIPPED

# Counters of one fleet's run and their names in the totals.
RUN_COUNTERS = {
    "drivers": "driver_count",
    "driver_scores": "driver_score_count",
    "trip_scores": "trip_score_count",
    "trip_locations": "trip_location_count",
    "trip_incidents": "trip_incident_count",
    "sql_inserted": "sql_inserted",
    "sql_updated": "sql_updated",
    "sql_skipped": "sql_skipped",
}


CONVERSIONS = "entity string, total long, resolved long, skipped long, filtered long, deduped long"


def conversion_line(entity: str, seen: Watch, kept: int) -> tuple:
    """One line of the summary from counts of the judged rows, of whose resolved rows ``kept`` were loaded."""
    return entity, seen["total"], kept, seen["skipped"], seen["filtered"], seen["resolved"] - kept


def union_all(parts: list[DataFrame]) -> DataFrame:
    """Rows of all batches; columns a batch lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def conversion_summary(conformed: DataFrame, entity: str) -> DataFrame:
    """Input rows by outcome; the four outcomes add up to the total."""
    def count(name: str) -> Column:
        return F.count_if(F.col("_status") == name)

    return conformed.agg(
        F.count("*").alias("total"),
        count(RESOLVED).alias("resolved"),
        count(SKIPPED).alias("skipped"),
        count(FILTERED).alias("filtered"),
        count(DEDUPED).alias("deduped"),
    ).select(F.lit(entity).alias("entity"), "total", "resolved", "skipped", "filtered", "deduped")


def conversion_counts(judged: DataFrame, entity: str, keys: list[str]) -> DataFrame:
    """The summary of judged rows of which one per key will be kept.

    One narrow pass: of resolved rows, as many are kept as there are keys, whichever rows those are. Rows are
    counted per status and key first, so a frequent key is one row of the second step.
    """
    key = [F.when(F.col("_status") == RESOLVED, F.col(k)).alias(f"_k{i}") for i, k in enumerate(keys)]
    per_key = judged.groupBy("_status", *key).agg(F.count("*").alias("_rows"))

    def rows(name: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("_status") == name, F.col("_rows"))), F.lit(0))

    kept = F.count_if(F.col("_status") == RESOLVED)
    return per_key.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("total"), kept.alias("resolved"),
        rows(SKIPPED).alias("skipped"), rows(FILTERED).alias("filtered"), (rows(RESOLVED) - kept).alias("deduped"),
    ).select(F.lit(entity).alias("entity"), "total", "resolved", "skipped", "filtered", "deduped")


def lookup_coverage(
    requested: DataFrame, resolved: DataFrame, key: str, lookup: str
) -> DataFrame:
    """Distinct keys asked for, found and not found."""
    wanted = requested.select(F.col(key).alias("_key")).filter("_key IS NOT NULL").distinct()
    found = resolved.select(F.col(key).alias("_found")).distinct()
    joined = wanted.join(found, F.col("_key") == F.col("_found"), "left")
    return joined.agg(
        F.count("*").alias("requested"), F.count("_found").alias("resolved")
    ).select(
        F.lit(lookup).alias("lookup"),
        "requested",
        "resolved",
        (F.col("requested") - F.col("resolved")).alias("unresolved"),
    )


def import_report(table_results: DataFrame, reject_counts: DataFrame) -> DataFrame:
    """One line per table, and a total line that also counts the rejected records."""
    counters = ["rows_inserted", "rows_updated", "rows_skipped", "tables", "skipped_records"]
    zero = F.lit(0).cast("bigint")
    lines = table_results.select(
        "table_name", *counters[:3], F.lit(1).cast("bigint").alias("tables"),
        zero.alias("skipped_records"),
    )
    rejects = reject_counts.select(
        F.lit("rejects").alias("table_name"),
        *[zero.alias(c) for c in counters[:4]],
        F.col("rejected").alias("skipped_records"),
    )
    total = lines.unionByName(rejects).agg(
        F.lit("total").alias("table_name"),
        *[F.coalesce(F.sum(c), zero).alias(c) for c in counters],
    )
    return lines.unionByName(total)


def run_totals(fleet_outcomes: DataFrame, discovery_errors: Column | None = None) -> DataFrame:
    """Fleets by pull status and sums of the run counters."""
    def fleets(status: str) -> Column:
        return F.count_if(F.col("pull_status") == status).alias(f"fleets_{status}")

    return fleet_outcomes.agg(
        F.count("*").alias("fleets_total"),
        *[fleets(s) for s in ("ok", "partial", "error", "skipped")],
        *[F.coalesce(F.sum(c), F.lit(0)).alias(n) for c, n in RUN_COUNTERS.items()],
    ).withColumn("discovery_errors", F.coalesce(discovery_errors or F.lit(0), F.lit(0)).cast("bigint"))


def pull_status(error_count: Column, failed: Column) -> Column:
    """Status of one pull: error when it broke off, partial when some step failed."""
    return F.when(failed, "error").when(error_count > 0, "partial").otherwise("ok")


def fleet_status(pull: Column, errors: Column, any_step_error: Column) -> Column:
    """Status of one fleet after conversion and import."""
    return (
        F.when((errors > 0) & any_step_error, F.when(pull == "error", "error").otherwise("partial"))
        .when((errors > 0) & (pull == "ok"), "partial")
        .otherwise(pull)
    )


def fleet_statuses(steps: DataFrame, pulls: DataFrame) -> DataFrame:
    """Status per fleet from its pull and its steps (``fleet_id, step, status, errors``)."""
    per_fleet = steps.groupBy("fleet_id").agg(
        F.sum("errors").alias("_step_errors"),
        F.bool_or(F.col("status") == "error").alias("_step_failed"),
    )
    joined = pulls.join(per_fleet, "fleet_id", "left")
    errors = F.col("errors") + F.coalesce("_step_errors", F.lit(0))
    return joined.select(
        "fleet_id",
        errors.alias("error_count"),
        fleet_status(
            F.col("pull_status"), errors, F.coalesce("_step_failed", F.lit(False))
        ).alias("fleet_status"),
    )


def run_status(fleet_status_rows: DataFrame) -> DataFrame:
    """Exit code and status of a whole run.

    No fleet at all is an error (2). A run in which no attempted fleet got anywhere is an error (1).
    Otherwise it succeeds, as ``partial`` if some fleet failed.
    """
    counts = fleet_status_rows.agg(
        F.count("*").alias("fleets"),
        F.count_if(F.col("fleet_status") != "skipped").alias("attempted"),
        F.count_if(F.col("fleet_status").isin("ok", "partial")).alias("loaded"),
        F.count_if(F.col("fleet_status") == "error").alias("failed"),
    )
    code = (
        F.when(F.col("fleets") == 0, 2)
        .when((F.col("attempted") > 0) & (F.col("loaded") == 0), 1)
        .otherwise(0)
    )
    return counts.withColumn("exit_code", code).withColumn(
        "run_status",
        F.when(F.col("exit_code") != 0, "error")
        .when(F.col("failed") > 0, "partial")
        .otherwise("ok"),
    )


def discovery_summary(reconciled: DataFrame) -> DataFrame:
    def count(name: str) -> Column:
        return F.count_if(F.col("outcome") == name)

    return reconciled.agg(
        F.count("*").alias("seen"),
        count("known").alias("known"),
        count("insertable").alias("inserted"),
        count("pending").alias("pending"),
    )


def company_mapping_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("fleet_id", "company_id").agg(F.count("*").alias("row_count"))


def table_profile(tables: dict[str, tuple[DataFrame, list[str]]], samples: int = 3) -> DataFrame:
    """Row count per table and its first few keys (in key order), as JSON."""
    parts = []
    for name, (df, keys) in tables.items():
        table = F.lit(name).alias("table_name")
        no_count, no_sample = F.lit(None).cast("bigint"), F.lit(None).cast("string")
        parts.append(df.agg(F.count("*").alias("row_count")).select(
            table, "row_count", no_sample.alias("sample_keys")
        ))
        head = df.select(*keys).orderBy(*keys).limit(samples)
        sample = F.to_json(F.array_sort(F.collect_list(F.struct(*keys))))
        parts.append(head.agg(sample.alias("sample_keys")).select(
            table, no_count.alias("row_count"), "sample_keys"
        ))
    return reduce(DataFrame.unionByName, parts).groupBy("table_name").agg(
        F.max("row_count").alias("row_count"), F.max("sample_keys").alias("sample_keys")
    )
