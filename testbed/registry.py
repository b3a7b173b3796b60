"""Registered queries: a Spark job and, where SQL can say the same, DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from testbed.views import Bed
from testbed.views_sql import with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so that both engines compare the same type."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def query(name: str, sql: str | None = None, views: tuple[str, ...] = ()):
    """Registers ``fn(bed)`` under ``name``, with its SQL over the named views."""

    def register(fn: Callable[[Bed], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(fn(Bed(spark, sf_dir)))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_views(sql, *views)
        return fn

    return register
