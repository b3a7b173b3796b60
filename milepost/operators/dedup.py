"""Deduplication with a defined survivor."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_by(df: DataFrame, keys: list[str], order: list[Column], as_side: bool = False) -> DataFrame:
    """One row per key: the first in ``order``.

    The ``row_number() = 1`` filter becomes a group limit that also runs before the shuffle, so a
    key that holds a large share of the rows sends one row per input partition. With ``as_side`` the
    result is the reduced side of a join on the keys (`skew`).
    """
    spread = [F.xxhash64(*[F.col(k) for k in keys])] if as_side else []
    rank = F.row_number().over(Window.partitionBy(*spread, *keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def last_by(df: DataFrame, keys: list[str], position: str, as_side: bool = False) -> DataFrame:
    return first_by(df, keys, [F.col(position).desc()], as_side)


def distinct_points(df: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct point rows. Only key columns are kept, so every survivor is the same row."""
    return df.select(*keys).distinct()


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).filter("row_count > 1")
