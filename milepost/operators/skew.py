"""Reduced join sides whose joins can still be split on a hot key.

Spark splits a skewed partition of a sort-merge join where both sides are plain exchanges on the join
keys. A side that has just been reduced to one row per key is partitioned by that key already: its exchange
lies below the aggregate, the join gets none of its own, and a key with a third of all rows stays in one task. Grouped by
the keys and a hash of them, the groups are the same, but the join needs an exchange of the reduced rows, and
may be split. That exchange moves one row per key; a side under the broadcast threshold is broadcast as before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def one_per_key(df: DataFrame, keys: list[str], *aggregates: Column) -> DataFrame:
    """``df.groupBy(*keys).agg(*aggregates)`` (or the distinct keys) as the reduced side of a join."""
    grouped = df.groupBy(F.xxhash64(*[F.col(k) for k in keys]).alias("_spread"), *keys)
    # an aggregate is needed for the columns; the number of rows is as good as any
    reduced = grouped.agg(*aggregates) if aggregates else grouped.agg(F.count("*").alias("_rows")).drop("_rows")
    return reduced.drop("_spread")
