"""Counts gathered in the pass that writes the rows.

A watched DataFrame carries aggregates that Spark evaluates while its rows go by (``Observation``), so
accounting needs no scan of its own. Watch what is written, above its last shuffle: the tasks that write count
once each, however often lost ones are repeated, whereas a stage below a shuffle may run again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from milepost.operators.merge import INSERT, UNCHANGED, UPDATE


class Watch:
    """Named counts of one DataFrame, known when it has been written."""

    def __init__(self, **counts: Column):
        self._seen = Observation()
        self._counts = counts

    def on(self, df: DataFrame) -> DataFrame:
        return df.observe(self._seen, *[c.alias(n) for n, c in self._counts.items()])

    def __getitem__(self, name: str) -> int:
        return int(self._seen.get[name])


def row_watch() -> Watch:
    return Watch(rows=F.count("*"))


def outcome_watch() -> Watch:
    """Rows by the status of conformed rows."""
    names = ("resolved", "skipped", "filtered", "deduped")
    return Watch(total=F.count("*"), **{n: F.count_if(F.col("_status") == n) for n in names})


def action_watch() -> Watch:
    """Rows by the action of a merge."""
    actions = {"rows_inserted": INSERT, "rows_updated": UPDATE, "rows_skipped": UNCHANGED}
    return Watch(**{n: F.count_if(F.col("_action") == a) for n, a in actions.items()})
