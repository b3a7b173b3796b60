"""Run folders: which run of a fleet is the latest.

:func:`latest_run` works on rows that are read anyway. :func:`read_latest_run` finds the latest runs in the
folders' names, ``<root>/fleet_id=<id>/run_ts=<run>``, before anything is read: older runs are not listed file by
file, and not scanned.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from milepost.operators.skew import one_per_key


def latest_run(rows: DataFrame, location: str = "fleet_id", run: str = "run_ts") -> DataFrame:
    """Rows of the lexicographically greatest run per location.

    The maximum is a partial aggregate (over partition folders: metadata-sized), joined back.
    """
    latest = one_per_key(rows, [location], F.max(run).alias(run))
    return rows.join(latest, [location, run], "left_semi")


def latest_folders(spark: SparkSession, root: str, location: str = "fleet_id", run: str = "run_ts") -> list[str]:
    """The folder of the lexicographically greatest run of each location; one listing for all folders' names.

    Runs without files (a write that broke off, marker files aside) are passed over.
    """
    top = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = top.getFileSystem(spark._jsc.hadoopConfiguration())
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{location}=*/{run}=*")
    found: dict[str, list[tuple[str, str]]] = {}
    for status in files.globStatus(pattern) or []:
        path = status.getPath()
        name = unquote(path.getName().partition("=")[2])
        found.setdefault(path.getParent().getName(), []).append((name, path))

    def filled(path) -> bool:
        return any(
            s.getLen() > 0 and not s.getPath().getName().startswith(("_", ".")) for s in files.listStatus(path)
        )

    out = []
    for _, runs in sorted(found.items()):
        latest = next((path for _, path in sorted(runs, key=lambda r: r[0], reverse=True) if filled(path)), None)
        if latest is not None:
            out.append(latest.toString())
    return out


def read_latest_run(
    spark: SparkSession, root: str, schema, source: str = "json", location: str = "fleet_id", run: str = "run_ts"
) -> DataFrame:
    """Rows of each location's latest run, with ``location`` and ``run`` as columns; only those folders are scanned."""
    folders = latest_folders(spark, root, location, run)
    whole = spark.read.schema(schema)
    if not folders:
        empty = spark.createDataFrame([], schema)
        return empty.withColumns({c: F.lit(None).cast("string") for c in (location, run) if c not in empty.columns})
    return whole.format(source).option("basePath", root).load(folders)
