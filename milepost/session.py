"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


# Runtime options that the jobs are written for.
RUNTIME = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join partition even where that costs one more exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # the JVM never compiles methods over 8000 bytes, which wide projections easily exceed; such
    # stages run better as many small generated methods
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # a version of a stored table has a folder per partition value; Spark would list each in a task of its own, which
    # costs far more than the listing
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
}

#: Bytes that a file counts on top of its own when the files of a stored table are dealt to tasks (Spark's default: 4 MB).
SMALL_FILE_COST = 256 << 10


#: Root of the scratch folders of the run that is going on.
RUN_ROOT = "milepost.scratch.root"


def spark_session(app_name: str = "milepost", master: str | None = None, **conf) -> SparkSession:
    """Session with UTC time, adaptive execution and skew splitting.

    Broadcast hints are used only for sides whose rows have been counted up to a limit (the eligible
    companies of the rollups) or are bounded by a parameter. Elsewhere Spark broadcasts a side when
    its measured size is under the threshold, and otherwise uses a sort-merge join whose skewed
    partitions are split.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **RUNTIME,
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Applies the runtime options to a session made elsewhere."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, the folder every executor can reach.

    Only a plain local run may leave the setting out; a temporary folder takes its place there. On a
    cluster each executor would write to a disk of its own, so the job is refused.
    """
    root = spark.conf.get(RUN_ROOT, "") or spark.conf.get("spark.checkpoint.dir", "") or ""
    if not root:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="milepost-")
        spark.conf.set("spark.checkpoint.dir", root)
    return os.path.join(root, f"{label}-{uuid.uuid4().hex}")


@contextmanager
def run_scratch(spark: SparkSession, label: str) -> Iterator[dict]:
    """Gathers the scratch folders of one run below one root, which is removed when the run succeeds.

    Set ``keep`` in the dictionary it gives to leave the root in place; an exception does so too. What
    the run returns must not read from it.
    """
    root, outer = scratch_dir(spark, label), spark.conf.get(RUN_ROOT, "")
    spark.conf.set(RUN_ROOT, root)
    options = {"keep": False}
    try:
        yield options
    except BaseException:
        options["keep"] = True
        raise
    finally:
        if outer:
            spark.conf.set(RUN_ROOT, outer)
        else:
            spark.conf.unset(RUN_ROOT)
        if not options["keep"]:
            folder = spark._jvm.org.apache.hadoop.fs.Path(root)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def small_files(spark: SparkSession) -> Iterator[None]:
    """Scans that run in here put many small files into one task: the tasks follow the bytes, not the files.

    For wide aggregates of a stored table, of which each task first sets up its many columns.
    """
    name = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, SMALL_FILE_COST)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def cut_lineage(df: DataFrame, label: str, compression: str = "snappy", watch=None) -> DataFrame:
    """Write ``df`` to the shared folder once and read it back.

    Used where one intermediate result feeds several outputs. Unlike a cache it survives the loss
    of executors. A ``watch`` (`operators.accounting`) counts the rows as they are written.
    """
    path = scratch_dir(df.sparkSession, label)
    (df if watch is None else watch.on(df)).write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
