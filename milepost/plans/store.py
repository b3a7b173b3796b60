"""Versions of a partitioned table: data folders and the manifest that points to them.

``<path>/data/<commit>/_part=<hex of the value>/`` holds rows, with the partition column in the files;
``<path>/manifest/<number>.json`` holds the schema and, per partition value, its folder. A version is
there once its manifest is: it is written under another name and renamed, so readers see the old
table or the new one, and a run that breaks off leaves folders that no manifest names. NULL is a
partition value like any other, and a table without rows still has a schema.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class Version:
    """One version of a table; ``folders`` by the text of the partition value (None for NULL)."""

    number: int
    schema: StructType
    folders: dict[str | None, str]


def _fs(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[str]:
    target, files = _fs(spark, path)
    if not files.exists(target):
        return []
    return [status.getPath().getName() for status in files.listStatus(target)]


def latest(spark: SparkSession, path: str) -> Version | None:
    """The newest version, or None before the first."""
    numbers = [int(n.removesuffix(".json")) for n in _names(spark, f"{path}/manifest") if n.endswith(".json")]
    if not numbers:
        return None
    number = max(numbers)
    line = spark.read.text(f"{path}/manifest/{number:08d}.json", wholetext=True).first()[0]
    held = json.loads(line)
    return Version(number, StructType.fromJson(held["schema"]), {v: f for v, f in held["folders"]})


def read_folders(spark: SparkSession, schema: StructType, folders: list[str]) -> DataFrame:
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def read_version(spark: SparkSession, version: Version, values: list[str | None] | None = None) -> DataFrame:
    """The rows of a version, or of some of its partitions."""
    picked = version.folders if values is None else [v for v in version.folders if v in set(values)]
    return read_folders(spark, version.schema, sorted(version.folders[v] for v in picked))


def write_folders(
    df: DataFrame, path: str, partition: str, watch=None, order: list | None = None, sought: list[str] | None = None
) -> dict[str | None, str]:
    """Writes rows that no version names yet; gives the folder of each partition value.

    Rebalancing brings the rows of a partition together and, by their measured size, splits large
    partitions over several tasks and files and joins small ones. A ``watch`` (`operators.accounting`) counts
    the rows as they are written. ``order`` sorts the rows of each file. Row groups get Bloom filters, sized
    by their distinct values, for the columns ``sought``.
    """
    spark, root = df.sparkSession, f"{path}/data/{uuid.uuid4().hex}"
    # the text of the value is made after the shuffle, which then moves the value alone
    dealt = df.hint("rebalance", F.col(partition)).withColumn("_part", F.hex(F.col(partition).cast("string")))
    if order:
        dealt = dealt.sortWithinPartitions("_part", *order)
    options = {f"parquet.bloom.filter.enabled#{c}": "true" for c in sought or []}
    if options:
        options["parquet.bloom.filter.adaptive.enabled"] = "true"
    options["compression"] = "zstd"
    (dealt if watch is None else watch.on(dealt)).write.options(**options).partitionBy("_part").parquet(root)
    found = [n.removeprefix("_part=") for n in _names(spark, root) if n.startswith("_part=")]
    null = "__HIVE_DEFAULT_PARTITION__"
    return {None if n == null else bytes.fromhex(n).decode(): f"{root}/_part={n}" for n in found}


def commit(spark: SparkSession, path: str, before: Version | None, schema: StructType, folders: dict) -> Version:
    """Makes the next version. Fails if another writer has made it meanwhile."""
    number = before.number + 1 if before else 1
    text = json.dumps({"schema": schema.jsonValue(), "folders": list(folders.items())})
    hidden, files = _fs(spark, f"{path}/manifest/.{uuid.uuid4().hex}")
    final, _ = _fs(spark, f"{path}/manifest/{number:08d}.json")
    stream = files.create(hidden)
    stream.write(bytearray(text.encode()))
    stream.close()
    if files.exists(final) or not files.rename(hidden, final):
        raise RuntimeError(f"another writer has made version {number} of {path}")
    return Version(number, schema, folders)


def discard(spark: SparkSession, folders: dict) -> None:
    """Removes folders that were written and not committed."""
    for root in {f.rpartition("/")[0] for f in folders.values()}:
        target, files = _fs(spark, root)
        files.delete(target, True)


def vacuum(spark: SparkSession, path: str) -> int:
    """Removes data folders that the newest version doesn't name; for times without readers or writers."""
    version = latest(spark, path)
    named = {f.rpartition("/")[0].rpartition("/")[2] for f in version.folders.values()} if version else set()
    loose = [n for n in _names(spark, f"{path}/data") if n not in named]
    for name in loose:
        target, files = _fs(spark, f"{path}/data/{name}")
        files.delete(target, True)
    return len(loose)
