"""Whole-dataset snapshots in numbered folders.

Overwriting a folder that the same job reads loses the data: Spark is lazy, and the
old files are gone when the plan runs. Each publish therefore writes a new version
and marks it when it is complete; the mark holds the schema. Readers take the newest
marked one. One job at a time may publish to a path.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from strata.operators.conform import Declared, resolve_schema
from strata.sources.partitions import spread_by
from strata.sources.storage import Storage

_PREFIX = "v="
_MARK = "_PUBLISHED"
_LABEL = "_LABEL"


def version_path(path: str, version: int) -> str:
    return f"{path.rstrip('/')}/{_PREFIX}{version}"


def versions(spark: SparkSession, path: str) -> list[int]:
    """Complete versions, oldest first."""
    storage = Storage(spark, path)
    found = [int(name[len(_PREFIX) :]) for name in storage.names() if name.startswith(_PREFIX)]
    return sorted(n for n in found if storage.holds_text(f"{_PREFIX}{n}", _MARK))


def labelled_version(spark: SparkSession, path: str, label: str) -> int | None:
    """The complete version that was published with this label, if it is still there."""
    storage = Storage(spark, path)
    for number in reversed(versions(spark, path)):
        folder = f"{_PREFIX}{number}"
        if storage.exists(folder, _LABEL) and storage.read_text(folder, _LABEL) == label:
            return number
    return None


def latest_version(spark: SparkSession, path: str, before: int | None = None) -> int | None:
    """The newest complete version, or the newest one below ``before``."""
    complete = [n for n in versions(spark, path) if before is None or n < before]
    return complete[-1] if complete else None


def publish_snapshot(
    df: DataFrame,
    path: str,
    version: int | None = None,
    partition_by: Sequence[str] = (),
    label: str | None = None,
    gather: bool = True,
) -> int:
    """Write ``df`` as a new version and return its number.

    With an explicit ``version`` a repeated call does nothing once that version is
    complete, so a job that is run again publishes once. A ``label`` is kept beside the
    rows; :func:`labelled_version` finds it again. Rows of a partition are gathered before
    they are written, unless there are so few partitions that every task may write all
    (``gather=False``).
    """
    spark = df.sparkSession
    storage = Storage(spark, path)
    if version is None:
        last = latest_version(spark, path)
        version = 0 if last is None else last + 1
    folder = f"{_PREFIX}{version}"
    if storage.holds_text(folder, _MARK):
        return version
    if partition_by and gather:
        df = spread_by(df, *partition_by)
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy(*partition_by).parquet(version_path(path, version))
    if label is not None:
        storage.write_text(label, folder, _LABEL)
    storage.write_text(df.schema.json(), folder, _MARK)
    return version


def read_snapshot(
    spark: SparkSession, path: str, version: int | None = None, schema: Declared | None = None
) -> DataFrame:
    """A published version, by default the newest.

    Before the first publish the result is empty if ``schema`` is given, else an error.
    """
    chosen = latest_version(spark, path) if version is None else version
    if chosen is None:
        if schema is None:
            raise FileNotFoundError(f"nothing is published at {path}")
        return spark.createDataFrame([], resolve_schema(schema))
    if schema is None:
        # As published: no file is opened to infer it, an empty snapshot has one too, and
        # partition values keep their type.
        text = Storage(spark, path).read_text(f"{_PREFIX}{chosen}", _MARK)
        schema = StructType.fromJson(json.loads(text))
    return spark.read.schema(resolve_schema(schema)).parquet(version_path(path, chosen))


def purge_versions(spark: SparkSession, path: str, keep: int = 1) -> list[int]:
    """Remove all but the newest ``keep`` complete versions; returns the removed numbers.

    Folders older than the newest version that were never completed go as well.
    """
    if keep < 1:
        raise ValueError("keep at least one version")
    complete = versions(spark, path)
    if not complete:
        return []
    kept = set(complete[-keep:])
    storage = Storage(spark, path)
    removed = []
    for name in storage.names():
        if not name.startswith(_PREFIX):
            continue
        number = int(name[len(_PREFIX) :])
        if number not in kept and number < complete[-1]:
            storage.remove(name)
            removed.append(number)
    return sorted(removed)
