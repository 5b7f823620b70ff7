"""What has been read, file by file: for batch runs over folders whose writers are slow.

A file's time says when it was written, not when it became visible, so a job that goes by times
loses what is committed late. A manifest keeps the path, length and time of every file a job has
read. A run takes the files that are not in it, whatever their times, and writes them
down when it has succeeded. Files that were read and have changed since are reported, not read
twice in silence.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.conform import Declared, resolve_schema
from strata.session import cut_lineage
from strata.sources.storage import Storage

FILES = "path string, length long, modified timestamp"
_MANIFEST = f"job string, run_id string, taken_at timestamp, {FILES}"


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, modified) of all files below ``path``, listed by Spark; none is opened."""
    if not Storage(spark, path).names():
        return spark.createDataFrame([], FILES)
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return listed.select("path", "length", F.col("modificationTime").alias("modified"))


@dataclass(frozen=True)
class FileRun:
    """Files of a run: ``new`` ones, and those that have ``rewritten`` content since they were read."""

    run_id: str
    new: DataFrame
    rewritten: DataFrame

    def read(self, spark: SparkSession, schema: Declared, fmt: str = "parquet", again: bool = False) -> DataFrame:
        """The rows of the new files; of the rewritten ones too if they are to be read ``again``.

        The paths of these files reach the driver, as for any reader.
        """
        chosen = self.new.unionByName(self.rewritten) if again else self.new
        paths = [row["path"] for row in chosen.select("path").collect()]
        declared = resolve_schema(schema)
        return spark.read.schema(declared).format(fmt).load(paths) if paths else spark.createDataFrame([], declared)


class FileManifest:
    """Files that jobs have read, one small folder for each run below ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def seen(self, job: str) -> DataFrame:
        """Each file that ``job`` has read, as it was when it was read last."""
        if not Storage(self.spark, self.path).names():
            return self.spark.createDataFrame([], FILES)
        rows = self.spark.read.schema(_MANIFEST).parquet(self.path).where(F.col("job") == job)
        return rows.groupBy("path").agg(F.max_by(F.struct("length", "modified"), F.col("taken_at")).alias("x")).select("path", "x.*")

    def pending(self, job: str, folder: str) -> DataFrame:
        """Files of ``folder`` that ``job`` has not read as they are, with ``known``: was the path read before?"""
        files, seen = list_files(self.spark, folder), self.seen(job)
        old = seen.select(F.col("path").alias("of"), F.struct("length", "modified").alias("old"))
        joined = files.join(old, F.col("path") == F.col("of"), "left")
        changed = ~F.col("old").eqNullSafe(F.struct("length", "modified"))
        return joined.where(changed).select("path", "length", "modified", F.col("old").isNotNull().alias("known"))

    @contextmanager
    def run(self, job: str, folder: str, run_id: str | None = None, take_rewritten: bool = False) -> Iterator[FileRun]:
        """A run over what is pending; it is written down if the block ends without an exception.

        The listing is fixed at the start, so a file that appears meanwhile is left to the next
        run. A run that wrote and then failed is repeated, so its writes have to be idempotent.
        Rewritten files stay pending, and are reported again, unless ``take_rewritten``.
        """
        if not job:
            raise ValueError("a run needs a job name")
        run_id = run_id or uuid.uuid4().hex
        pending = cut_lineage(self.pending(job, folder))
        new, rewritten = (pending.where(F.col("known") == known).drop("known") for known in (False, True))
        yield FileRun(run_id, new, rewritten)
        taken = new.unionByName(rewritten) if take_rewritten else new
        run = [F.lit(job).alias("job"), F.lit(run_id).alias("run_id"), F.lit(dt.datetime.now(dt.UTC)).alias("taken_at")]
        rows = taken.select(*run, "path", "length", "modified")
        rows.write.mode("append").parquet(self.path)
