"""A record of job runs: what has been processed, and when.

A run is written down only when it succeeds. Rows per run, not per input row or
file, so the record stays small.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.columns import named
from strata.operators.conform import Declared
from strata.plans.skew import lookup_join
from strata.sources.raw import read_raw
from strata.sources.storage import Storage

RUN_SCHEMA = (
    "job string, run_id string, started_at timestamp, read_until timestamp, committed_at timestamp"
)


def _now() -> dt.datetime:
    return dt.datetime.now(dt.UTC)


@dataclass(frozen=True)
class Run:
    job: str
    run_id: str
    started_at: dt.datetime
    since: dt.datetime | None
    until: dt.datetime


class RunLedger:
    """Successful runs, one small Parquet file each, below ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def runs(self) -> DataFrame:
        if not Storage(self.spark, self.path).names():
            return self.spark.createDataFrame([], RUN_SCHEMA)
        return self.spark.read.schema(RUN_SCHEMA).parquet(self.path)

    def read_until(self, job: str) -> dt.datetime | None:
        """Up to where the successful runs of ``job`` have read."""
        newest = self.runs().filter(F.col("job") == job).agg(
            F.unix_micros(F.max("read_until")).alias("micros")
        )
        micros = newest.first()["micros"]
        return None if micros is None else _from_micros(micros)

    def record(
        self,
        job: str,
        started_at: dt.datetime,
        read_until: dt.datetime | None = None,
        run_id: str | None = None,
    ) -> str:
        """Write down a successful run and return its id."""
        run_id = run_id or uuid.uuid4().hex
        cells = {
            "job": job,
            "run_id": run_id,
            "started_at": started_at,
            "read_until": read_until or started_at,
            "committed_at": _now(),
        }
        row = self.spark.range(1).select(*[F.lit(value).alias(name) for name, value in cells.items()])
        row.coalesce(1).write.mode("append").parquet(self.path)
        return run_id

    @contextmanager
    def run(
        self,
        job: str,
        paused: bool = False,
        run_id: str | None = None,
        lag: dt.timedelta = dt.timedelta(0),
    ) -> Iterator[Run]:
        """A run of ``job``, recorded if the block ends without an exception.

        A paused run (a replay) is never recorded. Recording is not part of the
        block's own writes: a run that wrote and then failed will be repeated, so
        writes have to be idempotent.

        A file may carry a time from before it becomes visible, for as long as its
        writer takes to commit. ``lag`` leaves files younger than that to the next run.
        """
        if not job:
            raise ValueError("a run needs a job name")
        start = _now()
        current = Run(job, run_id or uuid.uuid4().hex, start, self.read_until(job), start - lag)
        yield current
        if not paused:
            self.record(job, current.started_at, current.until, current.run_id)

    def bounds(self, job: str, first: str, end: str) -> tuple[dt.datetime, dt.datetime]:
        """Up to where two runs have read: two rows read to the driver."""
        chosen = self.runs().filter((F.col("job") == job) & F.col("run_id").isin(first, end))
        starts = {
            row["run_id"]: _from_micros(row["micros"])
            for row in chosen.select("run_id", F.unix_micros("read_until").alias("micros")).collect()
        }
        missing = [name for name in (first, end) if name not in starts]
        if missing:
            raise KeyError(f"no runs {missing} of job {job!r}")
        return starts[first], starts[end]


def _from_micros(micros: int) -> dt.datetime:
    return dt.datetime.fromtimestamp(0, dt.UTC) + dt.timedelta(microseconds=micros)


def read_unprocessed(
    run: Run, spark: SparkSession, path: str, schema: Declared | None = None, fmt: str = "json"
) -> DataFrame:
    """Rows of the files that arrived since the job's last successful run.

    Files are told by their times. Where their writers are slow or their clocks differ,
    use :func:`strata.streaming.files.process_new_files`, which remembers file names.
    """
    return read_raw(spark, path, schema, fmt, since=run.since, until=run.until)


def unprocessed(df: DataFrame, processed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose keys are not in ``processed``."""
    return lookup_join(df, processed, {key: key for key in keys}, "left_anti")


def replay_range(df: DataFrame, ledger: RunLedger, job: str, first: str, end: str, at: str) -> DataFrame:
    """Rows that came after what run ``first`` had read, up to what run ``end`` has read.

    With runs that leave a ``lag``, that is where their reading ended, not their start.
    ``at`` is the arrival time, in UTC if it has no zone. The bounds become literals, so
    the filter reaches the scan.
    """
    kind = df.schema[at].dataType
    zone = "" if kind.typeName() == "timestamp_ntz" else "+00:00"
    start, stop = (
        F.lit(moment.strftime("%Y-%m-%d %H:%M:%S.%f") + zone).cast(kind)
        for moment in ledger.bounds(job, first, end)
    )
    return df.filter((named(at) >= start) & (named(at) < stop))


def replay_files(
    ledger: RunLedger,
    job: str,
    first: str,
    end: str,
    path: str,
    schema: Declared | None = None,
    fmt: str = "json",
) -> DataFrame:
    """The same for files, by the time each one was written; the others are not opened."""
    start, stop = ledger.bounds(job, first, end)
    return read_raw(ledger.spark, path, schema, fmt, since=start, until=stop)
