"""Size checks that stand before every broadcast, and the sizes of tasks."""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, BinaryType, StringType, StructType

from strata.functions.columns import named

_MB = 1024 * 1024
_SHUFFLE_TARGET = 256 * _MB
_MOST_SHUFFLE_PARTITIONS = 50_000  # beyond, the number of shuffle blocks is the bottleneck
_MOST_SCAN_TASKS = 100_000
_LARGEST_SPLIT = 1024 * _MB
_MOST_FILES = 200_000
_LARGEST_FILE = 512 * _MB
_CELL = 16  # bytes reckoned for a fixed-width value with its row overhead


@dataclass(frozen=True)
class Bound:
    """What may be broadcast at most."""

    rows: int = 2_000_000
    bytes: int = 128 * 1024 * 1024


DEFAULT_BOUND = Bound()

_ONE_AT_A_TIME = threading.RLock()


def _width(schema: StructType) -> Column:
    total = F.lit(_CELL * len(schema.fields)).cast("long")
    for field in schema.fields:
        cell = named(field.name)
        if isinstance(field.dataType, (StringType, BinaryType)):
            total = total + F.coalesce(F.octet_length(cell), F.lit(0))
        elif not isinstance(field.dataType, AtomicType):
            text = F.to_json(F.struct(cell.alias("value")))
            total = total + 2 * F.octet_length(text)
    return total


def within(df: DataFrame, bound: Bound = DEFAULT_BOUND) -> bool:
    """Measured, not estimated: does ``df`` stay within ``bound``?

    One distributed aggregate; two numbers reach the driver.
    """
    measured = df.agg(F.count(F.lit(1)).alias("n"), F.sum(_width(df.schema)).alias("size")).first()
    return measured["n"] <= bound.rows and (measured["size"] or 0) <= bound.bytes


_UNKNOWN = 2**63 - 1


def _estimate(stats) -> int:
    """An estimate in bytes; a product of joins, which checkpoints keep, may be larger than Python takes from the JVM."""
    try:
        return int(stats.sizeInBytes())
    except ValueError:  # over 4,300 digits
        return _UNKNOWN


def planned_bytes(df: DataFrame) -> int:
    """Spark's own size estimate, the one its broadcast decision is based on."""
    return _estimate(df._jdf.queryExecution().optimizedPlan().stats())


def scanned_bytes(df: DataFrame) -> int:
    """What the scans below ``df`` read, after partition pruning; sources of unknown size count 0.

    The estimate for a whole plan would not do: for a join, Spark multiplies the sizes.
    """
    plan = df._jdf.queryExecution().optimizedPlan()
    unknown = df.sparkSession._jsparkSession.sessionState().conf().defaultSizeInBytes()
    leaves = plan.collectLeaves()
    sizes = [_estimate(leaves.apply(i).stats()) for i in range(leaves.size())]
    return sum(size for size in sizes if size < unknown)


def broadcasts_anyway(df: DataFrame) -> bool:
    """Will Spark broadcast ``df`` by itself under the session's threshold?"""
    conf = df.sparkSession._jsparkSession.sessionState().conf()
    return planned_bytes(df) <= conf.autoBroadcastJoinThreshold()


def task_sizes(
    total: int, shuffle_partitions: int, split_bytes: int, advisory_bytes: int
) -> tuple[int, int, int]:
    """Shuffle partitions, scan split size and AQE's partition size for ``total`` bytes of input.

    Never below the given settings: AQE joins shuffle partitions that turn out small,
    but adds some only where a rebalance is asked for, and there by its own size, which
    is also that of the written files.
    """
    wanted = min(-(-total // _SHUFFLE_TARGET), _MOST_SHUFFLE_PARTITIONS)
    split = min(-(-total // _MOST_SCAN_TASKS), _LARGEST_SPLIT)
    advisory = min(-(-total // _MOST_FILES), _LARGEST_FILE)
    return max(wanted, shuffle_partitions), max(split, split_bytes), max(advisory, advisory_bytes)


@contextmanager
def sized_for(*frames: DataFrame) -> Iterator[None]:
    """Plan what runs inside the block with task sizes that suit the input of ``frames``.

    The sizes are settings of the session that the frames belong to, so another thread that
    wants its own waits until the block is done.
    """
    with _ONE_AT_A_TIME:
        yield from _sized_for(*frames)


def _sized_for(*frames: DataFrame) -> Iterator[None]:
    spark = frames[0].sparkSession
    names = (
        "spark.sql.shuffle.partitions",
        "spark.sql.files.maxPartitionBytes",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes",
    )
    before = {name: spark.conf.get(name) for name in names}
    sql = spark._jsparkSession.sessionState().conf()
    units = spark._jvm.org.apache.spark.network.util.JavaUtils
    given = (
        int(before[names[0]]),
        sql.filesMaxPartitionBytes(),
        units.byteStringAsBytes(before[names[2]]),
    )
    total = sum(scanned_bytes(frame) for frame in frames)
    for name, value in zip(names, task_sizes(total, *given), strict=True):
        spark.conf.set(name, str(value))
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
