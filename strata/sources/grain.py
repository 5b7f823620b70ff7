"""A table that grows by appends, its grain proved again after each without regrouping what is there.

Each append is a published version: its rows in the order of a hash of their keys, and beside them
a blocked Bloom filter of these keys and the keys that this append repeats. A filter is a frame of
blocks; a key's hash names a block and sets eight bits of its 256. Filters stay apart, as merged
ones would fill up: a new key meets the blocks of all appends in one join, and they say which
appends may hold it. Their numbers of blocks are powers of two that follow the rows, so a key is
sent once for each such number. Keys that no filter knows are new for certain. The others are
looked up in the appends that may hold them: by their hashes, which Parquet finds by its
statistics of pages, or by a join where they are many.

Keys are compared null-safely: null is a key like any other. Repeated rows count as often as they
stand. Columns may have any names but those the module adds (``__place``, ``__new``, ``__held``,
``__stored``, and ``n`` for a key). One append at a time goes to a path; an append whose run ends before its
keys are checked is checked when violations are next asked for, or by the next append.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.columns import named
from strata.operators.grain import grain_check
from strata.plans.sizing import DEFAULT_BOUND, Bound, within
from strata.session import cut_lineage
from strata.sources.snapshots import publish_snapshot, read_snapshot, version_path, versions
from strata.sources.storage import Storage

_PLACE = "__place"
_FILTER = "_KEYS"
_REPEATED = "_REPEATED"
_BLOCK_BITS = 256
_WORDS = [f"w{i}" for i in range(4)]
_FILTER_SCHEMA = "blocks long, block long, w0 long, w1 long, w2 long, w3 long"
_MOST_PLACES = 1_000  # more keys to look up are a join instead of literals


def _place(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[part for key in keys for part in (named(key), named(key).isNull())])


def _masks(place: Column) -> list[Column]:
    """The four words of a key's block: two bits in each, from a second hash of its place."""
    second = F.xxhash64(F.lit(7), place)
    masks = []
    for i in range(len(_WORDS)):
        one, other = (F.shiftrightunsigned(second, 12 * i + shift).bitwiseAND(F.lit(63)).cast("int") for shift in (0, 6))
        masks.append(F.call_function("shiftleft", F.lit(1).cast("long"), one).bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), other)))
    return masks


def _block(place: Column, blocks: Column) -> Column:
    return place.bitwiseAND(blocks - 1)


def key_filter(df: DataFrame, keys: Sequence[str], rows: int, bits_per_key: int = 16) -> DataFrame:
    """The blocked Bloom filter of the keys of ``df``: (blocks, block, w0, w1, w2, w3)."""
    blocks = 1 << max(0, math.ceil(math.log2(max(1, rows * bits_per_key / _BLOCK_BITS))))
    placed = df.select(_place(keys).alias("place"))
    words = [mask.alias(word) for mask, word in zip(_masks(F.col("place")), _WORDS, strict=True)]
    set_bits = placed.select(F.lit(blocks).cast("long").alias("blocks"), _block(F.col("place"), F.lit(blocks)).alias("block"), *words)
    return set_bits.groupBy("blocks", "block").agg(*[F.bit_or(word).alias(word) for word in _WORDS])


def _folder(path: str, version: int, name: str) -> str:
    return f"{version_path(path, version)}/{name}"


def _done(spark: SparkSession, path: str, version: int, name: str) -> bool:
    return Storage(spark, version_path(path, version)).exists(name, "_SUCCESS")


def publish_append(df: DataFrame, path: str, keys: Sequence[str], rows_per_page: int = 4_096, bound: Bound = DEFAULT_BOUND) -> int:
    """Store ``df`` as the next append of the table at ``path``, check its keys, and return its number."""
    spark = df.sparkSession
    ordered = df.withColumn(_PLACE, _place(keys)).repartitionByRange(_PLACE).sortWithinPartitions(_PLACE)
    hadoop = spark._jsparkSession.sessionState().newHadoopConf()
    limit = hadoop.get("parquet.page.row.count.limit")
    spark.conf.set("parquet.page.row.count.limit", str(rows_per_page))
    try:
        number = publish_snapshot(ordered, path)
    finally:
        spark.conf.unset("parquet.page.row.count.limit") if limit is None else spark.conf.set("parquet.page.row.count.limit", limit)
    _check_appends(spark, path, keys, bound)
    return number


def read_appends(spark: SparkSession, path: str, numbers: Sequence[int] | None = None) -> DataFrame:
    """All rows of the table, or those of some appends."""
    chosen = versions(spark, path) if numbers is None else numbers
    if not chosen:
        raise FileNotFoundError(f"nothing is published at {path}")
    return reduce(DataFrame.unionByName, [read_snapshot(spark, path, n) for n in chosen]).drop(_PLACE)


def _check_appends(spark: SparkSession, path: str, keys: Sequence[str], bound: Bound) -> None:
    """Filter and violations of each append that has none yet, oldest first."""
    earlier: list[int] = []
    for number in versions(spark, path):
        if not _done(spark, path, number, _FILTER):
            stored = read_snapshot(spark, path, number)
            key_filter(stored, keys, stored.count()).write.mode("overwrite").parquet(_folder(path, number, _FILTER))
        if not _done(spark, path, number, _REPEATED):
            found = appended_violations(spark, path, number, earlier, keys, bound)
            found.write.mode("overwrite").parquet(_folder(path, number, _REPEATED))
        earlier.append(number)


def possible_keys(spark: SparkSession, path: str, number: int, earlier: Sequence[int], keys: Sequence[str]) -> DataFrame:
    """(``__place``, *keys, ``__new``, ``__held``): keys of an append that earlier ones may hold, their rows in it, and these."""
    fresh = read_snapshot(spark, path, number).groupBy(_PLACE, *[named(key) for key in keys]).agg(F.count(F.lit(1)).alias("__new"))
    filters = [
        spark.read.schema(_FILTER_SCHEMA).parquet(_folder(path, n, _FILTER)).withColumn("__held", F.lit(n)) for n in earlier
    ]
    stored = reduce(DataFrame.unionByName, filters)
    sizes = [row["blocks"] for row in stored.select("blocks").distinct().collect()]  # powers of two: 63 at most
    place = F.col(_PLACE)
    asked = fresh.select(place, F.explode(F.array(*[F.lit(n).cast("long") for n in sizes] or [F.lit(1).cast("long")])).alias("blocks"))
    asked = asked.withColumn("block", _block(place, F.col("blocks")))
    known = [F.col(word).bitwiseAND(mask) == mask for mask, word in zip(_masks(place), _WORDS, strict=True)]
    held = asked.join(stored, ["blocks", "block"]).where(reduce(Column.__and__, known))
    # Keys whose places are equal meet the same blocks.
    return fresh.join(held.groupBy(_PLACE).agg(F.collect_set("__held").alias("__held")), _PLACE)


def _any(conditions: Sequence[Column]) -> Column:
    """One of the conditions holds; halved, so that the expression is not as deep as they are many."""
    if len(conditions) <= 1:
        return conditions[0] if conditions else F.lit(False)
    half = len(conditions) // 2
    return _any(conditions[:half]) | _any(conditions[half:])


def rows_to_compare(spark: SparkSession, path: str, number: int, possible: DataFrame, keys: Sequence[str], bound: Bound = DEFAULT_BOUND) -> DataFrame:
    """The keys of the rows of append ``number`` whose places are those of possible keys."""
    wanted = possible.where(F.array_contains("__held", number)).select(_PLACE).distinct()
    places = [row[0] for row in wanted.limit(_MOST_PLACES + 1).collect()]
    stored = read_snapshot(spark, path, number).select(_PLACE, *[named(key) for key in keys])
    if len(places) <= _MOST_PLACES:
        # Not isin: of more than ten values Parquet would learn the smallest and the largest only.
        return stored.where(_any([F.col(_PLACE) == place for place in sorted(places)]))
    return stored.join(F.broadcast(wanted) if within(wanted, bound) else wanted, _PLACE, "left_semi")


def appended_violations(
    spark: SparkSession, path: str, number: int, earlier: Sequence[int], keys: Sequence[str], bound: Bound = DEFAULT_BOUND
) -> DataFrame:
    """(*keys, n): keys of an append that occur more than once in it and the earlier ones, with all their rows."""
    names = [named(key) for key in keys]
    again = grain_check(read_snapshot(spark, path, number), keys, "n")
    if not earlier:
        return again
    possible = cut_lineage(possible_keys(spark, path, number, earlier, keys))
    held = [row[0] for row in possible.select(F.explode("__held")).distinct().collect()]  # no more than there are appends
    parts = [possible.select(*names, "__new")]
    for n in sorted(held):
        parts.append(rows_to_compare(spark, path, n, possible, keys, bound).select(*names, F.lit(0).cast("long").alias("__new")))
    # A stored row counts one; the row of a possible key counts its rows in the new append.
    counted = reduce(DataFrame.unionByName, parts).groupBy(*names).agg(F.sum("__new").alias("__new"), F.count_if(F.col("__new") == 0).alias("__stored"))
    old = counted.where("__new > 0 and __stored > 0").select(*names, (F.col("__new") + F.col("__stored")).alias("n"))
    return old.unionByName(again).groupBy(*names).agg(F.max("n").alias("n"))


def grain_violations(spark: SparkSession, path: str, keys: Sequence[str], count: str = "n", bound: Bound = DEFAULT_BOUND) -> DataFrame:
    """What :func:`~strata.operators.grain.grain_check` gives for the whole table, from what the appends recorded.

    A key's number of rows only grows, so the largest one recorded is the newest.
    """
    _check_appends(spark, path, keys, bound)
    folders = [_folder(path, number, _REPEATED) for number in versions(spark, path)]
    if not folders:
        raise FileNotFoundError(f"nothing is published at {path}")
    schema = spark.read.parquet(folders[0]).schema
    found = spark.read.schema(schema).parquet(*folders)
    return found.groupBy(*[named(key) for key in keys]).agg(F.max("n").alias(count))
