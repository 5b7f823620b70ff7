"""Published versions with a tree of digests, so that two of them are compared where they differ.

A row's place is a hash of its key. The places are cut into leaves, leaves into the nodes of a tree
whose levels have sixteen children each, and every node has a digest: the number of its rows and two
sums of row hashes, which do not depend on the order of rows. A version is stored in the order
of places, its digests beside it. A comparison goes down from the root into the nodes whose
digests differ, and reads the rows of the differing leaves alone: ranges of places, which
Parquet finds by its statistics. Versions of different sizes meet at the leaves of the smaller tree.

Nulls are told from other values. Two different sets of rows have equal digests with a
probability of about one in 2^128 for a pair of nodes.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.columns import named
from strata.operators.diff import dataset_diff
from strata.plans.skew import lookup_join
from strata.sources.snapshots import latest_version, publish_snapshot, read_snapshot, version_path
from strata.sources.storage import Storage

_PLACE = "__place"
_BITS = 48
_STEP = 4  # bits of a level
_FOLDER = "_digests"
_TREE = "node long, n long, one decimal(38,0), other decimal(38,0), level int"
_MOST_RANGES = 1_000  # more ranges of places are a join instead of literals


def _place(keys: Sequence[str]) -> Column:
    hashed = F.xxhash64(*[part for key in keys for part in (named(key), named(key).isNull())])
    return F.shiftrightunsigned(hashed, 64 - _BITS)


def _row_hash(columns: Sequence[str], seed: int) -> Column:
    cells = [part for name in sorted(columns) for part in (named(name), named(name).isNull())]
    return F.xxhash64(F.lit(seed), *cells).cast("decimal(38,0)")


def publish_digested(df: DataFrame, path: str, keys: Sequence[str], version: int | None = None, rows_per_leaf: int = 4_096) -> int:
    """Publish ``df`` in the order of places, with its digests, and return the version's number."""
    placed = df.withColumn(_PLACE, _place(keys))
    ordered = placed.repartitionByRange(_PLACE).sortWithinPartitions(_PLACE)
    # Small pages, so that statistics tell leaves apart.
    spark = df.sparkSession
    hadoop = spark._jsparkSession.sessionState().newHadoopConf()
    limit = hadoop.get("parquet.page.row.count.limit")
    spark.conf.set("parquet.page.row.count.limit", str(rows_per_leaf))
    try:
        number = publish_snapshot(ordered, path, version)
    finally:
        spark.conf.unset("parquet.page.row.count.limit") if limit is None else spark.conf.set("parquet.page.row.count.limit", limit)
    digests(spark, path, number, rows_per_leaf)
    return number


def _digest_path(path: str, version: int) -> str:
    return f"{version_path(path, version)}/{_FOLDER}"


def digests(spark: SparkSession, path: str, version: int, rows_per_leaf: int = 4_096) -> DataFrame:
    """(level, node, n, one, other) of a version; made from its rows if a run ended before they were."""
    storage = Storage(spark, version_path(path, version))
    if not storage.exists(_FOLDER, "_SUCCESS"):
        rows = read_snapshot(spark, path, version)
        columns = [name for name in rows.columns if name != _PLACE]
        levels = max(1, math.ceil(math.log2(max(2, rows.count() / rows_per_leaf)) / _STEP))
        levels = min(levels, _BITS // _STEP)

        def summed(df: DataFrame, node: Column, sums: Sequence[Column]) -> DataFrame:
            n, one, other = sums
            return df.groupBy(node.alias("node")).agg(F.sum(n).alias("n"), F.sum(one).alias("one"), F.sum(other).alias("other"))

        leaf = F.shiftright(F.col(_PLACE), _BITS - _STEP * levels)
        lowest = summed(rows, leaf, [F.lit(1), _row_hash(columns, 1), _row_hash(columns, 2)])
        lowest.withColumn("level", F.lit(levels)).write.mode("overwrite").partitionBy("level").parquet(_digest_path(path, version) + ".leaves")
        lowest = spark.read.schema(_TREE).parquet(_digest_path(path, version) + ".leaves").drop("level")
        every = [
            summed(lowest, F.shiftright("node", _STEP * (levels - level)), [F.col("n"), F.col("one"), F.col("other")]).withColumn("level", F.lit(level))
            for level in range(levels + 1)
        ]
        tree = reduce(DataFrame.unionByName, every)
        tree.repartition("level").sortWithinPartitions("node").write.mode("overwrite").partitionBy("level").parquet(_digest_path(path, version))
        storage.remove(f"{_FOLDER}.leaves")
    return spark.read.schema(_TREE).parquet(_digest_path(path, version))


def differing_leaves(spark: SparkSession, path: str, before: int, after: int) -> tuple[DataFrame, int]:
    """The nodes whose digests differ, at the lowest level that both versions have, and that level."""
    one, other = digests(spark, path, before), digests(spark, path, after)
    levels = min(df.agg(F.max("level")).first()[0] or 0 for df in (one, other))
    found = None
    for level in range(levels + 1):
        sides = []
        for df, name in ((one, "before"), (other, "after")):
            side = df.where(F.col("level") == level).select("node", F.struct("n", "one", "other").alias(name))
            if found is not None:
                side = side.join(found.withColumnRenamed("node", "of"), F.shiftright("node", _STEP) == F.col("of"), "left_semi")
            sides.append(side)
        found = sides[0].join(sides[1], "node", "full_outer").where("not (before <=> after)").select("node")
    return found, levels


def dataset_diff_digest(spark: SparkSession, path: str, keys: Sequence[str], before: int | None = None, after: int | None = None) -> DataFrame:
    """:func:`~strata.operators.diff.dataset_diff` of two published versions, reading only what differs.

    By default the newest version and the one before. The columns of both must be the same.
    """
    after = latest_version(spark, path) if after is None else after
    before = latest_version(spark, path, after) if before is None else before
    if after is None or before is None:
        raise FileNotFoundError(f"no two versions are published at {path}")
    found, level = differing_leaves(spark, path, before, after)
    found = found.cache()
    shift = _BITS - _STEP * level
    few = found.limit(_MOST_RANGES + 1).collect()
    sides = []
    for version in (before, after):
        rows = read_snapshot(spark, path, version)
        if len(few) <= _MOST_RANGES:
            ranges = [(F.col(_PLACE) >= (row["node"] << shift)) & (F.col(_PLACE) < (row["node"] + 1 << shift)) for row in few]
            rows = rows.where(reduce(lambda a, b: a | b, ranges, F.lit(False)))
        else:
            leaf = rows.withColumn("__leaf", F.shiftright(F.col(_PLACE), shift))
            rows = lookup_join(leaf, found, {"__leaf": "node"}, "left_semi").drop("__leaf")
        sides.append(rows.drop(_PLACE))
    return dataset_diff(*sides, keys)
