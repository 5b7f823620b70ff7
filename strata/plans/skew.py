"""Lookup joins that survive hot keys.

A lookup brings attributes of a side that is unique per key to a side that may hold a third
of its rows under one key. While the lookup side is small, Spark broadcasts it and no key is
hot. Beyond that the join shuffles, and the task that gets a hot key would run alone. Here
the rows of a hot key are spread over as many salts as it is too large, and its one lookup
row is repeated for each of them. The join stays one join over one scan of either side.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegralType,
    LongType,
    MapType,
    StringType,
    TimestampNTZType,
    TimestampType,
    VariantType,
)

from strata.functions.columns import named, quoted
from strata.plans.sizing import broadcasts_anyway, scanned_bytes

_LEAST_SHARES = 1024  # keys with more than this part of all rows are hot at any size
_SHARE_BYTES = 128 * 1024 * 1024  # and so are those with more than this
_MOST_SHARES = 65_536
_MOST_TRACKED = 1_000_000
_AS_THEY_ARE = (
    BinaryType,
    BooleanType,
    DateType,
    DecimalType,
    IntegralType,
    StringType,
    TimestampNTZType,
    TimestampType,
)
_HASH, _SALTS, _SALT = "__hash", "__salts", "__salt"


def _comparable(left: DataType, right: DataType) -> DataType | None:
    """The type in which keys that join have equal hashes; None if there is none."""
    if isinstance(left, IntegralType) and isinstance(right, IntegralType):
        return LongType()
    numbers = (IntegralType, FloatType, DoubleType)
    if isinstance(left, numbers) and isinstance(right, numbers):
        return DoubleType()
    if isinstance(left, StringType) and left.collation != "UTF8_BINARY":
        return None
    return left if left == right and isinstance(left, _AS_THEY_ARE) else None


def _key_hash(names: Sequence[str], kinds: Sequence[DataType]) -> Column:
    cells = []
    for name, kind in zip(names, kinds, strict=True):
        cell = named(name).cast(kind)
        if isinstance(kind, DoubleType):
            cell = F.when(cell == 0, F.lit(0.0)).otherwise(cell)  # 0.0 and -0.0 join
        cells.append(cell)
    return F.xxhash64(*cells)


def _shares(df: DataFrame) -> int:
    """A key is hot above one part in so many: a task's fair share at the size of the input."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(_MOST_SHARES, max(_LEAST_SHARES, partitions, math.ceil(scanned_bytes(df) / _SHARE_BYTES)))


def hot_keys(
    df: DataFrame, keys: Sequence[Sequence[str]], kinds: Sequence[Sequence[DataType]] | None = None
) -> list[dict[int, int]]:
    """For each list of key columns, the hashes of the hot keys and how many shares each fills.

    One pass over ``df`` for all of them: a frequent-items sketch per task, merged in two
    steps. Memory does not grow with the number of keys, and a key above the threshold cannot
    be missed, as the sketch's error is far below it. A wrong guess would only cost a few
    repeated lookup rows.
    """
    kinds = kinds or [[_comparable(df.schema[n].dataType, df.schema[n].dataType) for n in names] for names in keys]
    shares = _shares(df)
    tracked = min(_MOST_TRACKED, 1 << (8 * shares - 1).bit_length())
    hashed = df.select(*[_key_hash(names, kind).alias(f"h{i}") for i, (names, kind) in enumerate(zip(keys, kinds, strict=True))])
    groups = F.pmod(F.spark_partition_id(), F.lit(64)).alias("g")
    first = hashed.groupBy(groups).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.expr(f"approx_top_k_accumulate(h{i}, {tracked})").alias(f"s{i}") for i in range(len(keys))],
    )
    # Grouped by a constant: without rows there is no group, and no sketch to merge.
    merged = first.groupBy(F.lit(1)).agg(
        F.sum("n").alias("n"), *[F.expr(f"approx_top_k_combine(s{i}, {tracked})").alias(f"s{i}") for i in range(len(keys))]
    )
    row = merged.select("n", *[F.expr(f"approx_top_k_estimate(s{i}, {shares})").alias(f"t{i}") for i in range(len(keys))]).first()
    if row is None:
        return [{} for _ in keys]
    return [
        {x["item"]: math.ceil(x["count"] * shares / row["n"]) for x in row[f"t{i}"] or [] if x["count"] * shares > row["n"]}
        for i in range(len(keys))
    ]


def hot_keys_counted(
    counted: DataFrame, keys: Sequence[str], kinds: Sequence[DataType], count: str, total: int, shares: int
) -> dict[int, int]:
    """:func:`hot_keys` of a frame that says in ``count`` how many of ``total`` rows each of its rows stands for.

    Fewer keys than ``shares`` can be hot, so that many rows reach the driver at most.
    """
    sums = counted.groupBy(_key_hash(keys, kinds).alias("h")).agg(F.sum(count).alias("n"))
    hot = sums.where(F.col("n") * shares > total).collect()
    return {row["h"]: math.ceil(row["n"] * shares / total) for row in hot}


def shares_of(df: DataFrame) -> int:
    """Into how many parts the rows of ``df`` are thought divided; a key that has more than one is hot."""
    return _shares(df)


def _row_hash(df: DataFrame) -> Column:
    """Spreads the rows of a key, equal rows of different tasks too; a task that runs again does the same."""
    cells = [named(f.name) for f in df.schema.fields if not isinstance(f.dataType, (MapType, VariantType)) and "map<" not in f.dataType.simpleString()]
    return F.xxhash64(*cells, F.spark_partition_id())


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: Mapping[str, str],
    how: str = "left_outer",
    *,
    split_hot: bool | None = None,
    hot: Mapping[int, int] | None = None,
) -> DataFrame:
    """Join ``left`` to ``right`` (unique per key) on ``{left column: right column}``.

    ``how`` is ``left_outer``, ``left_semi`` or ``left_anti``. The right key columns are not
    part of the result. ``split_hot=None`` looks for hot keys, and spreads them, when the right
    side is too large to broadcast and the hashes of equal keys are equal; True and False force
    it, and True fails where that is not so (collated text, unlike types). ``hot`` hands in
    what :func:`hot_keys` has found.
    """
    if how not in ("left_outer", "left_semi", "left_anti"):
        raise ValueError(f"not a lookup: {how}")
    left_keys = list(on)
    right_keys = [f"__on_{i}" for i in range(len(on))]
    carried = [name for name in right.columns if name not in on.values()]
    clash = {name.lower() for name in left.columns} & {name.lower() for name in carried}
    if how == "left_outer" and clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    right = right.select(
        *[named(name).alias(key) for name, key in zip(on.values(), right_keys, strict=True)],
        *([named(name).alias(name) for name in carried] if how == "left_outer" else []),
    ).dropna(subset=right_keys)
    small = broadcasts_anyway(right)
    if how != "left_outer" and not small:
        # One row per key is enough to decide, and a hot key on this side collapses
        # before the shuffle.
        right = right.distinct()
    kinds = key_kinds(left, right, dict(zip(left_keys, right_keys, strict=True)))
    if split_hot and kinds is None:
        raise ValueError(f"hashes of equal keys may differ: {left_keys}")
    wanted = (not small if split_hot is None else split_hot) and kinds is not None
    columns = left.columns
    salted = False
    if wanted:
        hot = hot_keys(left, [left_keys], [kinds])[0] if hot is None else hot
        salted = bool(hot)
    if salted:
        left, right = _salted(left, right, left_keys, right_keys, kinds, hot)
    pairs = [*zip(left_keys, right_keys, strict=True), *([(_SALT, f"{_SALT}_r")] if salted else [])]
    condition = reduce(and_, [left[quoted(mine)] == right[other] for mine, other in pairs])
    out = left.join(right, condition, how)
    added = [named(name) for name in carried] if how == "left_outer" else []
    return out.select(*[left[quoted(name)] for name in columns], *added)


def key_kinds(left: DataFrame, right: DataFrame, on: Mapping[str, str]) -> list[DataType] | None:
    """The types in which the keys of both sides hash alike; None if a key has none."""
    kinds = [_comparable(left.schema[mine].dataType, right.schema[other].dataType) for mine, other in on.items()]
    return None if None in kinds else kinds


def _salted(
    left: DataFrame,
    right: DataFrame,
    left_keys: Sequence[str],
    right_keys: Sequence[str],
    kinds: Sequence[DataType],
    hot: Mapping[int, int],
) -> tuple[DataFrame, DataFrame]:
    """Both sides with a salt: rows of a hot key get one of its salts, its lookup row gets all."""
    # At most as many rows as there are shares; the limit bounds the repeated lookup rows too.
    table = left.sparkSession.createDataFrame(list(hot.items()), f"{_HASH} long, {_SALTS} long")

    def with_salts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
        marked = df.withColumn(f"{_HASH}_k", _key_hash(keys, kinds))
        found = marked.join(F.broadcast(table), F.col(f"{_HASH}_k") == F.col(_HASH), "left_outer")
        return found.withColumn(_SALTS, F.coalesce(F.col(_SALTS), F.lit(1).cast("long")))

    one = with_salts(left, left_keys).withColumn(_SALT, F.pmod(_row_hash(left), F.col(_SALTS)))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col(_SALTS) - 1))
    other = with_salts(right, right_keys).withColumn(f"{_SALT}_r", every)
    extra = [_HASH, f"{_HASH}_k", _SALTS]
    return one.drop(*extra), other.drop(*extra)
