"""Compare two versions of a dataset."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import named

_SURPLUS = "__surplus"


def _aligned(before: DataFrame, after: DataFrame) -> tuple[DataFrame, DataFrame]:
    if set(before.columns) != set(after.columns):
        odd = sorted(set(before.columns) ^ set(after.columns))
        raise ValueError(f"columns on one side only: {odd}")
    return before, after.select(*[named(name) for name in before.columns])


def dataset_diff(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows ``(*keys, change, before, after)`` for every key that differs.

    ``change`` is ``added``, ``removed`` or ``changed``; ``before`` and ``after`` are
    structs of the other columns. Nulls equal nulls. Equal rows cancel out first, in a
    hash aggregation that copes with any number of copies; only what is left is
    grouped by key. There is no join, so a key that should be unique and is not cannot
    multiply: if its rows differ, it fails the job.
    """
    names = [named(key) for key in keys]
    others = [name for name in before.columns if name not in keys] or list(keys)
    left = multiset_diff(before, after, _SURPLUS)
    row = F.struct(*[named(name) for name in others])

    def side(present: Column) -> Column:
        return F.first(F.when(present, row), ignorenulls=True)

    gone, new = F.col(_SURPLUS) < 0, F.col(_SURPLUS) > 0
    grouped = left.groupBy(*names).agg(
        side(gone).alias("before"),
        side(new).alias("after"),
        F.sum(F.greatest(-F.col(_SURPLUS), F.lit(0))).alias("__before_rows"),
        F.sum(F.greatest(F.col(_SURPLUS), F.lit(0))).alias("__after_rows"),
    )
    repeated = (F.col("__before_rows") > 1) | (F.col("__after_rows") > 1)
    failure = F.raise_error(F.lit("dataset_diff: a key occurs more than once")).cast("string")
    change = (
        F.when(repeated, failure)
        .when(F.col("before").isNull(), "added")
        .when(F.col("after").isNull(), "removed")
        .otherwise("changed")
    )
    return grouped.select(*names, change.alias("change"), "before", "after")


def multiset_diff(before: DataFrame, after: DataFrame, count: str = "surplus") -> DataFrame:
    """Rows that occur more often on one side: positive ``surplus`` in ``after``.

    Needs no key. Copies of a row are added up on the map side, so any number of
    equal rows reaches the shuffle as one row per task.
    """
    before, after = _aligned(before, after)
    signed = before.withColumn(count, F.lit(-1).cast("long")).unionByName(
        after.withColumn(count, F.lit(1).cast("long"))
    )
    columns = [named(name) for name in before.columns]
    return signed.groupBy(*columns).agg(F.sum(count).alias(count)).filter(F.col(count) != 0)


def same_rows(before: DataFrame, after: DataFrame) -> bool:
    """Whether both hold the same rows, in any order, equally often. Runs a job."""
    return multiset_diff(before, after).isEmpty()
