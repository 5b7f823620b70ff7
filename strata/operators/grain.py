"""Checks of a table's grain: one row per key, and a row for every key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import named
from strata.plans.skew import lookup_join


class GrainError(ValueError):
    """A table has several rows for one key of its grain."""


def grain_check(df: DataFrame, keys: Sequence[str], count: str = "n") -> DataFrame:
    """Keys that occur more than once, with their number of rows.

    Counts are added up on the map side first, so hot keys do no harm.
    """
    return (
        df.groupBy(*[named(key) for key in keys])
        .agg(F.count(F.lit(1)).alias(count))
        .filter(F.col(count) > 1)
    )


def assert_grain(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise if a key occurs more than once. Runs one job over the key columns."""
    example = F.first(F.struct(*[named(key) for key in keys]))
    repeated = grain_check(df, keys, "__n").agg(F.count("__n").alias("n"), example.alias("key")).first()
    if repeated["n"]:
        key = repeated["key"].asDict()
        raise GrainError(f"{repeated['n']} keys have more than one row, for example {key}")


def grain_coverage(required: DataFrame, product: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Keys of ``required`` that have no row in ``product``, once each."""
    wanted = required.select(*[named(name) for name in on]).distinct()
    return lookup_join(wanted, product, on, "left_anti", split_hot=False)
