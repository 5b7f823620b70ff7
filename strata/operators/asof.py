"""Attributes as they stood at a moment: each row gets the newest row of the other side up to its time.

No range join: both sides are put together and sorted once by key and time, and the last row of
the other side is carried along. So that a key with very many rows is not one task's, time is cut
into slices: each slice of a key is sorted on its own, and begins with what the slices before it
end with, one row that is found from the last rows of slices alone.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.columns import named

_SLICE, _AT, _SIDE, _ROW, _FOUND = "__slice", "__at", "__side", "__row", "__found"
_CARRIED, _RIGHT, _LEFT = 0, 1, 2


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: Mapping[str, str],
    at: Mapping[str, str],
    columns: Mapping[str, str],
    slice_seconds: int = 30 * 86_400,
) -> DataFrame:
    """``left`` with ``columns`` (``{new name: right column}``) of the newest right row at its time or before.

    ``on`` and ``at`` map left to right columns: equal keys, and the one time column. Left rows
    without a key or a time, or without an earlier right row, get nulls; right rows without
    them are never found. Of right rows of one time the greatest by ``columns`` is taken.
    ``slice_seconds`` changes the work, not the result.
    """
    clash = {name.lower() for name in left.columns} & {name.lower() for name in columns}
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    ((mine, theirs),) = at.items()
    keys = [f"__key_{i}" for i in range(len(on))]

    def sliced(time: str) -> list:
        moment = named(time).cast("timestamp")
        return [moment.alias(_AT), F.floor(F.unix_seconds(moment) / slice_seconds).alias(_SLICE)]

    found = F.struct(*[named(source).alias(f"c{i}") for i, source in enumerate(columns.values())])
    other = right.select(*[named(c).alias(k) for k, c in zip(keys, on.values(), strict=True)], *sliced(theirs), found.alias(_FOUND))
    other = other.dropna(subset=[*keys, _AT])
    whole = F.struct(*[named(name) for name in left.columns])
    rows = left.select(*[named(c).alias(k) for k, c in zip(keys, on, strict=True)], *sliced(mine), whole.alias(_ROW))
    # The last right row of each slice, cut down on the map side; then what each slice begins with.
    last = other.groupBy(*keys, _SLICE).agg(F.max(F.struct(_AT, _FOUND)).alias("last"))
    slices = rows.select(*keys, _SLICE).distinct().dropna().join(last, [*keys, _SLICE], "full_outer")
    earlier = Window.partitionBy(*keys).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carried = slices.select(*keys, _SLICE, F.last("last", ignorenulls=True).over(earlier).alias("last")).where("last is not null")
    parts = [
        (carried, F.col("last")[_AT], F.col("last")[_FOUND], _CARRIED),
        (other, F.col(_AT), F.col(_FOUND), _RIGHT),
        (rows, F.col(_AT), F.lit(None), _LEFT),
    ]
    kind, row_kind = other.schema[_FOUND].dataType, rows.schema[_ROW].dataType
    together = None
    for df, time, value, side in parts:
        row = F.col(_ROW) if side == _LEFT else F.lit(None)
        part = df.select(*keys, _SLICE, time.alias(_AT), value.cast(kind).alias(_FOUND), row.cast(row_kind).alias(_ROW), F.lit(side).alias(_SIDE))
        together = part if together is None else together.unionByName(part)
    # At the same time a right row stands before the left ones, and the greatest right row last.
    order = Window.partitionBy(*keys, _SLICE).orderBy(_AT, _SIDE, _FOUND).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    valid = F.col(_AT).isNotNull()
    for key in keys:
        valid = valid & F.col(key).isNotNull()
    seen = F.when(valid, F.last(_FOUND, ignorenulls=True).over(order))
    joined = together.withColumn(_FOUND, seen).where(F.col(_SIDE) == _LEFT)
    added = [F.col(_FOUND)[f"c{i}"].alias(name) for i, name in enumerate(columns)]
    return joined.select(*[F.col(_ROW)[name].alias(name) for name in left.columns], *added)


def slices_of(df: DataFrame, keys: Sequence[str], at: str, slice_seconds: int = 30 * 86_400) -> DataFrame:
    """How many rows each slice of each key has: what one task of :func:`asof_join` sorts at most."""
    slice_ = F.floor(F.unix_seconds(named(at).cast("timestamp")) / slice_seconds).alias("slice")
    return df.groupBy(*[named(key) for key in keys], slice_).agg(F.count(F.lit(1)).alias("rows"))
