"""Point-in-time snapshots: one full copy of the live rows per period.

Stored snapshots keep their tombstones (``keep_tombstones=True``). A snapshot that
forgot a deletion could not take in a late older row without reviving the key.
:func:`snapshot_at` hides tombstones from readers.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.columns import named, quoted
from strata.functions.dates import (
    next_period,
    period_of,
    periods_between,
    previous_period,
    start_after,
    start_of,
    starts_between,
)
from strata.operators.merge import is_live, merge_into_unique, retain_last, with_flag
from strata.plans.sizing import DEFAULT_BOUND, Bound

_UNTIL = "__until"


def affected_partitions(changes: DataFrame, at: str, unit: str = "month") -> DataFrame:
    """The periods that ``changes`` touch, one row each; null dates touch none."""
    return (
        changes.filter(named(at).isNotNull())
        .select(period_of(named(at), unit).alias("period"))
        .distinct()
    )


def earliest_affected(changes: DataFrame, at: str, unit: str = "month") -> dt.date | None:
    """First period that ``changes`` touch. Runs a job that returns one value."""
    return changes.agg(period_of(F.min(quoted(at)), unit).alias("first")).first()["first"]


def _last_per_period(
    changes: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    deleted: str | None,
    unit: str,
    period: str,
    order_is_total: bool,
    upto: dt.date,
) -> DataFrame:
    moment = named(order[0])
    # A row in no period, or in one that is not built, must not get lost in silence.
    lost = F.raise_error(F.concat(F.lit(f"{order[0]} is null or after {upto}: "), F.coalesce(moment.cast("string"), F.lit("null"))))
    inside = moment.cast("date") < next_period(period_of(F.lit(upto).cast("date"), unit), unit)
    at = F.when(moment.isNotNull() & inside, period_of(moment, unit)).otherwise(lost.cast("date"))
    return retain_last(
        changes.withColumn(period, at),
        keys=[*keys, period],
        order=order,
        deleted=deleted,
        keep_tombstones=True,
        order_is_total=order_is_total,
    )


def spread_periods(
    latest: DataFrame,
    keys: Sequence[str],
    deleted: str | None,
    upto: dt.date,
    unit: str,
    period: str,
    keep_tombstones: bool,
) -> DataFrame:
    """Repeat each key's row in every period up to the key's next row, or ``upto``."""
    columns = latest.columns
    by_time = Window.partitionBy(*[named(k) for k in keys]).orderBy(F.col(period))
    last = F.lit(upto).cast("date")
    following = previous_period(F.lead(period).over(by_time), unit)
    spans = latest.withColumn(_UNTIL, F.least(F.coalesce(following, last), last))
    if deleted is not None and not keep_tombstones:
        # The span of a delete is known by now, so it can go before rows multiply.
        spans = spans.filter(is_live(deleted))
    covered = F.explode(periods_between(F.col(period), F.col(_UNTIL), unit)).alias(period)
    others = [named(name) for name in columns if name != period]
    spread = spans.select(*others, covered)
    return spread if deleted is None or keep_tombstones else spread.drop(deleted)


def pit_snapshots(
    changes: DataFrame,
    *,
    keys: Sequence[str],
    order: Sequence[str],
    upto: dt.date,
    deleted: str | None = None,
    unit: str = "month",
    period: str = "period",
    keep_tombstones: bool = False,
    order_is_total: bool = False,
) -> DataFrame:
    """Every period's snapshot from the full change history, in one pass.

    The period of a row is that of ``order[0]``; a row without a date, or after the period
    ``upto``, the last one to build, fails the job. Rows are first cut to one per key and period,
    on the map side too, so a key with a third of all changes reaches the second shuffle
    with at most one row per period.
    """
    latest = _last_per_period(changes, keys, order, deleted, unit, period, order_is_total, upto)
    return spread_periods(latest, keys, deleted, upto, unit, period, keep_tombstones)


def pit_partition(
    incoming: DataFrame,
    previous: DataFrame,
    current: DataFrame,
    *,
    keys: Sequence[str],
    order: Sequence[str],
    deleted: str | None = None,
    keep_tombstones: bool = False,
    order_is_total: bool = False,
) -> DataFrame:
    """The current period's snapshot, rebuilt from incoming rows, the previous and the current one.

    Periods follow ingest time here. ``current`` beats ``previous`` when equal, and
    incoming rows beat both.
    """
    age = "__age"

    def aged(df: DataFrame, value: int) -> DataFrame:
        return with_flag(df, deleted).withColumn(age, F.lit(value))

    merged = retain_last(
        aged(incoming, 2),
        aged(current, 1).unionByName(aged(previous, 0)),
        keys=keys,
        order=[*order, age],
        deleted=deleted,
        keep_tombstones=keep_tombstones,
        order_is_total=order_is_total,
    )
    return merged.drop(age)


def roll_forward(
    stored: DataFrame,
    late: DataFrame,
    *,
    keys: Sequence[str],
    order: Sequence[str],
    stored_upto: dt.date,
    upto: dt.date | None = None,
    first: dt.date | None = None,
    deleted: str | None = None,
    unit: str = "month",
    period: str = "period",
    keep_tombstones: bool = True,
    order_is_total: bool = False,
    bound: Bound = DEFAULT_BOUND,
) -> DataFrame:
    """The rebuilt snapshots of all periods from the earliest one that must change.

    ``stored`` are the snapshots so far, tombstones included, up to ``stored_upto``; every
    period after that, up to ``upto``, is filled from the last one, whether it has late rows
    or not. All periods are rebuilt in one pass instead of one after the other: a stored
    snapshot already holds the newest row of each key at that time, so each late row only
    has to compete with it in the periods that the late row reaches. Earlier partitions are
    not read. While the late rows, in all periods they reach, stay within ``bound``, stored
    rows are not shuffled. ``first`` hands in the earliest period of ``late`` if it is known
    already. A late row without a date, or after ``upto``, fails the job.
    """
    placed, others = roll_forward_parts(
        stored,
        late,
        keys=keys,
        order=order,
        stored_upto=stored_upto,
        upto=upto,
        first=first,
        deleted=deleted,
        unit=unit,
        period=period,
        order_is_total=order_is_total,
        bound=bound,
    )
    rebuilt = others if placed is None else placed.unionByName(others)
    return _finish(rebuilt, deleted, keep_tombstones)


def _in_each(df: DataFrame, starts: Sequence[dt.date], period: str) -> DataFrame:
    """``df`` once for each of the periods, every one in tasks of its own.

    A task then has no more rows than its share of ``df``, however many periods there are, and
    those that write or sort the rows by period need no more memory than for one.
    """
    return reduce(DataFrame.unionByName, [df.withColumn(period, F.lit(start)) for start in starts])


def roll_forward_parts(
    stored: DataFrame,
    late: DataFrame,
    *,
    keys: Sequence[str],
    order: Sequence[str],
    stored_upto: dt.date,
    upto: dt.date | None = None,
    first: dt.date | None = None,
    deleted: str | None = None,
    unit: str = "month",
    period: str = "period",
    order_is_total: bool = False,
    bound: Bound = DEFAULT_BOUND,
) -> tuple[DataFrame | None, DataFrame]:
    """:func:`roll_forward`, with the rows that stand where stored ones stood apart from the others."""
    upto = max(upto or stored_upto, stored_upto)
    first = first or earliest_affected(late, order[0], unit)
    following = start_after(start_of(stored_upto, unit), unit)
    if first is None or first > following:
        first = following
    latest = _last_per_period(late, keys, order, deleted, unit, period, order_is_total, upto)
    arrivals = spread_periods(latest, keys, None, upto, unit, period, True)
    others = [named(name) for name in stored.columns if name != period]
    # Each stored period stands for itself, and the last one for all periods after it too.
    affected = stored.filter(F.col(period) >= F.lit(first).cast("date")).select(*others, F.col(period))
    missing = starts_between(following, start_of(upto, "day"), unit)
    if missing:
        last = stored.filter(F.col(period) == F.lit(stored_upto).cast("date")).select(*others)
        affected = affected.unionByName(_in_each(last, missing, period))
    return merge_into_unique(arrivals, affected.select(*[named(n) for n in arrivals.columns]), [*keys, period], order, bound)


def _finish(df: DataFrame, deleted: str | None, keep_tombstones: bool) -> DataFrame:
    if deleted is None or keep_tombstones:
        return df
    return df.filter(is_live(deleted)).drop(deleted)


def snapshot_at(
    stored: DataFrame,
    when: dt.date,
    *,
    deleted: str | None = None,
    unit: str = "month",
    period: str = "period",
) -> DataFrame:
    """The data as it stood in the period of ``when``.

    A filter on the partition column with a literal, so only that partition is read.
    """
    start = period_of(F.lit(when).cast("date"), unit)
    return _finish(stored.filter(F.col(period) == start), deleted, False).drop(period)
