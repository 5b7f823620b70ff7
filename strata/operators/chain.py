"""Snapshots of every period from a skip chain of deltas, instead of one full copy per period.

Periods are numbered from an origin on. Node k of the chain holds the newest change of each key in
the periods after k without its lowest binary digit, up to k; node 0 holds all from before the
origin. So the state at the end of period k is made of node k, of what k becomes without its
lowest digit, and so on down to 0: as many nodes as k has binary ones. A change is in one node for
each digit at most, so a chain of n periods stores each change about log n times, where full
copies store every live row n times. A late change replaces log n nodes instead of all later
periods.

Nodes keep their tombstones. A change without a time, or after the last period, fails the job.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.columns import named
from strata.functions.dates import next_period, period_of, start_of
from strata.operators.merge import retain_last, with_flag
from strata.operators.temporal import spread_periods

_MONTHS = {"month": 1, "quarter": 3, "year": 12}
_DAYS = {"day": 1, "week": 7}
_NEXT = "__next"


def period_number(day: dt.date, origin: dt.date, unit: str = "month") -> int:
    """1 for the period of ``origin``, 2 for the next one."""
    day, origin = start_of(day, unit), start_of(origin, unit)
    if unit in _DAYS:
        return (day - origin).days // _DAYS[unit] + 1
    return ((day.year - origin.year) * 12 + day.month - origin.month) // _MONTHS[unit] + 1


def _number(column: Column, origin: dt.date, unit: str) -> Column:
    start = period_of(column, unit)
    first = start_of(origin, unit)
    if unit in _DAYS:
        return F.floor(F.datediff(start, F.lit(first)) / _DAYS[unit]).cast("long") + 1
    months = (F.year(start) - first.year) * 12 + F.month(start) - first.month
    return F.floor(months / _MONTHS[unit]).cast("long") + 1


def nodes_of(number: int) -> list[int]:
    """The nodes that the state at the end of a period is made of, 0 last."""
    found = []
    while number > 0:
        found.append(number)
        number -= number & -number
    return [*found, 0]


def nodes_with(number: int, last: int) -> list[int]:
    """The nodes up to ``last`` that hold the changes of a period."""
    found, number = [], max(number, 0)
    while number <= last:
        found.append(number)
        if not number:
            break
        number += number & -number
    return found


def _numbered(changes: DataFrame, at: str, origin: dt.date, upto: dt.date, unit: str) -> DataFrame:
    """``changes`` with ``node``, the number of their period, 0 for all before the origin."""
    moment = named(at)
    lost = F.raise_error(F.concat(F.lit(f"{at} is null or after {upto}: "), F.coalesce(moment.cast("string"), F.lit("null"))))
    inside = moment.cast("date") < next_period(period_of(F.lit(upto).cast("date"), unit), unit)
    number = F.greatest(_number(moment, origin, unit), F.lit(0))
    return changes.withColumn("node", F.when(moment.isNotNull() & inside, number).otherwise(lost.cast("long")))


def _sent(df: DataFrame, targets: Iterable[tuple[int, int]]) -> DataFrame:
    """Rows of a node once for each of its targets; (node, target) are few, at most log n for a period."""
    table = df.sparkSession.createDataFrame(list(targets), "of long, target long")
    joined = df.join(F.broadcast(table), named("node") == F.col("of"))
    return joined.drop("of", "node").withColumnRenamed("target", "node")


def _newest(df: DataFrame, keys: Sequence[str], order: Sequence[str], deleted: str | None) -> DataFrame:
    return retain_last(df, keys=[*keys, "node"], order=order, deleted=deleted, keep_tombstones=True)


def _in_nodes(
    numbered: DataFrame, targets: Iterable[tuple[int, int]], keys: Sequence[str], order: Sequence[str], deleted: str | None
) -> DataFrame:
    """The newest row of each key and period, in those target nodes of its period that end before the key's next one.

    What a node holds is so known before rows multiply: nothing is sorted or shuffled after that.
    """
    single = _newest(numbered, keys, order, deleted)
    by_time = Window.partitionBy(*[named(key) for key in keys]).orderBy("node")
    sent = _sent(single.withColumn(_NEXT, F.lead("node").over(by_time)), targets)
    return sent.where(F.col(_NEXT).isNull() | (F.col("node") < F.col(_NEXT))).drop(_NEXT)


def delta_chain(
    changes: DataFrame,
    *,
    keys: Sequence[str],
    order: Sequence[str],
    origin: dt.date,
    upto: dt.date,
    deleted: str | None = None,
    unit: str = "month",
) -> DataFrame:
    """All nodes of the chain in one pass, to be stored partitioned by ``node``.

    The period of a row is that of ``order[0]``. Rows are cut to one per key and period first.
    """
    last = max(period_number(upto, origin, unit), 0)
    targets = [(number, node) for number in range(last + 1) for node in nodes_with(number, last)]
    return _in_nodes(_numbered(changes, order[0], origin, upto, unit), targets, keys, order, deleted)


def snapshots_between(
    chain: DataFrame,
    first: dt.date,
    last: dt.date,
    *,
    keys: Sequence[str],
    order: Sequence[str],
    origin: dt.date,
    deleted: str | None = None,
    unit: str = "month",
    period: str = "period",
) -> DataFrame:
    """The live rows of each period from ``first`` to ``last``; only their nodes are read.

    The state of ``first`` is made of its nodes. What changes after it is told by the rows of
    each later node that are of that node's own period, so every row is shuffled and sorted
    once, by key, and repeated in the periods it lasts for after that.
    """
    start, last = start_of(first, unit), start_of(last, unit)
    begin, end = (period_number(day, origin, unit) for day in (start, last))
    node, moment = named("node"), named(order[0])
    base = node.isin(nodes_of(begin))
    wanted = chain.where(base | ((node > max(begin, 0)) & (node <= end)))
    wanted = wanted.where(base | (_number(moment, origin, unit) == node))
    dated = wanted.withColumn(period, F.when(base, F.lit(start)).otherwise(period_of(moment, unit))).drop("node")
    together = dated.repartition(*[named(key) for key in keys])
    newest = retain_last(together, keys=[*keys, period], order=order, deleted=deleted, keep_tombstones=True)
    return spread_periods(newest, keys, deleted, last, unit, period, keep_tombstones=False)


def snapshot_from_chain(chain: DataFrame, when: dt.date, **options) -> DataFrame:
    """The data as it stood at the end of the period of ``when``, from about log n partitions."""
    return snapshots_between(chain, when, when, period="__period", **options).drop("__period")


def roll_chain(
    chain: DataFrame,
    late: DataFrame,
    *,
    keys: Sequence[str],
    order: Sequence[str],
    origin: dt.date,
    stored_upto: dt.date,
    upto: dt.date | None = None,
    deleted: str | None = None,
    unit: str = "month",
) -> tuple[DataFrame, list[int]]:
    """The nodes that must be replaced after ``late`` rows, and their numbers.

    ``late`` may hold rows of any period up to ``upto``. The numbers of their periods reach the
    driver. A node after ``stored_upto`` is made of stored nodes, so no period is built again
    from its rows.
    """
    upto = max(upto or stored_upto, stored_upto)
    stored_last, last = period_number(stored_upto, origin, unit), period_number(upto, origin, unit)
    arrived = _numbered(with_flag(late, deleted), order[0], origin, upto, unit)
    numbers = [row["node"] for row in arrived.select("node").distinct().collect()]
    touched = {node for number in numbers for node in nodes_with(number, last)} | set(range(stored_last + 1, last + 1))
    sources = {node for node in touched if node <= stored_last}
    for node in touched:
        if node > stored_last:
            low = node - (node & -node)
            sources |= {source for source in nodes_of(stored_last) if low < source}
    if sources:
        kept = chain.where(named("node").isin(sorted(sources)))
        arrived = arrived.unionByName(kept.withColumn("node", F.greatest(_number(named(order[0]), origin, unit), F.lit(0))))
    targets = [(number, node) for number in range(max(last, 0) + 1) for node in nodes_with(number, last) if node in touched]
    return _in_nodes(arrived, targets, keys, order, deleted), sorted(touched)


def rebase_chain(
    chain: DataFrame,
    new_origin: dt.date,
    *,
    keys: Sequence[str],
    order: Sequence[str],
    origin: dt.date,
    upto: dt.date,
    deleted: str | None = None,
    unit: str = "month",
) -> DataFrame:
    """The chain with a later origin: what lies before becomes one node, whose periods can't be told apart any more.

    The changes of a period are those rows of its own node that are of that period.
    """
    own = F.greatest(_number(named(order[0]), origin, unit), F.lit(0)) == named("node")
    return delta_chain(chain.where(own).drop("node"), keys=keys, order=order, origin=new_origin, upto=upto, deleted=deleted, unit=unit)
