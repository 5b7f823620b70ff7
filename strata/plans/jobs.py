"""The composed jobs: read, transform, publish. Each publishes with a single write."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.functions.columns import named, quoted
from strata.functions.dates import period_of, start_after, start_of, starts_between
from strata.operators.conform import Declared, conform
from strata.operators.merge import current_state, is_live, merge_into_unique, newest_per_key, with_flag
from strata.operators.product import Enrichment, standardize, wide_product
from strata.operators.temporal import (
    pit_partition,
    pit_snapshots,
    roll_forward_parts,
)
from strata.plans.sizing import sized_for, within
from strata.sources.commits import Version, commit_partitions, read_version
from strata.sources.partitions import (
    Columns,
    among,
    column_list,
    of_partitions,
    partition_folders,
    rebuild_partitions,
    swap_table_partitions,
    value_tuple,
)
from strata.sources.raw import read_raw
from strata.sources.snapshots import (
    latest_version,
    publish_snapshot,
    purge_versions,
    read_snapshot,
)
from strata.sources.storage import Storage
from strata.sources.tables import replace_table


def load_typed_table(
    spark: SparkSession,
    source: str,
    raw_schema: Declared,
    columns: Mapping[str, str | Column],
    dates: Mapping[str, str],
    table: str,
    path: str,
    fmt: str = "json",
) -> DataFrame:
    """Raw files to a typed catalog table, fully replaced."""
    raw = conform(read_raw(spark, source, raw_schema, fmt), raw_schema)
    with sized_for(raw):
        return replace_table(standardize(raw, columns, dates), table, path)


def build_product(
    base: DataFrame, enrichments: Sequence[Enrichment], path: str, keep: int = 2
) -> int:
    """A wide data product, fully replaced; returns the published version."""
    with sized_for(base, *[item.frame for item in enrichments]):
        version = publish_snapshot(wide_product(base, enrichments), path)
    purge_versions(base.sparkSession, path, keep)
    return version


def apply_changes(
    events: DataFrame,
    state_path: str,
    *,
    keys: Sequence[str],
    image: str = "row",
    sequence: Sequence[str] = (),
    deleted: str = "_deleted",
    keep: int = 2,
) -> DataFrame:
    """Change events merged into the published state; returns its live rows.

    Tombstones stay in the stored state, so events that arrive late cannot revive a
    deleted key.
    """
    spark = events.sparkSession
    last = latest_version(spark, state_path)
    existing = None if last is None else read_snapshot(spark, state_path, last)
    with sized_for(events, *([] if existing is None else [existing])):
        merged = current_state(
            events,
            existing,
            keys=keys,
            image=image,
            sequence=sequence,
            deleted=deleted,
            keep_tombstones=True,
            existing_unique=True,
        )
        version = publish_snapshot(merged, state_path)
    purge_versions(spark, state_path, keep)
    return read_snapshot(spark, state_path, version).filter(is_live(deleted)).drop(deleted)


def reprocess(
    source: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    path: str,
    column: Columns,
    affected: Iterable,
) -> list:
    """Rebuild the ``affected`` partitions of a table from the same partitions of ``source``.

    Running it again changes nothing. Returns the partitions that became empty.
    """
    affected = list(affected)
    chosen = of_partitions(source, column, affected)
    with sized_for(chosen):
        return rebuild_partitions(build(chosen), path, column, affected)


def _stored_partitions(
    spark: SparkSession, path: str, column: Columns, folders: Iterable[str], rows: DataFrame, evolve: bool
) -> tuple[DataFrame, DataFrame | None]:
    """``rows`` and the rows of some partition folders, in the same columns.

    The stored ones are read in their own schema. Where that and the one of ``rows`` differ,
    nothing is dropped or made up: it is an error, unless ``evolve`` asks for columns that
    one side lacks to be null there.
    """
    folders = [f"{path.rstrip('/')}/{folder}" for folder in folders]
    if not folders:
        return rows, None
    parts = column_list(column)
    # All footers of the partitions to be read are looked at: older files may have fewer columns.
    inferred = spark.read.option("basePath", path).option("mergeSchema", "true").parquet(*folders).schema
    own = StructType([field for field in inferred.fields if field.name not in parts])
    given = {field.name: field for field in rows.schema.fields}
    for field in own.fields:
        if field.name in given and given[field.name].dataType != field.dataType:
            raise ValueError(f"column {field.name!r} is stored as {field.dataType.simpleString()}")
    lacking = [field for field in own.fields if field.name not in given]
    added = [field for name, field in given.items() if name not in own.names and name not in parts]
    if (lacking or added) and not evolve:
        raise ValueError(
            f"columns differ from the stored ones: missing {[f.name for f in lacking]}, new {[f.name for f in added]}"
        )
    schema = StructType([*own.fields, *added, *[given[name] for name in parts]])
    stored = spark.read.schema(schema).option("basePath", path).parquet(*folders)
    rows = rows.withColumns({field.name: F.lit(None).cast(field.dataType) for field in lacking})
    return rows, stored.select(*[named(name) for name in rows.columns])


def _assert_not_moved(changes: DataFrame, table: DataFrame, column: Columns, keys: Sequence[str], touched: list) -> None:
    """No key of ``changes`` may stand in two partitions, of its own rows or of the table."""
    parts = column_list(column)
    names = [named(key) for key in keys]
    at = changes.select(*names, F.struct(*[named(part) for part in parts]).alias("__at")).distinct()
    if not at.groupBy(*keys).count().filter("count > 1").isEmpty():
        raise ValueError(f"a key of {list(keys)} stands in several partitions of {parts}")
    elsewhere = table.filter(~F.coalesce(_touches(table, parts, touched), F.lit(False))).select(*names)
    if not _found_elsewhere(elsewhere, at.select(*names), keys).isEmpty():
        raise ValueError(f"a key of {list(keys)} is stored in another partition of {parts}")


def _touches(table: DataFrame, parts: list[str], touched: list) -> Column:
    return among([table[quoted(part)] for part in parts], [value_tuple(value) for value in touched])


def _found_elsewhere(stored: DataFrame, keys_of: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored keys that are among some others; these are broadcast if they are few."""
    alias = {key: f"__key_{i}" for i, key in enumerate(keys)}
    small = keys_of.select(*[named(key).alias(alias[key]) for key in keys])
    if within(small):
        small = F.broadcast(small)
    same = reduce(and_, [stored[quoted(key)].eqNullSafe(small[alias[key]]) for key in keys])
    return stored.join(small, same, "left_semi")


def merge_partitions(
    incoming: DataFrame,
    path: str,
    column: Columns,
    *,
    keys: Sequence[str],
    order: Sequence[str],
    deleted: str | None = None,
    order_is_total: bool = False,
    evolve: bool = False,
    follows_key: bool = False,
) -> list:
    """Merge ``incoming`` into a table partitioned by ``column``, touching few partitions.

    For tables too large to be rewritten on each run. ``column`` must follow from the
    key (a creation month, say, or a hash bucket), so that all versions of a row share
    a partition; a key that is found in another one fails the job. That check reads the key
    columns of the table; ``follows_key`` says that it is not needed, as for hash buckets.
    Only the partitions that ``incoming`` touches are read as a whole and rewritten; their
    values, at most as many as there are folders, come to the driver. The table stores the
    delete flag, so merging the same rows again changes nothing. Columns that differ from
    the stored ones fail the job, or become null where they lack with ``evolve``. Returns
    the touched values.

    Readers may see some partitions before and some after the merge. If the driver dies
    while Spark swaps the folders, rows of a partition may be left in the staging folder
    below ``path``; :func:`merge_table_partitions` has no such moment.
    """
    spark = incoming.sparkSession
    changes = with_flag(incoming, deleted)
    touched = _values(changes, column)
    if not touched:
        return []
    storage, parts = Storage(spark, path), column_list(column)
    folders = partition_folders(storage, parts, touched)
    if not follows_key and storage.names():
        # The key columns alone; a table without any folder yet has none to compare with.
        every = spark.read.schema(StructType([changes.schema[name] for name in (*keys, *parts)])).parquet(path)
        _assert_not_moved(changes, every, column, keys, touched)
    changes, stored = _stored_partitions(spark, path, column, folders.values(), changes, evolve)
    with sized_for(changes, *([] if stored is None else [stored])):
        placed, others = _merged(changes, stored, keys, order, deleted, order_is_total)
        rebuild_partitions(others, path, column, touched, in_place=placed)
    return touched


def _merged(
    changes: DataFrame,
    stored: DataFrame | None,
    keys: Sequence[str],
    order: Sequence[str],
    deleted: str | None,
    order_is_total: bool,
) -> tuple[DataFrame | None, DataFrame]:
    newest = newest_per_key(changes, keys, order, deleted, order_is_total)
    return (None, newest) if stored is None else merge_into_unique(newest, stored, keys, order)


def _values(df: DataFrame, column: Columns) -> list:
    """Distinct partition values, as tuples where there are several columns."""
    parts = column_list(column)
    found = [tuple(row) for row in df.select(*[quoted(part) for part in parts]).distinct().collect()]
    return found if len(parts) > 1 else [value for (value,) in found]


def merge_table_partitions(
    incoming: DataFrame,
    table: str,
    column: Columns,
    folder: str,
    *,
    keys: Sequence[str],
    order: Sequence[str],
    deleted: str | None = None,
    order_is_total: bool = False,
    follows_key: bool = False,
) -> list:
    """:func:`merge_partitions` for a catalog table, without overwriting anything.

    The touched partitions are written to the new ``folder`` and switched over in the
    catalog, see :func:`strata.sources.partitions.swap_table_partitions`. The columns must
    be those of the table.
    """
    spark = incoming.sparkSession
    changes = with_flag(incoming, deleted)
    every = spark.table(table)
    if set(every.columns) != set(changes.columns):
        raise ValueError(f"columns differ: {sorted(set(every.columns) ^ set(changes.columns))}")
    touched = _values(changes, column)
    if not touched:
        return []
    if not follows_key:
        _assert_not_moved(changes, every, column, keys, touched)
    stored = of_partitions(every, column, touched).select(*[named(name) for name in changes.columns])
    with sized_for(changes, stored):
        placed, others = _merged(changes, stored, keys, order, deleted, order_is_total)
        swap_table_partitions(others, table, column, touched, folder, in_place=placed)
    return touched


def merge_committed(
    incoming: DataFrame,
    path: str,
    column: Columns,
    *,
    keys: Sequence[str],
    order: Sequence[str],
    deleted: str | None = None,
    order_is_total: bool = False,
    evolve: bool = False,
    follows_key: bool = False,
    attempts: int = 20,
) -> int | None:
    """:func:`merge_partitions` for a table of commits, beside other jobs that write to it.

    Returns the number of the commit, None without incoming rows. If another job replaces one
    of the touched partitions meanwhile, the rows are merged again, into what it left; jobs on
    other partitions are not in the way. The check that no key has moved looks at the whole
    table, so without ``follows_key`` any other job's commit is a reason to look again.
    Tasks have the sizes that the session sets: jobs that size their own wait for each other.
    """
    spark = incoming.sparkSession
    changes = with_flag(incoming, deleted)
    touched = _values(changes, column)
    if not touched:
        return None

    def build(version: Version) -> DataFrame:
        if version.schema is None:
            return _merged(changes, None, keys, order, deleted, order_is_total)[1]
        if not follows_key:
            _assert_not_moved(changes, read_version(spark, path, version), column, keys, touched)
        stored, rows = read_version(spark, path, version, touched), changes
        if evolve:
            rows, stored = _widened(rows, stored), _widened(stored, rows)
        elif set(rows.columns) != set(stored.columns):
            raise ValueError(f"columns differ from the stored ones: {sorted(set(rows.columns) ^ set(stored.columns))}")
        placed, others = _merged(rows, stored.select(*[named(name) for name in rows.columns]), keys, order, deleted, order_is_total)
        return others if placed is None else placed.unionByName(others)

    reads = None if follows_key else "all"
    return commit_partitions(spark, path, column, touched, build, reads=reads, evolve=evolve, attempts=attempts)


def _widened(df: DataFrame, other: DataFrame) -> DataFrame:
    """``df`` with the columns that only ``other`` has, as nulls."""
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in other.schema.fields if f.name not in df.columns})


def load_period(
    incoming: DataFrame,
    path: str,
    current: dt.date,
    *,
    keys: Sequence[str],
    order: Sequence[str],
    deleted: str | None = None,
    unit: str = "month",
    period: str = "period",
    evolve: bool = False,
) -> None:
    """Rebuild the current period's partition of a snapshot table, by ingest time.

    Reads two partitions, the current one and the newest one before it, however long ago
    that was, and writes one. The table stores the delete flag; running the job again
    changes nothing. Columns that differ from the stored ones fail the job, or become null
    where they lack with ``evolve``.
    """
    spark = incoming.sparkSession
    changes = with_flag(incoming, deleted)
    now = start_of(current, unit)
    folders = _periods(spark, path, period)
    earlier = max((start for start in folders if start < now), default=None)
    chosen = [folders[start] for start in (earlier, now) if start in folders]
    dated = changes.withColumn(period, F.lit(now).cast("date"))
    dated, stored = _stored_partitions(spark, path, period, chosen, dated, evolve)
    changes = dated.drop(period)

    def of(start: dt.date | None) -> DataFrame:
        if stored is None or start not in folders:
            return changes.limit(0)
        return of_partitions(stored, period, [start]).drop(period)

    previous, present = of(earlier), of(now)
    with sized_for(changes, previous, present):
        rebuilt = pit_partition(
            changes, previous, present, keys=keys, order=order, deleted=deleted, keep_tombstones=True
        )
        rebuilt = rebuilt.withColumn(period, F.lit(now).cast("date"))
        rebuild_partitions(rebuilt, path, period, [now])


def _periods(spark: SparkSession, path: str, period: str) -> dict[dt.date, str]:
    """Folder of each stored period."""
    found = partition_folders(Storage(spark, path), [period])
    return {dt.date.fromisoformat(text): folder for (text,), folder in found.items()}


def roll_snapshots(
    late: DataFrame,
    path: str,
    upto: dt.date,
    *,
    keys: Sequence[str],
    order: Sequence[str],
    deleted: str | None = None,
    unit: str = "month",
    period: str = "period",
    order_is_total: bool = False,
    evolve: bool = False,
) -> list[dt.date]:
    """Merge ``late`` into a snapshot table and roll it forward to the period ``upto``.

    Rebuilds the partitions from the earliest affected one on, and leaves older ones
    alone. Every period up to ``upto`` gets its snapshot, also one without changes and also
    if there are no late rows at all. Without a table yet, all are built. The table stores
    the delete flag; running the job again changes nothing. Columns that differ from the
    stored ones fail the job, or become null where they lack with ``evolve``. Returns the
    periods that were written.
    """
    spark = late.sparkSession
    changes = with_flag(late, deleted)
    moment = named(order[0])
    dates = changes.select(period_of(moment, unit).alias("at"))
    first, newest, undated = dates.agg(F.min("at"), F.max("at"), F.count_if(F.col("at").isNull())).first()
    if undated:
        raise ValueError(f"{undated} rows have no {order[0]}")
    folders = _periods(spark, path, period)
    if first is None and not folders:
        return []
    upto = start_of(upto, unit)
    stored_upto = max(folders, default=None)
    upto = max(upto, stored_upto or upto)
    if newest is not None and newest > upto:
        raise ValueError(f"rows of {newest} lie after the last period {upto}")
    how = {"keys": keys, "order": order, "deleted": deleted, "unit": unit, "period": period, "order_is_total": order_is_total}
    placed = None
    if stored_upto:
        following = start_after(stored_upto, unit)
        first = following if first is None else min(first, following)
        # The last stored period is also where later ones are filled from.
        needed = [folder for start, folder in sorted(folders.items()) if start >= min(first, stored_upto)]
        dated = changes.withColumn(period, period_of(moment, unit))
        dated, stored = _stored_partitions(spark, path, period, needed, dated, evolve)
        changes = dated.drop(period)
        placed, rolled = roll_forward_parts(stored, changes, stored_upto=stored_upto, upto=upto, first=first, **how)
    else:
        rolled = pit_snapshots(changes, upto=upto, keep_tombstones=True, **how)
    written = starts_between(first, upto, unit)
    with sized_for(changes, rolled):
        rebuild_partitions(rolled, path, period, written, in_place=placed)
    return written
