"""Rebuild some partitions of a table and leave the others alone.

A partition is named by a value, or by a tuple of values where a table is partitioned by
several columns.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_, or_
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.columns import named, quoted
from strata.sources.storage import Storage

_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"

Columns = str | Sequence[str]


def spread_by(df: DataFrame, *columns: str) -> DataFrame:
    """Gather rows by partition column before a partitioned write.

    Few tasks write to each folder, which avoids small files. The hint, unlike a
    plain repartitioning, lets Spark split a folder that holds a large share of all
    rows over several tasks, and join small ones.
    """
    return df.hint("rebalance", *columns)


def column_list(column: Columns) -> list[str]:
    return [column] if isinstance(column, str) else list(column)


def value_tuple(value: object) -> tuple:
    return value if isinstance(value, tuple) else (value,)


def _value_text(value: object) -> str:
    """A partition value the way Spark spells it in folder names, before escaping."""
    if value is None:
        return _NULL_FOLDER
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, dt.datetime):
        text = str(value)
        return text.rstrip("0") if value.microsecond else text
    return str(value)


def _texts(value: object) -> tuple[str, ...]:
    return tuple(_value_text(part) for part in value_tuple(value))


def of_partitions(df: DataFrame, column: Columns, values: Iterable) -> DataFrame:
    """Rows of some partitions; the filter is on literals, so other folders are not read."""
    names = column_list(column)
    return df.filter(among([df[quoted(name)] for name in names], [value_tuple(v) for v in values]))


def among(cells: list[Column], values: list[tuple]) -> Column:
    if not values:
        return F.lit(False)
    if len(cells) == 1:
        chosen = cells[0].isin([value for (value,) in values if value is not None])
        return (chosen | cells[0].isNull()) if (None,) in values else chosen
    rest: dict[object, list[tuple]] = {}
    for first, *others in values:
        rest.setdefault(first, []).append(tuple(others))
    return reduce(or_, [and_(cells[0].eqNullSafe(F.lit(v)), among(cells[1:], some)) for v, some in rest.items()])


def partition_folders(storage: Storage, names: Sequence[str], wanted: Iterable | None = None) -> dict[tuple[str, ...], str]:
    """Folder of each partition below the root, by the texts of its values; only ``wanted`` ones if given."""
    chosen = None if wanted is None else {_texts(value) for value in wanted}
    found = {(): ""}
    for depth, column in enumerate(names):
        deeper = {}
        for texts, folder in found.items():
            for child in storage.names(*filter(None, [folder])):
                name, _, value = child.partition("=")
                here = (*texts, unquote(value))
                if unquote(name) == column and (chosen is None or any(w[: depth + 1] == here for w in chosen)):
                    deeper[here] = f"{folder}/{child}" if folder else child
        found = deeper
    return found


def _files(storage: Storage, folders: dict[tuple[str, ...], str]) -> dict[tuple[str, ...], tuple[str, set[str]]]:
    """Folder and data files of partitions."""
    return {
        texts: (folder, {f for f in storage.names(folder) if not f.startswith(("_", "."))})
        for texts, folder in folders.items()
    }


def _ordered(affected: Iterable) -> list:
    return sorted(set(affected), key=lambda value: [(part is not None, part) for part in value_tuple(value)])


def _emptied(affected: list, before: dict, after: dict) -> list:
    """Partitions that still hold a file from before the rebuild."""
    nothing = ("", set())
    return [v for v in affected if after.get(_texts(v), nothing)[1] & before.get(_texts(v), nothing)[1]]


def rebuild_partitions(
    df: DataFrame, path: str, column: Columns, affected: Iterable, in_place: DataFrame | None = None
) -> list:
    """Replace the ``affected`` partitions below ``path`` by the rows of ``df``.

    Only affected partitions are written, and a repeated run gives the same table.
    ``df`` may read the table itself: Spark stages the new files and swaps the folders
    when all are written. Dynamic overwrite keeps the old rows of a partition that
    has become empty, so those are removed afterwards; they are told by still holding
    a file from before. Returns the removed partition values.

    ``in_place`` are further rows, which already come partition by partition because they
    are read from the table: they are written as they come and not shuffled.
    """
    names, affected = column_list(column), _ordered(affected)
    if not affected:
        return []
    storage = Storage(df.sparkSession, path)
    before = _files(storage, partition_folders(storage, names, affected))
    writer = _gathered(df, names, affected, in_place).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(*names).parquet(path)
    emptied = _emptied(affected, before, _files(storage, partition_folders(storage, names, affected)))
    for value in emptied:
        storage.remove(before[_texts(value)][0])
    return emptied


def _gathered(df: DataFrame, names: list[str], affected: list, in_place: DataFrame | None) -> DataFrame:
    spread = spread_by(of_partitions(df, names, affected), *names)
    return spread if in_place is None else of_partitions(in_place, names, affected).unionByName(spread)


def catalog_folders(spark: SparkSession, table: str) -> dict[tuple[str, ...], str]:
    """Where the catalog says each partition of a table is, by the texts of its values."""
    state = spark._jsparkSession.sessionState()
    identifier = state.sqlParser().parseTableIdentifier(table)
    every = state.catalog().listPartitions(identifier, spark._jvm.scala.Option.apply(None))
    names = [column.name for column in spark.catalog.listColumns(table) if column.isPartition]
    found = {}
    for i in range(every.size()):
        part = every.apply(i)
        texts = tuple(part.spec().get(name).get() for name in names)
        found[texts] = unquote(part.location().toString())
    return found


def _catalog_files(spark: SparkSession, table: str, affected: list) -> dict[tuple[str, ...], tuple[str, set[str]]]:
    wanted = {_texts(value) for value in affected}
    return {
        texts: (folder, {f for f in Storage(spark, folder).names() if not f.startswith(("_", "."))})
        for texts, folder in catalog_folders(spark, table).items()
        if texts in wanted
    }


def rebuild_table_partitions(df: DataFrame, table: str, column: Columns, affected: Iterable) -> list:
    """The same for a catalog table partitioned by ``column``, wherever its partitions are."""
    names, affected = column_list(column), _ordered(affected)
    if not affected:
        return []
    spark = df.sparkSession
    before = _catalog_files(spark, table, affected)
    columns = [quoted(name) for name in spark.table(table).columns]
    rebuilt = _gathered(df.select(*columns), names, affected, None)
    name = "spark.sql.sources.partitionOverwriteMode"
    previous = spark.conf.get(name)
    spark.conf.set(name, "dynamic")
    try:
        rebuilt.write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(name, previous)
    emptied = _emptied(affected, before, _catalog_files(spark, table, affected))
    if emptied:
        specs = ", ".join(_partition_spec(names, value) for value in emptied)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {specs}")
        for value in emptied:
            parent, _, leaf = before[_texts(value)][0].rstrip("/").rpartition("/")
            Storage(spark, parent).remove(leaf)
    spark.catalog.refreshTable(table)
    return emptied


def _partition_spec(names: list[str], value: object) -> str:
    cells = []
    for name, part in zip(names, value_tuple(value), strict=True):
        text = "null" if part is None else "'" + _value_text(part).replace("\\", "\\\\").replace("'", "\\'") + "'"
        cells.append(f"{quoted(name)} = {text}")
    return f"PARTITION ({', '.join(cells)})"


def swap_table_partitions(
    df: DataFrame,
    table: str,
    column: Columns,
    affected: Iterable,
    folder: str,
    in_place: DataFrame | None = None,
) -> list:
    """Replace partitions of a catalog table by pointing the catalog at new folders.

    The rows are written to ``folder``, which must be a new one, and each partition is
    switched to its new place when all are complete. Nothing is overwritten: a job that
    dies at any point leaves every partition with its old rows or its new ones, and
    running it again with another folder completes it. Old folders stay until
    :func:`purge_swapped` removes them. Returns the emptied partitions. ``in_place`` is as
    in :func:`rebuild_partitions`.
    """
    names, affected = column_list(column), _ordered(affected)
    if not affected:
        return []
    spark = df.sparkSession
    storage = Storage(spark, folder)
    if storage.names():
        raise FileExistsError(f"{folder} is not empty")
    columns = [quoted(name) for name in spark.table(table).columns]
    placed = None if in_place is None else in_place.select(*columns)
    _gathered(df.select(*columns), names, affected, placed).write.partitionBy(*names).parquet(folder)
    written = partition_folders(storage, names, affected)
    known = catalog_folders(spark, table)
    fresh, emptied = [], []
    for value in affected:
        spec = _partition_spec(names, value)
        if _texts(value) not in written:
            emptied.append(value)
            continue
        place = f"{folder.rstrip('/')}/{written[_texts(value)]}".replace("'", "\\'")
        if _texts(value) in known:
            spark.sql(f"ALTER TABLE {table} {spec} SET LOCATION '{place}'")
        else:
            fresh.append(f"{spec} LOCATION '{place}'")
    if fresh:  # one statement for all
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(fresh)}")
    if emptied:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(_partition_spec(names, v) for v in emptied)}")
    spark.catalog.refreshTable(table)
    return emptied


def purge_swapped(spark: SparkSession, table: str, root: str) -> list[str]:
    """Remove partition folders below ``root`` that the catalog no longer points to; returns them.

    ``root`` holds the folders that :func:`swap_table_partitions` wrote to, each with its
    partitions. Call it when no reader of the older folders is left.
    """
    names = [column.name for column in spark.catalog.listColumns(table) if column.isPartition]

    def plain(path: str) -> str:
        return "/" + path.split(":", 1)[-1].strip("/")

    used = {plain(folder) for folder in catalog_folders(spark, table).values()}
    removed = []
    for written in Storage(spark, root).names():
        if written.startswith(("_", ".")):
            continue
        base = f"{root.rstrip('/')}/{written}"
        storage = Storage(spark, base)
        folders = partition_folders(storage, names)
        stale = [folder for folder in folders.values() if plain(f"{base}/{folder}") not in used]
        for folder in stale:
            storage.remove(folder)
            removed.append(f"{base}/{folder}")
        if folders and len(stale) == len(folders):
            Storage(spark, root).remove(written)
    return removed
