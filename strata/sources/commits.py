"""Partitioned tables that several jobs may write at once.

A job writes its partitions to a folder of its own, which nobody reads yet, and then adds one
commit: a small file with the next number that names the partitions it has replaced and where
they are now. Only one job can create a number. A job that finds its number taken looks at what
the commits since its own reading have replaced: if that is nothing it has read, its rows stand
and it takes the next number; else it builds its rows again from the newest version. So jobs on
different partitions don't wait for each other, jobs on the same ones take effect one after the
other, and a job that dies leaves no trace but a folder that :func:`purge_commits` removes.

A version is the table after so many commits. Commits hold names of partitions, never rows, and
every so many commits one names all partitions of the table, so that few are read.
"""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from strata.functions.columns import named
from strata.sources.partitions import Columns, _texts, column_list, partition_folders, spread_by
from strata.sources.storage import Storage

_COMMITS = "_commits"
_DATA = "data"
_WRITE = "__write"
_FULL = 50  # every so many commits one names all partitions

Texts = tuple[str, ...]


class CommitConflict(RuntimeError):
    """Others have changed what the rows depend on, each time they were built."""


@dataclass(frozen=True)
class Version:
    """The table after ``number`` commits: where each partition is."""

    number: int = 0
    columns: tuple[str, ...] = ()
    schema: StructType | None = None
    folders: dict[Texts, str] = field(default_factory=dict)


def _name(number: int) -> str:
    return f"{number:012d}"


def _numbers(storage: Storage) -> list[int]:
    return sorted(int(name) for name in storage.names(_COMMITS) if name.isdigit())


def _record(storage: Storage, number: int) -> dict:
    return json.loads(storage.read_text(_COMMITS, _name(number)))


def table_version(spark: SparkSession, path: str, number: int | None = None) -> Version:
    """The newest version of the table at ``path``, or that of a number; 0 is the empty table."""
    storage = Storage(spark, path)
    known = _numbers(storage)
    if number is None:
        number = known[-1] if known else 0
    elif number and number not in known:
        raise KeyError(f"{path} has no version {number}")
    changes, folders = [], {}
    for n in range(number, 0, -1):
        record = _record(storage, n)
        changes.append(record)
        if record["full"]:
            break
    for record in reversed(changes):
        if record["full"]:
            folders = {}
        for cells, folder in record["folders"]:
            folders[tuple(cells)] = folder
        for cells in record["emptied"]:
            folders.pop(tuple(cells), None)
    if not changes:
        return Version()
    return Version(number, tuple(changes[0]["columns"]), StructType.fromJson(changes[0]["schema"]), folders)


def read_version(
    spark: SparkSession, path: str, version: Version | int | None = None, partitions: Iterable | None = None
) -> DataFrame:
    """The rows of a version, by default the newest, or only those of some ``partitions`` of it.

    Other folders are not even listed. An empty table that has never been written has no
    columns, so that is an error.
    """
    if not isinstance(version, Version):
        version = table_version(spark, path, version)
    if version.schema is None:
        raise FileNotFoundError(f"nothing is committed at {path}")
    folders = version.folders
    if partitions is not None:
        wanted = {_texts(value) for value in partitions}
        folders = {texts: folder for texts, folder in folders.items() if texts in wanted}
    if not folders:
        return spark.createDataFrame([], version.schema)
    base = f"{path.rstrip('/')}/{_DATA}"
    read = spark.read.schema(version.schema).option("basePath", base)
    return read.parquet(*[f"{base}/{folder}" for folder in folders.values()]).select(*[named(n) for n in version.schema.names])


def _settled(rows: DataFrame, version: Version, parts: list[str], evolve: bool) -> StructType:
    """The table's schema with these rows; other columns than it has are refused or added."""
    if version.schema is None:
        return StructType.fromJson(json.loads(rows.schema.json()))
    if list(version.columns) != parts:
        raise ValueError(f"the table is partitioned by {list(version.columns)}, not {parts}")
    known = {f.name: f.dataType for f in version.schema.fields}
    for f in rows.schema.fields:
        if f.name in known and known[f.name] != f.dataType:
            raise ValueError(f"column {f.name!r} is stored as {known[f.name].simpleString()}")
    added = [f for f in rows.schema.fields if f.name not in known]
    lacking = sorted(set(known) - set(rows.columns))
    if (added or lacking) and not evolve:
        raise ValueError(f"columns differ from the stored ones: missing {lacking}, new {[f.name for f in added]}")
    return StructType([*version.schema.fields, *added])


def _write(rows: DataFrame, path: str, parts: list[str], touched: set[Texts]) -> tuple[str, dict[Texts, str]]:
    """The rows in a folder of their own; its name, and the folder of each partition."""
    write = f"{_WRITE}=w{uuid.uuid4().hex}"
    folder = f"{path.rstrip('/')}/{_DATA}/{write}"
    spread_by(rows, *parts).write.partitionBy(*parts).parquet(folder)
    found = partition_folders(Storage(rows.sparkSession, folder), parts)
    beyond = sorted(set(found) - touched)
    if beyond:
        Storage(rows.sparkSession, f"{path.rstrip('/')}/{_DATA}").remove(write)
        raise ValueError(f"{len(beyond)} partitions have rows but are not replaced, such as {beyond[0]}")
    return write, {texts: f"{write}/{name}" for texts, name in found.items()}


def commit_partitions(
    spark: SparkSession,
    path: str,
    column: Columns,
    replaced: Iterable,
    build: Callable[[Version], DataFrame],
    *,
    reads: Iterable | None = None,
    evolve: bool = False,
    attempts: int = 20,
) -> int:
    """Replace the partitions ``replaced`` by the rows that ``build`` makes of a version; returns the new number.

    ``build`` is called with the newest version, and again with a newer one if another job has
    meanwhile replaced a partition that the rows depend on: those of ``replaced`` and of
    ``reads``, or any if ``reads`` is ``"all"`` (a string). It must depend on nothing else in the
    table. A replaced partition without rows is gone. Rows of other partitions fail the job, and
    so do other columns than the stored ones, unless ``evolve`` adds them (null in older rows, and
    what the rows lack is null there). Nothing is visible before the commit and all of it after.
    After ``attempts`` buildings in vain :class:`CommitConflict` is raised.
    """
    parts, touched = column_list(column), {_texts(value) for value in replaced}
    every = isinstance(reads, str)
    depends = touched | (set() if every or reads is None else {_texts(value) for value in reads})
    storage = Storage(spark, path)
    for attempt in range(attempts):
        if attempt:  # not all at once again
            time.sleep(min(2.0, 0.05 * 2**attempt) * (uuid.uuid4().int % 1000) / 1000)
        version = table_version(spark, path)
        rows = build(version)
        schema = _settled(rows, version, parts, evolve)
        write, folders = _write(rows, path, parts, touched)
        number = version.number + 1
        while True:
            emptied = sorted(touched - set(folders))
            record = {"columns": parts, "schema": json.loads(schema.json()), "write": write, "touched": sorted(touched)}
            if number % _FULL:
                record |= {"full": False, "folders": sorted(folders.items()), "emptied": emptied}
            else:
                before = table_version(spark, path, number - 1).folders
                whole = {k: v for k, v in before.items() if k not in touched} | folders
                record |= {"full": True, "folders": sorted(whole.items()), "emptied": []}
            if storage.create_text(json.dumps(record), _COMMITS, _name(number)):
                return number
            other = _record(storage, number)
            changed = {tuple(texts) for texts in other["touched"]}
            same = version.schema is not None and other["schema"] == json.loads(version.schema.json())
            if every or changed & depends or not same:
                break
            number += 1
        storage.remove(_DATA, write)
    raise CommitConflict(f"{path}: others have changed what the rows depend on, {attempts} times")


def purge_commits(spark: SparkSession, path: str, keep: int = 2, idle: dt.timedelta = dt.timedelta(days=1)) -> list[str]:
    """Remove folders that none of the newest ``keep`` versions reads; returns the removed ones.

    Folders without a commit are those of jobs that died or still run; they go if nothing was
    changed in them for ``idle``, which must be longer than any job takes. Commits stay, as do
    the numbers; a version whose folders are gone can no longer be read.
    """
    if keep < 1:
        raise ValueError("keep at least one version")
    storage = Storage(spark, path)
    names = storage.names(_DATA)  # before the commits: what is committed from now on is not among them
    last = table_version(spark, path)
    oldest = max(last.number - keep + 1, 1)
    used = {folder for n in range(oldest, last.number + 1) for folder in table_version(spark, path, n).folders.values()}
    committed = {_record(storage, n)["write"] for n in _numbers(storage)}
    now, removed = time.time() * 1000, []
    for write in names:
        if not write.startswith(f"{_WRITE}="):
            continue
        if write not in committed:
            if now - storage.changed_at(_DATA, write) > idle.total_seconds() * 1000:
                storage.remove(_DATA, write)
                removed.append(write)
            continue
        parts = [f"{write}/{name}" for name in partition_folders(Storage(spark, f"{path.rstrip('/')}/{_DATA}/{write}"), last.columns).values()]
        stale = [folder for folder in parts if folder not in used]
        if len(stale) == len(parts):
            storage.remove(_DATA, write)
        else:
            for folder in stale:
                storage.remove(_DATA, *folder.split("/"))
        removed += stale
    return sorted(removed)
