"""Catalog tables, conformed when read and when written."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from strata.operators.conform import Declared, conform, resolve_schema, table_schema
from strata.sources.partitions import spread_by
from strata.sources.snapshots import publish_snapshot, purge_versions, version_path


def read_conformed(
    spark: SparkSession, table: str, schema: Declared | None = None, mode: str = "strict"
) -> DataFrame:
    """A catalog table in the declared schema; only the declared columns are read."""
    df = spark.table(table)
    return df if schema is None else conform(df, schema, mode)


def write_conformed(
    df: DataFrame,
    table: str,
    schema: Declared | None = None,
    mode: str = "strict",
    overwrite: bool = False,
) -> DataFrame:
    """Write ``df`` to a catalog table, conformed to ``schema`` or to the table's own.

    Columns are matched by name, whatever their order in ``schema``, which must have all
    columns of the table and no others. It appends, or replaces the table's rows, and
    returns a read of the table in the order of ``schema``. Rows of a partitioned table are
    gathered by partition first. A table that ``df`` itself reads cannot be replaced this
    way; see :func:`replace_table`.
    """
    spark = df.sparkSession
    own = table_schema(spark, table)
    fitted = _for_table(df, own, schema, mode)
    parts = [column.name for column in spark.catalog.listColumns(table) if column.isPartition]
    gathered = spread_by(fitted, *parts) if parts else fitted
    gathered.write.insertInto(table, overwrite=overwrite)
    return read_conformed(spark, table, schema, mode)


def _for_table(df: DataFrame, own: StructType, schema: Declared | None, mode: str) -> DataFrame:
    """``df`` conformed to ``schema``, then to the columns of the table in the table's order."""
    if schema is None:
        return conform(df, own, mode)
    declared = resolve_schema(schema)
    # The catalog folds the case of names.
    wanted, given = ({name.lower() for name in kind.names} for kind in (own, declared))
    if wanted != given:
        raise ValueError(f"not in the table: {sorted(given - wanted)}; not declared: {sorted(wanted - given)}")
    return conform(conform(df, declared, mode), own, mode)


def replace_table(
    df: DataFrame,
    table: str,
    path: str,
    schema: Declared | None = None,
    mode: str = "strict",
    keep: int = 2,
) -> DataFrame:
    """Replace the whole content of an unpartitioned external table, even one that ``df`` reads.

    The rows go to a new version folder below ``path``, and the catalog is pointed at
    it when they are complete. Readers see the old rows or the new ones. Versions
    older than the last ``keep`` are removed; that number must cover the longest
    running reader.
    """
    spark = df.sparkSession
    if any(column.isPartition for column in spark.catalog.listColumns(table)):
        raise ValueError(f"{table} is partitioned; rebuild its partitions instead")
    fitted = _for_table(df, table_schema(spark, table), schema, mode)
    version = publish_snapshot(fitted, path)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{version_path(path, version)}'")
    spark.catalog.refreshTable(table)
    purge_versions(spark, path, keep)
    return read_conformed(spark, table, schema, mode)


def reads_table(table: str, schema: Declared | None = None, mode: str = "strict") -> Callable:
    """Decorator: pass the conformed table as first argument."""

    def decorate(function: Callable) -> Callable:
        @wraps(function)
        def wrapped(*args: Any, **kwargs: Any) -> Any:
            frame = read_conformed(SparkSession.active(), table, schema, mode)
            return function(frame, *args, **kwargs)

        return wrapped

    return decorate


def writes_table(
    table: str, schema: Declared | None = None, mode: str = "strict", overwrite: bool = False
) -> Callable:
    """Decorator: write the returned frame to the table, and return a read of the table."""

    def decorate(function: Callable) -> Callable:
        @wraps(function)
        def wrapped(*args: Any, **kwargs: Any) -> DataFrame:
            return write_conformed(function(*args, **kwargs), table, schema, mode, overwrite)

        return wrapped

    return decorate
