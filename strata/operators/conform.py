"""Make a frame match a declared schema, at its edges or around a transform."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import wraps
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from strata.functions.columns import named
from strata.functions.casting import count_lost, find_field, fit

# A schema, its DDL text, or a function that gives one of them when it is needed.
Declared = StructType | str | Callable[[], "StructType | str"]


def resolve_schema(declared: Declared) -> StructType:
    if callable(declared) and not isinstance(declared, StructType):
        declared = declared()
    if isinstance(declared, str):
        return StructType.fromDDL(declared)
    if not isinstance(declared, StructType):
        raise TypeError(f"not a schema: {declared!r}")
    return declared


def table_schema(spark: SparkSession, table: str) -> StructType:
    """The catalog's schema of ``table``, partition columns included (and last)."""
    return spark.table(table).schema


def schema_from_columns(columns: Iterable[tuple[str, str] | Mapping[str, str]]) -> StructType:
    """Schema from a column list as catalogs and table templates write it.

    Each column is a ``(name, type)`` pair or a mapping with ``Name`` and ``Type``
    (and, if present, ``Comment``). A type is any Spark DDL type.
    """
    schema = StructType()
    for column in columns:
        if isinstance(column, Mapping):
            name, kind, comment = column["Name"], column["Type"], column.get("Comment")
        else:
            (name, kind), comment = column, None
        metadata = {"comment": comment} if comment else None
        schema = schema.add(StructField(name, DataType.fromDDL(kind), True, metadata))
    return schema


def _case_sensitive(df: DataFrame) -> bool:
    return str(df.sparkSession.conf.get("spark.sql.caseSensitive", "false")).lower() == "true"


def _check_mode(mode: str) -> bool:
    if mode not in ("strict", "lenient"):
        raise ValueError(f"mode is 'strict' or 'lenient', not {mode!r}")
    return mode == "lenient"


def conform(df: DataFrame, schema: Declared, mode: str = "strict") -> DataFrame:
    """Exactly the declared columns, in declared order, in the declared types.

    One projection, so the scan below reads only these columns. A missing column
    fails analysis. In strict mode a value that does not fit fails the job, whatever the
    session's ANSI setting; in lenient mode it becomes null. A number keeps its whole part
    where the declared type has no fraction, in both modes; :func:`conform_losses` counts
    these cases too.
    """
    lenient = _check_mode(mode)
    exact = _case_sensitive(df)
    cells: list[Column] = []
    for wanted in resolve_schema(schema).fields:
        cell = named(wanted.name)
        given = find_field(df.schema, wanted.name, exact)
        if given is not None:
            cell = fit(cell, given.dataType, wanted.dataType, lenient, exact)
        cells.append(cell.alias(wanted.name))
    return df.select(*cells)


def conform_losses(df: DataFrame, schema: Declared) -> DataFrame:
    """Rows ``(column_name, lost)``: how many values become null in a lenient conform, or lose a fraction.

    One pass over the declared columns, reduced on the map side.
    """
    exact = _case_sensitive(df)
    totals, pairs = [], []
    for index, wanted in enumerate(resolve_schema(schema).fields):
        given = find_field(df.schema, wanted.name, exact)
        if given is None:
            raise ValueError(f"column {wanted.name!r} is missing")
        lost = count_lost(named(given.name), given.dataType, wanted.dataType, exact)
        totals.append(F.coalesce(F.sum(lost), F.lit(0)).alias(f"c{index}"))
        pairs.append(
            F.struct(F.lit(wanted.name).alias("column_name"), F.col(f"c{index}").alias("lost"))
        )
    return df.agg(*totals).select(F.inline(F.array(*pairs)))


def with_schema(schema: Declared, mode: str = "strict") -> Callable:
    """Decorator: conform every frame argument, positional or by keyword, before the call."""

    def decorate(function: Callable) -> Callable:
        @wraps(function)
        def wrapped(*args: Any, **kwargs: Any) -> Any:
            declared = resolve_schema(schema)

            def fitted(value: Any) -> Any:
                return conform(value, declared, mode) if isinstance(value, DataFrame) else value

            return function(
                *map(fitted, args), **{name: fitted(value) for name, value in kwargs.items()}
            )

        return wrapped

    return decorate

