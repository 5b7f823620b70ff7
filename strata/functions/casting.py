"""Casting one column to a declared type, matching nested fields by name.

Spark casts a struct by position: ``struct<age,name>`` cast to
``struct<name,age>`` swaps the values. Structs are therefore rebuilt field by
field, guarded so that a null struct stays null instead of turning into a struct
of nulls.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    AtomicType,
    ByteType,
    CharType,
    DataType,
    DecimalType,
    DoubleType,
    FloatType,
    FractionalType,
    IntegerType,
    IntegralType,
    LongType,
    MapType,
    ShortType,
    StringType,
    StructField,
    StructType,
    VarcharType,
)

_LIMITS = {ByteType: 2**7, ShortType: 2**15, IntegerType: 2**31, LongType: 2**63}


def find_field(struct: StructType, name: str, case_sensitive: bool = False) -> StructField | None:
    """The field called ``name``; an exact match wins over one that differs in case."""
    folded = None
    for field in struct.fields:
        if field.name == name:
            return field
        if not case_sensitive and field.name.lower() == name.lower():
            folded = field
    return folded


def _same(source: DataType, target: DataType) -> bool:
    return source.simpleString() == target.simpleString()


def _child(source: StructType, name: str, case_sensitive: bool) -> StructField:
    field = find_field(source, name, case_sensitive)
    if field is None:
        raise ValueError(f"field {name!r} is missing from {source.simpleString()}")
    return field


def _try_cast(column: Column, source: DataType, target: DataType) -> Column:
    """``try_cast``, with the common misfits told beforehand.

    Spark implements ``try_cast`` by catching an exception per misfit, which costs
    microseconds each. A value out of range, or a text without any digit, is
    recognised without one.
    """
    if isinstance(target, (CharType, VarcharType)):
        text = column.cast("string")
        return F.when(F.char_length(text) <= target.length, text)
    attempt = column.try_cast(target)
    if isinstance(source, IntegralType) and type(target) in _LIMITS:
        limit = _LIMITS[type(target)]
        return F.when(column.between(F.lit(-limit), F.lit(limit - 1)), attempt)
    if isinstance(source, StringType) and isinstance(target, (IntegralType, DecimalType)):
        return F.when(column.rlike("[0-9]"), attempt)
    return attempt


def _always_fits(source: DataType, target: DataType) -> bool:
    """Casts that cannot fail, whatever the value."""
    if type(target) is StringType:
        return isinstance(source, AtomicType)
    widths = [ByteType, ShortType, IntegerType, LongType]
    if type(source) in widths and type(target) in widths:
        return widths.index(type(source)) <= widths.index(type(target))
    return isinstance(source, (IntegralType, FloatType)) and isinstance(target, DoubleType)


def _strictly(column: Column, source: DataType, target: DataType) -> Column:
    """The cast, with the failure built in: it does not depend on the session's ANSI mode."""
    if _always_fits(source, target):
        return column.cast(target)
    if not isinstance(source, AtomicType):
        return column.cast(target)
    value = _try_cast(column, source, target)
    kind = target.simpleString()
    misfit = F.raise_error(F.concat(column.cast("string"), F.lit(f" does not fit {kind}"))).cast(_plain(target))
    return F.when(column.isNull() | value.isNotNull(), value).otherwise(misfit)


def _plain(target: DataType) -> DataType:
    return StringType() if isinstance(target, (CharType, VarcharType)) else target


def fit(
    column: Column,
    source: DataType,
    target: DataType,
    lenient: bool = False,
    case_sensitive: bool = False,
) -> Column:
    """``column`` as ``target``. Values that do not fit raise, or become null when lenient."""
    if _same(source, target):
        return column
    if isinstance(source, StructType) and isinstance(target, StructType):
        children = []
        for wanted in target.fields:
            given = _child(source, wanted.name, case_sensitive)
            value = fit(
                column.getField(given.name), given.dataType, wanted.dataType, lenient, case_sensitive
            )
            children.append(value.alias(wanted.name))
        return F.when(column.isNotNull(), F.struct(*children))
    if isinstance(source, ArrayType) and isinstance(target, ArrayType):
        # A cast of the whole collection stays inside generated code.
        if _always_fits(source.elementType, target.elementType):
            return column.cast(target)
        return F.transform(
            column,
            lambda item: fit(item, source.elementType, target.elementType, lenient, case_sensitive),
        )
    if isinstance(source, MapType) and isinstance(target, MapType):
        out = column
        if not _same(source.valueType, target.valueType):
            out = F.transform_values(
                out,
                lambda _, v: fit(v, source.valueType, target.valueType, lenient, case_sensitive),
            )
        if not _same(source.keyType, target.keyType):
            # A map key must not be null, so keys are cast strictly in both modes.
            out = F.transform_keys(
                out, lambda k, _: fit(k, source.keyType, target.keyType, False, case_sensitive)
            )
        return out
    return _try_cast(column, source, target) if lenient else _strictly(column, source, target)


def count_lost(
    column: Column, source: DataType, target: DataType, case_sensitive: bool = False
) -> Column:
    """How many non-null values inside ``column`` a fit would change beyond their type.

    That is, values that a lenient fit turns into null, and numbers that lose a fraction in
    either mode.
    """
    nothing = F.lit(0).cast("long")
    if _same(source, target):
        return nothing
    if isinstance(source, StructType) and isinstance(target, StructType):
        total = nothing
        for wanted in target.fields:
            given = _child(source, wanted.name, case_sensitive)
            total = total + count_lost(
                column.getField(given.name), given.dataType, wanted.dataType, case_sensitive
            )
        return total
    if isinstance(source, ArrayType) and isinstance(target, ArrayType):
        items, old, new = column, source.elementType, target.elementType
    elif isinstance(source, MapType) and isinstance(target, MapType):
        items, old, new = F.map_values(column), source.valueType, target.valueType
    else:
        value = _try_cast(column, source, target)
        lost = column.isNotNull() & value.isNull()
        if isinstance(source, FractionalType) and isinstance(target, (IntegralType, DecimalType)):
            exact = isinstance(target, IntegralType) or isinstance(source, DecimalType)
            if exact:  # a double is hardly ever a decimal exactly
                lost = lost | F.coalesce(value.cast(source) != column, F.lit(False))
        return F.when(lost, F.lit(1)).otherwise(F.lit(0)).cast("long")
    added = F.aggregate(
        items, nothing, lambda acc, item: acc + count_lost(item, old, new, case_sensitive)
    )
    return F.coalesce(added, nothing)
