"""Typed tables, and wide data products with a fixed grain."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import named, quoted
from strata.functions.dates import parse_date
from strata.operators.grain import assert_grain
from strata.plans.sizing import broadcasts_anyway
from strata.plans.skew import hot_keys, hot_keys_counted, key_kinds, lookup_join, shares_of
from strata.session import cut_lineage

_ROWS = "__rows"


def standardize(
    df: DataFrame,
    columns: Mapping[str, str | Column],
    dates: Mapping[str, str] | None = None,
    strict: bool = False,
) -> DataFrame:
    """Project, rename and parse raw columns into a typed table.

    ``columns`` maps each output name to an input column (or expression), in output
    order; ``dates`` names the outputs to parse, with their pattern.
    """
    cells = []
    for name, given in columns.items():
        cell = named(given) if isinstance(given, str) else given
        if dates and name in dates:
            cell = parse_date(cell, dates[name], strict)
        cells.append(cell.alias(name))
    return df.select(*cells)


@dataclass(frozen=True)
class Enrichment:
    """Attributes to add to a product.

    ``on`` maps product columns to columns of ``frame``; ``columns`` maps new product
    columns to columns (or expressions) of ``frame``. ``unique=True`` checks that
    ``frame`` has one row per key, as a repeated key would change the grain.
    """

    frame: DataFrame
    on: Mapping[str, str]
    columns: Mapping[str, str | Column] = field(default_factory=dict)
    unique: bool = True
    split_hot: bool | None = None


def wide_product(base: DataFrame, enrichments: Sequence[Enrichment]) -> DataFrame:
    """``base`` with related attributes added by left outer joins; its rows stay as they are.

    Small sides are broadcast by Spark. For larger ones hot keys are spread over several
    tasks, see :mod:`strata.plans.skew`; one pass over ``base`` finds them for all lookups
    whose keys are columns of ``base``. For keys that an earlier lookup adds, the rows of
    ``base`` are counted by the columns that lead there, and the counts follow the lookups,
    so hot ones (and rows left without a match) are known before any wide row moves.
    """
    sides = []
    for item in enrichments:
        keys = [f"__key_{i}" for i in range(len(item.on))]
        pairs = zip(item.on.values(), keys, strict=True)
        attributes = item.frame.select(
            *[named(name).alias(key) for name, key in pairs],
            *[
                (named(given) if isinstance(given, str) else given).alias(name)
                for name, given in item.columns.items()
            ],
        )
        if item.unique:
            assert_grain(attributes.filter(F.col(keys[0]).isNotNull()), keys)
        sides.append((item, attributes, dict(zip(item.on, keys, strict=True))))
    hot = _hot_keys_of_base(base, sides) | _hot_keys_added(base, sides)
    result = base
    for i, (item, attributes, on) in enumerate(sides):
        split = i in hot or bool(item.split_hot)
        result = lookup_join(result, attributes, on, split_hot=split, hot=hot.get(i))
    return result


def _hot_keys_of_base(base: DataFrame, sides: Sequence[tuple]) -> dict[int, dict[int, int]]:
    """Hot keys of the lookups that need them and whose keys are in ``base``, by their number."""
    wanted = {}
    for i, (item, attributes, on) in enumerate(sides):
        if item.split_hot is False or not set(item.on) <= set(base.columns):
            continue
        kinds = key_kinds(base, attributes, on)
        if kinds is not None and (item.split_hot or not broadcasts_anyway(attributes)):
            wanted[i] = (list(item.on), kinds)
    if not wanted:
        return {}
    found = hot_keys(base, [keys for keys, _ in wanted.values()], [kinds for _, kinds in wanted.values()])
    return dict(zip(wanted, found, strict=True))


def _hot_keys_added(base: DataFrame, sides: Sequence[tuple]) -> dict[int, dict[int, int]]:
    """Hot keys of the lookups that need them and whose keys earlier lookups add, by their number."""
    wanted = {
        i
        for i, (item, attributes, _) in enumerate(sides)
        if item.split_hot is not False
        and not set(item.on) <= set(base.columns)
        and (item.split_hot or not broadcasts_anyway(attributes))
    }
    if not wanted:
        return {}
    # Which columns are needed before each lookup, found from the last one backwards.
    needed: list[set[str]] = [set() for _ in range(max(wanted) + 2)]
    for i in range(max(wanted), -1, -1):
        item = sides[i][0]
        added = needed[i + 1] & set(item.columns)
        needed[i] = (needed[i + 1] - added) | (set(item.on) if added or i in wanted else set())

    def summed(df: DataFrame, columns: set[str], rows: Column) -> DataFrame:
        return df.groupBy(*[named(name) for name in sorted(columns)]).agg(rows.alias(_ROWS))

    counted = cut_lineage(summed(base, needed[0], F.count(F.lit(1))))
    total = counted.agg(F.sum(_ROWS)).first()[0] or 0
    shares, found = shares_of(base), {}
    for i, (item, attributes, on) in enumerate(sides[: max(wanted) + 1]):
        if i in wanted:
            kinds = key_kinds(counted, attributes, on)
            if kinds is not None:
                found[i] = hot_keys_counted(counted, list(item.on), kinds, _ROWS, total, shares)
        added = needed[i + 1] & set(item.columns)
        if added:
            narrow = attributes.select(*[named(name) for name in (*on.values(), *sorted(added))])
            counted = lookup_join(counted, narrow, on)
        if needed[i + 1] and needed[i + 1] != needed[i]:
            counted = summed(counted, needed[i + 1], F.sum(_ROWS))
    return found


def _most_rows(df: DataFrame, keys: list[Column]) -> int:
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.max("n").alias("most")).first()["most"] or 0


def nest_attribute(
    children: DataFrame,
    keys: Sequence[str],
    value: str,
    name: str | None = None,
    max_values: int | None = None,
) -> DataFrame:
    """Child rows folded into one sorted array of distinct values per key.

    Repeated values are removed first, on the map side too, so only what ends up in
    an array is gathered. Null values are left out. An array is one cell of one row: where
    that may get too large, ``max_values`` has the values counted first, and raises before
    anything is gathered.
    """
    names = [named(key) for key in keys]
    distinct = children.select(*names, named(value)).distinct()
    if max_values is not None and _most_rows(distinct, names) > max_values:
        raise ValueError(f"more than {max_values} values of {value!r} for one {list(keys)}")
    folded = F.array_sort(F.collect_list(quoted(value))).alias(name or value)
    return distinct.groupBy(*names).agg(folded)


def attach_nested(
    base: DataFrame, children: DataFrame, on: Mapping[str, str], value: str, name: str | None = None
) -> DataFrame:
    """``base`` with an array column of its children's values; no children, empty array."""
    name = name or value
    nested = nest_attribute(children, list(on.values()), value, name)
    joined = lookup_join(base, nested, on)
    empty = F.array().cast(joined.schema[name].dataType)
    return joined.withColumn(name, F.coalesce(named(name), empty))


def array_filter(product: DataFrame, column: str, value: object) -> DataFrame:
    """Rows whose array column holds ``value``."""
    return product.filter(F.array_contains(named(column), value))


def product_rollup(
    product: DataFrame,
    by: Mapping[str, str | Column],
    measures: Mapping[str, Column],
) -> DataFrame:
    """Group a product by any of its columns; groups are pre-aggregated before the shuffle."""
    groups = [
        (named(given) if isinstance(given, str) else given).alias(name)
        for name, given in by.items()
    ]
    return product.groupBy(*groups).agg(*[cell.alias(name) for name, cell in measures.items()])


