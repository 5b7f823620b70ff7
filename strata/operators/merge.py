"""Merge change records into current state: the newest record of each key wins."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, MapType, StructType, VariantType

from strata.functions.columns import named, quoted
from strata.functions.dates import from_epoch_millis
from strata.plans.sizing import DEFAULT_BOUND, Bound, scanned_bytes, within
from strata.session import cut_lineage

_ARRIVAL = "__arrival"
_RANK = "__rank"
_HIT = "__hit"
_KNOWN = "__known"
_HOPELESS = 64


def _sortable(dtype: DataType) -> bool:
    if isinstance(dtype, (MapType, VariantType)):
        return False
    if isinstance(dtype, StructType):
        return all(_sortable(field.dataType) for field in dtype.fields)
    element = getattr(dtype, "elementType", None)
    return element is None or _sortable(element)


def is_live(deleted: str) -> Column:
    """True unless the delete flag is set; an unknown flag counts as live."""
    return ~F.coalesce(named(deleted), F.lit(False))


def with_flag(df: DataFrame, deleted: str | None) -> DataFrame:
    """``df`` with a delete flag; one that has none holds live rows only."""
    if deleted is None or deleted in df.columns:
        return df
    return df.withColumn(deleted, F.lit(False))


def newest_first(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    deleted: str | None,
    order_is_total: bool,
) -> list[Column]:
    """Sort columns that leave no tie undecided.

    Newest first and nulls last; then the later arrival; then a delete before a live
    row; then the remaining columns, so that the same input always gives the same
    winner.
    """
    ranking = [named(name).desc_nulls_last() for name in order]
    if _ARRIVAL in df.columns:
        ranking.append(F.col(_ARRIVAL).desc())
    if deleted is not None:
        ranking.append(is_live(deleted).asc())
    if not order_is_total:
        used = {*keys, *order, _ARRIVAL, deleted}
        ranking += [
            named(field.name).desc_nulls_last()
            for field in df.schema.fields
            if field.name not in used and _sortable(field.dataType)
        ]
    return ranking


def newest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    deleted: str | None,
    order_is_total: bool,
) -> DataFrame:
    # row_number() == 1 right above the window makes Spark cut every task's rows to
    # one per key before the shuffle, which is also what tames a hot key.
    window = Window.partitionBy(*[named(key) for key in keys]).orderBy(
        *newest_first(df, keys, order, deleted, order_is_total)
    )
    ranked = df.withColumn(_RANK, F.row_number().over(window))
    return ranked.filter(F.col(_RANK) == 1).drop(_RANK)


def _same_keys(one: DataFrame, other: DataFrame, keys: Sequence[str], new: dict[str, str]) -> Column:
    return reduce(and_, [one[quoted(key)].eqNullSafe(other[new[key]]) for key in keys])


def _stays(order: Sequence[str], new: dict[str, str]) -> Column:
    """Structs compare field by field with nulls lowest, as the ranking does; equal ones go to the newcomer."""
    return F.struct(*[named(name) for name in order]) > F.struct(*[new[name] for name in order])


def merge_into_unique(
    newest: DataFrame,
    existing: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    bound: Bound = DEFAULT_BOUND,
) -> tuple[DataFrame | None, DataFrame]:
    """``newest`` (one row per key) put into ``existing``, each of whose rows is replaced or stays.

    Returns the rows that stand where the stored ones stood, and the others. While ``newest``
    stays within ``bound`` it is kept in the checkpoint folder and broadcast: ``existing`` is
    read once as a whole and once for its keys alone, and neither shuffled nor sorted. Beyond
    that one full outer join gives the same rows, all of them as "others". A key that
    ``existing`` repeats stays repeated in both ways.
    """
    new = {name: f"__new_{i}" for i, name in enumerate(newest.columns)}

    def renamed(df: DataFrame) -> DataFrame:
        return df.select(*[named(name).alias(alias) for name, alias in new.items()])

    # A scan this much larger than the bound hardly shrinks to it; then nothing is measured.
    if scanned_bytes(newest) <= _HOPELESS * bound.bytes:
        newest = cut_lineage(newest)
        if within(newest, bound):
            return _patch(existing, renamed(newest), keys, order, new)
    arriving = renamed(newest).withColumn(_HIT, F.lit(True))
    known = existing.withColumn(_KNOWN, F.lit(True))
    joined = known.join(arriving, _same_keys(known, arriving, keys, new), "full_outer")
    takes = F.col(_KNOWN).isNull() | (F.col(_HIT).isNotNull() & ~_stays(order, new))
    cells = [F.when(takes, F.col(new[n])).otherwise(named(n)).alias(n) for n in newest.columns]
    return None, joined.select(*cells)


def _patch(
    existing: DataFrame, small: DataFrame, keys: Sequence[str], order: Sequence[str], new: dict[str, str]
) -> tuple[DataFrame, DataFrame]:
    hits = F.broadcast(small.withColumn(_HIT, F.lit(True)))
    joined = existing.join(hits, _same_keys(existing, hits, keys, new), "left_outer")
    replaced = F.col(_HIT).isNotNull() & ~_stays(order, new)
    patched = joined.select(*[F.when(replaced, F.col(alias)).otherwise(named(n)).alias(n) for n, alias in new.items()])
    small_keys = F.broadcast(small.select(*[new[key] for key in keys]))
    known = existing.select(*[quoted(key) for key in keys])
    known = known.join(small_keys, _same_keys(known, small_keys, keys, new), "left_semi").distinct()
    added = small.join(known, _same_keys(known, small, keys, new), "left_anti")
    return patched, added.select(*[F.col(alias).alias(name) for name, alias in new.items()])


def retain_last(
    incoming: DataFrame,
    existing: DataFrame | None = None,
    *,
    keys: Sequence[str],
    order: Sequence[str],
    deleted: str | None = None,
    keep_tombstones: bool = False,
    order_is_total: bool = False,
    existing_unique: bool = False,
    bound: Bound = DEFAULT_BOUND,
) -> DataFrame:
    """One row per key: the newest of ``incoming`` and ``existing``, unless it is a delete.

    ``order`` lists the columns that decide what is newest, most important first.
    Equal ones are decided by arrival (incoming wins), then delete over live, then
    by the remaining columns; set ``order_is_total`` when ``order`` alone decides, so
    that a reader of a few columns need not read all of them. A null order value
    loses to any other. The delete flag may be missing on one side, or null: live.

    Both frames must have the same columns, in any order; the result has those of
    ``incoming``. The delete flag is dropped, unless ``keep_tombstones`` asks for the
    form to store: with tombstones kept, an older event that arrives in a later run
    cannot revive a deleted key.

    ``existing_unique`` states that ``existing`` is a stored table with one row per key.
    Then the newest incoming rows are put into it, see :func:`merge_into_unique`. This runs
    jobs: one to keep those rows in the checkpoint folder, and one to measure them there.
    """
    if not keys or not order:
        raise ValueError("retain_last needs at least one key and one order column")
    incoming = with_flag(incoming, deleted)
    merged = None
    if existing is not None:
        existing = with_flag(existing, deleted)
        if existing_unique and _types(existing) == _types(incoming):
            newest = newest_per_key(incoming, keys, order, deleted, order_is_total)
            placed, others = merge_into_unique(newest, existing, keys, order, bound)
            merged = others if placed is None else placed.unionByName(others)
        if merged is None:
            incoming = incoming.withColumn(_ARRIVAL, F.lit(1))
            incoming = incoming.unionByName(existing.withColumn(_ARRIVAL, F.lit(0)))
    if merged is None:
        merged = newest_per_key(incoming, keys, order, deleted, order_is_total).drop(_ARRIVAL)
    if deleted is not None and not keep_tombstones:
        merged = merged.filter(is_live(deleted)).drop(deleted)
    return merged


def _types(df: DataFrame) -> dict[str, str]:
    return dict(df.dtypes)


def flatten_changes(
    events: DataFrame,
    *,
    image: str = "row",
    before: str = "before",
    after: str = "after",
    event_millis: str = "ts_ms",
    as_of: str = "_as_of",
    deleted: str = "_deleted",
    carry: Sequence[str] = (),
) -> DataFrame:
    """Change events ``{before, after, epoch millis}`` to versioned rows.

    A delete has no ``after``. ``image="row"`` takes ``after`` as a whole, so a field
    that an update sets to null stays null; ``image="field"`` falls back to ``before``
    for every null field. ``carry`` names further event columns to keep, such as a
    source sequence number that orders events of one millisecond.
    """
    if image not in ("row", "field"):
        raise ValueError(f"image is 'row' or 'field', not {image!r}")
    new, old = named(after), named(before)
    known = {field.name for field in events.schema[before].dataType.fields}
    cells = []
    for field in events.schema[after].dataType.fields:
        name = field.name
        value = new.getField(name)
        if name in known:
            if image == "row":
                value = F.when(new.isNotNull(), value).otherwise(old.getField(name))
            else:
                value = F.coalesce(value, old.getField(name))
        cells.append(value.alias(name))
    return events.select(
        *cells,
        from_epoch_millis(named(event_millis)).alias(as_of),
        new.isNull().alias(deleted),
        *[named(name) for name in carry],
    )


def current_state(
    events: DataFrame,
    existing: DataFrame | None = None,
    *,
    keys: Sequence[str],
    image: str = "row",
    as_of: str = "_as_of",
    deleted: str = "_deleted",
    sequence: Sequence[str] = (),
    keep_tombstones: bool = False,
    existing_unique: bool = False,
    **flatten: str,
) -> DataFrame:
    """Change events merged into the state they describe.

    ``sequence`` names event columns, also present in ``existing``, that order events
    of one millisecond. The other settings are those of :func:`flatten_changes` and
    :func:`retain_last`.
    """
    changes = flatten_changes(
        events, image=image, as_of=as_of, deleted=deleted, carry=sequence, **flatten
    )
    return retain_last(
        changes,
        existing,
        keys=keys,
        order=[as_of, *sequence],
        deleted=deleted,
        keep_tombstones=keep_tombstones,
        existing_unique=existing_unique,
    )
