"""Keep current state up to date from a folder of change files."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.columns import named
from strata.operators.conform import Declared
from strata.operators.merge import is_live, retain_last, with_flag
from strata.plans.jobs import merge_partitions
from strata.plans.sizing import sized_for
from strata.sources.snapshots import (
    labelled_version,
    latest_version,
    publish_snapshot,
    purge_versions,
    read_snapshot,
)
from strata.sources.storage import Storage
from strata.streaming.files import checkpoint_id, process_new_files

_BUCKETS = "_BUCKETS"


def current_state_incremental(
    spark: SparkSession,
    source: str,
    schema: Declared,
    state_path: str,
    checkpoint: str,
    *,
    keys: Sequence[str],
    order: Sequence[str],
    deleted: str | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    fmt: str = "parquet",
    max_files: int | None = None,
    order_is_total: bool = False,
    keep: int = 2,
    timeout: int | None = None,
) -> int | None:
    """Merge files that are new since the last call into the state; returns its version.

    ``transform`` turns a batch into versioned rows (for change events, pass
    :func:`strata.operators.merge.flatten_changes`). Each batch publishes the version after
    the newest one, whoever wrote that, labelled with the stream and the batch; a batch
    that is repeated after a failure finds its label and has no further effect. Without
    new files nothing happens. The state keeps its tombstones; :func:`read_state` hides
    them. The newest ``keep`` versions stay.
    """
    if keep < 2:
        raise ValueError("keep at least two versions")

    def merge(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        label = f"{checkpoint_id(session, checkpoint)}/{number}"
        if labelled_version(session, state_path, label) is not None:
            return
        changes = with_flag(transform(batch) if transform else batch, deleted)
        previous = latest_version(session, state_path)
        # The next version is planned from stored files, so lineage does not grow.
        state = None if previous is None else read_snapshot(session, state_path, previous)
        with sized_for(changes, *([] if state is None else [state])):
            merged = retain_last(
                changes,
                state,
                keys=keys,
                order=order,
                deleted=deleted,
                keep_tombstones=True,
                order_is_total=order_is_total,
                existing_unique=True,
            )
            publish_snapshot(merged, state_path, label=label)
        purge_versions(session, state_path, keep)

    process_new_files(spark, source, schema, checkpoint, merge, fmt, max_files, timeout)
    return latest_version(spark, state_path)


def current_state_partitioned(
    spark: SparkSession,
    source: str,
    schema: Declared,
    state_path: str,
    checkpoint: str,
    *,
    keys: Sequence[str],
    order: Sequence[str],
    deleted: str | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    column: str = "bucket",
    buckets: int | None = None,
    fmt: str = "parquet",
    max_files: int | None = None,
    timeout: int | None = None,
) -> None:
    """The same for a state too large to be written anew with each batch.

    The state is partitioned by ``column``, which must follow from the key; with
    ``buckets`` it is computed, as a hash of the key. A batch rewrites the partitions it
    touches, see :func:`strata.plans.jobs.merge_partitions`; a repeated batch changes
    nothing. Unlike numbered versions, a batch becomes visible partition by partition.
    The number of buckets is kept beside the state, and another one is refused: the rows
    of a key would then be sought in the wrong place.
    """
    storage = Storage(spark, state_path)
    if buckets is not None:
        if storage.holds_text(_BUCKETS):
            known = int(storage.read_text(_BUCKETS))
            if known != buckets:
                raise ValueError(f"the state has {known} buckets, not {buckets}")
        elif storage.names():
            raise ValueError(f"there is a state at {state_path}, but not in buckets")
        else:
            storage.write_text(str(buckets), _BUCKETS)

    def merge(batch: DataFrame, number: int) -> None:
        changes = transform(batch) if transform else batch
        if buckets is not None:
            hashed = F.xxhash64(*[named(key) for key in keys])
            changes = changes.withColumn(column, F.pmod(hashed, F.lit(buckets)).cast("int"))
        merge_partitions(
            changes,
            state_path,
            column,
            keys=keys,
            order=order,
            deleted=deleted,
            follows_key=buckets is not None,
        )

    process_new_files(spark, source, schema, checkpoint, merge, fmt, max_files, timeout)


def read_state(spark: SparkSession, state_path: str, deleted: str | None = None) -> DataFrame:
    """The live rows of the newest published state."""
    state = read_snapshot(spark, state_path)
    return state if deleted is None else state.filter(is_live(deleted)).drop(deleted)
