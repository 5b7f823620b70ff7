"""From raw events to conceptual tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from strata.functions.columns import quoted
from strata.sources.snapshots import publish_snapshot


def bronze_to_silver(
    raw: DataFrame, required: Sequence[str], kind: str | None = None, kind_column: str | None = None
) -> DataFrame:
    """Rows with all ``required`` values present; of one ``kind`` if given."""
    clean = raw.dropna(subset=list(required))
    if kind is not None:
        if kind_column is None:
            raise ValueError("kind needs kind_column")
        clean = clean.filter(clean[quoted(kind_column)] == kind)
    return clean


def route(silver: DataFrame, by: str, path: str) -> int:
    """Publish all conceptual tables in one pass, one folder per value of ``by``.

    The rows of a large table are spread over several tasks and files. Returns the
    published version; a filter on ``by`` reads one table of it.
    """
    return publish_snapshot(silver, path, partition_by=[by])
