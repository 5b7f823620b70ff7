"""Raw files with a declared schema."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.conform import Declared, resolve_schema


def read_raw(
    spark: SparkSession,
    path: str | list[str],
    schema: Declared | None = None,
    fmt: str = "json",
    since: dt.datetime | None = None,
    until: dt.datetime | None = None,
    **options: str,
) -> DataFrame:
    """Rows of the files under ``path``.

    With a schema no file is read to infer one. ``since`` (inclusive) and ``until``
    (exclusive) choose files by modification time; Spark drops the others when it
    lists them, without opening them.
    """
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(resolve_schema(schema))
    df = reader.load(path)
    modified = F.col("_metadata.file_modification_time")
    if since is not None:
        df = df.filter(modified >= F.lit(since))
    if until is not None:
        df = df.filter(modified < F.lit(until))
    return df
