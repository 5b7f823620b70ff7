"""Process each file of a growing folder once."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strata.operators.conform import Declared, resolve_schema
from strata.sources.storage import Storage


def process_new_files(
    spark: SparkSession,
    source: str,
    schema: Declared,
    checkpoint: str,
    handle: Callable[[DataFrame, int], None],
    fmt: str = "parquet",
    max_files: int | None = None,
    timeout: int | None = None,
) -> None:
    """Call ``handle(rows, batch number)`` for the files that no earlier call has finished.

    Spark's checkpoint remembers which files were read; a batch counts as read when
    ``handle`` returns. After a failure the same files come again under the same
    number, so ``handle`` should make its writes idempotent by it. Without new files
    ``handle`` is not called. All new files are one batch unless ``max_files`` bounds it.
    A call lasts until they are done; with ``timeout`` (seconds) it gives up earlier.
    """
    reader = spark.readStream.schema(resolve_schema(schema)).format(fmt)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    running = (
        reader.load(source)
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    if timeout is None:
        running.awaitTermination()
    elif not running.awaitTermination(timeout):
        running.stop()
        raise TimeoutError(f"no end after {timeout} s; the next call continues from the checkpoint")


def checkpoint_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave to a stream's checkpoint when it began."""
    return json.loads(Storage(spark, checkpoint).read_text("metadata"))["id"]
