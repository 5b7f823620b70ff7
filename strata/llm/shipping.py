"""Give the workers this package, so that code in tasks can be imported there."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import strata

_SENT: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to all workers of ``spark`` once, through Spark's own file service."""
    context = spark.sparkContext
    if context.applicationId in _SENT:
        return
    root = os.path.dirname(os.path.abspath(strata.__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="run-"), "strata.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(target)
    _SENT.add(context.applicationId)
