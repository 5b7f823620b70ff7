"""Good rows and rejected ones from one pass, with the reasons and their counts.

A lenient conform makes null what does not fit, and a second job has to count the losses. Here
every row is judged while it is written: it lands in the table if each declared field fits and the
required ones are there, else beside it, as it came, with a reason for each field. Both go into
one version, by one write of one scan, so none is seen without the other; the counts are
taken along the way (``Observation``).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.functions.casting import count_lost, find_field, fit
from strata.functions.columns import named
from strata.operators.conform import Declared, resolve_schema
from strata.sources.snapshots import latest_version, publish_snapshot, read_snapshot, versions

_REJECTED = "rejected"


@dataclass(frozen=True)
class Quarantined:
    """A published version: its number, its good rows, the rejected ones with ``reasons``, and counts by reason.

    ``counts`` has ``rows`` and ``rejected`` too. A row with two faults counts under both.
    """

    version: int
    good: DataFrame
    rejected: DataFrame
    counts: dict[str, int]


def judge(df: DataFrame, schema: Declared, required: Sequence[str] = ()) -> DataFrame:
    """``fitted`` (the declared fields, null if rejected), ``raw`` (the row as it came, if rejected), reasons, rejected.

    Reasons are ``name: does not fit`` (a value that has no place in the declared type, or loses a
    fraction) and ``name: is null`` (required, and null as it came). An undeclared column is
    only kept in ``raw``.
    """
    declared = resolve_schema(schema)
    exact = str(df.sparkSession.conf.get("spark.sql.caseSensitive", "false")).lower() == "true"
    unknown = [name for name in required if find_field(declared, name, exact) is None]
    if unknown:
        raise ValueError(f"required, but not declared: {unknown}")
    needed = {find_field(declared, name, exact).name for name in required}
    cells, reasons = [], []
    for wanted in declared.fields:
        given = find_field(df.schema, wanted.name, exact)
        if given is None:
            raise ValueError(f"column {wanted.name!r} is missing")
        cell = named(given.name)
        cells.append(fit(cell, given.dataType, wanted.dataType, True, exact).alias(wanted.name))
        lost = count_lost(cell, given.dataType, wanted.dataType, exact) > 0
        reasons.append(F.when(lost, F.lit(f"{wanted.name}: does not fit")))
        if wanted.name in needed:
            reasons.append(F.when(cell.isNull(), F.lit(f"{wanted.name}: is null")))
    raw = F.struct(*[named(name) for name in df.columns])
    judged = df.select(F.filter(F.array(*reasons), lambda x: x.isNotNull()).alias("reasons"), F.struct(*cells).alias("fitted"), raw.alias("raw"))
    bad = F.size("reasons") > 0
    return judged.select(F.when(~bad, F.col("fitted")).alias("fitted"), F.when(bad, F.col("raw")).alias("raw"), "reasons", bad.alias(_REJECTED))


def _counts(declared: StructType, required: Sequence[str]) -> dict[str, F.Column]:
    names = [f"{f.name}: does not fit" for f in declared.fields] + [f"{name}: is null" for name in required]
    own = {name: F.count_if(F.array_contains("reasons", name)) for name in names}
    return {"rows": F.count(F.lit(1)), "rejected": F.count_if(F.col(_REJECTED))} | own


def write_or_reject(df: DataFrame, schema: Declared, path: str, required: Sequence[str] = (), version: int | None = None) -> Quarantined:
    """Publish the rows of ``df`` that fit ``schema``, and the others beside them, as one version.

    A given ``version`` that is complete stays as it is, and its counts are taken from its rows.
    """
    spark = df.sparkSession
    declared = resolve_schema(schema)
    counts = {name: value.alias(name) for name, value in _counts(declared, required).items()}
    if version is not None and version in versions(spark, path):
        found = read_snapshot(spark, path, version).agg(*counts.values()).first().asDict()
    else:
        observation = Observation()
        judged = judge(df, declared, required).observe(observation, *counts.values())
        # Two partitions: every task writes a file of either, and nothing is shuffled.
        version = publish_snapshot(judged, path, version, partition_by=[_REJECTED], gather=False)
        found = observation.get
    return Quarantined(version, read_good(spark, path, version), read_rejected(spark, path, version), {k: v for k, v in found.items() if v or k in ("rows", "rejected")})


def _stored(spark: SparkSession, path: str, version: int | None) -> DataFrame:
    return read_snapshot(spark, path, latest_version(spark, path) if version is None else version)


def read_good(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rows that fitted; the rejected ones are not read."""
    return _stored(spark, path, version).where(~F.col(_REJECTED)).select("fitted.*")


def read_rejected(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rejected rows as they came, with their ``reasons``."""
    return _stored(spark, path, version).where(F.col(_REJECTED)).select("raw", "reasons")
