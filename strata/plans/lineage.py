"""Which partitions were made from which, and what has to be made again when one changes.

Each run of a job records pairs (partition read, partition written) as rows of a small Parquet
table. From some changed partitions :func:`downstream` follows the pairs through all later
tables and gives every partition to rebuild with its step: a partition's step comes after those
of all changed partitions it is made of, so steps are rebuilt one after the other, and the
partitions of a step at the same time.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.session import cut_lineage
from strata.sources.storage import Storage

LINK_SCHEMA = "job string, run_at timestamp, source string, source_part string, target string, target_part string"


class PartitionLineage:
    """Links between partitions of tables, below ``path``; tables and partitions are named by text."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def every(self) -> DataFrame:
        """All recorded links, of old runs too."""
        if not Storage(self.spark, self.path).names():
            return self.spark.createDataFrame([], LINK_SCHEMA)
        return self.spark.read.schema(LINK_SCHEMA).parquet(self.path)

    def record(self, job: str, links: DataFrame, run_at: dt.datetime | None = None) -> None:
        """Write down what a run has read and written: source, source_part, target and target_part.

        The newest run that has written a partition says what it is made of. Call it when the
        run's own writes are done; a run that is repeated records the same again.
        """
        if not job:
            raise ValueError("a run needs a job name")
        named = [F.col(name).cast("string").alias(name) for name in ("source", "source_part", "target", "target_part")]
        at = F.lit(run_at or dt.datetime.now(dt.UTC))
        rows = links.select(F.lit(job).alias("job"), at.alias("run_at"), *named).distinct()
        rows.write.mode("append").parquet(self.path)

    def links(self) -> DataFrame:
        """(source, source_part, target, target_part) as the newest run of each target partition left them."""
        newest = F.max("run_at").over(Window.partitionBy("target", "target_part"))
        current = self.every().withColumn("newest", newest).where("run_at = newest")
        return current.select("source", "source_part", "target", "target_part").distinct()


def downstream(links: DataFrame, changed: DataFrame) -> DataFrame:
    """(table, part, step) of all partitions to rebuild when those of ``changed`` (table, part) have changed.

    Steps count from 1. The changed partitions are in the result only if they are made of others
    that change too. Each round follows the links of the partitions whose step has grown, so there
    are as many rounds as the longest chain of tables; links that lead back to where they began
    fail the job. Null partitions are partitions like others.
    """
    edges = cut_lineage(links.select("source", "source_part", "target", "target_part").where("target is not null").distinct())
    steps = cut_lineage(changed.select("table", "part").distinct().withColumn("step", F.lit(0)))
    front, step, tables = steps, 0, edges.select("source", "source_part").distinct().count()
    while True:
        step += 1
        same = edges["source"].eqNullSafe(front["table"]) & edges["source_part"].eqNullSafe(front["part"])
        reached = edges.join(front, same, "left_semi").select(F.col("target").alias("table"), F.col("target_part").alias("part")).distinct()
        front = cut_lineage(reached)
        if front.isEmpty():
            return steps.where("step > 0")
        if step > tables:
            raise ValueError("partitions are made of each other")
        later = front.withColumn("step", F.lit(step))
        steps = cut_lineage(steps.unionByName(later).groupBy("table", "part").agg(F.max("step").alias("step")))
