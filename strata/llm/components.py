"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from strata.plans.sizing import Bound, within
from strata.plans.skew import hot_keys_counted, lookup_join
from strata.session import cut_lineage

_SHARE = 100  # edges of a node that are always left in one task
_SHARE_BYTES = 128 << 20
_FEW = Bound(rows=1_000_000, bytes=32 << 20)


def components(edges: DataFrame, few: Bound = _FEW) -> DataFrame:
    """``edges`` (a, b) of longs to (node, root): the smallest node of its component for each other node.

    Large and small stars by turns: every node links its larger neighbours, then its smaller
    ones, to the smallest it knows. The number of rounds grows with the logarithm of the longest
    chain. Neighbours are never gathered: minima are taken before the shuffle. Edges meet only the
    minima of nodes that are not settled, the centres that have a smaller neighbour, or the nodes
    with two. Up to ``few`` these are broadcast and edges stay where they are; beyond, edges are
    shuffled and a node with very many is spread over salts, as many as it has fair shares of the
    rows (1/1024 of them or 128 MB, but 100 rows at least). When no node is unsettled, each
    component is one star. Roots are not in the result.
    """

    def down(df: DataFrame) -> DataFrame:
        """From the larger to the smaller node, each edge once."""
        return df.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()

    def meet(df: DataFrame, name: str, least: DataFrame) -> DataFrame:
        """``df`` with ``m`` of the node ``name``, null if ``least`` does not have it."""
        if within(least, few):
            return df.join(F.broadcast(least), df[name] == least["of"], "left").drop("of")
        total = df.count()
        shares = max(1024, total * 16 // _SHARE_BYTES)
        counted = df.groupBy(name).agg(F.count(F.lit(1)).alias("n"))
        hot = hot_keys_counted(counted, [name], [LongType()], "n", max(total, _SHARE * shares), shares)
        return lookup_join(df, least, {name: "of"}, split_hot=True, hot=hot)

    current = cut_lineage(down(edges))
    while True:
        above = current.select(F.col("b").alias("of"), F.lit(None).cast("long").alias("below"))
        ends = current.select(F.col("a").alias("of"), F.col("b").alias("below")).unionByName(above)
        nodes = ends.groupBy("of").agg(F.min("below").alias("m"), F.count("below").alias("below"), F.count(F.lit(1)).alias("all"))
        unsettled = cut_lineage(nodes.where("below > 1 or (below = 1 and all > 1)"))
        if unsettled.isEmpty():
            return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
        centres = unsettled.where("all > below").select("of", "m")
        large = meet(current, "b", centres).select("a", F.coalesce("m", "b").alias("b"))
        large = cut_lineage(large.distinct())
        both = large.groupBy("a").agg(F.min("b").alias("m"), F.max("b").alias("most")).where("m < most")
        met = meet(large, "a", cut_lineage(both.select(F.col("a").alias("of"), "m")))
        moved = F.col("b") > F.col("m")
        linked = met.select(F.when(moved, F.col("b")).otherwise(F.col("a")).alias("a"), F.when(moved, F.col("m")).otherwise(F.col("b")).alias("b"))
        current = cut_lineage(linked.distinct())
