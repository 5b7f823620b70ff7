"""Exact top-k by integer inner product as a Voronoi join.

Pivots cut the vectors into cells. Per cell a summary holds the number of vectors, the
distance of the farthest and those of the nearest ones from the pivot. From the summaries
alone every query gets a score that its k-th best candidate surely reaches, and for every
cell a score that none of its vectors can pass; a cell goes to a group of queries only if
one of them could find something there. Cells are cut into blocks and queries into groups
of bounded size, so that a cell of equal vectors is spread like any other. Each block is
solved by itself with exact integer arithmetic and sends on k candidates a query at most.

Defined results: vectors that are null or hold null or non-finite components, and rows
without id, take no part; shorter vectors count as filled up with zeros; a query's own rows
are all rows with its id; queries that repeat an id with the same vector count once, other
rows that repeat are candidates each; of equal scores the smaller vec_id comes first; other
columns are not looked at; scores beyond 64 bits are held at the largest long;
an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.vectors import best, matrix, squared_distances, whole_vectors

_EXACT = 2.0**53
_LONG = 2**63 - 1


def _products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products of integer-valued rows, as float64 or, where that can't hold them, objects."""
    largest = np.abs(queries).max(initial=0) * np.abs(rows).max(initial=0) * max(1, rows.shape[1])
    if largest < _EXACT:
        return queries @ rows.T
    whole = [[[int(x) for x in row] for row in side] for side in (queries, rows)]
    return np.array([[sum(map(int.__mul__, q, r)) for r in whole[1]] for q in whole[0]], dtype=object)


def _pivots(data: DataFrame, count: int, width: int) -> np.ndarray:
    """A fixed random sample of ``count`` vectors."""
    chosen = data.select("id", "v").orderBy(F.xxhash64("id"), "id", "v").limit(count).toArrow()
    return matrix(chosen["v"], width)


def _assigned(data: DataFrame, pivots: np.ndarray, columns: str) -> DataFrame:
    """``data`` (id, v) with the nearest pivot and the distance from it."""
    width = pivots.shape[1]

    def assign(batches):
        for batch in batches:
            apart = squared_distances(matrix(batch.column("v"), width), pivots)
            cell = apart.argmin(1)
            away = np.sqrt(apart[np.arange(len(cell)), cell])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell.astype(np.int32)), pa.array(away)], [*batch.schema.names, "cell", "away"]
            )

    return data.mapInArrow(assign, f"{columns}, cell int, away double")


def _summaries(data: DataFrame, k: int):
    """Per cell: its vectors, the largest and the k + 1 smallest distances. One row per pivot."""
    ranked = data.groupBy("cell", "away").count()
    near = (
        ranked.withColumn("r", F.row_number().over(Window.partitionBy("cell").orderBy("away")))
        .where(F.col("r") <= k + 1)
        .groupBy("cell")
        .agg(F.sort_array(F.collect_list(F.struct("away", "count"))).alias("near"))
    )
    sizes = data.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("far"))
    return sizes.join(near, "cell").collect()


def _groups(queries: dict[int, int], size: int) -> tuple[dict[int, int], dict[int, int], int]:
    """For the cells of queries: the first group, in how many groups they go, and how many there are.

    A cell of many queries is cut into groups of about ``size``; cells of few share one.
    """
    first, parts, last, room = {}, {}, -1, 0
    for cell, count in sorted(queries.items()):
        if count >= size:
            first[cell], parts[cell] = last + 1, -(-count // size)
            last, room = last + parts[cell], 0
            continue
        if count > room:
            last, room = last + 1, size
        first[cell], parts[cell] = last, 1
        room -= count
    return first, parts, last + 1


def exact_top_k(
    vectors: DataFrame,
    k: int = 10,
    every: int = 100,
    scale: int = 1024,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    pivot_count: int = 32,
    block_rows: int = 16_384,
    group_queries: int = 4_096,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best of all rows for each id divisible by ``every``.

    Scores are inner products of floor(``scale`` * x).
    """
    spark = vectors.sparkSession

    def whole(x: Column) -> Column:
        # floor() of a double is a long; beyond 2 ** 52 a double is whole already.
        large = F.greatest(F.lit(-1e300), F.least(F.lit(1e300), x * scale))
        return F.when(F.abs(x) * scale < 2.0**52, F.floor(x * scale).cast("double")).otherwise(large)

    data = whole_vectors(vectors, id_column, vector_column).select("id", F.transform("v", whole).alias("v"))
    schema = "query_id long, rank int, vec_id long, score long"
    width = data.agg(F.max(F.size("v"))).first()[0]
    if width is None:
        return spark.createDataFrame([], schema)
    width = max(width, 1)
    pivots = _pivots(data, pivot_count, width)
    placed = _assigned(data, pivots, "id long, v array<double>")
    cells = _summaries(placed, k)
    salts = {row["cell"]: -(-row["n"] // block_rows) for row in cells}
    counts = np.array([row["n"] for row in cells], dtype=np.int64)
    cell_of = np.array([row["cell"] for row in cells], dtype=np.int32)
    centres, far = pivots[cell_of], np.array([row["far"] for row in cells])
    near = [(i, x["away"], min(x["count"], k + 1)) for i, row in enumerate(cells) for x in row["near"]]
    near_cell = np.array([x[0] for x in near])
    near_away, near_count = np.array([x[1] for x in near]), np.array([x[2] for x in near])
    chosen = data.where(F.pmod("id", F.lit(every)) == 0)
    rows_of_id = chosen.groupBy("id").agg(F.count(F.lit(1)).alias("own"))
    asked = chosen.distinct().join(rows_of_id, "id").select("id", "v", "own")
    total = int(counts.sum())

    def needs(batches):
        """Each query with what its k-th best surely reaches and the cells that may hold better ones."""
        for batch in batches:
            rows = matrix(batch.column("v"), width)
            at, length = rows @ centres.T, np.sqrt((rows * rows).sum(1))
            slack = 1e-9 * (1 + length * (np.sqrt((centres * centres).sum(1)).max() + far.max()))
            reach = at + length[:, None] * far
            sure, own = np.full(len(rows), -np.inf), batch.column("own").to_numpy()
            if total > k:
                least = at[:, near_cell] - length[:, None] * near_away
                order = np.argsort(-least, axis=1)
                for i, o in enumerate(order):  # the query's own rows may be among those counted
                    enough = np.searchsorted(np.cumsum(near_count[o]), k + own[i])
                    sure[i] = least[i, o[enough]] - slack[i] if enough < len(o) else -np.inf
            needed = reach + slack[:, None] >= sure[:, None]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(sure), pa.array([cell_of[row] for row in needed], pa.list_(pa.int32()))],
                [*batch.schema.names, "sure", "cells"],
            )

    # Queries near the same pivot share a group, so that groups need few cells.
    home = _assigned(asked, pivots, "id long, v array<double>, own long")
    first, parts, groups = _groups({r["cell"]: r["count"] for r in home.groupBy("cell").count().collect()}, group_queries)
    if not groups:
        return spark.createDataFrame([], schema)
    begin, spread = (F.create_map(*[F.lit(x) for item in part.items() for x in item]) for part in (first, parts))
    group = F.element_at(begin, F.col("cell")) + F.pmod(F.xxhash64("id"), F.element_at(spread, F.col("cell")))
    ready = home.select("id", "v", "own", group.cast("int").alias("g")).mapInArrow(
        needs, "id long, v array<double>, own long, g int, sure double, cells array<int>"
    )
    block_count = F.create_map(*[F.lit(x) for item in salts.items() for x in item])
    every_block = F.explode(F.sequence(F.lit(0), F.element_at(block_count, F.col("cell")) - 1)).alias("block")
    sent = ready.select("id", "v", F.xxhash64("v").alias("same"), "g", "sure", F.explode("cells").alias("cell"))
    sent = sent.select("id", "v", "same", "sure", "g", "cell", every_block)
    pairs = ready.select(F.col("g").alias("group"), F.explode("cells").alias("cell")).distinct()
    blocks = placed.select(
        "id", "v", "cell", F.pmod(F.xxhash64("id"), F.element_at(block_count, F.col("cell"))).cast("int").alias("block")
    )
    if groups * len(cells) <= 200_000:
        pairs = F.broadcast(pairs)
    blocks = blocks.join(pairs, "cell").select("id", "v", "cell", "block", F.col("group").alias("g"))
    key = ("g", "cell", "block")

    def solve(queries: pa.Table, rows: pa.Table) -> pa.Table:
        ids, mine = rows["id"].to_numpy(), queries["id"].to_numpy()
        have, sure = matrix(rows["v"], width), queries["sure"].to_numpy()
        found = []
        for start in range(0, len(mine), 256):
            part = matrix(queries["v"].slice(start, 256), width)
            for i, row in enumerate(_products(part, have)):
                scores = np.where(ids == mine[start + i], -np.inf, row)
                scores = np.where(scores >= sure[start + i], scores, -np.inf)
                top = best(scores, ids, k)
                value = [max(-_LONG - 1, min(_LONG, int(x))) for x in row[top]]
                found.append((np.full(len(top), start + i), ids[top], np.array(value, dtype=np.int64)))
        place, other, score = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
        place = place.astype(np.int64)
        same = queries["same"].to_numpy()
        return pa.table({"query_id": mine[place], "same": same[place], "vec_id": other, "score": score})

    found = (
        sent.groupBy(*key)
        .cogroup(blocks.groupBy(*key))
        .applyInArrow(solve, "query_id long, same long, vec_id long, score long")
    )
    order = Window.partitionBy("query_id", "same").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
