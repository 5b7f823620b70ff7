"""Approximate nearest neighbours with an inverted multi-index.

Unit vectors are cut into two halves, each quantised by its own k-means centres; a pair of
centres is a cell. A query walks the cells by the sum of its two distances with a heap until
enough rows are reached, and these rows are ranked again by exact cosine. The cells of one
first-half centre form a list; lists are cut into blocks and queries into groups of bounded
size, so a list with a third of all rows is spread like any other. Only the centres and the
number of rows of each cell are broadcast: their size is set by ``centres``, not by the data.

Defined results: vectors that are null, zero, or hold null or non-finite components, and
rows without id, take no part; shorter vectors count as filled up with zeros; a query's own
rows are all rows with its id; queries that repeat an id with the same vector count once,
other rows that repeat are candidates each; of equal scores the smaller vec_id comes first;
other columns are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.vectors import best, k_means, matrix, squared_distances, whole_vectors


def _units(rows: np.ndarray) -> np.ndarray:
    scaled = rows / np.abs(rows).max(1, keepdims=True)  # squares of very large numbers would overflow
    return scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))


def cosines(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Cosine of ``query`` with each row, in the same order of additions wherever a row stands."""
    q, r = query / np.abs(query).max(), rows / np.abs(rows).max(1, keepdims=True)
    return (r * q).sum(1) / (np.sqrt((r * r).sum(1)) * np.sqrt((q * q).sum()))


@dataclass(frozen=True)
class MultiIndex:
    """Centres of both halves, and the number of rows in each cell."""

    first: np.ndarray
    second: np.ndarray
    counts: np.ndarray | None = None

    def cells(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        half = self.first.shape[1]
        return (
            squared_distances(units[:, :half], self.first).argmin(1),
            squared_distances(units[:, half:], self.second).argmin(1),
        )

    def walk(self, unit: np.ndarray, wanted: int) -> np.ndarray:
        """Cells in the order of the summed distance until they hold ``wanted`` rows, as a matrix of flags."""
        half = self.first.shape[1]
        apart_a = squared_distances(unit[None, :half], self.first)[0]
        apart_b = squared_distances(unit[None, half:], self.second)[0]
        by_a, by_b = np.argsort(apart_a, kind="stable"), np.argsort(apart_b, kind="stable")
        a, b, counts = apart_a[by_a].tolist(), apart_b[by_b].tolist(), self.counts[by_a][:, by_b].tolist()
        seen = np.zeros((len(a), len(b)), dtype=bool)
        heap, reached = [(a[0] + b[0], 0, 0)], 0
        while heap and reached < wanted:
            _, i, j = heapq.heappop(heap)
            seen[by_a[i], by_b[j]] = True
            reached += counts[i][j]
            # Every pair but those in the first column has one parent, its left neighbour.
            if j + 1 < len(b):
                heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
            if j == 0 and i + 1 < len(a):
                heapq.heappush(heap, (a[i + 1] + b[0], i + 1, 0))
        return seen


def fit_index(data: DataFrame, width: int, centres: int, sample_rows: int) -> MultiIndex:
    """Centres from ``sample_rows`` rows chosen by a hash of the id; every row is indexed later."""
    sample = data.select("id", "v").orderBy(F.xxhash64("id"), "id", "v").limit(sample_rows).toArrow()
    units, half = _units(matrix(sample["v"], width)), width // 2
    return MultiIndex(k_means(units[:, :half], centres), k_means(units[:, half:], centres))


def nearest_neighbours(
    vectors: DataFrame,
    k: int = 5,
    every: int = 50,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    centres: int = 64,
    sample_rows: int = 16_384,
    share: float = 0.45,
    least: int = 4_096,
    block_rows: int = 16_384,
    group_queries: int = 4_096,
) -> DataFrame:
    """query_id, rank, vec_id, score: about the ``k`` nearest rows by cosine of each id divisible by ``every``.

    A query looks at ``share`` of all rows, and at ``least`` rows at any rate.
    """
    spark = vectors.sparkSession
    data = whole_vectors(vectors, id_column, vector_column).where(F.exists("v", lambda x: x != 0))
    measured = data.agg(F.max(F.size("v")), F.count(F.lit(1)), F.count(F.when(F.pmod("id", F.lit(every)) == 0, 1))).first()
    width, total, asked = measured
    if not asked:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width = max(width, 2)
    index = fit_index(data, width, centres, sample_rows)
    wanted = max(least, math.ceil(share * total))
    groups = math.ceil(asked / group_queries)

    def place(batches):
        for batch in batches:
            a, b = index.cells(_units(matrix(batch.column("v"), width)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32))], [*batch.schema.names, "a", "b"]
            )

    placed = data.mapInArrow(place, "id long, v array<double>, a int, b int")
    counts = np.zeros((len(index.first), len(index.second)), dtype=np.int64)
    for row in placed.groupBy("a", "b").count().collect():  # centres squared rows at most
        counts[row["a"], row["b"]] = row["count"]
    full = MultiIndex(index.first, index.second, counts)
    blocks_of = np.maximum(1, -(-counts.sum(1) // block_rows))

    def walks(batches):
        for batch in batches:
            units = _units(matrix(batch.column("v"), width))
            for i, unit in enumerate(units):
                seen = full.walk(unit, wanted)
                lists_ = np.flatnonzero((seen & (counts > 0)).any(1))
                repeat = batch.slice(i, 1).take(pa.array(np.zeros(len(lists_), dtype=np.int64)))
                flags = [np.packbits(seen[a]).tobytes() for a in lists_]
                yield pa.RecordBatch.from_arrays(
                    [*repeat.columns, pa.array(lists_.astype(np.int32)), pa.array(flags, pa.binary())],
                    [*batch.schema.names, "a", "flags"],
                )

    salt = F.element_at(F.array(*[F.lit(int(n)) for n in blocks_of]), F.col("a") + 1)
    asked_rows = data.where(F.pmod("id", F.lit(every)) == 0).distinct()
    sent = (
        asked_rows.select("id", "v", F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int").alias("g"))
        .mapInArrow(walks, "id long, v array<double>, g int, a int, flags binary")
        .select("id", F.xxhash64("v").alias("same"), "v", "g", "a", "flags", F.explode(F.sequence(F.lit(0), salt - 1)).alias("block"))
    )
    rows = placed.select(
        "id", "v", "a", "b", F.pmod(F.xxhash64("id"), salt).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"),
    )
    key = ("g", "a", "block")

    def rerank(queries: pa.Table, found: pa.Table) -> pa.Table:
        ids, mine, same = found["id"].to_numpy(), queries["id"].to_numpy(), queries["same"].to_numpy()
        have, second = matrix(found["v"], width), found["b"].to_numpy()
        units = _units(have) if len(have) else have
        flags = queries["flags"].to_pylist()
        result = []
        for start in range(0, len(mine) if len(have) else 0, 256):
            part = matrix(queries["v"].slice(start, 256), width)
            rough = _units(part) @ units.T
            for i, row in enumerate(rough):
                reached = np.unpackbits(np.frombuffer(flags[start + i], np.uint8))[second] == 1
                row = np.where(reached & (ids != mine[start + i]), row, -np.inf)
                if len(row) > k:  # the product of blocks may round equal vectors differently
                    row[row < np.partition(row, len(row) - k)[len(row) - k] - 1e-9] = -np.inf
                near = np.flatnonzero(row > -np.inf)
                score = cosines(part[i], have[near])
                top = best(score, ids[near], k)
                result.append((np.full(len(top), start + i), ids[near][top], score[top]))
        where, other, score = (np.concatenate(x) for x in zip(*result)) if result else (np.zeros(0),) * 3
        where = where.astype(np.int64)
        return pa.table(
            {"query_id": mine[where], "same": same[where], "vec_id": other.astype(np.int64), "score": score.astype(np.float64)}
        )

    found = (
        sent.groupBy(*key)
        .cogroup(rows.groupBy(*key))
        .applyInArrow(rerank, "query_id long, same long, vec_id long, score double")
    )
    order = Window.partitionBy("query_id", "same").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
