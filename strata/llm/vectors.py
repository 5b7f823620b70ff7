"""Vector columns as numpy arrays, and the best rows of a block of scores."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INFINITE = float("inf")


def whole_vectors(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(id, v) of the rows that have an id and a vector of finite numbers; v is array<double>."""

    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < INFINITE)

    chosen = vectors.select(
        vectors[id_column].cast("long").alias("id"), vectors[vector_column].cast("array<double>").alias("v")
    )
    return chosen.where(F.col("id").isNotNull() & F.col("v").isNotNull() & F.forall("v", finite))


def matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """A list column as rows of ``width`` numbers; shorter lists are filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):  # no chunk at all
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    if len(lengths) and (lengths == width).all():
        return values.reshape(len(lengths), width)
    rows = np.zeros((len(lengths), width))
    row = np.repeat(np.arange(len(lengths)), lengths)
    begin = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    rows[row, np.arange(len(values)) - np.repeat(begin, lengths)] = values
    return rows


def lists(rows: np.ndarray) -> pa.Array:
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ravel()))


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` largest scores, largest first, ties to the smaller id; -inf is no score."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        places = np.flatnonzero((scores >= least) & (scores > -np.inf))
    else:
        places = np.flatnonzero(scores > -np.inf)
    return places[np.lexsort((ids[places], -scores[places]))][:k]


def squared_distances(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    apart = (rows * rows).sum(1)[:, None] - 2 * rows @ centres.T + (centres * centres).sum(1)
    return np.maximum(apart, 0)


def k_means(rows: np.ndarray, k: int, rounds: int = 12, seed: int = 0) -> np.ndarray:
    """At most ``k`` centres of ``rows``; fewer if there are fewer different rows."""
    different = np.unique(rows, axis=0)
    chosen = np.random.default_rng(seed).permutation(len(different))[:k]
    centres = different[np.sort(chosen)].copy()
    for _ in range(rounds):
        nearest = squared_distances(rows, centres).argmin(1)
        for j in range(len(centres)):
            own = rows[nearest == j]
            if len(own):
                centres[j] = own.mean(0)
    return centres
