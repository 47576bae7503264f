"""Approximate nearest neighbours by inner product: a hash-prefix forest per shard."""

from __future__ import annotations

from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statement_lake.llm.common import (
    clean_vectors, largest_size, merged, search_blocks, settle, shards,
)

#: Vectors in a forest and queries in a block: bounds of what a task holds.
SHARD_ROWS, BLOCK_ROWS = 16_384, 512
#: Trees of a forest and bits of a hash string.
TREES, BITS = 24, 32
#: A query ascends until its prefixes hold this many entries, over all trees, for each row of the
#: shard, and k for each tree.
ENTRIES_PER_ROW = 0.8


def planes(dims: int, trees: int, bits: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((dims + 1, trees * bits))


def lifted(x: np.ndarray, longest: float) -> np.ndarray:
    """Vectors at equal length: one more component, so that angles order as products do."""
    rest = np.sqrt(np.maximum(0, longest**2 - (x**2).sum(axis=1)))
    return np.hstack([x, rest[:, None]])


def strings(x: np.ndarray, normal: np.ndarray, trees: int, bits: int) -> np.ndarray:
    """(trees, rows): each row's hash string in each tree, as a number; the first bit is the highest."""
    ones = (x @ normal > 0).reshape(len(x), trees, bits)
    weights = np.uint64(1) << np.arange(bits - 1, -1, -1, dtype=np.uint64)
    return np.ascontiguousarray((ones * weights).sum(axis=2, dtype=np.uint64).T)


def build_forest(
    ids: np.ndarray, x: np.ndarray, trees: int = TREES, bits: int = BITS, seed: int = 7
) -> dict[str, Any]:
    """Every row in every tree, as sorted arrays of hash strings."""
    longest = float(np.sqrt((x**2).sum(axis=1).max()))
    keys = strings(lifted(x / longest, 1.0), planes(x.shape[1], trees, bits, seed), trees, bits)
    order = np.argsort(keys, axis=1, kind="stable")
    return {
        "ids": ids, "x": x, "keys": np.take_along_axis(keys, order, axis=1),
        "order": order.astype(np.int32), "bits": bits, "seed": seed,
    }


def prefix_ranges(forest: dict[str, Any], asked: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """(2, trees, queries): where each tree's entries that share the first depth bits begin and end."""
    drop = (forest["bits"] - depth).astype(np.uint64)
    first = (asked >> drop) << drop
    last = first + ((np.uint64(1) << drop) - np.uint64(1))
    out = np.empty((2, *asked.shape), np.int64)
    for t, keys in enumerate(forest["keys"]):
        out[0, t] = np.searchsorted(keys, first[t], "left")
        out[1, t] = np.searchsorted(keys, last[t], "right")
    return out


def search_forest(
    forest: dict[str, Any],
    ids: np.ndarray,
    queries: np.ndarray,
    best: list,
    k: int,
    entries_per_row: float = ENTRIES_PER_ROW,
) -> None:
    """Raises each query's k best by the candidates of the forest.

    The longest shared prefix with enough entries is found by halving the depth,
    for all trees together: going up one bit at a time would end at the same
    place.  What the trees hold there, and nothing else, is scored exactly.
    """
    trees, rows = forest["keys"].shape
    bits, x = forest["bits"], forest["x"]
    normal = planes(x.shape[1], trees, bits, forest["seed"])
    size = np.sqrt((queries**2).sum(axis=1, keepdims=True))
    flat = np.hstack([queries / size, np.zeros((len(queries), 1))])
    asked = strings(flat, normal, trees, bits)
    wanted = min(trees * rows, int(entries_per_row * rows) + k * trees)
    low, high = np.zeros(len(queries), np.int64), np.full(len(queries), bits, np.int64)
    while (low < high).any():  # the deepest level that holds enough
        middle = (low + high + 1) // 2
        begin, end = prefix_ranges(forest, asked, middle)
        enough = (end - begin).sum(axis=0) >= wanted
        low, high = np.where(enough, middle, low), np.where(enough, high, middle - 1)
    begin, end = prefix_ranges(forest, asked, low)
    columns = np.ascontiguousarray(x.T)
    for i in range(len(queries)):
        seen = np.zeros(rows, bool)
        for t in range(trees):
            seen[forest["order"][t, begin[t, i] : end[t, i]]] = True
        seen &= forest["ids"] != ids[i]
        near = np.flatnonzero(seen)
        scores = products(columns, near, queries[i])
        kept = best[i]
        if len(kept[0]) == k:
            better = scores >= kept[0][-1]
            near, scores = near[better], scores[better]
        if len(near) > 4 * k:
            better = scores >= np.partition(scores, -k)[-k]
            near, scores = near[better], scores[better]
        best[i] = merged(kept, scores, forest["ids"][near], k)


def products(columns: np.ndarray, rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products of rows with a query, summed component by component.

    A product depends on the two vectors alone and not on where a row lies, so
    equal vectors tie.
    """
    total = np.zeros(len(rows))
    for column, value in zip(columns, query):
        total += column[rows] * value
    return total


def nearest(
    vectors: DataFrame,
    queries: DataFrame | Column,
    k: int = 20,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    entries_per_row: float = ENTRIES_PER_ROW,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest found, by inner product.

    queries: a condition on vec_id that picks rows of vectors, or a table with
    the same columns.  A query's own id is no candidate of its own.  Every row is
    in the index; scores are inner products of the vectors as given.  Where a
    forest gives fewer than k, the query goes up to the root, so all are found
    if there are k at most.

    Rows with a null id, a null or zero vector or a component that is null or not
    finite take no part.  Repeated ids: the row with the greatest vector counts.
    Vectors of different lengths: missing components count as 0.  Ties go to the
    smaller vec_id.  No rows, or no queries: no rows.  Other columns are ignored.
    """
    not_zero = F.exists("vector", lambda x: x != 0)
    clean = settle(
        clean_vectors(vectors, id_column, vector_column).where(not_zero), "neighbour-vectors"
    )
    dims = largest_size(clean)
    if isinstance(queries, Column):
        asked = clean.where(queries)
    else:
        asked = clean_vectors(queries, id_column, vector_column).where(not_zero)
        dims = max(dims, largest_size(asked))
    index = settle(shards(clean, dims, SHARD_ROWS, build_forest), "neighbour-forests")

    def search(forest: Any, ids: np.ndarray, x: np.ndarray, best: list) -> None:
        search_forest(forest, ids, x, best, k, entries_per_row)

    return search_blocks(asked, index, dims, block_rows, search, k, pa.float64())
