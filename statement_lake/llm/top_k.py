"""Exact top-k by inner product: a KD-tree per shard, searched best first."""

from __future__ import annotations

import heapq
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statement_lake.llm.common import (
    clean_vectors, largest_size, merged, search_blocks, settle, shards,
)

#: Vectors in a tree, in a leaf, and queries in a block: bounds of what a task holds.
SHARD_ROWS, LEAF_ROWS, BLOCK_ROWS = 16_384, 256, 512
#: Sums of products below this are exact as doubles.
EXACT = 2**53
LONG = 2**63


def build_tree(ids: np.ndarray, x: np.ndarray, leaf_rows: int = LEAF_ROWS) -> dict[str, Any]:
    """Median splits along the widest side; each node has the tight box of its rows."""
    order = np.arange(len(ids))
    low, high, kids, spans = [], [], [], []
    todo = [(0, len(ids), -1)]
    while todo:
        begin, end, parent = todo.pop()
        node = len(spans)
        rows = x[order[begin:end]]
        low.append(rows.min(axis=0) if x.shape[1] else np.zeros(0))
        high.append(rows.max(axis=0) if x.shape[1] else np.zeros(0))
        spans.append((begin, end))
        kids.append([])
        if parent >= 0:
            kids[parent].append(node)
        wide = high[-1] - low[-1]
        if end - begin > leaf_rows and wide.size and wide.max() > 0:
            middle = (end - begin) // 2
            split = np.argpartition(rows[:, wide.argmax()], middle, kind="introselect")
            order[begin:end] = order[begin:end][split]
            todo += [(begin, begin + middle, node), (begin + middle, end, node)]
    codes = x[order]
    largest = np.abs(codes).max(initial=0)
    if largest < 128:
        codes = codes.astype(np.int8)
    elif largest < 2**31:
        codes = codes.astype(np.int32)
    return {
        "ids": ids[order], "codes": codes, "low": np.array(low), "high": np.array(high),
        "kids": kids, "spans": spans, "largest": float(largest),
    }


def search_tree(
    tree: dict[str, Any], ids: np.ndarray, queries: np.ndarray, best: list, k: int
) -> None:
    """Raises each query's k best by what the tree holds.

    A node's bound is the highest product that a point of its box can have.  The
    node with the highest bound is next; a node whose bound is below the kth
    score so far, from this tree or an earlier one, is never opened.
    """
    most = np.abs(queries).max(initial=0) * tree["largest"] * max(1, queries.shape[1])
    if not np.isfinite(most) or most >= EXACT:
        _search_wide(tree, ids, queries, best, k)
        return
    bounds = np.maximum(queries, 0) @ tree["high"].T + np.minimum(queries, 0) @ tree["low"].T
    codes, names, kids, spans = tree["codes"].astype(float), tree["ids"], tree["kids"], tree["spans"]
    for i, query in enumerate(queries):
        bound, kept = bounds[i].tolist(), best[i]
        kth = kept[0][-1] if len(kept[0]) == k else -np.inf
        heap = [(-bound[0], 0)]
        while heap and -heap[0][0] >= kth:
            node = heapq.heappop(heap)[1]
            if kids[node]:
                for kid in kids[node]:
                    if bound[kid] >= kth:
                        heapq.heappush(heap, (-bound[kid], kid))
                continue
            begin, end = spans[node]
            score = codes[begin:end] @ query
            near = np.flatnonzero(score >= kth)
            near = near[names[begin + near] != ids[i]]
            if len(near):
                kept = merged(kept, score[near].astype(np.int64), names[begin + near], k)
                kth = kept[0][-1] if len(kept[0]) == k else -np.inf
        best[i] = kept


def _search_wide(
    tree: dict[str, Any], ids: np.ndarray, queries: np.ndarray, best: list, k: int
) -> None:
    """Whole numbers without bound, for vectors whose products are not exact as doubles.

    Boxes are of no use to such numbers, so every leaf is read; scores beyond a
    long end at its limits.
    """
    codes = [[int(v) for v in row] for row in tree["codes"]]
    for i, query in enumerate(queries):
        query = [int(v) for v in query]
        scores = np.array(
            [max(-LONG, min(LONG - 1, sum(a * b for a, b in zip(query, row)))) for row in codes],
            np.int64,
        )
        other = tree["ids"] != ids[i]
        scores, names = scores[other], tree["ids"][other]
        scores, names = np.concatenate([best[i][0], scores]), np.concatenate([best[i][1], names])
        order = sorted(range(len(names)), key=lambda j: (-int(scores[j]), int(names[j])))[:k]
        best[i] = (scores[order], names[order])


def exact_top_k(
    vectors: DataFrame,
    queries: DataFrame | Column,
    k: int = 20,
    scale: float = 64,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest products of codes.

    A vector's codes are floor(scale * component); the score is the whole-number
    inner product.  queries: a condition on vec_id that picks rows of vectors, or
    a table with the same columns.  A query's own id is no candidate of its own.

    Rows with a null id, a null vector or a component that is null or not finite
    take no part.  Repeated ids: the row with the greatest vector counts.  Vectors
    of different lengths: missing components count as 0; an empty vector scores 0
    with all.  Ties go to the smaller vec_id.  Scores beyond a long end at its
    limits.  No rows, or no queries: no rows.  Other columns are ignored.
    """
    coded = settle(_coded(clean_vectors(vectors, id_column, vector_column), scale), "top-k-codes")
    dims = largest_size(coded)
    if isinstance(queries, Column):
        asked = coded.where(queries)
    else:
        asked = _coded(clean_vectors(queries, id_column, vector_column), scale)
        dims = max(dims, largest_size(asked))
    index = settle(shards(coded, dims, SHARD_ROWS, build_tree), "top-k-trees")

    def search(tree: Any, ids: np.ndarray, x: np.ndarray, best: list) -> None:
        search_tree(tree, ids, x, best, k)

    return search_blocks(asked, index, dims, block_rows, search, k, pa.int64())


def _coded(clean: DataFrame, scale: float) -> DataFrame:
    # rint of a double is a double: floor() would end at the limits of a long.
    def code(x: Column) -> Column:
        y = x * F.lit(float(scale))
        near = F.rint(y)
        return near - F.when(near > y, 1.0).otherwise(0.0)

    return clean.select("vec_id", F.transform("vector", code).alias("vector"))
