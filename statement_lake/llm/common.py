"""What several operators of this subpackage share."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statement_lake.session import settle


def clean_vectors(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """(vec_id long, vector array<double>), one row an id, in partitions by id.

    Rows whose id or vector is null, or whose vector holds a null or a number
    that is not finite, are left out.  Of several rows with one id the greatest
    vector (in array order) counts; the aggregate combines before it shuffles.
    """
    sound = F.forall(
        "vector",
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))),
    )
    return (
        vectors.select(
            F.col(id_column).cast("long").alias("vec_id"),
            F.col(vector_column).cast("array<double>").alias("vector"),
        )
        .where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull())
        .where(sound)
        .groupBy("vec_id")
        .agg(F.max("vector").alias("vector"))
    )


def matrix(columns: pa.RecordBatch, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of a batch; shorter vectors are filled up with zeros."""
    ids = columns.column("vec_id").to_numpy(zero_copy_only=False)
    lists = columns.column("vector")
    lengths = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(ids), dims))
    values = lists.flatten().to_numpy(zero_copy_only=False)
    out[np.arange(dims)[None, :] < lengths[:, None]] = values
    return ids, out


def shards(
    vectors: DataFrame, dims: int, rows: int, build: Callable[[np.ndarray, np.ndarray], Any]
) -> DataFrame:
    """(payload binary): what build makes of every `rows` vectors of a partition at most."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def made(some: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
            ids, x = (np.concatenate(part) for part in zip(*some))
            order = np.argsort(ids, kind="stable")
            blob = pickle.dumps(build(ids[order], x[order]), protocol=5)
            return pa.RecordBatch.from_pydict({"payload": pa.array([blob], pa.binary())})

        room = rows
        for batch in batches:
            ids, x = matrix(batch, dims)
            while len(ids):
                held.append((ids[:room], x[:room]))
                ids, x = ids[room:], x[room:]
                room -= len(held[-1][0])
                if not room:
                    yield made(held)
                    held, room = [], rows
        if held:
            yield made(held)

    return vectors.select("vec_id", "vector").mapInArrow(pack, "payload binary")


def search_blocks(
    queries: DataFrame,
    index: DataFrame,
    dims: int,
    block_rows: int,
    search: Callable[[Any, np.ndarray, np.ndarray, list], None],
    k: int,
    score_type: pa.DataType,
) -> DataFrame:
    """The k best (query_id, rank, vec_id, score) of each query against every shard.

    Queries are dealt into blocks of about block_rows.  Every block meets every
    shard once: shards are sent to the blocks' partitions and read one after
    the other, while the block keeps the best so far of each query, so a later
    shard starts from the kth score that the earlier ones have reached.
    search(shard, ids, vectors, best) updates best, for each query a pair of
    arrays (scores, ids), sorted.
    """
    count = queries.count()
    if not count:
        blocks = 1
    else:
        blocks = -(-count // block_rows)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, list] = {}
        for batch in batches:
            ids, x = matrix(batch, dims)
            block = batch.column("block").to_numpy()
            for b in np.unique(block):
                made.setdefault(int(b), []).append((ids[block == b], x[block == b]))
        for b, parts in made.items():
            blob = pickle.dumps(tuple(np.concatenate(p) for p in zip(*parts)), protocol=5)
            yield pa.RecordBatch.from_pydict(
                {"block": pa.array([b], pa.int32()), "kind": pa.array([0], pa.int32()),
                 "payload": pa.array([blob], pa.binary())}
            )

    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    asked = (
        queries.select("vec_id", "vector", block.alias("block"))
        .repartition(blocks, "block")
        .mapInArrow(gather, "block int, kind int, payload binary")
    )
    sent = index.select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        F.lit(1).alias("kind"),
        "payload",
    )
    schema = pa.schema(
        [("query_id", pa.int64()), ("rank", pa.int32()), ("vec_id", pa.int64()), ("score", score_type)]
    )

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, x, best = None, np.empty(0, np.int64), np.empty((0, dims)), []

        def told() -> pa.RecordBatch:
            sizes = [len(found) for _, found in best]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(ids, sizes), pa.int64()),
                    pa.array(np.concatenate([np.arange(1, n + 1) for n in sizes]), pa.int32()),
                    pa.array(np.concatenate([found for _, found in best]), pa.int64()),
                    pa.array(np.concatenate([score for score, _ in best]), score_type),
                ],
                schema=schema,
            )

        for batch in batches:
            for i in range(batch.num_rows):
                b = batch.column("block")[i].as_py()
                if b != at:
                    if best:
                        yield told()
                    at, ids, best = b, np.empty(0, np.int64), []
                payload = pickle.loads(memoryview(batch.column("payload")[i].as_buffer()))
                if batch.column("kind")[i].as_py() == 0:
                    ids, x = payload
                    empty = np.empty(0, score_type.to_pandas_dtype())
                    best = [(empty, np.empty(0, np.int64)) for _ in ids]
                elif best:
                    search(payload, ids, x, best)
        if best:
            yield told()

    score = "long" if pa.types.is_integer(score_type) else "double"
    return (
        asked.unionByName(sent)
        .repartition(blocks, "block")
        .sortWithinPartitions("block", "kind")
        .mapInArrow(answer, f"query_id long, rank int, vec_id long, score {score}")
    )


def merged(
    kept: tuple[np.ndarray, np.ndarray], scores: np.ndarray, ids: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """The k best of both, highest score first, ties to the smaller id."""
    scores, ids = np.concatenate([kept[0], scores]), np.concatenate([kept[1], ids])
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


def largest_size(vectors: DataFrame) -> int:
    return vectors.agg(F.max(F.size("vector"))).first()[0] or 0


__all__ = [
    "clean_vectors", "largest_size", "matrix", "merged", "search_blocks", "settle", "shards",
]
