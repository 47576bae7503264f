"""Exact top-k and approximate neighbours against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from statement_lake.llm import neighbours, queries, top_k

SCHEMA = "vec_id long, embedding array<double>, score string, rank string, vector int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", "y", 1) for i, v in rows], SCHEMA)


def brute(rows, k, code, asked=lambda i: i % 20 == 0, zero=True):
    held = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        if zero or any(v):
            held[i] = max(held.get(i, []), list(v))
    coded = {i: [code(x) for x in v] for i, v in held.items()}
    out = set()
    for q in filter(asked, coded):
        scores = sorted(
            (-sum(a * b for a, b in zip(coded[q], coded[c])), c) for c in coded if c != q
        )
        out |= {(q, r, c, -s) for r, (s, c) in enumerate(scores[:k], 1)}
    return out


def floor64(x):
    return math.floor(64 * x)


ODD = [
    (20, [0.5, 0.25]), (20, [0.5, 0.25]), (40, [0.1, 0.2]), (40, [0.3, 0.0]), (1, None), (2, []),
    (3, [1.0, None]), (60, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (None, [1.0, 1.0]),
    (5, [0.0, 0.0]), (6, [0.5, 0.25]), (7, [0.5, 0.25]), (8, [-0.001, 0.7]), (9, [0.5, 0.25, 3.0]),
]


def test_exact_top_k_of_odd_rows(spark):
    found = top_k.exact_top_k(frame(spark, ODD), queries.asked(), k=4)
    assert {tuple(r) for r in found.collect()} == brute(ODD, 4, floor64)


@pytest.mark.parametrize("scale", [1.0, 1e7])
def test_exact_top_k_with_many_ties(spark, scale):
    random = np.random.default_rng(3)
    x = random.integers(-2, 3, (900, 5)) * scale
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    found = top_k.exact_top_k(frame(spark, rows).repartition(7), queries.asked(), block_rows=10)
    assert {tuple(r) for r in found.collect()} == brute(rows, 20, floor64)


def test_tree_boxes_are_tight_and_prune():
    random = np.random.default_rng(1)
    centres = random.standard_normal((20, 8)) * 50
    x = np.floor(centres[np.arange(4000) % 20] + random.standard_normal((4000, 8)))
    tree = top_k.build_tree(np.arange(4000), x, leaf_rows=32)
    for (begin, end), low, high in zip(tree["spans"], tree["low"], tree["high"]):
        assert (tree["codes"][begin:end].min(axis=0) == low).all()
        assert (tree["codes"][begin:end].max(axis=0) == high).all()
    best = [(np.empty(0, np.int64), np.empty(0, np.int64))]
    tree["codes"] = tree["codes"].astype(float)
    opened = []

    class Spans(list):
        def __getitem__(self, node):
            opened.append(node)
            return super().__getitem__(node)

    tree["spans"] = Spans(tree["spans"])
    top_k.search_tree(tree, np.array([-1]), x[:1], best, 20)
    assert best[0][0].tolist() == sorted(x @ x[0])[::-1][:20]
    assert len(opened) < len(tree["spans"]) / 8


def test_no_rows_and_no_queries(spark):
    assert top_k.exact_top_k(frame(spark, []), queries.asked()).count() == 0
    assert top_k.exact_top_k(frame(spark, [(1, [1.0])]), queries.asked()).count() == 0
    assert neighbours.nearest(frame(spark, []), queries.asked()).count() == 0
    assert neighbours.nearest(frame(spark, [(1, [1.0])]), queries.asked()).count() == 0


def test_nearest_finds_all_of_few_rows(spark):
    found = {(q, r, c): s for q, r, c, s in neighbours.nearest(frame(spark, ODD), queries.asked()).collect()}
    wanted = brute(ODD, 20, float, zero=False)
    assert set(found) == {w[:3] for w in wanted}
    assert all(abs(found[w[:3]] - w[3]) < 1e-12 for w in wanted)


@pytest.mark.parametrize("many", [1_001, 2_003])
def test_equal_vectors_come_in_order_of_id(many):
    """Scores are those of a plain sum, wherever a row lies in its shard."""
    random = np.random.default_rng(many)
    some = random.standard_normal((40, 37))
    x = some[random.integers(0, 40, many)]
    forest = neighbours.build_forest(np.arange(many), x)
    best = [(np.empty(0), np.empty(0, np.int64)) for _ in range(20)]
    neighbours.search_forest(forest, np.full(20, -1), x[:20], best, 60, entries_per_row=24)
    for (scores, ids), query in zip(best, x):
        plain = []
        for row in x:
            total = 0.0
            for a, b in zip(row.tolist(), query.tolist()):
                total += a * b
            plain.append(total)
        wanted = sorted(range(many), key=lambda i: (-plain[i], i))[:60]
        assert ids.tolist() == wanted and scores.tolist() == [plain[i] for i in wanted]


@pytest.mark.parametrize("folder", ["sf0.01", "sf0.1"])
def test_recall_over_all_queries_of_a_table(spark, folder):
    """At the default, on tables far smaller than a shard and not held whole."""
    table = spark.read.parquet(f"/root/testdata/{folder}/embeddings.parquet")
    rows = {r.vec_id: r.embedding for r in table.collect()}
    ids, x = np.array(list(rows)), np.array(list(rows.values()), float)
    found = {}
    for r in neighbours.nearest(table, queries.asked()).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q in found:
        scores = np.where(ids == q, -np.inf, x @ x[ids == q][0])
        hits += len(found[q] & set(ids[np.argsort(-scores)[:20]].tolist()))
    assert len(found) == (ids % 20 == 0).sum() and hits >= 0.9 * 20 * len(found)


def test_nearest_recall_of_vectors_of_any_length(spark):
    random = np.random.default_rng(5)
    x = random.standard_normal((20_000, 32)) * random.uniform(0.5, 1.5, (20_000, 1))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    asked = F.col("vec_id") % 200 == 0
    found = neighbours.nearest(frame(spark, rows).coalesce(1), asked).collect()
    hits = 0
    for q in range(0, 20_000, 200):
        scores = x @ x[q]
        scores[q] = -np.inf
        best = set(np.argsort(-scores)[:20].tolist())
        mine = [r.vec_id for r in found if r.query_id == q]
        assert len(set(mine)) == 20
        hits += len(best & set(mine))
    assert hits >= 0.9 * 20 * 100
