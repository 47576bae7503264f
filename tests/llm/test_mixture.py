"""Mixture: budgets against a plain recursion, runs against a plain walk."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from statement_lake.llm import mixture

SCHEMA = "doc_id long, text string, lang string, source string, tokens string, row int"


def rows(seed, n):
    random = np.random.default_rng(seed)
    out = [
        (i, "w " * int(random.integers(0, 40)), str(random.choice(["en", "de", "xx"])), f"src{min(9, random.geometric(0.3))}", "t", 1)
        for i in range(n)
    ]
    return out + [(n, None, None, None, None, None), (None, "a b", "en", "src1", "t", 1), (5, "again", "en", "other", "t", 1)]


def plain_domain(source):
    digits = (source or "")[len((source or "").rstrip("0123456789")):]
    return mixture.DOMAINS[int(digits) % 4 if digits else 0]


def filled(children, budget):
    """Budget by name of children {name: (capacity, weight)}, handing on shortages until none is left."""
    given, open_ = {}, dict(children)
    while open_:
        weight = sum(w for _, w in open_.values())
        short = {n: c for n, (c, w) in open_.items() if c * weight <= w * budget}
        if not short:
            given |= {n: min(c, w * budget // weight) for n, (c, w) in open_.items()}
            break
        given |= short
        budget -= sum(short.values())
        open_ = {n: x for n, x in open_.items() if n not in short}
    return given


def plain(table, share, epochs, seed):
    docs = []
    for i, text, lang, source, *_ in table:
        name = f"{'-' if i is None else i}:{hashlib.md5((text or '').encode()).hexdigest()}"
        docs.append((i, plain_domain(source), lang or "-", source or "-", len((text or "").split()), name))
    leaves = {}
    for _, *leaf, tokens, _ in docs:
        leaves[tuple(leaf)] = leaves.get(tuple(leaf), 0) + tokens
    leaves = {k: t for k, t in leaves.items() if t}
    total = sum(leaves.values()) * share // 100

    def deal(prefix, budget):
        depth = len(prefix)
        if depth == 3:
            return {prefix: budget}
        level, caps = mixture.LEVELS[depth], {}
        for k, t in leaves.items():
            if k[:depth] == prefix:
                caps[k[depth]] = caps.get(k[depth], 0) + t * epochs
        children = {n: (c, mixture.WEIGHTS[level].get(n, 1)) for n, c in caps.items()}
        out = {}
        for n, b in filled(children, budget).items():
            out |= deal((*prefix, n), b)
        return out

    found = []
    for leaf, budget in deal((), min(total, epochs * sum(leaves.values()))).items():
        whole, rest = divmod(budget, leaves[leaf])
        mine = [d for d in docs if d[1:4] == leaf]
        found += [(*d[:5], e) for d in mine for e in range(1, whole + 1)]
        mine.sort(key=lambda d: (hashlib.md5(f"{seed}:{whole}:{d[5]}".encode()).hexdigest(), d[4]))
        held = 0
        for d in mine:
            held += d[4]
            if held > rest or not rest:
                break
            found.append((*d[:5], whole + 1))
    return sorted(found, key=repr)


@pytest.mark.parametrize(("share", "epochs"), [(50, 2), (50, 1), (130, 2), (300, 2)])
def test_matches_plain_version(spark, share, epochs):
    table = rows(share, 500)
    found = mixture.mix(spark.createDataFrame(table, SCHEMA), share=share, epochs=epochs)
    found = found.select(F.col("row.doc_id"), *mixture.LEVELS, "tokens", "epoch")
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain(table, share, epochs, 17)


def test_documents_keep_their_columns_and_empty_tables(spark):
    frame = spark.createDataFrame(rows(1, 50), SCHEMA)
    found = mixture.mixed_documents(frame, epochs=1)
    assert found.columns == frame.columns and found.exceptAll(frame).count() == 0
    assert mixture.mix(frame.limit(0)).count() == 0
    assert mixture.mix(frame.where("text IS NULL")).count() == 0
