"""SimHash near duplicates against brute force over all pairs."""

import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from statement_lake.llm import near_duplicates as nd


def plain_fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(
        1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)
    )


def reached(prints):
    """Component number of each fingerprint, by plain search."""
    prints, group = list(set(prints)), {}
    for start in prints:
        if start in group:
            continue
        todo = [start]
        group[start] = start
        while todo:
            x = todo.pop()
            for y in prints:
                if y not in group and (x ^ y).bit_count() <= 3:
                    group[y] = start
                    todo.append(y)
    return group


def expected(rows):
    prints = [(i, plain_fingerprint(t)) for i, t in rows]
    group = reached(f for _, f in prints)
    least = {}
    for i, f in prints:
        if i is not None:
            least[group[f]] = min(i, least.get(group[f], i))
    return sorted(((i, f"{f:016x}", least.get(group[f])) for i, f in prints), key=repr)


def texts(random, n):
    words = [f"Wörd{i}" for i in range(400)]
    out = []
    for i in range(n):
        if i % 4 or i < 5:
            out.append(" ".join(random.choice(words, random.integers(1, 120))))
        else:  # a copy with some words changed
            copy = out[random.integers(len(out))].split(" ")
            for _ in range(random.integers(0, 3)):
                copy[random.integers(len(copy))] = str(random.choice(words))
            out.append("\t\n ".join(copy))
    return out


def test_matches_brute_force(spark):
    random = np.random.default_rng(2)
    rows = list(enumerate(texts(random, 400)))
    rows += [(1000, None), (1001, ""), (1002, " \t\r\n"), (None, "only here"), (None, rows[3][1])]
    rows += [rows[7], rows[7], (1003, "one"), (1004, "ONE"), (1005, "a b c"), (5, "another text")]
    rows += [(1006, "long " * 200_000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("x"))
    found = nd.near_duplicates(frame.withColumn("root", F.lit(1)))
    assert sorted((tuple(r) for r in found.collect()), key=repr) == expected(rows)


def test_links_at_every_distance_and_no_further(spark):
    random = np.random.default_rng(4)
    prints = set()
    for _ in range(60):
        x = int(random.integers(0, 1 << 63)) * 2 + int(random.integers(2))
        prints.add(x)
        for bits in (1, 2, 3, 3, 3, 4):
            flips = random.choice(64, bits, replace=False)
            prints.add(x ^ sum(1 << int(b) for b in flips))
    frame = spark.createDataFrame([(nd._signed(p), p % 1000) for p in prints], "fp long, least long")
    two = nd.components(nd._within_two(frame))
    first = frame.join(two, frame.fp == two.node, "left").select(
        "fp", F.coalesce("root", "fp").alias("root")
    )
    links = nd._at_three(first).union(two.select("node", "root"))
    found = {r.node: r.root for r in nd.components(links).collect()}
    wanted = reached(prints)
    groups = {}
    for p, g in wanted.items():
        groups.setdefault(g, set()).add(nd._signed(p))
    mine = {}
    for group in groups.values():
        roots = {found.get(p, p) for p in group}
        assert roots == {min(group)}
        mine[min(group)] = group
    assert len(mine) == len(groups)


def test_long_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(1001, 1400)]
    found = nd.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {(r.node, r.root) for r in found} == {(i, 0) for i in range(1, 201)} | {
        (i, 1000) for i in range(1001, 1400)
    }


def test_one_of_each_keeps_columns_and_first_rows(spark):
    rows = [(3, "a b c d e", "x"), (2, "A b c d e", "y"), (5, "quite other words here", "z")]
    rows += [(5, "quite other words here", "w"), (None, "a b c d e", "n"), (9, None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    found = nd.one_of_each(frame)
    assert found.columns == frame.columns
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(
        [rows[1], rows[3], rows[4], rows[5]], key=repr
    )


def test_one_of_each_tells_rows_with_one_id_apart(spark):
    a, b, c = "the first text of all", "an altogether different second text", "words that nobody else has"
    rows = [(5, a, "x"), (7, a, "x"), (9, a, "x"), (2, b, "x"), (5, b, "x")]  # (5, a) stands for 7 and 9
    rows += [(1, c, "x"), (1, "unrelated to it in every way", "x")]  # one id is the least of two components
    rows += [(None, "seen without any id here", "x"), (None, "seen without any id here", "y"), (None, None, "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    wanted = [rows[i] for i in (0, 3, 5, 6, 7, 9)]
    assert sorted(map(tuple, nd.one_of_each(frame).collect()), key=repr) == sorted(wanted, key=repr)


def test_no_rows(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert nd.near_duplicates(frame).count() == 0
    assert nd.one_of_each(frame).count() == 0
