"""The divergence audit against a plain count, and its perfect hashes."""

import random
import re
from collections import Counter
from fractions import Fraction
from math import floor

import numpy as np
import pytest

from statement_lake.llm import divergence
from statement_lake.llm.perfect_hash import PerfectHash, hashes

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def plain(rows, least, top):
    """The contract, one group after the other, in fractions."""
    rows = [(text or "", lang or "", source or "") for text, lang, source in rows]
    lower = {c: c + 32 for c in range(65, 91)}
    read = [([t.translate(lower) for t in TERM.findall(text)], lang, source) for text, lang, source in rows]
    out = []
    for lang in {r[1] for r in read}:
        within = Counter(t for terms, where, _ in read if where == lang for t in set(terms))
        kept = sorted(t for t, n in within.items() if n >= least)
        counts = {}
        for terms, where, source in read:
            if where == lang:
                counts.setdefault(source, Counter()).update(t for t in terms if t in within and within[t] >= least)
        whole = sum(counts.values(), Counter())

        def shares(own):
            total = sum(own.values()) + 2 * len(kept)
            return {t: 1 + floor(Fraction(10**9 * (own[t] + 2), total)) for t in kept}

        p, q = {s: shares(own) for s, own in counts.items()}, shares(whole)
        far = lambda a, b: (a - b) ** 2 // (a + b)
        for s in counts:
            pairs = [(sum(far(p[s][t], p[o][t]) for t in kept), o) for o in counts if o != s]
            own = [(far(p[s][t], q[t]), t) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", own)):
                listed = sorted(found, key=lambda x: (-x[0], x[1].encode()))
                for rank, (value, item) in enumerate(listed[: None if part == "pair" else top], 1):
                    out.append((lang, s, part, item, value, rank))
    return sorted(out)


def some_rows(seed, n=300):
    draw = random.Random(seed)
    words = ["the", "The", "naïve", "Ärger", "ärger", "x1y", "日本", "a-b", "ſ"] + [f"w{c}{d}" for c in "abcdef" for d in "ghij"]
    rows = []
    for _ in range(n):
        source = draw.choice(["hot"] * 6 + ["b", "c", None, "", "ü"])
        size = draw.choice([0, 1, 5, 40])
        text = " ".join(draw.choice(words[: draw.randint(3, len(words))]) for _ in range(size))
        rows.append((None if draw.random() < 0.05 else text, draw.choice(["en", "en", "de", None, "rare"]), source))
    return rows + [("only words here", "lone", "one"), ("", "mute", "a"), (None, "mute", "b")]


@pytest.mark.parametrize("seed", [0, 1])
def test_equals_a_plain_count(spark, seed):
    rows = some_rows(seed)
    frame = spark.createDataFrame(
        [(*r, 1, "n", 2.0) for r in rows], "text string, lang string, source string, n int, term string, total double"
    ).repartition(5)
    for options in ({}, {"shard_terms": 4, "broadcast_bytes": 1}):
        found = divergence.audit(frame, least_documents=5, top_terms=4, **options)
        assert sorted(tuple(r) for r in found.collect()) == plain(rows, 5, 4)


def test_held_terms_and_slots_are_handed_on(spark, monkeypatch):
    rows = some_rows(3, 120)
    monkeypatch.setattr(divergence, "HELD_TERMS", 7)
    monkeypatch.setattr(divergence, "HELD_SLOTS", 9)
    monkeypatch.setattr(divergence, "CELLS", 30)
    frame = spark.createDataFrame(rows, "text string, lang string, source string").coalesce(1)
    found = divergence.audit(frame, least_documents=3, shard_terms=3)
    assert sorted(tuple(r) for r in found.collect()) == plain(rows, 3, 10)


def test_no_rows_and_very_long_texts(spark):
    schema = "text string, lang string, source string"
    assert divergence.audit(spark.createDataFrame([], schema)).count() == 0
    rows = [("long word " * 100_000, "en", "a"), ("word", "en", "b")]
    found = divergence.audit(spark.createDataFrame(rows, schema), least_documents=1)
    assert sorted(tuple(r) for r in found.collect()) == plain(rows, 1, 10)


def test_a_perfect_hash_is_minimal_and_tells_strangers():
    draw = random.Random(4)
    for n in (0, 1, 2, 3, 17, 5_000):
        keys = list({f"key{draw.random()}".encode() for _ in range(n)})
        table = PerfectHash(keys)
        slots = table.slots(keys, hashes(keys))
        assert sorted(slots.tolist()) == list(range(len(keys)))
        assert [table.keys[s] for s in slots.tolist()] == keys
        strangers = [f"no{i}".encode() for i in range(500)]
        assert (table.slots(strangers, hashes(strangers)) == -1).all()


def test_equal_hashes_are_kept_apart(monkeypatch):
    from statement_lake.llm import perfect_hash

    monkeypatch.setattr(perfect_hash, "hashes", lambda keys: np.array([len(k) for k in keys], np.int64))
    keys = [b"a", b"b", b"cc", b"dd", b"eee"]
    table = perfect_hash.PerfectHash(keys)
    slots = table.slots([*keys, b"x", b"yy"], perfect_hash.hashes([*keys, b"x", b"yy"]))
    assert sorted(slots[:5].tolist()) == [0, 1, 2, 3, 4] and slots[5:].tolist() == [-1, -1]


def test_shares_are_exact_at_any_size():
    counts, totals = [0, 1, 5, 10**13, 4 * 10**14], [3, 10**3, 10**10, 10**15, 9 * 10**14]
    found = divergence.shares(np.array(counts), np.array(totals))
    assert found.tolist() == [1 + (10**9 * (c + 2)) // t for c, t in zip(counts, totals)]
