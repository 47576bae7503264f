"""Language-model scores: the base against a plain count, the model as a proper and better one."""

import math
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from statement_lake.llm import language_model as lm
from statement_lake.llm import queries
from statement_lake.llm import word_contexts as wc

FOLDER = "/root/testdata/sf0.01"


def plain_tokens(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lowered), None]


def plain(rows):
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1 for i, _ in rows]
    counts = Counter(t for (_, text), h in zip(rows, held) if not h for t in plain_tokens(text))
    n, v = sum(counts.values()), len(counts)
    out = []
    for (i, text), h in zip(rows, held):
        found = plain_tokens(text)
        base = sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in found)
        out.append((i, h, len(found), sum(counts[t] > 0 for t in found), n, base))
    return out


def key(row):
    return repr(row[:5]) + f"{row[5]:.6f}"


ODD = [(1, None), (2, ""), (3, " \t\x0b\n"), (None, "no id"), (4, "Same Words"), (4, "same words"), (5, "Ünïcode ÀÉ \x1c x\x00y"),
       (6, "x" * 100_000), (7, "very long " * 50_000), (8, "unseen-word-here")]


@pytest.mark.parametrize("hot", [3, 65_536])
def test_base_score_equals_plain_count(spark, hot):
    rows = ODD + [(100 + i, f"word{i % 13} the of {'zz' * (i % 5)}") for i in range(200)]
    frame = spark.createDataFrame([(i, t, 1, b"x") for i, t in rows], "doc_id long, text string, n int, word binary")
    found = [tuple(r) for r in lm.score_texts(frame, hot_words=hot).collect()]
    for mine, other in zip(sorted(found, key=key), sorted(plain(rows), key=key), strict=True):
        assert mine[:5] == other[:5]
        assert abs(mine[5] - other[5]) < 1e-6 * (1 + abs(other[5]))
        assert mine[6] < 0 and np.isfinite(mine[6]) and mine[7] > 0


def test_model_is_a_distribution_and_words_do_not_depend_on_blocks(monkeypatch):
    words = [f"{a}{b}".encode() for a in "abcd" for b in ("ing", "tion", "é")]
    times = np.arange(1, len(words) + 1)
    counts = [np.zeros((1 << p, 2), np.float32) for p in lm.SLOTS]
    bits = lm.Bits(words)
    for table, slots in zip(counts, bits.slots):
        np.add.at(table, (slots.ravel(), bits.bits.ravel()), np.repeat(times[bits.word], 8))
    weights, table = lm.train_mixer(counts, words, times)
    # one byte and the end, over all bytes: below 1 together, as longer words exist
    short = [bytes([b]) for b in range(256) if b != 0x20]
    assert 0 < (10 ** lm.word_scores(counts, weights, table, short)).sum() < 1
    whole = lm.word_scores(counts, weights, table, words + short)
    monkeypatch.setattr(lm, "BLOCK", 3)
    assert np.allclose(lm.word_scores(counts, weights, table, words + short), whole)


def test_held_out_texts_are_predicted(spark):
    found = queries.op7_language_model(spark, FOLDER).toPandas()
    assert len(found) == queries.table(spark, FOLDER, "documents").count()
    out = found[found.held_out]
    # the base spends one share on all unseen words together, so it is no distribution over texts
    assert len(out) and out.score.sum() > 1.15 * out.base_score.sum()
    assert 1 < out.bits_per_byte.mean() < 2.6


def test_no_rows(spark):
    assert lm.score_texts(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_words_before_count(spark):
    """The same words in an order that was learned, and in one that was not."""
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 1]
    order = "one two three four five six seven eight nine ten"
    other = " ".join(sorted(order.split()))
    rows = [(i, order) for i in range(400) if i not in held] + [(held[0], order), (held[1], other)]
    for hot in (4, 65_536):
        found = {r.doc_id: r for r in lm.score_texts(spark.createDataFrame(rows, "doc_id long, text string"), hot_words=hot).collect()}
        learned, mixed = found[held[0]], found[held[1]]
        assert math.isclose(learned.base_score, mixed.base_score)
        assert learned.score > mixed.score + 1


def test_words_are_coded_as_a_distribution(monkeypatch):
    words = [f"w{i}".encode() for i in range(20)]
    code = wc.Code(words, [40 // (i + 1) + 1 for i in range(20)], 3)
    texts = [[words[(i * i + j) % 20] for j in range(i)] + [b"rare"] for i in range(50)]
    read = [code.read(text) for text in texts]
    tables = [np.zeros(size) for size in code.sizes]
    for steps in wc.blocks(code, read):
        wc.add(tables, steps)
    counts = [wc.short(table.reshape(-1, 2)) for table in tables]
    weights, _ = wc.train(counts, code, read)
    before = [words[3], words[7]]
    follow = [code.read([*before, word]) for word in [*words, b"rare"]]
    base = wc.score(counts, weights, code, [code.read(before)])[0]
    assert math.isclose((10 ** (wc.score(counts, weights, code, follow) - base)).sum(), 1, rel_tol=1e-4)
    whole = wc.score(counts, weights, code, read)
    monkeypatch.setattr(wc, "BLOCK_TOKENS", 3)
    assert np.allclose(wc.score(counts, weights, code, read), whole)


@pytest.mark.parametrize("hot", [0, 2, 50])
def test_texts_are_read_as_their_words(hot):
    texts = [(text or "").encode() for _, text in ODD] + [b"\xff\xfe THE the", b"a  b\x85c "] * 3
    plain_words = [[*text.lower().split(), b"\n"] for text in texts]
    counts = Counter(word for words in plain_words for word in words).most_common(hot)
    code = wc.Code([w for w, _ in counts], [n for _, n in counts], 3)
    column = pa.array(texts, pa.binary()).slice(1)
    far, at = Counter(), 0
    for first, some in wc.slices(column, 60_000):
        assert first == at
        read = code.read_texts(some)
        again = code.unwritten(*code.written(read), len(read.numbers))
        for text, (numbers, hashes) in enumerate(wc.texts(*again, read.start)):
            expected = code.read(plain_words[1 + first + text])
            assert (numbers == expected[0]).all() and (hashes == expected[1]).all()
            assert read.sizes[text] == sum(map(len, plain_words[1 + first + text])) + len(numbers)
        words = read.far.view(pa.binary()).to_pylist()
        far.update((first + t, words[w]) for t, w in zip(read.far_text.tolist(), read.far_word.tolist()))
        at += len(some)
    assert at == len(column)
    known = {w for w, _ in counts}
    assert far == Counter((t, w) for t, words in enumerate(plain_words[1:]) for w in words if w not in known)


def test_beginnings_in_common_are_scored_once():
    words = sorted({f"{a}{b}{c}".encode() for a in ("pre", "un", "") for b in "abcdefgh" for c in ("ing", "ed", "é")})
    whole, once = lm.Bits(words), lm.Bits(words, shared=True)
    assert len(once.at) == len({(word + b" ")[: end + 1] for word in words for end in range(len(word) + 1)}) < len(whole.at)
    assert (once.bits[once.of] == whole.bits).all() and (once.at[once.of] == whole.at).all()
    assert all((a[once.of] == b).all() for a, b in zip(once.slots, whole.slots))


def test_bits_are_counted_in_little_time():
    """Counting the bits took most of the whole query's time."""
    words = [b"w%d" % i for i in range(3000)]
    code = wc.Code(words, [3000 // (i + 1) + 1 for i in range(3000)], 3)
    rng = np.random.default_rng(5)
    steps = [*wc.blocks(code, [code.read([words[i] for i in rng.integers(0, 3000, 40_000)])])]
    best = {}
    for name, one in (("mine", None), ("plain", 1)):
        for _ in range(3):
            tables = [np.zeros(size, np.int32) for size in code.sizes]
            began = time.thread_time()
            for some in steps:
                if one is None:
                    wc.add(tables, some)
                else:
                    for table, cells in zip(tables, some.cells):
                        np.add.at(table, cells.astype(np.int64), one)
            took = time.thread_time() - began
            best[name] = min(best.get(name, took), took)
        best[name + "_sums"] = [int(table.sum()) for table in tables]
    assert best["mine_sums"] == best["plain_sums"]
    assert best["mine"] < 0.7 * best["plain"]


def test_weights_equal_plain_sums_by_gate_and_contexts_need_no_nodes():
    """Looking up nodes that contexts do not need, and adding up gate by gate with bincount, took the query over its time."""
    words = [b"w%d" % i for i in range(300)]
    code = wc.Code(words, [3000 // (i + 1) + 1 for i in range(300)], 3)
    rng = np.random.default_rng(7)
    texts = [code.read([words[i] for i in rng.zipf(1.3, n) % 300]) for n in (0, 5, 9_000, 700)]
    tables = [np.zeros(size, np.int32) for size in code.sizes]
    for steps in wc.blocks(code, texts):
        wc.add(tables, steps)
    alone, code.nodes = code.nodes, None
    again = [np.zeros(size, np.int32) for size in code.sizes[1:]]
    for steps in wc.blocks(code, texts):
        wc.add(again, steps, 1)
    code.nodes = alone
    assert all((a == b).all() for a, b in zip(tables[1:], again))
    counts = [wc.short(table.reshape(-1, 2)) for table in tables]
    weights, speed, size = wc.first_weights(), np.full((wc.GATES, wc.INPUTS), 1e-4), 0
    for steps in wc.blocks(code, texts):
        found = [wc.stretched(both, 1)[cells] for both, cells in zip(counts, steps.cells)]
        x = [*(says.astype(float) * wc.GRAIN - wc.WIDEST for says in found), np.ones(len(steps.bits))]
        gates = (found[1] & 3) * 4 + (found[2] & 3)
        raw = np.clip(sum(weights[gates, i] * given for i, given in enumerate(x)), -wc.MOST, wc.MOST)
        error = steps.bits - 1 / (1 + np.exp(-raw))
        total = np.bincount(gates, minlength=wc.GATES)[:, None] + 1e-9
        slope = np.stack([np.bincount(gates, error * given, wc.GATES) for given in x], axis=1) / total
        speed += slope**2
        weights, size = weights + wc.SPEED * slope / np.sqrt(speed), size + len(steps.bits)
    mine, bits = wc.train(counts, code, texts)
    assert bits == size and np.allclose(mine, weights, atol=1e-4)


def private_megabytes():
    with open("/proc/self/smaps_rollup") as shown:
        return sum(map(int, re.findall(r"\nPss_Anon:\s+(\d+)", shown.read()))) / 1024


def test_a_pass_leaves_nothing_in_reserve():
    """What Arrow kept in workers stood beside the next pass's tables: over 3000 MB an executor."""
    rng = np.random.default_rng(3)
    texts = [" ".join(map(str, rng.integers(0, 10**6, 400).tolist())).encode() for _ in range(8_000)]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.binary()), "held_out": pa.array([False] * len(texts))})
    del texts
    pa.default_memory_pool().release_unused()
    before = private_megabytes()
    assert sum(sum(told["every"].to_pylist()) for told in lm.released(lm.counted_words)(iter([batch]))) == 8_000 * 401
    assert private_megabytes() - before < 60  # 101 with what the pool keeps by itself


def test_stretched_tables_go_with_their_counts():
    words = [b"a", b"b", b"c"]
    code = wc.Code(words, [3, 2, 1], 1)
    counts = [wc.short(np.ones((size // 2, 2))) for size in code.sizes]
    held = wc.ready(counts, 0, code)
    assert wc.ready(counts, 0, code) is held and wc.ready(counts, 1, code) is not held
    del counts, held
    assert wc._ready is None


def test_bits_are_counted_in_four_bytes_and_wider_where_they_must():
    words = [b"the", b"then", b"x" * 50]
    for times, kind in (([7, 2, 3], np.int32), ([1 << 33, 5, 1 << 30], np.int64)):
        held = lm.BitTables()
        for word, n in zip(words, times):
            held.add([word], np.array([n]))
        bits = lm.Bits(words)
        weight = np.repeat(np.array(times)[bits.word], 8)
        for table, slots, power in zip(held.tables, bits.slots, lm.SLOTS):
            plain_table = np.zeros(2 << power, np.int64)
            np.add.at(plain_table, (slots * 2 + bits.bits).ravel(), weight)
            assert table.dtype == kind and (table == plain_table).all()
