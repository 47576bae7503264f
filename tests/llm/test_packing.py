"""Packing: pieces against the tokenizer itself, the plan against best fit one by one."""

import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from statement_lake.llm import packing

PATH = public_tokenizers.path(packing.TOKENIZER)


def one_by_one(lengths, capacity):
    """Best-fit decreasing with a look at every bin for every piece."""
    bins = []
    for n in sorted(lengths, reverse=True):
        fitting = [b for b in range(len(bins)) if bins[b] >= n]
        if fitting:
            bins[min(fitting, key=lambda b: bins[b])] -= n
        else:
            bins.append(capacity - n)
    return sorted(bins)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 30), st.integers(1, 40)), max_size=12), st.integers(30, 64))
def test_plan_equals_best_fit_one_by_one(counts, capacity):
    totals = {}
    for length, n in counts:
        totals[length] = totals.get(length, 0) + n
    runs = packing.plan(totals.items(), capacity)
    placed, used = {}, {}
    for length, low, high, first, each, base in runs:
        for rank in range(low, high):
            sequence, offset = first + (rank - low) // each, base + (rank - low) % each * length
            assert (length, rank) not in placed
            placed[length, rank] = sequence
            used.setdefault(sequence, []).append((offset, length))
    assert len(placed) == sum(totals.values())
    for spans in used.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    rooms = sorted(capacity - sum(n for _, n in spans) for spans in used.values())
    assert rooms == one_by_one([n for n, c in totals.items() for _ in range(c)], capacity)


def expected_pieces(rows, length):
    tokenizer = Tokenizer.from_file(PATH)
    out = []
    for doc, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for piece, at in enumerate(range(0, len(ids), length)):
            part = ids[at : at + length]
            out.append((doc, piece, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    return out


@pytest.mark.parametrize("length", [8, 4096])
def test_pieces_and_places(spark, length):
    rows = [
        (1, "Hello, World! it's 12.5 é ÉCOLE"), (2, None), (3, ""), (4, " \t\n"), (None, "no id"), (5, "same"),
        (5, "same"), (6, "a b c\x1cd é ́x"), (7, "ΑΣ ΣΑΣ İ ǅ"), (8, "<|endoftext|> x<|endoftext|>"),
        (9, "they're we'll don't 's"), (10, "x" * 5000), (11, "word " * 9000), (12, "日本語テキスト 🎉🎉"),
    ]
    rows += [(100 + i, "tie " * (i % 7)) for i in range(60)]
    frame = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, bucket int")
    found = packing.best_fit(frame, PATH, length, bucket_rows=10).collect()
    assert sorted((tuple(r)[:5] for r in found), key=repr) == sorted(
        expected_pieces(rows, length), key=repr
    )
    used = {}
    for r in found:
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in used.values():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at
            at += n
        assert at <= length
    assert len(used) == len(one_by_one([r.length for r in found], length))


@pytest.mark.parametrize("remembered", [packing.REMEMBERED, 20_000])
def test_remembered_words_equal_the_tokenizer(remembered):
    """10,000 texts with added tokens in them, against a tokenizer fresh from the file."""
    tokenizer, found = Tokenizer.from_file(PATH), packing.Encoder(PATH, remembered)
    assert found.word_by_word
    random = np.random.default_rng(6)
    bits = [*"aZé'sß.9²½ªµ-ÀÿÑ\xa0\x85\x1c\xadﬁ°Σςİ́ \n<|>", "<|endoftext|>", "<|startoftext|>", "<|EndOfText|>"]
    for _ in range(10_000):
        text = "".join(bits[i] for i in random.integers(0, len(bits), random.integers(0, 30)))
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert found.ids([text.encode()]) == [np.array(ids, "<u4").tobytes()], repr(text)


def test_other_files_are_read_by_their_own_rules():
    """A second file in one worker gets its own ids, whatever the first one remembered."""
    other = public_tokenizers.path("byte_bpe_50k.json")
    text = "Hello,  World! it's 12.5 <|endoftext|> é"
    for path in (PATH, other, PATH):
        ids = Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
        assert packing.encoder(path).ids([text.encode()]) == [np.array(ids, "<u4").tobytes()]
    assert not packing.Encoder(other).word_by_word


def test_what_is_remembered_is_bounded():
    held = packing.Remembered(100_000)
    for i in range(5_000):
        held.put({f"word{i}": b"1234"})
        held.age()
    assert len(held.young) + len(held.old) <= 100_000 // packing.ENTRY
    assert held.absent({"word4999", "word0"}) == ["word0"]


def test_stretches_keep_every_byte():
    random = np.random.default_rng(2)
    for _ in range(200):
        texts = [bytes(random.choice(list(b"ab \n"), random.integers(0, 40))) for _ in range(8)]
        found = [b""] * len(texts)
        for some in packing.stretches(texts, 16):
            for number, part in some:
                found[number] += part
        assert found == texts
        words = [w for some in packing.stretches(texts, 16) for _, part in some for w in part.split()]
        assert words == [w for text in texts for w in text.split()]


def test_no_rows(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert packing.best_fit(frame, PATH).count() == 0


def test_remembered_bytes_do_not_change_pieces(spark):
    frame = spark.createDataFrame([(i, f"word{i} in a text of {i * i} words " * 30) for i in range(200)], "doc_id long, text string")
    little, much = (packing.best_fit(frame, PATH, remembered=n) for n in (1 << 10, 1 << 24))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert little.select(columns).exceptAll(much.select(columns)).count() == 0 and little.count() == much.count()
    assert packing.encoder(PATH, 1 << 10).remembered == 1 << 10


def test_words_are_looked_up_once_for_many_texts():
    held = packing.Encoder(PATH)
    asked, absent = [], held.words.absent
    held.words.absent = lambda keys: asked.extend(keys) or absent(keys)
    texts = [b" alpha Beta " * 60_000, b"", b"\n", b"beta alpha\tBeta" * 20_000]
    found = held.ids(texts)
    plain = held.tokenizer.encode_batch([text.decode() for text in texts], add_special_tokens=False)
    assert [np.frombuffer(ids, "<u4").tolist() for ids in found] == [one.ids for one in plain]
    assert sorted(asked) == sorted({word for text in texts for word in text.split()})


def test_little_memory_where_little_is_remembered():
    """In the pipeline, columns of the words of 4 MB of text at once took an executor over its memory."""
    texts = [" ".join(f"word{i % 5000} the{i % 7}" for i in range(at, at + 20_000)).encode() for at in range(0, 10**6, 20_000)]
    before, column = pa.default_memory_pool(), pa.array(texts)
    found, peak = {}, {}
    for remembered in (packing.REMEMBERED, 32 << 20):
        held, pool = packing.Encoder(PATH, remembered), pa.proxy_memory_pool(before)
        pa.set_memory_pool(pool)
        try:
            some = (held.ids(part) for _, part in packing.groups(column, 2 * held.together))
            found[remembered] = sum(len(ids) for part in some for ids in part)
        finally:
            pa.set_memory_pool(before)
        peak[remembered] = pool.max_memory()
    assert found[packing.REMEMBERED] == found[32 << 20]
    assert peak[32 << 20] < 0.4 * peak[packing.REMEMBERED], peak
