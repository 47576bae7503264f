"""Language-model scores: logistic mixing of hashed-context bit predictors.

Words are coded bit by bit in the context of the words before (word_contexts);
those that are not frequent are spelled behind an escape, byte by byte.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statement_lake.llm import word_contexts
from statement_lake.session import settle

#: Slots (as a power of two) of the predictors that see the last 0, 1, 2 and 3 bytes of a word, and all before.
SLOTS = (8, 16, 20, 20, 22)
#: Slots of a predictor that are summed and sent together (as a power of two).
CHUNK = 16
#: Bytes of words that are worked on at a time, when learning weights and otherwise.
STEP, BLOCK = 1 << 13, 1 << 15
#: Frequent training words, which have a code of their own; the others are spelled, and their scores joined.
HOT_WORDS = 65_536
#: Words whose beginnings are looked at together.
HELD_WORDS = 100_000
#: A word's end; its byte cannot be in a word.
WORD_END = b" "
#: Pseudo-count of a bit, gates, cells of the refining table, speed of the weights.
PRIOR, GATES, CELLS, SPEED = 0.4, 48, 33, 0.05
LEAST = 1e-6


#: Of each byte the nodes that its bits are told at (the bits before, with a leading one), and the bits.
NODES = (256 + np.arange(256)[:, None]) >> (8 - np.arange(8))
SIDES = ((np.arange(256)[:, None] >> (7 - np.arange(8))) & 1).astype(np.int8)
ODD = np.uint64(0x9E3779B97F4A7C15)


def node_offsets(power: int) -> np.ndarray:
    """What the slots of a byte's bits differ by from that of their context; those of half a byte are neighbours."""
    late = NODES >= 16
    root = np.where(late, 16 + (np.arange(256)[:, None] >> 4), 1).astype(np.uint64)
    place = np.where(late, (NODES & ((1 << (np.arange(8) - 4).clip(0)) - 1)) | 1 << (np.arange(8) - 4).clip(0), NODES)
    if power == 8:
        return NODES
    mixed = root * np.uint64(0xD6E8FEB86659FD93)
    mixed = (mixed ^ (mixed >> np.uint64(32))) * ODD
    return (mixed >> np.uint64(64 - power)).astype(np.int64) ^ place


OFFSETS = {power: node_offsets(power) for power in SLOTS}


class Bits:
    """The bits of some words, each with its slot in every predictor."""

    def __init__(self, words: list[bytes], shared: bool = False):
        """shared: the bits of a beginning that several words have stand here once; `of` tells each byte's place."""
        data = np.frombuffer(WORD_END.join([*words, b""]), np.uint8)
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        self.word = np.repeat(np.arange(len(words)), sizes)
        self.begin = np.cumsum(sizes) - sizes
        self.at = np.arange(len(data)) - self.begin[self.word]
        powers = np.cumprod(np.full(int(sizes.max()), ODD))
        terms = (data.astype(np.uint64) + np.uint64(1)) * powers[self.at]
        sums = np.concatenate([[np.uint64(0)], np.cumsum(terms)])
        before = sums[self.begin].take(self.word)
        contexts = [np.zeros(len(data), np.uint64)]
        recent = np.zeros(len(data), np.uint64)
        for back in (1, 2, 3):
            byte = np.zeros(len(data), np.uint64)
            byte[back:] = data[:-back]
            recent = recent + np.where(self.at >= back, byte + np.uint64(1), np.uint64(0)) * np.uint64(257 ** (back - 1))
            contexts.append(recent)
        contexts.append(sums[:-1] - before)
        if shared:
            _, first, self.of = np.unique(sums[1:] - before, return_index=True, return_inverse=True)
            data, self.at = data[first], self.at[first]
            contexts = [context[first] for context in contexts]
        self.bits = SIDES.take(data, axis=0)
        self.slots = []
        for context, power in zip(contexts, SLOTS):
            key = (context ^ (context >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
            key = (key ^ (key >> np.uint64(32))) * ODD
            first = (key >> np.uint64(64 - power)).astype(np.int64)[:, None]
            self.slots.append(first ^ OFFSETS[power].take(data, axis=0))


def blocks(words: list[bytes], size: int) -> Iterator[tuple[int, int]]:
    """Ranges of words with about this many bytes together, a word at least."""
    begin, held = 0, 0
    for i, word in enumerate(words):
        held += len(word) + 1
        if held >= size:
            yield begin, i + 1
            begin, held = i + 1, 0
    if begin < len(words):
        yield begin, len(words)


#: Stretched predictions are held within this on either side; a step of a quarter of 14 bits.
WIDEST = np.float32(24)
GRAIN = 2 * WIDEST / np.float32(65_535)
#: Levels of how often the last three bytes, and all bytes before, were seen.
LEVELS = {3: (1, 16, 256), 4: (1, 3, 16)}


def stretched(counts: np.ndarray, order: int, own: int) -> np.ndarray:
    """What a slot says of a bit in 14 bits, then its level; own: two a slot, each without one of that bit."""
    found = np.empty((len(counts), 2 if own else 1), np.uint16)
    for at in range(0, len(counts), 1 << CHUNK):  # some at a time, as workers have little room
        for bit in range(found.shape[1]):
            zero, one = counts[at : at + (1 << CHUNK)].T
            if own:
                zero, one = np.maximum(zero - np.float32(1 - bit), 0), np.maximum(one - np.float32(bit), 0)
            says = np.log((one + np.float32(PRIOR)) / (zero + np.float32(PRIOR)))
            says = np.rint((np.clip(says, -WIDEST, WIDEST) + WIDEST) * np.float32(0.25) / GRAIN)
            seen = zero + one
            level = sum((seen >= least).astype(np.uint16) for least in LEVELS.get(order, (1,)))
            found[at : at + (1 << CHUNK), bit] = np.minimum(says, 16_383).astype(np.uint16) << np.uint16(2) | level
    return found.ravel()


def inputs(tables: list[np.ndarray], bits: Bits, own: int) -> tuple[list[np.ndarray], np.ndarray]:
    """(stretched predictions (bytes, 8), gates: by how often its whole prefix and its last three bytes were seen)."""
    found = [table.take(slots * 2 + bits.bits if own else slots) for table, slots in zip(tables, bits.slots)]
    near, whole = (found[order] & np.uint16(3) for order in (3, 4))
    place = np.minimum(bits.at, 2).astype(np.uint16)[:, None]
    gates = (whole * np.uint16(4) + near) * np.uint16(3) + place
    return [says * GRAIN - WIDEST for says in found], gates.astype(np.int64)


def squash(x: np.ndarray) -> np.ndarray:
    return np.clip(1 / (1 + np.exp(-np.clip(x, -30, 30))), LEAST, 1 - LEAST)


def cell(x: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(x * 2) + CELLS // 2, 0, CELLS - 1).astype(np.int64)


def mixed(weights: np.ndarray, x: list[np.ndarray], gates: np.ndarray) -> np.ndarray:
    columns = np.ascontiguousarray(weights.T)
    found = columns[-1].take(gates)
    for column, given in zip(columns, x):
        found += column.take(gates) * given
    return found


def first_weights() -> np.ndarray:
    return np.tile(np.float32([0.05, 0.1, 0.2, 0.3, 0.4, 0.0]), (GATES, 1))


def train_mixer(counts: list[np.ndarray], words: list[bytes], times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(weights, refining table) after one pass over the words, each as often as it occurs.

    A bit is predicted from the counts without one of its own occurrences, so
    that words are met as if they were new.
    """
    weights, speed = first_weights(), np.full((GATES, len(SLOTS) + 1), 1e-4)
    table = np.zeros((GATES * CELLS, 2))
    tables = [stretched(held, order, 1) for order, held in enumerate(counts)]
    for low, high in blocks(words, STEP):
        bits = Bits(words[low:high], shared=True)
        x, gates = inputs(tables, bits, 1)
        raw = mixed(weights, x, gates)
        weight = np.bincount(bits.of, times[low:high][bits.word], len(bits.at))
        weight = np.repeat(weight.astype(np.float32), 8).reshape(-1, 8)
        flat = (gates * CELLS + cell(raw)) * 2 + bits.bits
        met = np.bincount(flat.ravel(), weight.ravel(), table.size).reshape(table.shape)
        table += met
        error = (bits.bits - squash(raw)) * weight
        total = met.reshape(GATES, -1).sum(axis=1, keepdims=True) + 1e-9
        sums = [np.bincount(gates.ravel(), (error * given).ravel(), GATES) for given in x]
        slope = np.stack([*sums, np.bincount(gates.ravel(), error.ravel(), GATES)], axis=1) / total
        speed += slope**2
        weights = weights + (SPEED * slope / np.sqrt(speed)).astype(np.float32)
    return weights, table


def word_scores(
    counts: list[np.ndarray], weights: np.ndarray, table: np.ndarray, words: list[bytes], tables: list | None = None
) -> np.ndarray:
    """log10 probability of each word with its end; tables: stretched of the counts, if at hand."""
    centres = np.tile(squash((np.arange(CELLS) - CELLS // 2) / 2), GATES)
    refined = (table[:, 1] + 4 * centres) / (table.sum(axis=1) + 4)
    refined = np.clip(refined, LEAST, 1 - LEAST)
    bend = np.log(refined / (1 - refined)).astype(np.float32)
    tables = tables or [stretched(held, order, 0) for order, held in enumerate(counts)]
    order = sorted(range(len(words)), key=words.__getitem__)  # beginnings in common stand together
    words = [words[n] for n in order]
    out = np.zeros(len(words))
    for low, high in blocks(words, BLOCK):
        bits = Bits(words[low:high], shared=True)
        x, gates = inputs(tables, bits, 0)
        raw = mixed(weights, x, gates)
        both = (raw + bend.take(gates * CELLS + cell(raw))) / 2
        cost = np.log10(squash(both * (2 * bits.bits - 1).astype(np.float32))).sum(axis=1)
        out[order[low:high]] = np.add.reduceat(cost.take(bits.of), bits.begin, dtype=np.float64)
    return out


def _column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(name).to_pylist()


def grouped(batches: Iterator[pa.RecordBatch], size: int = HELD_WORDS) -> Iterator[pa.RecordBatch]:
    """Batches of about this many rows: more words have more beginnings in common."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= size:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, rows = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


Pass = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def released(function: Pass) -> Pass:
    """The same pass; before it and after it the worker gives back what Arrow holds in reserve.

    Workers are used again: what was kept of one pass would stand beside the tables of the next.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.default_memory_pool().release_unused()
        yield from function(batches)
        pa.default_memory_pool().release_unused()

    return run


def counted_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, learned, every) of the texts of each batch, held out or not."""
    for batch in batches:
        for out in (True, False):
            texts = batch.column("text").filter(pc.equal(batch.column("held_out"), out))
            if not len(texts):
                continue
            found = [word_contexts.split(some)[0] for _, some in word_contexts.slices(texts)]
            words, times = pa.chunked_array(found).value_counts().flatten()
            words = pa.concat_arrays([words.cast(pa.string()), pa.array([word_contexts.TEXT_END.decode()])])
            times = np.append(times.to_numpy(), len(texts))
            yield pa.RecordBatch.from_arrays(
                [words.view(pa.binary()), pa.array(0 * times if out else times), pa.array(times)],
                ["word", "learned", "every"],
            )


def count_words(rows: DataFrame) -> DataFrame:
    """(word, learned, every): how often each token occurs, in the training documents and in all."""
    found = rows.select("text", "held_out").mapInArrow(
        released(counted_words), "word binary, learned long, every long"
    )
    return found.groupBy("word").agg(F.sum("learned").alias("learned"), F.sum("every").alias("every"))


TABLE_SCHEMA = "predictor int, chunk int, cells int, counts binary"


def packed(counts: np.ndarray) -> bytes:
    """Whole numbers, in four bytes each where that holds them: the size, then what zstd makes of them."""
    kind = np.int32 if counts.max(initial=0) < 1 << 31 else np.int64
    return bytes([np.dtype(kind).itemsize]) + pa.Codec("zstd", 1).compress(counts.astype(kind).tobytes(), asbytes=True)


def unpacked(blob: bytes, size: int) -> np.ndarray:
    found = pa.Codec("zstd").decompress(blob[1:], size * blob[0])
    return np.frombuffer(found, np.int32 if blob[0] == 4 else np.int64)


def told_tables(tables: list[np.ndarray], first: int = 0) -> Iterator[pa.RecordBatch]:
    """Tables of fixed size in chunks; first: the number of the first one."""
    for order, table in enumerate(tables, first):
        for chunk, at in enumerate(range(0, len(table), 2 << CHUNK)):
            part = table[at : at + (2 << CHUNK)]
            yield pa.RecordBatch.from_pydict(
                {"predictor": pa.array([order], pa.int32()), "chunk": pa.array([chunk], pa.int32()),
                 "cells": pa.array([len(part)], pa.int32()), "counts": pa.array([packed(part)], pa.binary())}
            )


def summed_tables(found: DataFrame, cells: list[int], label: str) -> list[np.ndarray]:
    """The sum of the tasks' tables, (slots, 2) each; their size is what reaches the driver."""

    def added(parts: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(int(parts["cells"].iloc[0]), np.int64)
        for blob in parts["counts"]:
            total += unpacked(blob, len(total))
        return parts.iloc[:1].assign(counts=[packed(total)])

    found = found.groupBy("predictor", "chunk").applyInPandas(added, TABLE_SCHEMA)
    tables = [np.zeros(size, np.float32) for size in cells]
    for row in settle(found, label).toLocalIterator():
        at = row["chunk"] * (2 << CHUNK)
        tables[row["predictor"]][at : at + row["cells"]] = unpacked(bytes(row["counts"]), row["cells"])
    return [table.reshape(-1, 2) for table in tables]


def summed_places(found: DataFrame, size: int) -> np.ndarray:
    """The sum of the tasks' numbers, place by place."""
    sums = np.zeros(size)
    for row in found.groupBy("place").agg(F.sum("value").alias("value")).collect():  # `size` rows at most
        sums[row["place"]] = row["value"]
    return sums


class BitTables:
    """Counts of bits in the slots of each predictor, two cells a slot; four bytes a cell as long as they must hold them."""

    def __init__(self):
        self.tables, self.most = [np.zeros(2 << power, np.int32) for power in SLOTS], 0

    def add(self, words: list[bytes], times: np.ndarray) -> None:
        bits = Bits(words, shared=True)
        weight = np.repeat(np.bincount(bits.of, times[bits.word], len(bits.at)).astype(np.int64), 8)
        self.most += int(weight.sum())  # no cell has more
        if self.most >= 1 << 31 and self.tables[0].dtype == np.int32:
            for n, table in enumerate(self.tables):
                self.tables[n] = table.astype(np.int64)
        weight = weight.astype(self.tables[0].dtype)  # numpy takes a slow way round for another type
        for table, slots in zip(self.tables, bits.slots):
            np.add.at(table, (slots * 2 + bits.bits).ravel(), weight)


def learn_counts(words: DataFrame) -> list[np.ndarray]:
    """For each predictor (slots, 2) counts of bits, over all training words.

    A task adds up its words in tables of fixed size; chunks of the tables are
    summed by their number.  What reaches the driver has the size of the tables.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, some = BitTables(), False
        for batch in grouped(batches):
            names, times = _column(batch, "word"), batch.column("learned").to_numpy()
            order = sorted(range(len(names)), key=names.__getitem__)  # beginnings in common stand together
            names, times = [names[n] for n in order], times[order]
            for low, high in blocks(names, BLOCK):
                some = True
                held.add(names[low:high], times[low:high])
        if some:
            yield from told_tables(held.tables)

    found = words.where("learned > 0").mapInArrow(released(counted), TABLE_SCHEMA)
    return summed_tables(found, [2 << power for power in SLOTS], "lm-bits")


def learn_mixer(words: DataFrame, counts) -> tuple[np.ndarray, np.ndarray]:
    """Weights, averaged over the tasks by their tokens, and the sum of their refining tables.

    The tasks learn side by side; their numbers are summed place by place, so
    the driver gets one of each, however many tasks there are.
    """

    def trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, times = [], []
        for batch in batches:
            names += _column(batch, "word")
            times.append(batch.column("learned").to_numpy())
        if names:
            times = np.concatenate(times)
            weights, table = train_mixer(counts.value, names, times)
            share = float(times.sum())
            values = np.concatenate([[share], share * weights.ravel(), table.ravel()])
            yield pa.RecordBatch.from_pydict({"place": np.arange(len(values)), "value": values})

    found = words.where("learned > 0").mapInArrow(released(trained), "place long, value double")
    sums = summed_places(found, 1 + GATES * (len(SLOTS) + 1) + GATES * CELLS * 2)
    total, weights, table = np.split(sums, [1, 1 + GATES * (len(SLOTS) + 1)])
    weights = weights.reshape(GATES, -1) / total if total[0] else first_weights()
    return weights.astype(np.float32), table.reshape(-1, 2)


READ_SCHEMA = (
    "row long, doc_id long, held_out boolean, word binary, n long, size long, known long, base double, "
    "rows binary, starts binary, numbers binary, hashes binary"
)
READ_KINDS = [
    pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.float64(),
    pa.binary(), pa.binary(), pa.binary(), pa.binary(),
]
READ_NAMES = [column.split()[0] for column in READ_SCHEMA.split(", ")]


def read_texts(rows: DataFrame, code, hot_base: np.ndarray) -> DataFrame:
    """Three kinds of rows, so that texts are cut into words once.

    A row a text with what its frequent words settle; a row a text and word
    behind an escape (word, n); a row for some texts together (rows, starts,
    numbers, hashes), all held out or none, which the passes over words read.
    """

    def told(many: int, **given) -> pa.RecordBatch:
        columns = [given.get(name) for name in READ_NAMES]
        columns = [pa.nulls(many) if c is None else c for c in columns]
        columns = [c.cast(k) if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(columns, READ_KINDS)]
        return pa.RecordBatch.from_arrays(columns, READ_NAMES)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for out in (True, False):
                chosen = batch.filter(pc.equal(batch.column("held_out"), out))
                for first, texts in word_contexts.slices(chosen.column("text")):
                    ids, docs = (chosen.column(c).slice(first, len(texts)) for c in ("row", "doc_id"))
                    found = code.value.read_texts(texts)
                    pairs, times = np.unique(found.far_text * len(found.far) + found.far_word, return_counts=True)
                    if len(pairs):
                        of, word = np.divmod(pairs, len(found.far))
                        yield told(len(pairs), row=ids.take(pa.array(of)), word=found.far.take(pa.array(word)), n=times)
                    start = found.start
                    known = np.add.reduceat((found.numbers != code.value.escape).astype(np.int64), start[:-1])
                    base = np.add.reduceat(hot_base[found.numbers], start[:-1])
                    yield told(len(texts), row=ids, doc_id=docs, held_out=[out] * len(texts), n=np.diff(start),
                               size=found.sizes, known=known, base=base)
                    numbers, hashes = code.value.written(found)
                    yield told(1, held_out=[out], rows=[ids.to_numpy().tobytes()], starts=[start.astype(np.int64).tobytes()],
                               numbers=[numbers], hashes=[hashes])

    return settle(rows.mapInArrow(released(read), READ_SCHEMA), "lm-read")


def read_again(batches: Iterator[pa.RecordBatch], code) -> Iterator[tuple[np.ndarray, list]]:
    """(row numbers, texts as numbers and hashes) of some texts together."""
    for batch in batches:
        for rows, starts, numbers, hashes in zip(*(batch.column(c) for c in ("rows", "starts", "numbers", "hashes"))):
            start = np.frombuffer(starts.as_py(), np.int64)
            found = code.unwritten(numbers.as_py(), hashes.as_py(), int(start[-1]))
            yield np.frombuffer(rows.as_py(), np.int64), list(word_contexts.texts(*found, start))


def learn_contexts(lessons: DataFrame, code) -> list[np.ndarray]:
    """Counts of the code's bits, alone and in the contexts of all training texts."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [np.zeros(size, np.int32) for size in code.value.sizes[1:]]
        some = False
        texts = (text for _, texts in read_again(batches, code.value) for text in texts)
        for steps in word_contexts.blocks(code.value, texts):
            some = True
            word_contexts.add(tables, steps, 1)
        if some:
            yield from told_tables(tables, 1)

    tables = summed_tables(lessons.mapInArrow(released(counted), TABLE_SCHEMA), code.value.sizes, "lm-contexts")
    return [word_contexts.short(table) for table in [code.value.alone, *tables[1:]]]


def learn_context_weights(lessons: DataFrame, code, counts) -> np.ndarray:
    """Weights of the predictors over words, averaged over the tasks by their bits."""

    def trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = (text for _, texts in read_again(batches, code.value) for text in texts)
        weights, share = word_contexts.train(counts.value, code.value, texts)
        values = np.concatenate([[float(share)], share * weights.ravel().astype(float)])
        yield pa.RecordBatch.from_pydict({"place": np.arange(len(values)), "value": values})

    first = word_contexts.first_weights()
    sums = summed_places(lessons.mapInArrow(released(trained), "place long, value double"), 1 + first.size)
    return (sums[1:].reshape(first.shape) / sums[0]).astype(np.float32) if sums[0] else first


def held_out(id_column: str = "doc_id") -> Column:
    """Documents that nothing is learned from."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit(""))) % 5 == 1


def score_texts(
    documents: DataFrame,
    held: Column | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    hot_words: int = HOT_WORDS,
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte), one row a document row.

    base_score: the log10 probability of the tokens by their smoothed shares in
    the training documents.  score: their log10 probability by the mixing model,
    which codes each word bit by bit in the contexts of no, one and two words
    before.  Words that are not among the most frequent of the training documents
    follow an escape and are spelled, from contexts inside the word, so that this
    part of their probability is worked out once.  bits_per_byte is the score over
    the bytes of the tokens and their ends.

    Null texts count as empty: the end alone.  Rows with null or equal doc_ids
    have their own rows.  Without training documents the counts are 0 and the
    model is its starting state.  No rows: no rows.  Other columns are ignored.
    """
    spark: SparkSession = documents.sparkSession
    held = held_out(id_column) if held is None else held
    rows = documents.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_column), F.lit("")).cast("binary").alias("text"),
        F.coalesce(held, F.lit(False)).alias("held_out"),
    )
    words = settle(count_words(rows), "lm-words")
    n, v = words.agg(F.sum("learned"), F.count_if(F.col("learned") > 0)).first()
    n, v = n or 0, v or 0
    counts = spark.sparkContext.broadcast(learn_counts(words))
    weights, table = learn_mixer(words, counts)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = []
        for batch in grouped(batches):
            tables = tables or [stretched(held, order, 0) for order, held in enumerate(counts.value)]
            score = word_scores(counts.value, weights, table, _column(batch, "word"), tables)
            base = np.log10((batch.column("learned").to_numpy() + 0.5) / (n + 0.5 * (v + 1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), batch.column("learned"), batch.column("every"), pa.array(base), pa.array(score)],
                ["word", "learned", "every", "base", "score"],
            )

    costs = settle(
        words.mapInArrow(released(scored), "word binary, learned long, every long, base double, score double"),
        "lm-scores",
    )
    counts.destroy()  # the spelling costs are written; workers hold one model at a time
    known = words.where("learned > 0")
    top = known.orderBy(F.desc("learned"), "word").limit(hot_words).collect()  # a fixed number
    hot, times = [bytes(r["word"]) for r in top], [r["learned"] for r in top]
    code = spark.sparkContext.broadcast(word_contexts.Code(hot, times, n - sum(times)))
    hot_base = np.append(np.log10((np.array(times) + 0.5) / (n + 0.5 * (v + 1))), 0.0)
    numbered = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text", "held_out")
    parts = read_texts(numbered, code, hot_base)
    together = parts.where("numbers IS NOT NULL").select("held_out", "rows", "starts", "numbers", "hashes")
    lessons = together.where("NOT held_out").drop("held_out")
    contexts = spark.sparkContext.broadcast(learn_contexts(lessons, code))
    context_weights = learn_context_weights(lessons, code, contexts)

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in read_again(batches, code.value):
            score = word_contexts.score(contexts.value, context_weights, code.value, texts)
            yield pa.RecordBatch.from_pydict({"row": rows, "score": score})

    coded = together.drop("held_out").mapInArrow(released(follow), "row long, score double")
    sums = ["n", "size", "known", "base", "score"]
    empty = {c: F.lit(0).cast("double" if c in ("base", "score") else "long") for c in sums}
    none = {"doc_id": F.lit(None).cast("long"), "held_out": F.lit(None).cast("boolean")}
    coded = coded.select("row", *(v.alias(c) for c, v in none.items()), *(empty[c].alias(c) for c in sums[:-1]), "score")
    # a word has one row of costs, so that no partition's table of them grows with a frequent word
    rest = parts.where("word IS NOT NULL").select("row", "word", "n").join(costs.hint("shuffle_hash"), "word")
    rest = rest.select(
        "row", *(v.alias(c) for c, v in none.items()), empty["n"].alias("n"), empty["size"].alias("size"),
        F.when(F.col("learned") > 0, F.col("n")).otherwise(0).alias("known"),
        (F.col("n") * F.col("base")).alias("base"), (F.col("n") * F.col("score")).alias("score"),
    )
    texts = parts.where("size IS NOT NULL").select("row", "doc_id", "held_out", *sums[:-1], empty["score"].alias("score"))
    whole = texts.unionByName(coded).unionByName(rest)
    return (
        whole.groupBy("row")
        .agg(
            F.max("doc_id").alias("doc_id"),
            F.max("held_out").alias("held_out"),
            F.sum("n").alias("n_tokens"),
            F.sum("known").alias("n_known"),
            F.lit(n).cast("long").alias("train_tokens"),
            F.sum("base").alias("base_score"),
            F.sum("score").alias("score"),
            F.sum("size").alias("size"),
        )
        .withColumn("bits_per_byte", -F.col("score") * float(np.log2(10)) / F.col("size"))
        .drop("row", "size")
    )
