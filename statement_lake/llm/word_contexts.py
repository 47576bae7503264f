"""Bit predictors over the words before: words coded by a prefix code, bits mixed from hashed contexts."""

from __future__ import annotations

import heapq
import weakref
import zlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Most slots (as a power of two) of the predictors that see the word before, and the two words before.
POWER = 22
#: Tokens that are worked on at a time, and bytes of texts that are cut into words at a time.
BLOCK_TOKENS, SLICE = 1 << 11, 1 << 21
#: Pseudo-count of a bit, gates (how often either context was seen), speed of the weights.
PRIOR, GATES, SPEED = 0.4, 16, 0.05
INPUTS = 4
#: Stretched predictions lie within this on either side, as counts have 16 bits; a step of a quarter of 14 bits.
WIDEST = np.float32(12.02)
GRAIN = 2 * WIDEST / np.float32(65_535)
#: Bound of a stretched probability: a bit has at least one part in a million.
MOST = np.float32(13.8)
#: Level of how often a context was seen.
LEVELS = np.searchsorted([1, 3, 16], np.arange(17), side="right").astype(np.uint32)
#: Bits in a row whose slots are neighbours: together they take one line of a cache.
TOGETHER = 4
ODD = 0x9E3779B97F4A7C15
#: The token that ends a document; its byte cannot be in a word.
TEXT_END = b"\n"


def slices(texts: pa.Array, size: int = SLICE) -> Iterator[tuple[int, pa.Array]]:
    """(number of the first, texts): some `size` bytes at a time, a text at least."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        before = int(ends[at - 1]) if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + size, side="right")))
        yield at, texts.slice(at, end - at)
        at = end


def split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of some texts in lower case (A-Z alone), cut at the six ASCII blanks, and each one's text."""
    kind = pa.large_string() if pa.types.is_large_binary(texts.type) else pa.string()
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.view(kind)))
    words, text = lists.flatten(), np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
    some = pc.greater(pc.binary_length(words), 0)
    if not pc.all(some).as_py():  # blanks at either end of a text leave an empty word there
        words, text = words.filter(some), text[some.to_numpy(zero_copy_only=False)]
    return words, text


class Read(NamedTuple):
    """Texts as numbers and hashes of their words, ends included; words behind an escape by their numbers in `far`."""

    numbers: np.ndarray
    hashes: np.ndarray
    start: np.ndarray
    sizes: np.ndarray
    far: pa.Array
    far_text: np.ndarray
    far_word: np.ndarray


def texts(numbers: np.ndarray, hashes: np.ndarray, start: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers and hashes of each text."""
    bounds = start.tolist()
    for low, high in zip(bounds, bounds[1:]):
        yield numbers[low:high], hashes[low:high]


class Code:
    """A Huffman code of frequent words and of an escape, whose number is the last one."""

    def __init__(self, words: list[bytes], times: list[int], escapes: int):
        # the tables grow with the training words: about a slot a word, as far as workers can hold them
        self.power = min(POWER, max(10, (sum(times) + escapes).bit_length()))
        self.number = {word: n for n, word in enumerate(words)}
        self.words = pa.array(words, pa.binary())
        self.escape = len(words)
        self.hashes = np.array([*map(zlib.crc32, words), 0], np.uint32)
        leaves = len(words) + 1
        heap = [(n, i) for i, n in enumerate([*times, max(escapes, 1)])]
        heapq.heapify(heap)
        above = np.zeros((2 * leaves, 2), np.int64)  # (node above, side) of a leaf or node
        for node in range(leaves, 2 * leaves - 1):
            (a, left), (b, right) = heapq.heappop(heap), heapq.heappop(heap)
            above[left], above[right] = (node, 0), (node, 1)
            heapq.heappush(heap, (a + b, node))
        steps, sides, nears, self.start = [], [], [], np.zeros(leaves + 1, np.int64)
        listed = above.tolist()
        for leaf in range(leaves):
            path, at = [], leaf
            while at != 2 * leaves - 2:
                at, side = listed[at]
                path.append((at - leaves, side))
            place = root = 0
            for depth, (node, side) in enumerate(reversed(path)):
                place, root = (2 * place + sides[-1], root) if depth % TOGETHER else (1, node)
                steps.append(node)
                sides.append(side)
                nears.append((root + 1) << TOGETHER | place)
            self.start[leaf + 1] = len(steps)
        steps, sides, self.start = np.array(steps, np.int64), np.array(sides, np.int64), self.start.astype(np.int32)
        #: Of each step the cell of its node and side.
        self.nodes = (steps * 2 + sides).astype(np.int32)
        nears = np.array(nears, np.uint64)
        mixed = (nears >> np.uint64(TOGETHER)) * np.uint64(0xD6E8FEB86659FD93)
        mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(ODD) >> np.uint64(64 - self.power)
        #: Of each step, what its cells differ by from the first one of its context: steps close together stay close.
        self.offsets = ((mixed ^ (nears & np.uint64((1 << TOGETHER) - 1))).astype(np.int64) * 2 + sides).astype(np.int32)
        weight = np.repeat(np.array([*times, escapes], np.int64), np.diff(self.start))
        cells = np.zeros(2 * max(1, self.escape), np.int64)
        np.add.at(cells, self.nodes, weight)
        #: Counts of the bits without a context: the words alone settle them.
        self.alone = cells.reshape(-1, 2)

    @property
    def sizes(self) -> list[int]:
        """Cells (two a slot) of the three predictors' tables."""
        return [2 * max(1, self.escape), 2 << self.power, 2 << self.power]

    def read(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and hashes of a text's words."""
        numbers = np.array([self.number.get(word, self.escape) for word in words], np.int32)
        hashes = self.hashes[numbers]
        for at in np.flatnonzero(numbers == self.escape):
            hashes[at] = zlib.crc32(words[at])
        return numbers, hashes

    def read_texts(self, texts: pa.Array) -> Read:
        """The same of whole texts, their ends included."""
        words, text = split(texts)
        wide = pa.large_binary() if pa.types.is_large_string(words.type) else pa.binary()
        found = pc.index_in(words, value_set=self.words.cast(wide).view(words.type))
        found = pc.fill_null(found, self.escape).to_numpy(zero_copy_only=False)
        each = np.bincount(text, minlength=len(texts))
        start = np.concatenate([[0], np.cumsum(each + 1)])
        sizes = np.bincount(text, pc.binary_length(words).to_numpy(zero_copy_only=False), len(texts))
        numbers = np.full(start[-1], self.number.get(TEXT_END, self.escape), np.int32)
        at = np.arange(len(found)) + text  # an end stands behind each text before
        numbers[at] = found
        rare = found == self.escape
        coded = words.filter(pa.array(rare)).dictionary_encode()
        far, far_word = coded.dictionary, coded.indices.to_numpy()
        hashes = self.hashes[numbers]
        ends = start[1:] - 1
        hashes[ends] = zlib.crc32(TEXT_END)
        own = np.fromiter(map(zlib.crc32, far.view(wide).to_numpy(zero_copy_only=False)), np.uint32, len(far))
        hashes[at[rare]] = own[far_word]
        far_text = text[rare]
        if TEXT_END not in self.number:
            far = pa.concat_arrays([far, pa.array([TEXT_END.decode()], far.type)])
            far_word = np.concatenate([far_word, np.full(len(texts), len(far) - 1, far_word.dtype)])
            far_text = np.concatenate([far_text, np.arange(len(texts))])
        return Read(numbers, hashes, start, (sizes + each + 2).astype(np.int64), far, far_text, far_word)

    def written(self, read: Read) -> tuple[bytes, bytes]:
        """Numbers, and hashes of the words behind an escape; what unwritten makes numbers and hashes of again."""
        return _zstd().compress(read.numbers.tobytes(), asbytes=True), read.hashes[read.numbers == self.escape].tobytes()

    def unwritten(self, numbers: bytes, hashes: bytes, size: int) -> tuple[np.ndarray, np.ndarray]:
        found = np.frombuffer(_zstd().decompress(numbers, 4 * size), np.int32)
        known = self.hashes[found]
        known[found == self.escape] = np.frombuffer(hashes, np.uint32)
        return found, known


def _zstd() -> pa.Codec:
    return pa.Codec("zstd", 1)


class Steps:
    """The code bits of some words, each with its cells in every predictor."""

    def __init__(self, code: Code, text: np.ndarray, numbers: np.ndarray, one: np.ndarray, two: np.ndarray):
        begin = code.start.take(numbers)
        sizes = code.start.take(numbers + 1) - begin
        first = np.cumsum(sizes) - sizes
        self.code = code
        #: Of each bit its number among the steps of the code.
        self.step = np.repeat(begin - first, sizes)
        self.step += np.arange(len(self.step))
        #: Numbers of the texts, and the first step of each.
        changed = np.flatnonzero(np.diff(text, prepend=-1)) if len(self.step) else np.zeros(0, np.int64)
        self.texts, self.first = text[changed], first[changed]
        one = (one.astype(np.uint64) + np.uint64(1)) * np.uint64(ODD)
        two = (two.astype(np.uint64) + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F) ^ (one >> np.uint64(17)) ^ one
        offset = code.offsets.take(self.step)
        #: Two cells a slot, the second one for bits that are one.
        self.near = []
        for context in (one, two):
            key = (context ^ (context >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
            key = (key ^ (key >> np.uint64(31))) * np.uint64(ODD)
            slot = (key >> np.uint64(64 - code.power)).astype(np.int32)
            self.near.append(np.repeat(slot * np.int32(2), sizes) ^ offset)
        self.bits = offset & np.int32(1)

    @property
    def cells(self) -> list[np.ndarray]:
        """Of all predictors; that of the words alone has the cells of the code's steps."""
        return [self.code.nodes.take(self.step), *self.near]


def blocks(code: Code, texts: Iterable[tuple[np.ndarray, np.ndarray]]) -> Iterator[Steps]:
    """Steps of read texts, BLOCK_TOKENS words at a time; the contexts of a text go on over its cuts."""
    held, size = [], 0

    def steps() -> Steps:
        return Steps(code, *(np.concatenate(part) for part in zip(*held)))

    for text, (numbers, hashes) in enumerate(texts):
        before = np.concatenate([np.zeros(2, np.uint32), hashes])
        at = 0
        while at < len(numbers):
            end = min(len(numbers), at + BLOCK_TOKENS - size)
            held.append((np.full(end - at, text), numbers[at:end], before[at + 1 : end + 1], before[at:end]))
            size, at = size + end - at, end
            if size >= BLOCK_TOKENS:
                yield steps()
                held, size = [], 0
    if held:
        yield steps()


def add(tables: list[np.ndarray], steps: Steps, first: int = 0) -> None:
    """Count the bits in their cells, from this predictor on."""
    for table, cells in zip(tables, steps.near if first else steps.cells):
        # ones of the table's own type: numpy takes a slow way round for others
        np.add.at(table, cells.astype(np.int64), np.ones(len(cells), table.dtype))


def first_weights() -> np.ndarray:
    return np.tile(np.float32([0.3, 0.4, 0.4, 0.0]), (GATES, 1))


def short(counts: np.ndarray) -> np.ndarray:
    """(slots, 2) counts as one number a slot, 16 bits each; those of a slot are scaled down together."""
    least = np.maximum(1, counts.max(axis=1, keepdims=True) / 65_535)
    both = np.rint(counts / least).astype(np.uint32)
    return both[:, 0] | both[:, 1] << np.uint32(16)


def stretched(both: np.ndarray, own: int) -> np.ndarray:
    """What a slot says of a bit in 14 bits, then its level; own: two a slot, each without one of that bit."""
    found = np.empty((len(both), 2 if own else 1), np.uint16)
    for at in range(0, len(both), 1 << 16):  # some at a time, as workers have little room
        part = both[at : at + (1 << 16)]
        zero, one = (part & np.uint32(0xFFFF)).astype(np.float32), (part >> np.uint32(16)).astype(np.float32)
        for bit in range(found.shape[1]):
            z, o = (np.maximum(zero - own * (1 - bit), 0), np.maximum(one - own * bit, 0)) if own else (zero, one)
            says = np.rint((np.log((o + np.float32(PRIOR)) / (z + np.float32(PRIOR))) + WIDEST) * np.float32(0.25) / GRAIN)
            level = LEVELS.take(np.minimum(z + o, np.float32(LEVELS.size - 1)).astype(np.int64))
            found[at : at + (1 << 16), bit] = says.astype(np.uint16) << np.uint16(2) | level
    return found.ravel()


_ready: tuple[weakref.ref, int, list] | None = None


def _forget(gone: weakref.ref) -> None:
    global _ready
    if _ready is not None and _ready[0] is gone:
        _ready = None


def ready(counts: list[np.ndarray], own: int, code: Code) -> list[np.ndarray]:
    """stretched of all predictors, of the first one by the code's steps; this worker holds those last asked for.

    They go with the counts, as workers that are used again have no room for them beside other tables.
    """
    global _ready
    if _ready is None or _ready[0]() is not counts[-1] or _ready[1] != own:
        _ready = None
        alone, *tables = [stretched(both, own) for both in counts]
        _ready = weakref.ref(counts[-1], _forget), own, [alone.take(code.nodes if own else code.nodes >> 1), *tables]
    return _ready[2]


def inputs(tables: list[np.ndarray], steps: Steps, own: int) -> tuple[list[np.ndarray], np.ndarray]:
    """(stretched predictions in grains, gates) of the bits; own: tables without the bit itself."""
    # the level stays in the last two bits, far below what counts
    x = [tables[0].take(steps.step)]
    x += [table.take(cells if own else cells >> np.int32(1)) for table, cells in zip(tables[1:], steps.near)]
    return x, (x[1] & np.uint16(3)) * np.uint16(4) + (x[2] & np.uint16(3))


def mixed(weights: np.ndarray, x: list[np.ndarray], gates: np.ndarray) -> np.ndarray:
    """The stretched probability that a bit is one."""
    *columns, found = np.ascontiguousarray(weights.T)
    gates = gates.astype(np.int64)
    # grains are counted from -WIDEST: what that takes off and their size are worked into the weights, not the bits
    found = (found - WIDEST * sum(columns)).take(gates)
    for column, given in zip(columns, x):
        part = (column * GRAIN).take(gates)
        part *= given
        found += part
    return np.clip(found, -MOST, MOST, out=found)


def train(
    counts: list[np.ndarray], code: Code, texts: Iterable[tuple[np.ndarray, np.ndarray]]
) -> tuple[np.ndarray, int]:
    """(weights after one pass over the texts, bits); each bit is met as if it were new."""
    weights, speed, size = first_weights(), np.full((GATES, INPUTS), 1e-4), 0
    tables = ready(counts, 1, code)
    for steps in blocks(code, texts):
        x, gates = inputs(tables, steps, 1)
        # bits of a gate stand together, so that a gate's sums are products of matrices
        order = gates.astype(np.uint8).argsort(kind="stable")
        total = np.bincount(gates, minlength=GATES)
        rows = np.ones((INPUTS, len(order)), np.float32)
        for row, given in zip(rows, x):
            np.multiply(given.take(order), GRAIN, out=row)
            row -= WIDEST
        ends = np.cumsum(total)
        spans = [(gate, slice(end - many, end)) for gate, (end, many) in enumerate(zip(ends.tolist(), total.tolist())) if many]
        error = np.empty(len(order), np.float32)
        for gate, span in spans:
            np.matmul(weights[gate], rows[:, span], out=error[span])
        np.clip(error, -MOST, MOST, out=error)
        np.exp(np.negative(error, out=error), out=error)
        error += 1
        np.subtract(steps.bits.take(order).astype(np.float32), np.reciprocal(error, out=error), out=error)
        slope = np.zeros((GATES, INPUTS))
        for gate, span in spans:
            slope[gate] = rows[:, span] @ error[span]
        slope /= total[:, None] + 1e-9
        speed += slope**2
        weights = weights + (SPEED * slope / np.sqrt(speed)).astype(np.float32)
        size += len(steps.bits)
    return weights, size


def score(
    counts: list[np.ndarray], weights: np.ndarray, code: Code, texts: list[tuple[np.ndarray, np.ndarray]]
) -> np.ndarray:
    """log10 probability of each text's words, up to how those behind an escape are spelled."""
    out = np.zeros(len(texts))
    tables = ready(counts, 0, code)
    for steps in blocks(code, texts):
        if len(steps.bits):
            x, gates = inputs(tables, steps, 0)
            cost = mixed(weights, x, gates)
            cost.view(np.int32)[:] ^= steps.bits << np.int32(31)  # the other sign where the bit is one
            np.exp(cost, out=cost)
            cost += 1
            np.log(cost, out=cost)
            out[steps.texts] -= np.add.reduceat(cost, steps.first, dtype=np.float64) / np.log(10)
    return out
