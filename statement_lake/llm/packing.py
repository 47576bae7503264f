"""Best-fit-decreasing packing of documents into token sequences."""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Iterable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statement_lake.session import settle

TOKENIZER, SEQUENCE, END_ID = "word_bpe_49k.json", 4096, 1
#: Bytes of words, and of parts of words, that a Python worker remembers.
REMEMBERED = 128 << 20
#: What an entry takes beside its two strings, about.
ENTRY = 170
#: Pieces that share a numbering bucket, about; buckets are what ranks are counted in.
BUCKET_ROWS = 50_000
#: Longest stretch of text without an ASCII blank that is remembered.
WORD_BYTES = 64

#: Words of plain Latin characters: lower case and composition are letter by letter there.
PLAIN, UNPLAIN = re.compile("[\x21-\x7e\xa1-\xff]+"), re.compile("[^\n\x21-\x7e\xa1-\xff]")
#: The rules of a tokenizer file under which words can be encoded one by one (fixed values).
WORD_RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
LINE_PART = regex.compile(r"\n|" + WORD_RULE)
#: Between the ids of words: no four bytes of ids are all ones, as ids are below 2^24.
END_OF_WORD = b"\xff\xff\xff\xff"
BLANK = re.compile(rb"[\x20\t-\r]")
#: Bytes of text that a stretch has, and of what a worker remembers the share whose words are looked up together:
#: Arrow's columns of those words take some ten times the text.
STRETCH, TOGETHER = 1 << 17, 1 / 32


class Remembered:
    """The entries used last, within a number of bytes (plus what one stretch of text needs).

    Entries live in two halves; when the younger one is full it becomes the older
    one, and what is asked for in the older one moves back.
    """

    def __init__(self, most: int):
        self.half, self.size = most // 2, 0
        self.young: dict = {}
        self.old: dict = {}

    def absent(self, keys: set) -> list:
        """The keys that have no entry; all others are among the young ones afterwards."""
        keys = keys.difference(self.young)
        back = {key: self.old[key] for key in keys if key in self.old}
        self.put(back)
        return list(keys.difference(back))

    def put(self, entries: dict) -> None:
        self.young |= entries
        self.size += ENTRY * len(entries) + sum(map(len, entries)) + sum(map(len, entries.values()))

    def age(self) -> None:
        if self.size > self.half:
            self.old, self.young, self.size = self.young, {}, 0

    def shrink(self) -> None:
        """Keep the younger half; the worker may serve other stages next."""
        self.old = {}


class Encoder:
    """Token ids of texts by one tokenizer file, as the file alone gives them."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer

        self.path, self.remembered = path, remembered
        self.together = max(STRETCH, int(remembered * TOGETHER))
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        self.added = [t["content"] for t in rules.get("added_tokens") or []]
        self.word_by_word = self._parts_words(rules)
        self.words, self.parts = Remembered(remembered // 2), Remembered(remembered // 2)
        self.shown: dict[int, str] = {}
        if self.word_by_word:
            # how the tokenizer writes the bytes of each plain character
            cut = self.tokenizer.pre_tokenizer.pre_tokenize_str
            self.shown = {c: "".join(part for part, _ in cut(chr(c))) for c in range(0x21, 0x100)}

    @staticmethod
    def _parts_words(rules: dict) -> bool:
        """White space is part of no token and nothing is joined over it."""
        try:
            steps = rules["pre_tokenizer"]["pretokenizers"]
            plain = (
                [n["type"] for n in rules["normalizer"]["normalizers"]] == WORD_NORMALIZERS
                and [s["type"] for s in steps] == ["Split", "ByteLevel"]
                and steps[0]["pattern"]["Regex"] == WORD_RULE
                and (steps[0]["behavior"], steps[0]["invert"]) == ("Removed", True)
                and not steps[1]["add_prefix_space"]
                and rules["model"]["type"] == "BPE"
            )
        except (KeyError, TypeError):
            return False
        alone = ("lstrip", "rstrip", "single_word", "normalized")
        added = rules.get("added_tokens") or []
        return plain and not any(
            any(t[flag] for flag in alone) or any(c.isspace() for c in t["content"]) for t in added
        )

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _merged(self, parts: list[str]) -> list[bytes]:
        """Ids of parts of plain words, straight from the tokenizer's merges."""
        model = self.tokenizer.model
        found = [model.tokenize(p if p.isascii() else p.translate(self.shown)) for p in parts]
        return [array("I", [t.id for t in tokens]).tobytes() for tokens in found]

    def _learn(self, words: list[bytes]) -> list[bytes]:
        """Remember the ids of new words; returns those that should be forgotten again."""
        text = b"\n".join(words).decode()
        shown = text.split("\n")
        if UNPLAIN.search(text):
            simple = [len(w) <= WORD_BYTES and (w.isascii() and w.isprintable() or bool(PLAIN.fullmatch(w))) for w in shown]
        else:
            simple = [len(w) <= WORD_BYTES for w in shown]
        for token in self.added:
            if token in text:
                simple = [plain and token not in w for plain, w in zip(simple, shown)]
        plain = list(compress(words, simple))
        other = [n for n, is_plain in enumerate(simple) if not is_plain]
        if plain:
            # one search over all of them; a line feed ends a word
            cut = LINE_PART.findall("\n".join(compress(shown, simple)).lower())
            new = self.parts.absent(set(cut) - {"\n"})
            self.parts.put(dict(zip(new, self._merged(new))))
            held = self.parts.young
            held["\n"] = END_OF_WORD
            ids = b"".join([held[p] for p in cut]).split(END_OF_WORD)
            self.words.put(dict(zip(plain, ids)))
            self.parts.age()
        self.words.put({words[n]: ids for n, ids in zip(other, self._whole([shown[n] for n in other]))})
        return [words[n] for n in other if len(words[n]) > WORD_BYTES]

    def ids(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text as unsigned little-endian 32-bit numbers.

        Where the file's rules treat each stretch without white space by itself, a
        word's ids never depend on its neighbours, and within plain words the same
        holds for the parts it is cut into: words and parts are encoded once and
        remembered.  A word that holds one of the file's added tokens goes through
        the tokenizer, and so does the whole text under other rules.
        """
        if not self.word_by_word:
            return self._whole([text.decode() for text in texts])
        found: list[list[bytes]] = [[] for _ in texts]
        for some in stretches(texts, self.together):
            # each distinct word is looked up once; Arrow tells the words apart and lays their ids side by side
            parts = pa.array([part for _, part in some], pa.large_binary())
            lists = pc.ascii_split_whitespace(parts.view(pa.large_string()))
            coded = lists.flatten().dictionary_encode()
            words = coded.dictionary.view(pa.large_binary()).to_numpy(zero_copy_only=False).tolist()
            new = self.words.absent(set(words) - {b""})  # blanks at either end leave an empty word there
            long = self._learn(new) if new else []
            held = self.words.young
            held[b""] = b""
            ids = pa.array([held[w] for w in words], pa.large_binary()).take(coded.indices)
            bounds = np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1)[lists.offsets.to_numpy()].tolist()
            data = memoryview(ids.buffers()[2] or b"")
            for (number, _), low, high in zip(some, bounds, bounds[1:]):
                found[number].append(data[low:high])
            for word in long:
                del held[word]
            self.words.age()
        return [b"".join(parts) for parts in found]


def stretches(texts: list[bytes], size: int = STRETCH) -> Iterator[list[tuple[int, bytes]]]:
    """Texts in groups of about `size` bytes, (number, part); longer texts are cut at blanks."""
    group: list[tuple[int, bytes]] = []
    held = 0
    for number, text in enumerate(texts):
        at = 0
        while True:
            blank = BLANK.search(text, at + size - held) if len(text) - at > size - held else None
            end = blank.end() if blank else len(text)
            group.append((number, text[at:end]))
            held, at = held + end - at, end
            if held >= size:
                yield group
                group, held = [], 0
            if at >= len(text):
                break
    if group:
        yield group


_encoder: Encoder | None = None


def encoder(path: str, remembered: int = REMEMBERED) -> Encoder:
    """This worker's encoder; it holds the one of the last file and size asked for."""
    global _encoder
    if _encoder is None or (_encoder.path, _encoder.remembered) != (path, remembered):
        _encoder = Encoder(path, remembered)
    return _encoder


def groups(column: pa.Array, size: int) -> Iterator[tuple[int, list[bytes]]]:
    """(number of the first, texts): a batch's texts, some `size` bytes at a time."""
    texts, held, first = [], 0, 0
    for number, text in enumerate(column):
        texts.append(text.as_py())
        held += len(texts[-1])
        if held >= size:
            yield first, texts
            texts, held, first = [], 0, number + 1
    if texts:
        yield first, texts


def pieces(
    documents: DataFrame, tokenizer_path: str, length: int, id_column: str, text_column: str, remembered: int
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): documents with an end id, cut where too long."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        held = encoder(tokenizer_path, remembered)
        encode = held.ids
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            rows: list[tuple] = []
            docs = batch.column("doc_id").to_pylist()
            for first, texts in groups(batch.column("text"), 2 * held.together):
                for doc, found in zip(docs[first : first + len(texts)], encode(texts)):
                    ids = found + end
                    for number, at in enumerate(range(0, len(ids), 4 * length)):
                        part = memoryview(ids)[at : at + 4 * length]
                        rows.append((doc, number, at // 4, len(part) // 4, zlib.crc32(part)))
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            columns = zip(*rows) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)
        held.words.shrink()
        held.parts.shrink()

    rows = documents.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_column), F.lit("")).cast("binary").alias("text"),
    )
    return rows.mapInArrow(
        cut, "doc_id long, piece int, start long, length long, ids_crc32 long"
    )


class Capacities:
    """Segment tree over remaining capacities: finds the tightest that has open bins."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.open = [False] * (2 * self.leaves)
        self.bins: dict[int, list[tuple[int, int]]] = {}

    def put(self, left: int, first: int, count: int) -> None:
        """count bins, numbered from first, now have this capacity left."""
        if left and count:
            self.bins.setdefault(left, []).append((first, count))
            self._mark(left, True)

    def take(self, left: int) -> tuple[int, int]:
        found = self.bins[left].pop()
        if not self.bins[left]:
            self._mark(left, False)
        return found

    def _mark(self, left: int, is_open: bool) -> None:
        node = self.leaves + left
        self.open[node] = is_open
        while node > 1:
            node //= 2
            self.open[node] = self.open[2 * node] or self.open[2 * node + 1]

    def tightest(self, least: int) -> int | None:
        """The smallest open capacity of at least this."""
        node = self.leaves + least
        if not self.open[node]:
            while node > 1 and (node % 2 or not self.open[node + 1]):
                node //= 2
            if node <= 1:
                return None
            node += 1
        while node < self.leaves:
            node = 2 * node if self.open[2 * node] else 2 * node + 1
        return node - self.leaves


def plan(counts: Iterable[tuple[int, int]], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over (length, count): runs of (length, first rank, last rank + 1,
    first sequence, pieces a sequence, offset).

    Bins with equal room are alike, so pieces of one length are placed in runs:
    the tightest bins with room for the length take as many as fit, each in turn,
    which is what placing the pieces one after the other gives.  The work depends
    on the number of lengths and capacities, not on the number of pieces.
    """
    room, runs, fresh = Capacities(capacity), [], 0
    for length, count in sorted(counts, reverse=True):
        rank = 0
        while rank < count:
            left = room.tightest(length)
            if left is None:
                left = capacity
                need = -(-(count - rank) // (capacity // length))
                first, bins, fresh = fresh, need, fresh + need
            else:
                first, bins = room.take(left)
            each = left // length
            placed = min(count - rank, bins * each)
            full, over = divmod(placed, each)
            used = full + bool(over)
            runs.append((length, rank, rank + placed, first, each, capacity - left))
            room.put(left, first + used, bins - used)
            if over:
                room.put(left - over * length, first + full, 1)
            room.put(left - each * length, first, full)
            rank += placed
    return runs


def best_fit(
    documents: DataFrame,
    tokenizer_path: str,
    length: int = SEQUENCE,
    id_column: str = "doc_id",
    text_column: str = "text",
    bucket_rows: int = BUCKET_ROWS,
    remembered: int = REMEMBERED,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), one row a piece.

    The whole corpus is packed at once: the only thing that packing depends on is
    how many pieces have each length, `length` numbers at most, which the driver
    turns into runs.  Pieces of a length are numbered within buckets that spread
    any length, and each piece finds the run that holds its number.

    Null and empty texts are one piece that holds the end id alone.  Rows with
    null or equal doc_ids are packed like others, each by itself.  Where pieces
    tie (equal lengths), order of bucket and row decides.  No rows: no rows.
    Other columns are ignored.  remembered: bytes of words and parts that a Python
    worker holds; fewer take more time and give the same.
    """
    spark = documents.sparkSession
    cut = settle(pieces(documents, tokenizer_path, length, id_column, text_column, remembered), "pack-pieces")
    total = cut.count()
    buckets = -(-total // bucket_rows) or 1
    key = F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id())
    spread = settle(cut.withColumn("bucket", F.pmod(key, F.lit(buckets))), "pack-buckets")
    sizes = spread.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    counts = spread.groupBy("length").count().collect()  # `length` rows at most
    runs = plan([(r["length"], r["count"]) for r in counts], length)
    steps = spark.createDataFrame(
        runs, "of long, low long, high long, sequence long, each long, base long"
    )
    lookup = steps.groupBy("of").agg(
        F.collect_list(F.struct("low", "high", "sequence", "each", "base")).alias("all")
    )
    # the numbers of a length in a bucket are consecutive, so few runs concern them
    first = sizes.select(
        "length", "bucket", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")
    ).join(lookup, F.col("length") == F.col("of"))
    concerned = F.filter(
        "all", lambda r: (r["low"] < F.col("first") + F.col("n")) & (F.col("first") < r["high"])
    )
    first = first.select("length", "bucket", "first", concerned.alias("runs"))
    order = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    placed = spread.withColumn("nth", F.row_number().over(order) - 1).join(first, ["length", "bucket"])
    placed = placed.withColumn("rank", F.col("first") + F.col("nth"))
    run = F.element_at(
        F.filter("runs", lambda r: (r["low"] <= F.col("rank")) & (F.col("rank") < r["high"])), 1
    )
    found = placed.withColumn("run", run)
    inside = F.col("rank") - F.col("run.low")
    return found.select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("run.sequence") + F.floor(inside / F.col("run.each"))).alias("sequence_id"),
        (F.col("run.base") + F.pmod(inside, F.col("run.each")) * F.col("length")).alias("offset"),
    )
