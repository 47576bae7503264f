"""How far the sources of a language are from each other, by exact term counts.

Terms are counted twice.  The first pass finds the documents of each term and
keeps the frequent ones; the kept terms become sharded minimal perfect hashes.
The second pass holds these hashes as broadcasts of bounded size and increments
dense slots per group; everything after that is arithmetic on whole numbers.
"""

from __future__ import annotations

import pickle
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statement_lake.llm.perfect_hash import PerfectHash, hashes
from statement_lake.session import settle

#: Documents of a language that a term must be in; terms that are listed for a group.
LEAST_DOCUMENTS, TOP_TERMS = 10, 10
#: Kept terms in a perfect hash, about.
SHARD_TERMS = 20_000
#: Bytes of perfect hashes that are broadcast at a time; more of them take more passes.
BROADCAST_BYTES = 64 << 20
#: Distinct terms that a task counts before it hands them on, and dense slots it holds.
HELD_TERMS, HELD_SLOTS = 1 << 19, 1 << 23
#: Cells of a block of (sources x terms) that is compared at once.
CELLS = 1 << 17
#: Numbers are this many parts of the whole.
PARTS = 1_000_000_000
#: Runs of ASCII letters and of all that is not ASCII, in UTF-8.
TERM = re.compile(rb"[A-Za-z\x80-\xff]+")


def terms(text: bytes) -> list[bytes]:
    """The terms of a text; bytes.lower() changes A-Z alone."""
    return TERM.findall(text.lower())


def _read(documents: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    def named(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(""))

    return documents.select(
        named(lang).alias("lang"),
        named(source).alias("source"),
        named(text).cast("binary").alias("text"),
    )


def document_counts(rows: DataFrame) -> DataFrame:
    """(lang, term, documents): in how many documents of a language each term is."""

    def told(found: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        for lang, own in found.items():
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": pa.array([lang] * len(own), pa.string()),
                    "term": pa.array(list(own), pa.binary()),
                    "documents": pa.array(list(own.values()), pa.int64()),
                }
            )

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, Counter] = {}
        held = 0
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                own = found.setdefault(lang, Counter())
                held -= len(own)
                own.update(set(terms(text.as_py())))
                held += len(own)
                if held >= HELD_TERMS:
                    yield from told(found)
                    found, held = {}, 0
        yield from told(found)

    parts = rows.select("lang", "text").mapInArrow(counted, "lang string, term binary, documents long")
    return parts.groupBy("lang", "term").agg(F.sum("documents").alias("documents"))


def perfect_hashes(kept: DataFrame, shard_terms: int) -> DataFrame:
    """(lang, shard, shards, terms in order of their slots, payload): one row a shard.

    Terms are dealt by hash within their language, so that no shard grows with
    the vocabulary.
    """
    sizes = kept.groupBy("lang").agg(F.ceil(F.count("*") / shard_terms).cast("int").alias("shards"))
    dealt = kept.join(settle(sizes, "divergence-shards"), "lang")
    dealt = dealt.withColumn("shard", F.pmod(F.xxhash64("term"), F.col("shards")).cast("int"))

    def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []

        def made() -> pa.RecordBatch:
            table = PerfectHash(held)
            return pa.RecordBatch.from_pydict(
                {
                    "lang": pa.array([at[0]], pa.string()),
                    "shard": pa.array([at[1]], pa.int32()),
                    "shards": pa.array([at[2]], pa.int32()),
                    "terms": pa.array([table.keys], pa.list_(pa.binary())),
                    "payload": pa.array([pickle.dumps(table, protocol=5)], pa.binary()),
                }
            )

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("lang", "shard", "shards", "term")]
            for lang, shard, shards, term in zip(*columns):
                if at is not None and at[:2] != (lang, shard):
                    yield made()
                    held = []
                at = (lang, shard, shards)
                held.append(term)
        if held:
            yield made()

    return (
        dealt.select("lang", "shard", "shards", "term")
        .repartition("lang", "shard")
        .sortWithinPartitions("lang", "shard")
        .mapInArrow(built, "lang string, shard int, shards int, terms array<binary>, payload binary")
    )


def _rounds(tables: DataFrame, most: int) -> Iterator[list]:
    """Rows (lang, shard, shards, payload) by language, in lists of bounded size."""
    held, size = [], 0
    for row in tables.select("lang", "shard", "shards", "payload").orderBy("lang", "shard").toLocalIterator():
        if held and size + len(row.payload) > most:
            yield held
            held, size = [], 0
        held.append(row)
        size += len(row.payload)
    if held:
        yield held


def _recount(rows: DataFrame, shards: list) -> DataFrame:
    """(lang, source, shard, slot, n) for the terms of these shards, summed over all tasks."""
    languages = sorted({row.lang for row in shards})
    shipped = rows.sparkSession.sparkContext.broadcast(
        {
            lang: (
                next(r.shards for r in shards if r.lang == lang),
                {r.shard: bytes(r.payload) for r in shards if r.lang == lang},
            )
            for lang in languages
        }
    )

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: dict[str, dict[int, PerfectHash]] = {}
        found: dict[tuple[str, str], Counter] = {}
        slots: dict[tuple[str, str, int], np.ndarray] = {}
        held = 0

        def increment() -> None:
            for lang in {lang for lang, _ in found}:
                own = {source: counter for (of, source), counter in found.items() if of == lang}
                many, payloads = shipped.value[lang]
                if lang not in opened:
                    opened[lang] = {s: pickle.loads(payload) for s, payload in payloads.items()}
                # each term of the language is looked up once, whatever the sources that have it
                keys = list(set().union(*own.values()))
                h = hashes(keys)
                shard_of = h % many
                shard_at, slot_at = np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int64)
                for shard, table in opened[lang].items():
                    here = np.flatnonzero(shard_of == shard)
                    slot = table.slots([keys[i] for i in here.tolist()], h[here])
                    shard_at[here], slot_at[here] = np.where(slot >= 0, shard, -1), slot
                number = {key: i for i, key in enumerate(keys)}
                for source, counter in own.items():
                    at = np.fromiter(map(number.__getitem__, counter), np.int64, len(counter))
                    n = np.fromiter(counter.values(), np.int64, len(counter))
                    for shard, table in opened[lang].items():
                        known = np.flatnonzero(shard_at[at] == shard)
                        if len(known):
                            key = (lang, source, shard)
                            if key not in slots:
                                slots[key] = np.zeros(len(table), np.int64)
                            slots[key][slot_at[at[known]]] += n[known]
            found.clear()

        def told() -> Iterator[pa.RecordBatch]:
            for (lang, source, shard), dense in slots.items():
                used = np.flatnonzero(dense)
                yield pa.RecordBatch.from_pydict(
                    {
                        "lang": pa.array([lang], pa.string()),
                        "source": pa.array([source], pa.string()),
                        "shard": pa.array([shard], pa.int32()),
                        "slots": pa.array([used], pa.list_(pa.int32())),
                        "counts": pa.array([dense[used]], pa.list_(pa.int64())),
                    }
                )
            slots.clear()

        for batch in batches:
            groups = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist())
            for group, text in zip(groups, batch.column("text")):
                if group[0] not in shipped.value:
                    continue
                own = found.setdefault(group, Counter())
                held -= len(own)
                own.update(terms(text.as_py()))
                held += len(own)
                if held >= HELD_TERMS:
                    increment()
                    held = 0
                    if sum(map(len, slots.values())) >= HELD_SLOTS:
                        yield from told()
        increment()
        yield from told()

    parts = rows.mapInArrow(
        counted, "lang string, source string, shard int, slots array<int>, counts array<bigint>"
    )
    each = parts.select(
        "lang", "source", "shard", F.explode(F.arrays_zip("slots", "counts")).alias("of")
    ).select("lang", "source", "shard", F.col("of.slots").alias("slot"), F.col("of.counts").alias("n"))
    summed = each.groupBy("lang", "source", "shard", "slot").agg(F.sum("n").alias("n"))
    return settle(summed, "divergence-counts")


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(PARTS * (count + 2) / (total + 2 * kept)), exact for any 64-bit counts."""

    def wide(value: Column) -> Column:
        return value.cast("decimal(20,0)")

    above = wide(count + 2) * F.lit(PARTS).cast("decimal(10,0)")
    below = total + 2 * kept
    short = F.call_function("div", (count + 2) * F.lit(PARTS), below)
    return 1 + F.when(count < 9 * PARTS, short).otherwise(F.call_function("div", above, wide(below)))


def shares(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """The same on arrays; totals include the added counts.  Divides digit by digit, so nothing overflows."""
    whole, rest = np.divmod(counts + 2, totals)
    for _ in range(3):
        more, rest = np.divmod(rest * 1000, totals)
        whole = whole * 1000 + more
    return 1 + whole


def _pairs(counts: DataFrame, groups: DataFrame, tables: DataFrame) -> DataFrame:
    """(lang, source, item, value) for each ordered pair of sources of a language.

    Terms come in blocks that hold CELLS cells of (sources x terms) at most, so a
    block fits in memory whatever the number of sources; blocks' sums are added up.
    Each block is told all sources, as a source without a term has a share of it.
    """
    many = groups.groupBy("lang").agg(F.count("*").alias("sources"))
    width = F.greatest(F.lit(16), F.expr(f"{CELLS} div sources"))
    wide = settle(many.select("lang", width.cast("int").alias("width")), "divergence-width")
    sizes = tables.select("lang", "shard", F.size("terms").alias("size"))
    blocks = (
        sizes.join(wide, "lang")
        .select(
            "lang", "shard", F.explode(F.expr("sequence(0, (size - 1) div width)")).alias("block"),
            "size", "width",
        )
        .select("lang", "shard", "block", F.expr("least(width, size - block * width)").alias("wide"))
    )
    # a block without terms, so that each pair of a language without kept terms has its sum, too
    bare = wide.select("lang", F.lit(-1).alias("shard"), F.lit(0).alias("block"), F.lit(0).alias("wide"))
    told = blocks.unionByName(bare).join(groups, "lang").select(
        "lang", "shard", "block", F.lit(None).cast("int").alias("slot"), "source",
        (F.col("total") + 2 * F.col("kept")).alias("n"), "wide",
    )
    cells = counts.join(wide, "lang").select(
        "lang", "shard", F.expr("slot div width").cast("int").alias("block"),
        F.expr("slot % width").cast("int").alias("slot"), "source", "n", F.lit(None).cast("int").alias("wide"),
    )

    def compared(table: pa.Table) -> pa.Table:
        slot = table.column("slot").to_numpy()
        slot = np.where(np.isnan(slot), -1, slot).astype(np.int64) if slot.dtype.kind == "f" else slot
        n, sources = table.column("n").to_numpy(), table.column("source").to_pylist()
        heads = np.flatnonzero(slot < 0)
        names = [sources[i] for i in heads.tolist()]
        number = {name: i for i, name in enumerate(names)}
        filled = np.zeros((len(names), int(table.column("wide")[int(heads[0])].as_py())), np.int64)
        body = np.flatnonzero(slot >= 0)
        filled[[number[sources[i]] for i in body.tolist()], slot[body]] = n[body]
        p = shares(filled, n[heads][:, None])
        sums = np.zeros((len(names), len(names)), np.int64)
        for i in range(len(names)):
            apart = p[i + 1 :] - p[i]
            sums[i, i + 1 :] = (apart * apart // (p[i + 1 :] + p[i])).sum(axis=1)
        sums += sums.T
        a, b = np.nonzero(~np.eye(len(names), dtype=bool))
        lang = table.column("lang")[0].as_py()
        return pa.table(
            {
                "lang": pa.array([lang] * len(a), pa.string()),
                "source": pa.array([names[i] for i in a.tolist()], pa.string()),
                "item": pa.array([names[i] for i in b.tolist()], pa.string()),
                "value": pa.array(sums[a, b], pa.int64()),
            }
        )

    each = (
        cells.unionByName(told)
        .groupBy("lang", "shard", "block")
        .applyInArrow(compared, "lang string, source string, item string, value long")
    )
    return each.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def _terms(counts: DataFrame, groups: DataFrame, tables: DataFrame) -> DataFrame:
    """(lang, source, item, value): terms that a group uses more than its language does."""
    listed = tables.select("lang", "shard", F.posexplode("terms").alias("slot", "term"))
    whole = counts.groupBy("lang", "shard", "slot").agg(F.sum("n").alias("all_n"))
    named = listed.join(whole, ["lang", "shard", "slot"])
    totals = groups.groupBy("lang").agg(F.sum("total").alias("all_total"))
    p = share(F.col("n"), F.col("total"), F.col("kept"))
    q = share(F.col("all_n"), F.col("all_total"), F.col("kept"))
    return (
        counts.join(groups, ["lang", "source"])
        .join(settle(totals, "divergence-totals"), "lang")
        .join(named, ["lang", "shard", "slot"])
        .select("lang", "source", F.col("term").cast("string").alias("item"), p.alias("p"), q.alias("q"))
        .where("p > q")
        .select("lang", "source", "item", F.expr("(p - q) * (p - q) div (p + q)").alias("value"))
    )


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return rows.select(
        "lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank")
    )


def _union(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def audit(
    documents: DataFrame,
    least_documents: int = LEAST_DOCUMENTS,
    top_terms: int = TOP_TERMS,
    shard_terms: int = SHARD_TERMS,
    broadcast_bytes: int = BROADCAST_BYTES,
    text_column: str = "text",
    lang_column: str = "lang",
    source_column: str = "source",
) -> DataFrame:
    """(lang, source, part, item, value, rank): distances of sources and their own terms.

    Part `pair`: each other source of the language with the distance of the two
    shares summed over the language's kept terms.  Part `term`: the terms a
    source uses more than its language as a whole, the `top_terms` furthest.
    Kept are the terms in `least_documents` documents of a language or more.

    Null lang, source and text count as empty; a document without terms still
    makes its group occur.  Repeated rows count each time.  Ties go to the
    smaller item.  A language with one source has no pairs; without kept terms
    all its distances are 0.  No rows: no rows.  Other columns are ignored.
    """
    spark = documents.sparkSession
    rows = _read(documents, text_column, lang_column, source_column)
    frequent = document_counts(rows).where(F.col("documents") >= least_documents)
    kept = settle(frequent.select("lang", "term"), "divergence-kept")
    tables = settle(perfect_hashes(kept, shard_terms), "divergence-hashes")
    none = spark.createDataFrame([], "lang string, source string, shard int, slot int, n long")
    counts = _union([none, *(_recount(rows, some) for some in _rounds(tables, broadcast_bytes))])
    sums = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    vocabulary = tables.groupBy("lang").agg(F.sum(F.size("terms")).alias("kept"))
    zero = F.lit(0).cast("bigint")
    occurring = rows.select("lang", "source").distinct()
    groups = settle(
        occurring.join(sums, ["lang", "source"], "left")
        .join(vocabulary, "lang", "left")
        .select(
            "lang", "source", F.coalesce("total", zero).alias("total"), F.coalesce("kept", zero).alias("kept")
        ),
        "divergence-groups",
    )
    pairs = _ranked(_pairs(counts, groups, tables), "pair")
    own = _ranked(_terms(counts, groups, tables), "term").where(F.col("rank") <= top_terms)
    return pairs.unionByName(own)
