"""SimHash near duplicates, found by meet-in-the-middle ball hashing."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statement_lake.session import settle

#: Bits of a fingerprint; fingerprints link at RADIUS differing bits or fewer.
BITS, RADIUS = 64, 3
#: Words in a shingle and the seed of its hash.
WORDS, SEED = 3, 42
#: Shingles that are held as bits at a time.
PIECE = 1 << 16
#: Where the blocks begin that are left out in turn to reach pairs at an odd radius.
EDGES = (0, 21, 42, 64)


def fingerprint(text: bytes, words: int = WORDS, seed: int = SEED) -> int:
    """SimHash of a text's word shingles; a bit is 1 if it is so in over half of the hashes.

    bytes.lower() changes A-Z alone and bytes.split() splits at the six ASCII
    blanks alone, as asked.
    """
    parts = text.lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(sizes + 1) - 1
    begins = ends - sizes
    n = max(1, len(parts) - words + 1)
    digest, first, last = xxhash.xxh64_digest, begins[:n], ends[min(words, len(parts)) - 1 :][:n]
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, PIECE):
        spans = zip(first[at : at + PIECE].tolist(), last[at : at + PIECE].tolist())
        hashes = b"".join([digest(joined[b:e], seed) for b, e in spans])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, BITS // 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(
    documents: DataFrame, id_column: str, text_column: str, digests: bool = False
) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long.  digests: with the text's SHA-256, too."""
    more = ["digest"] if digests else []

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            found = [fingerprint(t.as_py() or b"") for t in texts]
            fp = np.array(found, np.uint64).view(np.int64)
            columns = [batch.column("doc_id"), pa.array(fp), *[batch.column(c) for c in more]]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "fp", *more])

    rows = documents.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_column), F.lit("")).cast("binary").alias("text"),
        *[_digest(F.col(text_column)).alias(c) for c in more],
    )
    return rows.mapInArrow(of, "doc_id long, fp long" + ", digest string" * digests)


def _digest(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def _signed(bits: int) -> int:
    bits &= (1 << BITS) - 1
    return bits - (1 << BITS) if bits >> (BITS - 1) else bits


def _ball(value: Column, bits: Iterable[int]) -> Column:
    """The value and all values that differ from it in one of the bits."""
    masks = F.array(*[F.lit(_signed(m)).cast("long") for m in [0, *(1 << b for b in bits)]])
    return F.transform(masks, lambda mask: value.bitwiseXOR(mask))


def _within_two(prints: DataFrame) -> DataFrame:
    """Links (a, b) that join all fingerprints that differ in two bits at most.

    Two of them share a point within one bit of both.  At most 65 fingerprints
    lie around a point, so the smallest of them can stand for it; no pairs.
    """
    around = prints.select("fp", F.explode(_ball(F.col("fp"), range(BITS))).alias("point"))
    least = F.min("fp").over(Window.partitionBy("point"))
    return around.select(F.col("fp").alias("a"), least.alias("b")).where("a <> b").distinct()


def _at_three(prints: DataFrame) -> DataFrame:
    """Verified links (a, b) at three bits between fingerprints (fp, root) of different roots.

    Three differing bits leave two at most once a block that has one of them is
    left out; so some block is left out of both and the rest of both lies within
    one bit of a common point.  Points that meet fingerprints of one root only
    are dropped before anything is joined; the others' members are compared only
    across roots.
    """
    balls = []
    for number, (low, high) in enumerate(zip(EDGES, EDGES[1:]), 1):
        out = ((1 << (high - low)) - 1) << low
        rest = F.col("fp").bitwiseAND(F.lit(_signed(~out)))
        # the block's number takes its place; other blocks' points seldom fall on it
        marked = rest.bitwiseOR(F.lit(_signed(number << low)))
        balls.append(_ball(marked, [b for b in range(BITS) if not low <= b < high]))
    points = prints.select("fp", "root", F.explode(F.concat(*balls)).alias("point"))
    here = Window.partitionBy("point")
    mixed = (
        points.withColumn("least", F.min("root").over(here))
        .withColumn("most", F.max("root").over(here))
        .where("least <> most")
        .select("point", "fp", "root")
    )
    met = settle(mixed, "simhash-met")
    a, b = met.alias("a"), met.alias("b")
    differing = F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp")))
    return (
        a.join(b, F.col("a.point") == F.col("b.point"))
        .where((F.col("a.root") > F.col("b.root")) & (differing <= RADIUS))
        .select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))
        .distinct()
    )


def components(links: DataFrame, label: str = "simhash") -> DataFrame:
    """(node, root): the smallest node that each node of the links (a, b) reaches.

    Alternates large-star and small-star steps until the links are stars; each
    step is an aggregate and a join, and every round is a written table.  A hub
    joins many nodes; its links are one row each and its minimum is combined
    before the shuffle.
    """
    links = settle(links.where("a <> b"), f"{label}-links")
    before = None
    while True:
        both = links.select("a", "b").union(links.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        # large star: greater neighbours join the least one
        large = (
            both.join(least, "a")
            .where("b > a")
            .select(F.col("b").alias("a"), F.col("least").alias("b"))
            .where("a <> b")
            .distinct()
        )
        large = settle(large, f"{label}-large")
        # small star: smaller neighbours and the node itself join the least one
        lower = large.groupBy("a").agg(F.min("b").alias("least"))
        small = (
            large.join(lower, "a")
            .select(F.explode(F.array("a", "b")).alias("a"), F.col("least").alias("b"))
            .where("a <> b")
            .distinct()
        )
        links = settle(small, f"{label}-small")
        now = links.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if now == before:
            break
        before = now
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _groups(found: DataFrame) -> DataFrame:
    """(fp, root, component_id) for fingerprints (doc_id, fp): root tells components apart.

    Components may have one component_id where a doc_id repeats with different texts.
    """
    prints = settle(found.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    close = settle(components(_within_two(prints), "simhash-two"), "simhash-close")

    def rooted(roots: DataFrame, column: str) -> DataFrame:
        root = roots.withColumnRenamed("node", column)
        return prints.join(root, prints["fp"] == root[column], "left").select(
            "fp", "least", F.coalesce("root", "fp").alias("root")
        )

    first = settle(rooted(close, "of"), "simhash-first")
    further = settle(_at_three(first), "simhash-three")
    links = further.union(close.select(F.col("node").alias("a"), F.col("root").alias("b")))
    last = settle(rooted(components(links, "simhash-all"), "of"), "simhash-last")
    ids = last.groupBy("root").agg(F.min("least").alias("component_id"))
    return settle(last.join(ids, "root").select("fp", "root", "component_id"), "simhash-components")


def near_duplicates(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row a document row.

    fingerprint: 16 lowercase hex digits of the SimHash over three-word shingles.
    component_id: the smallest doc_id reachable over fingerprints that differ in
    three bits at most, the document's own included.

    Null text counts as empty; texts without words have fingerprint 0 and link
    like any other.  Copies share a fingerprint and are handled once.  A null
    doc_id has its row too, but is never a component_id unless no member has an
    id.  Rows with one doc_id each have their row.  No rows: no rows.  Other
    columns are ignored.
    """
    found = settle(fingerprints(documents, id_column, text_column), "simhash-prints")
    return found.join(_groups(found), "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def one_of_each(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row of each component of near duplicates.

    Every column stays as it is.  The row with the component's least doc_id stays;
    of several such rows the smallest, in order of their columns.  A doc_id that
    repeats with different texts may so stay once in each of their components.
    Rows with a null doc_id cannot be copies of rows that have one, but are of
    each other: one of them stays in each component, the smallest.
    """
    prints = fingerprints(documents, id_column, text_column, digests=True)
    found = settle(prints, "simhash-prints")
    rooted = found.join(_groups(found).select("fp", "root"), "fp")
    texts = settle(
        rooted.groupBy("root", "doc_id", "digest").agg(F.count("*").alias("rows")), "simhash-texts"
    )
    # the least doc_id of each component, and null where it has rows without one
    least = (
        texts.groupBy("root", "doc_id")
        .agg(F.sum("rows").alias("times"))
        .groupBy(F.col("root").alias("in_root"), F.col("doc_id").isNull())
        .agg(F.min(F.struct("doc_id", "times")).alias("first"))
        .select("in_root", F.col("first.doc_id").alias("kept"), F.col("first.times").alias("times"))
    )
    here = (F.col("root") == F.col("in_root")) & F.col("doc_id").eqNullSafe(F.col("kept"))
    kept = settle(
        texts.join(least, here).select("in_root", "kept", F.col("digest").alias("kept_digest"), "times"),
        "simhash-kept",
    )
    rows = documents.select(F.struct("*").alias("row"))
    key = F.col(f"row.`{id_column}`").cast("long")
    named = rows.join(
        kept, key.eqNullSafe(F.col("kept")) & (_digest(F.col(f"row.`{text_column}`")) == F.col("kept_digest"))
    )
    once = named.where("times = 1").select("row.*")
    if kept.where("times > 1").isEmpty():
        return once
    many = named.where("times > 1").groupBy("in_root", "kept").agg(F.min("row").alias("row"))
    return once.unionByName(many.select("row.*"))
