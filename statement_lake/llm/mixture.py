"""Mixing sources to target weights by hierarchical budgets and seeded epochs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statement_lake.session import settle

#: Parts of the tree, from the root down.
LEVELS = ("domain", "lang", "source")
#: Production weights; names that are not listed weigh 1.  Whole numbers, so that budgets are exact.
DOMAINS = ("web", "books", "code", "forum")
WEIGHTS: Mapping[str, Mapping[str, int]] = {
    "domain": {"web": 4, "books": 3, "code": 2, "forum": 1},
    "lang": {"en": 5, "de": 2, "fr": 2, "es": 1},
    "source": {},
}
#: Budget as hundredths of all tokens, the most often a document is taken, and the seed of its order.
SHARE, EPOCHS, SEED = 50, 2, 17
#: Hex digits of a document's place that make up its bucket.
BUCKET_DIGITS = 3
WIDE = "decimal(38,0)"


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]++")).cast("long")


def domain_of(source: Column) -> Column:
    """The domain by the number that a source's name ends in; names without one are web."""
    number = F.regexp_extract(F.coalesce(source, F.lit("")), "([0-9]{1,9})$", 1)
    place = F.when(number != "", number.cast("int") % len(DOMAINS)).otherwise(0)
    return F.element_at(F.array(*map(F.lit, DOMAINS)), place + 1)


def _weight(level: str, weights: Mapping[str, Mapping[str, int]]) -> Column:
    given = weights.get(level, {})
    found = F.lit(1)
    for name, weight in given.items():
        found = F.when(F.col(level) == name, F.lit(weight)).otherwise(found)
    return found.cast(WIDE)


def _shared(nodes: DataFrame, parents: list[str], level: str) -> DataFrame:
    """budget of each node: its parent's, by weight, with no node above its capacity.

    Children in order of capacity by weight: those that cannot use their share
    get their capacity, and what they leave goes to their siblings by weight.
    A parent's budget is never above what its children hold together, so what
    siblings cannot use has been handed on by the ancestors before.
    """
    order = Window.partitionBy(*parents).orderBy(F.col("capacity") / F.col("weight"), level)
    all_before = order.rowsBetween(Window.unboundedPreceding, -1)
    all_after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    together = Window.partitionBy(*parents)
    before = F.coalesce(F.sum("capacity").over(all_before), F.lit(0)).cast(WIDE)
    filled = nodes.withColumn("before", before).withColumn(
        "after", F.sum("weight").over(all_after).cast(WIDE)
    )
    full = F.col("capacity") * F.col("after") <= F.col("weight") * (F.col("parent_budget") - F.col("before"))
    filled = filled.withColumn("full", full)
    used = F.sum(F.when(F.col("full"), F.col("capacity")).otherwise(0)).over(together).cast(WIDE)
    open_weight = F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(together).cast(WIDE)
    filled = filled.withColumn("used", used).withColumn("open", open_weight)
    rest = F.expr("(weight * (parent_budget - used)) div open").cast(WIDE)
    budget = F.when(F.col("full"), F.col("capacity")).otherwise(F.least(F.col("capacity"), rest))
    return filled.select(*parents, level, "capacity", budget.alias("budget"))


def budgets(
    leaves: DataFrame, share: int, epochs: int, weights: Mapping[str, Mapping[str, int]]
) -> DataFrame:
    """(domain, lang, source, tokens, budget) of each leaf (domain, lang, source, tokens).

    The windows run over nodes of the tree; rows have been added up before.
    """
    open_leaves = leaves
    for level in LEVELS:
        open_leaves = open_leaves.where(_weight(level, weights) > 0)
    capacity = (F.sum("tokens") * epochs).cast(WIDE).alias("capacity")
    whole = leaves.agg(F.expr(f"(sum(tokens) * {share}) div 100").cast(WIDE).alias("asked"))
    held = open_leaves.agg(capacity)
    # one row each
    total = whole.select("asked", F.lit(1).alias("one")).join(held.withColumn("one", F.lit(1)), "one")
    total = total.select(F.least("asked", "capacity").alias("parent_budget"), F.lit(0).alias("root"))
    above, parents = total, ["root"]
    for depth, level in enumerate(LEVELS):
        own = list(LEVELS[: depth + 1])
        nodes = open_leaves.groupBy(*own).agg(capacity).withColumn("root", F.lit(0))
        nodes = nodes.withColumn("weight", _weight(level, weights)).join(above, parents)
        shared = _shared(nodes, parents, level)
        above = shared.select(*parents, level, F.col("budget").alias("parent_budget"))
        parents = [*parents, level]
    found = above.select(*LEVELS, F.col("parent_budget").cast("long").alias("budget"))
    return found.join(leaves, list(LEVELS))


def mix(
    documents: DataFrame,
    domain: Column | None = None,
    share: int = SHARE,
    epochs: int = EPOCHS,
    seed: int = SEED,
    weights: Mapping[str, Mapping[str, int]] = WEIGHTS,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    source_column: str = "source",
) -> DataFrame:
    """(row, domain, lang, source, tokens, epoch): the rows taken, once for each epoch they are taken in.

    share hundredths of all tokens (words) are dealt out down the tree of domains,
    languages and sources by weight; a node that holds fewer, `epochs` times its
    tokens, leaves the rest to its siblings, and only what these cannot use goes
    to its parent's siblings.  A leaf takes whole epochs as long as its budget
    lasts, and of the next epoch, whose order the seed sets, the longest run from
    the start that the budget still holds.

    row holds all columns of the documents.  Null languages and sources are
    leaves named `-`; null texts have no tokens.  A document without tokens adds
    nothing to a run and is taken with it.  Rows with one doc_id are told apart by
    their text; rows that share both have places next to each other.  Weight 0
    shuts a node.  A leaf whose documents have no tokens takes nothing.  No rows:
    no rows.
    """
    domain = domain_of(F.col(source_column)) if domain is None else domain
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("-"))
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = documents.select(
        F.struct("*").alias("row"),
        domain.alias("domain"),
        name(lang_column).alias("lang"),
        name(source_column).alias("source"),
        word_count(text).alias("tokens"),
        F.concat_ws(":", F.coalesce(F.col(id_column).cast("string"), F.lit("-")), F.md5(text.cast("binary"))).alias("name"),
    )
    leaves = settle(rows.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens")), "mixture-leaves")
    leaves = leaves.where("tokens > 0")
    leaf = settle(
        budgets(leaves, share, epochs, weights).select(
            *LEVELS,
            F.expr("budget div tokens").cast("int").alias("whole"),
            F.expr("budget % tokens").alias("rest"),
        ),
        "mixture-budgets",
    )
    place = F.md5(F.concat_ws(":", F.lit(seed), F.col("whole"), F.col("name")).cast("binary"))
    placed = (
        rows.join(leaf, list(LEVELS))
        .withColumn("place", place)
        .withColumn("bucket", F.substring("place", 1, BUCKET_DIGITS))
    )
    # Where in its leaf's order each bucket begins; only the bucket in which the
    # budget ends is looked at row by row.
    sizes = placed.groupBy(*LEVELS, "bucket").agg(F.sum("tokens").alias("held"))
    so_far = Window.partitionBy(*LEVELS).orderBy("bucket")
    ends = settle(
        sizes.withColumn("end", F.sum("held").over(so_far)).withColumn("begin", F.col("end") - F.col("held")),
        "mixture-buckets",
    )
    last = (
        ends.join(leaf, list(LEVELS))
        .where("end > rest")
        .groupBy(*LEVELS)
        .agg(F.min(F.struct("bucket", "begin")).alias("last"))
        .select(*LEVELS, F.col("last.bucket").alias("last_bucket"), F.col("last.begin").alias("last_begin"))
    )
    placed = placed.join(settle(last, "mixture-last"), list(LEVELS), "left")
    kept = ["row", *LEVELS, "tokens"]
    full = placed.where("whole > 0").select(*kept, F.explode(F.sequence(F.lit(1), F.col("whole"))).alias("epoch"))
    early = placed.where("rest > 0 AND (last_bucket IS NULL OR bucket < last_bucket)")
    early = early.select(*kept, (F.col("whole") + 1).alias("epoch"))
    run = Window.partitionBy(*LEVELS).orderBy("place", "tokens").rowsBetween(Window.unboundedPreceding, 0)
    ending = (
        placed.where("rest > 0 AND bucket = last_bucket")
        .withColumn("end", F.col("last_begin") + F.sum("tokens").over(run))
        .where("end <= rest")
        .select(*kept, (F.col("whole") + 1).alias("epoch"))
    )
    return full.unionByName(early).unionByName(ending)


def mixed_documents(documents: DataFrame, **options) -> DataFrame:
    """The documents taken, in their own columns, once for each epoch they are taken in."""
    return mix(documents, **options).select("row.*")
