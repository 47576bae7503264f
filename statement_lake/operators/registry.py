"""Symbol registry: which symbol a renamed security first traded under.

Columns: map_to, symbol, conid, description, first_seen, src.  Rows are never
revised once written, and ``map_to`` is set once, so the registry is state that
is folded over the sources in their order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statement_lake.session import settle, settled

REGISTRY_SCHEMA = (
    "map_to string, symbol string, conid bigint, description string, first_seen date, src string"
)
# Sources whose texts name a security in the dictionary.
DICTIONARY_SOURCES = ("trades", "positions")


def candidates(
    facts: DataFrame,
    src: str,
    description: Column | None = None,
    category: str | None = None,
    date: str = "reportDate",
) -> DataFrame:
    """Securities of a source with the date each was first seen."""
    rows = facts.where(F.col("conid").isNotNull())
    if category is not None:
        rows = rows.where(F.col("assetCategory") == category)
    text = F.col("description") if description is None else description
    return (
        rows.select("symbol", "conid", text.alias("description"), F.col(date).alias("_date"))
        .groupBy("symbol", "conid", "description")
        .agg(F.min("_date").alias("first_seen"))
        .select(
            F.lit(None).cast("string").alias("map_to"),
            "symbol",
            "conid",
            "description",
            "first_seen",
            F.lit(src).alias("src"),
        )
    )


def unseen(registry: DataFrame, found: DataFrame) -> DataFrame:
    """Candidates the registry lacks; missing texts compare as equal, so reruns add nothing."""
    known = registry.select("symbol", "conid", "description").alias("known")
    new = found.alias("new")
    same = (
        F.col("new.symbol").eqNullSafe(F.col("known.symbol"))
        & (F.col("new.conid") == F.col("known.conid"))
        & F.col("new.description").eqNullSafe(F.col("known.description"))
    )
    return new.join(known, same, "left_anti")


def register(registry: DataFrame, found: DataFrame) -> DataFrame:
    return registry.unionByName(unseen(registry, found))


def earliest_symbols(registry: DataFrame, key: str, ignore_blank: bool = False) -> DataFrame:
    """(key, symbol, root) for each symbol last registered after the key's earliest symbol.

    The earliest row of a key is earlier than any row that has an earlier one,
    so pairing every row with all earlier rows of its key comes down to two
    aggregates.  Ties on the date go by symbol.
    """
    dated = registry.where(F.col("first_seen").isNotNull() & F.col(key).isNotNull())
    if ignore_blank:
        dated = dated.where(F.trim(key) != "")
    roots = dated.groupBy(key).agg(
        F.min("first_seen").alias("_root_date"),
        F.min_by("symbol", F.struct("first_seen", F.col("symbol").isNull(), "symbol")).alias("_root"),
    )
    last = dated.groupBy(key, "symbol").agg(F.max("first_seen").alias("_last"))
    return last.join(roots, key).where("_last > _root_date").select(key, "symbol", "_root")


def _open_rows(registry: DataFrame) -> DataFrame:
    return registry.where(F.col("map_to").isNull())


def _mapped_rows(registry: DataFrame) -> DataFrame:
    return registry.where(F.col("map_to").isNotNull())


def _moves(registry: DataFrame, key: str, ignore_blank: bool = False) -> DataFrame:
    """Moves of the keys that open rows have."""
    keys = _open_rows(registry).select(key).distinct()
    return earliest_symbols(registry.join(keys, key, "left_semi"), key, ignore_blank)


def _filled(registry: DataFrame, *moves: tuple[str, DataFrame]) -> DataFrame:
    """The open rows, with the first root the moves offer."""
    rows, roots = _open_rows(registry), []
    for key, found in moves:
        roots.append(f"_root_{key}")
        rows = rows.join(found.withColumnRenamed("_root", roots[-1]), [key, "symbol"], "left")
    return rows.withColumn("map_to", F.coalesce(*roots)).select(*registry.columns)


def map_by(registry: DataFrame, key: str, ignore_blank: bool = False) -> DataFrame:
    """Map open rows to the earliest symbol of the same ``key``, one hop."""
    filled = _filled(registry, (key, _moves(registry, key, ignore_blank)))
    return _mapped_rows(registry).unionByName(filled)


def resolve(registry: DataFrame, ignore_blank_description: bool = False) -> DataFrame:
    """Fill ``map_to``: by contract id, then by description, then to the symbol itself.

    ``registry`` should be settled; it comes back as it is when nothing is open.
    Only the keys of open rows are aggregated, and only open rows are written, so
    a load with few new securities does little work on a large registry.
    """
    if _open_rows(registry).isEmpty():
        return registry
    # Each look-up is written before the next one, so that only one's shuffles are there at a time.
    with (
        settled(_moves(registry, "conid"), "moves") as by_conid,
        settled(_moves(registry, "description", ignore_blank_description), "moves") as by_text,
    ):
        filled = _filled(registry, ("conid", by_conid), ("description", by_text))
        new = settle(filled.withColumn("map_to", F.coalesce("map_to", "symbol")), "registry")
    return _mapped_rows(registry).unionByName(new)


def dictionary(registry: DataFrame) -> DataFrame:
    """(symbol, description): the latest description of each canonical symbol."""
    named = registry.where(
        F.col("src").isin(*DICTIONARY_SOURCES)
        & F.col("first_seen").isNotNull()
        & F.col("map_to").isNotNull()
    )
    latest_first = F.struct(
        -F.unix_date("first_seen"),
        F.col("symbol").isNull(),
        "symbol",
        F.col("description").isNull(),
        "description",
    )
    return named.groupBy(F.col("map_to").alias("symbol_key")).agg(
        F.min_by("description", latest_first).alias("description")
    ).select(F.col("symbol_key").alias("symbol"), "description")


def canonical(facts: DataFrame, registry: DataFrame, description: str = "description") -> DataFrame:
    """Replace each fact's symbol by its canonical one where the registry knows the triple.

    Registry triples without a missing part are unique, so facts never multiply.
    The registry should be a stored or settled table: a small one is broadcast by
    size, and otherwise a hot triple's facts are split by adaptive execution.
    """
    known = registry.where(
        F.col("symbol").isNotNull() & F.col("conid").isNotNull() & F.col("description").isNotNull()
    ).select(
        F.col("symbol").alias("_symbol"),
        F.col("conid").alias("_conid"),
        F.col("description").alias("_description"),
        "map_to",
    )
    same = (
        (F.col("symbol") == F.col("_symbol"))
        & (F.col("conid") == F.col("_conid"))
        & (F.col(description) == F.col("_description"))
    )
    columns = facts.columns
    return (
        facts.join(known, same, "left")
        .withColumn("symbol", F.coalesce("map_to", "symbol"))
        .select(*columns)
    )
