"""Privacy-safe copies of the marts."""

from __future__ import annotations

import random
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from statement_lake.session import settle

# Money columns (lower case), datasets that are rewritten, text pattern.
MONEY_COLUMNS = frozenset(
    """
    tradeprice trademoney proceeds taxes ibcommission netcash closeprice cost costbasis
    fifopnlrealized mtmpnl marketvalue positionvalue costbasismoney fifopnlunrealized cash
    stock options funds dividendaccruals interestaccruals forexcfdunrealizedpl
    cfdunrealizedpl crypto total totallong totalshort amount amountbase price avgprice
    averageprice markprice strike value
    """.split()
)
DATASETS = frozenset(
    """
    trades_history positions_latest positions_history cash_transactions_history
    account_nav_latest account_nav_history symbols_dictionary corporate_actions_history
    """.split()
)
COMPANY_DATASETS = ("symbols_dictionary", "positions_latest", "positions_history")
SECURITY_PREFIX = r"^[A-Za-z0-9._-]+\([^)]+\)\s+"
CODE_WIDTH = 4
LETTERS = 26
MOST_LETTERS = 8


def draw_factor(seed: int | None = None) -> float:
    """A money factor from 2.0, 2.1, … 20.0."""
    return random.Random(seed).randint(20, 200) * 0.1


def symbol_columns(rows: DataFrame) -> list[str]:
    lowered = [(name, name.lower()) for name in rows.columns]
    return [name for name, low in lowered if low == "symbol" or low.startswith("symbol_")]


def distinct_symbols(datasets: Mapping[str, DataFrame]) -> DataFrame | None:
    """Every non-blank symbol of the datasets that are rewritten."""
    parts = [
        rows.select(F.col(f"`{column}`").cast("string").alias("symbol")).distinct()
        for dataset_id, rows in datasets.items()
        if dataset_id in DATASETS
        for column in symbol_columns(rows)
    ]
    if not parts:
        return None
    return reduce(DataFrame.unionByName, parts).where(F.trim("symbol") != "").distinct()


def _letters(number: Column, width: int) -> Column:
    """The number in letters, with `width` of them at least; longer numbers take as many as they need."""
    digits = F.char(F.lit(65) + F.pmod(number, F.lit(LETTERS)))
    text = digits
    for place in range(1, MOST_LETTERS):
        higher = F.floor(number / F.lit(LETTERS**place))
        letter = F.char(F.lit(65) + F.pmod(higher, F.lit(LETTERS)))
        shown = letter if place < width else F.when(higher > 0, letter).otherwise(F.lit(""))
        text = F.concat(shown, text)
    return text


def symbol_codes(symbols: DataFrame, width: int = CODE_WIDTH) -> DataFrame:
    """(symbol, code): each symbol's position in code-point order, as letters.

    Positions come from range partitions: the position inside the partition plus
    the sizes of those before it, so no task holds all symbols.  A code depends
    on the position alone: positions from 26^width on have more letters.
    """
    ranged = settle(
        symbols.select("symbol")
        .distinct()
        .repartitionByRange("symbol")
        .withColumn("part", F.spark_partition_id()),
        "symbols",
    )
    # One row per partition: as many as the range shuffle has, whatever the data.
    sizes = ranged.groupBy("part").agg(F.count("*").alias("size"), F.min("symbol").alias("start"))
    offsets = sizes.select(
        "part",
        (
            F.sum("size").over(W.orderBy("start").rowsBetween(W.unboundedPreceding, 0))
            - F.col("size")
        ).alias("offset"),
    )
    position = F.row_number().over(W.partitionBy("part").orderBy("symbol")) - 1
    return (
        ranged.withColumn("position", position)
        .join(F.broadcast(offsets), "part")
        .select("symbol", _letters(F.col("position") + F.col("offset"), width).alias("code"))
    )


def cash_description(text: Column, code: Column) -> Column:
    """Replace a leading ``TICKER(ID)`` by the code; other texts stay."""
    return F.when(
        code.isNotNull() & text.rlike(SECURITY_PREFIX),
        F.concat(code, F.lit(" "), F.regexp_replace(text, SECURITY_PREFIX, "")),
    ).otherwise(text)


def company_description(text: Column, code: Column) -> Column:
    return F.when(code.isNotNull(), F.concat(F.lit("Company "), code)).otherwise(text)


def corporate_action_description(code: Column) -> Column:
    return F.when(code.isNotNull(), F.concat(F.lit("Corporate action for "), code)).otherwise(
        F.lit("Corporate action")
    )


def action_text(type_: Column, code: Column) -> Column:
    """``type / code``, or the one that is there."""
    return (
        F.when(type_.isNotNull() & code.isNotNull(), F.concat(type_, F.lit(" / "), code))
        .when(type_.isNotNull(), type_)
        .when(code.isNotNull(), code)
        .otherwise(F.lit("Corporate action"))
    )


def obfuscate(
    rows: DataFrame,
    dataset_id: str,
    codes: DataFrame,
    factor: float,
    extra_money_columns: Iterable[str] = (),
) -> DataFrame:
    """Rewrite one dataset: symbols to codes, texts by dataset, money scaled, the rest as it is.

    ``codes`` should be settled: a small map is broadcast by size, and otherwise a
    hot symbol's rows are split by adaptive execution.
    """
    money = MONEY_COLUMNS | {name.lower() for name in extra_money_columns}
    columns = rows.columns
    joined = rows
    code_of = {}
    for position, name in enumerate(symbol_columns(rows)):
        key, code_of[name] = f"_symbol_{position}", f"_code_{position}"
        lookup = codes.select(F.col("symbol").alias(key), F.col("code").alias(code_of[name]))
        joined = joined.join(lookup, F.col(f"`{name}`").cast("string") == F.col(key), "left")
    code = F.col(code_of["symbol"]) if "symbol" in code_of else F.lit(None).cast("string")

    def rewritten(name: str) -> Column:
        low, value = name.lower(), F.col(f"`{name}`")
        if name in code_of:
            return F.coalesce(F.col(code_of[name]), value.cast("string"))
        if low == "description" and dataset_id == "cash_transactions_history":
            return cash_description(value, code)
        if low == "description" and dataset_id in COMPANY_DATASETS:
            return company_description(value, code)
        if low == "description" and dataset_id == "corporate_actions_history":
            return corporate_action_description(code)
        if low == "actiondescription" and dataset_id == "corporate_actions_history":
            return action_text(F.col("type"), F.col("code"))
        if low in money:
            return value * F.lit(factor)
        return value

    return joined.select(*[rewritten(name).alias(name) for name in columns])
