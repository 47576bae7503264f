"""Replace-then-insert of a batch into stored rows.

Each function takes the stored rows the batch can touch and returns their
replacement.  Copies inside a batch are content, not conflicts: they stay,
except where a source defines one row per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statement_lake.session import settle


def replace_by_hash(stored: DataFrame, batch: DataFrame, column: str) -> DataFrame:
    """Stored rows whose content the batch does not deliver again, and the whole batch.

    ``batch`` should be settled: it is read twice, and its hashes are joined as
    they are, which keeps the shape whose skewed partitions are split.
    """
    return kept_by_hash(stored, batch, column).unionByName(batch)


def kept_by_hash(stored: DataFrame, batch: DataFrame, column: str) -> DataFrame:
    """The stored rows whose content the batch does not deliver again."""
    return stored.join(batch.select(column), column, "left_anti")


def replace_dates(stored: DataFrame, batch: DataFrame, date: str, column: str) -> DataFrame:
    """Replace every stored row of the batch's dates, whatever account it is of.

    Rows without a date are replaced by content.  The dates of a batch are
    bounded by the calendar, so they are broadcast.
    """
    dates = batch.where(F.col(date).isNotNull()).select(date).distinct()
    kept = stored.join(F.broadcast(dates), date, "left_anti")
    return replace_by_hash(kept, batch, column)


def replace_by_key(stored: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Replace stored rows that share the key of a batch row; a blank account equals a missing one."""
    names = [f"_key_{position}" for position in range(len(keys))]
    kinds = dict(stored.dtypes)

    def part(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit("")) if kinds[name] == "string" else F.col(name)

    parts = dict(zip(names, map(part, keys), strict=True))
    delivered = batch.select(*[value.alias(name) for name, value in parts.items()]).distinct()
    kept = stored.withColumns(parts).join(delivered, names, "left_anti").drop(*names)
    return kept.unionByName(batch)


def last_per_key(
    rows: DataFrame, keys: list[str], order: Column, columns: list[str] | None = None
) -> DataFrame:
    """The row of greatest ``order`` for each key, pre-aggregated before the shuffle."""
    columns = columns or rows.columns
    others = [name for name in columns if name not in keys]
    best = rows.groupBy(*keys).agg(
        F.max_by(F.struct(*others), order).alias("_row"),
    )
    return best.select(*keys, "_row.*").select(*columns)


def greatest_hash_per_key(rows: DataFrame, keys: list[str], column: str) -> DataFrame:
    """One row per key, the one whose content hash sorts last; a missing account becomes blank.

    Rows without a hash come before all others.
    """
    kinds = dict(rows.dtypes)
    blanks = {name: F.coalesce(name, F.lit("")) for name in keys if kinds[name] == "string"}
    filled = rows.withColumns(blanks) if blanks else rows
    return last_per_key(filled, keys, F.coalesce(column, F.lit("")))


def last_file_by_hash(rows: DataFrame, column: str, order: str = "file_order") -> DataFrame:
    """Loading files one after another, at once: content stays with the copies of its last file."""
    last = settle(
        rows.groupBy(column).agg(F.max(order).alias(order)),
        "last-file",
    )
    return rows.join(last, [column, order], "left_semi")


def last_file_copies(
    rows: DataFrame, column: str, columns: list[str], order: str = "file_order"
) -> DataFrame:
    """The same for a hash over all of the content: rows of one hash are copies of each other.

    Only hashes that occur more than once can be in several files; their files are
    looked at, and only hashes of several files are joined with the rows.
    """
    rows = rows.where(F.col(order).isNotNull())
    seen = rows.select(F.col(column).alias("_of")).groupBy("_of").agg(F.count("*").alias("_n"))
    repeated = settle(seen.where("_n > 1").select("_of"), "repeated")
    of = F.col(column).eqNullSafe(F.col("_of"))
    files = rows.select(column, order).join(repeated, of, "left_semi").groupBy(F.col(column).alias("_of"))
    last = files.agg(F.min(order).alias("_first"), F.max(order).alias("_last")).where("_first < _last")
    overtaken = settle(last.select("_of", "_last"), "last-file")
    return rows.join(overtaken, of & (F.col(order) < F.col("_last")), "left_anti").select(*columns)


def last_file_by_date(
    rows: DataFrame, date: str, column: str, order: str = "file_order"
) -> DataFrame:
    """The same where each file replaces whole dates; rows without a date go by content."""
    dated = F.col(date).isNotNull()
    last = rows.where(dated).groupBy(date).agg(F.max(order).alias(order))
    current = rows.where(dated).join(F.broadcast(last), [date, order], "left_semi")
    return current.unionByName(last_file_by_hash(rows.where(~dated), column, order))


def last_file_by_key(
    rows: DataFrame, keys: list[str], column: str, order: str = "file_order"
) -> DataFrame:
    """The same where a key has one row: last file first, then greatest hash within it."""
    kinds = dict(rows.dtypes)
    blanks = {name: F.coalesce(name, F.lit("")) for name in keys if kinds[name] == "string"}
    filled = rows.withColumns(blanks) if blanks else rows
    return last_per_key(filled, keys, F.struct(order, column))
