"""Content fingerprint of a record's attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fingerprint(attributes: Column) -> Column:
    """SHA-256 hex of ``name=value`` for every attribute, by name, joined with ``|``.

    ``attributes`` is a string map of the attributes that are present, so an
    absent attribute and an empty one give different fingerprints.
    """
    pairs = F.transform(
        F.sort_array(F.map_entries(attributes)),
        lambda entry: F.concat(entry["key"], F.lit("="), entry["value"]),
    )
    return F.sha2(F.array_join(pairs, "|"), 256)


def fingerprint_of(**columns: Column) -> Column:
    """The same fingerprint where the attributes are known columns; NULL means absent."""
    pairs = [F.concat(F.lit(f"{name}="), columns[name]) for name in sorted(columns)]
    return F.sha2(F.concat_ws("|", *pairs), 256)
