"""Text attributes to typed columns.

Every parser keeps three outcomes apart: absent or empty text is NULL, a
readable value is typed, and an unreadable value is NULL and reported by
``is_bad``.  Values are rearranged into ISO text and cast, so neither the
session time zone nor the ANSI mode touches them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLANKS = " \t\n\r\f\u000b"
_PLAIN_NUMBER = r"^[+-]?\d+(?:\.\d+)?$"
_NUMBER = (
    r"^[+-]?(?:\d+(?:_\d+)*(?:\.(?:\d+(?:_\d+)*)?)?|\.\d+(?:_\d+)*)"
    r"(?:[eE][+-]?\d+(?:_\d+)*)?$"
)


def has_text(raw: Column) -> Column:
    """True for present, non-empty text; never NULL."""
    return F.coalesce(raw != "", F.lit(False))


def value_text(raw: Column) -> Column:
    """Stripped text of a value; absent and empty become NULL, blank stays as empty text."""
    return F.btrim(F.nullif(raw, F.lit("")), F.lit(_BLANKS))


def _dashed(text: Column) -> Column:
    return F.concat_ws("-", text.substr(1, 4), text.substr(5, 2), text.substr(7, 2))


def _clock(text: Column, start: int) -> Column:
    parts = [text.substr(start + offset, 2) for offset in (0, 2, 4)]
    return F.concat(F.lit(" "), F.concat_ws(":", *parts))


def date_of(text: Column) -> Column:
    """``yyyyMMdd`` or ``yyyy-M-d``."""
    iso = F.when(text.rlike(r"^\d{8}$"), _dashed(text)).when(
        text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), text
    )
    return F.when(~text.startswith("0000"), iso.try_cast("date"))


def timestamp_of(text: Column, accept_compact: bool = False) -> Column:
    """``yyyyMMddHHmmss``, ``yyyyMMdd`` or ``yyyy-M-d H:m:s`` with a blank, ``;`` or ``T`` between.

    ``accept_compact`` also takes ``yyyyMMdd;HHmmss``.
    """
    iso = (
        F.when(text.rlike(r"^\d{14}$"), F.concat(_dashed(text), _clock(text, 9)))
        .when(text.rlike(r"^\d{8}$"), F.concat(_dashed(text), F.lit(" 00:00:00")))
        .when(
            text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}(?:[\s;]+|[Tt])\d{1,2}:\d{1,2}:\d{1,2}$"),
            F.regexp_replace(text, r"[\s;]+|[Tt]", " "),
        )
    )
    if accept_compact:
        iso = iso.when(
            text.rlike(r"^\d{8}[ ;]\d{6}$"), F.concat(_dashed(text), _clock(text, 10))
        )
    return F.when(~text.startswith("0000"), iso.try_cast("timestamp_ntz"))


def double_of(text: Column) -> Column:
    """Float text with optional thousands commas; ``nan`` and ``inf`` are values."""
    digits = F.btrim(F.replace(text, F.lit(","), F.lit("")), F.lit(_BLANKS))
    return (
        F.when(text.rlike(_PLAIN_NUMBER), text.try_cast("double"))
        .when(digits.rlike(_NUMBER), F.replace(digits, F.lit("_"), F.lit("")).try_cast("double"))
        .when(digits.rlike(r"(?i)^[+-]?nan$"), F.lit(float("nan")))
        .when(digits.rlike(r"(?i)^[+-]?inf(?:inity)?$"), digits.try_cast("double"))
    )


def long_of(text: Column) -> Column:
    """Whole number; anything else is NULL and never reported."""
    return F.when(
        text.rlike(r"^[+-]?\d+(?:_\d+)*$"),
        F.replace(text, F.lit("_"), F.lit("")).try_cast("bigint"),
    )


def flag_of(text: Column) -> Column:
    letter = F.upper(text)
    return F.when(letter == "Y", F.lit(True)).when(letter == "N", F.lit(False))


_READERS = {
    "date": date_of,
    "timestamp_ntz": timestamp_of,
    "double": double_of,
    "bigint": long_of,
    "boolean": flag_of,
}
STRICT_TYPES = ("date", "timestamp_ntz", "double")


def typed(text: Column, type_name: str, accept_compact: bool = False) -> Column:
    """Value of ``value_text``; attributes of type string are taken raw instead."""
    if type_name == "timestamp_ntz":
        return timestamp_of(text, accept_compact)
    return _READERS[type_name](text)


def is_bad(text: Column, value: Column) -> Column:
    """Text is there, but the strict parser could not read it."""
    return text.isNotNull() & value.isNull()
