"""Safe field coercions: bad input gives NULL, never an error.

A field arrives as ``text`` (the JSON text or number as a string). JSON numbers
and JSON text follow different rules only where the text looks like a number that
is not an integer: ``7.9`` truncates to 7, ``"7.9"`` is refused. ``number`` is the
field read as a JSON number (NULL for JSON text) and is evaluated in that case only.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_INTEGER = r"^[+-]?[0-9]+$"
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_INSTANT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,9})?Z$"


def to_whole(text: Column, number: Column, sql_type: str = "bigint") -> Column:
    """Numbers truncate; text must be a plain integer; out of range gives NULL."""
    return (F.when(text.rlike(_INTEGER), text.try_cast(sql_type))
            .when(text.rlike(_NUMBER), number.try_cast(sql_type)))


def to_long(text: Column, number: Column) -> Column:
    return to_whole(text, number, "bigint")


def to_int(text: Column, number: Column) -> Column:
    return to_whole(text, number, "int")


def to_decimal(text: Column, precision: int = 10, scale: int = 2) -> Column:
    """Text or number to a decimal, rounded half up; overflow gives NULL."""
    return F.when(text.rlike(_NUMBER), text.try_cast(f"decimal({precision},{scale})"))


def to_instant(text: Column, number: Column) -> Column:
    """Epoch milliseconds (number or digits) or an ISO instant ending in ``Z``."""
    return (F.when(text.rlike(_INSTANT), text.try_cast("timestamp"))
            .otherwise(F.timestamp_millis(to_long(text, number))))
