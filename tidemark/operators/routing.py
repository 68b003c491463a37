"""Routing of raw change events by table and by change code."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def event_table(value: Column) -> Column:
    return F.get_json_object(value, "$.source.table")


def event_op(value: Column) -> Column:
    return F.get_json_object(value, "$.op")


def belongs(table: str, op: str | None = None) -> Column:
    """The event is of this table, and of this change code if one is given.

    Broken JSON and missing fields read as NULL, which no filter keeps. Only texts that hold the name,
    or an escape that may spell it, are parsed.
    """
    keep = (F.col("value").contains(table) | F.col("value").contains("\\")) & (event_table(F.col("value")) == table)
    return keep if op is None else keep & (event_op(F.col("value")) == op)


def route(events: DataFrame, table: str, op: str | None = None) -> DataFrame:
    """Events of one table, optionally of one change code."""
    return events.filter(belongs(table, op))


def fan_out(events: DataFrame, tables: Iterable[str]) -> dict[str, DataFrame]:
    """One narrow branch per table: no shuffle, each branch filters on its own."""
    return {table: route(events, table) for table in tables}


def tagged(events: DataFrame, tables: Iterable[str]) -> DataFrame:
    """All wanted events with their table in a column, for one partitioned write.

    The name comes from a generator, or else each use of the column would parse the text again.
    """
    return (events.select(*[c for c in events.columns if c != "table"], F.explode(F.array(event_table(F.col("value")))).alias("table"))
            .filter(F.col("table").isin(*tables)))
