"""Date parts and relative-time predicates. ``as_of`` always comes from the caller."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def moment(as_of: datetime | date | str) -> Column:
    """The reference time of a report as a timestamp literal."""
    text = as_of if isinstance(as_of, str) else as_of.isoformat(sep=" ") if isinstance(as_of, datetime) else as_of.isoformat()
    return F.lit(text).cast("timestamp")


def day_of(as_of) -> Column:
    return F.to_date(moment(as_of))


def since(ts: Column, as_of, interval: str) -> Column:
    """``ts`` lies no further back than ``interval`` (for example ``30 DAY``), and not after ``as_of``."""
    return (ts >= moment(as_of) - F.expr(f"INTERVAL {interval}")) & (ts <= moment(as_of))


def days_back(day: Column, as_of, days: int) -> Column:
    return (day >= F.date_sub(day_of(as_of), days)) & (day <= day_of(as_of))


def on_day(ts: Column, as_of) -> Column:
    """Same calendar day, as a range so that parquet statistics can prune."""
    start = day_of(as_of)
    return (ts >= start.cast("timestamp")) & (ts < F.date_add(start, 1).cast("timestamp"))


def _in_months(rows: DataFrame, first: Column, last: Column) -> DataFrame:
    """Of a table kept by month, only the folders from the one of ``first`` to that of ``last``: bounds are constants, so the scan prunes."""
    if "yyyymm" not in rows.columns:
        return rows
    return rows.filter(F.col("yyyymm").between(yyyymm(first), yyyymm(last)))


def rows_since(rows: DataFrame, as_of, interval: str, column: str = "created_at") -> DataFrame:
    """The rows :func:`since` keeps; a table with a ``yyyymm`` of ``column`` is read from the months in question."""
    now = moment(as_of)
    return _in_months(rows, now - F.expr(f"INTERVAL {interval}"), now).filter(since(F.col(column), as_of, interval))


def rows_of_days(rows: DataFrame, as_of, days: int, column: str) -> DataFrame:
    """The rows :func:`days_back` keeps, read from the months in question."""
    today = day_of(as_of)
    return _in_months(rows, F.date_sub(today, days), today).filter(days_back(F.col(column), as_of, days))


def rows_on_day(rows: DataFrame, as_of, column: str = "created_at") -> DataFrame:
    """The rows :func:`on_day` keeps, read from its month."""
    return _in_months(rows, day_of(as_of), day_of(as_of)).filter(on_day(F.col(column), as_of))


def start_of_hour(ts: Column) -> Column:
    return F.date_trunc("hour", ts)


def monday(ts: Column) -> Column:
    return F.to_date(F.date_trunc("week", ts))


def month_start(ts: Column) -> Column:
    return F.trunc(ts, "MM")


def yyyymm(ts: Column) -> Column:
    return F.year(ts) * 100 + F.month(ts)


def iso_weekday(day: Column) -> Column:
    """Monday is 1, Sunday is 7."""
    return F.weekday(day) + 1


def month_gap(earlier: Column, later: Column) -> Column:
    """Month boundaries crossed, not whole months elapsed."""
    return (F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)


def epoch_day(day: Column) -> Column:
    return F.datediff(day, F.lit("1970-01-01").cast("date"))
