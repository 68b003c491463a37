"""Money, ratios and display text."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.schemas import OP_LABELS, STATUS_LABELS


def total(column: Column | str) -> Column:
    """Sum of a money column; an empty group gives 0."""
    return F.coalesce(F.sum(column), F.lit(0)).cast("decimal(18,2)")


def whole(column: Column) -> Column:
    """A count or an integer sum; NULL counts as 0."""
    return F.coalesce(column, F.lit(0)).cast("bigint")


def cents(amount: Column) -> Column:
    return (amount * 100).cast("bigint")


def rounded(value: Column, digits: int = 4) -> Column:
    """Half-up rounding by plain double arithmetic, the same on every engine."""
    step = float(10 ** digits)
    return F.floor(value * F.lit(step) + F.lit(0.5)) / F.lit(step)


def ratio(part: Column, base: Column, factor: float = 1.0) -> Column:
    """``factor * part / base`` as a double of four places; NULL for a zero base."""
    scaled = part.cast("double") * F.lit(factor) if factor != 1.0 else part.cast("double")
    return rounded(F.try_divide(scaled, base.cast("double")))


def op_label(op: Column) -> Column:
    return F.create_map(*[F.lit(x) for x in chain(*OP_LABELS.items())])[op]


def status_label(status: Column) -> Column:
    """Display label; an unknown status shows as it is."""
    labels = F.create_map(*[F.lit(x) for x in chain(*STATUS_LABELS.items())])
    return F.coalesce(F.try_element_at(labels, status), status)


def money_text(amount: Column) -> Column:
    return F.concat(F.lit("₩"), F.format_number(amount, 0))


def time_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy. MM. dd. HH:mm:ss")
