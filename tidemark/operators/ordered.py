"""Row order within a key without gathering the key in one task.

A window over a key sorts all its rows in one task. Here a key is cut into ranges
of its order column; each (key, range) is worked on its own, and one small row per
(key, range) carries the state from range to range. Rows of a key are unique in
the order column, so a range of width w holds at most w rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _ranged(rows: DataFrame, order: str, width: int) -> DataFrame:
    return rows.withColumn("_range", F.floor(F.col(order) / F.lit(width)))


def previous_value(rows: DataFrame, keys: Sequence[str], order: str, value: str, width: int,
                   name: str = "previous") -> DataFrame:
    """``lag(value)`` per key along a unique integer column."""
    keys = list(keys)
    ranged = _ranged(rows, order, width)
    last = ranged.groupBy(*keys, "_range").agg(F.max_by(value, order).alias("_last"))
    carried = last.select(*keys, "_range", F.lag("_last").over(
        Window.partitionBy(*keys).orderBy("_range")).alias("_carried"))
    within = Window.partitionBy(*keys, "_range").orderBy(order)
    inner = (ranged.withColumn("_inner", F.lag(value).over(within))
             .withColumn("_nth", F.row_number().over(within)))
    return (inner.join(carried, keys + ["_range"])
            .withColumn(name, F.when(F.col("_nth") > 1, F.col("_inner")).otherwise(F.col("_carried")))
            .drop("_range", "_inner", "_nth", "_carried"))


def running_sums(rows: DataFrame, keys: Sequence[str], order: str, measures: dict[str, str], width: int,
                 include_current: bool = True) -> DataFrame:
    """Running sums per key along an integer column; ``measures`` maps input to output.

    Without ``include_current`` a row sees only rows of a strictly lower order value.
    """
    keys = list(keys)
    ranged = _ranged(rows, order, width)
    totals = ranged.groupBy(*keys, "_range").agg(*[F.sum(m).alias(f"_t_{m}") for m in measures])
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, "_range", *[
        F.coalesce(F.sum(f"_t_{m}").over(earlier), F.lit(0)).alias(f"_o_{m}") for m in measures])
    upto = 0 if include_current else -1
    within = (Window.partitionBy(*keys, "_range").orderBy(order)
              .rangeBetween(Window.unboundedPreceding, upto))
    inner = ranged
    for m in measures:
        inner = inner.withColumn(f"_i_{m}", F.coalesce(F.sum(m).over(within), F.lit(0)))
    joined = inner.join(offsets, keys + ["_range"])
    for m, out in measures.items():
        joined = joined.withColumn(out, F.col(f"_i_{m}") + F.col(f"_o_{m}"))
    return joined.drop("_range", *[f"_i_{m}" for m in measures], *[f"_o_{m}" for m in measures])
