"""Change-event envelopes: building them from rows.

An envelope is one JSON text per row change: ``before``, ``after``,
``source{db, table, ts_ms, file, pos}``, ``op`` and ``ts_ms``. Decimals travel as
text, times as ISO instants.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import ORDER_ITEMS, ORDERS


def _wire(field: T.StructField) -> Column:
    column = F.col(field.name)
    if isinstance(field.dataType, T.DecimalType):
        return column.cast("string").alias(field.name)
    if isinstance(field.dataType, T.TimestampType):
        return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias(field.name)
    return column


def to_envelopes(log: DataFrame, table: str, schema: T.StructType, db: str = "shop", file: Column | None = None,
                 pos: Column | None = None, former: dict[str, str] | None = None) -> DataFrame:
    """One ``value`` text per log row; a delete carries its image in ``before``.

    ``former`` names columns of ``log`` with values from before an update, by field:
    an update then carries its image with these in ``before``.
    """
    image = F.struct(*[_wire(f) for f in schema])
    gone = F.col("cdc_op").eqNullSafe("d")
    old = F.lit(None) if former is None else F.when(F.col("cdc_op") == "u", F.struct(
        *[F.col(former[f.name]).alias(f.name) if f.name in former else _wire(f) for f in schema]))
    source = F.struct(
        F.lit(db).alias("db"), F.lit(table).alias("table"), F.col("cdc_ts_ms").alias("ts_ms"),
        (file if file is not None else F.lit("log.000001")).alias("file"),
        (pos if pos is not None else F.col("id")).alias("pos"))
    body = F.struct(
        F.when(gone, image).otherwise(old).alias("before"), F.when(~gone, image).alias("after"), source.alias("source"),
        F.col("cdc_op").alias("op"), F.col("cdc_ts_ms").alias("ts_ms"))
    return log.select(F.to_json(body).alias("value"))


def order_envelopes(log: DataFrame) -> DataFrame:
    return to_envelopes(log, "orders", ORDERS)


def item_envelopes(log: DataFrame) -> DataFrame:
    return to_envelopes(log, "order_items", ORDER_ITEMS, pos=F.col("product_id"))


def snapshot_envelopes(rows: DataFrame, table: str, schema: T.StructType, read_ts_ms: Column) -> DataFrame:
    """A table as ``r`` (snapshot read) events, one per row."""
    log = rows.withColumn("cdc_op", F.lit("r")).withColumn("cdc_ts_ms", read_ts_ms)
    return to_envelopes(log, table, schema)
