"""From envelope text to typed rows, with an output for the bad ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import coerce
from tidemark.schemas import ITEM_REQUIRED, ORDER_ITEMS, ORDER_REQUIRED, ORDERS

_NUMERIC = (T.LongType, T.IntegerType, T.TimestampType)


def _texts(schema: T.StructType) -> T.StructType:
    """The image with every field as text."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema])


def _numbers(schema: T.StructType) -> T.StructType:
    """The numeric fields of the image as JSON numbers; JSON text reads as NULL."""
    image = T.StructType([T.StructField(f.name, T.DoubleType()) for f in schema if isinstance(f.dataType, _NUMERIC)])
    source = T.StructType([T.StructField("pos", T.DoubleType())])
    return T.StructType([T.StructField("before", image), T.StructField("after", image),
                         T.StructField("source", source), T.StructField("ts_ms", T.DoubleType())])


def _envelope(schema: T.StructType) -> T.StructType:
    source = T.StructType([T.StructField(n, T.StringType()) for n in ("db", "table", "ts_ms", "file", "pos")])
    return T.StructType([T.StructField("before", _texts(schema)), T.StructField("after", _texts(schema)),
                         T.StructField("source", source), T.StructField("op", T.StringType()),
                         T.StructField("ts_ms", T.StringType())])


def _opened(events: DataFrame, schema: T.StructType) -> DataFrame:
    """Parse each text once.

    The parse sits in a generator, which the optimizer does not move filters
    through: as a plain column it would be parsed again for every filter on it.
    """
    return events.select(*events.columns, F.inline(F.array(F.from_json("value", _envelope(schema)))))


def _pick(before, after) -> Column:
    """``before`` for a delete, ``after`` for anything else, a missing code included."""
    return F.when(F.col("op").eqNullSafe("d"), before).otherwise(after)


def _has_image(schema: T.StructType) -> Column:
    """The image is an object with at least one field, known or not."""
    known = F.coalesce(*[F.col("_image")[f.name] for f in schema]).isNotNull()
    raw = _pick(F.get_json_object("value", "$.before"), F.get_json_object("value", "$.after"))
    return known | (F.col("_image").isNotNull() & F.coalesce(raw.rlike(r'^\{\s*"'), F.lit(False)))


def _imaged(events: DataFrame, schema: T.StructType) -> DataFrame:
    return _opened(events, schema).withColumn("_image", _pick(F.col("before"), F.col("after")))


def _typed(field: T.StructField, numbers: Column) -> Column:
    text = F.col("_image")[field.name]
    number = _pick(numbers["before"][field.name], numbers["after"][field.name]) \
        if isinstance(field.dataType, _NUMERIC) else None
    if isinstance(field.dataType, T.LongType):
        out = coerce.to_long(text, number)
    elif isinstance(field.dataType, T.IntegerType):
        out = coerce.to_int(text, number)
    elif isinstance(field.dataType, T.DecimalType):
        out = coerce.to_decimal(text, field.dataType.precision, field.dataType.scale)
    elif isinstance(field.dataType, T.TimestampType):
        out = coerce.to_instant(text, number)
    else:
        out = text
    return out.alias(field.name)


def _reason(schema: T.StructType) -> Column:
    """Why an event gives no row; NULL if it gives one."""
    not_json = F.when(F.get_json_object("value", "$").isNull(), "not json").otherwise("no image")
    return F.when(~F.coalesce(_has_image(schema), F.lit(False)), not_json)


def _columns(schema: T.StructType, keep: Sequence[str]) -> list[Column]:
    numbers = F.from_json("value", _numbers(schema))
    # One number that grows through all files of the source log: their names end in a count, a file holds less than 4 GiB.
    file = F.coalesce(F.regexp_extract("source.file", r"([0-9]+)$", 1).try_cast("bigint"), F.lit(0))
    pos = coerce.to_long(F.col("source.pos"), numbers["source"]["pos"])
    known = {"source_file": F.col("source.file").alias("source_file"),
             "source_pos": pos.alias("source_pos"), "source_place": (F.shiftleft(file, 32) + pos).alias("source_place")}
    if "order_id" in schema.names:
        known["former_order_id"] = coerce.to_long(F.col("before.order_id"), numbers["before"]["order_id"]).alias("former_order_id")
    return [*[_typed(f, numbers) for f in schema], F.col("op").alias("cdc_op"),
            coerce.to_long(F.col("ts_ms"), numbers["ts_ms"]).alias("cdc_ts_ms"),
            *[known[k] if k in known else F.col(k) for k in keep]]


def typed_rows(events: DataFrame, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """Typed log rows of every event that has an image.

    ``keep`` names further columns: of ``events``, ``source_file``/``source_pos``, ``source_place`` (the position over
    all files), or ``former_order_id``, the order an item belonged to before the change.
    """
    return _imaged(events, schema).filter(_has_image(schema)).select(*_columns(schema, keep))


def all_rows(events: DataFrame, schema: T.StructType, required: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """:func:`typed_rows` and the events that give none, in one pass.

    ``reason`` says why a row may not enter the log: ``not json``, ``no image``, or ``missing`` and the
    required columns it lacks; NULL for the others. ``event`` is the text of an event without an image.
    """
    rows = _imaged(events, schema).withColumn("_reason", _reason(schema))
    rows = rows.select(*_columns(schema, keep), "_reason", F.when(F.col("_reason").isNotNull(), F.col("value")).alias("event"))
    lacking = F.concat_ws(" ", F.lit("missing"), *[F.when(F.col(name).isNull(), F.lit(name)) for name in required])
    return rows.withColumn("reason", F.coalesce("_reason", F.when(~complete(required), lacking))).drop("_reason")


def order_rows(events: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return typed_rows(events, ORDERS, keep)


def item_rows(events: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return typed_rows(events, ORDER_ITEMS, keep)


def bad_events(events: DataFrame, schema: T.StructType) -> DataFrame:
    """Events that give no row, with the reason."""
    return _imaged(events, schema).withColumn("reason", _reason(schema)).filter("reason IS NOT NULL").select("value", "reason")


def complete(required: Sequence[str]) -> Column:
    """All required columns present."""
    keep = F.lit(True)
    for name in required:
        keep = keep & F.col(name).isNotNull()
    return keep


def split_incomplete(rows: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows fit for the log, rows for quarantine)."""
    return rows.filter(complete(required)), rows.filter(~complete(required))


def orders_split(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    return split_incomplete(rows, ORDER_REQUIRED)


def items_split(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    return split_incomplete(rows, ITEM_REQUIRED)
