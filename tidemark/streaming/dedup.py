"""Deduplication of a running stream of typed rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.versions import earliest, remove_folder
from tidemark.schemas import TIE
from tidemark.session import FREED, adaptive, settings
from tidemark.sources import writers

FIRST_SEEN_TTL_MS = 600_000
AT = "_batch_ms"  # when a micro-batch was begun: the same if it runs again


def drop_repeats(rows: DataFrame, ingest: str = "ingest_ts", delay: str = "10 minutes") -> DataFrame:
    """Drop repeats of one change, (id, version, place in the source log), that arrive within ``delay``.

    The watermark runs on arrival time. On the time of the change it would drop
    late versions, which must reach the log. An event that gave no row is known by its text.
    """
    more = [c for c in (TIE.name, "event") if c in rows.columns]
    return rows.withWatermark(ingest, delay).dropDuplicatesWithinWatermark(["id", "cdc_ts_ms", *more])


def first_seen(rows: DataFrame, schema: T.StructType, ttl_ms: int = FIRST_SEEN_TTL_MS) -> DataFrame:
    """Pass the first row of an id; hold back the others for ``ttl_ms`` of run time. State in a store, row by row in Python:
    only checkpoints that were begun with it go on with it, :func:`first_seen_sink` holds to the same rule.

    The period starts when a row passes and is not extended by rows held back. Of rows that
    arrive in one micro-batch the one of the lowest version passes. Updates and deletes within
    the period are lost: this operator is offered for the behaviour itself, :func:`drop_repeats`
    is the standard one. That one's state on the JVM can't hold a period of run time: it ends
    with the watermark, which in a quiet stream stands still for as long as nothing arrives.
    """
    from pyspark.sql.streaming.stateful_processor import StatefulProcessor

    class FirstSeen(StatefulProcessor):
        def init(self, handle):
            self.seen = handle.getValueState("seen", "flag boolean", ttl_ms)

        def handleInputRows(self, key, rows, timerValues):
            if not self.seen.exists():  # rows of an id stream by; one of them is held
                self.seen.update((True,))
                yield min(rows, key=lambda r: (r.cdc_ts_ms is None, r.cdc_ts_ms))

        def close(self):
            pass

    return rows.select(*schema.names).groupBy("id").transformWithState(
        FirstSeen(), outputStructType=schema, outputMode="append", timeMode="processingTime")


def timed(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows with the time of their micro-batch, for :func:`first_seen_sink`."""
    return rows.select(*schema.names, F.unix_millis(F.current_timestamp()).alias(AT))


def first_seen_sink(sink: Callable[[DataFrame, int], None], written: Callable[[int], str], place: str,
                    ttl_ms: int = FIRST_SEEN_TTL_MS) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: ``sink`` gets the rows of :func:`timed` that pass, by the rule of :func:`first_seen`.

    The ids that ``sink`` wrote for a batch, to the folder ``written`` names, are kept below ``place`` under the number
    and the time of the batch for as long as they hold others back. A batch reads those of the batches before it: a
    batch that runs again passes the same ids. Nothing but DataFrame steps; no clock but that of the batches.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with settings(spark, adaptive(spark) | FREED):
            begun = batch.select(AT).first()
            rows = earliest(batch.drop(AT))
            if begun is not None and writers.exists(spark, place):
                seen = (spark.read.schema(T.StructType([batch.schema["id"], T.StructField("batch_id", T.LongType()), T.StructField("passed_ms", T.LongType())]))
                        .option("basePath", place).parquet(place).filter((F.col("batch_id") < batch_id) & (F.col("passed_ms") > begun[0] - ttl_ms)))
                rows = rows.join(seen.select(F.col("id").alias("_seen")).distinct(), F.col("id").eqNullSafe(F.col("_seen")), "left_anti")
            sink(rows, batch_id)
            if begun is None:
                return
            passed = spark.read.schema(T.StructType([batch.schema["id"]])).parquet(written(batch_id))
            (passed.withColumn("passed_ms", F.lit(begun[0]).cast("long")).write.mode("overwrite").partitionBy("passed_ms")
             .parquet(f"{place}/batch_id={batch_id}"))
            _forget(spark, place, begun[0] - ttl_ms)
    return write


def _forget(spark, place: str, until_ms: int) -> None:
    """Remove ids that passed no later than ``until_ms``."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{place}/batch_id=*/passed_ms=*")
    for found in pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or ():
        if int(found.getPath().getName().partition("=")[2]) <= until_ms:
            remove_folder(spark, found.getPath().getParent().toString())


def delay_ms(ingest: str = "ingest_ts") -> Column:
    """Arrival time minus time of the change, in milliseconds."""
    return F.unix_millis(F.col(ingest)) - F.col("cdc_ts_ms")
