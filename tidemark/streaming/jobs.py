"""The running jobs: capture (changes to topics) and sync (topics to the change log)."""

from __future__ import annotations

import time
from collections import deque
from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidemark.functions import calendar as cal
from tidemark.operators import parsing, routing, versions
from tidemark.operators.staging import staged
from tidemark.operators.versions import latest
from tidemark.plans import rollups
from tidemark.schemas import ITEM_REQUIRED, ORDER_ITEMS, ORDER_ITEMS_LOG, ORDER_REQUIRED, ORDERS, ORDERS_LOG, TIE
from tidemark.session import STATE_STORE, settings
from tidemark.sources import readers, writers
from tidemark.streaming import dedup

MODEL = {
    "orders": (ORDERS, T.StructType(list(ORDERS_LOG) + [TIE]), ORDER_REQUIRED),
    "order_items": (ORDER_ITEMS, T.StructType(list(ORDER_ITEMS_LOG) + [TIE]), ITEM_REQUIRED),
}


def trigger(every: str | None) -> dict:
    """``None`` works off what is there and stops; otherwise an interval."""
    return {"availableNow": True} if every is None else {"processingTime": every}


def capture(events: DataFrame, checkpoint: str, path: str | None = None, servers: str | None = None,
            every: str | None = "30 seconds", keyed: bool = True, one_topic: str | None = None,
            partitions: int | None = None, **options: str) -> StreamingQuery:
    """Route a stream of change events to the topics of their tables, or all to ``one_topic``, whose readers route them."""
    tagged = routing.tagged(events, list(writers.TOPICS))
    rows = writers.topic_rows(tagged, one_topic=one_topic, key=writers.event_key() if keyed else None)
    return writers.publish(rows, checkpoint, path, servers, partitions, **options).trigger(**trigger(every)).start()


def sync(events: DataFrame, table: str, base: str, every: str | None = "profile", mode: str = "versions",
         ttl_ms: int = dedup.FIRST_SEEN_TTL_MS, after: Callable[[DataFrame, int], None] | None = None,
         state_partitions: int | None = None, profile: writers.SinkProfile = writers.STANDARD) -> StreamingQuery:
    """Parse a topic and append its rows to the change log below ``base``.

    ``every`` is a trigger interval, None to work off what is there, or by default that of the ``profile``.

    ``mode``: ``versions`` drops repeated (id, version) pairs, ``first_seen`` keeps
    the first row of an id per period, ``all`` keeps everything. State and progress
    live in the checkpoint, from which a restart goes on. Events are parsed once: those
    that give no row, and rows that lack a column, go to the rejected side of the log
    (not in ``first_seen``, which knows ids only), see :func:`rejected_events`.
    Every batch counts them, see :func:`progress`.
    """
    schema, log_schema, required = MODEL[table]
    if mode not in ("first_seen", "versions", "all"):
        raise ValueError(f"unknown mode: {mode}")
    checkpoint, log_path = f"{base}/checkpoints/{table}-{mode}", f"{base}/{table}"
    run = writers.run_of(events.sparkSession, checkpoint)
    sink = writers.log_sink(log_path, required, after, run)
    stored = mode == "first_seen" and writers.exists(events.sparkSession, f"{checkpoint}/state")
    if stored:  # begun with a state store
        rows = dedup.first_seen(parsing.typed_rows(events, schema, keep=[TIE.name]), log_schema, ttl_ms)
    elif mode == "first_seen":
        rows = dedup.timed(parsing.typed_rows(events, schema, keep=[TIE.name]), log_schema)
        sink = dedup.first_seen_sink(sink, lambda batch_id: writers.batch_folder(log_path, run, batch_id), f"{checkpoint}/seen", ttl_ms)
    else:
        rows = observed(parsing.all_rows(events, schema, required, keep=[TIE.name, "ingest_ts"]))
        rows = (dedup.drop_repeats(rows) if mode == "versions" else rows).drop("ingest_ts")
    return _start(rows.writeStream.foreachBatch(sink).outputMode("append")
                  .option("checkpointLocation", checkpoint)
                  .trigger(**trigger(profile.trigger if every == "profile" else every)), events.sparkSession, state_partitions,
                  STATE_STORE if stored else None)


def keep_current(base: str, table: str, ties: Sequence[str] = (TIE.name,)) -> Callable[[DataFrame, int], None]:
    """For ``after`` of :func:`sync`: a table of current rows by month below ``base/current``, of which each batch rewrites
    the months it touches. The batch may run again."""
    path = f"{base}/current/{table}"

    def after(batch: DataFrame, batch_id: int) -> None:
        rows = batch.drop("yyyymm")
        if rows.isEmpty():
            return
        if not writers.exists(batch.sparkSession, f"{path}/_SUCCESS"):
            versions.write_by_month(latest(rows, ties=ties), path)
        else:
            versions.compact_changes(batch.sparkSession, path, rows, ties=ties)
    return after


ARRIVALS = "arrivals"


def observed(rows: DataFrame) -> DataFrame:
    """Count what a batch brings as it passes: events, those without a row, incomplete ones, the newest change, the longest delay."""
    return rows.observe(
        ARRIVALS, F.count("*").alias("events"), F.count("event").alias("bad"), (F.count("reason") - F.count("event")).alias("incomplete"),
        F.max("cdc_ts_ms").alias("newest_change_ms"), F.max(dedup.delay_ms()).alias("longest_delay_ms"))


def rejected_events(spark: SparkSession, base: str, table: str) -> DataFrame:
    """Rows and events that a running sync set aside, with the reason."""
    return writers.read_rejected(spark, f"{base}/{table}", MODEL[table][1])


def _start(writer, spark: SparkSession, state_partitions: int | None, conf: dict[str, str] | None = None) -> StreamingQuery:
    """Start with a number of state partitions of its own: it is fixed by the first
    run of a checkpoint and should follow the size of the state."""
    own = {} if state_partitions is None else {"spark.sql.shuffle.partitions": str(state_partitions)}
    with settings(spark, own | (conf or {})):
        return writer.start()


def drain(query: StreamingQuery, poll_s: float = 0.5, limit_s: float | None = None) -> None:
    """Stop an interval query once a micro-batch found nothing new to read.

    For runs with processing-time state, which never count as finished. If ``limit_s`` is
    given and passes first, the query is stopped and TimeoutError raised: what it wrote is
    then a part only.
    """
    end = None if limit_s is None else time.time() + limit_s
    started = False
    try:
        while query.isActive:
            if end is not None and time.time() >= end:
                raise TimeoutError(f"the query had more to read after {limit_s} s")
            last = query.lastProgress
            if last is not None and last["numInputRows"] > 0:
                started = True
            elif (started or (last is not None and (last["batchId"] > 0 or "addBatch" not in last["durationMs"]))) \
                    and not query.status["isTriggerActive"]:
                return  # nothing new, or a trigger that found nothing to make a first batch of
            time.sleep(poll_s)
    finally:
        query.stop()
        if query.exception() is not None:
            raise query.exception()


def run_with_restarts(start: Callable[[], StreamingQuery], attempts: int = 3, pause_s: float = 10.0) -> StreamingQuery:
    """Wait for a query to end; on failure start it again from its checkpoint."""
    for attempt in range(attempts + 1):
        query = start()
        try:
            query.awaitTermination()
            return query
        except Exception:
            if attempt == attempts:
                raise
            time.sleep(pause_s)
    raise AssertionError("unreachable")


def current_rows(spark: SparkSession, base: str, table: str) -> DataFrame:
    """The newest version per id from the change log."""
    log = writers.read_log(spark, f"{base}/{table}", MODEL[table][1])
    return latest(log, ties=[TIE.name]).drop("yyyymm", TIE.name)


def replay(spark: SparkSession, path: str, table: str, from_ms: int, until_ms: int) -> DataFrame:
    """Current rows of a time range of a topic, read again from its beginning."""
    events = readers.event_files(spark, path, writers.TOPICS[table])
    schema, _, required = MODEL[table]
    rows = parsing.typed_rows(readers.start_at_timestamp(events, from_ms), schema, keep=[TIE.name])
    wanted = rows.filter(parsing.complete(required) & (F.col("cdc_ts_ms") < until_ms))
    return latest(wanted, ties=[TIE.name]).drop(TIE.name)


def refresh_product_daily(spark: SparkSession, base: str, changed_items: DataFrame, changed_orders: DataFrame,
                          rollup_path: str) -> None:
    """Bring the daily product rollup up to date after a batch of changes.

    A change touches the month an item lies in, the months its earlier versions lay
    in, and for an order the months of its items. Those months are recomputed from
    current rows and replaced as a whole, so running it twice does no harm.
    """
    items_log = writers.read_log(spark, f"{base}/order_items", ORDER_ITEMS_LOG)
    ids = changed_items.select("id").distinct()
    order_ids = (changed_orders.select(F.col("id").alias("order_id")).distinct())
    touched = (items_log.join(ids, "id", "left_semi").select("yyyymm")
               .unionAll(items_log.join(order_ids, "order_id", "left_semi").select("yyyymm"))
               .distinct())
    months = [r[0] for r in touched.collect()]  # one value per calendar month
    items = current_rows(spark, base, "order_items")
    orders = current_rows(spark, base, "orders")
    in_touched = versions.in_months(months, "_month")
    touched_items = items.withColumn("_month", cal.yyyymm(F.col("created_at"))).filter(in_touched).drop("_month")
    daily = staged(rollups.product_daily(touched_items, orders).withColumn("yyyymm", cal.yyyymm(F.col("sale_date"))), "refreshed")
    daily.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("yyyymm").parquet(rollup_path)
    left = {r[0] for r in daily.select("yyyymm").distinct().collect()}  # one value per calendar month
    for emptied in set(months) - left:  # an overwrite by month can't clear a month without rows
        versions.remove_folder(spark, versions.month_folder(rollup_path, emptied))


def progress(query: StreamingQuery) -> list[dict]:
    """Rows, rates, duration, backlog and what was counted of the recent micro-batches."""
    out = []
    for p in query.recentProgress:
        behind = [s["metrics"].get("maxOffsetsBehindLatest") for s in p["sources"] if s.get("metrics")]
        out.append({"batch_id": p["batchId"], "rows": p["numInputRows"],
                    "rows_per_second": p.get("processedRowsPerSecond"),
                    "duration_ms": p["durationMs"].get("triggerExecution"),
                    "backlog": max((int(b) for b in behind if b is not None), default=None),
                    **_counted(p["observedMetrics"].get(ARRIVALS))})
    return out


def _counted(metrics: Row | None) -> dict:
    return {} if metrics is None else metrics.asDict()


class Lag(StreamingQueryListener):
    """How far each micro-batch of the queries of a session is behind the changes, as it happens.

    ``seen`` gets (query, batch, events, newest change, its age at the end of the batch in milliseconds).
    Register with ``spark.streams.addListener``; ``limit`` bounds what is kept, ``warn`` is told of a lag of
    more than ``warn_ms``.
    """

    def __init__(self, limit: int = 1000, warn_ms: int | None = None, warn: Callable[[dict], None] | None = None):
        self.seen: deque[dict] = deque(maxlen=limit)
        self.warn_ms, self.warn = warn_ms, warn

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        found = p.observedMetrics.get(ARRIVALS)
        if found is None or not found["events"]:
            return
        ended = datetime.fromisoformat(p.timestamp.replace("Z", "+00:00")).timestamp() * 1000 + p.durationMs["triggerExecution"]
        newest = found["newest_change_ms"]
        row = {"query": str(p.runId), "batch_id": p.batchId, "events": found["events"], "newest_change_ms": newest,
               "lag_ms": None if newest is None else int(ended - newest)}
        self.seen.append(row)
        if self.warn is not None and row["lag_ms"] is not None and row["lag_ms"] > self.warn_ms:
            self.warn(row)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass
