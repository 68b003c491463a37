"""The capture and sync jobs on files, with restarts, repeats and late versions."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.versions import latest
from tidemark.schemas import ORDERS_LOG
from tidemark.sources import envelopes, readers, writers
from tidemark.streaming import jobs


def text(i, ts, op):
    image = {"id": i, "user_id": 1, "status": "PENDING", "total_amount": "1.00", "created_at": 1736467200000}
    return json.dumps({"before": image if op == "d" else None, "after": None if op == "d" else image, "op": op, "ts_ms": ts,
                       "source": {"table": "orders", "pos": ts}})


def drop_file(folder, name, lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f".{name}").write_text("\n".join(lines) + "\n")
    (folder / f".{name}").rename(folder / name)


def log_rows(spark, base):
    return sorted((r.id, r.cdc_ts_ms, r.cdc_op) for r in writers.read_log(spark, f"{base}/orders", ORDERS_LOG).collect())


FIRST = [text(1, 10, "c"), text(1, 20, "u"), text(2, 5, "c"), text(1, 10, "c")]
SECOND = [text(1, 99, "d"), text(3, 99, "c")]


def test_sync_drops_repeats_and_goes_on_after_a_restart(spark, tmp_path):
    base, topic = str(tmp_path / "base"), tmp_path / "topics" / "orders-cdc"

    def run():
        stream = readers.change_stream(spark, "orders-cdc", path=str(tmp_path / "topics"))
        jobs.sync(stream, "orders", base, every=None, state_partitions=2).awaitTermination()

    drop_file(topic, "1.txt", FIRST)
    run()
    assert log_rows(spark, base) == [(1, 10, "c"), (1, 20, "u"), (2, 5, "c")]
    drop_file(topic, "2.txt", SECOND + ["not a json"])
    run()
    assert log_rows(spark, base) == [(1, 10, "c"), (1, 20, "u"), (1, 99, "d"), (2, 5, "c"), (3, 99, "c")]
    current = {(r.id, r.cdc_ts_ms, r.cdc_op) for r in jobs.current_rows(spark, base, "orders").collect()}
    assert current == {(1, 99, "d"), (2, 5, "c"), (3, 99, "c")}


def test_late_versions_reach_the_log(spark, tmp_path):
    base, topic = str(tmp_path / "base"), tmp_path / "topics" / "orders-cdc"
    for n, (i, ts) in enumerate([(1, 7_200_000), (2, 7_300_000), (3, 0), (1, 7_200_000)]):
        drop_file(topic, f"{n}.txt", [text(i, ts, "c")])
    stream = readers.change_stream(spark, "orders-cdc", path=str(tmp_path / "topics"), max_files_per_trigger=1)
    query = jobs.sync(stream, "orders", base, every=None, state_partitions=2)
    query.awaitTermination()
    assert log_rows(spark, base) == [(1, 7_200_000, "c"), (2, 7_300_000, "c"), (3, 0, "c")]
    assert sum(p["rows"] for p in jobs.progress(query)) == 4


def test_first_seen_across_a_restart(spark, tmp_path):
    base, topic = str(tmp_path / "base"), tmp_path / "topics" / "orders-cdc"

    def run():
        stream = readers.change_stream(spark, "orders-cdc", path=str(tmp_path / "topics"))
        jobs.drain(jobs.sync(stream, "orders", base, every="3 seconds", mode="first_seen", state_partitions=2))

    drop_file(topic, "1.txt", FIRST)
    run()
    assert log_rows(spark, base) == [(1, 10, "c"), (2, 5, "c")]
    drop_file(topic, "2.txt", SECOND)
    run()
    assert log_rows(spark, base) == [(1, 10, "c"), (2, 5, "c"), (3, 99, "c")]


def test_incomplete_rows_are_set_aside(spark, tmp_path):
    base, topic = str(tmp_path / "base"), tmp_path / "topics" / "orders-cdc"
    drop_file(topic, "1.txt", [text(1, 10, "c"), text("x", 11, "c"), text(None, 12, "c")])
    stream = readers.change_stream(spark, "orders-cdc", path=str(tmp_path / "topics"))
    jobs.sync(stream, "orders", base, every=None, mode="all").awaitTermination()
    assert log_rows(spark, base) == [(1, 10, "c")]
    assert writers.read_log(spark, f"{base}/orders", ORDERS_LOG, rejected=True).count() == 2


def test_a_batch_that_runs_again_leaves_the_same_rows(spark, tmp_path, seed_orders):
    path = str(tmp_path / "log")
    for _ in range(2):
        writers.append_log(seed_orders, 0, path, ["id"])
    assert writers.read_log(spark, path, ORDERS_LOG).count() == 10


def test_stream_equals_batch_for_shuffled_and_repeated_events(spark, tmp_path):
    rng = random.Random(1)
    events = [text(i, rng.randint(1, 500), rng.choice("cu")) for i in range(30) for _ in range(6)]
    events += rng.sample(events, 60)
    rng.shuffle(events)
    base, folder = str(tmp_path / "base"), tmp_path / "in"
    for n in range(4):
        drop_file(folder / "changes", f"{n}.txt", events[n::4])
    changes = readers.change_stream(spark, "changes", path=str(folder))
    jobs.capture(changes, f"{base}/cp", path=f"{base}/topics", every=None).awaitTermination()
    topic = readers.change_stream(spark, "topic=orders-cdc", path=f"{base}/topics")
    jobs.sync(topic, "orders", base, every=None, state_partitions=2).awaitTermination()
    want = {}
    for e in map(json.loads, events):
        want[e["after"]["id"]] = max(want.get(e["after"]["id"], 0), e["ts_ms"])
    assert {r.id: r.cdc_ts_ms for r in jobs.current_rows(spark, base, "orders").collect()} == want


def test_rollup_refresh_equals_recompute(spark, tmp_path, seed_orders, seed_items):
    from tidemark.plans import rollups
    base, path = str(tmp_path / "base"), str(tmp_path / "rollup")
    writers.append_log(seed_orders, 0, f"{base}/orders", ["id"])
    writers.append_log(seed_items, 0, f"{base}/order_items", ["id"])
    writers.backfill(rollups.product_daily(seed_items, seed_orders), path, "sale_date")
    moved = (seed_items.filter("id = 1").withColumn("created_at", F.lit("2025-02-03").cast("timestamp"))
             .withColumn("cdc_ts_ms", F.lit(2000).cast("bigint")))
    cancelled = (seed_orders.filter("id = 5").withColumn("status", F.lit("CANCELLED"))
                 .withColumn("cdc_ts_ms", F.lit(2000).cast("bigint")))
    writers.append_log(moved, 1, f"{base}/order_items", ["id"])
    writers.append_log(cancelled, 1, f"{base}/orders", ["id"])
    jobs.refresh_product_daily(spark, base, moved, cancelled, path)
    want = rollups.product_daily(latest(seed_items.unionByName(moved)), latest(seed_orders.unionByName(cancelled)))
    got = spark.read.parquet(path).drop("yyyymm").select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_restarts_give_up_after_the_last_attempt():
    class Failing:
        def awaitTermination(self):
            raise RuntimeError("lost")
    starts = []
    with pytest.raises(RuntimeError):
        jobs.run_with_restarts(lambda: starts.append(1) or Failing(), attempts=3, pause_s=0)
    assert len(starts) == 4


def test_topic_rows(spark, seed_orders):
    from tidemark.operators import routing
    tagged = routing.tagged(envelopes.order_envelopes(seed_orders), writers.TOPICS)
    rows = writers.topic_rows(tagged, key=writers.event_key()).collect()
    assert {r.topic for r in rows} == {"orders-cdc"} and sorted(int(r.key) for r in rows) == list(range(1, 11))
    assert {r.topic for r in writers.topic_rows(tagged, one_topic="all-cdc").collect()} == {"all-cdc"}
    assert writers.STANDARD.batch_rows == 1000 and writers.FAST.batch_rows == 100


def test_first_seen_holds_ids_in_files_for_the_period(spark, tmp_path):
    from tidemark.streaming import dedup
    log, place = str(tmp_path / "log"), str(tmp_path / "seen")
    sink = dedup.first_seen_sink(writers.log_sink(log, ["id"], run="r"), lambda n: writers.batch_folder(log, "r", n), place, ttl_ms=100)

    def batch(n, at, *rows):
        frame = spark.createDataFrame([(i, ts, at) for i, ts in rows], "id long, cdc_ts_ms long, _batch_ms long")
        sink(frame.withColumn("created_at", F.lit(None).cast("timestamp")), n)
        return sorted((r.id or 0, r.cdc_ts_ms) for r in spark.read.parquet(f"{log}/run=r").filter(f"batch_id = {n}").collect())

    assert batch(0, 1000, (1, 9), (1, 7), (1, None), (2, 5), (None, 3)) == [(0, 3), (1, 7), (2, 5)]
    assert batch(1, 1050, (1, 1), (3, 4), (None, 1)) == [(3, 4)]
    assert batch(1, 1050, (1, 1), (3, 4), (None, 1)) == [(3, 4)]  # runs again
    assert batch(2, 1099, (2, 1), (3, 1)) == []
    assert batch(3, 1100, (1, 2), (3, 2)) == [(1, 2)]  # held back rows do not extend the period
    assert not (tmp_path / "seen" / "batch_id=0").exists() and (tmp_path / "seen" / "batch_id=1").exists()


def test_first_seen_needs_no_state_store(spark, tmp_path):
    base, topic = str(tmp_path / "base"), tmp_path / "topics" / "orders-cdc"
    drop_file(topic, "1.txt", FIRST)
    stream = readers.change_stream(spark, "orders-cdc", path=str(tmp_path / "topics"))
    jobs.drain(jobs.sync(stream, "orders", base, every="1 second", mode="first_seen", state_partitions=2))
    assert log_rows(spark, base) == [(1, 10, "c"), (2, 5, "c")]
    checkpoint = tmp_path / "base" / "checkpoints" / "orders-first_seen"
    assert not (checkpoint / "state").exists() and (checkpoint / "seen" / "batch_id=0").exists()
