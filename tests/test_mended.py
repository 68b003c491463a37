"""Cases the sample tables don't hold: restarts with other settings, ties, surplus, several faults, future rows."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.test_streaming import drop_file, log_rows, text
from tidemark.functions import calendar as cal
from tidemark.operators import versions
from tidemark.plans import quality
from tidemark.schemas import ORDERS_LOG
from tidemark.sources import readers, writers
from tidemark.streaming import jobs


def sync(spark, tmp_path, mode="versions"):
    stream = readers.change_stream(spark, "orders-cdc", path=str(tmp_path / "topics"))
    jobs.sync(stream, "orders", str(tmp_path / "base"), every=None, mode=mode, state_partitions=2).awaitTermination()


def test_log_keeps_earlier_runs_after_a_mode_switch(spark, tmp_path):
    topic = tmp_path / "topics" / "orders-cdc"
    drop_file(topic, "1.txt", [text(1, 10, "c")])
    sync(spark, tmp_path, "versions")
    (topic / "1.txt").unlink()
    drop_file(topic, "2.txt", [text(2, 20, "c")])
    sync(spark, tmp_path, "all")
    assert log_rows(spark, str(tmp_path / "base")) == [(1, 10, "c"), (2, 20, "c")]


def test_later_change_of_one_millisecond_wins(spark, tmp_path):
    def change(status, pos):
        event = json.loads(text(1, 10, "c"))
        event["after"]["status"], event["source"]["pos"] = status, pos
        return json.dumps(event)
    drop_file(tmp_path / "topics" / "orders-cdc", "1.txt", [change("PENDING", 100), change("PROCESSING", 200), change("PENDING", 100)])
    sync(spark, tmp_path)
    assert len(log_rows(spark, str(tmp_path / "base"))) == 2
    assert [r.status for r in jobs.current_rows(spark, str(tmp_path / "base"), "orders").collect()] == ["PROCESSING"]


def test_compaction_of_a_stream_log_leaves_rejected_rows_out(spark, tmp_path):
    bad = json.loads(text(2, 10, "c"))
    del bad["after"]["user_id"]
    drop_file(tmp_path / "topics" / "orders-cdc", "1.txt", [text(1, 10, "c"), text(1, 20, "u"), json.dumps(bad)])
    sync(spark, tmp_path)
    base, out = str(tmp_path / "base"), str(tmp_path / "snapshots")
    assert writers.read_log(spark, f"{base}/orders", ORDERS_LOG, rejected=True).count() == 1
    versions.compact(spark, f"{base}/orders", out)
    assert [(r.id, r.cdc_ts_ms) for r in versions.read_snapshot(spark, out).collect()] == [(1, 20)]


def test_an_expired_drain_raises(spark, tmp_path):
    query = spark.readStream.format("rate").load().writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c")).start()
    with pytest.raises(TimeoutError):
        jobs.drain(query, poll_s=0.1, limit_s=0.5)
    assert not query.isActive


def test_surplus_and_shifted_null(spark):
    few, many = (spark.range(n).select("id", F.lit("c").alias("cdc_op"), F.lit(None).cast("timestamp").alias("deleted_at")) for n in (3, 1000))
    assert quality.count_reconciliation(few, many).first().verdict == "severe"
    kind = "id long, a string, b string, cdc_op string, deleted_at timestamp"
    source, target = (spark.createDataFrame([(1, *v, "c", None)], kind) for v in (("x", None), (None, "x")))
    assert [tuple(r) for r in quality.row_reconciliation(source, target, ["a", "b"]).collect()] == [(1, "different")]


def test_every_fault_of_an_item(spark):
    item = spark.createDataFrame([(1, 0, "", 0, 0.0)], "id long, product_id long, product_name string, quantity int, price double")
    assert sorted(r.fault for r in quality.item_faults(item).collect()) == [
        "price not positive", "product_id not positive", "product_name empty", "quantity below 1"]


def test_reports_end_at_their_reference_time(spark):
    rows = spark.createDataFrame([(datetime(2025, 1, d),) for d in (1, 8, 11)], "ts timestamp")
    assert [r.ts.day for r in rows.filter(cal.since(F.col("ts"), "2025-01-10 00:00:00", "7 DAY")).collect()] == [8]
    assert [r.ts.day for r in rows.filter(cal.days_back(F.to_date("ts"), "2025-01-10", 7)).collect()] == [8]


def test_log_files_count_by_number(spark):
    events = spark.createDataFrame([(json.dumps({"source": {"file": f, "pos": 5}}),) for f in ("log.999999", "log.1000000", "log.1000001")], "value string")
    assert readers.start_at_offset(events, "log.1000000", 5).count() == 2
