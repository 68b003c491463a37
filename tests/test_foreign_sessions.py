"""Streams in a session that someone else built: without the library's state store, on workers without the library."""

import json
import subprocess
import sys

import pytest
from pyspark import cloudpickle

from tests.test_streaming import drop_file, log_rows, text
from tidemark.sources import readers
from tidemark.streaming import jobs, kept

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
DEFAULT = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"


@pytest.fixture
def foreign(spark):
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, DEFAULT)
    yield spark
    assert spark.conf.get(PROVIDER) == DEFAULT  # what the streams need is theirs alone
    spark.conf.set(PROVIDER, before)


def test_first_seen_brings_its_state_store(foreign, tmp_path):
    drop_file(tmp_path / "topics" / "orders-cdc", "1.txt", [text(1, 20, "u"), text(1, 10, "c"), text(2, 5, "c")])
    stream = readers.change_stream(foreign, "orders-cdc", path=str(tmp_path / "topics"))
    jobs.drain(jobs.sync(stream, "orders", str(tmp_path / "base"), every="1 second", mode="first_seen", state_partitions=2))
    assert log_rows(foreign, str(tmp_path / "base")) == [(1, 10, "c"), (2, 5, "c")]


def test_kept_rollups_bring_their_state_store(foreign, tmp_path):
    order = {"id": 1, "user_id": 7, "status": "COMPLETED", "total_amount": "2.50", "created_at": 1736467200000}
    events = [json.dumps({"before": None, "after": order | {"status": s}, "op": "u", "ts_ms": n, "source": {"table": "orders", "pos": n}})
              for n, s in enumerate(("PENDING", "COMPLETED"), 1)]
    drop_file(tmp_path / "topics" / "changes", "1.txt", events)
    stream = readers.change_stream(foreign, "changes", path=str(tmp_path / "topics"))
    kept.keep(stream, str(tmp_path / "base"), every=None).awaitTermination()
    row = kept.customer_segments(foreign, str(tmp_path / "base")).first()
    assert (row.user_id, row.total_orders, row.total_spent_cents, row.completed_orders) == (7, 1, 250, 1)


def test_the_stateful_step_loads_without_the_library(tmp_path):
    code = "import pickle, sys; print(type(pickle.load(sys.stdin.buffer)).__name__)"
    done = subprocess.run([sys.executable, "-c", code], input=cloudpickle.dumps(kept.KeptOrder()), cwd=tmp_path, env={}, capture_output=True)
    assert done.stdout.split() == [b"KeptOrder"], done.stderr
