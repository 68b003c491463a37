"""Rollups kept by the stream equal those recomputed from current rows."""

import json
import random

import pytest

from tidemark.operators import parsing, routing, versions
from tidemark.plans import rollups
from tidemark.schemas import TIE
from tidemark.sources import readers
from tidemark.streaming import jobs, kept

STATUSES = ("PENDING", "PROCESSING", "COMPLETED", "CANCELLED")


def event(table, image, op, ts, before=None):
    return json.dumps({"before": image if op == "d" else before, "after": None if op == "d" else image, "op": op, "ts_ms": ts,
                       "source": {"table": table, "pos": ts}})


def history(seed):
    """Changes of orders and items: updates, deletes, moves to other orders and back, repeats and late versions."""
    r = random.Random(seed)
    texts, items, ts = [], {}, 0
    for _ in range(260):
        ts += 1
        if r.random() < 0.35:
            image = {"id": r.randint(1, 12), "user_id": r.randint(1, 4), "status": r.choice(STATUSES), "total_amount": f"{r.randint(1, 99)}.50",
                     "created_at": 1736467200000 + 86_400_000 * r.randint(0, 2)}
            texts.append(event("orders", image, r.choice("cuuud"), ts))
        else:
            i = r.randint(1, 25)
            image = {"id": i, "order_id": r.randint(1, 12) if r.random() < 0.3 or i not in items else items[i]["order_id"],
                     "product_id": r.randint(1, 4), "product_name": r.choice(["b", "a", "c"]), "quantity": r.randint(1, 5), "price": "2.25",
                     "subtotal": f"{r.randint(1, 50)}.10", "created_at": 1736467200000 + 3_600_000 * r.randint(0, 30)}
            op = r.choice("uuuud") if i in items and image["order_id"] == items[i]["order_id"] else "u"
            texts.append(event("order_items", image, op, ts, before=items.get(i)))
            items[i] = image
    late = texts[:]
    r.shuffle(late)
    return texts[:120], texts[120:200] + late[:40], late[40:120], texts[200:], texts[:60]


def same(got, want):
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("fold_every", [100, 2])
def test_kept_rollups_equal_recompute(spark, tmp_path, fold_every):
    base, topics = str(tmp_path / "base"), tmp_path / "topics" / "changes"
    topics.mkdir(parents=True)
    parts, seen = history(fold_every), []
    for n, part in enumerate(parts):  # a restart before every part
        (topics / f".{n}").write_text("\n".join(part) + "\n")
        (topics / f".{n}").rename(topics / f"{n}.txt")
        seen += part
        kept.keep(readers.change_stream(spark, "changes", path=str(tmp_path / "topics")), base, every=None, fold_every=fold_every).awaitTermination()
    events = spark.createDataFrame([(t,) for t in seen], "value string")
    orders = versions.latest(parsing.order_rows(routing.route(events, "orders"), keep=[TIE.name]), ties=[TIE.name])
    items = versions.latest(parsing.item_rows(routing.route(events, "order_items"), keep=[TIE.name]), ties=[TIE.name])
    same(kept.product_daily(spark, base), rollups.product_daily(items, orders))
    same(kept.customer_segments(spark, base), rollups.customer_segments(orders, items))
    same(kept.cart_analytics(spark, base), rollups.cart_analytics(orders))
    state = rollups.hourly_partials(items, orders)
    same(rollups.hourly_sales(kept.hourly_state(spark, base)), rollups.hourly_sales(state))
    same(rollups.hourly_sales_view(kept.hourly_state(spark, base)), rollups.hourly_sales_view(state))


def test_a_batch_that_runs_again_counts_once(spark, tmp_path):
    rows = spark.createDataFrame([("order", 1, 5, None, None, None, None, 1, 2, 150, 0, 0, 1, 0)], kept.SIGNED)
    base = str(tmp_path)
    path = kept._run_path(base, kept.writers.run_of(spark, f"{base}/checkpoints/kept"))
    for batch in (0, 0, 1, 2, 2, 3):
        kept.partials(rows).write.mode("overwrite").partitionBy("kind").parquet(f"{path}/level=0/batch_id={batch}")
        if batch >= 1:
            kept.fold(spark, path, batch)
        assert kept.cart_analytics(spark, base).first().total_orders == batch + 1
    # The first attempt of batch 2 folded and was lost; what it needs is still there.
    assert kept._last_fold(spark, path, 3) == 2 and kept._last_fold(spark, path) == 3


def test_bad_events_are_kept_with_their_reason_and_counted(spark, tmp_path):
    base, topic = str(tmp_path / "base"), tmp_path / "topics" / "orders-cdc"
    topic.mkdir(parents=True)
    good = event("orders", {"id": 1, "user_id": 1, "status": "PENDING", "total_amount": "1.00", "created_at": 1736467200000}, "c", 10)
    lacking = event("orders", {"id": 2, "status": "PENDING"}, "c", 11)
    (topic / "1.txt").write_text("\n".join([good, "not json", "not json either", '{"op":"c","after":{}}', lacking, good]) + "\n")
    lag = jobs.Lag()
    spark.streams.addListener(lag)
    try:
        query = jobs.sync(readers.change_stream(spark, "orders-cdc", path=str(tmp_path / "topics")), "orders", base, every=None, state_partitions=2)
        query.awaitTermination()
        rejected = sorted((r.reason, r.event, r.id) for r in jobs.rejected_events(spark, base, "orders").collect())
        assert rejected == [("missing user_id", None, 2), ("no image", '{"op":"c","after":{}}', None), ("not json", "not json", None),
                            ("not json", "not json either", None)]
        assert [r.id for r in jobs.current_rows(spark, base, "orders").collect()] == [1]
        counted = next(p for p in jobs.progress(query) if p["rows"])
        assert (counted["events"], counted["bad"], counted["incomplete"], counted["newest_change_ms"]) == (6, 3, 1, 11)
        for _ in range(50):
            if lag.seen:
                break
            __import__("time").sleep(0.2)
        assert lag.seen[0]["events"] == 6 and lag.seen[0]["lag_ms"] > 1_000_000
    finally:
        spark.streams.removeListener(lag)


def test_an_empty_topic_drains(spark, tmp_path):
    (tmp_path / "topics" / "orders-cdc").mkdir(parents=True)
    stream = readers.change_stream(spark, "orders-cdc", path=str(tmp_path / "topics"))
    jobs.drain(jobs.sync(stream, "orders", str(tmp_path / "base"), every="1 second", mode="all"), limit_s=60)


def test_a_run_id_whose_first_write_was_cut_off(spark, tmp_path):
    (tmp_path / "cp" / "run").mkdir(parents=True)
    run = kept.writers.run_of(spark, str(tmp_path / "cp"))
    assert run and kept.writers.run_of(spark, str(tmp_path / "cp")) == run


def test_kept_rollups_hold_versions_in_files_that_fold(spark, tmp_path):
    base, topics = str(tmp_path / "base"), tmp_path / "topics" / "changes"
    topics.mkdir(parents=True)
    (topics / "1.txt").write_text("\n".join(history(1)[0]) + "\n")
    kept.keep(readers.change_stream(spark, "changes", path=str(tmp_path / "topics")), base, every=None, fold_every=1).awaitTermination()
    assert not (tmp_path / "base" / "checkpoints" / "kept" / "state").exists()
    path = f"{base}/kept-orders/run={kept.writers.run_of(spark, f'{base}/checkpoints/kept')}"
    before = sorted(map(str, kept.held_rows(spark, path, 0, 1).collect()))
    assert before and len({(r.order_id, r.item_id) for r in kept.held_rows(spark, path, 0, 1).collect()}) == len(before)
    kept.fold_held(spark, path, 0)  # the batch runs again
    assert sorted(map(str, kept.held_rows(spark, path, 0, 1).collect())) == before


def test_signed_rows_are_those_of_the_stateful_step(spark):
    held = {}
    rows = [(7, None, 5, 1, 3, "PENDING", 10, None, None, None, None, 150, None, False), (7, 1, 5, 1, None, None, None, 7200, 4, "b", 2, 300, 150, False),
            (7, 2, 5, 1, None, None, None, 3600, 4, "a", None, None, None, False), (7, 3, 5, 1, None, None, None, None, 5, None, 1, 1, 1, False)]
    late = [(7, None, 6, None, 3, "COMPLETED", 10, None, None, None, None, 150, None, False), (7, 1, 5, 1, None, None, None, 0, 9, "z", 9, 9, 9, False),
            (7, 2, 6, 1, None, None, None, 3600, 4, "a", None, None, None, True)]
    for row in rows:
        held[row[1]] = row[1:]
    before = kept.added(7, held)
    for row in late:
        if kept.newer(row[1:], held.get(row[1])):
            held[row[1]] = row[1:]
    want = kept.Counter()
    for sign, side in ((-1, before), (1, kept.added(7, held))):
        want.update({(sign, *r): n for r, n in side.items()})
    frame = spark.createDataFrame([(*r, 0) for r in rows] + [(*r, 1) for r in late], kept.T.StructType([*kept.CHANGE, kept.T.StructField("batch_id", kept.T.LongType())]))
    got = kept.Counter((1 if r.refs > 0 else -1, *r[:7], *map(abs, r[7:])) for r in kept.signed_rows(frame, 1).collect())
    assert got == want


def test_a_name_spelled_by_escapes_is_routed(texts):
    events = texts('{"source":{"table":"\\u006frders"}}', '{"source":{"table":"orders"}}', '{"source":{"table":"order_items"}}', "orders", None)
    assert routing.route(events, "orders").count() == 2
