"""Routing, parsing and coercion of change events."""

import json
from datetime import datetime
from decimal import Decimal

import pytest

from tidemark.operators import parsing, routing
from tidemark.schemas import ORDER_ITEMS, ORDERS
from tidemark.sources import envelopes, readers


def event(table="orders", op="c", after=None, before=None, **more):
    return json.dumps({"before": before, "after": after, "op": op, "ts_ms": 5,
                       "source": {"db": "shop", "table": table, "file": "f.1", "pos": 9}, **more})


def kept(frame):
    return [r.value for r in frame.collect()]


def test_router_keeps_own_table_only(texts):
    mine, other = event("orders"), event("order_items")
    events = texts(mine, other)
    assert kept(routing.route(events, "orders")) == [mine]
    assert kept(routing.route(events, "order_items")) == [other]


@pytest.mark.parametrize("text", ['{"op":"c"}', '{"op":"c","source":{"db":"shop"}}', "not a json", "", "[1]"])
def test_router_drops_malformed(texts, text):
    for table in ("orders", "order_items"):
        assert kept(routing.route(texts(text), table)) == []
        assert kept(routing.route(texts(text), table, "c")) == []


def test_router_keeps_all_codes_and_op_router_one(texts):
    events = [event(op=op) for op in "cudr"]
    assert kept(routing.route(texts(*events), "orders")) == events
    for n, op in enumerate("cudr"):
        assert kept(routing.route(texts(*events), "orders", op)) == [events[n]]
    no_op = json.dumps({"source": {"table": "orders"}})
    assert kept(routing.route(texts(no_op), "orders")) == [no_op]
    assert kept(routing.route(texts(no_op), "orders", "c")) == []


def test_router_is_not_fooled_by_text(texts):
    fake = json.dumps({"after": {"note": '"table":"orders"'}, "source": {"table": "users"}})
    assert kept(routing.route(texts(fake), "orders")) == []


def test_fan_out_and_tags(texts):
    events = texts(event("orders"), event("order_items"), event("users"))
    branches = routing.fan_out(events, ["orders", "order_items"])
    assert {t: b.count() for t, b in branches.items()} == {"orders": 1, "order_items": 1}
    assert sorted(r.table for r in routing.tagged(events, ["orders", "order_items"]).collect()) == ["order_items", "orders"]


def test_image_choice(texts):
    rows = parsing.order_rows(texts(
        event(op="d", before={"id": 1}), event(op="c", after={"id": 2}), event(op=None, after={"id": 3}),
        event(op="x", after={"id": 4}, before={"id": 40}), event(op="c", after={}), event(op="c"),
        event(op="d", after={"id": 5}), event(op="c", after="text"), "not a json", '{"after":{"id":6}}')).collect()
    assert sorted((r.id, r.cdc_op) for r in rows if r.cdc_op) == [(1, "d"), (2, "c"), (4, "x")]
    assert sorted(r.id for r in rows if r.cdc_op is None) == [3, 6]


def test_image_of_unknown_fields_goes_to_quarantine(texts):
    rows = parsing.order_rows(texts(event(after={"colour": "red"}), event(after={"id": None}),
                                    event(after={"id": 1, "user_id": 2})))
    good, bad = parsing.orders_split(rows)
    assert [r.id for r in good.collect()] == [1]
    assert bad.count() == 2


def test_bad_events_with_reason(texts):
    bad = parsing.bad_events(texts("not a json", event(after={}), event(after={"id": 1})), ORDERS).collect()
    assert sorted(r.reason for r in bad) == ["no image", "not json"]


@pytest.mark.parametrize("value, want", [
    ("7", 7), (7, 7), (7.9, 7), ("7.9", None), (" 7 ", None), (None, None), ("abc", None), ("-3", -3), ("+3", 3),
    (True, None), ("", None), (-7.9, -7), (7e2, 700), ("7e2", None), ("99999999999999999999", None)])
def test_long(texts, value, want):
    assert parsing.order_rows(texts(event(after={"id": value, "status": "x"}))).head().id == want


@pytest.mark.parametrize("value, want", [("2", 2), (2, 2), (2.9, 2), ("2.9", None), (3_000_000_000, None), ("x", None)])
def test_int(texts, value, want):
    rows = parsing.item_rows(texts(event("order_items", after={"quantity": value, "product_name": "n"})))
    assert rows.head().quantity == want


@pytest.mark.parametrize("value, want", [
    ("12.30", "12.30"), (12.3, "12.30"), ("abc", None), (None, None), (5, "5.00"), ("1e2", "100.00"), ("12.345", "12.35"),
    ("123456789.00", None), (True, None), (" 1 ", None)])
def test_decimal(texts, value, want):
    got = parsing.order_rows(texts(event(after={"total_amount": value, "status": "x"}))).head().total_amount
    assert got == (None if want is None else Decimal(want))


@pytest.mark.parametrize("value, want", [
    ("2024-11-14T05:30:00Z", datetime(2024, 11, 14, 5, 30)), (1699999999999, datetime(2023, 11, 14, 22, 13, 19, 999000)),
    ("1699999999999", datetime(2023, 11, 14, 22, 13, 19, 999000)), ("2024-11-14 05:30:00", None),
    ("2024-11-14T05:30:00", None), ("2024-11-14T05:30:00+09:00", None), (None, None), ("soon", None)])
def test_instant(texts, value, want):
    assert parsing.order_rows(texts(event(after={"created_at": value, "status": "x"}))).head().created_at == want


def test_text_and_version(texts):
    row = parsing.order_rows(texts(event(after={"status": 5}, ts_ms="77")), keep=["source_file", "source_pos"]).head()
    assert (row.status, row.cdc_ts_ms, row.source_file, row.source_pos) == ("5", 77, "f.1", 9)


def test_round_trip(seed_items):
    back = parsing.item_rows(envelopes.item_envelopes(seed_items))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, seed_items.collect()))


def test_start_positions(texts):
    def at(ts, file, pos):
        return json.dumps({"ts_ms": ts, "source": {"table": "orders", "file": file, "pos": pos}})
    events = texts(at(1, "f.1", 5), at(2, "f.1", 10), at(3, "f.2", 1), "not a json")
    assert readers.start_at_timestamp(events, 2).count() == 2
    assert readers.start_at_offset(events, "f.1", 10).count() == 2
    assert readers.start_at_offset(events, "f.2", 2).count() == 0


def test_snapshot_events_carry_read_code(seed_orders):
    from pyspark.sql import functions as F
    source = seed_orders.drop("cdc_op", "cdc_ts_ms")
    snapshot = envelopes.snapshot_envelopes(source, "orders", ORDERS, F.lit(7).cast("bigint"))
    rows = parsing.order_rows(readers.snapshot_and_changes(snapshot, envelopes.order_envelopes(seed_orders)))
    assert sorted((r.cdc_op, r["count"]) for r in rows.groupBy("cdc_op").count().collect()) == [("c", 10), ("r", 10)]


def test_source_options():
    jdbc = readers.jdbc_options("jdbc:x", "orders", 1, 900, 16)
    assert (jdbc["partitionColumn"], jdbc["numPartitions"]) == ("id", "16")
    assert readers.kafka_options("b:1", "orders-cdc")["startingOffsets"] == "latest"
    assert readers.kafka_options("b:1", "t", "earliest", 500)["maxOffsetsPerTrigger"] == "500"
    assert readers.kafka_options("b:1", "t", start_ts_ms=9)["startingTimestamp"] == "9"


def test_both_models_share_the_contract():
    assert {"id", "created_at", "deleted_at"} <= set(ORDERS.names) & set(ORDER_ITEMS.names)
