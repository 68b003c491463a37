"""Golden values of the seed rows, and reports against brute force."""

import random
from collections import defaultdict
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.plans import baskets, quality, reports, rollups, service
from tidemark.schemas import ORDER_ITEMS_LOG, ORDERS_LOG

AT = datetime(2025, 1, 10)


def test_status_totals(seed_orders):
    got = {r.status: (r.order_count, int(r.total_revenue), r.all_orders, int(r.all_revenue))
           for r in reports.status_statistics(seed_orders).collect()}
    assert got == {"COMPLETED": (4, 2576500, 10, 6319500), "PROCESSING": (3, 3224000, 10, 6319500),
                   "PENDING": (2, 467000, 10, 6319500), "CANCELLED": (1, 52000, 10, 6319500)}


def test_order_totals_that_do_not_match(seed_orders, seed_items):
    bad = quality.order_total_mismatch(seed_orders, seed_items).collect()
    assert sorted((r.order_id, int(r.total_amount), int(r.calculated_total)) for r in bad) == [
        (1, 1799000, 1599000), (2, 2190000, 1890000)]


@pytest.mark.parametrize("fan_out, spent, completed", [(True, 6099000, 6), (False, 2033000, 2)])
def test_customer_segments_with_and_without_fan_out(seed_orders, seed_items, fan_out, spent, completed):
    row = rollups.customer_segments(seed_orders, seed_items, fan_out).filter("user_id = 101").head()
    assert (row.total_spent_cents, row.completed_orders, row.total_orders, row.total_items) == (spent * 100, completed, 2, 6)


def test_product_daily_totals(seed_orders, seed_items):
    total = rollups.product_daily(seed_items, seed_orders).agg(
        F.count("*").alias("n"), F.sum("total_quantity").alias("q"), F.sum("total_revenue").alias("r")).head()
    assert (total.n, total.q, int(total.r)) == (19, 20, 5767500)


def test_weighting_equals_the_joined_rows(spark, seed_orders, seed_items):
    joined = seed_orders.join(seed_items.select(F.col("order_id").alias("id"), "quantity"), "id", "left")
    want = joined.groupBy("user_id").agg(F.sum("total_amount").alias("s")).collect()
    got = reports.customer_metrics(seed_orders, seed_items, fan_out=True).collect()
    assert {r.user_id: r.total_spent for r in got} == {r.user_id: r.s for r in want}


def _brute_pairs(items, min_orders, k):
    orders, total, n = defaultdict(set), defaultdict(Decimal), defaultdict(int)
    by_order = defaultdict(list)
    for item in items:
        by_order[item[1]].append(item)
    for order, lines in by_order.items():
        for a in lines:
            for b in lines:
                if a[0] < b[0] and a[7] >= datetime(2025, 1, 1):
                    pair = a[3], b[3]
                    orders[pair].add(order)
                    total[pair] += a[6] + b[6]
                    n[pair] += 1
    good = sorted(((-len(o), p) for p, o in orders.items() if len(o) >= min_orders))[:k]
    return [(p[0], p[1], -c, round(float(total[p]) / n[p], 3)) for c, p in good]


@pytest.mark.parametrize("limit", [2, 5, 8, 1000])
def test_bought_together_matches_brute_force(spark, limit):
    """One order holds a third of all items; every limit gives the same pairs."""
    rng = random.Random(limit)
    items = []
    for n in range(1, 421):
        order = 1 if n % 3 == 0 else rng.randint(2, 40)
        name = f"p{rng.randint(1, 9)}"
        created = datetime(2025, 1, rng.randint(1, 28)) if rng.random() < 0.8 else datetime(2024, 1, 1)
        items.append((n, order, 1, name, 1, Decimal(1), Decimal(rng.randint(1, 99)), created, created, None, "c", 1))
    frame = spark.createDataFrame(items, ORDER_ITEMS_LOG)
    got = baskets.bought_together(frame, "2025-01-31 00:00:00", days=30, min_orders=3, k=6, basket_limit=limit, id_range=50)
    rows = [(r.product_a, r.product_b, r.co_purchase_count, round(r.avg_bundle_revenue, 3)) for r in got.collect()]
    want = _brute_pairs(items, 3, 6)
    assert [r[:3] for r in rows] == [w[:3] for w in want]
    assert all(abs(r[3] - w[3]) < 0.01 for r, w in zip(rows, want))


def test_illegal_transitions(spark):
    log = spark.createDataFrame([
        (1, "PENDING", 1, 1), (1, "PROCESSING", 2, 1), (1, "COMPLETED", 3, 1), (1, "CANCELLED", 4, 1),
        (2, "PENDING", 1, 1), (2, "COMPLETED", 2, 1), (3, "CANCELLED", 1, 1), (3, "CANCELLED", 2, 1),
        (4, "PENDING", 1, 1), (4, "PROCESSING", 1, 2), (4, "CANCELLED", 2, 1)],
        "id long, status string, cdc_ts_ms long, source_pos long")
    illegal = quality.illegal_transitions(log, width_ms=2)
    assert sorted((r.id, r.from_status, r.to_status) for r in illegal.collect()) == [
        (1, "COMPLETED", "CANCELLED"), (2, "PENDING", "COMPLETED")]
    assert [r.id for r in quality.refused_cancellations(illegal).collect()] == [1]


def test_field_faults(spark):
    items = spark.createDataFrame([
        (1, 1, 0, "n", 1, Decimal(1), Decimal(1), AT, AT, None, "c", 1), (2, 1, 1, "", 1, Decimal(1), Decimal(1), AT, AT, None, "c", 1),
        (3, 1, 1, "n", 0, Decimal(1), Decimal(1), AT, AT, None, "c", 1), (4, 1, 1, "n", 1, Decimal(0), Decimal(1), AT, AT, None, "c", 1),
        (5, 1, 1, "n", 1, Decimal(1), Decimal(1), AT, AT, None, "c", 1)], ORDER_ITEMS_LOG)
    assert [r.id for r in quality.item_faults(items).orderBy("id").collect()] == [1, 2, 3, 4]
    orders = spark.createDataFrame([(1, 1, "PENDING", Decimal(1), AT, AT, None, "c", 1), (2, -1, "LOST", Decimal(1), AT, AT, None, "c", 1)], ORDERS_LOG)
    assert sorted(r.fault for r in quality.order_faults(orders, items).collect()) == ["no items", "user_id not positive"]
    assert [r.id for r in quality.status_faults(orders, ["PENDING"]).collect()] == [2]
    products = spark.createDataFrame([(1, "", "c", 1, 1), (2, "n", "x" * 51, 1, 1), (3, "n", None, -1, 1), (4, "n", None, 1, -1), (5, "n", "c", 0, 0)],
                                     "id long, name string, category string, price int, stock int")
    assert quality.product_faults(products).count() == 4


def test_row_reconciliation(spark):
    source = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id long, v string")
    target = spark.createDataFrame([(1, "a", "c"), (2, "x", "c"), (4, "d", "c"), (3, "c", "d")], "id long, v string, cdc_op string")
    got = {r.id: r.issue for r in quality.row_reconciliation(source, target, ["v"]).collect()}
    assert got == {2: "different", 3: "missing", 4: "surplus"}
    assert quality.count_reconciliation(source, target).head().verdict == "consistent"


def test_categories_without_name(spark):
    products = spark.createDataFrame([("a", 1), (None, 2), ("", 3)], "category string, stock int")
    got = sorted((r.category, r.product_count, r.total_stock) for r in reports.category_counts(products).collect())
    assert got == [("Uncategorized", 1, 2), ("Uncategorized", 1, 3), ("a", 1, 1)]


def test_pages_and_nested_items(seed_orders, seed_items):
    page = service.order_page(seed_orders, seed_items, page=2, limit=4).collect()
    assert sorted(r.id for r in page) == [3, 4, 5, 6]
    assert {(r.total, r.page, r["limit"], r.total_pages) for r in page} == {(10, 2, 4, 3)}
    assert {r.id: [i.product_id for i in r["items"]] for r in page}[5] == [5001, 5002, 5003]
    mine = service.user_orders(seed_orders, seed_items, user_id=101).collect()
    assert sorted(r.id for r in mine) == [1, 7]


def test_big_orders_nest_in_parts(spark, seed_orders, seed_items):
    parts = service.nested_items(seed_orders.select("id"), seed_items, chunk=1).collect()
    seen = defaultdict(list)
    for r in parts:
        seen[r.id] += [i.id for i in r["items"]]
    assert sorted(i for ids in seen.values() for i in ids) == list(range(1, 21))
    assert len([r for r in parts if r.id == 1]) > 1


def test_deleting_users(spark, seed_orders):
    users = spark.createDataFrame([(101, "a"), (500, "b")], "id long, username string")
    assert [r.id for r in quality.deletable_users(users, seed_orders).collect()] == [500]
    assert [(r.id, r.order_count) for r in quality.blocked_users(users, seed_orders).collect()] == [(101, 2)]


def test_soft_deletes_stay_in_rollups_unless_asked(spark, seed_orders, seed_items):
    gone = seed_orders.withColumn("deleted_at", F.when(F.col("id") == 4, F.current_timestamp()))
    assert rollups.cart_analytics(gone).head().total_orders == 10
    assert rollups.cart_analytics(gone, exclude_soft_deleted=True).head().total_orders == 9


def test_refresh_of_touched_keys_equals_recompute(spark, seed_orders, seed_items):
    cancelled = seed_orders.withColumn("status", F.when(F.col("id") == 5, "CANCELLED").otherwise(F.col("status")))
    old = rollups.product_daily(seed_items, seed_orders)
    stale = old.filter("product_id = 1001").select("sale_date", "product_id")
    got = rollups.apply_refresh(old, seed_items, cancelled, seed_orders.filter("id = 5"), stale)
    want = rollups.product_daily(seed_items, cancelled)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_an_order_of_three_thousand_names_is_never_paired(spark, monkeypatch):
    """Fewer pairs than asked for: the big order is looked up for pairs of the small ones, and not paired itself."""
    sizes = {}
    stage = baskets.staged

    def counting(rows, label):
        out = stage(rows, label)
        sizes[label] = sizes.get(label, 0) + out.count()
        return out

    monkeypatch.setattr(baskets, "staged", counting)
    at = datetime(2025, 1, 20)
    lines = [(1, f"p{n}") for n in range(3000)]
    lines += [(2 + 2 * n + m, f"p{n}") for n in range(3000) for m in range(2)]
    lines += [(order, name) for order in (9001, 9002) for name in ("p7", "p8", "p9")]
    frame = spark.createDataFrame([(i, order, 1, name, 1, Decimal(1), Decimal(2), at, at, None, "c", 1) for i, (order, name) in enumerate(lines)], ORDER_ITEMS_LOG)
    for pairs in (baskets.bought_together, baskets.bought_together_unordered):
        got = {(r.product_a, r.product_b, r.co_purchase_count) for r in pairs(frame, "2025-01-31 00:00:00").collect()}
        assert got == {("p7", "p8", 3), ("p7", "p9", 3), ("p8", "p9", 3)}
    assert sizes["basket-pairs"] < 100
