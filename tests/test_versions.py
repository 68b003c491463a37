"""Versions, compaction, retention and the order operators."""

import random
from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from tidemark.operators import dedup, ordered, partials, versions
from tidemark.schemas import ORDERS_LOG


def order(i, ts, op="u", status="PENDING", created=datetime(2025, 1, 10), deleted=None):
    return (i, 1, status, Decimal(1), created, created, deleted, op, ts)


def test_latest_and_ties(spark):
    log = spark.createDataFrame([(1, 10, "a", 1), (1, 20, "b", 2), (2, 5, "c", 3), (1, 10, "a", 1), (1, 99, "d", 4),
                                 (3, 99, "e", 5), (3, 99, "f", 9)], "id long, cdc_ts_ms long, v string, pos long")
    got = {(r.id, r.cdc_ts_ms, r.v) for r in versions.latest(log, ties=["pos"]).collect()}
    assert got == {(1, 99, "d"), (2, 5, "c"), (3, 99, "f")}
    first = {(r.id, r.v) for r in versions.earliest(log, ties=["pos"]).collect()}
    assert first == {(1, "a"), (2, "c"), (3, "e")}
    assert versions.distinct_versions(log).count() == 5


def test_latest_ignores_arrival_order(spark):
    rows = [(k, v, f"{k}-{v}") for k in range(20) for v in range(15)]
    random.Random(3).shuffle(rows)
    log = spark.createDataFrame(rows + rows[:50], "id long, cdc_ts_ms long, v string")
    assert {(r.id, r.v) for r in versions.latest(log).collect()} == {(k, f"{k}-14") for k in range(20)}


def test_views_and_policies(spark):
    gone = datetime(2025, 1, 11)
    rows = spark.createDataFrame([order(1, 1), order(2, 1, op="d"), order(3, 1, deleted=gone), order(4, 1, op=None)], ORDERS_LOG)
    assert sorted(r.id for r in versions.active(rows).collect()) == [1, 4]
    assert [versions.with_deleted(rows, p).count() for p in ("exclude", "include", "only")] == [3, 4, 1]


def test_restore_and_purge(spark):
    old, recent = datetime(2025, 1, 1), datetime(2025, 9, 1)
    rows = spark.createDataFrame([order(1, 5, deleted=old), order(2, 5, deleted=recent), order(3, 5),
                                  order(4, 5, op="d", deleted=old)], ORDERS_LOG)
    kept = versions.purge_soft_deleted(rows, "2025-10-01 00:00:00", 6)
    assert sorted(r.id for r in kept.collect()) == [2, 3]
    after = versions.merge_changes(rows, versions.restore_versions(rows, "2025-10-01 00:00:00"))
    assert sorted((r.id, r.deleted_at is None) for r in after.collect()) == [(1, True), (2, True), (3, True), (4, False)]


def test_compaction_months_and_retention(spark, tmp_path):
    jan, mar = datetime(2025, 1, 10), datetime(2025, 3, 10)
    log = spark.createDataFrame([order(1, 1, created=jan), order(1, 2, created=mar), order(2, 1, created=jan)], ORDERS_LOG)
    path, out = str(tmp_path / "log"), str(tmp_path / "current")
    versions.write_by_month(log, path)
    versions.compact(spark, path, out)
    assert sorted((r.id, r.yyyymm) for r in versions.read_snapshot(spark, out).collect()) == [(1, 202503), (2, 202501)]
    versions.compact(spark, path, out, keep_months=1, as_of="2025-04-01")
    current = versions.read_snapshot(spark, out)
    assert [r.id for r in current.collect()] == [1]
    expired = versions.expired_months(versions.latest(log), "2025-04-01", 1).collect()
    assert [(r.yyyymm, r.row_count) for r in expired] == [(202501, 1)]
    march = versions.read_months(spark, path, "2025-03-01", "2025-03-31")
    assert [r.id for r in march.collect()] == [1]
    assert "PartitionFilters: [isnotnull(yyyymm" in march._jdf.queryExecution().toString()


def test_signed_totals(spark):
    pairs = spark.createDataFrame([("a", 1, Decimal(5)), ("a", -1, Decimal(5)), ("b", 1, Decimal(2))], "k string, sign int, m decimal(10,2)")
    assert [tuple(r) for r in versions.signed_totals(pairs, ["k"], ["m"]).collect()] == [("b", 1, Decimal("2.00"))]


def test_previous_value_and_running_sums_match_brute_force(spark):
    rng = random.Random(5)
    rows = [(k, t, rng.randint(-9, 9)) for k in (1, 2, 3) for t in rng.sample(range(-500, 500), 120 if k == 1 else 15)]
    frame = spark.createDataFrame(rows, "k long, t long, v long")
    want_lag, want_sum, want_before = {}, {}, {}
    for k in (1, 2, 3):
        total, last = 0, None
        for _, t, v in sorted(r for r in rows if r[0] == k):
            want_lag[k, t], want_before[k, t] = last, total
            total, last = total + v, v
            want_sum[k, t] = total
    for width in (1, 7, 100, 10_000):
        lagged = ordered.previous_value(frame, ["k"], "t", "v", width)
        assert {(r.k, r.t): r.previous for r in lagged.collect()} == want_lag
        sums = ordered.running_sums(frame, ["k"], "t", {"v": "total"}, width)
        assert {(r.k, r.t): r.total for r in sums.collect()} == want_sum
        before = ordered.running_sums(frame, ["k"], "t", {"v": "total"}, width, include_current=False)
        assert {(r.k, r.t): r.total for r in before.collect()} == want_before


def test_first_seen_matches_a_sequential_run(spark):
    rng = random.Random(11)
    rows = [("hot" if rng.random() < 0.7 else f"k{rng.randint(1, 5)}", rng.randint(0, 60_000), n) for n in range(3000)]
    want, last = set(), {}
    for key, t, n in sorted(rows, key=lambda r: (r[1], r[2])):
        if key not in last or t >= last[key] + 500:
            last[key] = t
            want.add((key, t, n))
    frame = spark.createDataFrame(rows, "k string, t long, n long")
    for width in (500, 1300, 100_000):
        got = {tuple(r) for r in dedup.first_seen(frame, "k", "t", "n", ttl_ms=500, range_ms=width).collect()}
        assert got == want


def test_mergeable_states(spark):
    rows = spark.createDataFrame([(b, k, v) for b in range(3) for k in (1, 2) for v in range(b, b + 40 * k)], "b int, k int, v long")
    exact = {r.k: r.n for r in rows.groupBy("k").agg(F.count_distinct("v").alias("n")).collect()}
    by_rows = partials.merge_distinct_rows(partials.distinct_rows(rows, ["b", "k"], "v").drop("b"), ["k"], "v", "n")
    by_bits = partials.merge_distinct_bitmaps(partials.distinct_bitmaps(rows, ["b", "k"], "v").drop("b"), ["k"], "n")
    by_sketch = partials.merge_distinct_sketches(partials.distinct_sketches(rows, ["b", "k"], "v").drop("b"), ["k"], "n")
    for merged in (by_rows, by_bits, by_sketch):
        assert {r.k: r.n for r in merged.collect()} == exact
    sums = partials.merge_sum_states(partials.sum_states(rows, ["b", "k"], "v").drop("b"), ["k"])
    assert {r.k: r.n for r in sums.collect()} == {1: 120, 2: 240}
