"""Tables kept by month: reads, compaction and removal leave other months alone."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import versions
from tidemark.plans import quality, reports, service
from tidemark.sources import writers

AS_OF = "2025-06-20 00:00:00"


@pytest.fixture
def by_month(spark, tmp_path, seed_orders, seed_items):
    """Seed orders and items, one month apart by id, written by month."""
    at = F.expr("timestamp'2025-01-10 12:00:00' + make_interval(0, CAST(id % 6 AS INT))")
    out = []
    for name, rows in (("orders", seed_orders), ("items", seed_items)):
        versions.write_by_month(rows.withColumn("created_at", at), str(tmp_path / name))
        out.append(str(tmp_path / name))
    return out


def files(path):
    from pathlib import Path
    return {str(f): f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}


def test_reports_read_the_months_of_their_period(spark, by_month):
    orders, items = map(spark.read.parquet, by_month)
    daily = items.select(F.to_date("created_at").alias("sale_date"), "product_id", "product_name", "yyyymm",
                         F.col("quantity").alias("total_quantity"), F.col("subtotal").alias("total_revenue"), F.lit(1.0).alias("avg_price"))
    carts = orders.select(F.to_date("created_at").alias("order_date"), "yyyymm")
    for name, frame in {
        "Q07": reports.bestsellers_now(items, orders, AS_OF), "Q08": reports.kpi_orders(orders, AS_OF), "Q16": reports.cart_trend(carts, AS_OF),
        "Q20": reports.stock_projection(daily, AS_OF), "Q21": reports.weekly_growth(orders, AS_OF), "Q22": reports.revenue_forecast(orders, AS_OF),
        "Q23": reports.volume_decomposition(orders, AS_OF), "Q32": reports.daily_revenue_week(orders, AS_OF), "Q34": reports.product_report(daily, AS_OF),
    }.items():
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(yyyymm" in plan, name
    week = reports.daily_revenue_week(orders, AS_OF)
    assert week.select(F.sum("orders")).first()[0] is None
    assert reports.daily_revenue_week(orders, "2025-06-12 00:00:00").first().orders == 1


def test_compaction_rewrites_touched_months_only(spark, by_month):
    path = by_month[0]
    before = files(path)
    current = spark.read.parquet(path).drop("yyyymm").collect()
    orders = spark.createDataFrame(current, spark.read.parquet(path).drop("yyyymm").schema)
    moved = orders.filter("id = 1").withColumns({"created_at": F.lit("2025-04-02").cast("timestamp"), "cdc_ts_ms": F.lit(2000).cast("long")})
    stale = orders.filter("id = 9").withColumns({"status": F.lit("STALE"), "cdc_ts_ms": F.lit(1).cast("long")})
    undated = orders.filter("id = 3").withColumns({"created_at": F.lit(None).cast("timestamp"), "cdc_ts_ms": F.lit(2000).cast("long")})
    changes = moved.unionByName(stale).unionByName(undated)
    for _ in range(2):  # the same changes again do no harm
        touched = versions.compact_changes(spark, path, changes)
        assert set(touched) <= {None, 202502, 202504}
        want = versions.latest(orders.unionByName(changes))
        assert sorted(map(str, spark.read.parquet(path).drop("yyyymm").collect())) == sorted(map(str, want.collect()))
    after = files(path)
    assert all(after[f] == t for f, t in before.items() if "yyyymm=202502" not in f and "yyyymm=202504" not in f)
    # A month whose last row leaves is removed.
    all_of = orders.filter("id % 6 = 5").withColumns({"created_at": F.lit("2025-01-01").cast("timestamp"), "cdc_ts_ms": F.lit(3000).cast("long")})
    versions.compact_changes(spark, path, all_of)
    assert not any("yyyymm=202506" in f for f in files(path)) and spark.read.parquet(path).count() == 10


def test_expired_months_go_and_no_file_changes(spark, by_month, tmp_path, seed_orders):
    path = by_month[0]
    before = files(path)
    kept = versions.retain_months(spark.read.parquet(path), AS_OF, 2).count()
    assert versions.remove_expired_months(spark, path, AS_OF, 2) == 3
    assert spark.read.parquet(path).count() == kept
    assert all(before[f] == t for f, t in files(path).items())
    log = str(tmp_path / "log")
    writers.append_log(seed_orders, 0, log, ["id"])
    assert versions.remove_expired_months(spark, log, AS_OF, 2) == 1 and not files(log)


def test_pages_by_last_order_equal_pages_by_number(spark, seed_orders, seed_items):
    last = None
    for page in range(1, 5):
        want = service.order_page(seed_orders, seed_items, page=page, limit=3).select("id", "items").collect()
        one = service.order_page_after(seed_orders, seed_items, last, limit=3)
        assert sorted(map(str, one.select("id", "items").collect())) == sorted(map(str, want))
        end = one.orderBy("created_at", "id").first()
        last = (end.created_at, end.id)


def test_reconciliation_names_what_counts_hide(spark):
    rows = spark.createDataFrame([(1, "a", None, "c"), (2, "b", None, "d"), (3, None, "x", "c"), (4, "e", "e", "c")], "id long, p string, q string, cdc_op string")
    target = spark.createDataFrame([(1, "a", None, "c"), (1, "a", None, "c"), (2, "b", None, "d"), (3, "x", None, "c"), (5, "f", None, "c")], rows.schema)
    got = {tuple(r) for r in quality.row_differences(rows, target, ["p", "q"]).collect()}
    assert got == {(1, "duplicate", 1, 2), (3, "different", 1, 1), (4, "missing", 1, 0), (5, "surplus", 0, 1)}
    assert quality.row_reconciliation(rows, rows, ["p", "q"]).count() == 0
    live = quality.count_reconciliation(rows.filter("id < 3"), target.filter("id < 3")).first()
    assert (live.source_rows, live.target_rows, live.verdict) == (1, 2, "minor")
