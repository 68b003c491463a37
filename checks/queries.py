"""Every query of the library, run over the sample tables.

Each entry takes (spark, folder of the tables). Reports with a relative period use
the fixed ``as_of`` of the sample mapping.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import calendar as cal
from tidemark.functions.money import money_text, op_label, status_label, time_text
from tidemark.operators import dedup, partials, parsing, routing, versions
from tidemark.operators.staging import staged
from tidemark.plans import baskets, quality, reports, rollups, service
from tidemark.schemas import ORDER_ITEMS, ORDER_ITEMS_LOG, ORDER_STATUSES, ORDERS, ORDERS_LOG, TIE
from tidemark.session import adopt, fresh_path
from tidemark.sources import envelopes, readers, writers
from tidemark.sources import sample_tables as st
from tidemark.streaming import jobs, kept

AS_OF, EVENTS_AS_OF = st.AS_OF, st.EVENTS_AS_OF
QUERIES = {}


def query(fn):
    """Register a query; it runs with the adaptive settings of the library."""
    @functools.wraps(fn)
    def run(spark, root):
        return fn(adopt(spark), root)
    QUERIES[fn.__name__] = run
    return run


def both_events(spark, root) -> DataFrame:
    """Order and item changes as one stream of texts."""
    return (envelopes.order_envelopes(st.orders_log(spark, root))
            .unionAll(envelopes.item_envelopes(st.items_log(spark, root))))


# --- sources, routing, parsing ---------------------------------------------

@query
def s01_snapshot_then_changes(spark, root):
    log = st.orders_log(spark, root)
    snapshot = envelopes.snapshot_envelopes(log.drop("cdc_op", "cdc_ts_ms"), "orders", ORDERS,
                                            F.unix_millis("created_at") - 1)
    changes = envelopes.order_envelopes(log.filter(F.col("cdc_op") != "c"))
    rows = parsing.order_rows(readers.snapshot_and_changes(snapshot, changes))
    return versions.latest(rows).select("id", "status", "total_amount", "cdc_op", "cdc_ts_ms")


@query
def s02_orders_only_source(spark, root):
    rows = parsing.order_rows(routing.route(both_events(spark, root), "orders"))
    return quality.counts_by_op(rows)


@query
def s03_items_only_source(spark, root):
    rows = parsing.item_rows(routing.route(both_events(spark, root), "order_items"))
    return quality.counts_by_op(rows)


@query
def s04_start_at_timestamp(spark, root):
    events = readers.start_at_timestamp(both_events(spark, root), 946_684_800_000)
    return (events.groupBy(routing.event_table(F.col("value")).alias("table_name"))
            .agg(F.count("*").cast("bigint").alias("events")))


@query
def s04_start_at_offset(spark, root):
    orders = routing.route(both_events(spark, root), "orders")
    events = readers.start_at_offset(orders, "log.000001", 100)
    return parsing.order_rows(events).agg(F.count("*").cast("bigint").alias("events"),
                                          F.min("id").alias("first_id"))


@query
def p02_events_by_table_and_op(spark, root):
    """All routers side by side over one read of the events."""
    routers = [(t, op) for t in ("orders", "order_items") for op in ("c", "u", "d", "r")]
    counts = both_events(spark, root).agg(F.array(*[
        F.struct(F.lit(t).alias("table_name"), F.lit(op).alias("op"),
                 F.count_if(routing.belongs(t, op)).cast("bigint").alias("events")) for t, op in routers]).alias("r"))
    return counts.select(F.inline("r"))


@query
def p04_fan_out(spark, root):
    branches = routing.fan_out(both_events(spark, root), ["orders", "order_items"])
    return quality.labelled_counts(branches)


@query
def p07_order_rows(spark, root):
    good, _ = parsing.orders_split(parsing.order_rows(routing.route(both_events(spark, root), "orders")))
    return good


@query
def p08_item_rows(spark, root):
    good, _ = parsing.items_split(parsing.item_rows(routing.route(both_events(spark, root), "order_items")))
    return good


@query
def f01_coercions(spark, root):
    """Numbers and texts in all forms a field may take, one event per row."""
    at, value = F.col("ts").cast("timestamp"), F.col("value")
    millis = F.unix_millis(at)
    odd = F.col("event_id") % 2 == 1
    image = F.to_json(F.struct(
        F.col("event_id").cast("string").alias("id"), value.cast("string").alias("order_id"),
        value.alias("product_id"), F.col("event_type").alias("product_name"), value.alias("quantity"),
        value.cast("string").alias("price"), value.alias("subtotal"),
        millis.alias("created_at"), F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("updated_at"),
        F.date_format(at, "yyyy-MM-dd HH:mm:ss").alias("deleted_at")))
    # Every other event writes its id as a number and its time as digits in quotes.
    image = F.when(odd, F.regexp_replace(F.regexp_replace(
        image, '"id":"([0-9]+)"', '"id":$1'), '"created_at":([0-9]+)', '"created_at":"$1"')).otherwise(image)
    events = st.table(spark, root, "events").select(F.concat(
        F.lit('{"op":"c","after":'), image, F.lit(',"ts_ms":'), millis.cast("string"), F.lit("}")).alias("value"))
    return parsing.item_rows(events)


@query
def p10_op_labels(spark, root):
    return (st.orders_log(spark, root).groupBy(op_label(F.col("cdc_op")).alias("operation_type"))
            .agg(F.count("*").cast("bigint").alias("events")))


# --- versions and row views -------------------------------------------------

@query
def v01_current_orders(spark, root):
    return st.orders(spark, root)


@query
def v01_current_items(spark, root):
    return st.items(spark, root)


@query
def v02_merge_changes(spark, root):
    log = st.items_log(spark, root)
    cut = F.lit("2000-01-01").cast("timestamp")
    stored = versions.latest(log.filter(F.col("created_at") < cut), ties=("product_id",))
    return versions.merge_changes(stored, log.filter(F.col("created_at") >= cut), ties=("product_id",))


@query
def v02_compacted_snapshot(spark, root):
    """Log written by month, compacted to a snapshot, snapshot read back."""
    log_path, out = fresh_path(spark, "items-log"), fresh_path(spark, "items-current")
    versions.write_by_month(st.items_log(spark, root), log_path)
    versions.compact(spark, log_path, out, ties=("product_id",))
    return versions.read_snapshot(spark, out).drop("yyyymm")


@query
def v02_compacted_changes(spark, root):
    """Current rows by month, brought up to date with two rounds of changes: some rows move to another month, some come again."""
    path, log = fresh_path(spark, "items-by-month"), st.items_log(spark, root)
    key = F.col("id")
    first = log.withColumns({"created_at": F.when(key % 7 == 0, F.col("created_at") - F.expr("INTERVAL 90 DAY")).otherwise(F.col("created_at")),
                             "cdc_ts_ms": F.col("cdc_ts_ms") - 1})
    versions.write_by_month(versions.latest(first, ties=("product_id",)), path)
    versions.compact_changes(spark, path, log, ties=("product_id",))
    versions.compact_changes(spark, path, first.filter(key % 3 == 0), ties=("product_id",))
    return spark.read.parquet(path).drop("yyyymm")


@query
def v03_product_daily_all_versions(spark, root):
    return rollups.product_daily(st.items_log(spark, root), st.orders_log(spark, root))


@query
def v09_retained_months(spark, root):
    return versions.retain_months(st.orders(spark, root), AS_OF, 6).select("id", "created_at")


@query
def v09_expired_months(spark, root):
    return versions.expired_months(st.orders(spark, root), AS_OF, 6)


@query
def v09_removed_months(spark, root):
    """A written table without its expired months; no file of the others is touched."""
    path = fresh_path(spark, "orders-by-month")
    versions.write_by_month(st.orders(spark, root), path)
    versions.remove_expired_months(spark, path, AS_OF, 6)
    return spark.read.parquet(path).select("id", "created_at")


@query
def v10_purged_orders(spark, root):
    return versions.purge_soft_deleted(st.orders(spark, root), AS_OF, 6).select("id", "deleted_at")


@query
def v11_restored_orders(spark, root):
    current = st.orders(spark, root)
    return versions.merge_changes(current, versions.restore_versions(current, AS_OF)).select(
        "id", "deleted_at", "cdc_op", "cdc_ts_ms")


@query
def v12_signed_totals(spark, root):
    log = st.items_log(spark, root)
    current = versions.latest(log, ties=("product_id",))
    plus = current.select("product_id", "subtotal", F.lit(1).alias("sign"))
    minus = current.filter(~versions.not_deleted()).select("product_id", "subtotal", F.lit(-1).alias("sign"))
    return versions.signed_totals(plus.unionAll(minus), ["product_id"], ["subtotal"]).withColumn(
        "row_count", F.col("row_count").cast("bigint"))


@query
def p11_active_orders(spark, root):
    return versions.active(st.orders(spark, root))


@query
def p12_active_items(spark, root):
    return versions.active(st.items(spark, root))


@query
def p14_deleted_orders(spark, root):
    return reports.deleted_orders(st.orders(spark, root))


@query
def p15_active_order_list(spark, root):
    return reports.active_order_list(st.orders(spark, root))


@query
def p16_orders_by_status(spark, root):
    return service.order_list(st.orders(spark, root), status="PENDING").select("id", "user_id", "status")


@query
def p16_orders_of_user(spark, root):
    return service.order_list(st.orders(spark, root), user_id=42).select("id", "user_id", "status")


@query
def p17_products_by_category(spark, root):
    return service.product_list(st.products(spark, root), "ECONOMY")


@query
def p18_user_by_name(spark, root):
    return service.lookup(st.users(spark, root), "username", "Customer#000000042")


@query
def p18_user_by_email(spark, root):
    return service.lookup(st.users(spark, root), "email", "customer.000000042@shop.example")


@query
def p18_order_by_id(spark, root):
    return service.lookup(st.orders(spark, root), "id", 42).select("id", "user_id", "status", "total_amount")


@query
def p18_product_by_id(spark, root):
    return service.lookup(st.products(spark, root), "id", 42)


@query
def p20_deleted_policies(spark, root):
    current = st.orders(spark, root)
    return quality.labelled_counts({p: versions.with_deleted(current, p) for p in ("exclude", "include", "only")})


@query
def p21_priced_items(spark, root):
    return service.priced_items(st.items(spark, root)).select("id", "quantity", "price", "subtotal")


@query
def p21_order_totals(spark, root):
    return service.order_totals(st.items(spark, root))


@query
def f06_calendar_parts(spark, root):
    at = F.col("ts").cast("timestamp")
    day = F.to_date(at)
    return st.table(spark, root, "events").select(
        "event_id", day.alias("day"), cal.start_of_hour(at).alias("hour_start"),
        F.hour(at).cast("bigint").alias("hour"), cal.monday(at).alias("monday"),
        cal.month_start(at).alias("month_start"), cal.yyyymm(at).cast("bigint").alias("yyyymm"),
        cal.iso_weekday(day).cast("bigint").alias("weekday"),
        F.datediff(cal.day_of(EVENTS_AS_OF), day).cast("bigint").alias("days_ago"),
        cal.month_gap(day, F.lit("2024-03-01").cast("date")).cast("bigint").alias("months_ago"),
        F.unix_timestamp(at).alias("unix_seconds"), cal.epoch_day(day).cast("bigint").alias("epoch_day"))


@query
def f23_display_text(spark, root):
    return st.orders(spark, root).select(
        "id", status_label(F.col("status")).alias("label"), money_text(F.col("total_amount")).alias("amount"),
        time_text(F.col("created_at")).alias("placed"))


# --- rollups ------------------------------------------------------------------

@query
def q01_product_daily(spark, root):
    return rollups.product_daily(st.items(spark, root), st.orders(spark, root))


@query
def q01_product_daily_active(spark, root):
    return rollups.product_daily(st.items(spark, root), st.orders(spark, root), exclude_soft_deleted=True)


@query
def q02_product_daily_view(spark, root):
    return rollups.product_daily_view(q01_product_daily(spark, root))


@query
def q03_customer_segments(spark, root):
    return rollups.customer_segments(st.orders(spark, root), st.items(spark, root))


@query
def q03_customer_segments_literal(spark, root):
    return rollups.customer_segments(st.orders(spark, root), st.items(spark, root), fan_out=True)


@query
def q04_customer_segments_view(spark, root):
    return rollups.customer_segments_view(q03_customer_segments(spark, root))


@query
def q04_customer_segments_view_literal(spark, root):
    return rollups.customer_segments_view(q03_customer_segments_literal(spark, root))


@query
def q05_hourly_sales(spark, root):
    return rollups.hourly_sales(rollups.hourly_partials(st.event_items(spark, root), st.event_orders(spark, root)))


@query
def q05_hourly_sales_view(spark, root):
    return rollups.hourly_sales_view(rollups.hourly_partials(st.event_items(spark, root), st.event_orders(spark, root)))


@query
def q05_hourly_sales_view_lineitem(spark, root):
    return rollups.hourly_sales_view(rollups.hourly_partials(st.items(spark, root), st.orders(spark, root)))


@query
def q06_cart_analytics_view(spark, root):
    return rollups.cart_analytics_view(rollups.cart_analytics(st.orders(spark, root)))


@query
def v04_additive_merge(spark, root):
    """Partial rows per month of order, summed per key as an additive table does."""
    items, orders = st.items(spark, root), st.orders(spark, root)
    months = orders.select("*", cal.yyyymm(F.col("created_at")).alias("batch"))
    lines = rollups.sold_lines(items, orders).join(
        months.select(F.col("id").alias("order_id"), "batch"), "order_id")
    return rollups.product_daily_merge(rollups.product_daily_of(lines, ["batch"]).drop("batch"))


@query
def s18_backfilled_rollup(spark, root):
    """The rollup rebuilt into a table and read back."""
    path = fresh_path(spark, "product-daily")
    writers.backfill(q01_product_daily(spark, root), path, "sale_date")
    return spark.read.parquet(path).drop("yyyymm")


@query
def v05_distinct_orders_rows(spark, root):
    orders = st.orders(spark, root)
    batches = [orders.filter(F.col("status") == s) for s in ORDER_STATUSES] + [orders]
    states = [partials.distinct_rows(b, ["user_id"], "id") for b in batches]
    merged = states[0]
    for s in states[1:]:
        merged = merged.unionAll(s)
    return partials.merge_distinct_rows(merged, ["user_id"], "id", "total_orders")


@query
def v05_distinct_orders_bitmaps(spark, root):
    states = partials.distinct_bitmaps(st.orders(spark, root), ["user_id", "status"], "id")
    return partials.merge_distinct_bitmaps(states.drop("status"), ["user_id"], "total_orders")


@query
def v05_distinct_buyers_sketch(spark, root):
    """Sketch estimates per status, with the check that each lies within 10 %."""
    orders = st.orders(spark, root)
    states = partials.distinct_sketches(
        orders.withColumn("month", cal.yyyymm(F.col("created_at"))), ["status", "month"], "user_id")
    estimate = partials.merge_distinct_sketches(states.drop("month"), ["status"], "estimate")
    exact = orders.groupBy("status").agg(F.count_distinct("user_id").cast("bigint").alias("exact"))
    return estimate.join(exact, "status").select(
        "status", "exact", (F.abs(F.col("estimate") - F.col("exact")) <= F.col("exact") * 0.1).alias("close"))


@query
def v08_sum_and_mean_states(spark, root):
    states = partials.sum_states(st.orders(spark, root).withColumn("month", cal.yyyymm(F.col("created_at"))),
                                 ["user_id", "month"], "total_amount")
    return partials.merge_sum_states(states.drop("month"), ["user_id"])


@query
def d08_touched_keys_refresh(spark, root):
    """Rollup kept up by recomputing only the keys a batch of changes touched."""
    log = st.items_log(spark, root)
    orders = st.orders(spark, root)
    cut = F.lit("2001-06-01").cast("timestamp")
    before = staged(versions.latest(log.filter(F.col("created_at") < cut), ties=("product_id",)).drop("updated_at", "deleted_at", "cdc_ts_ms"), "items-before")
    after = versions.latest(log, ties=("product_id",))
    changed = log.filter(F.col("created_at") >= cut)
    changed_orders = changed.select(F.col("order_id").alias("id")).distinct()
    stale = (before.join(changed_orders.withColumnRenamed("id", "order_id"), "order_id", "left_semi")
             .select(F.to_date("created_at").alias("sale_date"), "product_id"))
    old = rollups.product_daily(before, orders)
    return rollups.apply_refresh(old, after, orders, changed_orders, stale)


@query
def d08_touched_customers_refresh(spark, root):
    """Segments kept up by recomputing only the customers a batch touched."""
    cut = F.lit("2001-06-01").cast("timestamp")
    orders_log, items_log = st.orders_log(spark, root), st.items_log(spark, root)
    new_order = F.col("created_at") >= cut
    old = rollups.customer_segments(versions.latest(orders_log.filter(~new_order)),
                                    versions.latest(items_log.filter(~new_order), ties=("product_id",)))
    changed = (orders_log.filter(new_order).select("id")
               .unionAll(items_log.filter(new_order).select(F.col("order_id").alias("id"))))
    orders = versions.latest(orders_log)
    return rollups.refresh_customers(old, orders, st.items(spark, root), rollups.touched_customers(orders_log, changed))


@query
def d08_touched_days_refresh(spark, root):
    """Daily order counts kept up by recomputing only the days a batch touched."""
    log = st.orders_log(spark, root)
    late = (F.col("created_at") >= F.lit("2001-06-01").cast("timestamp")) | (F.col("status") == "CANCELLED")
    old = rollups.cart_analytics(versions.latest(log.filter(~late)))
    days = log.filter(late).select(F.to_date("created_at").alias("order_date"))
    return rollups.cart_analytics_view(rollups.refresh_cart_days(old, versions.latest(log), days))


# --- reports ------------------------------------------------------------------

@query
def q07_bestsellers_now(spark, root):
    return reports.bestsellers_now(st.items(spark, root), st.orders(spark, root), AS_OF)


@query
def q07_bestsellers_now_events(spark, root):
    return reports.bestsellers_now(st.event_items(spark, root), st.event_orders(spark, root), EVENTS_AS_OF)


@query
def q08_kpi_orders(spark, root):
    return reports.kpi_orders(st.orders(spark, root), AS_OF)


@query
def q09_kpi_with_items(spark, root):
    return reports.kpi_with_items(st.event_orders(spark, root), st.event_items(spark, root), EVENTS_AS_OF)


@query
def q09_kpi_with_items_literal(spark, root):
    return reports.kpi_with_items(st.orders(spark, root), st.items(spark, root), AS_OF, fan_out=True)


@query
def q10_orders_by_hour(spark, root):
    return reports.orders_by_hour(st.event_orders(spark, root), st.event_items(spark, root), EVENTS_AS_OF)


@query
def q11_category_sales(spark, root):
    return reports.category_sales(st.items(spark, root), AS_OF)


@query
def q12_bestsellers_day(spark, root):
    return reports.bestsellers_day(q01_product_daily(spark, root), AS_OF)


@query
def q13_customer_metrics(spark, root):
    return reports.customer_metrics(st.orders(spark, root), st.items(spark, root))


@query
def q13_customer_metrics_literal(spark, root):
    return reports.customer_metrics(st.orders(spark, root), st.items(spark, root), fan_out=True)


@query
def q13_rfm_segments(spark, root):
    return reports.rfm_segments(q13_customer_metrics(spark, root), AS_OF)


@query
def q13_rfm_segments_literal(spark, root):
    return reports.rfm_segments(q13_customer_metrics_literal(spark, root), AS_OF)


@query
def q14_top_customers(spark, root):
    return reports.top_customers(q04_customer_segments_view(spark, root))


@query
def q15_hourly_trend(spark, root):
    return reports.hourly_trend(q05_hourly_sales_view(spark, root), EVENTS_AS_OF)


@query
def q16_cart_trend(spark, root):
    return reports.cart_trend(q06_cart_analytics_view(spark, root), AS_OF)


@query
def q16_cart_metrics(spark, root):
    return rollups.cart_metrics(st.orders(spark, root), st.items(spark, root))


@query
def q16_cart_metrics_literal(spark, root):
    return rollups.cart_metrics(st.orders(spark, root), st.items(spark, root), fan_out=True)


@query
def q17_repeat_purchase(spark, root):
    return reports.repeat_purchase(st.items(spark, root), st.orders(spark, root))


@query
def q17_repeat_purchase_people(spark, root):
    return reports.repeat_purchase(st.items(spark, root), st.orders(spark, root), count_people=True)


@query
def q18_bought_together(spark, root):
    return baskets.bought_together(st.items(spark, root), AS_OF)


@query
def q18_bought_together_long(spark, root):
    """A longer period, and a basket limit low enough to take the look-up way."""
    return baskets.bought_together(st.items(spark, root), AS_OF, days=900, basket_limit=4)


@query
def q18_bought_together_unordered(spark, root):
    return baskets.bought_together_unordered(st.items(spark, root), AS_OF, days=900)


@query
def q18_bought_together_unordered_lookup(spark, root):
    return baskets.bought_together_unordered(st.items(spark, root), AS_OF, days=900, basket_limit=4)


@query
def q19_cohort_ltv(spark, root):
    return reports.cohort_ltv(st.orders(spark, root), AS_OF)


@query
def q19_cohort_ltv_all(spark, root):
    return reports.cohort_ltv(st.orders(spark, root), AS_OF, months=84)


@query
def q20_weekly_growth(spark, root):
    return reports.weekly_growth(st.orders(spark, root), AS_OF)


@query
def q21_stock_projection(spark, root):
    return reports.stock_projection(q01_product_daily(spark, root), AS_OF)


@query
def q22_revenue_forecast(spark, root):
    return reports.revenue_forecast(st.orders(spark, root), AS_OF)


@query
def q23_volume_decomposition(spark, root):
    return reports.volume_decomposition(st.orders(spark, root), AS_OF)


@query
def q24_deleted_stats(spark, root):
    return reports.deleted_stats(st.orders(spark, root))


@query
def q25_status_statistics(spark, root):
    return reports.status_statistics(st.orders(spark, root))


@query
def q26_category_counts(spark, root):
    return reports.category_counts(st.products(spark, root))


@query
def q27_recent_orders(spark, root):
    return service.recent_orders(st.orders(spark, root), st.users(spark, root), st.items(spark, root))


def _item_text(nested: DataFrame) -> DataFrame:
    """Nested items as one text, for comparison with SQL."""
    text = F.array_join(F.transform("items", lambda i: F.concat_ws(
        ":", i["id"].cast("string"), i["product_id"].cast("string"), i["quantity"].cast("string"),
        i["subtotal"].cast("string"))), ",")
    return nested.withColumn("items", text).drop("part")


@query
def q28_order_page(spark, root):
    return _item_text(service.order_page(st.orders(spark, root), st.items(spark, root), status="COMPLETED", page=3))


@query
def o03_order_page_after(spark, root):
    """The third page again, sought from the last order of the second one in a table kept by month."""
    path = fresh_path(spark, "orders-by-month")
    versions.write_by_month(st.orders(spark, root), path)
    orders, items = spark.read.parquet(path), st.items(spark, root)
    last = service.order_page_after(orders, items, None, status="COMPLETED", limit=20).orderBy("created_at", "id").first()
    return _item_text(service.order_page_after(orders, items, (last.created_at, last.id), status="COMPLETED"))


@query
def q29_user_orders(spark, root):
    return _item_text(service.user_orders(st.orders(spark, root), st.items(spark, root)))


@query
def q30_status_daily(spark, root):
    return rollups.status_daily(st.orders(spark, root))


@query
def q31_status_hourly(spark, root):
    return rollups.status_hourly(st.event_orders(spark, root))


@query
def q31_status_hourly_merged(spark, root):
    parts = rollups.status_hourly_partials(st.event_orders(spark, root), F.to_date("created_at"))
    return rollups.status_hourly_merge(parts)


@query
def q32_daily_revenue_week(spark, root):
    return reports.daily_revenue_week(st.orders(spark, root), AS_OF)


@query
def p19_daily_revenue_by_months(spark, root):
    """The same from a table kept by month: only the months of the period are read."""
    path = fresh_path(spark, "orders-by-month")
    versions.write_by_month(st.orders(spark, root), path)
    return reports.daily_revenue_week(spark.read.parquet(path), AS_OF)


@query
def q33_order_summaries(spark, root):
    return reports.order_summaries(st.orders(spark, root), st.items(spark, root))


@query
def q34_product_report(spark, root):
    return reports.product_report(q02_product_daily_view(spark, root), AS_OF)


@query
def o04_users_page(spark, root):
    return service.page_of(st.users(spark, root), F.desc("id"), page=4)


@query
def o04_products_after(spark, root):
    return service.page_after(st.products(spark, root), 150)


# --- deduplication -----------------------------------------------------------

@query
def d01_first_seen_ten_minutes(spark, root):
    rows = st.table(spark, root, "events").select(
        "event_type", F.unix_millis(F.col("ts").cast("timestamp")).alias("at_ms"), "event_id")
    return dedup.first_seen(rows, "event_type", "at_ms", "event_id", range_ms=86_400_000)


@query
def d02_distinct_versions(spark, root):
    return (versions.distinct_versions(st.items_log(spark, root)).groupBy("id")
            .agg(F.count("*").cast("bigint").alias("versions")))


@query
def d09_replayed_range(spark, root):
    """Events written as topic text, one range of them replayed from the start."""
    path = fresh_path(spark, "replay")
    writers.write_topic(envelopes.item_envelopes(st.items_log(spark, root)), path, writers.TOPICS["order_items"])
    return jobs.replay(spark, path, "order_items", 820_454_400_000, 852_076_800_000)


@query
def d10_lag(spark, root):
    items = st.table(spark, root, "lineitem").select(
        F.col("l_orderkey").alias("id"), F.unix_millis(F.col("l_shipdate").cast("timestamp")).alias("arrived"))
    orders = st.orders_log(spark, root).select("id", F.col("cdc_ts_ms").alias("happened"))
    return quality.lag_report(items.join(orders, "id"), "arrived", "happened")


# --- quality ------------------------------------------------------------------

@query
def k01_count_reconciliation(spark, root):
    return quality.count_reconciliation(st.table(spark, root, "orders"), st.orders(spark, root))


@query
def k01_row_reconciliation(spark, root):
    """A target that lacks rows, holds some twice, has others that differ, shifted NULLs and rows of its own; deletes on both sides."""
    source = st.orders(spark, root)
    key = F.col("id")
    target = versions.latest(parsing.order_rows(envelopes.order_envelopes(st.orders_log(spark, root)))).filter(
        (key % 29 != 0) | ~versions.not_deleted())
    shifted = key % 43 == 0
    target = target.withColumns({
        "status": F.when(key % 37 == 0, "LOST").otherwise(F.col("status")),
        "deleted_at": F.when(shifted, F.col("updated_at")).otherwise(F.col("deleted_at")),
        "updated_at": F.when(~shifted, F.col("updated_at"))})
    target = (target.unionByName(target.filter("id % 31 = 0"))
              .unionByName(source.filter("id % 41 = 0").withColumn("id", key + 1_000_000_000)))
    return quality.row_differences(source, target, ["user_id", "status", "total_amount", "created_at", "updated_at", "deleted_at"])


@query
def k02_duplicate_ids(spark, root):
    return quality.duplicate_keys(st.items_log(spark, root))


@query
def k03_order_total_mismatch(spark, root):
    return quality.order_total_mismatch(st.orders(spark, root), st.items(spark, root))


@query
def k03_order_totals_listing(spark, root):
    return quality.order_totals_listing(st.orders(spark, root), st.items(spark, root))


@query
def k04_counts_by_op(spark, root):
    return quality.counts_by_op(st.items_log(spark, root))


@query
def k05_labelled_counts(spark, root):
    return quality.labelled_counts({"Orders": st.orders_log(spark, root), "Order Items": st.items_log(spark, root)})


@query
def k06_illegal_transitions(spark, root):
    return quality.illegal_transitions(st.status_log(spark, root))


@query
def k06_transition_summary(spark, root):
    return quality.transition_summary(k06_illegal_transitions(spark, root))


@query
def k07_negative_stock(spark, root):
    return quality.negative_stock(st.products(spark, root), st.stock_moves(spark, root))


@query
def k08_shared_names(spark, root):
    return quality.duplicate_values(st.products(spark, root), "name")


@query
def k08_shared_emails(spark, root):
    return quality.labelled_counts({"emails": quality.duplicate_values(st.users(spark, root), "email"),
                                    "usernames": quality.duplicate_values(st.users(spark, root), "username")})


@query
def k09_field_faults(spark, root):
    orders, items = st.orders(spark, root), st.items(spark, root)
    faults = (quality.item_faults(items).unionByName(quality.order_faults(orders, items))
              .unionByName(quality.product_faults(st.products(spark, root)))
              .unionByName(quality.status_faults(orders, ORDER_STATUSES)
                           .select("id", F.lit("unknown status").alias("fault"))))
    return faults.groupBy("fault").agg(F.count("*").cast("bigint").alias("row_count"))


@query
def k10_refused_cancellations(spark, root):
    return quality.refused_cancellations(k06_illegal_transitions(spark, root))


@query
def k11_deletable_users(spark, root):
    return quality.deletable_users(st.users(spark, root), st.orders(spark, root))


@query
def k11_users_without_recent_orders(spark, root):
    """Users that no order of the last 30 days refers to."""
    return quality.deletable_users(st.users(spark, root), cal.rows_since(st.orders(spark, root), AS_OF, "30 DAY"))


@query
def k11_blocked_users(spark, root):
    return quality.blocked_users(st.users(spark, root), st.orders(spark, root))


# --- streams --------------------------------------------------------------------

def _captured(events: DataFrame, base: str) -> None:
    """Run the capture job over what is there; it leaves one folder per topic."""
    jobs.capture(events, f"{base}/checkpoints/capture", path=f"{base}/topics", every=None).awaitTermination()


def _topic(spark, base: str, table: str) -> DataFrame:
    return readers.change_stream(spark, f"topic={writers.TOPICS[table]}", path=f"{base}/topics")


@query
def s05_stream_current_orders(spark, root):
    """Capture to topic files, sync to the change log, newest version per id."""
    base = fresh_path(spark, "stream-orders")
    log = st.orders_from(readers.table_stream(spark, root, "orders"))
    _captured(envelopes.order_envelopes(log), base)
    jobs.sync(_topic(spark, base, "orders"), "orders", base, every=None, state_partitions=8).awaitTermination()
    return jobs.current_rows(spark, base, "orders")


@query
def s06_stream_current_items(spark, root):
    """The same for items, named by a stream-static join. All versions go to the log:
    some share (id, version), and only the read rule tells which of them wins."""
    base = fresh_path(spark, "stream-items")
    log = st.items_from(readers.table_stream(spark, root, "lineitem"), st.table(spark, root, "part"))
    _captured(envelopes.item_envelopes(log), base)
    jobs.sync(_topic(spark, base, "order_items"), "order_items", base, every=None, mode="all").awaitTermination()
    return jobs.current_rows(spark, base, "order_items")


@query
def d01_stream_first_seen(spark, root):
    """First status per order; what is held back within the period never arrives."""
    base = fresh_path(spark, "stream-first-seen")
    history = st.status_rows(readers.table_stream(spark, root, "lineitem"))
    _captured(envelopes.order_envelopes(history), base)
    # An interval: a processing-time timer never lets a finite run end by itself.
    jobs.drain(jobs.sync(_topic(spark, base, "orders"), "orders", base, every="5 seconds", mode="first_seen",
                         state_partitions=8))
    return writers.read_log(spark, f"{base}/orders", ORDERS_LOG).select("id", "cdc_ts_ms")


@query
def d01b_stream_first_seen_items(spark, root):
    """First version per item, as for orders."""
    base = fresh_path(spark, "stream-first-seen-items")
    events = envelopes.item_envelopes(st.items_log(spark, root))
    events.write.text(f"{base}/topics/order-items-cdc")
    stream = readers.change_stream(spark, "order-items-cdc", path=f"{base}/topics")
    jobs.drain(jobs.sync(stream, "order_items", base, every="5 seconds", mode="first_seen", state_partitions=8))
    return writers.read_log(spark, f"{base}/order_items", ORDER_ITEMS_LOG).select("id", "cdc_ts_ms")


@query
def s10_one_topic_current_orders(spark, root):
    """Orders and items in one keyed topic, whose reader takes the orders; each batch keeps a table of current rows by month."""
    base, log = fresh_path(spark, "stream-one-topic"), st.orders_log(spark, root)
    first = log.withColumns({"cdc_ts_ms": F.col("cdc_ts_ms") - 1, "status": F.lit("PENDING"), "cdc_op": F.lit("c"),
                             "created_at": F.col("created_at") - F.expr("INTERVAL 40 DAY")}).filter("id % 50 < 10")
    for rows in (envelopes.order_envelopes(first).unionByName(envelopes.item_envelopes(st.items_log(spark, root).filter("id % 9 = 0"))),
                 envelopes.order_envelopes(log)):
        rows.coalesce(4).write.mode("append").option("compression", "gzip").text(f"{base}/source/changes")
    source = readers.change_stream(spark, "changes", path=f"{base}/source", max_files_per_trigger=4)
    jobs.capture(source, f"{base}/checkpoints/capture", path=f"{base}/topics", every=None, one_topic="all-cdc", partitions=4,
                 compression="gzip").awaitTermination()
    topic = readers.change_stream(spark, "topic=all-cdc/partition=*", path=f"{base}/topics", keyed=True, max_files_per_trigger=8)
    jobs.sync(routing.route(topic, "orders"), "orders", base, every=None, state_partitions=8, after=jobs.keep_current(base, "orders")).awaitTermination()
    return spark.read.parquet(f"{base}/current/orders").drop("yyyymm", TIE.name)


@query
def s08_throttled_stream(spark, root):
    """A topic of six files read two at a time: how many batches brought how many events."""
    base = fresh_path(spark, "stream-throttled")
    envelopes.order_envelopes(st.orders_log(spark, root)).repartition(6).write.text(f"{base}/topics/orders-cdc")
    stream = readers.change_stream(spark, "orders-cdc", path=f"{base}/topics", max_files_per_trigger=2)
    query = jobs.sync(stream, "orders", base, every=None, mode="all")
    query.awaitTermination()
    return spark.createDataFrame([(p["rows"],) for p in jobs.progress(query) if p["rows"]], "n long").agg(
        F.count("*").alias("batches"), F.sum("n").alias("events"))


@query
def d05_restarted_sync(spark, root):
    """A sync whose first batch fails after it was written, started again from its checkpoint."""
    base, failed = fresh_path(spark, "stream-restarted"), []
    envelopes.order_envelopes(st.orders_log(spark, root)).write.text(f"{base}/topics/orders-cdc")

    def fail_once(batch, batch_id):
        if not failed:
            failed.append(batch_id)
            raise RuntimeError("lost")

    def start():
        stream = readers.change_stream(spark, "orders-cdc", path=f"{base}/topics")
        return jobs.sync(stream, "orders", base, every=None, state_partitions=8, after=fail_once)

    jobs.run_with_restarts(start, pause_s=0)
    return writers.read_log(spark, f"{base}/orders", ORDERS_LOG).drop("yyyymm")


@query
def d06_resumed_with_late_versions(spark, root):
    """A sync that is stopped and goes on from its checkpoint; what comes then holds older versions of what came before."""
    base, log = fresh_path(spark, "stream-resumed"), st.orders_log(spark, root)
    older = log.withColumns({"cdc_ts_ms": F.col("cdc_ts_ms") - 86_400_000, "status": F.lit("PENDING"), "cdc_op": F.lit("c")})
    for part in (log.filter("id % 2 = 0"), log.filter("id % 2 = 1").unionByName(older.filter("id % 4 < 2"))):
        envelopes.order_envelopes(part).write.mode("append").text(f"{base}/topics/orders-cdc")
        stream = readers.change_stream(spark, "orders-cdc", path=f"{base}/topics")
        jobs.sync(stream, "orders", base, every=None, state_partitions=8).awaitTermination()
    return jobs.current_rows(spark, base, "orders")


@query
def p05_bad_events(spark, root):
    """A topic with broken lines, events without an image and rows without a buyer, synced; what was set aside and why."""
    base, key = fresh_path(spark, "stream-bad"), F.col("id")
    log = st.orders_log(spark, root)
    broken = F.when(key % 11 == 0, F.concat(F.lit("broken "), key)).otherwise(
        F.concat(F.lit('{"op":"u","after":null,"ts_ms":'), key, F.lit("}")))
    bad = log.filter("id % 11 = 0 OR id % 13 = 0").select(broken.alias("value"))
    rest = log.filter("id % 11 <> 0 AND id % 13 <> 0").withColumn("user_id", F.when(key % 17 != 0, F.col("user_id")))
    bad.unionByName(envelopes.order_envelopes(rest)).write.text(f"{base}/topics/orders-cdc")
    stream = readers.change_stream(spark, "orders-cdc", path=f"{base}/topics")
    jobs.sync(stream, "orders", base, every=None, state_partitions=8).awaitTermination()
    return jobs.rejected_events(spark, base, "orders").select("reason", "event", "id", "status", "cdc_ts_ms")


# --- rollups kept by a stream -----------------------------------------------------

def _history(spark, root) -> list[DataFrame]:
    """Event texts in the order in which a topic gets them: every row as it was first, with other values and every fifth
    item in another order, then as it is in the log, then some of the first ones again."""
    orders, items = st.orders_log(spark, root), st.items_log(spark, root)
    earlier = F.col("cdc_ts_ms") - 2000
    first_orders = orders.withColumns({"status": F.lit("PENDING"), "cdc_op": F.lit("c"), "cdc_ts_ms": earlier,
                                       "user_id": F.col("user_id") + (F.col("id") % 3), "total_amount": F.lit("1.50").cast("decimal(10,2)"),
                                       "created_at": F.col("created_at") - F.expr("INTERVAL 3 DAY")})
    moved = (F.col("id") % 5 == 0) & (F.col("cdc_op") == "u")
    items = items.withColumn("former", F.when(moved, F.col("order_id") + 1).otherwise(F.col("order_id")))
    first_items = items.withColumns({"order_id": F.col("former"), "cdc_op": F.lit("c"), "cdc_ts_ms": earlier,
                                     "quantity": F.lit(1), "created_at": F.col("created_at") - F.expr("INTERVAL 30 HOUR")})

    def texts(order_rows, item_rows):
        return envelopes.order_envelopes(order_rows).unionByName(envelopes.to_envelopes(
            item_rows, "order_items", ORDER_ITEMS, pos=F.col("product_id"), former={"order_id": "former"}))

    again = F.col("id") % 4 == 0
    return [texts(first_orders, first_items), texts(orders, items), texts(first_orders.filter(again), first_items.filter(again))]


def _kept(spark, root) -> str:
    """The folder of the four rollups that one stream kept over the whole history, a batch for each of its parts."""
    run = spark.sparkContext.applicationId, root
    if run not in KEPT:
        KEPT[run] = _keep(spark, root)
    return KEPT[run]


KEPT: dict[tuple[str, str], str] = {}


def _keep(spark, root) -> str:
    base, files = fresh_path(spark, "kept"), 8
    for part in _history(spark, root):
        part.repartition(files).write.mode("append").text(f"{base}/topics/changes")
    events = readers.change_stream(spark, "changes", path=f"{base}/topics", max_files_per_trigger=files)
    kept.keep(events, base, every=None).awaitTermination()
    return base


@query
def j11_kept_product_daily(spark, root):
    return kept.product_daily(spark, _kept(spark, root))


@query
def j11_kept_customer_segments(spark, root):
    return kept.customer_segments(spark, _kept(spark, root))


@query
def j11_kept_hourly_sales(spark, root):
    return rollups.hourly_sales(kept.hourly_state(spark, _kept(spark, root)))


@query
def j11_kept_cart_analytics(spark, root):
    return rollups.cart_analytics_view(kept.cart_analytics(spark, _kept(spark, root)))
