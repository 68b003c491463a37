"""The four rollups and their views, recomputed from current rows, plus the
incremental forms: partial rows per batch, merged on read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import calendar as cal
from tidemark.functions.money import cents, ratio, total, whole
from tidemark.operators.staging import staged
from tidemark.plans.lines import alive, orders_with_totals, repeats, sold_lines

PRODUCT_DAY = ("sale_date", "product_id")


def product_daily(items: DataFrame, orders: DataFrame, exclude_soft_deleted: bool = False,
                  extra_keys: Sequence[Column] = ()) -> DataFrame:
    """Sales per day and product.

    The first step groups by order as well: it runs where the join left the rows
    and makes the order count a plain count. Only the buyers need a distinct count,
    so no row is expanded, and a product with a third of all lines is spread over
    its buyers before the last step.
    """
    lines = sold_lines(items, orders, exclude_soft_deleted)
    return product_daily_of(lines, extra_keys)


def product_daily_of(lines: DataFrame, extra_keys: Sequence[Column] = ()) -> DataFrame:
    day = F.to_date("created_at").alias("sale_date")
    per_order = lines.groupBy("order_id", "user_id", day, "product_id", *extra_keys).agg(
        F.min("product_name").alias("product_name"),
        F.sum("quantity").alias("quantity"), F.sum("subtotal").alias("subtotal"))
    extra_names = [c for c in per_order.columns
                   if c not in ("order_id", "user_id", "sale_date", "product_id", "product_name", "quantity", "subtotal")]
    return per_order.groupBy("sale_date", "product_id", *extra_names).agg(
        F.min("product_name").alias("product_name"),
        F.count("*").cast("bigint").alias("order_count"),
        whole(F.sum("quantity")).alias("total_quantity"),
        total("subtotal").alias("total_revenue"),
        F.count_distinct("user_id").cast("bigint").alias("unique_customers"))


def product_daily_view(daily: DataFrame) -> DataFrame:
    return daily.withColumn("avg_price", ratio(F.col("total_revenue"), F.col("total_quantity")))


def product_daily_merge(partials: DataFrame) -> DataFrame:
    """Additive merge of partial rows: every measure is summed per key."""
    return partials.groupBy(*PRODUCT_DAY).agg(
        F.min("product_name").alias("product_name"),
        whole(F.sum("order_count")).alias("order_count"),
        whole(F.sum("total_quantity")).alias("total_quantity"),
        total("total_revenue").alias("total_revenue"),
        whole(F.sum("unique_customers")).alias("unique_customers"))


def customer_segments(orders: DataFrame, items: DataFrame, fan_out: bool = False,
                      exclude_soft_deleted: bool = False) -> DataFrame:
    """Orders, spend (in cents), items and status counts per customer.

    ``fan_out=True`` repeats order values once per item line, as a join of the two
    tables would; the default counts each order once.
    """
    joined = orders_with_totals(alive(orders, exclude_soft_deleted), alive(items, exclude_soft_deleted))
    times = repeats("all_lines", fan_out)
    return joined.groupBy("user_id").agg(
        F.count("*").cast("bigint").alias("total_orders"),
        whole(F.sum(cents(F.col("total_amount")) * times)).alias("total_spent_cents"),
        whole(F.sum("all_quantity")).alias("total_items"),
        whole(F.sum(F.when(F.col("status") == "COMPLETED", times))).alias("completed_orders"),
        whole(F.sum(F.when(F.col("status") == "CANCELLED", times))).alias("cancelled_orders"))


def customer_segments_view(segments: DataFrame) -> DataFrame:
    spent = F.col("total_spent_cents")
    return segments.select(
        "user_id", "total_orders",
        (spent.cast("decimal(20,0)") / 100).cast("decimal(18,2)").alias("total_spent"),
        "total_items",
        ratio(spent, F.col("total_orders") * 100).alias("avg_order_value"),
        ratio(F.col("total_items"), F.col("total_orders")).alias("avg_items_per_order"),
        "completed_orders", "cancelled_orders")


def hourly_partials(items: DataFrame, orders: DataFrame, exclude_soft_deleted: bool = False) -> DataFrame:
    """Mergeable hourly state: one row per hour, product and order.

    Order ids stay in the state, so distinct orders merge exactly over any set of
    batches; sums and (sum, count) pairs merge by addition.
    """
    lines = sold_lines(items, orders, exclude_soft_deleted)
    return lines.groupBy(cal.start_of_hour(F.col("created_at")).alias("hour_timestamp"), "product_id", "order_id").agg(
        F.min("product_name").alias("product_name"),
        F.sum("quantity").cast("bigint").alias("quantity"),
        F.sum("subtotal").cast("decimal(18,2)").alias("revenue"),
        F.sum("price").cast("decimal(18,2)").alias("price_sum"),
        F.count("price").alias("price_count"))


def _hourly(state: DataFrame, *keys: str, name: bool) -> DataFrame:
    per_order = state.groupBy(*keys, "order_id").agg(
        *([F.min("product_name").alias("product_name")] if name else []),
        F.sum("quantity").alias("quantity"), F.sum("revenue").alias("revenue"),
        F.sum("price_sum").alias("price_sum"), F.sum("price_count").alias("price_count"))
    return per_order.groupBy(*keys).agg(
        *([F.min("product_name").alias("product_name")] if name else []),
        F.count("*").cast("bigint").alias("orders"),
        whole(F.sum("quantity")).alias("quantity"),
        total("revenue").alias("revenue"),
        ratio(F.sum("price_sum"), F.sum("price_count")).alias("avg_price"))


def hourly_sales(state: DataFrame) -> DataFrame:
    """Per hour and product."""
    return _hourly(state, "hour_timestamp", "product_id", name=True)


def hourly_sales_view(state: DataFrame) -> DataFrame:
    """Per hour and product name: products that share a name are one row."""
    return _hourly(state, "hour_timestamp", "product_name", name=False)


def cart_analytics(orders: DataFrame, exclude_soft_deleted: bool = False) -> DataFrame:
    return alive(orders, exclude_soft_deleted).groupBy(F.to_date("created_at").alias("order_date")).agg(
        F.count("*").cast("bigint").alias("total_orders"),
        F.count_if(F.col("status") == "COMPLETED").cast("bigint").alias("completed_orders"))


def cart_analytics_view(carts: DataFrame) -> DataFrame:
    return (carts.filter("total_orders > 0")
            .withColumn("completion_rate", ratio(F.col("completed_orders"), F.col("total_orders"), 100.0)))


def cart_metrics(orders: DataFrame, items: DataFrame, fan_out: bool = False) -> DataFrame:
    """Daily basket size, order value, item price and completion.

    With ``fan_out`` orders weigh by their number of lines, and an order without
    lines counts as one line of price zero.
    """
    joined = orders_with_totals(alive(orders), items)
    times = repeats("all_lines", fan_out)
    price_base = F.sum(F.greatest(F.col("all_lines"), F.lit(1))) if fan_out else F.sum("all_lines")
    done = F.sum(F.when(F.col("status") == "COMPLETED", times).otherwise(0))
    return joined.groupBy(F.to_date("created_at").alias("order_date")).agg(
        ratio(F.sum(F.col("alive_lines") * times), F.sum(times)).alias("avg_items_per_order"),
        ratio(F.sum((F.col("total_amount") * times).cast("decimal(18,2)")), F.sum(times)).alias("avg_order_value"),
        ratio(F.sum("all_price"), price_base).alias("avg_item_price"),
        F.count("*").cast("bigint").alias("total_orders"),
        whole(done).alias("completed_orders"),
        ratio(done, F.count("*"), 100.0).alias("completion_rate"))


def status_daily(orders: DataFrame) -> DataFrame:
    """Orders, revenue, average and buyers per day and status."""
    return _by_status(orders, F.to_date("created_at").alias("sale_date"))


def status_hourly(orders: DataFrame) -> DataFrame:
    return _by_status(orders, cal.start_of_hour(F.col("created_at")).alias("order_hour"))


def _by_status(orders: DataFrame, bucket: Column) -> DataFrame:
    per_user = alive(orders).groupBy(bucket, "status", "user_id").agg(
        F.count("*").alias("n"), F.sum("total_amount").alias("amount"))
    name = per_user.columns[0]
    return per_user.groupBy(name, "status").agg(
        whole(F.sum("n")).alias("order_count"),
        total("amount").alias("revenue"),
        ratio(F.sum("amount"), F.sum("n")).alias("avg_order_value"),
        F.count("user_id").cast("bigint").alias("unique_customers"))


def status_hourly_partials(orders: DataFrame, batch: Column) -> DataFrame:
    """Mergeable rows per batch, hour, status and buyer."""
    return alive(orders).groupBy(batch.alias("batch"), cal.start_of_hour(F.col("created_at")).alias("order_hour"),
                                 "status", "user_id").agg(
        F.count("*").alias("n"), F.sum("total_amount").cast("decimal(18,2)").alias("amount"))


def status_hourly_merge(partials: DataFrame) -> DataFrame:
    per_user = partials.groupBy("order_hour", "status", "user_id").agg(
        F.sum("n").alias("n"), F.sum("amount").alias("amount"))
    return per_user.groupBy("order_hour", "status").agg(
        whole(F.sum("n")).alias("order_count"),
        total("amount").alias("revenue"),
        ratio(F.sum("amount"), F.sum("n")).alias("avg_order_value"),
        F.count("user_id").cast("bigint").alias("unique_customers"))


def touched_keys(items: DataFrame, changed_orders: DataFrame, stale_keys: DataFrame) -> DataFrame:
    """The (day, product) keys a batch of changes touched.

    A status change of an order touches every key of its items; ``stale_keys`` are
    the keys that rows of the batch belonged to before it.
    """
    ids = changed_orders.select(F.col("id").alias("order_id")).distinct()
    now = (items.join(ids, "order_id", "left_semi")
           .select(F.to_date("created_at").alias("sale_date"), "product_id"))
    return now.unionByName(stale_keys.select(*PRODUCT_DAY)).distinct()


def refreshed(items: DataFrame, orders: DataFrame, keys: DataFrame) -> DataFrame:
    """Recomputed rollup rows of the given keys."""
    affected = (items.withColumn("sale_date", F.to_date("created_at"))
                .join(keys, list(PRODUCT_DAY), "left_semi").drop("sale_date"))
    return product_daily(affected, orders)


def apply_refresh(rollup: DataFrame, items: DataFrame, orders: DataFrame, changed_orders: DataFrame,
                  stale_keys: DataFrame) -> DataFrame:
    """The rollup with its touched keys replaced by their recomputed rows. Items are worked out once, for both steps."""
    unread = [c for c in ("updated_at", "deleted_at", "cdc_ts_ms") if c in items.columns]
    items = staged(items.drop(*unread), "refresh-items")
    keys = touched_keys(items, changed_orders, stale_keys)
    kept = rollup.join(keys, list(PRODUCT_DAY), "left_anti")
    return kept.unionByName(refreshed(items, orders, keys))


def touched_customers(orders: DataFrame, changed_order_ids: DataFrame) -> DataFrame:
    """Customers of the orders a batch touched. Give ``orders`` as all versions where
    an order may have moved to another customer."""
    ids = changed_order_ids.select("id").distinct()
    return orders.join(ids, "id", "left_semi").select("user_id").distinct()


def refresh_customers(segments: DataFrame, orders: DataFrame, items: DataFrame, customers: DataFrame) -> DataFrame:
    """Customer segments with the given customers recomputed from current rows."""
    mine = orders.join(customers, "user_id", "left_semi")
    lines = items.join(mine.select(F.col("id").alias("order_id")), "order_id", "left_semi")
    return segments.join(customers, "user_id", "left_anti").unionByName(customer_segments(mine, lines))


def refresh_cart_days(carts: DataFrame, orders: DataFrame, days: DataFrame) -> DataFrame:
    """Daily order counts with the given ``order_date`` days recomputed."""
    on_days = (orders.withColumn("order_date", F.to_date("created_at"))
               .join(days.select("order_date").distinct(), "order_date", "left_semi").drop("order_date"))
    return (carts.join(days.select("order_date").distinct(), "order_date", "left_anti")
            .unionByName(cart_analytics(on_days)))
