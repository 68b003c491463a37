"""Dashboard, business and forecast reports.

All take current rows and, where the period is relative, ``as_of``. A report with
a limit is ordered by a key that is unique, so that the same rows come out of
every run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import calendar as cal
from tidemark.functions.money import ratio, rounded, total, whole
from tidemark.operators.staging import staged
from tidemark.operators.versions import active
from tidemark.plans.lines import alive, orders_with_totals, repeats, sold_lines


# --- dashboard -------------------------------------------------------------

def _name_sales(lines: DataFrame, key: str) -> DataFrame:
    """Orders, quantity, revenue and average price per key, from (key, order) rows."""
    per_order = lines.groupBy(key, "order_id").agg(
        F.sum("quantity").alias("quantity"), F.sum("subtotal").alias("subtotal"),
        F.sum("price").alias("price"), F.count("price").alias("prices"))
    return per_order.groupBy(key).agg(
        F.count("*").cast("bigint").alias("order_count"),
        whole(F.sum("quantity")).alias("quantity_sold"),
        total("subtotal").alias("revenue"),
        ratio(F.sum("price"), F.sum("prices")).alias("avg_price"))


def bestsellers_now(items: DataFrame, orders: DataFrame, as_of, interval: str = "1 HOUR", k: int = 10) -> DataFrame:
    recent = cal.rows_since(items, as_of, interval)
    lines = sold_lines(recent, orders, keep_deleted_orders=True)
    return _name_sales(lines, "product_name").orderBy(F.desc("revenue"), "product_name").limit(k)


def kpi_orders(orders: DataFrame, as_of) -> DataFrame:
    """One row for the day: orders, revenue, average order value, buyers."""
    today = cal.rows_on_day(active(orders), as_of)
    return today.agg(
        F.count("*").cast("bigint").alias("total_orders"),
        total("total_amount").alias("total_revenue"),
        ratio(F.sum("total_amount"), F.count("*")).alias("avg_order_value"),
        F.count_distinct("user_id").cast("bigint").alias("unique_customers"))


def kpi_with_items(orders: DataFrame, items: DataFrame, as_of, fan_out: bool = False) -> DataFrame:
    """The day's key figures with item figures and the completion rate."""
    today = cal.rows_on_day(alive(orders), as_of)
    lines = staged(items.join(today.select(F.col("id").alias("order_id")), "order_id", "left_semi")
                   .select("order_id", "product_id", "quantity", "price", "subtotal", "cdc_op"), "day-lines")
    products = lines.agg(F.count_distinct("product_id").cast("bigint").alias("n"))
    times = repeats("all_lines", fan_out)
    amount = F.sum((F.col("total_amount") * times).cast("decimal(18,2)"))
    done = F.sum(F.when(F.col("status") == "COMPLETED", times).otherwise(0))
    return orders_with_totals(today, lines).agg(
        F.count("*").cast("bigint").alias("total_orders"),
        F.coalesce(amount, F.lit(0)).cast("decimal(18,2)").alias("total_revenue"),
        ratio(amount, F.sum(times)).alias("avg_order_value"),
        F.count_distinct("user_id").cast("bigint").alias("unique_customers"),
        whole(F.sum("all_quantity")).alias("total_items_sold"),
        ratio(done, F.count("*"), 100.0).alias("completion_rate"),
    ).select("*", products.scalar().alias("unique_products_sold"))


def orders_by_hour(orders: DataFrame, items: DataFrame, as_of) -> DataFrame:
    today = cal.rows_on_day(alive(orders), as_of)
    counts = (cal.rows_on_day(alive(items), as_of)
              .groupBy(F.col("order_id").alias("id")).agg(F.count("*").alias("item_count")))
    return (today.join(counts, "id", "left").groupBy(F.hour("created_at").cast("bigint").alias("hour")).agg(
        F.count("*").cast("bigint").alias("order_count"),
        total("total_amount").alias("revenue"),
        ratio(F.sum(F.coalesce("item_count", F.lit(0))), F.count("*")).alias("avg_items_per_order"))
        .orderBy("hour"))


def category_sales(items: DataFrame, as_of, k: int = 10) -> DataFrame:
    """The day's sales by the first word of the product name."""
    today = (cal.rows_on_day(alive(items), as_of)
             .withColumn("category", F.split_part("product_name", F.lit(" "), F.lit(1))))
    return _name_sales(today, "category").orderBy(F.desc("revenue"), "category").limit(k)


def bestsellers_day(daily: DataFrame, as_of, k: int = 10) -> DataFrame:
    """From the daily product rollup."""
    return (cal.rows_of_days(daily, as_of, 0, "sale_date").groupBy("product_name").agg(
        whole(F.sum("total_quantity")).alias("quantity_sold"),
        total("total_revenue").alias("revenue"),
        whole(F.sum("unique_customers")).alias("customers"))
        .orderBy(F.desc("revenue"), "product_name").limit(k))


def hourly_trend(hourly: DataFrame, as_of) -> DataFrame:
    return (cal.rows_since(hourly, as_of, "24 HOUR", "hour_timestamp")
            .select("hour_timestamp", "product_name", "orders", "quantity", "revenue")
            .orderBy(F.desc("hour_timestamp"), F.desc("revenue")))


def cart_trend(carts: DataFrame, as_of, days: int = 7) -> DataFrame:
    return cal.rows_of_days(carts, as_of, days, "order_date").orderBy(F.desc("order_date"))


def product_report(view: DataFrame, as_of, days: int = 7) -> DataFrame:
    return (cal.rows_of_days(view, as_of, days, "sale_date")
            .select("sale_date", "product_id", "product_name", "total_revenue", "total_quantity", "avg_price")
            .orderBy(F.desc("total_revenue")))


def daily_revenue_week(orders: DataFrame, as_of, days: int = 7) -> DataFrame:
    recent = cal.rows_since(alive(orders), as_of, f"{days} DAY")
    return (recent.groupBy(F.to_date("created_at").alias("order_date")).agg(
        F.count("*").cast("bigint").alias("orders"), total("total_amount").alias("revenue"))
        .orderBy(F.desc("order_date")))


# --- customers -------------------------------------------------------------

def customer_metrics(orders: DataFrame, items: DataFrame, fan_out: bool = False) -> DataFrame:
    """Per customer: last order, orders, spend, average, products, status counts.

    Order figures come from the orders alone, item figures from one pass over the
    joined lines, reduced by (customer, product) before the last step.
    """
    placed = alive(orders)
    weighted = orders_with_totals(placed, items) if fan_out else placed
    times = repeats("all_lines", fan_out)
    spent = F.sum((F.col("total_amount") * times).cast("decimal(18,2)"))
    base = weighted.groupBy("user_id").agg(
        F.max("created_at").alias("last_order_date"),
        F.count("*").cast("bigint").alias("total_orders"),
        spent.cast("decimal(18,2)").alias("total_spent"),
        ratio(spent, F.sum(times)).alias("avg_order_value"),
        whole(F.sum(F.when(F.col("status") == "COMPLETED", times))).alias("completed_orders"),
        whole(F.sum(F.when(F.col("status") == "CANCELLED", times))).alias("cancelled_orders"))
    bought = (items.select("order_id", "product_id", "quantity")
              .join(placed.select(F.col("id").alias("order_id"), "user_id"), "order_id")
              .groupBy("user_id", "product_id").agg(F.sum("quantity").alias("quantity"))
              .groupBy("user_id").agg(F.sum("quantity").cast("bigint").alias("total_items"),
                                      F.count("product_id").cast("bigint").alias("unique_products")))
    return (base.join(bought, "user_id", "left").fillna({"unique_products": 0, "total_items": 0})
            .withColumn("avg_items_per_order", ratio(F.col("total_items"), F.col("total_orders"))))


def rfm_segments(metrics: DataFrame, as_of) -> DataFrame:
    """Hot up to 7 days since the last order, Warm 30, Cold 90, else Churned."""
    age = F.datediff(cal.day_of(as_of), F.to_date("last_order_date"))
    segment = (F.when(age <= 7, "Hot").when(age <= 30, "Warm").when(age <= 90, "Cold").otherwise("Churned"))
    return (metrics.groupBy(segment.alias("segment")).agg(
        F.count("*").cast("bigint").alias("customer_count"),
        ratio(F.sum("total_spent"), F.count("*")).alias("avg_ltv"),
        ratio(F.sum("total_orders"), F.count("*")).alias("avg_orders"),
        ratio(F.sum("unique_products"), F.count("*")).alias("avg_product_diversity"))
        .orderBy(F.desc("avg_ltv")))


def top_customers(segments_view: DataFrame, k: int = 100) -> DataFrame:
    return (segments_view.select("user_id", F.col("total_spent").alias("ltv"), "total_orders",
                                 "avg_order_value", "avg_items_per_order")
            .orderBy(F.desc("ltv"), "user_id").limit(k))


def cohort_ltv(orders: DataFrame, as_of, months: int = 6) -> DataFrame:
    """Completed orders by month of the first one and age of the customer."""
    done = alive(orders).filter(F.col("status") == "COMPLETED")
    per_user = done.groupBy("user_id").agg(
        F.min("created_at").alias("first_at"), F.max("created_at").alias("last_at"),
        F.count("*").alias("orders"), F.sum("total_amount").alias("revenue"))
    oldest = cal.month_start(cal.moment(as_of) - F.expr(f"INTERVAL {months} MONTH"))
    return (per_user.select(
        cal.month_start(F.col("first_at")).alias("cohort_month"),
        cal.month_gap(F.col("first_at"), F.col("last_at")).cast("bigint").alias("customer_age_months"),
        "orders", "revenue")
        .filter(F.col("cohort_month") >= oldest)
        .groupBy("cohort_month", "customer_age_months").agg(
            F.count("*").cast("bigint").alias("customers_in_cohort"),
            ratio(F.sum("revenue"), F.count("*")).alias("avg_ltv"),
            ratio(F.sum("orders"), F.count("*")).alias("avg_orders"))
        .orderBy(F.desc("cohort_month"), "customer_age_months"))


# --- products --------------------------------------------------------------

def repeat_purchase(items: DataFrame, orders: DataFrame, min_customers: int = 5, k: int = 20,
                    count_people: bool = False) -> DataFrame:
    """Products bought again, by name.

    ``repeat_customers`` counts item lines of repeat buyers; ``count_people=True``
    counts the buyers themselves.
    """
    lines = staged(sold_lines(items, orders, keep_cancelled=True)
                   .groupBy("product_id", "user_id", "product_name", "order_id").agg(F.count("*").alias("n_lines")),
                   "bought-lines")
    named = lines.groupBy("product_id", "user_id", "product_name").agg(F.sum("n_lines").alias("n_lines"))
    bought = lines.groupBy("product_id", "user_id").agg(
        F.count_distinct("order_id").cast("bigint").alias("purchases"))
    both = named.join(bought, ["product_id", "user_id"], "left")
    again = F.col("purchases") > 1
    per_user = both.groupBy("product_name", "user_id").agg(
        F.sum(F.when(again, F.col("n_lines")).otherwise(0)).alias("repeat_lines"),
        F.max(again).alias("is_repeat"),
        F.sum(F.col("purchases") * F.col("n_lines")).alias("weighted"),
        F.sum("n_lines").alias("n_lines"))
    repeat = F.count_if("is_repeat") if count_people else F.sum("repeat_lines")
    return (per_user.groupBy("product_name").agg(
        F.count("*").cast("bigint").alias("total_customers"),
        whole(repeat).alias("repeat_customers"),
        ratio(F.sum("weighted"), F.sum("n_lines")).alias("avg_purchase_frequency"))
        .filter(F.col("total_customers") >= min_customers)
        .withColumn("repeat_rate", ratio(F.col("repeat_customers"), F.col("total_customers"), 100.0))
        .orderBy(F.desc("repeat_rate"), "product_name").limit(k))


def stock_projection(daily: DataFrame, as_of, days: int = 30, stock: int = 1000, k: int = 20) -> DataFrame:
    """Days until a stock of ``stock`` units sells out at the recent pace."""
    recent = cal.rows_of_days(daily, as_of, days, "sale_date")
    sold = F.col("total_sold_30d")
    return (recent.groupBy("product_name").agg(
        whole(F.sum("total_quantity")).alias("total_sold_30d"),
        total("total_revenue").alias("revenue_30d"))
        .filter(sold > 0)
        .withColumn("avg_daily_sales", ratio(sold, F.lit(days)))
        .withColumn("days_until_stockout", ratio(F.lit(stock * days), sold))
        .orderBy(F.desc("total_sold_30d"), "product_name").limit(k))


# --- trends ----------------------------------------------------------------
# The windows below have no partition: they run over one row per day or week of
# the period, so their size is set by the calendar and not by the data.

def weekly_growth(orders: DataFrame, as_of, weeks: int = 12) -> DataFrame:
    done = cal.rows_since(alive(orders), as_of, f"{weeks} WEEK").filter(F.col("status") == "COMPLETED")
    weekly = done.groupBy(cal.monday(F.col("created_at")).alias("week_start")).agg(
        total("total_amount").alias("revenue"), F.count("*").cast("bigint").alias("order_count"))
    before = F.lag("revenue").over(Window.orderBy("week_start"))
    return (weekly.withColumn("prev_week_revenue", before)
            .withColumn("growth_rate_percent",
                        ratio(F.col("revenue") - F.col("prev_week_revenue"), F.col("prev_week_revenue"), 100.0))
            .orderBy(F.desc("week_start")))


def revenue_forecast(orders: DataFrame, as_of, days: int = 30, k: int = 30) -> DataFrame:
    """Daily revenue, 7-row moving average and the value a 30-row regression line
    takes at the current day (NULL where one point leaves the line open).

    The line comes from exact integer sums of day numbers and cents.
    """
    done = cal.rows_since(alive(orders), as_of, f"{days} DAY").filter(F.col("status") == "COMPLETED")
    daily = done.groupBy(F.to_date("created_at").alias("date")).agg(total("total_amount").alias("actual_revenue"))
    x = F.datediff("date", F.date_sub(cal.day_of(as_of), days)).cast("bigint")
    y = (F.col("actual_revenue") * 100).cast("bigint")
    by_day = Window.orderBy("date")
    week, month = by_day.rowsBetween(-6, 0), by_day.rowsBetween(-29, 0)
    sums = daily.select(
        "date", "actual_revenue", x.alias("x"),
        F.sum(y).over(week).alias("y7"), F.count("*").over(week).alias("n7"),
        F.count("*").over(month).alias("n"), F.sum(x).over(month).alias("sx"), F.sum(y).over(month).alias("sy"),
        F.sum(x * y).over(month).alias("sxy"), F.sum(x * x).over(month).alias("sxx"))
    d = lambda name: F.col(name).cast("double")
    spread = d("n") * d("sxx") - d("sx") * d("sx")
    slope = F.try_divide(d("n") * d("sxy") - d("sx") * d("sy"), spread)
    fitted = (d("sy") + slope * (d("n") * d("x") - d("sx"))) / d("n") / 100.0
    return (sums.select("date", "actual_revenue",
                        rounded(d("y7") / d("n7") / 100.0, 2).alias("moving_avg_7d"),
                        rounded(fitted, 2).alias("predicted_revenue"))
            .orderBy(F.desc("date")).limit(k))


def volume_decomposition(orders: DataFrame, as_of, days: int = 60) -> DataFrame:
    """Daily orders, 7-row trend and the mean of days on the weekday of ``as_of``."""
    recent = cal.rows_since(alive(orders), as_of, f"{days} DAY")
    daily = recent.groupBy(F.to_date("created_at").alias("date")).agg(
        F.count("*").cast("bigint").alias("daily_orders"))
    week = Window.orderBy("date").rowsBetween(-6, 0)
    same = F.when(cal.iso_weekday(F.col("date")) == cal.iso_weekday(cal.day_of(as_of)), F.col("daily_orders"))
    everything = Window.partitionBy()
    return (daily.withColumn("trend_7d", ratio(F.sum("daily_orders").over(week), F.count("*").over(week)))
            .withColumn("seasonal_pattern", ratio(F.sum(same).over(everything), F.count(same).over(everything)))
            .orderBy(F.desc("date")))


# --- order lists and checks ------------------------------------------------

def deleted_stats(orders: DataFrame) -> DataFrame:
    return (orders.filter(F.col("deleted_at").isNotNull())
            .groupBy(F.to_date("deleted_at").alias("delete_date")).agg(
                F.count("*").cast("bigint").alias("deleted_orders"), total("total_amount").alias("lost_revenue"))
            .orderBy(F.desc("delete_date")))


def deleted_orders(orders: DataFrame, k: int = 100) -> DataFrame:
    return (orders.filter(F.col("deleted_at").isNotNull())
            .select("id", "user_id", "status", "total_amount", "created_at", "deleted_at")
            .orderBy(F.desc("deleted_at"), "id").limit(k))


def active_order_list(orders: DataFrame) -> DataFrame:
    return (active(orders).orderBy(F.desc("created_at"))
            .select("id", "user_id", "status", "total_amount"))


def order_summaries(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders that have items, with item count and item total (pre-aggregated)."""
    totals = alive(items).groupBy(F.col("order_id").alias("id")).agg(
        F.count("*").cast("bigint").alias("item_count"), total("subtotal").alias("total"))
    return alive(orders).select("id", "status").join(totals, "id")


def status_statistics(orders: DataFrame) -> DataFrame:
    """Count and revenue per status, each with the grand totals."""
    per_status = orders.groupBy("status").agg(
        F.count("*").cast("bigint").alias("order_count"), total("total_amount").alias("total_revenue"))
    everything = Window.partitionBy()
    return (per_status.withColumn("all_orders", F.sum("order_count").over(everything))
            .withColumn("all_revenue", F.sum("total_revenue").over(everything).cast("decimal(18,2)"))
            .orderBy("status"))


def category_counts(products: DataFrame) -> DataFrame:
    """Products and stock per category; unnamed categories get a label afterwards."""
    return (products.groupBy("category").agg(
        F.count("*").cast("bigint").alias("product_count"), whole(F.sum("stock")).alias("total_stock"))
        .withColumn("category", F.coalesce(F.nullif(F.col("category"), F.lit("")), F.lit("Uncategorized")))
        .orderBy("category"))
