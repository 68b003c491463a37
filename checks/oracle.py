"""The same results in SQL over the plain tables, for DuckDB."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

BASE = """
o_log AS (
  SELECT o_orderkey AS id, o_custkey AS user_id,
         CASE WHEN o_orderkey % 20 = 0 THEN 'CANCELLED' WHEN o_orderstatus = 'F' THEN 'COMPLETED'
              WHEN o_orderstatus = 'P' THEN 'PROCESSING' ELSE 'PENDING' END AS status,
         CAST(o_totalprice AS DECIMAL(10,2)) AS total_amount,
         o_orderdate AS created_at, o_orderdate AS updated_at,
         CASE WHEN o_orderkey % 50 = 7 THEN o_orderdate + INTERVAL 1 DAY END AS deleted_at,
         CASE WHEN o_orderkey % 97 = 3 THEN 'd' WHEN o_orderkey % 3 = 0 THEN 'u' ELSE 'c' END AS cdc_op,
         epoch_ms(o_orderdate) AS cdc_ts_ms
  FROM orders),
i_log AS (
  SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS order_id, l_partkey AS product_id,
         p_name AS product_name, CAST(l_quantity AS INTEGER) AS quantity,
         CAST(p_retailprice AS DECIMAL(10,2)) AS price, CAST(l_extendedprice AS DECIMAL(10,2)) AS subtotal,
         l_shipdate AS created_at, l_shipdate AS updated_at, CAST(NULL AS TIMESTAMP) AS deleted_at,
         CASE WHEN (l_orderkey + l_linenumber) % 41 = 0 THEN 'd' ELSE 'u' END AS cdc_op,
         epoch_ms(l_shipdate) AS cdc_ts_ms
  FROM lineitem JOIN part ON p_partkey = l_partkey),
o AS (SELECT * FROM o_log QUALIFY row_number() OVER (PARTITION BY id ORDER BY cdc_ts_ms DESC) = 1),
i AS (SELECT * FROM i_log QUALIFY row_number() OVER (PARTITION BY id ORDER BY cdc_ts_ms DESC, product_id DESC) = 1),
eo AS (
  SELECT event_id AS id, user_id,
         CASE WHEN user_id % 10 = 0 THEN 'CANCELLED' WHEN user_id % 10 < 7 THEN 'COMPLETED' ELSE 'PENDING' END AS status,
         CAST(value AS DECIMAL(10,2)) AS total_amount, ts AS created_at, CAST(NULL AS TIMESTAMP) AS deleted_at,
         'c' AS cdc_op
  FROM events WHERE event_type = 'purchase'),
ei AS (
  SELECT event_id AS id, event_id AS order_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_id,
         'product ' || CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) // 2 AS VARCHAR) AS product_name,
         1 AS quantity, CAST(value AS DECIMAL(10,2)) AS price, CAST(value AS DECIMAL(10,2)) AS subtotal,
         ts AS created_at, CAST(NULL AS TIMESTAMP) AS deleted_at, 'c' AS cdc_op
  FROM events WHERE event_type = 'purchase'),
usr AS (
  SELECT c_custkey AS id, c_name AS username, lower(replace(c_name, '#', '.')) || '@shop.example' AS email,
         c_mktsegment AS segment FROM customer),
prod AS (
  SELECT p_partkey AS id, p_name AS name, p_type AS category, CAST(p_retailprice AS DECIMAL(10,2)) AS price,
         p_size AS stock FROM part)
"""

AS_OF = "TIMESTAMP '2001-08-01 00:00:00'"
EVENTS_AS_OF = "TIMESTAMP '2024-01-30 12:00:00'"
TODAY = "DATE '2001-08-01'"


def add(name: str, body: str, *ctes: str) -> None:
    ORACLE[name] = "WITH RECURSIVE " + ",\n".join([BASE.strip(), *ctes]) + "\n" + body


def r4(part: str, base: str, factor: float | None = None, digits: int = 4) -> str:
    """Half-up ratio in plain double arithmetic; NULL for a zero base."""
    step = f"CAST({10 ** digits} AS DOUBLE)"
    times = f" * CAST({factor} AS DOUBLE)" if factor is not None else ""
    return (f"floor(CAST({part} AS DOUBLE){times} / nullif(CAST({base} AS DOUBLE), 0) * {step}"
            f" + CAST(0.5 AS DOUBLE)) / {step}")


def money(expr: str) -> str:
    return f"CAST(coalesce({expr}, 0) AS DECIMAL(18,2))"


def big(expr: str) -> str:
    return f"CAST(coalesce({expr}, 0) AS BIGINT)"


# --- sources, routing, parsing ---------------------------------------------

add("s01_snapshot_then_changes", """
SELECT id, status, total_amount, CASE WHEN cdc_op = 'c' THEN 'r' ELSE cdc_op END AS cdc_op,
       CASE WHEN cdc_op = 'c' THEN cdc_ts_ms - 1 ELSE cdc_ts_ms END AS cdc_ts_ms FROM o""")
add("s02_orders_only_source", "SELECT cdc_op, count(*) AS row_count FROM o_log GROUP BY cdc_op")
add("s03_items_only_source", "SELECT cdc_op, count(*) AS row_count FROM i_log GROUP BY cdc_op")
add("s04_start_at_timestamp", """
SELECT 'orders' AS table_name, count(*) AS events FROM o_log WHERE cdc_ts_ms >= 946684800000
UNION ALL SELECT 'order_items', count(*) FROM i_log WHERE cdc_ts_ms >= 946684800000""")
add("s04_start_at_offset", "SELECT count(*) AS events, min(id) AS first_id FROM o_log WHERE id >= 100")
add("p02_events_by_table_and_op", """
SELECT t AS table_name, ops.op, coalesce(n, 0) AS events
FROM (SELECT unnest(['orders', 'order_items']) AS t), (SELECT unnest(['c', 'u', 'd', 'r']) AS op) ops
LEFT JOIN (SELECT 'orders' AS t2, cdc_op, count(*) AS n FROM o_log GROUP BY cdc_op
           UNION ALL SELECT 'order_items', cdc_op, count(*) FROM i_log GROUP BY cdc_op) c
  ON c.t2 = t AND c.cdc_op = ops.op""")
add("p05_bad_events", """
SELECT CASE WHEN id % 11 = 0 THEN 'not json' WHEN id % 13 = 0 THEN 'no image' ELSE 'missing user_id' END AS reason,
       CASE WHEN id % 11 = 0 THEN 'broken ' || id WHEN id % 13 = 0 THEN '{"op":"u","after":null,"ts_ms":' || id || '}' END AS event,
       CASE WHEN id % 11 <> 0 AND id % 13 <> 0 THEN id END AS id,
       CASE WHEN id % 11 <> 0 AND id % 13 <> 0 THEN status END AS status,
       CASE WHEN id % 11 = 0 THEN NULL WHEN id % 13 = 0 THEN id ELSE cdc_ts_ms END AS cdc_ts_ms
FROM o_log WHERE id % 11 = 0 OR id % 13 = 0 OR id % 17 = 0""")
add("p04_fan_out", """
SELECT 'orders' AS table_name, count(*) AS record_count FROM o_log
UNION ALL SELECT 'order_items', count(*) FROM i_log""")
add("p07_order_rows", "SELECT * FROM o_log")
add("p08_item_rows", "SELECT * FROM i_log")
add("f01_coercions", """
SELECT event_id AS id, CAST(NULL AS BIGINT) AS order_id, CAST(trunc(value) AS BIGINT) AS product_id,
       event_type AS product_name, CAST(trunc(value) AS INTEGER) AS quantity, CAST(value AS DECIMAL(10,2)) AS price,
       CAST(value AS DECIMAL(10,2)) AS subtotal, make_timestamp(epoch_us(ts) // 1000 * 1000) AS created_at,
       date_trunc('second', ts) AS updated_at, CAST(NULL AS TIMESTAMP) AS deleted_at, 'c' AS cdc_op,
       epoch_us(ts) // 1000 AS cdc_ts_ms FROM events""")
add("p10_op_labels", """
SELECT CASE cdc_op WHEN 'u' THEN 'UPDATE' WHEN 'd' THEN 'DELETE' ELSE 'INSERT' END AS operation_type,
       count(*) AS events FROM o_log GROUP BY 1""")

# --- versions and row views -------------------------------------------------

add("v01_current_orders", "SELECT * FROM o")
for name in ("v01_current_items", "v02_merge_changes", "v02_compacted_snapshot", "v02_compacted_changes"):
    add(name, "SELECT * FROM i")

LINES = """
lines AS (
  SELECT i.*, o.user_id, o.status, o.created_at AS ordered_at FROM i JOIN o ON o.id = i.order_id
  WHERE i.cdc_op <> 'd' AND o.cdc_op <> 'd' AND o.status <> 'CANCELLED')"""
DAILY_SELECT = f"""
  SELECT CAST(created_at AS DATE) AS sale_date, product_id, min(product_name) AS product_name,
         count(DISTINCT order_id) AS order_count, {big('sum(quantity)')} AS total_quantity,
         {money('sum(subtotal)')} AS total_revenue, count(DISTINCT user_id) AS unique_customers"""
DAILY = f"daily AS ({DAILY_SELECT} FROM lines GROUP BY 1, 2)"
DAILY_VIEW = f"daily_view AS (SELECT *, {r4('total_revenue', 'total_quantity')} AS avg_price FROM daily)"

add("v03_product_daily_all_versions", DAILY_SELECT + """
FROM (SELECT i.*, o.user_id FROM i_log i JOIN o_log o ON o.id = i.order_id
      WHERE i.cdc_op <> 'd' AND o.cdc_op <> 'd' AND o.status <> 'CANCELLED') GROUP BY 1, 2""")
for name in ("v09_retained_months", "v09_removed_months"):
    add(name, "SELECT id, created_at FROM o WHERE created_at >= TIMESTAMP '2001-02-01'")
add("v09_expired_months", """
SELECT CAST(year(created_at) * 100 + month(created_at) AS BIGINT) AS yyyymm, count(*) AS row_count
FROM o WHERE created_at < TIMESTAMP '2001-02-01' GROUP BY 1""")
add("v10_purged_orders", f"""
SELECT id, deleted_at FROM o WHERE deleted_at IS NULL OR deleted_at >= {AS_OF} - INTERVAL 6 MONTH""")
add("v11_restored_orders", f"""
SELECT id, CASE WHEN back THEN NULL ELSE deleted_at END AS deleted_at, CASE WHEN back THEN 'u' ELSE cdc_op END AS cdc_op,
       CASE WHEN back THEN greatest(epoch_ms({AS_OF}), cdc_ts_ms + 1) ELSE cdc_ts_ms END AS cdc_ts_ms
FROM (SELECT *, cdc_op <> 'd' AND deleted_at IS NOT NULL AS back FROM o)""")
add("v12_signed_totals", f"""
SELECT product_id, count(*) AS row_count, {money('sum(subtotal)')} AS subtotal
FROM i WHERE cdc_op <> 'd' GROUP BY product_id""")
add("p11_active_orders", "SELECT * FROM o WHERE deleted_at IS NULL AND cdc_op <> 'd'")
add("p12_active_items", "SELECT * FROM i WHERE deleted_at IS NULL AND cdc_op <> 'd'")
add("p14_deleted_orders", """
SELECT id, user_id, status, total_amount, created_at, deleted_at FROM o
WHERE deleted_at IS NOT NULL ORDER BY deleted_at DESC, id LIMIT 100""")
add("p15_active_order_list", """
SELECT id, user_id, status, total_amount FROM o WHERE deleted_at IS NULL AND cdc_op <> 'd'""")
add("p16_orders_by_status", "SELECT id, user_id, status FROM o WHERE deleted_at IS NULL AND status = 'PENDING'")
add("p16_orders_of_user", "SELECT id, user_id, status FROM o WHERE deleted_at IS NULL AND user_id = 42")
add("p17_products_by_category", "SELECT * FROM prod WHERE category = 'ECONOMY'")
add("p18_user_by_name", "SELECT * FROM usr WHERE username = 'Customer#000000042'")
add("p18_user_by_email", "SELECT * FROM usr WHERE email = 'customer.000000042@shop.example'")
add("p18_order_by_id", "SELECT id, user_id, status, total_amount FROM o WHERE id = 42")
add("p18_product_by_id", "SELECT * FROM prod WHERE id = 42")
add("p20_deleted_policies", """
SELECT 'exclude' AS table_name, count(*) AS record_count FROM o WHERE deleted_at IS NULL
UNION ALL SELECT 'include', count(*) FROM o
UNION ALL SELECT 'only', count(*) FROM o WHERE deleted_at IS NOT NULL""")
add("p21_priced_items", "SELECT id, quantity, price, CAST(quantity * price AS DECIMAL(18,2)) AS subtotal FROM i")
add("p21_order_totals", f"SELECT order_id, {money('sum(quantity * price)')} AS total_amount FROM i GROUP BY order_id")
add("f06_calendar_parts", """
SELECT event_id, CAST(ts AS DATE) AS day, date_trunc('hour', ts) AS hour_start, CAST(hour(ts) AS BIGINT) AS hour,
       CAST(date_trunc('week', ts) AS DATE) AS monday, CAST(date_trunc('month', ts) AS DATE) AS month_start,
       CAST(year(ts) * 100 + month(ts) AS BIGINT) AS yyyymm, CAST(isodow(ts) AS BIGINT) AS weekday,
       date_diff('day', CAST(ts AS DATE), DATE '2024-01-30') AS days_ago,
       date_diff('month', CAST(ts AS DATE), DATE '2024-03-01') AS months_ago,
       epoch_ms(date_trunc('second', ts)) // 1000 AS unix_seconds,
       date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS epoch_day
FROM events""")
add("f23_display_text", """
SELECT id, CASE status WHEN 'PENDING' THEN '대기중' WHEN 'PROCESSING' THEN '처리중' WHEN 'COMPLETED' THEN '완료'
                       WHEN 'CANCELLED' THEN '취소됨' END AS label,
       '₩' || format('{:,}', CAST(round_even(total_amount, 0) AS BIGINT)) AS amount,
       strftime(created_at, '%Y. %m. %d. %H:%M:%S') AS placed FROM o""")

# --- rollups ------------------------------------------------------------------

add("q01_product_daily", "SELECT * FROM daily", LINES, DAILY)
add("j11_kept_product_daily", "SELECT * FROM daily", LINES, DAILY)
add("s18_backfilled_rollup", "SELECT * FROM daily", LINES, DAILY)
add("d08_touched_keys_refresh", "SELECT * FROM daily", LINES, DAILY)
add("q01_product_daily_active", DAILY_SELECT + """
FROM (SELECT i.*, o.user_id FROM i JOIN o ON o.id = i.order_id
      WHERE i.cdc_op <> 'd' AND o.cdc_op <> 'd' AND o.status <> 'CANCELLED'
        AND i.deleted_at IS NULL AND o.deleted_at IS NULL) GROUP BY 1, 2""")
add("q02_product_daily_view", "SELECT * FROM daily_view", LINES, DAILY, DAILY_VIEW)
add("v04_additive_merge", f"""
SELECT sale_date, product_id, min(product_name) AS product_name, {big('sum(order_count)')} AS order_count,
       {big('sum(total_quantity)')} AS total_quantity, {money('sum(total_revenue)')} AS total_revenue,
       {big('sum(unique_customers)')} AS unique_customers
FROM ({DAILY_SELECT}, date_trunc('month', ordered_at) AS batch FROM lines GROUP BY sale_date, product_id, batch)
GROUP BY sale_date, product_id""", LINES)


def segments(weighted: bool) -> str:
    rows = ("SELECT o.*, t.q FROM o LEFT JOIN (SELECT order_id, sum(quantity) AS q FROM i WHERE cdc_op <> 'd' "
            "GROUP BY order_id) t ON t.order_id = o.id WHERE o.cdc_op <> 'd'")
    if weighted:
        rows = ("SELECT o.*, i.quantity AS q FROM o LEFT JOIN i ON i.order_id = o.id AND i.cdc_op <> 'd' "
                "WHERE o.cdc_op <> 'd'")
    return f"""
seg AS (
  SELECT user_id, count(DISTINCT id) AS total_orders, {big('sum(CAST(total_amount * 100 AS BIGINT))')} AS total_spent_cents,
         {big('sum(q)')} AS total_items, count(*) FILTER (WHERE status = 'COMPLETED') AS completed_orders,
         count(*) FILTER (WHERE status = 'CANCELLED') AS cancelled_orders
  FROM ({rows}) GROUP BY user_id)"""


SEG_VIEW = f"""
seg_view AS (
  SELECT user_id, total_orders, CAST(total_spent_cents / 100.0 AS DECIMAL(18,2)) AS total_spent, total_items,
         {r4('total_spent_cents', 'total_orders * 100')} AS avg_order_value,
         {r4('total_items', 'total_orders')} AS avg_items_per_order, completed_orders, cancelled_orders
  FROM seg)"""
add("q03_customer_segments", "SELECT * FROM seg", segments(False))
add("d08_touched_customers_refresh", "SELECT * FROM seg", segments(False))
add("j11_kept_customer_segments", "SELECT * FROM seg", segments(False))
add("q03_customer_segments_literal", "SELECT * FROM seg", segments(True))
add("q04_customer_segments_view", "SELECT * FROM seg_view", segments(False), SEG_VIEW)
add("q04_customer_segments_view_literal", "SELECT * FROM seg_view", segments(True), SEG_VIEW)


def hourly(items: str, orders: str, keys: str, name: str = "") -> str:
    return f"""
  SELECT date_trunc('hour', i.created_at) AS hour_timestamp, {keys}, {name}
         count(DISTINCT i.order_id) AS orders, {big('sum(i.quantity)')} AS quantity,
         {money('sum(i.subtotal)')} AS revenue, {r4('sum(i.price)', 'count(i.price)')} AS avg_price
  FROM {items} i JOIN {orders} o ON o.id = i.order_id
  WHERE i.cdc_op <> 'd' AND o.cdc_op <> 'd' AND o.status <> 'CANCELLED'
  GROUP BY date_trunc('hour', i.created_at), {keys}"""


add("q05_hourly_sales", hourly("ei", "eo", "i.product_id", "min(i.product_name) AS product_name,"))
add("q05_hourly_sales_view", hourly("ei", "eo", "i.product_name"))
add("j11_kept_hourly_sales", hourly("i", "o", "i.product_id", "min(i.product_name) AS product_name,"))
add("q05_hourly_sales_view_lineitem", hourly("i", "o", "i.product_name"))
CART = f"""
cart AS (
  SELECT CAST(created_at AS DATE) AS order_date, count(DISTINCT id) AS total_orders,
         count(*) FILTER (WHERE status = 'COMPLETED') AS completed_orders
  FROM o WHERE cdc_op <> 'd' GROUP BY 1),
cart_view AS (SELECT *, {r4('completed_orders', 'total_orders', 100)} AS completion_rate FROM cart WHERE total_orders > 0)"""
for name in ("q06_cart_analytics_view", "d08_touched_days_refresh", "j11_kept_cart_analytics"):
    add(name, "SELECT * FROM cart_view", CART)
for name in ("v05_distinct_orders_rows", "v05_distinct_orders_bitmaps"):
    add(name, "SELECT user_id, count(DISTINCT id) AS total_orders FROM o GROUP BY user_id")
add("v05_distinct_buyers_sketch",
    "SELECT status, count(DISTINCT user_id) AS exact, TRUE AS close FROM o GROUP BY status")
add("v08_sum_and_mean_states", f"""
SELECT user_id, {money('sum(total_amount)')} AS total, count(total_amount) AS n,
       {r4('sum(total_amount)', 'count(total_amount)')} AS mean FROM o GROUP BY user_id""")

# --- reports ------------------------------------------------------------------


def sales_by(key: str, source: str) -> str:
    return f"""
SELECT {key}, count(DISTINCT order_id) AS order_count, {big('sum(quantity)')} AS quantity_sold,
       {money('sum(subtotal)')} AS revenue, {r4('sum(price)', 'count(price)')} AS avg_price
FROM {source} GROUP BY {key} ORDER BY revenue DESC, {key} LIMIT 10"""


def now_lines(items: str, orders: str, as_of: str) -> str:
    return f"""(SELECT i.* FROM {items} i JOIN {orders} o ON o.id = i.order_id
  WHERE i.created_at BETWEEN {as_of} - INTERVAL 1 HOUR AND {as_of} AND i.cdc_op <> 'd' AND o.status <> 'CANCELLED')"""


add("q07_bestsellers_now", sales_by("product_name", now_lines("i", "o", AS_OF)))
add("q07_bestsellers_now_events", sales_by("product_name", now_lines("ei", "eo", EVENTS_AS_OF)))
add("q08_kpi_orders", f"""
SELECT count(DISTINCT id) AS total_orders, {money('sum(total_amount)')} AS total_revenue,
       {r4('sum(total_amount)', 'count(*)')} AS avg_order_value, count(DISTINCT user_id) AS unique_customers
FROM o WHERE deleted_at IS NULL AND cdc_op <> 'd' AND CAST(created_at AS DATE) = {TODAY}""")


def kpi(items: str, orders: str, day: str, fan_out: bool) -> str:
    joined = (f"SELECT o.*, i.product_id, i.quantity FROM {orders} o LEFT JOIN {items} i ON i.order_id = o.id "
              f"WHERE CAST(o.created_at AS DATE) = {day} AND o.cdc_op <> 'd'")
    base = f"SELECT * FROM {orders} o WHERE CAST(created_at AS DATE) = {day} AND cdc_op <> 'd'"
    source = joined if fan_out else base
    return f"""
SELECT count(DISTINCT id) AS total_orders, {money('sum(total_amount)')} AS total_revenue,
       {r4('sum(total_amount)', 'count(*)')} AS avg_order_value, count(DISTINCT user_id) AS unique_customers,
       (SELECT {big('sum(quantity)')} FROM ({joined})) AS total_items_sold,
       (SELECT count(DISTINCT product_id) FROM ({joined})) AS unique_products_sold,
       {r4("count(*) FILTER (WHERE status = 'COMPLETED')", 'count(DISTINCT id)', 100)} AS completion_rate
FROM ({source})"""


add("q09_kpi_with_items", kpi("ei", "eo", "DATE '2024-01-30'", False))
add("q09_kpi_with_items_literal", kpi("i", "o", TODAY, True))
add("q10_orders_by_hour", f"""
SELECT hour(eo.created_at) AS hour, count(DISTINCT eo.id) AS order_count, {money('sum(total_amount)')} AS revenue,
       {r4('sum(coalesce(n, 0))', 'count(*)')} AS avg_items_per_order
FROM eo LEFT JOIN (SELECT order_id, count(*) AS n FROM ei WHERE CAST(created_at AS DATE) = DATE '2024-01-30'
                   AND cdc_op <> 'd' GROUP BY order_id) t ON t.order_id = eo.id
WHERE CAST(eo.created_at AS DATE) = DATE '2024-01-30' AND cdc_op <> 'd' GROUP BY 1""")
add("q11_category_sales", sales_by("category", f"""
(SELECT *, split_part(product_name, ' ', 1) AS category FROM i
 WHERE CAST(created_at AS DATE) = {TODAY} AND cdc_op <> 'd')"""))
add("q12_bestsellers_day", f"""
SELECT product_name, {big('sum(total_quantity)')} AS quantity_sold, {money('sum(total_revenue)')} AS revenue,
       {big('sum(unique_customers)')} AS customers
FROM daily WHERE sale_date = {TODAY} GROUP BY product_name ORDER BY revenue DESC, product_name LIMIT 10""", LINES, DAILY)


def metrics(fan_out: bool) -> str:
    joined = ("SELECT o.*, i.product_id, i.quantity FROM o LEFT JOIN i ON i.order_id = o.id WHERE o.cdc_op <> 'd'")
    source = joined if fan_out else "SELECT * FROM o WHERE cdc_op <> 'd'"
    return f"""
joined AS ({joined}),
metrics AS (
  SELECT a.*, b.total_items, {r4('b.total_items', 'a.total_orders')} AS avg_items_per_order, b.unique_products
  FROM (SELECT user_id, max(created_at) AS last_order_date, count(DISTINCT id) AS total_orders,
               {money('sum(total_amount)')} AS total_spent, {r4('sum(total_amount)', 'count(*)')} AS avg_order_value,
               count(*) FILTER (WHERE status = 'COMPLETED') AS completed_orders,
               count(*) FILTER (WHERE status = 'CANCELLED') AS cancelled_orders
        FROM ({source}) GROUP BY user_id) a
  JOIN (SELECT user_id, {big('sum(quantity)')} AS total_items, count(DISTINCT product_id) AS unique_products
        FROM joined GROUP BY user_id) b USING (user_id))"""


RFM = f"""
SELECT segment, count(*) AS customer_count, {r4('sum(total_spent)', 'count(*)')} AS avg_ltv,
       {r4('sum(total_orders)', 'count(*)')} AS avg_orders,
       {r4('sum(unique_products)', 'count(*)')} AS avg_product_diversity
FROM (SELECT *, CASE WHEN d <= 7 THEN 'Hot' WHEN d <= 30 THEN 'Warm' WHEN d <= 90 THEN 'Cold' ELSE 'Churned' END AS segment
      FROM (SELECT *, date_diff('day', CAST(last_order_date AS DATE), {TODAY}) AS d FROM metrics)) GROUP BY segment"""
add("q13_customer_metrics", "SELECT * FROM metrics", metrics(False))
add("q13_customer_metrics_literal", "SELECT * FROM metrics", metrics(True))
add("q13_rfm_segments", RFM, metrics(False))
add("q13_rfm_segments_literal", RFM, metrics(True))
add("q14_top_customers", """
SELECT user_id, total_spent AS ltv, total_orders, avg_order_value, avg_items_per_order
FROM seg_view ORDER BY ltv DESC, user_id LIMIT 100""", segments(False), SEG_VIEW)
add("q15_hourly_trend", f"""
SELECT hour_timestamp, product_name, orders, quantity, revenue
FROM ({hourly('ei', 'eo', 'i.product_name')}) WHERE hour_timestamp BETWEEN {EVENTS_AS_OF} - INTERVAL 24 HOUR AND {EVENTS_AS_OF}""")
add("q16_cart_trend", f"SELECT * FROM cart_view WHERE order_date BETWEEN {TODAY} - 7 AND {TODAY}", CART)


def cart_metrics(fan_out: bool) -> str:
    counts = ("(SELECT order_id, count(*) AS n FROM i WHERE cdc_op <> 'd' GROUP BY order_id) c ON c.order_id = o.id")
    if fan_out:
        return f"""
SELECT CAST(o.created_at AS DATE) AS order_date, {r4('sum(coalesce(n, 0))', 'count(*)')} AS avg_items_per_order,
       {r4('sum(total_amount)', 'count(*)')} AS avg_order_value,
       {r4('sum(coalesce(i.price, 0))', 'count(*)')} AS avg_item_price, count(DISTINCT o.id) AS total_orders,
       count(*) FILTER (WHERE status = 'COMPLETED') AS completed_orders,
       {r4("count(*) FILTER (WHERE status = 'COMPLETED')", 'count(DISTINCT o.id)', 100)} AS completion_rate
FROM o LEFT JOIN i ON i.order_id = o.id LEFT JOIN {counts} WHERE o.cdc_op <> 'd' GROUP BY 1"""
    return f"""
SELECT CAST(o.created_at AS DATE) AS order_date, {r4('sum(coalesce(n, 0))', 'count(*)')} AS avg_items_per_order,
       {r4('sum(total_amount)', 'count(*)')} AS avg_order_value, {r4('sum(p.s)', 'sum(p.m)')} AS avg_item_price,
       count(*) AS total_orders, count(*) FILTER (WHERE status = 'COMPLETED') AS completed_orders,
       {r4("count(*) FILTER (WHERE status = 'COMPLETED')", 'count(*)', 100)} AS completion_rate
FROM o LEFT JOIN {counts}
LEFT JOIN (SELECT order_id, sum(price) AS s, count(*) AS m FROM i GROUP BY order_id) p ON p.order_id = o.id
WHERE o.cdc_op <> 'd' GROUP BY 1"""


add("q16_cart_metrics", cart_metrics(False))
add("q16_cart_metrics_literal", cart_metrics(True))


def repeat(people: bool) -> str:
    again = "count(DISTINCT CASE WHEN n > 1 THEN user_id END)" if people else "count(*) FILTER (WHERE n > 1)"
    return f"""
SELECT *, {r4('repeat_customers', 'total_customers', 100)} AS repeat_rate FROM (
  SELECT product_name, count(DISTINCT user_id) AS total_customers, {again} AS repeat_customers,
         {r4('sum(n)', 'count(*)')} AS avg_purchase_frequency
  FROM bought LEFT JOIN (SELECT product_id, user_id, count(DISTINCT order_id) AS n FROM bought GROUP BY ALL) c
    USING (product_id, user_id)
  GROUP BY product_name) WHERE total_customers >= 5 ORDER BY repeat_rate DESC, product_name LIMIT 20"""


BOUGHT = """
bought AS (SELECT i.product_id, i.product_name, i.order_id, o.user_id FROM i JOIN o ON o.id = i.order_id
           WHERE i.cdc_op <> 'd' AND o.cdc_op <> 'd')"""
add("q17_repeat_purchase", repeat(False), BOUGHT)
add("q17_repeat_purchase_people", repeat(True), BOUGHT)


def together(days: int) -> str:
    return f"""
SELECT a.product_name AS product_a, b.product_name AS product_b, count(DISTINCT a.order_id) AS co_purchase_count,
       {r4('sum(a.subtotal + b.subtotal)', 'count(*)')} AS avg_bundle_revenue
FROM i a JOIN i b ON a.order_id = b.order_id AND a.id < b.id
WHERE a.cdc_op <> 'd' AND b.cdc_op <> 'd' AND a.created_at BETWEEN {AS_OF} - INTERVAL {days} DAY AND {AS_OF}
GROUP BY 1, 2 HAVING count(DISTINCT a.order_id) >= 3 ORDER BY co_purchase_count DESC, product_a, product_b LIMIT 20"""


for name in ("q18_bought_together_unordered", "q18_bought_together_unordered_lookup"):
    add(name, f"""
SELECT x.product_name AS product_a, y.product_name AS product_b, count(*) AS co_purchase_count,
       {r4('sum(x.amount + y.amount)', 'count(*)')} AS avg_bundle_revenue
FROM named x JOIN named y ON x.order_id = y.order_id AND x.product_name < y.product_name AND (x.recent OR y.recent)
GROUP BY 1, 2 HAVING count(*) >= 3 ORDER BY co_purchase_count DESC, product_a, product_b LIMIT 20""", f"""
named AS (SELECT order_id, product_name, sum(subtotal) AS amount,
                 bool_or(created_at BETWEEN {AS_OF} - INTERVAL 900 DAY AND {AS_OF}) AS recent
          FROM i WHERE cdc_op <> 'd' GROUP BY ALL)""")
add("q18_bought_together", together(30))
add("q18_bought_together_long", together(900))


def cohort(months: int) -> str:
    return f"""
SELECT cohort_month, customer_age_months, count(*) AS customers_in_cohort, {r4('sum(revenue)', 'count(*)')} AS avg_ltv,
       {r4('sum(orders)', 'count(*)')} AS avg_orders
FROM (SELECT user_id, CAST(date_trunc('month', min(created_at)) AS DATE) AS cohort_month,
             date_diff('month', min(created_at), max(created_at)) AS customer_age_months,
             count(DISTINCT id) AS orders, sum(total_amount) AS revenue
      FROM o WHERE cdc_op <> 'd' AND status = 'COMPLETED' GROUP BY user_id)
WHERE cohort_month >= date_trunc('month', {AS_OF} - INTERVAL {months} MONTH) GROUP BY 1, 2"""


add("q19_cohort_ltv", cohort(6))
add("q19_cohort_ltv_all", cohort(84))
add("q20_weekly_growth", f"""
SELECT week_start, revenue, order_count, prev AS prev_week_revenue,
       {r4('(revenue - prev)', 'prev', 100)} AS growth_rate_percent
FROM (SELECT *, lag(revenue) OVER (ORDER BY week_start) AS prev FROM (
  SELECT CAST(date_trunc('week', created_at) AS DATE) AS week_start, {money('sum(total_amount)')} AS revenue,
         count(DISTINCT id) AS order_count
  FROM o WHERE cdc_op <> 'd' AND status = 'COMPLETED' AND created_at BETWEEN {AS_OF} - INTERVAL 84 DAY AND {AS_OF} GROUP BY 1))""")
add("q21_stock_projection", f"""
SELECT product_name, total_sold_30d, revenue_30d, {r4('total_sold_30d', '30')} AS avg_daily_sales,
       {r4('30000', 'total_sold_30d')} AS days_until_stockout
FROM (SELECT product_name, {big('sum(total_quantity)')} AS total_sold_30d, {money('sum(total_revenue)')} AS revenue_30d
      FROM daily WHERE sale_date BETWEEN {TODAY} - 30 AND {TODAY} GROUP BY product_name)
WHERE total_sold_30d > 0 ORDER BY total_sold_30d DESC, product_name LIMIT 20""", LINES, DAILY)
add("q22_revenue_forecast", f"""
SELECT date, actual_revenue,
       floor(CAST(y7 AS DOUBLE) / CAST(n7 AS DOUBLE) / CAST(100 AS DOUBLE) * CAST(100 AS DOUBLE) + CAST(0.5 AS DOUBLE))
         / CAST(100 AS DOUBLE) AS moving_avg_7d,
       floor((sy + (n * sxy - sx * sy) / nullif(n * sxx - sx * sx, 0) * (n * x - sx)) / n / CAST(100 AS DOUBLE)
         * CAST(100 AS DOUBLE) + CAST(0.5 AS DOUBLE)) / CAST(100 AS DOUBLE) AS predicted_revenue
FROM (SELECT date, actual_revenue, CAST(x AS DOUBLE) AS x, sum(y) OVER week AS y7, count(*) OVER week AS n7,
             CAST(count(*) OVER mon AS DOUBLE) AS n, CAST(sum(x) OVER mon AS DOUBLE) AS sx,
             CAST(sum(y) OVER mon AS DOUBLE) AS sy, CAST(sum(x * y) OVER mon AS DOUBLE) AS sxy,
             CAST(sum(x * x) OVER mon AS DOUBLE) AS sxx
      FROM (SELECT *, date_diff('day', {TODAY} - 30, date) AS x, CAST(actual_revenue * 100 AS BIGINT) AS y FROM (
        SELECT CAST(created_at AS DATE) AS date, {money('sum(total_amount)')} AS actual_revenue FROM o
        WHERE created_at BETWEEN {AS_OF} - INTERVAL 30 DAY AND {AS_OF} AND cdc_op <> 'd' AND status = 'COMPLETED' GROUP BY 1))
      WINDOW week AS (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
             mon AS (ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW))
ORDER BY date DESC LIMIT 30""")
add("q23_volume_decomposition", f"""
SELECT date, daily_orders,
       {r4('sum(daily_orders) OVER week', 'count(*) OVER week')} AS trend_7d,
       {r4('(sum(daily_orders) FILTER (WHERE isodow(date) = isodow(' + TODAY + ')) OVER ())',
           '(count(*) FILTER (WHERE isodow(date) = isodow(' + TODAY + ')) OVER ())')} AS seasonal_pattern
FROM (SELECT CAST(created_at AS DATE) AS date, count(*) AS daily_orders FROM o
      WHERE created_at BETWEEN {AS_OF} - INTERVAL 60 DAY AND {AS_OF} AND cdc_op <> 'd' GROUP BY 1)
WINDOW week AS (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
add("q24_deleted_stats", f"""
SELECT CAST(deleted_at AS DATE) AS delete_date, count(*) AS deleted_orders, {money('sum(total_amount)')} AS lost_revenue
FROM o WHERE deleted_at IS NOT NULL GROUP BY 1""")
add("q25_status_statistics", f"""
SELECT status, count(*) AS order_count, {money('sum(total_amount)')} AS total_revenue,
       (SELECT count(*) FROM o) AS all_orders, (SELECT {money('sum(total_amount)')} FROM o) AS all_revenue
FROM o GROUP BY status""")
add("q26_category_counts", f"""
SELECT coalesce(nullif(category, ''), 'Uncategorized') AS category, count(*) AS product_count,
       {big('sum(stock)')} AS total_stock FROM prod GROUP BY 1""")
add("q27_recent_orders", """
SELECT o.id AS order_id, u.username, u.email, o.status, o.total_amount, o.created_at, i.product_name, i.quantity, i.price, i.subtotal
FROM o JOIN usr u ON u.id = o.user_id JOIN i ON i.order_id = o.id
ORDER BY o.created_at DESC, o.id DESC, i.id LIMIT 20""")
ITEM_TEXT = """
texts AS (SELECT order_id, string_agg(id || ':' || product_id || ':' || quantity || ':' || subtotal, ',' ORDER BY id) AS items
          FROM i GROUP BY order_id)"""
add("q28_order_page", """
SELECT p.id, user_id, status, total_amount, created_at, coalesce(items, '') AS items,
       (SELECT count(*) FROM o WHERE deleted_at IS NULL AND status = 'COMPLETED') AS total, 3 AS page, 10 AS "limit",
       CAST(ceil((SELECT count(*) FROM o WHERE deleted_at IS NULL AND status = 'COMPLETED') / 10.0) AS BIGINT) AS total_pages
FROM (SELECT * FROM o WHERE deleted_at IS NULL AND status = 'COMPLETED'
      ORDER BY created_at DESC, id DESC LIMIT 10 OFFSET 20) p LEFT JOIN texts ON texts.order_id = p.id""", ITEM_TEXT)
add("o03_order_page_after", """
SELECT p.id, user_id, status, total_amount, created_at, coalesce(items, '') AS items
FROM (SELECT * FROM o WHERE deleted_at IS NULL AND status = 'COMPLETED'
      ORDER BY created_at DESC, id DESC LIMIT 10 OFFSET 20) p LEFT JOIN texts ON texts.order_id = p.id""", ITEM_TEXT)
add("q29_user_orders", """
SELECT id, user_id, status, total_amount, created_at, coalesce(items, '') AS items
FROM o LEFT JOIN texts ON texts.order_id = o.id WHERE deleted_at IS NULL""", ITEM_TEXT)


def by_status(orders: str, bucket: str, name: str) -> str:
    return f"""
SELECT {bucket} AS {name}, status, count(*) AS order_count, {money('sum(total_amount)')} AS revenue,
       {r4('sum(total_amount)', 'count(*)')} AS avg_order_value, count(DISTINCT user_id) AS unique_customers
FROM {orders} WHERE cdc_op <> 'd' GROUP BY 1, 2"""


add("q30_status_daily", by_status("o", "CAST(created_at AS DATE)", "sale_date"))
add("q31_status_hourly", by_status("eo", "date_trunc('hour', created_at)", "order_hour"))
add("q31_status_hourly_merged", by_status("eo", "date_trunc('hour', created_at)", "order_hour"))
for name in ("q32_daily_revenue_week", "p19_daily_revenue_by_months"):
    add(name, f"""
SELECT CAST(created_at AS DATE) AS order_date, count(*) AS orders, {money('sum(total_amount)')} AS revenue
FROM o WHERE created_at BETWEEN {AS_OF} - INTERVAL 7 DAY AND {AS_OF} AND cdc_op <> 'd' GROUP BY 1""")
add("q33_order_summaries", f"""
SELECT o.id, o.status, t.item_count, t.total
FROM o JOIN (SELECT order_id, count(*) AS item_count, {money('sum(subtotal)')} AS total FROM i WHERE cdc_op <> 'd'
             GROUP BY order_id) t ON t.order_id = o.id WHERE o.cdc_op <> 'd'""")
add("q34_product_report", f"""
SELECT sale_date, product_id, product_name, total_revenue, total_quantity, avg_price
FROM daily_view WHERE sale_date BETWEEN {TODAY} - 7 AND {TODAY}""", LINES, DAILY, DAILY_VIEW)
add("o04_users_page", "SELECT * FROM usr ORDER BY id DESC LIMIT 10 OFFSET 30")
add("o04_products_after", "SELECT * FROM prod WHERE id < 150 ORDER BY id DESC LIMIT 10")

# --- deduplication -----------------------------------------------------------

add("d01_first_seen_ten_minutes", """
SELECT p.event_type, p.t AS at_ms, f.event_id FROM passed p JOIN moments f ON f.event_type = p.event_type AND f.t = p.t""",
    """
moments AS (SELECT event_type, epoch_us(ts) // 1000 AS t, min(event_id) AS event_id FROM events GROUP BY ALL)""", """
nexts AS (SELECT event_type, t, min(t) OVER (PARTITION BY event_type ORDER BY t
          RANGE BETWEEN 600000 FOLLOWING AND UNBOUNDED FOLLOWING) AS later FROM moments)""", """
passed AS (
  SELECT event_type, min(t) AS t FROM moments GROUP BY event_type
  UNION ALL
  SELECT n.event_type, n.later FROM passed p JOIN nexts n ON n.event_type = p.event_type AND n.t = p.t
  WHERE n.later IS NOT NULL)""")
add("d02_distinct_versions", "SELECT id, count(DISTINCT cdc_ts_ms) AS versions FROM i_log GROUP BY id")
add("d09_replayed_range", """
SELECT * FROM i_log WHERE cdc_ts_ms >= 820454400000 AND cdc_ts_ms < 852076800000
QUALIFY row_number() OVER (PARTITION BY id ORDER BY cdc_ts_ms DESC, product_id DESC) = 1""")
add("d10_lag", """
SELECT max(o.cdc_ts_ms) AS last_change_ms, max(epoch_ms(l_shipdate)) AS last_arrival_ms,
       max(epoch_ms(l_shipdate) - o.cdc_ts_ms) AS max_delay_ms
FROM lineitem JOIN o_log o ON o.id = l_orderkey""")

add("s05_stream_current_orders", "SELECT * FROM o")
add("s06_stream_current_items", "SELECT * FROM i")
add("s08_throttled_stream", "SELECT CAST(3 AS BIGINT) AS batches, count(*) AS events FROM orders")
for name in ("s10_one_topic_current_orders", "d06_resumed_with_late_versions"):
    add(name, "SELECT * FROM o")
add("d05_restarted_sync", "SELECT * FROM o_log")
add("d01b_stream_first_seen_items", "SELECT id, min(cdc_ts_ms) AS cdc_ts_ms FROM i_log GROUP BY id")
add("d01_stream_first_seen", "SELECT l_orderkey AS id, min(epoch_ms(l_shipdate)) AS cdc_ts_ms FROM lineitem GROUP BY l_orderkey")

# --- quality ------------------------------------------------------------------

add("k01_count_reconciliation", """
SELECT s AS source_rows, t AS target_rows, s - t AS difference,
       CASE WHEN s - t = 0 THEN 'consistent' WHEN abs(s - t) <= 10 THEN 'minor' ELSE 'severe' END AS verdict
FROM (SELECT (SELECT count(*) FROM orders) AS s, (SELECT count(*) FROM o WHERE cdc_op <> 'd') AS t)""")
add("k01_row_reconciliation", """
SELECT id, CASE WHEN id % 29 = 0 THEN 'missing' WHEN id % 37 = 0 OR id % 43 = 0 THEN 'different' ELSE 'duplicate' END AS issue,
       CAST(1 AS BIGINT) AS source_rows, CAST(CASE WHEN id % 29 = 0 THEN 0 WHEN id % 31 = 0 THEN 2 ELSE 1 END AS BIGINT) AS target_rows
FROM o WHERE cdc_op <> 'd' AND (id % 29 = 0 OR id % 31 = 0 OR id % 37 = 0 OR id % 43 = 0)
UNION ALL SELECT id + 1000000000, 'surplus', 0, 1 FROM o WHERE cdc_op <> 'd' AND id % 41 = 0""")
add("k02_duplicate_ids", "SELECT id, count(*) AS row_count FROM i_log GROUP BY id HAVING count(*) > 1")
TOTALS = f"""
totals AS (
  SELECT o.id AS order_id, o.status, o.total_amount, count(i.id) AS item_count, {money('sum(i.subtotal)')} AS calculated_total
  FROM o LEFT JOIN i ON i.order_id = o.id WHERE o.cdc_op <> 'd' GROUP BY ALL)"""
add("k03_order_total_mismatch", "SELECT * FROM totals WHERE total_amount <> calculated_total", TOTALS)
add("k03_order_totals_listing", "SELECT * FROM totals ORDER BY order_id DESC LIMIT 10", TOTALS)
add("k04_counts_by_op", "SELECT cdc_op, count(*) AS row_count FROM i_log GROUP BY cdc_op")
add("k05_labelled_counts", """
SELECT 'Orders' AS table_name, count(*) AS record_count FROM o_log
UNION ALL SELECT 'Order Items', count(*) FROM i_log""")
ILLEGAL = """
history AS (
  SELECT l_orderkey AS id, epoch_ms(l_shipdate) AS cdc_ts_ms,
         CASE WHEN l_returnflag = 'N' THEN 'PENDING' WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN 'PROCESSING'
              WHEN l_returnflag = 'A' THEN 'COMPLETED' ELSE 'CANCELLED' END AS status,
         CAST(l_linenumber AS BIGINT) * 1000000000 + l_partkey AS pos FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_shipdate ORDER BY pos DESC) = 1),
illegal AS (
  SELECT id, cdc_ts_ms, before AS from_status, status AS to_status
  FROM (SELECT *, lag(status) OVER (PARTITION BY id ORDER BY cdc_ts_ms) AS before FROM history)
  WHERE before IS NOT NULL AND before <> status AND (before || '>' || status) NOT IN
    ('PENDING>PROCESSING', 'PENDING>CANCELLED', 'PROCESSING>COMPLETED', 'PROCESSING>CANCELLED'))"""
add("k06_illegal_transitions", "SELECT * FROM illegal", ILLEGAL)
add("k06_transition_summary", "SELECT from_status, to_status, count(*) AS changes FROM illegal GROUP BY ALL", ILLEGAL)
add("k10_refused_cancellations",
    "SELECT * FROM illegal WHERE from_status = 'COMPLETED' AND to_status = 'CANCELLED'", ILLEGAL)
add("k07_negative_stock", """
SELECT product_id, moved_at_ms, CAST(stock + moved AS BIGINT) AS stock
FROM (SELECT product_id, moved_at_ms, sum(change) OVER (PARTITION BY product_id ORDER BY moved_at_ms) AS moved
      FROM (SELECT l_partkey AS product_id, epoch_ms(l_shipdate) AS moved_at_ms,
                   sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE -1 END * CAST(l_quantity AS BIGINT)) AS change
            FROM lineitem GROUP BY ALL)) m
JOIN prod ON prod.id = m.product_id WHERE stock + moved < 0""")
add("k08_shared_names", "SELECT name, count(*) AS row_count FROM prod GROUP BY name HAVING count(*) > 1")
add("k08_shared_emails", """
SELECT 'emails' AS table_name, count(*) AS record_count FROM (SELECT email FROM usr GROUP BY email HAVING count(*) > 1)
UNION ALL SELECT 'usernames', count(*) FROM (SELECT username FROM usr GROUP BY username HAVING count(*) > 1)""")
add("k09_field_faults", """
SELECT fault, count(*) AS row_count FROM (
  SELECT 'product_id not positive' AS fault FROM i WHERE product_id IS NULL OR product_id <= 0
  UNION ALL SELECT 'product_name empty' FROM i WHERE coalesce(product_name, '') = ''
  UNION ALL SELECT 'quantity below 1' FROM i WHERE quantity IS NULL OR quantity < 1
  UNION ALL SELECT 'price not positive' FROM i WHERE price IS NULL OR price <= 0
  UNION ALL SELECT 'user_id not positive' FROM o WHERE user_id IS NULL OR user_id <= 0
  UNION ALL SELECT 'no items' FROM o WHERE NOT EXISTS (SELECT 1 FROM i WHERE i.order_id = o.id)
  UNION ALL SELECT 'name length' FROM prod WHERE length(coalesce(name, '')) NOT BETWEEN 1 AND 255
  UNION ALL SELECT 'category length' FROM prod WHERE length(category) > 50
  UNION ALL SELECT 'price negative' FROM prod WHERE price IS NULL OR price < 0
  UNION ALL SELECT 'stock negative' FROM prod WHERE stock IS NULL OR stock < 0
  UNION ALL SELECT 'unknown status' FROM o WHERE status NOT IN ('PENDING', 'PROCESSING', 'COMPLETED', 'CANCELLED'))
WHERE fault IS NOT NULL GROUP BY fault""")
add("k11_deletable_users", "SELECT id, username FROM usr WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.user_id = usr.id)")
add("k11_users_without_recent_orders", f"""
SELECT id, username FROM usr WHERE NOT EXISTS (
  SELECT 1 FROM o WHERE o.user_id = usr.id AND created_at BETWEEN {AS_OF} - INTERVAL 30 DAY AND {AS_OF})""")
add("k11_blocked_users", """
SELECT usr.id, username, count(*) AS order_count FROM usr JOIN o ON o.user_id = usr.id GROUP BY ALL""")
