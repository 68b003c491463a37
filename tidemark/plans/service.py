"""Reads of the order service: lists, pages, lookups and nested results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import calendar as cal
from tidemark.functions.money import total
from tidemark.operators.staging import staged
from tidemark.operators.versions import with_deleted

ITEM_COLUMNS = ("id", "product_id", "product_name", "quantity", "price", "subtotal")


def lookup(rows: DataFrame, column: str, value) -> DataFrame:
    """Rows with one value; the predicate reaches the scan."""
    return rows.filter(F.col(column) == F.lit(value))


def order_list(orders: DataFrame, status: str | None = None, user_id: int | None = None,
               deleted: str = "exclude") -> DataFrame:
    """Orders by the optional filters, soft-deleted ones left out by default."""
    found = with_deleted(orders, deleted)
    if status:
        found = found.filter(F.col("status") == status)
    if user_id:
        found = found.filter(F.col("user_id") == user_id)
    return found


def product_list(products: DataFrame, category: str | None = None) -> DataFrame:
    return products.filter(F.col("category") == category) if category else products


def page_of(rows: DataFrame, *order, page: int = 1, limit: int = 10) -> DataFrame:
    """One page. For deep pages :func:`page_after` avoids sorting what was skipped."""
    return rows.orderBy(*order).offset((page - 1) * limit).limit(limit)


def page_after(rows: DataFrame, last_id: int | None, limit: int = 10) -> DataFrame:
    """The page behind a known last id, newest id first."""
    rest = rows if last_id is None else rows.filter(F.col("id") < last_id)
    return rest.orderBy(F.desc("id")).limit(limit)


def with_page_info(paged: DataFrame, everything: DataFrame, page: int, limit: int) -> DataFrame:
    """Add total, page, limit and number of pages; the count is a scalar subquery."""
    count = everything.agg(F.count("*").alias("n")).scalar()
    return (paged.withColumn("total", count)
            .withColumn("page", F.lit(page)).withColumn("limit", F.lit(limit))
            .withColumn("total_pages", F.ceil(F.col("total") / F.lit(limit)).cast("bigint")))


def nested_items(orders: DataFrame, items: DataFrame, chunk: int = 10_000) -> DataFrame:
    """Orders with their items as an array of structs, sorted by item id.

    An order is one row with ``part`` 0. Only an order of more than ``chunk`` items
    is spread over several rows of about ``chunk`` items each, so that no row grows
    with the data.
    """
    rows = staged(items.select("order_id", *ITEM_COLUMNS), "nested-items")
    sizes = rows.groupBy("order_id").agg(F.count("*").alias("_n"))
    kept = rows.join(sizes, "order_id")
    parts = F.ceil(F.col("_n") / F.lit(chunk))
    packed = (kept.withColumn("part", F.pmod(F.xxhash64("id"), parts))
              .groupBy("order_id", "part")
              .agg(F.array_sort(F.collect_list(F.struct(*ITEM_COLUMNS))).alias("items"))
              .withColumnRenamed("order_id", "id"))
    return (orders.join(packed, "id", "left")
            .withColumn("part", F.coalesce("part", F.lit(0)))
            .withColumn("items", F.coalesce("items", F.array().cast(packed.schema["items"].dataType))))


ORDER_COLUMNS = ("id", "user_id", "status", "total_amount", "created_at")


def _with_items(one: DataFrame, items: DataFrame) -> DataFrame:
    """A page of orders with nested items. The page is cut once, and only its (at most ``limit``) orders are matched."""
    one = staged(one.select(*ORDER_COLUMNS), "order-page")
    wanted = items.join(F.broadcast(one.select(F.col("id").alias("order_id"))), "order_id", "left_semi")
    return nested_items(one, wanted)


def order_page(orders: DataFrame, items: DataFrame, status: str | None = None, user_id: int | None = None,
               page: int = 1, limit: int = 10) -> DataFrame:
    """A page of orders, newest first, with nested items and page numbers.

    Every row before the page is sorted: for deep pages :func:`order_page_after` starts at the page itself.
    """
    found = order_list(orders, status, user_id)
    one = page_of(found, F.desc("created_at"), F.desc("id"), page=page, limit=limit)
    return with_page_info(_with_items(one, items), found, page, limit)


def order_page_after(orders: DataFrame, items: DataFrame, last: tuple | None, status: str | None = None, user_id: int | None = None,
                     limit: int = 10) -> DataFrame:
    """The page behind the order (created_at, id) that a client saw last; the first page without one.

    What lies before is filtered out, by a time predicate that reaches the scan and prunes the
    months of a table kept by month; of the rest each task keeps ``limit`` rows, so nothing is
    sorted that was skipped.
    """
    found = order_list(orders, status, user_id)
    if last is not None:
        at, seen = cal.moment(last[0]), F.lit(last[1])
        if "yyyymm" in found.columns:
            found = found.filter(F.col("yyyymm") <= cal.yyyymm(at))
        found = found.filter(F.col("created_at") <= at).filter((F.col("created_at") < at) | (F.col("id") < seen))
    return _with_items(found.orderBy(F.desc("created_at"), F.desc("id")).limit(limit), items)


def user_orders(orders: DataFrame, items: DataFrame, user_id: int | None = None) -> DataFrame:
    """Orders with nested items, of one user or of all."""
    found = order_list(orders, user_id=user_id)
    return nested_items(found.select(*ORDER_COLUMNS), items)


def recent_orders(orders: DataFrame, users: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """The newest (order, item) rows with the buyer.

    The first ``k`` rows lie within the newest ``k`` orders that have a buyer and an item. They
    are looked for among the newest orders only, four times as many in each try, so that items
    and buyers are matched with a few orders by broadcast and never shuffled.
    """
    placed = orders.select(F.col("id").alias("order_id"), "user_id", "status", "total_amount", "created_at")
    at = [F.desc("created_at"), F.desc("order_id")]
    tried = 4 * k
    while True:
        newest = staged(placed.orderBy(*at).limit(tried), "newest-orders")
        lines = staged(items.join(F.broadcast(newest.select("order_id")), "order_id", "left_semi").select(
            "order_id", F.col("id").alias("item_id"), "product_name", "quantity", "price", "subtotal"), "newest-lines")
        buyers = users.select(F.col("id").alias("user_id"), "username", "email").join(
            F.broadcast(newest.select("user_id").distinct()), "user_id", "left_semi")
        joinable = staged(newest.join(lines.select("order_id").distinct(), "order_id", "left_semi").join(buyers, "user_id"), "recent-orders")
        if joinable.count() >= k or newest.count() < tried:
            break
        tried *= 4
    first = joinable.orderBy(*at).limit(k)
    return (lines.join(F.broadcast(first), "order_id").orderBy(*at, "item_id").limit(k)
            .select("order_id", "username", "email", "status", "total_amount", "created_at",
                    "product_name", "quantity", "price", "subtotal"))


def priced_items(items: DataFrame) -> DataFrame:
    """Items with ``subtotal`` worked out from quantity and price."""
    return items.withColumn("subtotal", (F.col("quantity") * F.col("price")).cast("decimal(18,2)"))


def order_totals(items: DataFrame) -> DataFrame:
    """The total an order is created with: the sum of its subtotals."""
    return priced_items(items).groupBy("order_id").agg(total("subtotal").alias("total_amount"))
