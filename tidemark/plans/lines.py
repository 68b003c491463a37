"""Shared building blocks of the rollups and reports.

All functions take current rows (see ``operators.versions.latest``) unless they
say otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.versions import not_deleted, not_soft_deleted


def alive(rows: DataFrame, exclude_soft_deleted: bool = False) -> DataFrame:
    """Hard deletes out; soft deletes only on request."""
    keep = not_deleted() & not_soft_deleted() if exclude_soft_deleted else not_deleted()
    return rows.filter(keep)


def order_side(orders: DataFrame, *columns: str) -> DataFrame:
    """Order columns under names that do not clash with item columns."""
    names = {"id": "order_id", "created_at": "ordered_at"}
    return orders.select(*[F.col(c).alias(names.get(c, c)) for c in ("id",) + columns])


def sold_lines(items: DataFrame, orders: DataFrame, exclude_soft_deleted: bool = False,
               keep_deleted_orders: bool = False, keep_cancelled: bool = False) -> DataFrame:
    """Item lines with the buyer of their order; cancelled orders out by default.

    Filters sit on both inputs, so only lines that count are shuffled. The planner
    picks the join; adaptive execution splits a partition swollen by one order.
    """
    orders_in = orders if keep_deleted_orders else alive(orders, exclude_soft_deleted)
    if not keep_cancelled:
        orders_in = orders_in.filter(F.col("status") != "CANCELLED")
    items_in = alive(items, exclude_soft_deleted).select(
        "id", "order_id", "product_id", "product_name", "quantity", "price", "subtotal", "created_at")
    return items_in.join(order_side(orders_in, "user_id", "status"), "order_id")


def items_per_order(items: DataFrame) -> DataFrame:
    """Item totals per order. Joining these, and not the items, keeps one row per
    order and spares the join a side that one big order could swell."""
    alive_item = not_deleted()
    return items.groupBy("order_id").agg(
        F.count("*").alias("all_lines"),
        F.count_if(alive_item).alias("alive_lines"),
        F.sum("quantity").cast("bigint").alias("all_quantity"),
        F.sum(F.when(alive_item, F.col("quantity"))).cast("bigint").alias("alive_quantity"),
        F.sum("price").cast("decimal(18,2)").alias("all_price"),
        F.sum(F.when(alive_item, F.col("subtotal"))).cast("decimal(18,2)").alias("alive_subtotal"))


def orders_with_totals(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Every order with its item totals, zero where it has none."""
    totals = items_per_order(items)
    zero = {c: 0 for c in totals.columns if c != "order_id"}
    return (orders.join(totals.withColumnRenamed("order_id", "id"), "id", "left").fillna(zero))


def repeats(lines: str, fan_out: bool) -> Column:
    """How often an order counts: once, or once per joined item line.

    A plain left join of orders to items repeats an order once per line (and keeps
    it once when it has none). Weighting gives the same sums without the repeats.
    """
    return F.greatest(F.col(lines), F.lit(1)) if fan_out else F.lit(1)
