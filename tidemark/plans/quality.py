"""Data-quality and reconciliation jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.money import total, whole
from tidemark.operators.ordered import previous_value, running_sums
from tidemark.operators.staging import staged
from tidemark.plans.lines import alive
from tidemark.schemas import ALLOWED_TRANSITIONS

DAY_MS = 86_400_000


def count_reconciliation(source: DataFrame, target: DataFrame) -> DataFrame:
    """Live source rows against live target rows, with a verdict on the difference.

    Equal counts say nothing of the rows: a missing one and a repeated one make up for each
    other, which :func:`row_differences` tells apart.
    """
    there = alive(source) if "cdc_op" in source.columns else source
    both = (there.select(F.lit(1).alias("s"), F.lit(0).alias("t"))
            .unionAll(alive(target).select(F.lit(0).alias("s"), F.lit(1).alias("t"))))
    counts = both.agg(whole(F.sum("s")).alias("source_rows"), whole(F.sum("t")).alias("target_rows"))
    gap = F.col("source_rows") - F.col("target_rows")
    return counts.withColumn("difference", gap).withColumn(
        "verdict", F.when(gap == 0, "consistent").when(F.abs(gap) <= 10, "minor").otherwise("severe"))


def row_reconciliation(source: DataFrame, target: DataFrame, columns: Sequence[str], key: str = "id") -> DataFrame:
    """Keys on which two tables differ, with the issue, see :func:`row_differences`."""
    return row_differences(source, target, columns, key).select(key, "issue")


def row_differences(source: DataFrame, target: DataFrame, columns: Sequence[str], key: str = "id", buckets: int = 1 << 16) -> DataFrame:
    """Keys on which two tables differ, with the issue and how many rows each side has.

    ``missing``: fewer rows than in the source; ``surplus``: no row in the source; ``duplicate``:
    the source's row more often than there; ``different``: as many rows, other values.
    Deleted rows count on neither side.

    First each side is summed up by bucket of the key: the count and the sum of row hashes
    (two of 64 bits). Buckets that agree are done; rows are compared only in the others. Both
    sides are read twice, but only rows of unequal buckets are shuffled.
    """
    values = [*columns, *[F.col(c).isNull() for c in columns]]

    def side(rows: DataFrame, is_source: bool) -> DataFrame:
        kept = alive(rows) if "cdc_op" in rows.columns else rows
        return kept.select(key, F.pmod(F.xxhash64(key), F.lit(buckets)).alias("bucket"), F.xxhash64(key, *values).alias("h"),
                           F.xxhash64(F.lit(1), key, *values).alias("g"), F.lit(is_source).alias("is_source"))

    both = side(source, True).unionAll(side(target, False))
    sign = F.when(F.col("is_source"), 1).otherwise(-1)
    unequal = both.groupBy("bucket").agg(
        F.sum(sign).alias("n"), *[F.sum(F.col(c).cast("decimal(38,0)") * sign).alias(c) for c in ("h", "g")]
    ).filter("n <> 0 OR h <> 0 OR g <> 0").select("bucket")  # one row a bucket at most
    rows = both.join(F.broadcast(unequal), "bucket")
    per_value = rows.groupBy(key, "h", "g").agg(F.count_if("is_source").alias("s"), F.count_if(~F.col("is_source")).alias("t"))
    seen = per_value.groupBy(key).agg(
        F.sum("s").cast("bigint").alias("source_rows"), F.sum("t").cast("bigint").alias("target_rows"),
        F.sum(F.abs(F.col("s") - F.col("t"))).alias("apart"), F.sum(F.least("s", "t")).alias("shared"))
    s, t = F.col("source_rows"), F.col("target_rows")
    issue = (F.when(s == 0, "surplus").when(t < s, "missing").when((t > s) & (F.col("shared") == s), "duplicate").otherwise("different"))
    return seen.filter("apart > 0").select(key, issue.alias("issue"), "source_rows", "target_rows")


def duplicate_keys(rows: DataFrame, keys: Sequence[str] = ("id",)) -> DataFrame:
    return (rows.groupBy(*keys).agg(F.count("*").cast("bigint").alias("row_count"))
            .filter("row_count > 1"))


def order_total_mismatch(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders whose total is not the sum of their lines."""
    sums = items.groupBy(F.col("order_id").alias("id")).agg(
        F.count("*").alias("item_count"), F.sum("subtotal").alias("calculated_total"))
    joined = alive(orders).select("id", "status", "total_amount").join(sums, "id", "left")
    return joined.select(
        F.col("id").alias("order_id"), "status", "total_amount",
        whole(F.col("item_count")).alias("item_count"),
        F.coalesce("calculated_total", F.lit(0)).cast("decimal(18,2)").alias("calculated_total"),
    ).filter("total_amount <> calculated_total")


def order_totals_listing(orders: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """The newest orders with item count and item total, matching or not."""
    newest = alive(orders).select("id", "status", "total_amount").orderBy(F.desc("id")).limit(k)
    sums = (items.join(newest.select(F.col("id").alias("order_id")), "order_id", "left_semi")
            .groupBy(F.col("order_id").alias("id"))
            .agg(F.count("*").alias("item_count"), F.sum("subtotal").alias("calculated_total")))
    return newest.join(sums, "id", "left").select(
        F.col("id").alias("order_id"), "status", "total_amount",
        whole(F.col("item_count")).alias("item_count"),
        F.coalesce("calculated_total", F.lit(0)).cast("decimal(18,2)").alias("calculated_total"))


def counts_by_op(log: DataFrame) -> DataFrame:
    return log.groupBy("cdc_op").agg(F.count("*").cast("bigint").alias("row_count"))


def labelled_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table; an empty table still shows."""
    parts = [frame.agg(F.count("*").cast("bigint").alias("record_count"))
             .select(F.lit(label).alias("table_name"), "record_count") for label, frame in tables.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def illegal_transitions(log: DataFrame, width_ms: int = DAY_MS, version: str = "cdc_ts_ms", tie: str = "source_pos") -> DataFrame:
    """Status changes that the order life cycle does not allow.

    One row per (order, version) first; then each row meets the status before it.
    A row that keeps its status is no change.
    """
    unique = staged(log.groupBy("id", version).agg(F.max_by("status", tie).alias("status")), "status-versions")
    steps = previous_value(unique, ["id"], version, "status", width_ms, "from_status")
    allowed = F.lit(False)
    for before, after in ALLOWED_TRANSITIONS:
        allowed = allowed | ((F.col("from_status") == before) & (F.col("status") == after))
    return (steps.filter(F.col("from_status").isNotNull() & (F.col("from_status") != F.col("status")) & ~allowed)
            .select("id", version, "from_status", F.col("status").alias("to_status")))


def transition_summary(illegal: DataFrame) -> DataFrame:
    return illegal.groupBy("from_status", "to_status").agg(F.count("*").cast("bigint").alias("changes"))


def refused_cancellations(illegal: DataFrame) -> DataFrame:
    """Cancellations of an order that was already completed."""
    return illegal.filter((F.col("to_status") == "CANCELLED") & (F.col("from_status") == "COMPLETED"))


def negative_stock(products: DataFrame, moves: DataFrame, width_ms: int = 30 * DAY_MS) -> DataFrame:
    """Moments at which the running stock of a product lies below zero."""
    per_moment = staged(moves.groupBy("product_id", "moved_at_ms").agg(F.sum("change").alias("change")), "stock-moves")
    running = running_sums(per_moment, ["product_id"], "moved_at_ms", {"change": "moved"}, width_ms)
    opening = products.select(F.col("id").alias("product_id"), F.col("stock").cast("bigint").alias("opening_stock"))
    return (running.join(opening, "product_id")
            .withColumn("stock", (F.col("opening_stock") + F.col("moved")).cast("bigint"))
            .filter("stock < 0").select("product_id", "moved_at_ms", "stock"))


def duplicate_values(users: DataFrame, column: str) -> DataFrame:
    """Values of a column that must be unique but are not."""
    return (users.groupBy(column).agg(F.count("*").cast("bigint").alias("row_count"))
            .filter(F.col("row_count") > 1))


def item_faults(items: DataFrame) -> DataFrame:
    """One row per item and field rule that it breaks."""
    return _each_fault(
        items,
        F.when(~F.coalesce(F.col("product_id") > 0, F.lit(False)), "product_id not positive"),
        F.when(F.length(F.coalesce("product_name", F.lit(""))) == 0, "product_name empty"),
        F.when(~F.coalesce(F.col("quantity") >= 1, F.lit(False)), "quantity below 1"),
        F.when(~F.coalesce(F.col("price") > 0, F.lit(False)), "price not positive"))


def _each_fault(rows: DataFrame, *faults) -> DataFrame:
    return rows.select("id", F.explode(F.array_compact(F.array(*faults))).alias("fault"))


def order_faults(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders without a valid buyer, and orders without items."""
    buyer = (orders.filter(~F.coalesce(F.col("user_id") > 0, F.lit(False)))
             .select("id", F.lit("user_id not positive").alias("fault")))
    empty = (orders.join(items.select(F.col("order_id").alias("id")).distinct(), "id", "left_anti")
             .select("id", F.lit("no items").alias("fault")))
    return buyer.unionByName(empty)


def product_faults(products: DataFrame) -> DataFrame:
    """One row per product and field rule that it breaks."""
    return _each_fault(
        products,
        F.when(~F.length(F.coalesce("name", F.lit(""))).between(1, 255), "name length"),
        F.when(F.length("category") > 50, "category length"),
        F.when(~F.coalesce(F.col("price") >= 0, F.lit(False)), "price negative"),
        F.when(~F.coalesce(F.col("stock") >= 0, F.lit(False)), "stock negative"))


def status_faults(orders: DataFrame, statuses: Sequence[str]) -> DataFrame:
    return orders.filter(~F.coalesce(F.col("status").isin(*statuses), F.lit(False))).select("id", "status")


def deletable_users(users: DataFrame, orders: DataFrame) -> DataFrame:
    """Users that no order refers to."""
    buyers = orders.select(F.col("user_id").alias("id")).distinct()
    return users.select("id", "username").join(buyers, "id", "left_anti")


def blocked_users(users: DataFrame, orders: DataFrame) -> DataFrame:
    """Users that may not be deleted, with the number of their orders."""
    counts = orders.groupBy(F.col("user_id").alias("id")).agg(F.count("*").cast("bigint").alias("order_count"))
    return users.select("id", "username").join(counts, "id")


def lag_report(rows: DataFrame, ingested: str, happened: str) -> DataFrame:
    """Newest change, newest arrival and the greatest delay, in milliseconds."""
    return rows.agg(F.max(happened).cast("bigint").alias("last_change_ms"),
                    F.max(ingested).cast("bigint").alias("last_arrival_ms"),
                    F.max(F.col(ingested) - F.col(happened)).cast("bigint").alias("max_delay_ms"))
