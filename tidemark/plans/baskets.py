"""Products bought together.

A pair (a, b) of items of one order counts when ``a.id < b.id`` and ``a`` is
recent. The report asks for distinct orders per name pair, the best ``k`` of
them, and the mean of the two subtotals over all item pairs.

Joining the items of an order with themselves squares a big order. Instead:

1. Items shrink to one row per (order, name) with the lowest recent id and the
   highest id. A name pair occurs in an order iff low(a) < high(b).
2. Orders of up to ``basket_limit`` names are paired directly: each row meets at
   most that many others.
3. Bigger orders are not paired. A pair gains at most one count from each of
   them, so only pairs whose count so far comes within their number of the k-th
   best, or of the least count that is reported where there are fewer than ``k`` pairs,
   can still be in the result; those pairs alone are looked up in the big
   orders. Should the big orders be so many that this bound says nothing, the
   limit doubles until it does, so that the fewest and biggest stay unpaired:
   the biggest order is never paired where pairs of two orders or more are asked for.
4. The subtotals are needed for the ``k`` pairs only, and come from running sums.

Every step is exact; the limit only chooses the way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import calendar as cal
from tidemark.functions.money import ratio
from tidemark.operators.ordered import running_sums
from tidemark.operators.staging import staged
from tidemark.plans.lines import alive


def _recent_orders_only(lines: DataFrame, recent: Column) -> DataFrame:
    """Lines of orders with at least one recent item; no other order can count."""
    ids = lines.filter(recent).select("order_id").distinct()
    return lines.join(ids, "order_id", "left_semi")


def _names_per_order(lines: DataFrame, recent: Column) -> DataFrame:
    names = lines.groupBy("order_id", "product_name").agg(
        F.min(F.when(recent, F.col("id"))).alias("low"), F.max("id").alias("high"))
    sizes = names.groupBy("order_id").agg(F.count("*").alias("n_names"))
    return names.join(sizes, "order_id")


def _side(names: DataFrame, side: str) -> DataFrame:
    return names.select("order_id", *[F.col(c).alias(f"{n}_{side}") for c, n in
                                      (("product_name", "product"), ("low", "low"), ("high", "high"))])


def _by_item_id() -> Column:
    """Some recent item of the first name comes before some item of the second."""
    return F.col("low_a") < F.col("high_b")


def _unordered() -> Column:
    """Two names in alphabetical order, at least one of them recent."""
    return (F.col("product_a") < F.col("product_b")) & (F.col("low_a").isNotNull() | F.col("low_b").isNotNull())


def _count(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("product_a", "product_b").agg(F.count("*").alias("orders"))


def pair_counts(names: DataFrame, holds: Column, k: int, basket_limit: int, min_orders: int = 1) -> DataFrame:
    """Order counts per name pair, complete for every pair that can be in the best k of those with ``min_orders`` orders."""
    sized = staged(names, "basket-names")
    limit = basket_limit
    while True:
        small = sized.filter(F.col("n_names") <= limit)
        direct = _count(_side(small, "a").join(_side(small, "b"), "order_id").filter(holds))
        n_big = _orders_above(sized, limit)
        if n_big == 0:
            return direct.withColumnRenamed("orders", "co_purchase_count")
        direct = staged(direct, "basket-pairs")
        best = direct.orderBy(F.desc("orders")).limit(k).agg(F.count("*"), F.min("orders")).head()
        least = max(min_orders, best[1]) if best[0] == k else min_orders  # a pair of the result has so many orders at least
        if least > n_big:
            break
        limit *= 2
    big = sized.filter(F.col("n_names") > limit)
    reach = direct.filter(F.col("orders") >= least - n_big).select("product_a", "product_b")
    looked_up = _count(_side(big, "a").join(reach, "product_a")
                       .join(_side(big, "b"), ["order_id", "product_b"]).filter(holds))
    return (direct.unionByName(looked_up).groupBy("product_a", "product_b")
            .agg(F.sum("orders").cast("bigint").alias("co_purchase_count")))


def _orders_above(sized: DataFrame, limit: int) -> int:
    return sized.filter(F.col("n_names") > limit).agg(F.count_distinct("order_id")).head()[0]


def _roles(best: DataFrame) -> DataFrame:
    """One row per (pair, name in it): at most twice ``k`` rows, safe to broadcast."""
    return best.select("product_a", "product_b", F.explode(F.array(
        F.struct(F.col("product_a").alias("product_name"), F.lit(False).alias("is_b")),
        F.struct(F.col("product_b").alias("product_name"), F.lit(True).alias("is_b")))).alias("role")
    ).select("product_a", "product_b", "role.*")


def _best(counts: DataFrame, min_orders: int, k: int) -> DataFrame:
    return staged(counts.filter(F.col("co_purchase_count") >= min_orders)
                  .orderBy(F.desc("co_purchase_count"), "product_a", "product_b").limit(k), "basket-best")


def _lines(items: DataFrame, recent: Column) -> DataFrame:
    lines = staged(alive(items).select("id", "order_id", "product_name", "subtotal", "created_at"), "basket-lines")
    return _recent_orders_only(lines, recent)


def _bundle_revenue(lines: DataFrame, recent: Column, best: DataFrame, id_range: int) -> DataFrame:
    """Mean of both subtotals over all item pairs of the (at most k) best name pairs.

    Only lines of those names are read on. In each pair and order the lines of the
    first name feed a running count and sum, which the lines of the second name
    pick up: the work grows with the lines and not with their pairs.
    """
    amount = F.col("subtotal").cast("decimal(28,2)")
    is_a = ~F.col("is_b")
    both = (lines.join(F.broadcast(_roles(best)), "product_name").filter(F.col("is_b") | recent)
            .select("product_a", "product_b", "order_id", "id", "is_b", amount.alias("amount"),
                    is_a.cast("bigint").alias("one"),
                    F.when(is_a, amount).otherwise(0).cast("decimal(28,2)").alias("left_amount")))
    seen = running_sums(both, ["product_a", "product_b", "order_id"], "id",
                        {"one": "n_before", "left_amount": "sum_before"}, id_range, include_current=False)
    pairs = seen.filter(F.col("is_b") & (F.col("n_before") > 0))
    bundle = (F.col("sum_before") + F.col("amount") * F.col("n_before")).cast("decimal(38,2)")
    return pairs.groupBy("product_a", "product_b").agg(
        ratio(F.sum(bundle), F.sum("n_before")).alias("avg_bundle_revenue"))


def bought_together(items: DataFrame, as_of, days: int = 30, min_orders: int = 3, k: int = 20,
                    basket_limit: int = 1000, id_range: int = 1_000_000) -> DataFrame:
    """The ``k`` name pairs found in the most orders, ordered by item id within a pair."""
    recent = cal.since(F.col("created_at"), as_of, f"{days} DAY")
    lines = _lines(items, recent)
    best = _best(pair_counts(_names_per_order(lines, recent), _by_item_id(), k, basket_limit, min_orders), min_orders, k)
    revenue = _bundle_revenue(lines, recent, best, id_range)
    return best.join(revenue, ["product_a", "product_b"]).orderBy(
        F.desc("co_purchase_count"), "product_a", "product_b")


def bought_together_unordered(items: DataFrame, as_of, days: int = 30, min_orders: int = 3, k: int = 20,
                              basket_limit: int = 1000) -> DataFrame:
    """As :func:`bought_together` with each pair once, whatever the order of its
    items; the mean is that of both names' subtotals per order."""
    recent = cal.since(F.col("created_at"), as_of, f"{days} DAY")
    lines = _lines(items, recent)
    best = _best(pair_counts(_names_per_order(lines, recent), _unordered(), k, basket_limit, min_orders), min_orders, k)
    per_order = (lines.join(F.broadcast(_roles(best)), "product_name")
                 .groupBy("product_a", "product_b", "order_id").agg(
                     F.sum("subtotal").alias("amount"), F.count_distinct("is_b").alias("names"),
                     F.max(recent).alias("recent"))
                 .filter("names = 2 AND recent"))
    revenue = per_order.groupBy("product_a", "product_b").agg(
        ratio(F.sum("amount"), F.count("*")).alias("avg_bundle_revenue"))
    return best.join(revenue, ["product_a", "product_b"]).orderBy(
        F.desc("co_purchase_count"), "product_a", "product_b")
