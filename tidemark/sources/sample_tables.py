"""The sample star schema seen through the order model.

The mapping is fixed so that an SQL text can state the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.versions import latest

AS_OF = "2001-08-01 00:00:00"
EVENTS_AS_OF = "2024-01-30 12:00:00"


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def _change_code(key: Column) -> Column:
    return F.when(key % 97 == 3, "d").when(key % 3 == 0, "u").otherwise("c")


def orders_from(raw: DataFrame) -> DataFrame:
    """Order log rows from the sample ``orders`` columns (batch or stream)."""
    key = F.col("o_orderkey")
    placed = F.col("o_orderdate").cast("timestamp")
    status = (F.when(key % 20 == 0, "CANCELLED").when(F.col("o_orderstatus") == "F", "COMPLETED")
              .when(F.col("o_orderstatus") == "P", "PROCESSING").otherwise("PENDING"))
    return raw.select(
        key.alias("id"), F.col("o_custkey").alias("user_id"), status.alias("status"),
        F.col("o_totalprice").cast("decimal(10,2)").alias("total_amount"),
        placed.alias("created_at"), placed.alias("updated_at"),
        F.when(key % 50 == 7, placed + F.expr("INTERVAL 1 DAY")).alias("deleted_at"),
        _change_code(key).alias("cdc_op"), F.unix_millis(placed).alias("cdc_ts_ms"))


def _item_keys(raw: DataFrame) -> DataFrame:
    shipped = F.col("l_shipdate").cast("timestamp")
    return raw.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("subtotal"),
        shipped.alias("created_at"), shipped.alias("updated_at"),
        F.lit(None).cast("timestamp").alias("deleted_at"),
        F.when((F.col("l_orderkey") + F.col("l_linenumber")) % 41 == 0, "d").otherwise("u").alias("cdc_op"),
        F.unix_millis(shipped).alias("cdc_ts_ms"))


def _named(items: DataFrame, part: DataFrame) -> DataFrame:
    names = part.select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
                        F.col("p_retailprice").cast("decimal(10,2)").alias("price"))
    return items.join(names, "product_id").select(
        "id", "order_id", "product_id", "product_name", "quantity", "price", "subtotal",
        "created_at", "updated_at", "deleted_at", "cdc_op", "cdc_ts_ms")


def items_from(raw: DataFrame, part: DataFrame) -> DataFrame:
    """Item log rows from the sample ``lineitem`` columns (batch or stream)."""
    return _named(_item_keys(raw), part)


def orders_log(spark: SparkSession, root: str) -> DataFrame:
    return orders_from(table(spark, root, "orders"))


def items_log(spark: SparkSession, root: str) -> DataFrame:
    return items_from(table(spark, root, "lineitem"), table(spark, root, "part"))


def orders(spark: SparkSession, root: str) -> DataFrame:
    """Current orders."""
    return latest(orders_log(spark, root))


def items(spark: SparkSession, root: str) -> DataFrame:
    """Current items: the newest version first, product names only for those."""
    newest = latest(_item_keys(table(spark, root, "lineitem")), ties=("product_id",))
    return _named(newest, table(spark, root, "part"))


def users(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("username"),
        F.concat(F.lower(F.regexp_replace("c_name", "#", ".")), F.lit("@shop.example")).alias("email"),
        F.col("c_mktsegment").alias("segment"))


def products(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_type").alias("category"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("price"), F.col("p_size").alias("stock"))


def purchases(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "events").filter(F.col("event_type") == "purchase")


def event_orders(spark: SparkSession, root: str) -> DataFrame:
    """Purchase events as orders, for reports that need the time of day."""
    at = F.col("ts").cast("timestamp")
    return purchases(spark, root).select(
        F.col("event_id").alias("id"), "user_id",
        F.when(F.col("user_id") % 10 == 0, "CANCELLED").when(F.col("user_id") % 10 < 7, "COMPLETED")
        .otherwise("PENDING").alias("status"),
        F.col("value").cast("decimal(10,2)").alias("total_amount"),
        at.alias("created_at"), at.alias("updated_at"), F.lit(None).cast("timestamp").alias("deleted_at"),
        F.lit("c").alias("cdc_op"), F.unix_millis(at).alias("cdc_ts_ms"))


def event_items(spark: SparkSession, root: str) -> DataFrame:
    """Purchase events as one item each; two products share each name."""
    at = F.col("ts").cast("timestamp")
    product = F.get_json_object("props", "$.k").cast("bigint")
    amount = F.col("value").cast("decimal(10,2)")
    return purchases(spark, root).select(
        F.col("event_id").alias("id"), F.col("event_id").alias("order_id"), product.alias("product_id"),
        F.concat(F.lit("product "), F.floor(product / 2).cast("string")).alias("product_name"),
        F.lit(1).alias("quantity"), amount.alias("price"), amount.alias("subtotal"),
        at.alias("created_at"), at.alias("updated_at"), F.lit(None).cast("timestamp").alias("deleted_at"),
        F.lit("c").alias("cdc_op"), F.unix_millis(at).alias("cdc_ts_ms"))


def status_log(spark: SparkSession, root: str) -> DataFrame:
    """A status history per order: one version per ship date of its lines."""
    status = (F.when(F.col("l_returnflag") == "N", "PENDING")
              .when((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "O"), "PROCESSING")
              .when(F.col("l_returnflag") == "A", "COMPLETED").otherwise("CANCELLED"))
    shipped = F.col("l_shipdate").cast("timestamp")
    return table(spark, root, "lineitem").select(
        F.col("l_orderkey").alias("id"), status.alias("status"),
        F.unix_millis(shipped).alias("cdc_ts_ms"),
        (F.col("l_linenumber").cast("bigint") * 1_000_000_000 + F.col("l_partkey")).alias("source_pos"))


def status_rows(raw: DataFrame) -> DataFrame:
    """The status history in the shape of order log rows (batch or stream)."""
    shipped = F.col("l_shipdate").cast("timestamp")
    return raw.select(
        F.col("l_orderkey").alias("id"), F.col("l_suppkey").alias("user_id"), F.lit("PENDING").alias("status"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("total_amount"),
        shipped.alias("created_at"), shipped.alias("updated_at"), F.lit(None).cast("timestamp").alias("deleted_at"),
        F.lit("u").alias("cdc_op"), F.unix_millis(shipped).alias("cdc_ts_ms"))


def stock_moves(spark: SparkSession, root: str) -> DataFrame:
    """Stock adjustments per product: returned lines add, the others take away."""
    shipped = F.col("l_shipdate").cast("timestamp")
    quantity = F.col("l_quantity").cast("bigint")
    return table(spark, root, "lineitem").select(
        F.col("l_partkey").alias("product_id"),
        F.when(F.col("l_returnflag") == "R", quantity).otherwise(-quantity).alias("change"),
        F.unix_millis(shipped).alias("moved_at_ms"))
