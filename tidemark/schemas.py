"""Fixed schemas of the model. Nothing is inferred."""

from pyspark.sql import types as T

MONEY = T.DecimalType(10, 2)
MONEY_SUM = T.DecimalType(18, 2)

ORDER_STATUSES = ("PENDING", "PROCESSING", "COMPLETED", "CANCELLED")

# The only status changes an order may make.
ALLOWED_TRANSITIONS = (
    ("PENDING", "PROCESSING"),
    ("PENDING", "CANCELLED"),
    ("PROCESSING", "COMPLETED"),
    ("PROCESSING", "CANCELLED"),
)

# Change codes and their labels.
OP_LABELS = {"c": "INSERT", "r": "INSERT", "u": "UPDATE", "d": "DELETE"}

# Display labels of an order status.
STATUS_LABELS = {
    "PENDING": "대기중",
    "PROCESSING": "처리중",
    "COMPLETED": "완료",
    "CANCELLED": "취소됨",
}

_TAIL = [
    T.StructField("created_at", T.TimestampType()),
    T.StructField("updated_at", T.TimestampType()),
    T.StructField("deleted_at", T.TimestampType()),
]
_CHANGE = [T.StructField("cdc_op", T.StringType()), T.StructField("cdc_ts_ms", T.LongType())]

ORDER_FIELDS = [
    T.StructField("id", T.LongType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("total_amount", MONEY),
]
ITEM_FIELDS = [
    T.StructField("id", T.LongType()),
    T.StructField("order_id", T.LongType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("price", MONEY),
    T.StructField("subtotal", MONEY),
]

ORDERS = T.StructType(ORDER_FIELDS + _TAIL)
ORDER_ITEMS = T.StructType(ITEM_FIELDS + _TAIL)
ORDERS_LOG = T.StructType(ORDER_FIELDS + _TAIL + _CHANGE)
ORDER_ITEMS_LOG = T.StructType(ITEM_FIELDS + _TAIL + _CHANGE)

# The log also keeps the position of a change in its source, over all files of the source log:
# of two changes of one row in the same millisecond, the later one wins.
TIE = T.StructField("source_place", T.LongType())

USERS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("username", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("phone", T.StringType()),
] + _TAIL)
PRODUCTS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("price", MONEY),
    T.StructField("stock", T.IntegerType()),
    T.StructField("description", T.StringType()),
] + _TAIL)

# Columns that a row must carry before it may enter the change log.
ORDER_REQUIRED = ("id", "user_id", "cdc_ts_ms")
ITEM_REQUIRED = ("id", "order_id", "product_id", "quantity", "cdc_ts_ms")
