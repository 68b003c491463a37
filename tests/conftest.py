import os
import sys
from datetime import datetime
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.schemas import ORDER_ITEMS_LOG, ORDERS_LOG  # noqa: E402
from tidemark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[*]", 8, {
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def texts(spark):
    """Event texts as a DataFrame."""
    return lambda *values: spark.createDataFrame([(v,) for v in values], "value string")


# The seed orders (id, user, status, total) and items
# (order, product, quantity, price), with their common time.
SEED_ORDERS = [
    (1, 101, "COMPLETED", 1799000), (2, 102, "PROCESSING", 2190000), (3, 103, "PENDING", 289000),
    (4, 104, "COMPLETED", 456000), (5, 105, "COMPLETED", 87500), (6, 106, "PROCESSING", 135000),
    (7, 101, "COMPLETED", 234000), (8, 107, "PENDING", 178000), (9, 108, "CANCELLED", 52000),
    (10, 109, "PROCESSING", 899000)]
SEED_ITEMS = [
    (1, 1001, 1, 1299000), (1, 1002, 1, 250000), (1, 1003, 1, 50000), (2, 2001, 1, 1690000), (2, 2002, 1, 50000),
    (2, 2003, 1, 150000), (3, 3001, 1, 189000), (3, 3002, 2, 50000), (4, 4001, 1, 456000), (5, 5001, 1, 36000),
    (5, 5002, 1, 33000), (5, 5003, 1, 18500), (6, 6001, 1, 135000), (7, 7001, 1, 149000), (7, 7002, 1, 45000),
    (7, 7003, 1, 40000), (8, 8001, 1, 89000), (8, 8002, 1, 89000), (9, 9001, 1, 52000), (10, 10001, 1, 899000)]
AT = datetime(2025, 1, 10, 12, 0, 0)


@pytest.fixture(scope="session")
def seed_orders(spark):
    return spark.createDataFrame(
        [(i, u, s, Decimal(t), AT, AT, None, "c", 1000) for i, u, s, t in SEED_ORDERS], ORDERS_LOG)


@pytest.fixture(scope="session")
def seed_items(spark):
    return spark.createDataFrame(
        [(n, o, p, f"product {p}", q, Decimal(c), Decimal(q * c), AT, AT, None, "c", 1000)
         for n, (o, p, q, c) in enumerate(SEED_ITEMS, 1)], ORDER_ITEMS_LOG)
