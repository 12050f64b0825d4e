from __future__ import annotations

import datetime as dt
import os
from decimal import Decimal

import pytest

from tillwright.session import build_session
from tillwright.sources import schemas


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(app="tests", master=f"local[{os.environ.get('BENCH_CPUS', '8')}]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.checkpoint.dir": f"file://{tmp_path_factory.mktemp('checkpoints')}",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


PRODUCTS = [
    (101, "Wireless Headphones", "Electronics", "45.00", "89.99"), (102, "Bluetooth Speaker", "Electronics", "20.00", "49.99"),
    (103, "Office Chair", "Furniture", "60.00", "129.99"), (104, "Laptop Charger", "Electronics", "15.00", "34.99"),
    (105, "Desk Lamp", "Furniture", "25.00", "59.99"),
]
STORES = [(201, "New York", "2500.00"), (202, "Los Angeles", "3200.00"), (203, "Chicago", "1800.00")]
SALES = [
    (501, 101, 201, "2025/10/1", 2, "179.98"), (502, 103, 202, "2025/10/1", 1, "129.99"), (503, 102, 201, "2025/10/2", 3, "149.97"),
    (504, 104, 203, "2025/10/2", 5, "174.95"), (505, 105, 202, "2025/10/3", 2, "119.98"), (506, 101, 203, "2025/10/3", 4, "359.96"),
    (507, 103, 201, "2025/10/4", 1, "129.99"), (508, 102, 202, "2025/10/4", 2, "99.98"),
]


def day(text: str) -> dt.date:
    return dt.date(*map(int, text.split("/")))


def star(spark, products=PRODUCTS, sales=SALES, stores=STORES):
    """products, sales, stores as frames."""
    return (
        spark.createDataFrame([(*p[:3], Decimal(p[3]), Decimal(p[4])) for p in products], schemas.PRODUCTS),
        spark.createDataFrame([(*s[:3], day(s[3]), s[4], Decimal(s[5])) for s in sales], schemas.SALES),
        spark.createDataFrame([(*s[:2], Decimal(s[2])) for s in stores], schemas.STORES),
    )


@pytest.fixture()
def retail(spark):
    return star(spark)
