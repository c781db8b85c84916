import os
import sys
from decimal import Decimal

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from salesloom.session import DEFAULTS  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    builder = SparkSession.builder.master("local[4]").appName("tests")
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    session = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def conf(spark):
    """Set Spark settings for one test."""
    changed = {}

    def set_conf(**settings):
        for key, value in settings.items():
            key = key.replace("__", ".")
            changed.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield set_conf
    for key, value in changed.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def money(value):
    return None if value is None else Decimal(str(value))


ORDER_DDL = "order_id bigint, order_date date, channel string, customer_name string, status string, total decimal(18,4)"
ITEM_DDL = "order_id bigint, item_seq int, sku string, product_name string, qty decimal(18,4), price decimal(18,4), total decimal(18,4)"


@pytest.fixture
def make_orders(spark):
    def make(rows):
        from datetime import date

        full = []
        for row in rows:
            order_id, day, *rest = row
            channel, name, status, total = (list(rest) + [None] * 4)[:4]
            full.append((order_id, day and date.fromisoformat(day), channel, name, status, money(total)))
        return spark.createDataFrame(full, ORDER_DDL)

    return make


@pytest.fixture
def make_items(spark):
    def make(rows):
        full = [(o, s, sku, name, money(q), money(p), money(t)) for o, s, sku, name, q, p, t in rows]
        return spark.createDataFrame(full, ITEM_DDL)

    return make


def rows_of(df, *columns):
    """Rows as tuples with decimals as float."""
    picked = df.select(*columns) if columns else df
    return [tuple(float(v) if isinstance(v, Decimal) else v for v in row) for row in picked.collect()]
