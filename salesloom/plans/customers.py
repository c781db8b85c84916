"""Best customers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.functions import cleanse as C
from salesloom.functions import predicates as P
from salesloom.operators.ordering import high_first, low_first, top


def _by_customer(orders: DataFrame, limit: int) -> DataFrame:
    totals = orders.groupBy("customer").agg(F.count(F.lit(1)).alias("orders"), F.sum("total").alias("revenue"))
    return top(totals, limit, high_first("revenue"), low_first("customer"))


def top_customers(orders: DataFrame, as_of=None, days: int = 90, limit: int = 50) -> DataFrame:
    """Best customers of the last days over all orders."""
    recent = orders.where(P.since_days(F.col("order_date"), as_of, days))
    return _by_customer(recent.withColumn("customer", F.col("customer_name")), limit)


def top_customers_approved(orders: DataFrame, as_of=None, days: int = 90, limit: int = 20) -> DataFrame:
    """Best customers over approved orders; those without a name share a label."""
    kept = P.last_full_days(F.col("order_date"), as_of, days) & P.status_has(F.col("status"))
    named = orders.where(kept).withColumn("customer", F.coalesce("customer_name", F.lit(C.NO_NAME)))
    return _by_customer(named, limit)
