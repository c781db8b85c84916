"""The daily report as one table, and the set of materialized reports."""

from __future__ import annotations

from functools import cache, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.functions import predicates as P
from salesloom.operators.lineage import materialized
from salesloom.plans import channels, products, sales
from salesloom.plans.lines import line_cells


def report_tables(orders: DataFrame, items: DataFrame, as_of=None) -> DataFrame:
    """Sections ``channels``, ``top_products`` and ``items_per_day`` in one long table."""
    channel_rows = channels.channel_orders(orders, as_of).select(
        F.lit("channels").alias("section"),
        F.lit(None).cast("bigint").alias("rank"),
        F.col("channel").alias("key"),
        F.lit(None).cast("string").alias("name"),
        "revenue",
        F.col("orders").cast("decimal(38,4)").alias("quantity"),
    )
    best = products.top_ranked_products(orders, items, as_of).select(
        F.lit("top_products").alias("section"),
        "rank",
        F.col("sku").alias("key"),
        F.col("product_name").alias("name"),
        "revenue",
        F.col("qty").cast("decimal(38,4)").alias("quantity"),
    )
    daily = sales.daily_orders_from_headers(orders, items, as_of)
    mean = sales.mean_items_per_day(daily, as_of).select(
        F.lit("items_per_day").alias("section"),
        F.lit(None).cast("bigint").alias("rank"),
        F.lit("mean").alias("key"),
        F.lit(None).cast("string").alias("name"),
        F.lit(None).cast("decimal(38,4)").alias("revenue"),
        F.round(F.col("mean_items").cast("decimal(38,4)"), 4).alias("quantity"),
    )
    return reduce(DataFrame.unionByName, [channel_rows, best, mean])


def materialized_reports(orders: DataFrame, items: DataFrame, as_of=None, recent=None) -> dict:
    """Report name to the function that builds it, for ``Warehouse.refresh``.

    ``recent`` gives orders and lines that cover the last 90 days, such as
    ``Warehouse.recent``; the reports over days read those instead of everything.
    Lines meet their orders once, for the first report that is built; the sums are stored
    for the others.
    """
    new_orders, new_items = recent or (orders, items)
    day = F.col("order_date")

    def summed(orders: DataFrame, items: DataFrame):
        return cache(lambda: materialized(line_cells(orders, items, P.since_days(day, as_of, 90))))

    every = summed(orders, items)
    new = summed(new_orders, new_items) if recent else every

    def lately(*columns) -> DataFrame:
        return new().where(P.since_days(day, as_of, 90)).select(*columns)

    return {
        "daily_orders": lambda: sales.daily_orders_of_headers(
            new_orders.where(P.since_days(day, as_of, 90)), lately(day.alias("day"), F.col("qty").alias("items"))
        ),
        "channels_30d": lambda: channels.channel_orders(new_orders, as_of),
        "product_ranking_90d": lambda: products.product_ranking_of_lines(lately("sku", "product_name", "qty", "total")),
        "daily_orders_lines": lambda: sales.daily_orders_of_lines(orders, every().select(day.alias("day"), "items", "revenue")),
        "channel_lines_30d": lambda: channels.channel_revenue_of_lines(new_orders, new(), as_of),
        "product_sales_90d": lambda: products.product_sales_of_lines(
            lately("sku", "product_name", F.col("items").alias("qty"), "revenue")
        ),
        "daily_channels": lambda: channels.daily_channel_orders(orders),
    }


# Key that must be unique in each materialized report.
REPORT_KEYS = {
    "daily_orders": ["day"],
    "channels_30d": ["channel"],
    "product_ranking_90d": ["rank"],
    "daily_orders_lines": ["day"],
    "channel_lines_30d": ["channel"],
    "product_sales_90d": ["sku"],
    "daily_channels": ["day", "channel"],
}
