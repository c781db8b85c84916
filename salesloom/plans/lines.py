"""Joins that the reports share.

Order lines join order headers on the order id as an inner join. Both sides are
narrowed first: headers by date and status, lines to the columns in use. An
inner sort-merge join is one that adaptive execution may split when a single
order (or sku) holds a large part of the lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.functions import cleanse as C
from salesloom.functions.predicates import is_active
from salesloom.operators.upsert import newest_per_key


def sold_lines(orders: DataFrame, items: DataFrame, header: list[str], line: list[str]) -> DataFrame:
    """Lines with the named header columns of their order."""
    return items.select("order_id", *line).join(orders.select("order_id", *header), "order_id")


def revenue_of_line() -> Column:
    return C.line_revenue(F.col("total"), F.col("qty"), F.col("price"))


def enriched_total() -> Column:
    """Line total, else quantity times price when both are known, else zero."""
    return C.zero_if_null(
        C.line_revenue(F.col("total"), F.col("qty"), F.col("price"), default_zero=False)
    )


def line_cells(orders: DataFrame, items: DataFrame, recent: Column) -> DataFrame:
    """Sums of lines by day, and for ``recent`` orders by channel, sku and name besides.

    One join from which all reports over lines are made; older days are one cell each.
    """
    lines = sold_lines(orders, items, ["order_date", "channel"], ["sku", "product_name", "qty", "price", "total"])
    keys = [F.when(recent, F.col(name)).alias(name) for name in ("channel", "sku", "product_name")]
    return lines.groupBy("order_date", *keys).agg(
        F.sum("qty").alias("qty"), F.sum(C.zero_if_null(F.col("qty"))).alias("items"),
        F.sum("total").alias("total"), F.sum(revenue_of_line()).alias("revenue"),
    )


def one_per_sku(products: DataFrame) -> DataFrame:
    """Catalogue with one row per sku, the newest; a repeated sku would multiply sales."""
    return newest_per_key(products.select("sku", "created_at", "id", "cost_price"), ["sku"], ["created_at", "id"])


def sales_enriched(orders: DataFrame, items: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Line-level sales of active products: day, product, tags, qty, total."""
    active = dim_product.where(is_active(F.col("status"))).select("code", "tags")
    lines = sold_lines(orders, items, ["order_date"], ["sku", "product_name", "qty", "price", "total"])
    return lines.join(active, F.col("sku") == F.col("code")).select(
        F.col("order_date").alias("day"),
        F.coalesce("product_name", F.lit(C.NO_NAME)).alias("product"),
        C.strip_tags(F.col("tags")).alias("tags"),
        C.zero_if_null(F.col("qty")).alias("qty"),
        enriched_total().alias("total"),
    )


def sales_rollup(orders: DataFrame, items: DataFrame, dim_product: DataFrame) -> DataFrame:
    """``sales_enriched`` summed by day, product and tags, with the line count.

    Lines are summed by day, sku and name before the product join, so the join
    sees a sku at most once per day and name, however many lines it has.
    """
    lines = sold_lines(orders, items, ["order_date"], ["sku", "product_name", "qty", "price", "total"])
    cells = lines.groupBy(
        F.col("order_date").alias("day"),
        "sku",
        F.coalesce("product_name", F.lit(C.NO_NAME)).alias("product"),
    ).agg(
        F.sum(C.zero_if_null(F.col("qty"))).alias("qty"),
        F.sum(enriched_total()).alias("total"),
        F.count(F.lit(1)).alias("lines"),
    )
    active = dim_product.where(is_active(F.col("status"))).select("code", "tags")
    return cells.join(active, F.col("sku") == F.col("code")).select(
        "day", "product", C.strip_tags(F.col("tags")).alias("tags"), "qty", "total", "lines"
    )
