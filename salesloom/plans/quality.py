"""Profiles of the loaded tables: counts, ranges, newest rows, tag coverage."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.functions import cleanse as C
from salesloom.functions import predicates as P
from salesloom.operators.ordering import high_first, low_first, top


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table, one row each. A Parquet count reads no column."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts).orderBy("table")


def table_counts_row(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table as one row, one column each."""
    counts = table_counts(tables)
    return counts.agg(*[F.max(F.when(F.col("table") == name, F.col("rows"))).alias(name) for name in tables])


def order_range(orders: DataFrame) -> DataFrame:
    """First and last order day, number of orders, total."""
    return orders.agg(
        F.min("order_date").alias("first_day"),
        F.max("order_date").alias("last_day"),
        F.count(F.lit(1)).alias("orders"),
        F.sum("total").cast("decimal(38,2)").alias("total"),
    )


def newest_days(orders: DataFrame, limit: int = 10) -> DataFrame:
    """Newest days with their order count and total."""
    days = orders.groupBy(F.col("order_date").alias("day")).agg(
        F.count(F.lit(1)).alias("orders"), F.sum("total").cast("decimal(38,2)").alias("total")
    )
    return top(days, limit, high_first("day"))


def channels_by_revenue(orders: DataFrame, limit: int = 15) -> DataFrame:
    """Channels of all time by total."""
    channels = orders.groupBy(F.coalesce("channel", F.lit(C.NULL_CHANNEL)).alias("channel")).agg(
        F.count(F.lit(1)).alias("orders"), F.sum("total").cast("decimal(38,2)").alias("total")
    )
    return top(channels, limit, high_first("total"), low_first("channel"))


def newest_orders(orders: DataFrame, limit: int = 5) -> DataFrame:
    columns = ["order_id", "external_id", "order_number", "order_date", "channel", "status", "total"]
    return top(orders.select(*columns), limit, high_first("order_date"), high_first("order_id"))


def newest_lines(orders: DataFrame, items: DataFrame, limit: int = 5) -> DataFrame:
    """Lines of the newest orders.

    Every order has its lines together in the result, so at most ``limit`` orders
    that have lines matter: those are picked before any line column is read.
    """
    order = [high_first("order_date"), high_first("order_id")]
    with_lines = orders.select("order_id", "order_date").join(
        items.select("order_id"), "order_id", "left_semi"
    )
    newest = top(with_lines, limit, *order)
    lines = items.select("order_id", "item_seq", "sku", "product_name", "qty", "price", "total").join(
        F.broadcast(newest), "order_id"
    )
    ties = [low_first(c) for c in ("item_seq", "sku", "product_name", "qty", "price", "total")]
    return top(lines, limit, *order, *ties)


def newest_products(products: DataFrame, limit: int = 5) -> DataFrame:
    return top(
        products.select("id", "sku", "product_name", "price", "cost_price"), limit, high_first("id")
    )


def newest_rows(table: DataFrame, key: str, limit: int = 3) -> DataFrame:
    """Newest rows of any table by its key; the rest of the row breaks ties."""
    return top(table, limit, high_first(key), *[low_first(c) for c in table.columns if c != key])


def load_summary(orders: DataFrame, items: DataFrame, start, end) -> DataFrame:
    """Orders, lines and gross value loaded for a period."""
    kept = orders.where(P.through_day(F.col("order_date"), start, end))
    headers = kept.agg(F.count(F.lit(1)).alias("orders"))
    lines = (
        items.select("order_id", "total")
        .join(kept.select("order_id"), "order_id")
        .agg(F.count(F.lit(1)).alias("lines"), F.coalesce(F.sum("total"), F.lit(0)).alias("gross"))
    )
    both = headers.unionByName(lines, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in ("orders", "lines", "gross")])


def load_sample(orders: DataFrame, items: DataFrame, start, end, limit: int = 10) -> DataFrame:
    """Newest lines loaded for a period."""
    return newest_lines(orders.where(P.through_day(F.col("order_date"), start, end)), items, limit)


def tag_coverage(dim_product: DataFrame, enriched_rows: DataFrame) -> DataFrame:
    """Products, products with tags, and rows of the enriched sales."""
    dim = dim_product.agg(
        F.count(F.lit(1)).alias("products"), F.count_if(P.has_tags(F.col("tags"))).alias("with_tags")
    )
    both = dim.unionByName(enriched_rows, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in ("products", "with_tags", "enriched_rows")])


def tagged_sample(dim_product: DataFrame, limit: int = 10) -> DataFrame:
    tagged = dim_product.where(P.has_tags(F.col("tags"))).select("code", "name", "tags")
    return top(tagged, limit, low_first("code"))
