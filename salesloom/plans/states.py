"""Partial sums by day, from which the materialized reports are made.

A state holds, for each month, what the reports need of a day: sums and counts by day, by
day and channel, by day and product, and bitmaps of the product names sold on a day. Days
add up, so a report merges the cells of its days, and a distinct count is that of the
bitmaps' union. A refresh makes anew only the months whose orders, lines or active
products have changed since the state was made; the warehouse's catalog tells which those
are, without reading a row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.functions import cleanse as C
from salesloom.functions import predicates as P
from salesloom.operators.lineage import materialized
from salesloom.operators.ordering import high_first, low_first
from salesloom.operators.ranking import numbered
from salesloom.plans.lines import revenue_of_line, sales_enriched, sold_lines
from salesloom.plans.sales import period_summary_row
from salesloom.sources.warehouse import BATCH, MONTH, Warehouse, month_text

_HELD = ("orders", "order_items")
_CELL_SUMS = ("orders", "order_total", "qty", "items", "line_revenue")


def channel_cells(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Headers and lines by day and channel, as it is written in the header; no lines leave nulls."""
    cell = [F.col("order_date").alias("day"), "channel"]
    headers = orders.groupBy(*cell).agg(F.count(F.lit(1)).alias("orders"), F.sum("total").alias("order_total"))
    lines = sold_lines(orders, items, ["order_date", "channel"], ["qty", "price", "total"]).groupBy(*cell).agg(
        F.sum("qty").alias("qty"), F.sum(C.zero_if_null(F.col("qty"))).alias("items"), F.sum(revenue_of_line()).alias("line_revenue")
    )
    both = headers.unionByName(lines, allowMissingColumns=True).groupBy("day", "channel")
    return both.agg(*[F.sum(name).alias(name) for name in _CELL_SUMS])


def state_days(cells: DataFrame) -> DataFrame:
    """Headers and lines by day, from ``channel_cells``."""
    return cells.groupBy("day").agg(*[F.sum(name).alias(name) for name in _CELL_SUMS])


def state_channels(cells: DataFrame) -> DataFrame:
    """Headers and line revenue by day and channel, from ``channel_cells``."""
    return cells.select("day", "channel", "orders", "order_total", "line_revenue")


def state_products(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Lines by day, sku and name."""
    return sold_lines(orders, items, ["order_date"], ["sku", "product_name", "qty", "price", "total"]).groupBy(
        F.col("order_date").alias("day"), "sku", "product_name"
    ).agg(
        F.sum("qty").alias("qty"), F.sum(C.zero_if_null(F.col("qty"))).alias("items"), F.sum("total").alias("total"),
        F.sum(revenue_of_line()).alias("line_revenue"),
    )


def state_sales(enriched: DataFrame) -> DataFrame:
    """Units and revenue of the active products by day."""
    return enriched.groupBy("day").agg(F.sum("qty").alias("units"), F.sum("total").alias("revenue"))


def state_names(enriched: DataFrame, names: DataFrame) -> DataFrame:
    """Bitmaps of the product names sold by day; ``names`` gives each name its number.

    Names are merged by day before they meet their numbers.
    """
    sold = enriched.select("day", F.col("product").alias("name")).distinct().join(names, "name")
    return sold.groupBy("day", F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("names")
    )


def new_names(known: DataFrame, names: DataFrame) -> DataFrame:
    """Numbers (name, number) of the names that have none yet, without gaps after the last."""
    fresh = names.select("name").distinct().join(known, "name", "left_anti")
    given = F.lit(known.agg(F.max("number")).first()[0] or 0)  # one number
    return numbered(fresh, "number", [F.col("name")]).select("name", (given + F.col("number")).cast("bigint").alias("number"))


def _sources(warehouse: Warehouse, active: DataFrame) -> dict[str, str]:
    """What each month's states are made of: the folders of its orders and lines, and the
    active products, told by a digest."""
    products = active.agg(F.sum(F.xxhash64("code", "tags").cast("decimal(38,0)")), F.count(F.lit(1))).first()
    folders = {name: warehouse.folders(name) for name in _HELD}
    months = sorted({month for held in folders.values() for month in held})
    return {month: json_of([*[folders[name].get(month) for name in _HELD], str(products[0]), products[1]]) for month in months}


def json_of(values: list) -> str:
    return "|".join(str(value) for value in values)


def refresh_states(warehouse: Warehouse) -> list[str]:
    """Bring the states up to date; returns the months made anew. Nothing else is read."""
    active = warehouse.load("dim_product").where(P.is_active(F.col("status")))
    with warehouse.together():
        now, before = _sources(warehouse, active), warehouse.notes("states")
        touched = sorted(month for month in {*now, *before} if now.get(month) != before.get(month))
        if touched:
            orders, items = (warehouse.load(name).where(F.col(MONTH).isin(touched)).drop(MONTH) for name in _HELD)
            # Lines are summed before they are stored: a day has a cell for each name.
            enriched = sales_enriched(orders, items, active).groupBy("day", "product")
            enriched = materialized(enriched.agg(F.sum("qty").alias("qty"), F.sum("total").alias("total")))
            cells = materialized(channel_cells(orders, items))
            known = warehouse.load("product_names").drop(BATCH)
            fresh = materialized(new_names(known, enriched.select(F.col("product").alias("name"))))
            if not fresh.isEmpty():
                warehouse.append("product_names", fresh, f"names-{known.count():012d}")
            names = known.unionByName(fresh)
            states = {
                "state_days": state_days(cells), "state_channels": state_channels(cells),
                "state_products": state_products(orders, items), "state_sales": state_sales(enriched),
                "state_names": state_names(enriched, names),
            }
            for name, rows in states.items():
                warehouse.overwrite_months(name, rows.withColumn(MONTH, month_text(F.col("day"))), touched)
            for month in touched:
                warehouse.note("states", month, now.get(month))
    return touched


def reports_from_states(warehouse: Warehouse, as_of=None) -> dict[str, Callable[[], DataFrame]]:
    """The materialized reports as merges of the states' cells, for ``Warehouse.refresh``."""

    def recent(name: str, days: int) -> DataFrame:
        return warehouse.load(name, F.date_sub(C.as_date(as_of), days)).where(P.since_days(F.col("day"), as_of, days))

    def labelled(cells: DataFrame, label: str, *keys: str) -> DataFrame:
        return cells.groupBy(*keys, C.label_or(F.col("channel"), label).alias("channel")).agg(
            F.sum("orders").alias("orders"), F.coalesce(F.sum("order_total"), F.lit(0)).alias("revenue")
        )

    def daily_orders() -> DataFrame:
        return recent("state_days", 90).where("orders is not null").select(
            "day", "orders", F.coalesce("order_total", F.lit(0)).alias("revenue"), F.coalesce("qty", F.lit(0)).alias("items")
        ).orderBy(high_first("day"))

    def product_ranking() -> DataFrame:
        sums = recent("state_products", 90).groupBy(
            C.label_or(F.col("sku"), C.NO_SKU).alias("sku"), C.label_or(F.col("product_name"), C.NO_NAME).alias("product_name")
        ).agg(F.coalesce(F.sum("total"), F.lit(0)).alias("revenue"), F.coalesce(F.sum("qty"), F.lit(0)).alias("qty"))
        order = [high_first("revenue"), low_first("sku"), low_first("product_name")]
        return numbered(sums, "rank", order).select("rank", "sku", "product_name", "revenue", "qty")

    def product_sales() -> DataFrame:
        return recent("state_products", 90).groupBy("sku").agg(
            F.coalesce(F.max("product_name"), F.lit("")).alias("product_name"), F.sum("items").alias("qty"), F.sum("line_revenue").alias("revenue")
        ).orderBy(high_first("revenue"), high_first("qty"), low_first("sku"))

    def channel_lines() -> DataFrame:
        cells = recent("state_channels", 30).groupBy("day", C.label_or(F.col("channel"), C.UNKNOWN_CHANNEL).alias("channel"))
        by_day = cells.agg(F.coalesce(F.sum("line_revenue"), F.lit(0)).alias("revenue"))
        return by_day.groupBy("channel").agg(F.sum("revenue").alias("revenue"), F.count("day").alias("active_days")).orderBy(
            high_first("revenue"), low_first("channel")
        )

    return {
        "daily_orders": daily_orders,
        "channels_30d": lambda: labelled(recent("state_channels", 30), C.NO_CHANNEL).orderBy(high_first("revenue"), low_first("channel")),
        "product_ranking_90d": product_ranking,
        "daily_orders_lines": lambda: warehouse.load("state_days").select(
            "day", "orders", "items", F.col("line_revenue").alias("revenue")
        ).orderBy(low_first("day")),
        "channel_lines_30d": channel_lines,
        "product_sales_90d": product_sales,
        "daily_channels": lambda: labelled(warehouse.load("state_channels"), C.NO_CHANNEL, "day"),
    }


def period_summary_from_states(warehouse: Warehouse, start, end) -> DataFrame:
    """``period_summary`` of any period from the cells of its days."""
    first = C.as_date(start)

    def within(name: str) -> DataFrame:
        return warehouse.load(name, first).where(P.through_day(F.col("day"), start, end))

    sums = within("state_sales").agg(F.sum("units").alias("units"), F.sum("revenue").alias("revenue"), F.count("day").alias("days"))
    # One bitmap of the period for each 32,768 names.
    sold = within("state_names").groupBy("bucket").agg(F.bitmap_or_agg("names").alias("names"))
    products = sold.agg(F.coalesce(F.sum(F.bitmap_count("names")), F.lit(0)).alias("products"))
    both = sums.unionByName(products, allowMissingColumns=True)  # a row of each
    return period_summary_row(both.agg(*[F.sum(name).alias(name) for name in ("units", "revenue", "days", "products")]), start, end)
