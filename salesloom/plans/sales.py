"""Daily, monthly and period sales."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesloom.functions import cleanse as C
from salesloom.functions import predicates as P
from salesloom.operators.ordering import high_first, low_first, top
from salesloom.plans.lines import revenue_of_line, sold_lines


def _by_day(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Header sums per day with those of ``lines``, partial sums of measures by ``day``.

    Orders without lines keep their day, as with an outer join, but the only join
    is an inner one and lines are summed per day before they meet the headers.
    """
    headers = orders.groupBy(F.col("order_date").alias("day")).agg(
        F.count(F.lit(1)).alias("orders"), F.sum("total").alias("order_total")
    )
    both = headers.unionByName(lines, allowMissingColumns=True)
    return both.groupBy("day").agg(
        F.sum("orders").alias("orders"),
        F.sum("order_total").alias("order_total"),
        *[F.sum(name).alias(name) for name in lines.columns if name != "day"],
    )


def _lines_by_day(orders: DataFrame, items: DataFrame, measures: dict) -> DataFrame:
    return (
        sold_lines(orders, items, ["order_date"], ["qty", "price", "total"])
        .groupBy(F.col("order_date").alias("day"))
        .agg(*[measure.alias(name) for name, measure in measures.items()])
    )


def daily_orders_from_lines(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders, items and line revenue per day; no lines on a day leaves nulls."""
    measures = {
        "items": F.sum(C.zero_if_null(F.col("qty"))),
        "revenue": F.sum(revenue_of_line()),
    }
    return daily_orders_of_lines(orders, _lines_by_day(orders, items, measures))


def daily_orders_of_lines(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """``daily_orders_from_lines`` from partial sums (day, items, revenue) of the lines."""
    return _by_day(orders, lines).select("day", "orders", "items", "revenue").orderBy(low_first("day"))


def daily_orders_from_headers(
    orders: DataFrame, items: DataFrame, as_of=None, days: int = 90
) -> DataFrame:
    """Orders, header revenue and items per day of the last ``days`` days."""
    recent = orders.where(P.since_days(F.col("order_date"), as_of, days))
    return daily_orders_of_headers(recent, _lines_by_day(recent, items, {"items": F.sum("qty")}))


def daily_orders_of_headers(recent: DataFrame, lines: DataFrame) -> DataFrame:
    """``daily_orders_from_headers`` from recent orders and partial sums (day, items) of their lines."""
    return (
        _by_day(recent, lines)
        .select(
            "day",
            "orders",
            F.coalesce("order_total", F.lit(0)).alias("revenue"),
            F.coalesce("items", F.lit(0)).alias("items"),
        )
        .orderBy(high_first("day"))
    )


def daily_header_sales(orders: DataFrame) -> DataFrame:
    """Orders, revenue and average ticket per day, from headers."""
    return (
        orders.groupBy(F.col("order_date").alias("day"))
        .agg(F.count(F.lit(1)).alias("orders"), F.coalesce(F.sum("total"), F.lit(0)).alias("revenue"))
        .withColumn("average_ticket", C.ratio(F.col("revenue"), F.col("orders"), 0.0))
    )


def last_days_series(orders: DataFrame, days: int = 14) -> DataFrame:
    """The newest days that have orders, oldest first."""
    return top(daily_header_sales(orders), days, high_first("day")).orderBy(low_first("day"))


def last_days_headline(orders: DataFrame, days: int = 14) -> DataFrame:
    """Totals over the newest days that have orders."""
    newest = top(daily_header_sales(orders), days, high_first("day"))
    totals = newest.agg(
        F.coalesce(F.sum("orders"), F.lit(0)).alias("orders"),
        F.coalesce(F.sum("revenue"), F.lit(0)).alias("revenue"),
    )
    return totals.withColumn("average_ticket", C.ratio(F.col("revenue"), F.col("orders"), 0.0))


def mean_items_per_day(daily: DataFrame, as_of=None, days: int = 14) -> DataFrame:
    """Mean items over the days of the last ``days`` calendar days."""
    recent = daily.where(P.since_days(F.col("day"), as_of, days))
    return recent.agg(F.avg(F.col("items").cast("double")).alias("mean_items"))


def mean_items_newest_days(daily: DataFrame, days: int = 14) -> DataFrame:
    """Mean items over the newest ``days`` days present; 0 without any."""
    newest = top(daily, days, high_first("day"))
    return newest.agg(F.coalesce(F.avg(F.col("items").cast("double")), F.lit(0.0)).alias("mean_items"))


def _in_period(sales: DataFrame, start, end, tag: str | Sequence[str] | None) -> DataFrame:
    rows = sales.where(P.through_day(F.col("day"), start, end))
    return rows.where(P.has_any_tag(F.col("tags"), tag)) if tag else rows


def _tag_column(tag: str | None):
    return F.lit(tag).cast("string").alias("tag")


def period_summary(sales: DataFrame, start, end, tag: str | None = None) -> DataFrame:
    """One row of totals for a period; also when nothing was sold.

    Takes the rollup or the line-level sales. Sums and both distinct counts are
    combined by product and by day in each task before anything is shuffled.
    """
    one = _in_period(sales, start, end, tag).agg(
        F.sum("qty").alias("units"),
        F.sum("total").alias("revenue"),
        F.count_distinct("product").alias("products"),
        F.count_distinct("day").alias("days"),
    )
    return period_summary_row(one, start, end, tag)


def period_summary_row(one: DataFrame, start, end, tag: str | None = None) -> DataFrame:
    """The summary from its one row of sums and counts."""
    return one.select(
        C.as_date(start).alias("start"),
        C.as_date(end).alias("end"),
        _tag_column(tag),
        "units",
        "revenue",
        "products",
        "days",
        F.when(F.col("units") > 0, C.ratio(F.col("revenue"), F.col("units")))
        .otherwise(F.lit(0.0))
        .alias("revenue_per_unit"),
    )


def top_products_in_period(sales: DataFrame, start, end, tag: str | None = None, limit: int = 10) -> DataFrame:
    """Best products of a period by revenue."""
    totals = (
        _in_period(sales, start, end, tag)
        .groupBy("product")
        .agg(F.sum("qty").alias("units"), F.sum("total").alias("revenue"))
        .select("product", _tag_column(tag), "units", "revenue")
    )
    return top(totals, limit, high_first("revenue"), low_first("product"))


def monthly_sales(sales: DataFrame, start, end, tag: str | None = None) -> DataFrame:
    """Units and revenue per month, with the bar width (5 to 100) of a chart."""
    months = (
        _in_period(sales, start, end, tag)
        .groupBy(C.month_of(F.col("day")).alias("month"))
        .agg(F.sum("qty").alias("units"), F.sum("total").alias("revenue"))
    )
    # The window sees one row per month of the period.
    highest = F.max("revenue").over(Window.partitionBy())
    share = C.ratio(F.col("revenue"), highest) * 100
    width = F.when(highest > 0, F.greatest(F.lit(5.0), share)).otherwise(F.lit(0.0))
    return months.select("month", _tag_column(tag), "units", "revenue", width.alias("bar_width")).orderBy(
        low_first("month")
    )


def tag_list(dim_product: DataFrame) -> DataFrame:
    """Distinct tags of the active products."""
    tagged = dim_product.where(P.is_active(F.col("status")) & P.has_tags(F.col("tags")))
    tags = tagged.select(F.explode(F.split("tags", ",")).alias("tag")).select(F.trim("tag").alias("tag"))
    return tags.where("tag <> ''").distinct().orderBy(low_first("tag"))


def fact_daily_sales(f_sales: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Revenue and quantity per day of the fact table.

    The fact is summed by its date key before the date dimension is joined.
    """
    sums = f_sales.groupBy("date_key").agg(F.sum("total").alias("revenue"), F.sum("qty").alias("qty"))
    return (
        sums.join(dim_date.select("date_key", "date_value"), "date_key")
        .groupBy(F.col("date_value").alias("day"))
        .agg(F.sum("revenue").alias("revenue"), F.sum("qty").alias("qty"))
        .orderBy(low_first("day"))
    )
