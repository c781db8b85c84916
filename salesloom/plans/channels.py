"""Sales by channel: totals, week over week, average ticket."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesloom.functions import cleanse as C
from salesloom.functions import predicates as P
from salesloom.operators.ordering import high_first, low_first, top
from salesloom.plans.lines import revenue_of_line, sold_lines


def channel_revenue_from_lines(orders: DataFrame, items: DataFrame, as_of=None, days: int = 30) -> DataFrame:
    """Line revenue and active days per channel; an order without lines adds 0."""
    recent = _labelled_orders(orders, as_of, days)
    lines = (
        sold_lines(recent, items, ["channel", "order_date"], ["qty", "price", "total"])
        .groupBy("channel", "order_date")
        .agg(F.sum(revenue_of_line()).alias("revenue"))
    )
    return _channel_revenue(recent, lines)


def channel_revenue_of_lines(orders: DataFrame, lines: DataFrame, as_of=None, days: int = 30) -> DataFrame:
    """``channel_revenue_from_lines`` from partial sums (channel, order_date, revenue) of the lines."""
    lines = lines.where(P.since_days(F.col("order_date"), as_of, days)).select(
        C.label_or(F.col("channel"), C.UNKNOWN_CHANNEL).alias("channel"), "order_date", "revenue"
    )
    return _channel_revenue(_labelled_orders(orders, as_of, days), lines)


def _labelled_orders(orders: DataFrame, as_of, days: int) -> DataFrame:
    return orders.where(P.since_days(F.col("order_date"), as_of, days)).select(
        "order_id", "order_date", C.label_or(F.col("channel"), C.UNKNOWN_CHANNEL).alias("channel")
    )


def _channel_revenue(recent: DataFrame, lines: DataFrame) -> DataFrame:
    present = recent.select("channel", "order_date").distinct().withColumn(
        "revenue", F.lit(0).cast("decimal(28,4)")
    )
    cells = lines.unionByName(present).groupBy("channel", "order_date").agg(F.sum("revenue").alias("revenue"))
    return (
        cells.groupBy("channel")
        .agg(F.sum("revenue").alias("revenue"), F.count("order_date").alias("active_days"))
        .orderBy(high_first("revenue"), low_first("channel"))
    )


def channel_orders(orders: DataFrame, as_of=None, days: int = 30) -> DataFrame:
    """Orders and header revenue per channel over the last days."""
    recent = orders.where(P.since_days(F.col("order_date"), as_of, days))
    return (
        recent.groupBy(C.label_or(F.col("channel"), C.NO_CHANNEL).alias("channel"))
        .agg(F.count(F.lit(1)).alias("orders"), F.coalesce(F.sum("total"), F.lit(0)).alias("revenue"))
        .orderBy(high_first("revenue"), low_first("channel"))
    )


def daily_channel_orders(orders: DataFrame) -> DataFrame:
    """Orders and revenue per day and channel."""
    return orders.groupBy(
        F.col("order_date").alias("day"), C.label_or(F.col("channel"), C.NO_CHANNEL).alias("channel")
    ).agg(F.count(F.lit(1)).alias("orders"), F.coalesce(F.sum("total"), F.lit(0)).alias("revenue"))


def channel_totals(daily: DataFrame, as_of=None, days: int = 30) -> DataFrame:
    """Channel totals from the daily table. The cutoff is a moment within the
    day ``days`` before, so that day itself is out."""
    recent = daily.where(F.col("day") > F.date_sub(C.as_date(as_of), days))
    return (
        recent.groupBy("channel")
        .agg(F.sum("orders").alias("orders"), F.sum("revenue").cast("decimal(38,2)").alias("revenue"))
        .orderBy(high_first("revenue"), low_first("channel"))
    )


def weekly_channel_revenue(orders: DataFrame, as_of=None, days: int = 90) -> DataFrame:
    """Revenue and orders per channel and week (Monday). Order ids are unique, so
    orders are counted without a distinct."""
    recent = orders.where(P.since_days(F.col("order_date"), as_of, days))
    return (
        recent.groupBy("channel", C.week_of(F.col("order_date")).alias("week"))
        .agg(F.sum("total").alias("revenue"), F.count(F.lit(1)).alias("orders"))
        .orderBy(high_first("week"), low_first("channel"))
    )


def _with_previous(weekly: DataFrame) -> DataFrame:
    """Adds the revenue of the previous week present; one row per channel and week
    enters the window."""
    weeks = Window.partitionBy("channel").orderBy("week")
    return weekly.withColumn("previous", F.lag("revenue").over(weeks))


def weekly_channel_change(orders: DataFrame, as_of=None, days: int = 90) -> DataFrame:
    """Week-over-week change in percent, only against a positive week."""
    weekly = _with_previous(weekly_channel_revenue(orders, as_of, days))
    return weekly.select(
        "channel",
        "week",
        "revenue",
        "previous",
        C.change_pct(F.col("revenue"), F.col("previous")).alias("change_pct"),
    )


def weekly_growth_leaders(orders: DataFrame, as_of=None, days: int = 56, limit: int = 15) -> DataFrame:
    """Channel weeks that grew most, over approved orders."""
    approved = orders.where(P.status_has(F.col("status"))).withColumn(
        "channel", F.coalesce("channel", F.lit(C.NO_CHANNEL))
    )
    weekly = _with_previous(weekly_channel_revenue(approved, as_of, days)).where("previous is not null")
    grown = weekly.select(
        "channel",
        "week",
        "revenue",
        "previous",
        C.ratio(F.col("revenue") - F.col("previous"), F.col("previous")).alias("change"),
    )
    return top(grown, limit, high_first("change"), low_first("channel"), low_first("week"))


def average_ticket(orders: DataFrame, as_of=None, days: int = 180) -> DataFrame:
    """Monthly revenue per order by channel, rounded to cents."""
    recent = orders.where(P.since_days(F.col("order_date"), as_of, days))
    return (
        recent.groupBy("channel", C.month_of(F.col("order_date")).alias("month"))
        .agg(F.count(F.lit(1)).alias("orders"), F.sum("total").alias("revenue"))
        .withColumn("average_ticket", F.round(F.col("revenue") / F.col("orders"), 2))
        .orderBy(high_first("month"), low_first("channel"))
    )


def average_ticket_approved(orders: DataFrame, as_of=None, months: int = 6) -> DataFrame:
    """Monthly revenue per approved order by channel over whole calendar months."""
    recent = orders.where(
        P.since_months(F.col("order_date"), as_of, months) & P.status_has(F.col("status"))
    )
    return (
        recent.groupBy(
            F.coalesce("channel", F.lit(C.NO_CHANNEL)).alias("channel"),
            C.month_of(F.col("order_date")).alias("month"),
        )
        .agg(F.count(F.lit(1)).alias("orders"), F.sum("total").alias("revenue"))
        .withColumn("average_ticket", C.ratio(F.col("revenue"), F.col("orders"), 0.0))
        .orderBy(high_first("month"), low_first("channel"))
    )
