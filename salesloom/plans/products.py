"""Sales by product: rankings, falling products, ABC curves, margin, unsold stock."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesloom.functions import cleanse as C
from salesloom.functions import predicates as P
from salesloom.operators.lineage import materialized
from salesloom.operators.ordering import high_first, low_first, top
from salesloom.operators.ranking import SUM_TYPE, numbered, running_share
from salesloom.plans.lines import one_per_sku, revenue_of_line, sold_lines


def product_sales(orders: DataFrame, items: DataFrame, as_of=None, days: int = 90) -> DataFrame:
    """Quantity and revenue per sku; lines without a sku form one group.

    Lines are hashed by sku and name first. Taking the greatest name, a text,
    needs sorted rows, and so it sorts the few sums instead of all lines.
    """
    recent = orders.where(P.since_days(F.col("order_date"), as_of, days))
    sums = (
        sold_lines(recent, items, [], ["sku", "product_name", "qty", "price", "total"])
        .groupBy("sku", "product_name")
        .agg(
            F.sum(C.zero_if_null(F.col("qty"))).alias("qty"),
            F.sum(revenue_of_line()).alias("revenue"),
        )
    )
    return product_sales_of_lines(sums)


def product_sales_of_lines(sums: DataFrame) -> DataFrame:
    """``product_sales`` from partial sums (sku, product_name, qty, revenue) of the recent lines."""
    return (
        sums.groupBy("sku")
        .agg(
            F.coalesce(F.max("product_name"), F.lit("")).alias("product_name"),
            F.sum("qty").alias("qty"),
            F.sum("revenue").alias("revenue"),
        )
        .orderBy(high_first("revenue"), high_first("qty"), low_first("sku"))
    )


def labelled_product_sales(orders: DataFrame, items: DataFrame, as_of=None, days: int = 90) -> DataFrame:
    """Revenue and quantity per labelled sku and name."""
    recent = orders.where(P.since_days(F.col("order_date"), as_of, days))
    return (
        sold_lines(recent, items, [], ["sku", "product_name", "qty", "total"])
        .groupBy(
            C.label_or(F.col("sku"), C.NO_SKU).alias("sku"),
            C.label_or(F.col("product_name"), C.NO_NAME).alias("product_name"),
        )
        .agg(
            F.coalesce(F.sum("total"), F.lit(0)).alias("revenue"),
            F.coalesce(F.sum("qty"), F.lit(0)).alias("qty"),
        )
    )


def product_ranking(orders: DataFrame, items: DataFrame, as_of=None, days: int = 90) -> DataFrame:
    """All products numbered by revenue; ties by sku, then name."""
    return _ranked(labelled_product_sales(orders, items, as_of, days))


def product_ranking_of_lines(sums: DataFrame) -> DataFrame:
    """``product_ranking`` from partial sums (sku, product_name, qty, total) of the recent lines."""
    sales = sums.groupBy(
        C.label_or(F.col("sku"), C.NO_SKU).alias("sku"), C.label_or(F.col("product_name"), C.NO_NAME).alias("product_name")
    ).agg(*[F.coalesce(F.sum(of).cast("decimal(28,4)"), F.lit(0)).alias(name) for name, of in (("revenue", "total"), ("qty", "qty"))])
    return _ranked(sales)


def _ranked(sales: DataFrame) -> DataFrame:
    order = [high_first("revenue"), low_first("sku"), low_first("product_name")]
    return numbered(sales, "rank", order).select("rank", "sku", "product_name", "revenue", "qty")


def top_ranked_products(
    orders: DataFrame, items: DataFrame, as_of=None, days: int = 90, limit: int = 10
) -> DataFrame:
    """The best of ``product_ranking``; only ``limit`` rows are numbered."""
    sales = labelled_product_sales(orders, items, as_of, days)
    order = [high_first("revenue"), low_first("sku"), low_first("product_name")]
    best = top(sales, limit, *order)
    return best.select(
        F.row_number().over(Window.orderBy(*order)).cast("bigint").alias("rank"),
        "sku", "product_name", "revenue", "qty",
    )


def falling_products(orders: DataFrame, items: DataFrame, as_of=None, days: int = 30, limit: int = 50) -> DataFrame:
    """Products with revenue in the days before, by how much they lost since.

    One scan with conditional sums. Only products sold in the earlier period
    qualify, so nothing before it needs to be read.
    """
    day = F.col("order_date")
    recent = orders.where(P.since_days(day, as_of, 2 * days)).select(
        "order_id", P.since_days(day, as_of, days).alias("current")
    )
    sums = (
        sold_lines(recent, items, ["current"], ["sku", "product_name", "total"])
        .groupBy("sku", "product_name")
        .agg(
            F.sum(F.when(F.col("current"), F.col("total"))).alias("revenue"),
            F.sum(F.when(~F.col("current"), F.col("total"))).alias("previous"),
        )
        .where("previous > 0")
    )
    fallen = sums.select(
        "sku",
        "product_name",
        "revenue",
        "previous",
        (F.col("revenue") - F.col("previous")).alias("delta"),
        C.change_pct(F.col("revenue"), F.col("previous")).alias("change_pct"),
    )
    return top(fallen, limit, low_first("delta"), low_first("sku"), low_first("product_name"))


def falling_products_approved(
    orders: DataFrame, items: DataFrame, as_of=None, days: int = 30, limit: int = 20
) -> DataFrame:
    """Approved sales by sku and name against the sku's earlier sales.

    A sku sold under two names meets the same earlier sum twice. Lines are joined
    and summed once for both periods; the earlier sums are added up from that.
    """
    day = F.col("order_date")
    today = C.as_date(as_of)
    approved = orders.where(P.last_full_days(day, as_of, 2 * days) & P.status_has(F.col("status")))
    approved = approved.select("order_id", (day >= F.date_sub(today, days)).alias("is_current"))
    sums = (
        sold_lines(approved, items, ["is_current"], ["sku", "product_name", "total"])
        .where("sku is not null")  # without a sku there is no earlier sum to fall from
        .groupBy("sku", "product_name")
        .agg(
            F.count_if("is_current").alias("lines"),
            F.sum(F.when(F.col("is_current"), F.col("total"))).alias("revenue"),
            F.sum(F.when(~F.col("is_current"), F.col("total"))).alias("previous"),
        )
    )
    before = sums.groupBy("sku").agg(F.sum("previous").alias("previous"))
    current = sums.where("lines > 0").select("sku", "product_name", C.zero_if_null(F.col("revenue")).alias("revenue"))
    fallen = (
        current.join(before.where("previous is not null"), "sku")
        .where("revenue < previous")
        .select(
            "sku",
            "product_name",
            "previous",
            "revenue",
            C.ratio(F.col("revenue") - F.col("previous"), F.col("previous")).alias("change"),
        )
    )
    return top(
        fallen, limit, low_first("change"), high_first("previous"), low_first("sku"), low_first("product_name")
    )


# --- the two-period analysis by sku key --------------------------------------


def _two_periods(as_of, days: int = 30):
    """Current ``[d-days, d]`` and previous ``[d-2*days, d-days-1]``, ends included."""
    today = C.as_date(as_of)
    start, before = F.date_sub(today, days), F.date_sub(today, 2 * days)
    day = F.col("order_date")
    return (day >= start) & (day <= today), (day >= before) & (day < start)


def sku_totals(orders: DataFrame, items: DataFrame, as_of=None, days: int = 30) -> DataFrame:
    """Per sku key: lines, quantity and value now, and lines and value before.

    The description is the one of the first line of the current period.
    """
    is_current, is_previous = _two_periods(as_of, days)
    both = orders.where(is_current | is_previous).select("order_id", is_current.alias("current"))
    lines = sold_lines(both, items, ["current"], ["item_seq", "sku", "product_name", "qty", "total"])
    now = F.col("current")
    # Place of a line among all lines as one number, which a hash aggregate can keep.
    place = F.col("order_id").cast("decimal(20,0)") * 10_000_000_000 + F.col("item_seq")
    by_name = lines.groupBy(
        C.sku_key(F.col("sku"), F.col("product_name")).alias("code"),
        F.coalesce("product_name", F.lit("")).alias("name"),
    ).agg(
        F.min(F.when(now, place)).alias("place"),
        F.count_if(now).alias("lines"),
        F.count_if(~now).alias("previous_lines"),
        F.sum(F.when(now, C.zero_if_null(F.col("qty")))).alias("qty"),
        F.sum(F.when(now, C.zero_if_null(F.col("total")))).alias("revenue"),
        F.sum(F.when(~now, C.zero_if_null(F.col("total")))).alias("previous"),
    )
    first_name = F.min(F.when(F.col("place").isNotNull(), F.struct("place", "name")))
    return by_name.groupBy("code").agg(
        first_name["name"].alias("description"),
        *[F.sum(c).alias(c) for c in ("lines", "previous_lines", "qty", "revenue", "previous")],
    )


def top_skus(totals: DataFrame, limit: int = 20) -> DataFrame:
    """Best sku keys of the current period by value."""
    sold = totals.where("lines > 0").select("code", "description", "qty", "revenue")
    return top(sold, limit, high_first("revenue"), low_first("code"))


def product_drops(totals: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Sku keys of both periods that lost at least ``threshold`` of their value."""
    limit = F.lit(str(threshold)).cast("decimal(6,4)")
    change = F.col("revenue") - F.col("previous")
    fallen = totals.where("lines > 0 and previous_lines > 0 and previous > 0").where(
        change <= -(limit * F.col("previous"))
    )
    return fallen.select(
        "code",
        "description",
        F.round("revenue", 2).alias("revenue"),
        F.round("previous", 2).alias("previous"),
        C.change_pct(F.col("revenue"), F.col("previous"), 1).alias("change_pct"),
    ).orderBy(low_first("change_pct"), low_first("code"))


def unsold_products(products: DataFrame, totals: DataFrame) -> DataFrame:
    """Catalogue products with a code that no line of the current period used."""
    sold = totals.where("lines > 0").select("code")
    return (
        products.where(C.first_filled(F.col("sku")).isNotNull())
        .join(sold, products["sku"] == sold["code"], "left_anti")
        .select(
            F.col("sku").alias("code"),
            F.coalesce("product_name", F.lit("")).alias("name"),
            F.coalesce("status", F.lit("")).alias("status"),
        )
    )


def kpi_comparison(orders: DataFrame, items: DataFrame, as_of=None, days: int = 30) -> DataFrame:
    """Revenue and average ticket of both periods. The ticket divides by all orders,
    also those without lines."""
    is_current, is_previous = _two_periods(as_of, days)
    both = orders.where(is_current | is_previous).select("order_id", is_current.alias("current"))
    headers = both.groupBy("current").agg(F.count(F.lit(1)).alias("orders"))
    lines = (
        sold_lines(both, items, ["current"], ["total"])
        .groupBy("current")
        .agg(F.sum(C.zero_if_null(F.col("total"))).alias("revenue"))
    )
    cells = headers.unionByName(lines, allowMissingColumns=True)

    def total(column: str, current: bool):
        side = F.col("current") if current else ~F.col("current")
        return F.coalesce(F.sum(F.when(side, F.col(column))), F.lit(0))

    sums = cells.agg(
        total("revenue", True).alias("revenue"),
        total("orders", True).alias("orders"),
        total("revenue", False).alias("previous_revenue"),
        total("orders", False).alias("previous_orders"),
    )
    return sums.withColumns(
        {
            "average_ticket": C.ratio(F.col("revenue"), F.col("orders"), 0.0),
            "previous_average_ticket": C.ratio(F.col("previous_revenue"), F.col("previous_orders"), 0.0),
        }
    )


# --- ABC curves ---------------------------------------------------------------


def _abc_base(orders: DataFrame, items: DataFrame, kept) -> DataFrame:
    return (
        sold_lines(orders.where(kept), items, [], ["sku", "product_name", "total"])
        .groupBy("sku", "product_name")
        .agg(F.sum("total").alias("revenue"))
    )


def abc_curve(orders: DataFrame, items: DataFrame, as_of=None, days: int = 90) -> DataFrame:
    """All products with cumulative share and class A/B/C at 70 and 90 percent.

    The class looks at the share rounded to one digit.
    """
    base = _abc_base(orders, items, P.since_days(F.col("order_date"), as_of, days))
    shares = running_share(base, "revenue")
    share = C.percent(F.col("cumulative"), F.col("grand_total"), 1)
    grade = (
        F.when(F.col("cumulative_pct") <= 70, "A").when(F.col("cumulative_pct") <= 90, "B").otherwise("C")
    )
    return (
        shares.withColumn("cumulative_pct", share)
        .select("sku", "product_name", "revenue", "cumulative_pct", grade.alias("class"))
        .orderBy(high_first("revenue"), low_first("sku"), low_first("product_name"))
    )


def abc_leaders(orders: DataFrame, items: DataFrame, as_of=None, days: int = 90, limit: int = 30) -> DataFrame:
    """First products of the approved ABC curve, classes at 80 and 95 percent of the
    unrounded share.

    Ranks and running sums of the first rows need only the first revenue values,
    how many products hold each, and the grand total.
    """
    kept = P.last_full_days(F.col("order_date"), as_of, days) & P.status_has(F.col("status"))
    base = _abc_base(orders, items, kept)
    leaders = top(base, limit, high_first("revenue"), low_first("sku"), low_first("product_name"))
    values = base.groupBy("revenue").agg(F.count(F.lit(1)).alias("held"))
    ordered = Window.orderBy(high_first("revenue"))
    # ``limit`` rows reach the windows and the broadcast below.
    running = top(values, limit, high_first("revenue")).select(
        F.col("revenue").alias("value"),
        (F.sum("held").over(ordered) - F.col("held") + 1).alias("position"),
        F.sum(F.coalesce("revenue", F.lit(0)) * F.col("held")).over(ordered).cast(SUM_TYPE).alias("cumulative"),
    )
    rows = leaders.join(F.broadcast(running), F.col("revenue").eqNullSafe(F.col("value"))).withColumn(
        "grand_total", base.agg(F.sum("revenue").cast(SUM_TYPE)).scalar()
    )
    reached, whole = F.col("cumulative"), F.col("grand_total")
    grade = (
        F.when(reached * 100 <= whole * 80, "A").when(reached * 100 <= whole * 95, "B").otherwise("C")
    )
    return rows.select(
        "position", "sku", "product_name", "revenue",
        C.ratio(reached, whole).alias("cumulative_share"), grade.alias("class"),
    ).orderBy(high_first("revenue"), low_first("sku"), low_first("product_name"))


# --- margin -------------------------------------------------------------------


def gross_margin(
    orders: DataFrame, items: DataFrame, products: DataFrame, as_of=None, days: int = 90, limit: int = 20
) -> DataFrame:
    """Estimated gross margin of the approved best sellers; unknown cost counts 0.

    A sku has one cost, so quantities are summed first and the cost is joined to
    the sums: the join sees a sku once per name, not once per line.
    """
    kept = P.last_full_days(F.col("order_date"), as_of, days) & P.status_has(F.col("status"))
    sums = (
        sold_lines(orders.where(kept), items, [], ["sku", "product_name", "qty", "total"])
        .groupBy("sku", "product_name")
        .agg(F.sum("qty").alias("qty"), F.sum("total").alias("revenue"))
        .where("revenue > 0")
    )
    best = top(sums, limit, high_first("revenue"), low_first("sku"), low_first("product_name"))
    # ``limit`` rows, stored because two joins read them; at most as many skus
    # are looked up in the catalogue.
    best = materialized(best)
    wanted = products.join(F.broadcast(best.select("sku").distinct()), "sku", "left_semi")
    cost = one_per_sku(wanted).select("sku", "cost_price")
    priced = best.join(cost, "sku", "left").withColumn(
        "cost", (C.zero_if_null(F.col("qty")) * C.zero_if_null(F.col("cost_price"))).cast("decimal(38,4)")
    )
    margin = F.col("revenue") - F.col("cost")
    return priced.select(
        "sku", "product_name", "qty", "revenue", "cost", margin.alias("margin"),
        C.ratio(margin, F.col("revenue")).alias("margin_share"),
    ).orderBy(high_first("revenue"), low_first("sku"), low_first("product_name"))


def fact_top_skus(f_sales: DataFrame, dim_product: DataFrame, as_of=None, days: int = 30, limit: int = 20) -> DataFrame:
    """Best codes of the fact table by value; the name comes from the dimension.

    The window is compared on the integer date key, the fact's own column. Sums
    are taken by key, code and description before the dimension is joined.
    """
    today = C.as_date(as_of)
    first, last = C.date_key(F.date_sub(today, days)), C.date_key(today)
    sums = (
        f_sales.where((F.col("date_key") >= first) & (F.col("date_key") <= last))
        .groupBy("product_key", "code", "description")
        .agg(F.sum("qty").alias("qty"), F.sum("total").alias("revenue"))
    )
    named = sums.join(dim_product.select("product_key", "name"), "product_key", "left")
    totals = named.groupBy("code", F.coalesce("name", "description").alias("name")).agg(
        F.sum("qty").alias("qty"), F.sum("revenue").alias("revenue")
    )
    return top(totals, limit, high_first("revenue"), low_first("code"), low_first("name"))
