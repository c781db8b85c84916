"""Building and repairing the warehouse tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.functions import cleanse as C
from salesloom.functions import predicates as P
from salesloom.operators.lineage import broadcast_if_small, materialized
from salesloom.operators.ranking import numbered
from salesloom.operators.skew import heavy_values, spread_left_join
from salesloom.operators.upsert import distinct_values, insert_new, newest_per_key, one_of_each, upsert
from salesloom.sources.sinks import with_raw_json


def dim_date(spark: SparkSession, as_of=None, years_back: int = 6, years_ahead: int = 1) -> DataFrame:
    """One row per day around the as-of day; Sunday is day 0 of the week."""
    today = C.as_date(as_of)
    days = F.sequence(F.add_months(today, -12 * years_back), F.add_months(today, 12 * years_ahead))
    day = F.col("date_value")
    dow = F.dayofweek(day) - 1
    return spark.range(1).select(F.explode(days).alias("date_value")).select(
        C.date_key(day).alias("date_key"),
        "date_value",
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        F.date_format(day, "MMMM").alias("month_name"),
        dow.alias("dow"),
        F.date_format(day, "EEEE").alias("dow_name"),
        dow.isin(0, 6).alias("is_weekend"),
    )


def new_product_keys(known: DataFrame, codes: DataFrame) -> DataFrame:
    """Keys (code, product_key) of the codes that the registry ``known`` lacks: numbers
    after its greatest, in the order of the codes. A key that was given once stays."""
    fresh = codes.select("code").where("code is not null").distinct().join(known, "code", "left_anti")
    given = F.lit(known.agg(F.max("product_key")).first()[0] or 0)  # one number
    return numbered(fresh, "product_key", [F.col("code")]).select("code", (given + F.col("product_key")).cast("bigint").alias("product_key"))


def dim_product_rows(stg_products: DataFrame, updated_at=None, keys: DataFrame | None = None) -> DataFrame:
    """Dimension rows from staging: the newest product of each code, with its key from the
    registry (null without one)."""
    newest = newest_per_key(
        stg_products.select(
            "code", "created_at", F.col("id").alias("id_src"),
            "name", "gtin", "unit", "status", "location", "price", "promo_price", "tags",
        ),
        ["code"],
        ["created_at", "id_src"],
    )
    newest = newest.join(keys, "code", "left") if keys is not None else newest.withColumn("product_key", F.lit(None).cast("bigint"))
    return newest.select(
        "product_key",
        "code", "id_src", "name", "gtin", "unit", "status", "location", "price", "promo_price",
        "created_at",
        (F.current_timestamp() if updated_at is None else updated_at).alias("updated_at"),
        "tags",
    )


def upsert_dim_product(
    dim_product: DataFrame, stg_products: DataFrame, updated_at=None, keys: DataFrame | None = None
) -> DataFrame:
    """Dimension after staging: known codes updated, new ones added, others kept.

    Staging has no tags of products that got theirs from their detail, so a known
    tag stays where staging has none.
    """
    known = dim_product.select("code", F.col("tags").alias("_known"))
    rows = dim_product_rows(stg_products, updated_at, keys).join(known, "code", "left")
    rows = rows.withColumn("tags", F.coalesce("tags", "_known")).drop("_known")
    return upsert(dim_product, rows, ["code"], ["updated_at"])


def fact_rows(
    stg_items: DataFrame, stg_orders: DataFrame, dim_product: DataFrame | None, as_of=None, days: int | None = 30,
    heavy: Sequence | None = None,
) -> DataFrame:
    """Fact rows of the window, one per staged (order, line); without product keys where no
    dimension is given. ``heavy`` names the codes that hold very many lines, where that is
    known; otherwise they are looked for.

    Staging may hold the same line several times; one of them counts, always the
    same, so a rerun loads the same rows. An order without a date counts as of today.
    """
    today = C.as_date(as_of)
    day = F.coalesce(C.parse_source_day(F.col("order_date_text")), today)
    headers = newest_per_key(
        stg_orders.select("order_id", "order_number", "order_date_text", "status"),
        ["order_id"],
        ["order_number"],
    ).select("order_id", "order_number", F.col("status").alias("order_status"), day.alias("order_date"))
    lines = stg_items.select("order_id", "item_seq", "code", "description", "qty", "unit_price", "total")
    if days is not None:
        headers = headers.where(
            (F.col("order_date") >= F.date_sub(today, days)) & (F.col("order_date") <= today)
        )
        # A window's orders are few and stored, so other lines go without a shuffle.
        headers = broadcast_if_small(materialized(headers))
        lines = lines.join(headers.select("order_id"), "order_id", "left_semi")
    # Lines are deduplicated before they meet their headers, so that they are joined once. A
    # join lets an order with very many lines be split.
    lines = one_of_each(lines, ["order_id", "item_seq"]).join(headers, "order_id")
    if dim_product is None:
        keyed = lines.withColumn("product_key", F.lit(None).cast("bigint"))
    else:
        heavy = heavy_values(stg_items, "code") if heavy is None else heavy
        keyed = spread_left_join(lines, dim_product.select("code", "product_key"), "code", heavy, ["order_id", "item_seq"])
    return keyed.select(
        C.date_key(F.col("order_date")).alias("date_key"),
        "order_id", "item_seq", "order_number", "product_key", "code", "description",
        C.zero_if_null(F.col("qty")).alias("qty"),
        C.zero_if_null(F.col("unit_price")).alias("unit_price"),
        C.zero_if_null(F.col("total")).alias("total"),
        "order_status",
    )


def reload_window(f_sales: DataFrame, window_rows: DataFrame, as_of=None, days: int = 30) -> DataFrame:
    """Fact table with the window's rows replaced; days outside it stay."""
    today = C.as_date(as_of)
    first, last = C.date_key(F.date_sub(today, days)), C.date_key(today)
    outside = f_sales.where((F.col("date_key") < first) | (F.col("date_key") > last))
    return outside.unionByName(window_rows)


def reload_fact_window(warehouse, stg_items, stg_orders, dim_product, as_of=None, days: int = 30) -> list[str]:
    """``reload_window`` on the stored fact table. Only the months the window
    touches are read, of staging too, and rewritten; rows of an edge month outside
    the window are carried over. An order that moved into the window leaves no facts
    on its old day: months that hold such facts are rewritten without them. Returns
    the months rewritten."""
    day = C.as_date(as_of)
    span = F.sequence(F.trunc(F.date_sub(day, days), "MM"), day, F.expr("interval 1 month"))
    months = [
        row[0]
        for row in warehouse.spark.range(1).select(F.explode(span).alias("day"))
        .select(F.date_format("day", "yyyy-MM")).collect()
    ]
    # Stored staging lies by month; orders without a day lie apart and count as of today.
    stg_items, stg_orders = (
        staged.where(F.col("month").isin([*months, "none"])) if "month" in staged.columns else staged
        for staged in (stg_items, stg_orders)
    )
    rows = materialized(fact_rows(stg_items, stg_orders, dim_product, as_of, days))
    loaded = materialized(rows.select("order_id").distinct())
    with warehouse.together():
        homes = distinct_values(warehouse.homes("f_sales", loaded).select("month"))
        left = [month for month in homes if month not in months]
        facts = warehouse.load("f_sales").where(F.col("month").isin(months + left)).drop("month")
        stored = facts.join(broadcast_if_small(loaded), "order_id", "left_anti")
        key = F.col("date_key")
        month = F.format_string("%04d-%02d", F.floor(key / 10000).cast("int"), (F.floor(key / 100) % 100).cast("int"))
        warehouse.overwrite_months(
            "f_sales", reload_window(stored, rows, as_of, days).withColumn("month", month), months + left
        )
    return months + left


def backfill_item_totals(items: DataFrame) -> DataFrame:
    """A line total that is missing or zero becomes quantity times price."""
    computed = (C.zero_if_null(F.col("qty")) * C.zero_if_null(F.col("price"))).cast("decimal(18,4)")
    return items.withColumn("total", F.when(_lacks_total(), computed).otherwise(F.col("total")))


def backfill_order_totals(orders: DataFrame, items: DataFrame) -> DataFrame:
    """An order total that is missing or zero becomes the sum of its lines.

    Only such orders meet the line sums. Lines are summed per order before the join.
    """
    sums = items.groupBy("order_id").agg(
        F.sum(C.line_revenue(F.col("total"), F.col("qty"), F.col("price"))).cast("decimal(18,4)").alias("line_sum")
    )
    return (
        orders.join(sums, "order_id", "left")
        .withColumn("total", F.when(_lacks_total(), F.coalesce("line_sum", "total")).otherwise(F.col("total")))
        .select(*orders.columns)
    )


def _lacks_total() -> Column:
    return F.col("total").isNull() | (F.col("total") == 0)


def _lacks_channel() -> Column:
    channel = F.col("channel")
    return channel.isNull() | (channel == "") | (F.lower(channel) == "null")


def label_missing_channels(orders: DataFrame) -> DataFrame:
    return orders.withColumn("channel", F.when(_lacks_channel(), F.lit(C.NO_CHANNEL)).otherwise(F.col("channel")))


def backfill(orders: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Line totals, then order totals, then channel labels; the order matters."""
    fixed_items = backfill_item_totals(items)
    return label_missing_channels(backfill_order_totals(orders, fixed_items)), fixed_items


def backfill_tables(warehouse) -> None:
    """``backfill`` on the stored tables, both in one switch. Only months that lack
    something are rewritten; lines lie in the month of their order, so a month is enough
    to total its orders."""
    with warehouse.together():
        _backfill_parts(warehouse)


def _backfill_parts(warehouse) -> None:
    items = warehouse.load("order_items")
    months = distinct_values(items.where(_lacks_total()).select("month"))
    if months:
        lacking = items.where(F.col("month").isin(months))
        warehouse.overwrite_months("order_items", backfill_item_totals(lacking), months, moved=False)
    orders = warehouse.load("orders")
    months = distinct_values(orders.where(_lacks_total() | _lacks_channel()).select("month"))
    if months:
        these = F.col("month").isin(months)
        lines = warehouse.load("order_items").where(these)
        fixed = label_missing_channels(backfill_order_totals(orders.where(these), lines))
        warehouse.overwrite_months("orders", fixed, months, moved=False)


def fill_tags(
    dim_product: DataFrame, categories: DataFrame, batch: int | None = None, updated_at=None
) -> DataFrame:
    """Give the untagged active products whose detail is known the leaf of its category.

    Products whose detail is missing stay in the queue and hold up no others. A
    ``batch`` takes the lowest ids among those that can be filled.
    """
    queue = P.awaits_tags(dim_product).select("id_src", "code")
    ready = categories.join(queue, "id_src")
    if batch is not None:
        ready = ready.orderBy("id_src", "code").limit(batch)
    found = newest_per_key(ready.select("code", F.col("tag").alias("new_tag")), ["code"], [])
    stamp = F.current_timestamp() if updated_at is None else updated_at
    filled = dim_product.join(found, "code", "left")
    return filled.select(
        *[
            F.coalesce("new_tag", "tags").alias("tags")
            if name == "tags"
            else F.when(F.col("new_tag").isNotNull(), stamp).otherwise(F.col(name)).alias(name)
            if name == "updated_at"
            else F.col(name)
            for name in dim_product.columns
        ]
    )


def migrate_orders(orders: DataFrame, legacy: DataFrame) -> DataFrame:
    """Orders plus those legacy orders whose id is not known yet."""
    renamed = with_raw_json(legacy).select(
        F.col("id").alias("order_id"),
        F.lit(None).cast("string").alias("external_id"),
        F.col("numero").alias("order_number"),
        C.utc_day(F.col("data_pedido")).alias("order_date"),
        F.col("canal_venda").alias("channel"),
        F.col("cliente_id").alias("customer_id"),
        F.col("cliente_nome").alias("customer_name"),
        F.col("situacao").alias("status"),
        F.col("valor_total").alias("total"),
        "raw_json",
    )
    return insert_new(orders, renamed.select(*orders.columns), ["order_id"])


def migrate_items(items: DataFrame, legacy: DataFrame) -> DataFrame:
    """Lines plus those legacy lines whose (order, number) is not known yet.

    Known ones go before the others get their JSON, so no text is shuffled that is not kept.
    """
    keys = ["order_id", "item_seq"]
    columns = legacy.columns
    legacy = with_raw_json(legacy.join(items.select(*keys), keys, "left_anti").select(*columns))
    renamed = legacy.select(
        "order_id",
        "item_seq",
        F.col("produto_id").alias("product_id"),
        F.col("produto_codigo").alias("sku"),
        F.col("produto_nome").alias("product_name"),
        F.col("quantidade").alias("qty"),
        F.col("valor_unitario").alias("price"),
        F.col("valor_total").alias("total"),
        "raw_json",
    )
    fresh = newest_per_key(renamed.select(*items.columns), keys, [])
    return items.unionByName(fresh.select(*items.columns))
