"""Named queries over the given tables, one or more per report and operator."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom import schemas
from salesloom.contract import pages
from salesloom.contract.tables import AS_OF, MONEY, Shop, utc_midnight
from salesloom.functions import cleanse as C
from salesloom.functions import predicates as P
from salesloom.operators.lineage import broadcast_if_small, ensure_checkpoint_dir, materialized
from salesloom.operators.ordering import high_first, last_key, low_first, page, page_after
from salesloom.operators.ranking import running_share
from salesloom.operators.skew import heavy_values
from salesloom.operators.upsert import duplicate_keys, replace_keys, upsert
from salesloom.plans import channels, customers, dataset, maintain, products, quality, questions, sales, search, states
from salesloom.plans.lines import sales_enriched, sales_rollup, sold_lines
from salesloom.sources import landing
from salesloom.sources.sinks import with_raw_json, write_csv
from salesloom.sources.warehouse import Warehouse, add_missing_columns, month_text
from salesloom.streaming.ingest import apply_order_details, apply_order_pages, ingest_increment, ingest_products, load_fact_window

START, END, TAG = "2000-07-01", "2001-07-31", "promo"
VOCABULARY = ("economy", "small", "medium", "promo", "brand#2", "brand#11")

_QUERIES: dict[str, Callable[[Shop], DataFrame]] = {}


def query(build: Callable[[Shop], DataFrame]) -> Callable[[Shop], DataFrame]:
    _QUERIES[build.__name__] = build
    return build


def plain(df: DataFrame) -> DataFrame:
    """Column types that any SQL engine shows alike: text, bigint, double, boolean."""

    def shown(name: str, kind: str):
        column = F.col(f"`{name}`")
        if kind.startswith("decimal") or kind == "float":
            return column.cast("double").alias(name)
        if kind in ("tinyint", "smallint", "int"):
            return column.cast("bigint").alias(name)
        if kind == "timestamp":
            utc = F.convert_timezone(None, F.lit("UTC"), column.cast("timestamp_ntz"))
            return utc.cast("string").alias(name)
        if kind in ("date", "timestamp_ntz"):
            return column.cast("string").alias(name)
        return column

    return df.select(*[shown(name, kind) for name, kind in df.dtypes])


def bound_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build):
        return lambda spark, sf_dir: plain(build(Shop(spark, sf_dir)))

    return {name: bind(build) for name, build in _QUERIES.items()}


# --- sales reports --------------------------------------------------------------


@query
def daily_orders_from_lines(s: Shop) -> DataFrame:
    return sales.daily_orders_from_lines(s.orders, s.order_items)


@query
def daily_orders_from_headers(s: Shop) -> DataFrame:
    return sales.daily_orders_from_headers(s.orders, s.order_items, AS_OF)


@query
def channel_revenue_from_lines(s: Shop) -> DataFrame:
    return channels.channel_revenue_from_lines(s.orders, s.order_items, AS_OF)


@query
def channel_orders(s: Shop) -> DataFrame:
    return channels.channel_orders(s.orders, AS_OF)


@query
def product_sales(s: Shop) -> DataFrame:
    return products.product_sales(s.orders, s.order_items, AS_OF)


@query
def product_ranking(s: Shop) -> DataFrame:
    return products.product_ranking(s.orders, s.order_items, AS_OF)


@query
def product_ranking_sliced(s: Shop) -> DataFrame:
    """The ranking by sorted slices, over all days."""
    return products.product_ranking(s.orders, s.order_items, AS_OF, days=20000)


@query
def top_ranked_products(s: Shop) -> DataFrame:
    return products.top_ranked_products(s.orders, s.order_items, AS_OF)


@query
def sales_enriched_lines(s: Shop) -> DataFrame:
    return sales_enriched(s.orders, s.order_items, s.dim_product)


@query
def sales_enriched_rollup(s: Shop) -> DataFrame:
    return sales_rollup(s.orders, s.order_items, s.dim_product)


@query
def weekly_channel_revenue(s: Shop) -> DataFrame:
    return channels.weekly_channel_revenue(s.orders, AS_OF)


@query
def weekly_channel_change(s: Shop) -> DataFrame:
    return channels.weekly_channel_change(s.orders, AS_OF)


@query
def weekly_growth_leaders(s: Shop) -> DataFrame:
    return channels.weekly_growth_leaders(s.orders, AS_OF)


@query
def falling_products(s: Shop) -> DataFrame:
    return products.falling_products(s.orders, s.order_items, AS_OF)


@query
def falling_products_approved(s: Shop) -> DataFrame:
    return products.falling_products_approved(s.orders, s.order_items, AS_OF)


@query
def product_drops(s: Shop) -> DataFrame:
    return products.product_drops(products.sku_totals(s.orders, s.order_items, AS_OF))


@query
def product_drops_half_year(s: Shop) -> DataFrame:
    return products.product_drops(products.sku_totals(s.orders, s.order_items, AS_OF, 180), 0.5)


@query
def top_customers(s: Shop) -> DataFrame:
    return customers.top_customers(s.orders, AS_OF)


@query
def top_customers_approved(s: Shop) -> DataFrame:
    return customers.top_customers_approved(s.orders, AS_OF)


def _enriched(s: Shop) -> DataFrame:
    return sales_enriched(s.orders, s.order_items, s.dim_product)


@query
def period_summary(s: Shop) -> DataFrame:
    return sales.period_summary(_enriched(s), START, END)


@query
def period_summary_by_tag(s: Shop) -> DataFrame:
    return sales.period_summary(_enriched(s), START, END, TAG)


@query
def top_products_in_period(s: Shop) -> DataFrame:
    return sales.top_products_in_period(_enriched(s), START, END)


@query
def top_products_in_period_by_tag(s: Shop) -> DataFrame:
    return sales.top_products_in_period(_enriched(s), START, END, TAG, 25)


@query
def monthly_sales(s: Shop) -> DataFrame:
    return sales.monthly_sales(_enriched(s), START, END)


@query
def monthly_sales_by_tag(s: Shop) -> DataFrame:
    return sales.monthly_sales(_enriched(s), START, END, TAG)


@query
def tag_list(s: Shop) -> DataFrame:
    return sales.tag_list(s.dim_product)


@query
def sales_question_totals(s: Shop) -> DataFrame:
    return questions.sales_question(_enriched(s), ["economy", "brand#2"], 2000, 5)


@query
def sales_question_lines(s: Shop) -> DataFrame:
    enriched = sales_enriched(s.orders, s.order_items, s.dim_product)
    return questions.sales_question(enriched, ["small"], 2001, aggregate=False)


def _question_texts(s: Shop) -> DataFrame:
    """A question from every conversation turn: its text with asked filters in front."""
    conv, turn = F.col("conv_id"), F.col("turn")
    months = F.array(*[F.lit(name) for name, _ in questions.MONTH_NAMES])
    words = F.array(*[F.lit(tag) for tag in VOCABULARY])
    intent = F.when(conv % 3 == 0, "Quanto vendi ").when(conv % 3 == 1, "Analise o produto ").otherwise("Oi ")
    tag = F.when(conv % 5 != 0, F.concat(F.lit("de "), F.element_at(words, (conv % 6 + 1).cast("int")), F.lit(" ")))
    other = F.when(conv % 4 == 0, F.concat(F.lit("ou "), F.element_at(words, (turn % 6 + 1).cast("int")), F.lit(" ")))
    month = F.when(conv % 2 == 0, F.concat(F.lit("em "), F.element_at(months, (conv % 13 + 1).cast("int")), F.lit(" ")))
    year = F.when(turn % 3 != 0, F.concat(F.lit("de 200"), (conv % 2).cast("string"), F.lit(" ")))
    parts = [F.coalesce(part, F.lit("")) for part in (intent, tag, other, month, year)]
    return s.given("conversations").select(
        (conv * 1000 + turn).alias("question_id"), F.concat(*parts, F.lit(": "), F.col("text")).alias("text")
    )


@query
def questions_read(s: Shop) -> DataFrame:
    read = questions.read_questions(_question_texts(s), VOCABULARY)
    return read.withColumn("tags", F.array_join("tags", ","))


@query
def questions_answered(s: Shop) -> DataFrame:
    return questions.answer_questions(_question_texts(s), _enriched(s), VOCABULARY)


@query
def question_lines(s: Shop) -> DataFrame:
    enriched = sales_enriched(s.orders, s.order_items, s.dim_product)
    return questions.question_lines(_question_texts(s), enriched, VOCABULARY, limit=10)


@query
def question_all_lines(s: Shop) -> DataFrame:
    """How many lines, and for how much, each question that asks for lines gets."""
    totals = questions.question_lines(_question_texts(s), _enriched(s), VOCABULARY, summed=True)
    return totals.groupBy("question_id").agg(F.sum("lines").alias("lines"), F.sum("revenue").alias("revenue"))


@query
def abc_curve(s: Shop) -> DataFrame:
    return products.abc_curve(s.orders, s.order_items, AS_OF)


@query
def abc_curve_sliced(s: Shop) -> DataFrame:
    """The curve by sorted slices, over all days."""
    return products.abc_curve(s.orders, s.order_items, AS_OF, days=20000)


@query
def abc_leaders(s: Shop) -> DataFrame:
    return products.abc_leaders(s.orders, s.order_items, AS_OF)


@query
def average_ticket(s: Shop) -> DataFrame:
    return channels.average_ticket(s.orders, AS_OF)


@query
def average_ticket_approved(s: Shop) -> DataFrame:
    return channels.average_ticket_approved(s.orders, AS_OF)


@query
def gross_margin(s: Shop) -> DataFrame:
    return products.gross_margin(s.orders, s.order_items, s.products, AS_OF)


@query
def sku_totals(s: Shop) -> DataFrame:
    return products.sku_totals(s.orders, s.order_items, AS_OF)


@query
def top_skus(s: Shop) -> DataFrame:
    return products.top_skus(products.sku_totals(s.orders, s.order_items, AS_OF))


@query
def unsold_products(s: Shop) -> DataFrame:
    return products.unsold_products(s.products, products.sku_totals(s.orders, s.order_items, AS_OF))


@query
def kpi_comparison(s: Shop) -> DataFrame:
    return products.kpi_comparison(s.orders, s.order_items, AS_OF)


@query
def fact_daily_sales(s: Shop) -> DataFrame:
    """Days need no product keys, so the fact is built without them."""
    facts = maintain.fact_rows(s.stg_order_items, s.stg_orders, None, AS_OF, None)
    return sales.fact_daily_sales(facts, maintain.dim_date(s.spark, AS_OF, 8))


@query
def fact_top_skus(s: Shop) -> DataFrame:
    recent = maintain.fact_rows(s.stg_order_items, s.stg_orders, s.keyed_products, AS_OF, 30)
    return products.fact_top_skus(recent, s.keyed_products, AS_OF)


@query
def last_days_series(s: Shop) -> DataFrame:
    return sales.last_days_series(s.orders)


@query
def last_days_headline(s: Shop) -> DataFrame:
    return sales.last_days_headline(s.orders)


@query
def daily_channel_orders(s: Shop) -> DataFrame:
    return channels.daily_channel_orders(s.orders)


@query
def channel_totals(s: Shop) -> DataFrame:
    return channels.channel_totals(channels.daily_channel_orders(s.orders), AS_OF)


@query
def mean_items_per_day(s: Shop) -> DataFrame:
    return sales.mean_items_per_day(sales.daily_orders_from_headers(s.orders, s.order_items, AS_OF), AS_OF)


@query
def mean_items_newest_days(s: Shop) -> DataFrame:
    return sales.mean_items_newest_days(sales.daily_orders_from_headers(s.orders, s.order_items, AS_OF))


@query
def report_tables(s: Shop) -> DataFrame:
    return dataset.report_tables(s.orders, s.order_items, AS_OF)


# --- table profiles -------------------------------------------------------------


@query
def load_summary(s: Shop) -> DataFrame:
    return quality.load_summary(s.orders, s.order_items, "2001-07-02", AS_OF)


@query
def load_sample(s: Shop) -> DataFrame:
    return quality.load_sample(s.orders, s.order_items, "2001-06-01", "2001-06-30")


def _tables(s: Shop) -> dict[str, DataFrame]:
    return {"orders": s.orders, "order_items": s.order_items, "products": s.products}


@query
def table_counts(s: Shop) -> DataFrame:
    return quality.table_counts(_tables(s))


@query
def table_counts_row(s: Shop) -> DataFrame:
    return quality.table_counts_row(_tables(s))


@query
def order_range(s: Shop) -> DataFrame:
    return quality.order_range(s.orders)


@query
def newest_days(s: Shop) -> DataFrame:
    return quality.newest_days(s.orders)


@query
def channels_by_revenue(s: Shop) -> DataFrame:
    return quality.channels_by_revenue(s.orders)


@query
def newest_orders(s: Shop) -> DataFrame:
    return quality.newest_orders(s.orders)


@query
def newest_lines(s: Shop) -> DataFrame:
    return quality.newest_lines(s.orders, s.order_items)


@query
def newest_products(s: Shop) -> DataFrame:
    return quality.newest_products(s.products)


@query
def newest_rows(s: Shop) -> DataFrame:
    legacy = s.orders.select(F.col("order_id").alias("id"), F.col("order_number").alias("numero"), "total")
    return quality.newest_rows(legacy, "id")


@query
def tag_coverage(s: Shop) -> DataFrame:
    enriched = _enriched(s).agg(F.count(F.lit(1)).alias("enriched_rows"))
    return quality.tag_coverage(s.dim_product, enriched)


@query
def tagged_sample(s: Shop) -> DataFrame:
    return quality.tagged_sample(s.dim_product)


# --- sources --------------------------------------------------------------------


@query
def landed_order_pages(s: Shop) -> DataFrame:
    ok, _ = landing.split_ok_rejects(pages.order_pages(s.orders))
    return landing.order_rows(ok).drop("raw_json")


@query
def landed_order_amounts(s: Shop) -> DataFrame:
    ok, _ = landing.split_ok_rejects(pages.order_pages(s.orders))
    return landing.order_amounts(ok)


@query
def staged_orders(s: Shop) -> DataFrame:
    ok, _ = landing.split_ok_rejects(pages.order_pages(s.orders))
    return landing.staged_order_rows(ok).drop("raw_json")


@query
def staged_items(s: Shop) -> DataFrame:
    """Staged lines of all details, counted and summed per code."""
    staged = landing.staged_item_rows(pages.order_details(s.order_items))
    return staged.groupBy("code", "description").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("qty").alias("qty"), F.sum("total").alias("total"),
        F.count_if(F.col("unit_price") == 0).alias("unpriced"),
    )


@query
def landed_page_rejects(s: Shop) -> DataFrame:
    _, rejects = landing.split_ok_rejects(pages.order_pages(s.orders))
    return rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("pages"))


@query
def landed_order_details(s: Shop) -> DataFrame:
    return landing.order_item_rows(pages.order_details(s.order_items)).drop("raw_json")


@query
def landed_product_pages(s: Shop) -> DataFrame:
    return landing.product_rows(pages.product_pages(s.products)).drop("raw_json")


@query
def landed_catalogue(s: Shop) -> DataFrame:
    return landing.catalogue_rows(pages.product_pages(s.products)).drop("raw_json")


@query
def product_category_tags(s: Shop) -> DataFrame:
    return landing.product_categories(pages.product_details(s.products))


@query
def rows_as_json(s: Shop) -> DataFrame:
    rows = with_raw_json(s.orders)
    fields = {f: F.get_json_object("raw_json", f"$.{f}") for f in s.orders.columns}
    fields["total"] = fields["total"].cast("double")  # JSON numbers have no fixed scale
    return rows.select("order_id", *[field.alias(f"json_{f}") for f, field in fields.items()])


# --- cleansing and filters ------------------------------------------------------


@query
def clean_dates(s: Shop) -> DataFrame:
    key = F.col("order_id")
    text = F.date_format("order_date", "dd/MM/yyyy")
    dirty = (
        F.when(key % 10 == 0, "")
        .when(key % 10 == 1, "30/02/2001")
        .when(key % 10 == 2, F.date_format("order_date", "yyyy-MM-dd"))
        .when(key % 10 == 3, F.concat(text, F.lit(" 23:59:58")))
        .when(key % 10 == 4, "amanhã")
        .otherwise(text)
    )
    rows = s.orders.select("order_id", "order_date", dirty.alias("text"))
    moment = C.parse_source_date(F.col("text"))
    return rows.select(
        "order_id",
        moment.alias("instant"),
        C.utc_day(moment).alias("utc_day"),
        C.parse_source_day(F.col("text")).alias("local_day"),
        C.parse_source_datetime(F.col("text")).alias("local_time"),
        C.date_key(F.col("order_date")).alias("date_key"),
    )


@query
def clean_numbers(s: Shop) -> DataFrame:
    key = F.col("order_id")
    dirty = (
        F.when(key % 6 == 0, "  ")
        .when(key % 6 == 1, "abc")
        .when(key % 6 == 2, F.concat(F.lit(" "), F.col("total").cast("string"), F.lit(" ")))
        .when(key % 6 == 3, "1,5")
        .otherwise(F.col("total").cast("string"))
    )
    rows = s.orders.select("order_id", "total", dirty.alias("text"))
    number = C.number_or_null(F.col("text"))
    return rows.select(
        "order_id",
        number.alias("number"),
        C.number_or_zero(F.col("text")).alias("number_or_zero"),
        C.first_nonzero(F.col("text"), F.lit("7")).alias("first_nonzero"),
        C.ratio(F.col("total"), number).alias("guarded"),
        C.ratio(F.col("total"), number, 0.0).alias("guarded_zero"),
    )


@query
def clean_labels(s: Shop) -> DataFrame:
    return s.orders.select(
        "order_id",
        C.channel_label(F.col("channel")).alias("channel"),
        C.label_or(F.col("channel"), C.UNKNOWN_CHANNEL).alias("channel_unknown"),
        C.label_or(F.col("customer_name"), C.NO_NAME).alias("customer"),
        P.status_has(F.col("status")).alias("approved"),
    )


@query
def clean_lines(s: Shop) -> DataFrame:
    lines = s.order_items.select(
        C.sku_key(F.col("sku"), F.col("product_name")).alias("code"),
        C.line_revenue(F.col("total"), F.col("qty"), F.col("price")).alias("revenue"),
        C.line_revenue(F.col("total"), F.col("qty"), F.col("price"), False).alias("revenue_or_null"),
    )
    return lines.groupBy("code").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum("revenue").alias("revenue"),
        F.count("revenue_or_null").alias("valued_lines"),
    )


@query
def clean_tags(s: Shop) -> DataFrame:
    tags = F.coalesce(F.concat(F.lit(", "), "tags", F.lit(", ")), F.lit(" , "))
    return s.products.select("id", C.strip_tags(tags).alias("tags"), C.strip_tags(F.lit(" ,")).alias("none"))


@query
def recent_windows(s: Shop) -> DataFrame:
    """Orders inside each kind of time window of the reports."""
    day = F.col("order_date")
    windows = {
        **{f"last_{n}_days": P.since_days(day, AS_OF, n) for n in (14, 30, 56, 60, 90, 180)},
        "six_months": P.since_months(day, AS_OF, 6),
        "full_90_days": P.last_full_days(day, AS_OF, 90),
        "through_july": P.through_day(day, "2001-07-01", "2001-07-31"),
        "year_2000": P.in_year_month(day, 2000),
        "may_2000": P.in_year_month(day, 2000, 5),
        "any_may": P.in_year_month(day, None, 5),
    }
    return s.orders.agg(*[F.count_if(condition).alias(name) for name, condition in windows.items()])


@query
def tag_queue(s: Shop) -> DataFrame:
    return P.awaits_tags(s.dim_product)


def _search(s: Shop, term: str, field: str, mode: str) -> DataFrame:
    accented = s.products.withColumn("product_name", F.translate("product_name", "aei", "ãéí"))
    return search.product_search(accented, term, field, mode).select("id", "sku", "product_name")


@query
def product_search_contains(s: Shop) -> DataFrame:
    return _search(s, "Wídg", "auto", "contains")


@query
def product_search_word(s: Shop) -> DataFrame:
    return _search(s, "Ring", "name", "word")


@query
def product_search_prefix(s: Shop) -> DataFrame:
    return _search(s, "sku-1", "sku", "prefix")


@query
def product_search_exact(s: Shop) -> DataFrame:
    return _search(s, "RED WIDGET", "name", "exact")


def _records(s: Shop) -> dict[str, DataFrame]:
    return {
        "order": s.orders.withColumnRenamed("order_id", "id"),
        "customer": s.given("customer").withColumnRenamed("c_custkey", "id"),
        "product": s.products,
    }


@query
def record_search(s: Shop) -> DataFrame:
    found = search.record_search(_records(s), "customer#00000001")
    return found.select("kind", F.get_json_object("record", "$.id").alias("id"))


@query
def orders_page(s: Shop) -> DataFrame:
    return page(s.orders.select("order_id", "order_date", "status"), 3, 50, high_first("order_date"), low_first("order_id"))


@query
def orders_page_after(s: Shop) -> DataFrame:
    """The third page, each one started from the last key of the one before."""
    orders, order, last = s.orders.select("order_id", "order_date", "status"), [("order_date", True), ("order_id", False)], None
    for _ in range(2):
        last = last_key(page_after(orders, 50, order, last), order)
    return page_after(orders, 50, order, last)


def _indexed(s: Shop, name: str, texts: DataFrame) -> Warehouse:
    shop = _scratch(s, name)
    search.build_search_index(shop, name, texts)
    return shop


@query
def product_search_indexed(s: Shop) -> DataFrame:
    """The word search by candidates of the stored index."""
    accented = s.products.withColumn("product_name", F.translate("product_name", "aei", "ãéí"))
    shop = _indexed(s, "product_grams", search.product_texts(accented))
    return search.product_search_indexed(accented, shop, "product_grams", "Ring", "name", "word").select("id", "sku", "product_name")


@query
def record_search_indexed(s: Shop) -> DataFrame:
    records = _records(s)
    shop = _indexed(s, "record_grams", search.record_texts(records))
    found = search.record_search_indexed(records, shop, "record_grams", "customer#00000001")
    return found.select("kind", F.get_json_object("record", "$.id").alias("id"))


# --- joins, windows, maintenance ------------------------------------------------


@query
def order_lines(s: Shop) -> DataFrame:
    return sold_lines(s.orders, s.order_items, ["order_date", "channel"], ["sku", "qty", "total"])


@query
def order_running_share(s: Shop) -> DataFrame:
    """Running share over customers with many tied values, by sorted slices."""
    counts = s.orders.groupBy("customer_id").agg(F.count(F.lit(1)).cast(MONEY).alias("orders"))
    return running_share(counts, "orders")


@query
def calendar_orders(s: Shop) -> DataFrame:
    """The date dimension with the orders of each day."""
    daily = s.orders.groupBy("order_date").agg(F.count(F.lit(1)).alias("orders"))
    dates = maintain.dim_date(s.spark, AS_OF)
    return dates.join(daily, F.col("date_value") == F.col("order_date"), "left").drop("order_date")


@query
def dimension_products(s: Shop) -> DataFrame:
    return s.keyed_products


@query
def dimension_upsert(s: Shop) -> DataFrame:
    """Dimension built from inactive products first, then updated from all."""
    stamp = utc_midnight("2001-01-01")
    inactive = s.stg_products.where("status = 'I'").withColumn("tags", F.lit("x"))
    keys = maintain.new_product_keys(s.spark.createDataFrame([], schemas.PRODUCT_KEYS), inactive)
    before = maintain.dim_product_rows(inactive, stamp, keys)
    changes = s.stg_products.where("status = 'A'")
    keys = keys.unionByName(maintain.new_product_keys(keys, changes))
    return maintain.upsert_dim_product(before, changes, utc_midnight(AS_OF), keys)


@query
def orders_upserted(s: Shop) -> DataFrame:
    """Stored orders up to July, then changes of the last 60 days, some seen twice."""
    stored = s.orders.where(F.col("order_date") < F.lit("2001-07-01").cast("date")).withColumn("version", F.lit(0))
    recent = s.orders.where(P.since_days(F.col("order_date"), AS_OF, 60))
    first = recent.withColumns({"status": F.lit("Em aberto"), "version": F.lit(1)})
    second = recent.where(P.status_has(F.col("status"))).withColumns(
        {"status": F.lit("Entregue"), "version": F.lit(2)}
    )
    return upsert(stored, first.unionByName(second), ["order_id"], ["version"])


def _scratch(s: Shop, name: str) -> Warehouse:
    return Warehouse(s.spark, f"{ensure_checkpoint_dir(s.spark)}/{name}-{uuid.uuid4().hex}")


def _stored_increments(s: Shop) -> Warehouse:
    """A warehouse after two batches of pages; the second holds two versions of each recent order."""
    shop = _scratch(s, "increments")
    recent = s.orders.where(P.since_days(F.col("order_date"), AS_OF, 60))
    opened = recent.withColumn("status", F.lit("Em aberto"))
    sent = recent.where(P.status_has(F.col("status"))).withColumn("status", F.lit("Entregue"))
    apply_order_pages(shop, pages.order_pages(s.orders))
    apply_order_pages(shop, pages.order_pages(opened).unionByName(pages.order_pages(sent)))
    return shop


@query
def stored_orders_upserted(s: Shop) -> DataFrame:
    return _stored_increments(s).load("orders").select("order_id", "status", "total", "month")


@query
def stored_page_rejects(s: Shop) -> DataFrame:
    rejects = _stored_increments(s).load("rejected_pages")
    return rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("pages"))


@query
def stored_order_amounts(s: Shop) -> DataFrame:
    return _stored_increments(s).load("order_amounts")


def _stored_lines(s: Shop) -> Warehouse:
    """Headers, then the details of all lines, then recent details again with other quantities."""
    shop = _scratch(s, "lines")
    apply_order_pages(shop, pages.order_pages(s.orders))
    apply_order_details(shop, pages.arriving_details(s.order_items))
    recent = s.orders.where(P.since_days(F.col("order_date"), AS_OF, 30)).select("order_id")
    again = s.order_items.withColumn("qty", (F.col("qty") * 2).cast(MONEY)).join(recent, "order_id", "left_semi")
    apply_order_details(shop, pages.arriving_details(again))
    return shop


@query
def stored_lines_replaced(s: Shop) -> DataFrame:
    return _stored_lines(s).load("order_items").drop("raw_json")


@query
def stored_detail_rejects(s: Shop) -> DataFrame:
    return _stored_lines(s).load("rejected_details").select("order_id", "reason")


def _land(rows: DataFrame, text, folder: str) -> None:
    """Write replies as packed files of JSON lines, one more set in the folder."""
    rows.select(text.alias("value")).write.mode("append").option("compression", "gzip").text(folder)


@query
def stored_dimension(s: Shop) -> DataFrame:
    """Dimension, with its keys, after two landings of product pages: the inactive
    products, then all others."""
    shop = _scratch(s, "dimension")
    folder = shop.path("landing")
    for status in ("I", "A"):
        rows = s.products.where(F.col("status") == status)
        _land(rows, pages.product_texts(rows), folder)
        ingest_products(s.spark, shop, folder, utc_midnight(AS_OF))
    return shop.load("dim_product")


def _landed_twice(s: Shop) -> Warehouse:
    """Two runs of the stream. Between them the recent pages land, and the details of all
    orders once more."""
    shop = _scratch(s, "stream")
    page_folder, detail_folder = shop.path("landing/pages"), shop.path("landing/details")
    details = materialized(pages.last_lines(s.order_items))
    recent = P.since_days(F.col("order_date"), AS_OF, 60)
    for rows in (s.orders.where(~recent), s.orders.where(recent)):
        _land(rows, pages.page_texts(rows), page_folder)
        _land(details, pages.detail_texts(details), detail_folder)
        ingest_increment(s.spark, shop, page_folder, detail_folder)
    return shop


@query
def stream_increments(s: Shop) -> DataFrame:
    """Orders of the stream with their lines, after two runs with repeated files."""
    shop = _landed_twice(s)
    lines = shop.load("order_items").groupBy("order_id", "month").agg(F.count(F.lit(1)).alias("lines"), F.sum("qty").alias("qty"))
    orders = shop.load("orders").select("order_id", "status", "total", "month")
    return orders.join(lines, ["order_id", "month"], "full")


@query
def stream_batches(s: Shop) -> DataFrame:
    """What each batch of the stream wrote."""
    return _landed_twice(s).load("load_batches").drop("batch")


@query
def fact_window_loaded(s: Shop) -> DataFrame:
    """The stored fact table after its last 90 days, then its last 30 days were loaded from pages."""
    shop = _scratch(s, "facts")
    known = s.spark.createDataFrame([], schemas.PRODUCT_KEYS)
    shop.materialize("dim_product", maintain.dim_product_rows(s.stg_products, utc_midnight(AS_OF), maintain.new_product_keys(known, s.stg_products)))
    # Both loads get the same replies; how they arrived is stored with them.
    landed, details = (
        materialized(landing.with_arrival(replies)) for replies in (pages.order_pages(s.orders), pages.arriving_details(s.order_items))
    )
    for days in (90, 30):
        load_fact_window(shop, landed, details, AS_OF, days, ready=True)
    return shop.load("f_sales")


@query
def orders_as_csv(s: Shop) -> DataFrame:
    """Orders written as CSV and read back."""
    path = f"{ensure_checkpoint_dir(s.spark)}/csv-{uuid.uuid4().hex}"
    columns = s.orders.select("order_id", "order_date", "customer_name", "status", "total")
    write_csv(columns, path)
    return s.spark.read.option("header", True).option("multiLine", True).schema(columns.schema).csv(path)


@query
def order_lines_replaced(s: Shop) -> DataFrame:
    """Lines of recent orders replaced; orders in part approval come back empty."""
    recent = s.orders.where(P.since_days(F.col("order_date"), AS_OF, 30)).select("order_id", "status")
    recent = materialized(recent.where("status <> 'Em aberto'"))
    ok = broadcast_if_small(recent)
    rows = s.order_items.join(broadcast_if_small(recent.where("status = 'Aprovado'").select("order_id")), "order_id", "left_semi")
    rows = rows.withColumn("qty", (F.col("qty") * 2).cast(MONEY))
    return replace_keys(s.order_items, ok, rows, ["order_id"])


@query
def orders_migrated(s: Shop) -> DataFrame:
    """Known orders up to 1999, joined by all legacy orders that are new."""
    columns = ["order_id", "external_id", "order_number", "order_date", "channel", "customer_id", "customer_name", "status", "total"]
    known = s.orders.where(F.col("order_date") < F.lit("2000-01-01").cast("date")).withColumn("raw_json", F.lit("{}"))
    legacy = s.orders.select(
        F.col("order_id").alias("id"), F.col("order_number").alias("numero"),
        F.to_timestamp(F.concat(F.col("order_date").cast("string"), F.lit(" -03:00")), "yyyy-MM-dd XXX").alias("data_pedido"),
        F.col("channel").alias("canal_venda"), F.col("customer_id").alias("cliente_id"),
        F.col("customer_name").alias("cliente_nome"), F.col("status").alias("situacao"), F.col("total").alias("valor_total"),
    )
    return maintain.migrate_orders(known.select(*columns, "raw_json"), legacy).drop("raw_json")


@query
def items_migrated(s: Shop) -> DataFrame:
    """Known lines of orders up to 1999, joined by all legacy lines that are new."""
    before = s.orders.where(F.col("order_date") < F.lit("2000-01-01").cast("date")).select("order_id")
    known = s.order_items.join(before, "order_id", "left_semi").withColumn("raw_json", F.lit("{}"))
    legacy = s.order_items.select(
        "order_id", "item_seq", F.col("product_id").alias("produto_id"), F.col("sku").alias("produto_codigo"),
        F.col("product_name").alias("produto_nome"), F.col("qty").alias("quantidade"), F.col("price").alias("valor_unitario"),
        F.col("total").alias("valor_total"),
    )
    return maintain.migrate_items(known, legacy).drop("raw_json")


@query
def fact_reloaded(s: Shop) -> DataFrame:
    """Fact of all days, its last 30 days reloaded twice."""
    heavy = heavy_values(s.stg_order_items, "code")
    facts, window = (
        maintain.fact_rows(s.stg_order_items, s.stg_orders, s.keyed_products, AS_OF, days, heavy) for days in (None, 30)
    )
    window = materialized(window)
    once = maintain.reload_window(facts, window, AS_OF)
    twice = maintain.reload_window(once, window, AS_OF)
    return twice


@query
def backfilled_orders(s: Shop) -> DataFrame:
    orders, _ = maintain.backfill(s.orders, s.order_items)
    return orders.select("order_id", "channel", "total")


@query
def backfilled_items(s: Shop) -> DataFrame:
    _, items = maintain.backfill(s.orders, s.order_items)
    return items.select("order_id", "item_seq", "sku", "total")


@query
def tags_filled(s: Shop) -> DataFrame:
    categories = landing.product_categories(pages.product_details(s.products))
    filled = maintain.fill_tags(s.dim_product, categories, updated_at=utc_midnight("2001-08-02"))
    return filled.select("code", "tags", "updated_at")


@query
def columns_added(s: Shop) -> DataFrame:
    wider = add_missing_columns(s.orders, {"channel": "string", "seller": "string", "freight": MONEY})
    return wider.select("order_id", "channel", "seller", "freight")


@query
def duplicate_line_keys(s: Shop) -> DataFrame:
    return duplicate_keys(s.order_items, ["order_id", "item_seq"])


# What of each report is compared: its key, a name, and three measures.
_CONTENTS = {
    "daily_orders": ("day", None, "orders", "revenue", "items"),
    "channels_30d": ("channel", None, "orders", "revenue", None),
    "product_ranking_90d": ("sku", "product_name", "rank", "revenue", "qty"),
    "daily_orders_lines": ("day", None, "orders", "revenue", "items"),
    "channel_lines_30d": ("channel", None, "active_days", "revenue", None),
    "product_sales_90d": ("sku", "product_name", None, "revenue", "qty"),
    "daily_channels": ("day", "channel", "orders", "revenue", None),
}


def _contents(shop: Warehouse) -> DataFrame:
    """All rows of the stored reports in one long table."""
    whole = None
    for name, (key, label, *measures) in _CONTENTS.items():
        texts = [(F.lit(None) if column is None else F.col(column)).cast("string") for column in (key, label)]
        numbers = [(F.lit(None) if column is None else F.col(column)).cast("double") for column in measures]
        rows = shop.load(name).select(F.lit(name).alias("report"), *texts, *numbers).toDF("report", "key", "name", "a", "b", "c")
        whole = rows if whole is None else whole.unionByName(rows)
    return whole


@query
def reports_contents(s: Shop) -> DataFrame:
    shop = _scratch(s, "reports")
    shop.refresh(dataset.materialized_reports(s.orders, s.order_items, AS_OF), keys=dataset.REPORT_KEYS)
    return _contents(shop)


def _states(s: Shop) -> Warehouse:
    """States of all days up to 60 days ago, then brought up to date with the rest."""
    shop = _scratch(s, "states")
    shop.materialize("dim_product", s.dim_product)
    raw, month = F.lit(None).cast("string").alias("raw_json"), month_text(F.col("order_date")).alias("month")
    orders = s.orders.select("*", raw, month)
    items = materialized(s.order_items.select("*", raw).join(orders.select("order_id", "month"), "order_id"))
    early = F.col("month") < "2001-06"
    for part in (early, ~early):
        for name, rows in (("orders", orders), ("order_items", items)):
            shop.overwrite_months(name, rows.where(part), [], moved=False)
        states.refresh_states(shop)
    return shop


@query
def reports_contents_incremental(s: Shop) -> DataFrame:
    """The same reports, merged from states that were made in two steps."""
    shop = _states(s)
    shop.refresh(states.reports_from_states(shop, AS_OF), keys=dataset.REPORT_KEYS)
    return _contents(shop)


@query
def period_summary_merged(s: Shop) -> DataFrame:
    """The summary of a period from sums and name bitmaps of its days."""
    return states.period_summary_from_states(_states(s), START, END)


@query
def reports_refreshed(s: Shop) -> DataFrame:
    """All reports materialized into the shared folder, and their row counts."""
    return _scratch(s, "reports").refresh(dataset.materialized_reports(s.orders, s.order_items, AS_OF), keys=dataset.REPORT_KEYS)
