"""Report rules on small hand-made tables, where a wrong reading would show."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from salesloom.plans import channels, customers, maintain, products, quality, sales, search
from salesloom.plans.lines import sales_enriched, sales_rollup
from tests.conftest import rows_of

AS_OF = "2024-03-31"


@pytest.fixture
def shop(make_orders, make_items):
    orders = make_orders([
        (1, "2024-03-31", "loja", "Ana", "Aprovado", 100),
        (2, "2024-03-01", "", "Bia", "aprovação parcial", None),
        (3, "2024-02-29", None, None, "APROVADO", 50),
        (4, "2024-02-01", "loja", "Ana", "Em aberto", 30),
        (5, "2024-01-31", "  ", "Ana", "Aprovado", 20),
        (6, "2024-03-15", "site", "Cid", None, 0),
    ])
    items = make_items([
        (1, 1, "A", "a", 2, 10, 20),
        (1, 2, "B", "b", 1, 30, None),
        (2, 1, "A", "a2", 3, 5, 15),
        (3, 1, "A", "a", 10, 10, 100),
        (4, 1, "C", "c", 1, 30, 30),
        (5, 1, None, None, None, 2, None),
        (5, 2, "", " ", 1, 20, 20),
    ])
    return orders, items


def test_days_keep_orders_without_lines(shop):
    got = dict((r[0], r[1:]) for r in rows_of(sales.daily_orders_from_lines(*shop)))
    assert got[date(2024, 3, 15)] == (1, None, None)
    assert got[date(2024, 3, 31)] == (1, 3.0, 50.0)
    assert got[date(2024, 1, 31)] == (1, 1.0, 20.0)
    headers = dict((r[0], r[1:]) for r in rows_of(sales.daily_orders_from_headers(*shop, AS_OF)))
    assert headers[date(2024, 3, 15)] == (1, 0.0, 0.0) and headers[date(2024, 3, 1)] == (1, 0.0, 3.0)


def test_revenue_per_day_adds_up_to_the_lines(shop):
    orders, items = shop
    total = sum(r[3] or 0 for r in rows_of(sales.daily_orders_from_lines(orders, items)))
    assert total == 20 + 30 + 15 + 100 + 30 + 0 + 20


def test_channels(shop):
    orders, items = shop
    assert rows_of(channels.channel_revenue_from_lines(orders, items, AS_OF)) == [
        ("loja", 50.0, 1), ("Desconhecido", 15.0, 1), ("site", 0.0, 1),
    ]
    assert rows_of(channels.channel_orders(orders, AS_OF)) == [("loja", 1, 100.0), ("(sem canal)", 1, 0.0), ("site", 1, 0.0)]
    # The day 30 days before is in the report from headers, out of the one from the daily table.
    daily = channels.daily_channel_orders(orders)
    assert rows_of(channels.channel_totals(daily, AS_OF)) == [("loja", 1, 100.0), ("site", 1, 0.0)]


def test_previous_week_is_the_previous_week_present(make_orders):
    orders = make_orders([
        (1, "2024-03-04", "x", None, "aprovado", 100), (2, "2024-03-20", "x", None, "Aprovada", 150),
        (3, "2024-03-27", "x", None, "novo", 75), (4, "2024-03-27", "y", None, "aprov", 5),
    ])
    got = rows_of(channels.weekly_channel_change(orders, AS_OF).orderBy("channel", "week"))
    assert got == [
        ("x", date(2024, 3, 4), 100.0, None, None),
        ("x", date(2024, 3, 18), 150.0, 100.0, 50.0),
        ("x", date(2024, 3, 25), 75.0, 150.0, -50.0),
        ("y", date(2024, 3, 25), 5.0, None, None),
    ]
    assert rows_of(channels.weekly_growth_leaders(orders, AS_OF)) == [("x", date(2024, 3, 18), 150.0, 100.0, 0.5)]


def test_product_groupings(shop):
    orders, items = shop
    by_sku = {r[0]: r[1:] for r in rows_of(products.product_sales(orders, items, AS_OF))}
    assert by_sku["A"] == ("a2", 15.0, 135.0) and by_sku[None] == ("", 0.0, 0.0) and by_sku[""] == (" ", 1.0, 20.0)
    ranking = rows_of(products.product_ranking(orders, items, AS_OF))
    assert ranking[0] == (1, "A", "a", 120.0, 12.0)
    # Both blank lines share the labels; a line without total adds nothing here.
    assert (3, "(sem sku)", "(sem nome)", 20.0, 1.0) in ranking
    assert rows_of(products.top_ranked_products(orders, items, AS_OF, limit=2)) == ranking[:2]


def test_falling_products(shop):
    orders, items = shop
    got = rows_of(products.falling_products(orders, items, AS_OF))
    # 'a2' has no earlier sales; null sums sort last.
    assert got == [
        ("A", "a", 20.0, 100.0, -80.0, -80.0), ("", " ", None, 20.0, None, None), ("C", "c", None, 30.0, None, None),
    ]


def test_a_sku_with_two_names_meets_its_earlier_sales_twice(shop):
    orders, items = shop
    orders = orders.withColumn("order_date", F.when(F.col("order_id") == 1, F.lit("2024-03-30").cast("date")).otherwise(F.col("order_date")))
    got = rows_of(products.falling_products_approved(orders, items, AS_OF))
    assert got == [("A", "a2", 100.0, 15.0, -0.85), ("A", "a", 100.0, 20.0, -0.8)]


def test_drops_between_two_periods(shop):
    orders, items = shop
    totals = products.sku_totals(orders, items, AS_OF)
    assert rows_of(products.product_drops(totals)) == [("A", "a", 35.0, 100.0, -65.0)]
    # The first line of the current period is the one of the lowest order.
    assert {r.code: r.description for r in totals.collect()}["A"] == "a"
    assert rows_of(products.product_drops(totals, 0.7)) == []
    assert rows_of(products.top_skus(totals, 1)) == [("A", "a", 5.0, 35.0)]
    assert rows_of(products.product_drops(totals, 0.65)) != []  # exactly the threshold counts


def test_unsold_ignores_products_without_code(spark, shop):
    catalogue = spark.createDataFrame(
        [("A", "a", "A"), ("C", "c", None), ("", "x", "A"), (None, "y", "A")], "sku string, product_name string, status string"
    )
    totals = products.sku_totals(*shop, AS_OF)
    assert rows_of(products.unsold_products(catalogue, totals)) == [("C", "c", "")]


def test_ticket_divides_by_all_orders(shop):
    (row,) = rows_of(products.kpi_comparison(*shop, AS_OF))
    # Current: 20 + 0 + 15 over three orders, one of them without lines.
    assert row == (35.0, 3, 150.0, 3, 35 / 3, 50.0)


def test_empty_periods_still_give_a_row(shop):
    orders, items = shop
    assert rows_of(products.kpi_comparison(orders, items, "2030-01-01")) == [(0.0, 0, 0.0, 0, 0.0, 0.0)]


def test_abc_rounds_first_or_not_at_all(make_orders, make_items):
    orders = make_orders([(1, "2024-03-30", None, None, "Aprovado", 0)])
    # Shares 70.04, 80.004, 100: rounded to 70.0 -> A; 80.004 % is beyond 80 -> B.
    items = make_items([(1, 1, "A", "a", 1, 1, "7004"), (1, 2, "B", "b", 1, 1, "996.4"), (1, 3, "C", "c", 1, 1, "1999.6")])
    curve = {r.sku: (float(r.cumulative_pct), r["class"]) for r in products.abc_curve(orders, items, AS_OF).collect()}
    assert curve == {"A": (70.0, "A"), "C": (90.0, "B"), "B": (100.0, "C")}
    leaders = rows_of(products.abc_leaders(orders, items, AS_OF), "sku", "class", "position")
    assert leaders == [("A", "A", 1), ("C", "B", 2), ("B", "C", 3)]


def test_abc_ties_share_rank_and_sum(make_orders, make_items):
    orders = make_orders([(1, "2024-03-30", None, None, "Aprovado", 0)])
    items = make_items([(1, n, f"S{n}", "x", 1, 1, 10) for n in range(1, 5)] + [(1, 5, "T", "t", 1, 1, 60), (1, 6, "N", "n", 1, 1, None)])
    got = rows_of(products.abc_leaders(orders, items, AS_OF, limit=3), "position", "sku", "cumulative_share")
    # All four tied products count in the share, also those beyond the limit.
    assert got == [(1, "T", 0.6), (2, "S1", 1.0), (2, "S2", 1.0)]
    curve = products.abc_curve(orders, items, AS_OF)
    assert [float(r.cumulative_pct) for r in curve.collect()] == [60.0] + [100.0] * 5
    sliced = products.abc_curve(orders, items, AS_OF)
    assert sorted(rows_of(sliced), key=str) == sorted(rows_of(curve), key=str)


def test_repeated_sku_does_not_multiply_sales(spark, shop):
    catalogue = spark.createDataFrame(
        [(1, "A", date(2020, 1, 1), 4), (2, "A", date(2021, 1, 1), 6), (3, "A", None, 9), (4, "B", None, None)],
        "id bigint, sku string, created_at date, cost int",
    ).withColumn("cost_price", F.col("cost").cast("decimal(18,4)"))
    got = rows_of(products.gross_margin(*shop, catalogue, "2024-04-01"))
    # The newest dated cost (6) counts once per line; skus without cost count 0.
    assert got[0] == ("A", "a", 12.0, 120.0, 72.0, 48.0, 0.4)
    assert got[1] == ("", " ", 1.0, 20.0, 0.0, 20.0, 1.0)
    assert got[2] == ("A", "a2", 3.0, 15.0, 18.0, -3.0, -0.2)
    assert all(r[3] > 0 for r in got)


def test_as_of_day_is_left_out_of_full_days(shop):
    orders, items = shop
    names = [r[0] for r in rows_of(customers.top_customers_approved(orders, AS_OF))]
    assert names == ["(sem nome)", "Ana", "Bia"]  # Ana only with the 20 of January; no total sorts last
    assert rows_of(customers.top_customers(orders, AS_OF))[0] == ("Ana", 3, 150.0)


@pytest.fixture
def dim(spark):
    return spark.createDataFrame(
        [("A", " ,luxo, kits ,", "A", 1), ("B", None, "A", 2), ("C", "luxo", "I", 3), ("D", "luxo,base", "A", 4)],
        "code string, tags string, status string, id_src bigint",
    ).withColumn("name", F.col("code"))


def test_enriched_sales_and_period_reports(shop, dim):
    lines = sales_enriched(*shop, dim)
    assert sorted(rows_of(lines, "day", "product", "tags", "qty", "total"), key=str) == sorted([
        (date(2024, 3, 31), "a", "luxo, kits", 2.0, 20.0), (date(2024, 3, 31), "b", None, 1.0, 30.0),
        (date(2024, 3, 1), "a2", "luxo, kits", 3.0, 15.0), (date(2024, 2, 29), "a", "luxo, kits", 10.0, 100.0),
    ], key=str)
    for source in (lines, sales_rollup(*shop, dim)):
        (row,) = rows_of(sales.period_summary(source, "2024-03-01", "2024-03-31"))
        assert row[2:] == (None, 6.0, 65.0, 3, 2, 65 / 6)
        (row,) = rows_of(sales.period_summary(source, "2024-03-01", "2024-03-30", "LUXO"))
        assert row[2:] == ("LUXO", 3.0, 15.0, 1, 1, 5.0)
        (row,) = rows_of(sales.period_summary(source, "2030-01-01", "2030-01-02"))
        assert row[2:] == (None, None, None, 0, 0, 0.0)
        assert rows_of(sales.top_products_in_period(source, "2024-02-01", "2024-03-31", limit=2)) == [
            ("a", None, 12.0, 120.0), ("b", None, 1.0, 30.0),
        ]
        months = rows_of(sales.monthly_sales(source, "2024-02-01", "2024-03-31"))
        assert months == [(date(2024, 2, 1), None, 10.0, 100.0, 100.0), (date(2024, 3, 1), None, 6.0, 65.0, 65.0)]


def test_bar_width_has_a_floor(spark):
    df = spark.createDataFrame([(date(2024, 1, 1), "p", None, 1, 1), (date(2024, 2, 1), "p", None, 1, 1000)], "day date, product string, tags string, qty int, total int")
    assert [r[-1] for r in rows_of(sales.monthly_sales(df, "2024-01-01", "2024-12-31"))] == [5.0, 100.0]
    none = df.withColumn("total", F.lit(0))
    assert [r[-1] for r in rows_of(sales.monthly_sales(none, "2024-01-01", "2024-12-31"))] == [0.0, 0.0]


def test_tags_are_trimmed_before_distinct(dim):
    assert rows_of(sales.tag_list(dim)) == [("base",), ("kits",), ("luxo",)]


def test_headline_takes_days_present(make_orders):
    orders = make_orders([(n, f"2024-0{1 + n % 3}-1{n % 5}", None, None, None, n) for n in range(1, 31)])
    series = rows_of(sales.last_days_series(orders, 4))
    assert [r[0] for r in series] == sorted(r[0] for r in series) and len(series) == 4
    (head,) = rows_of(sales.last_days_headline(orders, 4))
    assert head == (sum(r[1] for r in series), sum(r[2] for r in series), head[1] / head[0])


def test_backfill_order(shop):
    orders, items = maintain.backfill(*shop)
    assert sorted(rows_of(items, "order_id", "item_seq", "total"))[:2] == [(1, 1, 20.0), (1, 2, 30.0)]
    got = {r.order_id: (r.channel, None if r.total is None else float(r.total)) for r in orders.collect()}
    assert got[2] == ("(sem canal)", 15.0) and got[1] == ("loja", 100.0)
    assert got[6] == ("site", 0.0)  # no lines: stays as it is
    assert got[5] == ("  ", 20.0)  # blank but not empty: not relabelled
    again, _ = maintain.backfill(orders, items)
    assert sorted(rows_of(again), key=str) == sorted(rows_of(orders), key=str)


def test_tag_fill_takes_the_queue_only(spark, dim):
    wide = dim.withColumn("updated_at", F.lit("2020-01-01").cast("timestamp"))
    categories = spark.createDataFrame([(2, "folha"), (3, "x"), (4, "y"), (9, "z")], "id_src bigint, tag string")
    got = {r.code: r.tags for r in maintain.fill_tags(wide, categories).collect()}
    assert got == {"A": " ,luxo, kits ,", "B": "folha", "C": "luxo", "D": "luxo,base"}
    empty = categories.where("id_src = 2").withColumn("tag", F.lit(""))
    assert {r.code: r.tags for r in maintain.fill_tags(wide, empty).collect()}["B"] == ""


def test_tag_fill_is_not_held_up_by_products_without_detail(spark):
    rows = [(n, f"S{n}", None) for n in range(1, 801)]
    dim = spark.createDataFrame(rows, "id_src bigint, code string, tags string").withColumns(
        {"status": F.lit("A"), "name": F.lit("n"), "updated_at": F.lit("2020-01-01").cast("timestamp")}
    )
    categories = spark.range(601, 801).select(F.col("id").alias("id_src"), F.lit("t").alias("tag"))
    assert maintain.fill_tags(dim, categories).where("tags = 't'").count() == 200
    assert maintain.fill_tags(dim, categories, batch=5).where("tags = 't'").count() == 5


def test_migration_is_repeatable(spark):
    items = spark.createDataFrame([], "order_id bigint, item_seq int, product_id string, sku string, product_name string, qty decimal(18,4), price decimal(18,4), total decimal(18,4), raw_json string")
    legacy = spark.createDataFrame(
        [(1, 1, "7", "A", "a"), (1, 2, "8", "A", "a")],
        "order_id bigint, item_seq int, produto_id string, produto_codigo string, produto_nome string",
    ).withColumns({c: F.lit(1).cast("decimal(18,4)") for c in ("quantidade", "valor_unitario", "valor_total")})
    once = maintain.migrate_items(items, legacy)
    assert once.count() == 2 and maintain.migrate_items(once, legacy).count() == 2
    assert '"produto_codigo":"A"' in once.first().raw_json


def test_profiles(shop, dim):
    orders, items = shop
    assert dict(rows_of(quality.table_counts({"o": orders, "i": items}))) == {"o": 6, "i": 7}
    assert rows_of(quality.table_counts_row({"o": orders, "i": items})) == [(6, 7)]
    assert rows_of(quality.order_range(orders)) == [(date(2024, 1, 31), date(2024, 3, 31), 6, 200.0)]
    lines = rows_of(quality.newest_lines(orders, items, 3), "order_id", "item_seq")
    assert lines == [(1, 1), (1, 2), (2, 1)]
    assert rows_of(quality.load_summary(orders, items, "2024-03-01", AS_OF)) == [(3, 3, 35.0)]
    assert rows_of(quality.load_summary(orders, items, "2030-01-01", "2030-01-02")) == [(0, 0, 0.0)]
    enriched = sales_enriched(orders, items, dim).agg(F.count(F.lit(1)).alias("enriched_rows"))
    assert rows_of(quality.tag_coverage(dim, enriched)) == [(4, 3, 4)]


def test_record_search(spark):
    records = {
        "order": spark.createDataFrame([("P-1", "Maria", ["Caneta", "Agenda"])], "id string, client string, items array<string>"),
        "customer": spark.createDataFrame([("C-1", "Maria"), ("C-2", "Ana")], "id string, name string"),
    }
    assert len(rows_of(search.record_search(records, "MARIA "))) == 2
    assert [r.kind for r in search.record_search(records, "maria", "customer").collect()] == ["customer"]
    assert [r.kind for r in search.record_search(records, "agenda").collect()] == ["order"]
    assert search.record_search(records, "").count() == 3
