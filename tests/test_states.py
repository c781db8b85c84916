"""States by day, and the reports merged from them."""

import re

import pytest
from pyspark.sql import functions as F

from salesloom.plans import sales, states
from salesloom.plans.dataset import REPORT_KEYS, materialized_reports
from salesloom.plans.lines import sales_enriched
from salesloom.sources.warehouse import Warehouse, month_text
from tests.conftest import rows_of

AS_OF = "2024-03-20"


@pytest.fixture
def shop(spark, tmp_path, make_orders, make_items):
    warehouse = Warehouse(spark, str(tmp_path))
    products = spark.createDataFrame(
        [("S1", "A", "x"), ("S2", "A", None), ("S3", "I", "y")], "code string, status string, tags string"
    )
    warehouse.materialize("dim_product", products)

    def store(orders, items):
        nulls = {c: F.lit(None).cast("string") for c in ("external_id", "order_number", "customer_id", "raw_json", "product_id")}
        heads = make_orders(orders).withColumns(nulls).withColumn("month", month_text(F.col("order_date")))
        lines = make_items(items).withColumns(nulls).join(heads.select("order_id", "month"), "order_id")
        months = sorted({row.month for row in heads.select("month").collect()})
        for name, rows in (("orders", heads), ("order_items", lines)):
            warehouse.overwrite_months(name, rows, months, moved=False)

    warehouse.store = store
    return warehouse


FEBRUARY = (
    [(1, "2024-02-25", "web", "x", "a", 5), (2, "2024-02-25", " ", "x", "a", None), (3, "2024-02-26", None, "x", "a", 3)],
    [(1, 1, "S1", "n1", 2, 5, None), (1, 2, "S3", "n3", 1, 1, 1), (2, 1, None, None, None, 2, None)],
)
MARCH = ([(4, "2024-03-01", "web", "x", "a", 5), (5, "2024-03-15", "null", "x", "a", 7)], [(4, 1, "S1", "n1", 1, 5, 5), (5, 1, "S2", "n2", 3, None, 6)])


def contents(frames):
    return {name: sorted(map(str, build().collect())) for name, build in frames.items()}


def whole(shop):
    return materialized_reports(shop.load("orders"), shop.load("order_items"), AS_OF)


def test_reports_merge_to_the_same_rows(shop):
    for part in (FEBRUARY, MARCH):
        shop.store(*part)
        states.refresh_states(shop)
        expected = {name: [re.sub(r"Decimal\('([-0-9.]+?)0*'\)", r"\1", row) for row in rows] for name, rows in contents(whole(shop)).items()}
        merged = {name: [re.sub(r"Decimal\('([-0-9.]+?)0*'\)", r"\1", row) for row in rows] for name, rows in contents(states.reports_from_states(shop, AS_OF)).items()}
        assert merged == expected and set(merged) == set(REPORT_KEYS)


def test_a_new_day_reads_and_writes_one_month(shop, monkeypatch):
    shop.store(*FEBRUARY)
    shop.store(*MARCH)
    assert states.refresh_states(shop) == ["2024-02", "2024-03"]
    assert states.refresh_states(shop) == []
    before = shop.folders("state_products")
    shop.store([*MARCH[0], (6, "2024-03-19", "web", "x", "a", 1)], [*MARCH[1], (6, 1, "S1", "n9", 1, 1, 1)])
    read = []
    enriched = states.sales_enriched
    monkeypatch.setattr(states, "sales_enriched", lambda orders, items, active: read.extend([orders, items]) or enriched(orders, items, active))
    assert states.refresh_states(shop) == ["2024-03"]
    # Of all files of the tables only those of March are read.
    for rows in read:
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"PartitionFilters: \[[^\]]*month#\d+ = 2024-03\)", plan), plan
    after = shop.folders("state_products")
    assert after["2024-02"] == before["2024-02"] and after["2024-03"] != before["2024-03"]
    # Names keep their numbers; the new one follows without a gap.
    assert sorted(rows_of(shop.load("product_names"), "name", "number")) == [("n1", 1), ("n2", 2), ("n9", 3)]


def test_a_month_that_is_emptied_leaves_the_states(shop):
    shop.store(*FEBRUARY)
    shop.store(*MARCH)
    states.refresh_states(shop)
    for name in ("orders", "order_items"):
        shop.overwrite_months(name, shop.load(name).limit(0), ["2024-02"], moved=False)
    assert states.refresh_states(shop) == ["2024-02"]
    assert {row.month for row in shop.load("state_days").collect()} == {"2024-03"}


def test_changed_products_make_the_states_anew(shop, spark):
    shop.store(*FEBRUARY)
    states.refresh_states(shop)
    shop.materialize("dim_product", shop.load("dim_product").withColumn("status", F.lit("A")))
    assert states.refresh_states(shop) == ["2024-02"]


@pytest.mark.parametrize("start, end", [("2024-02-01", "2024-03-31"), ("2024-02-26", "2024-03-01"), ("2024-02-25", "2024-02-25"), ("2020-01-01", "2020-02-01")])
def test_any_period_from_the_states(shop, start, end):
    shop.store(*FEBRUARY)
    shop.store(*MARCH)
    states.refresh_states(shop)
    lines = sales_enriched(shop.load("orders"), shop.load("order_items"), shop.load("dim_product"))
    assert rows_of(states.period_summary_from_states(shop, start, end)) == rows_of(sales.period_summary(lines, start, end))


def test_names_beyond_one_bitmap(spark):
    names = spark.range(1, 70_001).selectExpr("CAST(id AS string) AS name", "id AS number")
    sold = spark.range(0, 210_000).selectExpr("DATE'2024-01-01' + CAST(id % 3 AS int) AS day", "CAST(id % 70000 + 1 AS string) AS product")
    bitmaps = states.state_names(sold, names)
    assert bitmaps.select("bucket").distinct().count() == 3
    merged = bitmaps.groupBy("bucket").agg(F.bitmap_or_agg("names").alias("names"))
    assert merged.agg(F.sum(F.bitmap_count("names"))).first()[0] == 70_000


def test_days_and_channels_come_from_one_join(shop, monkeypatch):
    shop.store(*FEBRUARY)
    joins = []
    sold = states.sold_lines
    monkeypatch.setattr(states, "sold_lines", lambda *args: joins.append(args) or sold(*args))
    states.refresh_states(shop)
    assert len(joins) == 2  # cells by channel, products
