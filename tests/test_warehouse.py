"""Versions, refresh, exports, and the fact reload on storage."""

import csv
import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from salesloom.operators.lineage import materialized
from salesloom.plans import maintain
from salesloom.plans.dataset import REPORT_KEYS, materialized_reports
from salesloom.operators.upsert import RepeatedKey, duplicate_keys
from salesloom.sources.catalog import ConcurrentChange
from salesloom.sources.sinks import with_raw_json, write_csv
from salesloom.sources.warehouse import Warehouse, add_missing_columns
from salesloom.streaming.ingest import upsert_orders
from tests.conftest import rows_of


class Killed(Exception):
    pass


def killed_before_the_switch(warehouse, monkeypatch):
    def die(*_):
        raise Killed

    monkeypatch.setattr(warehouse.catalog, "switch", die)


def test_readers_keep_the_old_table_until_the_new_one_is_complete(spark, tmp_path, monkeypatch):
    warehouse = Warehouse(spark, str(tmp_path))
    warehouse.materialize("report", spark.range(3))
    dying = Warehouse(spark, str(tmp_path))
    killed_before_the_switch(dying, monkeypatch)
    with pytest.raises(Killed):
        dying.materialize("report", spark.range(9))
    before = warehouse.load("report")
    assert before.count() == 3
    warehouse.materialize("report", spark.range(5))
    assert warehouse.load("report").count() == 5 and before.count() == 3
    assert spark.table("report").count() == 5
    with pytest.raises(ValueError, match="no table"):
        warehouse.load("nothing")


def _dated(spark, rows):
    nulls = {c: F.lit(None).cast("string") for c in ("external_id", "order_number", "channel", "customer_id", "customer_name", "raw_json")}
    df = spark.createDataFrame([(i, date.fromisoformat(d), s) for i, d, s in rows], "order_id bigint, order_date date, status string")
    return df.withColumns(nulls).withColumn("total", F.lit(1).cast("decimal(18,4)"))


def _lines(spark, rows):
    nulls = {c: F.lit(None).cast("string") for c in ("product_id", "sku", "product_name", "raw_json")}
    money = {c: F.lit(1).cast("decimal(18,4)") for c in ("qty", "price", "total")}
    return spark.createDataFrame(rows, "order_id bigint, item_seq int, month string").withColumns(nulls | money)


def _held(warehouse):
    return (
        sorted(rows_of(warehouse.load("orders"), "order_id", "status", "month")),
        sorted(rows_of(warehouse.load("order_items"), "order_id", "item_seq", "month")),
        sorted(rows_of(warehouse.load("order_months"), "order_id", "month")),
    )


def test_a_job_that_dies_before_the_switch_changes_nothing(spark, tmp_path, monkeypatch):
    """Headers, lines and index change together: old rows after the death, new ones after the rerun."""
    warehouse = Warehouse(spark, str(tmp_path))
    upsert_orders(warehouse, _dated(spark, [(1, "2024-01-05", "a"), (2, "2024-02-05", "a"), (3, "2024-03-05", "a")]))
    lines = _lines(spark, [(1, 1, "2024-01"), (2, 1, "2024-02"), (2, 2, "2024-02")])
    warehouse.replace("order_items", lines, lines, ["order_id"], [])
    before, changes = _held(warehouse), _dated(spark, [(2, "2024-03-09", "b"), (5, "2024-03-01", "a")])
    dying = Warehouse(spark, str(tmp_path))
    killed_before_the_switch(dying, monkeypatch)
    with pytest.raises(Killed):
        upsert_orders(dying, changes)
    assert _held(warehouse) == before == _held(Warehouse(spark, str(tmp_path)))
    # Also when the job dies while it writes the second of its tables.
    half = Warehouse(spark, str(tmp_path))
    write, written = half._write_parts, []

    def die_at_second(name, rows, parts):
        if written:
            raise Killed
        written.append(name)
        write(name, rows, parts)

    monkeypatch.setattr(half, "_write_parts", die_at_second)
    with pytest.raises(Killed):
        upsert_orders(half, changes)
    assert written and _held(warehouse) == before
    assert upsert_orders(warehouse, changes) == ["2024-02", "2024-03"]
    after = _held(warehouse)
    assert after[0] == [(1, "a", "2024-01"), (2, "b", "2024-03"), (3, "a", "2024-03"), (5, "a", "2024-03")]
    assert after[1] == [(1, 1, "2024-01"), (2, 1, "2024-03"), (2, 2, "2024-03")]
    assert after[2] == [(1, "2024-01"), (2, "2024-03"), (3, "2024-03"), (5, "2024-03")]
    # What the dead jobs left is named by no list, and goes on request.
    unused = warehouse.drop_unused(keep=1)
    assert any(folder.startswith("orders/month=2024-03") for folder in unused)
    assert _held(warehouse) == after and warehouse.drop_unused(keep=1) == []


def test_of_two_changes_at_a_time_one_is_refused(spark, tmp_path):
    one, other = Warehouse(spark, str(tmp_path)), Warehouse(spark, str(tmp_path))
    with pytest.raises(ConcurrentChange), one.together():
        upsert_orders(one, _dated(spark, [(1, "2024-01-05", "one")]))
        upsert_orders(other, _dated(spark, [(1, "2024-01-05", "other")]))
    assert rows_of(one.load("orders"), "order_id", "status") == [(1, "other")]


def test_the_index_says_which_months_to_read(spark, tmp_path, monkeypatch):
    from salesloom.sources import warehouse as module

    monkeypatch.setattr(module, "SPAN_IDS", 10)
    warehouse = Warehouse(spark, str(tmp_path))
    upsert_orders(warehouse, _dated(spark, [(i, f"2024-{1 + i // 10:02d}-05", "a") for i in range(1, 60)]))
    parts = {part for table, part in warehouse.catalog.current()[1] if table == "order_months"}
    assert parts == {"0", "1", "2", "3", "4", "5"}
    asked = materialized(spark.createDataFrame([(12,), (15,), (900,)], "order_id bigint"))
    found = warehouse.homes("orders", asked)
    assert sorted(rows_of(found)) == [(12, "2024-02"), (15, "2024-02")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*span#\d+ IN \(1,90\)", plan)
    # An upsert reads the keys of those months only: no scan of orders without a month.
    seen = []
    partitions = module.changed_partitions
    monkeypatch.setattr(module, "changed_partitions", lambda *args: seen.append(args[-1]) or partitions(*args))
    warehouse.replace("orders", asked, _dated(spark, []).withColumn("month", F.lit("x")).limit(0), ["order_id"])
    assert seen[0] == ["2024-02"] and warehouse.load("orders").count() == 57
    assert sorted(r.order_id for r in warehouse.load("order_months").where("span = '1'").collect()) == [10, 11, 13, 14, 16, 17, 18, 19]


def test_appended_batches_are_joined_and_repeats_replace(spark, tmp_path, monkeypatch):
    from salesloom.sources import warehouse as module

    monkeypatch.setattr(module, "BATCHES", 3)
    warehouse = Warehouse(spark, str(tmp_path))
    for n in (1, 2, 2, 3, 4):
        warehouse.append("rejected_pages", spark.createDataFrame([(f"f{n}", "bad", "{}")], "file string, reason string, page string"), f"orders-{n:03d}")
    rows = warehouse.load("rejected_pages")
    assert sorted(r.file for r in rows.collect()) == ["f1", "f2", "f3", "f4"]
    parts = {part for table, part in warehouse.catalog.current()[1] if table == "rejected_pages"}
    assert len(parts) == 2 and "orders-004" in parts


def test_a_repeated_report_key_leaves_all_reports_as_they_were(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    good = {"a": lambda: spark.range(3), "b": lambda: spark.range(2)}
    warehouse.refresh(good, keys={"a": ["id"], "b": ["id"]})
    bad = {"a": lambda: spark.range(7), "b": lambda: spark.range(2).union(spark.range(1))}
    with pytest.raises(RepeatedKey, match="b: {'id': 0"):
        warehouse.refresh(bad, keys={"a": ["id"], "b": ["id"]})
    assert warehouse.load("a").count() == 3 and warehouse.load("b").count() == 2


def test_product_keys_are_given_once(spark):
    known = spark.createDataFrame([("B", 7)], "code string, product_key bigint")
    codes = spark.createDataFrame([("C",), ("B",), ("A",), (None,), ("A",)], "code string")
    fresh = maintain.new_product_keys(known, codes)
    assert sorted(rows_of(fresh)) == [("A", 8), ("C", 9)]
    assert maintain.new_product_keys(known.unionByName(fresh), codes).count() == 0


def test_refresh_counts_and_keys(spark, tmp_path, make_orders, make_items):
    orders = make_orders([(1, "2024-03-01", "a", "x", "Aprovado", 5), (2, "2024-03-02", " ", None, None, None)])
    items = make_items([(1, 1, "S", "n", 1, 5, 5), (1, 2, None, None, 1, 1, None)])
    warehouse = Warehouse(spark, str(tmp_path))
    reports = materialized_reports(orders, items, "2024-03-10")
    counts = dict(rows_of(warehouse.refresh(reports)))
    assert set(counts) == set(REPORT_KEYS) and counts["daily_orders"] == 2 and counts["product_ranking_90d"] == 2
    for name, keys in REPORT_KEYS.items():
        assert duplicate_keys(warehouse.load(name), keys).count() == 0
    assert dict(rows_of(warehouse.refresh(reports, ["channels_30d"]))) == {"channels_30d": 2}


def test_csv_quotes_everything(spark, tmp_path):
    df = spark.createDataFrame([(1, 'say "hi", ok', None), (2, "", "ç\nx")], "n int, a string, b string").coalesce(1)
    write_csv(df, str(tmp_path / "out"))
    (part,) = (tmp_path / "out").glob("part-*.csv")
    text = part.read_text(encoding="utf-8")
    assert text.splitlines()[:2] == ['"n","a","b"', '"1","say ""hi"", ok",""']
    with open(part, newline="", encoding="utf-8") as handle:
        assert list(csv.reader(handle)) == [["n", "a", "b"], ["1", 'say "hi", ok', ""], ["2", "", "ç\nx"]]


def test_raw_json_and_added_columns(spark):
    df = spark.createDataFrame([(1, "x")], "id int, tags string")
    assert with_raw_json(df).first().raw_json == '{"id":1,"tags":"x"}'
    wider = add_missing_columns(df, {"tags": "string", "note": "string"})
    assert wider.columns == ["id", "tags", "note"] and wider.first().tags == "x"


def _staging(spark, day="05/03/2024"):
    orders = spark.createDataFrame(
        [(1, "10", "20/02/2024", "a"), (2, "11", day, "b"), (3, "12", None, "c"), (4, "13", "01/01/2024", "d")],
        "order_id bigint, order_number string, order_date_text string, status string",
    )
    items = spark.createDataFrame(
        [(1, 1, "A", 5), (2, 1, "A", 7), (2, 1, "A", 7), (2, 2, "Z", 1), (3, 1, "A", 2), (4, 1, "A", 9)],
        "order_id bigint, item_seq int, code string, total int",
    ).withColumns({
        "description": F.col("code"), "qty": F.lit(1).cast("decimal(18,4)"),
        "unit_price": F.lit(None).cast("decimal(18,4)"), "total": F.col("total").cast("decimal(18,4)"),
    })
    dim = spark.createDataFrame([("A", 77)], "code string, product_key bigint")
    return items, orders, dim


def test_fact_reload_is_repeatable_and_keeps_the_edge_month(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    items, orders, dim = _staging(spark)
    # First load covers everything up to 10 March.
    months = maintain.reload_fact_window(warehouse, items, orders, dim, "2024-03-10", days=100)
    assert months == ["2023-12", "2024-01", "2024-02", "2024-03"]

    def facts():
        return sorted(rows_of(warehouse.load("f_sales"), "order_id", "item_seq", "date_key", "product_key", "total", "unit_price", "month"))

    first = facts()
    assert first == [
        (1, 1, 20240220, 77, 5.0, 0.0, "2024-02"),
        (2, 1, 20240305, 77, 7.0, 0.0, "2024-03"),
        (2, 2, 20240305, None, 1.0, 0.0, "2024-03"),
        (3, 1, 20240310, 77, 2.0, 0.0, "2024-03"),
        (4, 1, 20240101, 77, 9.0, 0.0, "2024-01"),
    ]
    maintain.reload_fact_window(warehouse, items, orders, dim, "2024-03-10", days=100)
    assert facts() == first
    # A 10-day window: 29 Feb on. Order 1 lies before it in February and is carried over;
    # order 2 lost its lines in staging, so its facts go.
    gone = items.where("order_id <> 2")
    maintain.reload_fact_window(warehouse, gone, orders, dim, "2024-03-10", days=10)
    assert facts() == [r for r in first if r[0] != 2]
    # A window whose month ends up empty.
    maintain.reload_fact_window(warehouse, items.where("order_id = 1"), orders, dim, "2024-03-10", days=9)
    assert [r[0] for r in facts()] == [1, 4]


def test_dim_date(spark):
    rows = {r.date_value: r for r in maintain.dim_date(spark, "2024-02-29").collect()}
    assert min(rows) == date(2018, 2, 28) and max(rows) == date(2025, 2, 28)
    sunday = rows[date(2024, 2, 25)]
    assert (sunday.dow, sunday.dow_name, sunday.is_weekend, sunday.date_key) == (0, "Sunday", True, 20240225)
    assert rows[date(2024, 2, 29)].month_name == "February" and not rows[date(2024, 2, 29)].is_weekend


def test_reports_on_stored_tables_read_recent_months_only(spark, tmp_path):
    import re

    from salesloom.contract.tables import AS_OF, Shop
    from salesloom.plans import products
    from salesloom.sources.warehouse import month_text
    from tests.conftest import SMALL

    shop = Shop(spark, SMALL)
    warehouse = Warehouse(spark, str(tmp_path))
    raw = F.lit(None).cast("string").alias("raw_json")
    month = month_text(F.col("order_date")).alias("month")
    orders = shop.orders.select("*", raw, month)
    items = shop.order_items.join(orders.select("order_id", "month"), "order_id").withColumn("raw_json", raw)
    for name, rows in (("orders", orders), ("order_items", items)):
        warehouse.overwrite_months(name, rows, [])
    whole = warehouse.load("orders"), warehouse.load("order_items")
    recent = warehouse.recent(AS_OF, 90)
    for report in (products.product_sales, products.falling_products, products.abc_curve):
        expected = sorted(map(str, report(shop.orders, shop.order_items, AS_OF).collect()))
        assert sorted(map(str, report(*whole, AS_OF).collect())) == expected
        assert sorted(map(str, report(*recent, AS_OF).collect())) == expected
    plan = products.product_sales(*recent, AS_OF)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 2 and all(re.search(r"PartitionFilters: \[isnotnull\(month#\d+\), \(month#\d+ >= 2001-05\)", s) for s in scans)
    assert recent[1].select("month").distinct().count() == 4
    # Writes are rebalanced by month: one file per small month, not one per task and month.
    assert all(len(list(folder.glob("part-*"))) == 1 for folder in (tmp_path / "order_items").glob("month=*/v=*"))


def test_stored_backfill_rewrites_only_lacking_months(spark, tmp_path, make_orders, make_items):
    from salesloom.sources.warehouse import month_text

    orders = make_orders([
        (1, "2024-01-05", "a", None, None, 10), (2, "2024-02-05", "null", None, None, None), (3, "2024-03-05", "b", None, None, 0),
    ])
    items = make_items([(1, 1, "A", "a", 1, 10, 10), (2, 1, "A", "a", 2, 3, None), (2, 2, "B", "b", 1, 4, 5), (3, 1, "A", "a", 1, 7, 7)])
    nulls = {c: F.lit(None).cast("string") for c in ("external_id", "order_number", "customer_id", "raw_json", "product_id")}
    orders = orders.withColumns(nulls).withColumn("month", month_text(F.col("order_date")))
    items = items.withColumns(nulls).join(orders.select("order_id", "month"), "order_id")
    warehouse = Warehouse(spark, str(tmp_path))
    warehouse.overwrite_months("orders", orders, [])
    warehouse.overwrite_months("order_items", items, [])
    january = {t: set((tmp_path / t / "month=2024-01").iterdir()) for t in ("orders", "order_items")}
    for _ in range(2):
        maintain.backfill_tables(warehouse)
        assert sorted(rows_of(warehouse.load("orders"), "order_id", "channel", "total")) == [
            (1, "a", 10.0), (2, "(sem canal)", 11.0), (3, "b", 7.0),
        ]
        assert sorted(rows_of(warehouse.load("order_items"), "order_id", "item_seq", "total"))[1:3] == [(2, 1, 6.0), (2, 2, 5.0)]
    assert all(set((tmp_path / t / "month=2024-01").iterdir()) == files for t, files in january.items())
