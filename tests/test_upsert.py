"""Upsert, replace and insert-if-new, on frames and on stored tables."""

from datetime import date

import pytest

from salesloom.operators.upsert import duplicate_keys, insert_new, newest_per_key, replace_keys, upsert
from salesloom.sources.warehouse import Warehouse
from tests.conftest import rows_of

DDL = "id int, stamp int, v string"


@pytest.fixture
def target(spark):
    return spark.createDataFrame([(1, 0, "a"), (2, 0, "b"), (3, 0, "c")], DDL)


@pytest.fixture
def changes(spark):
    return spark.createDataFrame([(2, 1, "old"), (2, 2, "new"), (4, 1, "d"), (None, 9, "x"), (3, None, "undated"), (3, None, "n")], DDL)


def test_newest_change_wins(target, changes):
    once = upsert(target, changes, ["id"], ["stamp"])
    assert sorted(rows_of(once), key=str) == sorted(
        [(1, 0, "a"), (2, 2, "new"), (3, None, "undated"), (4, 1, "d")], key=str
    )


def test_upsert_twice_is_upsert_once(target, changes):
    once = upsert(target, changes, ["id"], ["stamp"])
    twice = upsert(once, changes, ["id"], ["stamp"])
    assert sorted(rows_of(twice), key=str) == sorted(rows_of(once), key=str)


def test_newest_combines_before_the_shuffle(changes):
    plan = newest_per_key(changes, ["id"], ["stamp"])._jdf.queryExecution().toString()
    assert "partial_max" in plan and "Window" not in plan


def test_empty_replacement_deletes(target, spark):
    gone = spark.createDataFrame([(1,), (2,)], "id int")
    rows = spark.createDataFrame([(2, 5, "again"), (2, 6, "more")], DDL)
    assert sorted(rows_of(replace_keys(target, gone, rows, ["id"]))) == [(2, 5, "again"), (2, 6, "more"), (3, 0, "c")]


def test_insert_new_ignores_known_keys(target, changes):
    after = insert_new(target, changes, ["id"])
    assert sorted(rows_of(after)) == [(1, 0, "a"), (2, 0, "b"), (3, 0, "c"), (4, 1, "d")]
    assert sorted(rows_of(insert_new(after, changes, ["id"]))) == sorted(rows_of(after))


def test_duplicate_keys(target, changes):
    assert duplicate_keys(target, ["id"]).count() == 0
    assert rows_of(duplicate_keys(changes.where("id = 2"), ["id"])) == [(2, 2)]


def _orders(spark, rows):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(i, date.fromisoformat(d) if d else None, s) for i, d, s in rows], "order_id bigint, order_date date, status string")
    nulls = {c: F.lit(None).cast("string") for c in ("external_id", "order_number", "channel", "customer_id", "customer_name", "raw_json")}
    return df.withColumns(nulls).withColumn("total", F.lit(1).cast("decimal(18,4)"))


def _state(warehouse):
    return sorted(rows_of(warehouse.load("orders"), "order_id", "status", "month"))


def test_stored_upsert_rewrites_only_touched_months(spark, tmp_path):
    from salesloom.streaming.ingest import upsert_orders

    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    upsert_orders(warehouse, _orders(spark, [(1, "2024-01-05", "a"), (2, "2024-02-05", "a"), (3, "2024-03-05", "a"), (4, None, "a")]))
    files = {m: set((tmp_path / "wh/orders" / f"month={m}").iterdir()) for m in ("2024-01", "2024-02", "2024-03")}
    # Order 2 moves to another month, and its old month is left empty.
    touched = upsert_orders(warehouse, _orders(spark, [(2, "2024-03-09", "b"), (5, "2024-03-01", "a")]))
    assert touched == ["2024-02", "2024-03"]
    assert _state(warehouse) == [
        (1, "a", "2024-01"), (2, "b", "2024-03"), (3, "a", "2024-03"), (4, "a", "none"), (5, "a", "2024-03"),
    ]
    assert set((tmp_path / "wh/orders/month=2024-01").iterdir()) == files["2024-01"]
    again = upsert_orders(warehouse, _orders(spark, [(2, "2024-03-09", "b"), (5, "2024-03-01", "a")]))
    assert again == ["2024-03"]
    assert _state(warehouse)[1] == (2, "b", "2024-03") and len(_state(warehouse)) == 5


def test_since_prunes_months(spark, tmp_path):
    from salesloom.streaming.ingest import upsert_orders

    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    upsert_orders(warehouse, _orders(spark, [(1, "2024-01-05", "a"), (2, "2024-02-05", "a"), (3, "2024-03-05", "a")]))
    recent = warehouse.load("orders", "2024-02-20")
    assert sorted(r.order_id for r in recent.collect()) == [2, 3]
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan


def test_key_tables_are_broadcast_only_up_to_a_counted_size(spark, conf):
    from salesloom.operators.lineage import broadcast_if_small, materialized

    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    keys, table = materialized(spark.range(10)), spark.range(100)
    few = table.join(broadcast_if_small(keys), "id", "left_anti")
    many = table.join(broadcast_if_small(keys, limit=9), "id", "left_anti")
    assert "BroadcastHashJoin" in few._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in many._jdf.queryExecution().executedPlan().toString()
    assert few.count() == many.count() == 90
    distinct = replace_keys(table.toDF("id"), broadcast_if_small(keys), table.limit(0), ["id"])
    assert "BroadcastHashJoin" in distinct._jdf.queryExecution().executedPlan().toString()


def test_stored_upsert_beyond_the_broadcast_size(spark, tmp_path, monkeypatch):
    from salesloom.operators import lineage
    from salesloom.streaming.ingest import upsert_orders

    monkeypatch.setattr(lineage, "BROADCAST_ROWS", 0)
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    upsert_orders(warehouse, _orders(spark, [(1, "2024-01-05", "a"), (2, "2024-02-05", "a")]))
    upsert_orders(warehouse, _orders(spark, [(2, "2024-01-09", "b")]))
    assert _state(warehouse) == [(1, "a", "2024-01"), (2, "b", "2024-01")]
