"""Loads that shuffle and store only what they must, with the rows of the plain way."""

import glob
import os
from collections import Counter

import pytest

from salesloom import schemas
from salesloom.contract import registry
from salesloom.contract.tables import Shop
from salesloom.operators.lineage import materialized
from salesloom.operators.upsert import changed_partitions, newest_of_stored, newest_per_key
from salesloom.sources import landing
from tests.conftest import SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def texts(df):
    return Counter(map(str, df.collect()))


@pytest.mark.parametrize("most", [1000, 0])
def test_newest_of_stored_rows(spark, most):
    rows = [(i, i % 3, f"a{i}") for i in range(20)] + [(3, 9, "late"), (3, 9, "later"), (4, None, "none"), (None, 1, "no key"), (None, 2, "no key")]
    stored = materialized(spark.createDataFrame(rows, "id int, version int, text string"))
    expected = newest_per_key(stored, ["id"], ["version"])
    assert texts(newest_of_stored(stored, ["id"], ["version"], most)) == texts(expected)


def test_single_rows_are_not_shuffled(spark):
    stored = materialized(spark.createDataFrame([(i, 1, "x" * i) for i in range(20)] + [(None, 1, "y")], "id int, version int, text string"))
    found = newest_of_stored(stored, ["id"], ["version"])
    assert found.count() == 20 and "Exchange" not in plan(found)


def replies(spark, rows):
    """Replies (id, status, reason, sku) as they are read; a null id names no order."""
    shaped = [(i, (status, reason, {"id": None, "itens": None}, [{"sku": sku}])) for i, status, reason, sku in rows]
    schema = spark.createDataFrame([], schemas.ORDER_DETAIL).schema
    filled = []
    for i, (status, reason, _, lines) in shaped:
        filled.append({"id": i, "retorno": {"status": status, "erros": reason, "itens": [dict(line) for line in lines]}})
    return materialized(landing.with_arrival(spark.createDataFrame(filled, schema).coalesce(1)))


@pytest.mark.parametrize("most", [1000, 0])
def test_stored_replies_settle_alike(spark, most):
    rows = [("1", "OK", None, "a"), ("2", "Erro", "busy", "b"), ("3", "OK", None, "c"), ("3", "Erro", "late", "d"), ("3", "OK", None, "e"),
            ("4", "Erro", "x", "f"), ("4", "Erro", "y", "g"), (None, "OK", None, "h"), (None, "Erro", None, "i"), ("5", None, None, "j")]
    stored = replies(spark, rows)
    columns = ["order_id", "_last", "reason", "replies"]
    assert texts(landing.settled_stored(stored, most).select(columns)) == texts(landing.settled_details(stored).select(columns))


def test_one_nameless_reply_settles_alike(spark):
    stored = replies(spark, [("1", "OK", None, "a"), (None, "OK", None, "b")])
    columns = ["order_id", "_last", "reason", "replies"]
    assert texts(landing.settled_stored(stored).select(columns)) == texts(landing.settled_details(stored).select(columns))


def test_single_replies_are_not_shuffled(spark):
    stored = replies(spark, [(str(i), "OK" if i % 3 else "Erro", "r", "a") for i in range(9)])
    found = landing.settled_stored(stored)
    assert found.count() == 9 and "Exchange" not in plan(found)


def test_parts_that_are_replaced_whole_are_not_read_for_it(spark):
    target = spark.createDataFrame([(1, "old", "a"), (2, "old", "a"), (3, "old", "b"), (4, "old", "b"), (None, "old", "c"), (5, "old", "c"), (6, "old", "d")], "id int, text string, part string")
    rows = materialized(spark.createDataFrame([(1, "new", "a"), (2, "new", "c"), (3, "new", "b"), (5, "new", "c")], target.schema))
    result, parts = changed_partitions(target, materialized(rows.select("id")), rows, ["id"], "part")
    assert parts == ["a", "b", "c"]
    assert texts(result) == texts(spark.createDataFrame([(1, "new", "a"), (2, "new", "c"), (3, "new", "b"), (5, "new", "c"), (4, "old", "b"), (None, "old", "c")], target.schema))
    # Only the months b and c keep rows, so only they are looked through for them.
    logical = result._jdf.queryExecution().optimizedPlan().toString()
    assert "[b,c]" in logical.replace(" ", "") or "IN (b,c)" in logical


def test_landed_files_are_packed(spark, tmp_path):
    registry._land(spark.range(50), registry.F.lit('{"id": "1"}'), str(tmp_path / "landing"))
    files = [f for f in glob.glob(str(tmp_path / "landing" / "part-*"))]
    assert files and all(f.endswith(".gz") and os.path.getsize(f) for f in files)
    assert spark.read.json(str(tmp_path / "landing")).count() == 50


def test_both_fact_loads_read_stored_replies(spark, monkeypatch):
    """The replies are parsed once, not by each load."""
    seen = []
    monkeypatch.setattr(registry, "load_fact_window", lambda shop, landed, details, *rest, **more: seen.extend([plan(landed), plan(details)]))
    monkeypatch.setattr(registry.Warehouse, "load", lambda self, name: None)
    registry.fact_window_loaded(Shop(spark, SMALL))
    assert len(seen) == 4 and not any("from_json" in text or "JsonToStructs" in text for text in seen)
