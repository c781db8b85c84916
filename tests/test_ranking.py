"""Sliced running sums and numbers against the plain window."""

from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from salesloom.operators.ordering import high_first, low_first, page, top
from salesloom.operators.ranking import numbered, running_share


@pytest.fixture
def sales(spark):
    """3,000 rows; a third of them share one value, others tie in pairs, some have none."""
    n = F.col("id")
    value = F.when(n % 3 == 0, F.lit(50)).when(n % 101 == 0, F.lit(None)).otherwise(F.floor(n / 2) % 700)
    return spark.range(3000).select("id", value.cast("decimal(28,4)").alias("revenue"))


def test_running_share_equals_window(sales):
    order = Window.orderBy(high_first("revenue"))
    whole_table = sales.select("id", F.sum("revenue").over(order).alias("c"), F.sum("revenue").over(Window.partitionBy()).alias("t"))
    plain = {r.id: (r.c, r.t) for r in whole_table.collect()}
    sliced = {r.id: (r.cumulative, r.grand_total) for r in running_share(sales, "revenue", slices=7).collect()}
    assert sliced == plain
    assert len(sliced) == 3000
    whole = sum(r.revenue or Decimal(0) for r in sales.collect())
    assert max(c for c, _ in sliced.values()) == whole


def test_numbers_equal_window(sales):
    order = [high_first("revenue"), low_first("id")]
    plain = {r.id: r.rank for r in sales.select("id", F.row_number().over(Window.orderBy(*order)).alias("rank")).collect()}
    sliced = {r.id: r.rank for r in numbered(sales, "rank", order, slices=7).collect()}
    assert sliced == plain
    assert sorted(sliced.values()) == list(range(1, 3001))


def test_slices_stay_even_under_a_hot_value(sales):
    df = numbered(sales, "rank", [high_first("revenue"), low_first("id")], slices=6)
    plan = df._jdf.queryExecution().toString()
    assert "_slice" in plan
    from salesloom.operators.ranking import _sliced

    sliced = _sliced(sales, [high_first("revenue"), low_first("id")], 6)
    sizes = [r["count"] for r in sliced.groupBy("_slice").count().collect()]
    assert max(sizes) < 3000 / 3


def test_top_and_page_place_nulls_last(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 7), (4, None), (5, 1)], "id int, v int")
    order = [high_first("v"), low_first("id")]
    assert [r.id for r in top(df, 4, *order).collect()] == [3, 1, 5, 2]
    assert [r.id for r in page(df, 2, 2, *order).collect()] == [5, 2]
    assert [r.id for r in page(df, 9, 2, *order).collect()] == []
