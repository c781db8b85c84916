"""Physical plans: what must hold when the tables are very large."""

import re

import pytest
from pyspark.sql import functions as F

from salesloom.contract.registry import bound_queries
from salesloom.contract.tables import AS_OF, Shop
from salesloom.plans import products, sales
from salesloom.plans.dataset import materialized_reports
from salesloom.plans.lines import sales_enriched, sold_lines
from salesloom.plans.maintain import fact_rows, migrate_items
from salesloom.sources.warehouse import Warehouse
from tests.conftest import SMALL

QUERIES = bound_queries()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_no_python(spark, conf, name):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    plan = plan_of(QUERIES[name](spark, SMALL))
    for node in ("CartesianProduct", "NestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert node not in plan


@pytest.mark.parametrize(
    "name", ["falling_products", "channel_orders", "period_summary", "sales_question_totals", "weekly_channel_change", "product_sales", "top_customers", "abc_leaders"]
)
def test_date_filter_reaches_the_scan(spark, name):
    plan = plan_of(QUERIES[name](spark, SMALL))
    scans = [line for line in plan.splitlines() if "FileScan" in line and "o_orderdate" in line]
    assert scans and all("GreaterThanOrEqual(o_orderdate" in line for line in scans)


def test_calendar_year_reaches_the_scan(spark):
    from salesloom.functions.predicates import in_year_month

    plan = plan_of(Shop(spark, SMALL).orders.where(in_year_month(F.col("order_date"), 2000)))
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan


def test_only_used_columns_are_read(spark):
    plan = plan_of(QUERIES["channel_orders"](spark, SMALL))
    (schema,) = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    read = {field.split(":")[0] for field in schema.split(",")}
    assert read == {"o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority"}


@pytest.mark.parametrize("name", ["product_ranking_sliced", "abc_curve_sliced", "order_running_share"])
def test_whole_table_windows_gather_only_slice_totals(spark, name):
    """The one single-partition exchange takes the output of an aggregate by slice."""
    lines = plan_of(QUERIES[name](spark, SMALL)).splitlines()
    at = [i for i, line in enumerate(lines) if "SinglePartition" in line]
    assert len(at) == 1
    below = "\n".join(lines[at[0] + 1 : at[0] + 3])
    assert "HashAggregate(keys=[_slice" in below


@pytest.mark.parametrize("name", ["period_summary", "abc_leaders", "falling_products_approved", "gross_margin", "kpi_comparison"])
def test_lines_are_scanned_once(spark, conf, name):
    """Parts of a report that share the line join also share its shuffle."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    df = QUERIES[name](spark, SMALL)
    df.collect()
    final = plan_of(df).split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet [l_") <= 1


def test_top_k_is_taken_per_task(spark):
    plan = plan_of(QUERIES["top_customers"](spark, SMALL))
    assert "TakeOrderedAndProject" in plan and "SinglePartition" not in plan


def test_first_lines_are_limited_before_the_shuffle(spark):
    from salesloom.contract import registry
    from salesloom.plans import questions
    import salesloom.plans.questions as module

    captured = []
    original = module.materialized
    module.materialized = lambda df: captured.append(plan_of(df)) or original(df)
    try:
        shop = Shop(spark, SMALL)
        questions.question_lines(
            registry._question_texts(shop), sales_enriched(shop.orders, shop.order_items, shop.dim_product), ["promo"], limit=10
        )
    finally:
        module.materialized = original
    (lines,) = [plan for plan in captured if "lineitem" in plan]
    assert "WindowGroupLimit" in lines and "Partial" in lines


def skewed(spark):
    """One order holds a third of all lines, and one sku half of them."""
    n = F.col("id")
    orders = spark.range(3000).select(
        (n + 1).alias("order_id"), F.date_add(F.lit("2024-01-01").cast("date"), (n % 80).cast("int")).alias("order_date"),
        F.lit("x").alias("channel"), F.lit("Aprovado").alias("status"), F.lit(1).cast("decimal(18,4)").alias("total"),
        F.repeat(F.lit("pad"), 20).alias("customer_name"),
    )
    items = spark.range(120000).select(
        F.when(n % 3 == 0, 7).otherwise(n % 3000 + 1).alias("order_id"), (n % 1000000).cast("int").alias("item_seq"),
        F.when(n % 2 == 0, "HOT").otherwise(F.concat(F.lit("S"), (n % 500).cast("string"))).alias("sku"),
        F.lit("n").alias("product_name"), *[F.lit(1).cast("decimal(18,4)").alias(c) for c in ("qty", "price", "total")],
    )
    dim = spark.range(500).select(F.concat(F.lit("S"), n.cast("string")).alias("code")).union(
        spark.createDataFrame([("HOT",)], "code string")
    ).withColumns({"status": F.lit("A"), "tags": F.lit("t")})
    return orders, items, dim


SKEW = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "200KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.3",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "100KB",
    "spark__sql__adaptive__coalescePartitions__enabled": "false",
    "spark__sql__shuffle__partitions": "16",
    "spark__sql__optimizer__runtime__bloomFilter__enabled": "false",
}


def test_hot_order_is_split_in_the_line_join(spark, conf):
    conf(**SKEW)
    orders, items, _ = skewed(spark)
    joined = sold_lines(orders, items, ["order_date"], ["sku", "qty", "total"]).groupBy("sku").agg(F.sum("total").alias("t"))
    rows = {r.sku: int(r.t) for r in joined.collect()}
    assert rows["HOT"] == 60000 and sum(rows.values()) == 120000
    assert "skew=true" in plan_of(joined)


def test_hot_sku_is_split_in_the_product_join(spark, conf):
    conf(**SKEW)
    orders, items, dim = skewed(spark)
    lines = sales_enriched(orders, items, dim)
    assert lines.count() == 120000
    counted = lines.groupBy("day").agg(F.count(F.lit(1)).alias("n"))
    assert sum(r.n for r in counted.collect()) == 120000
    assert plan_of(counted).count("skew=true") >= 1


def test_rollup_joins_products_after_summing(spark):
    shop = Shop(spark, SMALL)
    from salesloom.plans.lines import sales_rollup

    plan = sales_rollup(shop.orders, shop.order_items, shop.dim_product)._jdf.queryExecution().optimizedPlan().toString()
    join = plan.index("Join Inner, (sku")
    assert "Aggregate [order_date" in plan[join:]


def test_hot_groups_combine_before_the_shuffle(spark):
    shop = Shop(spark, SMALL)
    for df in (
        products.product_sales(shop.orders, shop.order_items, AS_OF),
        sales.daily_orders_from_lines(shop.orders, shop.order_items),
        products.sku_totals(shop.orders, shop.order_items, AS_OF),
    ):
        assert "partial_sum" in plan_of(df)


def test_lines_are_hashed_not_sorted_when_summed(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    shop = Shop(spark, SMALL)
    for df in (products.product_sales(shop.orders, shop.order_items, AS_OF), products.sku_totals(shop.orders, shop.order_items, AS_OF)):
        lines = plan_of(df).splitlines()
        deepest = max(i for i, line in enumerate(lines) if "Aggregate(" in line)
        assert "HashAggregate" in lines[deepest]


def test_same_result_under_any_partition_count(spark, conf):
    names = ["abc_curve_sliced", "product_ranking_sliced", "falling_products", "weekly_channel_change"]
    before = {n: sorted(map(str, QUERIES[n](spark, SMALL).collect())) for n in names}
    conf(spark__sql__shuffle__partitions="13", spark__sql__adaptive__enabled="false")
    for n in names:
        assert sorted(map(str, QUERIES[n](spark, SMALL).collect())) == before[n]


def test_lines_meet_their_orders_once_for_all_reports(spark, tmp_path, make_orders, make_items):
    met = spark.sparkContext.accumulator(0)

    def seen(key):
        met.add(1)
        return key

    orders = make_orders([(1, "2024-03-01", "a", "x", "Aprovado", 5), (2, "2024-03-02", " ", None, None, None), (3, "2020-01-01", "b", None, None, 1)])
    items = make_items([(1, 1, "S", "n", 1, 5, 5), (1, 2, None, None, 1, 1, None), (3, 1, "S", "o", None, 2, 7)])
    items = items.withColumn("order_id", F.udf(seen, "bigint").asNondeterministic()("order_id"))
    shop = Warehouse(spark, str(tmp_path))
    shop.refresh(materialized_reports(orders, items, "2024-03-10"))
    assert met.value == 3
    days = {str(r.day): (r.orders, r["items"], r.revenue) for r in shop.load("daily_orders_lines").collect()}
    assert days == {"2024-03-01": (1, 2, 6), "2024-03-02": (1, None, None), "2020-01-01": (1, 0, 7)}
    assert [(r.sku, r["product_name"], r.qty) for r in shop.load("product_sales_90d").collect()] == [("S", "n", 1), (None, "", 1)]


def test_known_legacy_lines_go_before_their_json_is_made(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    money = "decimal(18,4)"
    items = spark.createDataFrame(
        [(1, 1, "p", "s", "n", None, None, None, "{}")],
        f"order_id bigint, item_seq int, product_id string, sku string, product_name string, qty {money}, price {money}, total {money}, raw_json string",
    )
    legacy = spark.createDataFrame(
        [(1, 1, "q", "t", "m"), (1, 2, "a", "b", "c"), (1, 2, "a", "b", "d"), (None, 3, "a", "b", "d"), (2, None, "a", "b", "d")],
        "order_id bigint, item_seq int, produto_id string, produto_codigo string, produto_nome string",
    ).selectExpr("*", *[f"cast(null as {money}) as {name}" for name in ("quantidade", "valor_unitario", "valor_total")])
    both = migrate_items(items, legacy)
    assert sorted((r.order_id, r.item_seq, r.product_name) for r in both.collect()) == [(1, 1, "n"), (1, 2, "d")]
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert plan.index("StructsToJson") < plan.index("LeftAnti")  # a plan is written from its end


def test_lines_of_few_orders_are_replaced_without_a_shuffle(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    plan = plan_of(bound_queries()["order_lines_replaced"](spark, SMALL))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_fact_lines_meet_their_headers_once(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    money = "decimal(18,4)"
    headers = spark.createDataFrame(
        [(1, "7", "05/03/2024", "a"), (2, "8", "01/01/2020", "b"), (2, "9", None, "b")],
        "order_id bigint, order_number string, order_date_text string, status string",
    )
    lines = spark.createDataFrame(
        [(1, 1, "A", "x"), (1, 1, "B", "x"), (1, 2, None, "y"), (1, None, "C", "z"), (None, 1, "C", "z"), (2, 1, "D", "w"), (3, 1, "E", "v")],
        "order_id bigint, item_seq int, code string, description string",
    ).selectExpr("*", *[f"cast(null as {money}) as {name}" for name in ("qty", "unit_price", "total")])
    got = {}
    for days in (None, 30):
        facts = fact_rows(lines, headers, None, "2024-03-10", days)
        plan = plan_of(facts)
        got[days] = sorted((r.order_id, r.item_seq, r.code, r.date_key) for r in facts.collect())
        assert len(re.findall(r"SortMergeJoin [^\n]*Inner", plan)) == (1 if days is None else 0), plan
    assert got[None] == got[30] == [(1, 1, "B", 20240305), (1, 2, None, 20240305), (2, 1, "D", 20240310)]
