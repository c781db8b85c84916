"""The shop's tables, taken from the given TPC-H-like Parquet tables.

Dirty values (blank channel, missing total, blank sku ...) are planted by key
arithmetic in all rows, so that the cleansing rules have work to do. Each
expression here has its twin in ``oracle.TABLES``.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom import schemas

# Newest order day of the given tables at every scale.
AS_OF = "2001-08-01"
MONEY = "decimal(18,4)"


def utc_midnight(day: str) -> Column:
    return F.lit(f"{day} 00:00:00+00:00").cast("timestamp")


def _divides(column: str, n: int) -> Column:
    return F.col(column) % n == 0


class Shop:
    """Lazily built inputs of the reports over one folder of tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def given(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def orders(self) -> DataFrame:
        key = F.col("o_orderkey")
        status = (
            F.when(F.col("o_orderstatus") == "F", "Aprovado")
            .when(F.col("o_orderstatus") == "O", "Em aberto")
            .otherwise("aprovação parcial")
        )
        channel = (
            F.when(_divides("o_orderkey", 17), "")
            .when(_divides("o_orderkey", 23), F.lit(None))
            .when(_divides("o_orderkey", 29), "  ")
            .when(_divides("o_orderkey", 59), "null")
            .otherwise(F.col("o_orderpriority"))
        )
        customer = F.when(
            ~_divides("o_orderkey", 31), F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"))
        )
        total = (
            F.when(_divides("o_orderkey", 19), F.lit(None))
            .when(_divides("o_orderkey", 47), F.lit(0).cast("decimal(18,2)"))
            .otherwise(F.col("o_totalprice").cast("decimal(18,2)"))
        )
        return self.given("orders").select(
            key.alias("order_id"),
            F.concat(F.lit("EXT-"), key.cast("string")).alias("external_id"),
            (key + 100000).cast("string").alias("order_number"),
            F.col("o_orderdate").cast("date").alias("order_date"),
            channel.alias("channel"),
            F.col("o_custkey").cast("string").alias("customer_id"),
            customer.alias("customer_name"),
            status.alias("status"),
            total.cast(MONEY).alias("total"),
        )

    @cached_property
    def order_items(self) -> DataFrame:
        part = F.col("l_partkey")
        sku = (
            F.when(_divides("l_orderkey", 37), F.lit(None))
            .when(_divides("l_orderkey", 41), "")
            .otherwise(F.concat(F.lit("SKU-"), part.cast("string")))
        )
        # The same sku is sold under up to two names.
        name = F.when(
            ~_divides("l_orderkey", 53),
            F.concat(F.lit("Produto "), (part % 64).cast("string"), F.lit(" "), F.col("l_linestatus")),
        )
        list_price = F.col("l_extendedprice").cast("decimal(18,2)")
        total = (
            F.when(_divides("l_orderkey", 11), F.lit(None))
            .when(_divides("l_orderkey", 43), F.lit(0).cast("decimal(24,4)"))
            .otherwise(list_price * (1 - F.col("l_discount").cast("decimal(4,2)")))
        )
        cents = F.floor(F.col("l_extendedprice") * 100 / F.col("l_quantity")).cast("decimal(16,0)")
        return self.given("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("item_seq"),
            part.cast("string").alias("product_id"),
            sku.alias("sku"),
            name.alias("product_name"),
            F.when(~_divides("l_orderkey", 61), F.col("l_quantity").cast(MONEY)).alias("qty"),
            F.when(
                ~_divides("l_orderkey", 67), (cents * F.lit("0.01").cast("decimal(3,2)")).cast(MONEY)
            ).alias("price"),
            total.cast(MONEY).alias("total"),
        )

    @cached_property
    def products(self) -> DataFrame:
        """Catalogue rows; bigger sizes come with an older copy under the same sku."""
        part = self.given("part")
        key = F.col("p_partkey")
        listed = F.col("p_retailprice").cast(MONEY)
        columns = [
            F.concat(F.lit("SKU-"), key.cast("string")).alias("sku"),
            F.col("p_name").alias("product_name"),
            listed.alias("price"),
            F.when(~_divides("p_partkey", 7), (listed * F.lit("0.9").cast("decimal(2,1)")).cast(MONEY)).alias(
                "promo_price"
            ),
            F.when(~_divides("p_partkey", 10), (listed * F.lit("0.6").cast("decimal(2,1)")).cast(MONEY)).alias(
                "cost_price"
            ),
            F.lpad(key.cast("string"), 13, "0").alias("gtin"),
            F.lit("UN").alias("unit"),
            F.concat(F.lit("A-"), F.col("p_size").cast("string")).alias("location"),
            F.when(F.col("p_size") <= 45, "A").otherwise("I").alias("status"),
            F.when(
                ~_divides("p_partkey", 13), F.concat(F.col("p_brand"), F.lit(", "), F.col("p_type"), F.lit(" ,"))
            ).alias("tags"),
        ]
        day = F.when(
            ~_divides("p_partkey", 9),
            F.date_add(F.lit("2000-01-01").cast("date"), (key % 500).cast("int")).cast("timestamp_ntz"),
        )
        current = part.select(key.alias("id"), day.alias("created_at"), *columns)
        older = part.where("p_size >= 40").select(
            (-key - 1).alias("id"), F.lit("1999-01-01").cast("timestamp_ntz").alias("created_at"), *columns
        )
        older = older.withColumns(
            {
                "product_name": F.concat("product_name", F.lit(" (old)")),
                "cost_price": (F.col("cost_price") + 1).cast(MONEY),
                "status": F.lit("A"),
            }
        )
        return current.unionByName(older)

    @cached_property
    def stg_products(self) -> DataFrame:
        return self.products.select(
            "id", F.col("sku").alias("code"), F.col("product_name").alias("name"), "gtin", "unit", "price",
            "promo_price", "status", "location", "created_at", "tags", F.lit(None).cast("string").alias("raw_json"),
        )

    @cached_property
    def dim_product(self) -> DataFrame:
        from salesloom.plans.maintain import dim_product_rows

        return dim_product_rows(self.stg_products, utc_midnight(AS_OF))

    @cached_property
    def keyed_products(self) -> DataFrame:
        """The dimension with its keys."""
        from salesloom.plans.maintain import dim_product_rows, new_product_keys

        none = self.spark.createDataFrame([], schemas.PRODUCT_KEYS)
        return dim_product_rows(self.stg_products, utc_midnight(AS_OF), new_product_keys(none, self.stg_products))

    @cached_property
    def stg_orders(self) -> DataFrame:
        """Staged headers; the date is source text, missing for some orders."""
        return self.orders.select(
            "order_id", "order_number",
            F.when(F.col("order_id") % 71 != 0, F.date_format("order_date", "dd/MM/yyyy")).alias("order_date_text"),
            "status", "customer_name", F.lit(None).cast("string").alias("seller"), "total",
            F.lit(None).cast("string").alias("raw_json"),
        )

    @cached_property
    def stg_order_items(self) -> DataFrame:
        return self.order_items.select(
            "order_id", "item_seq", F.lit(None).cast("string").alias("order_number"), F.col("sku").alias("code"),
            F.col("product_name").alias("description"), "qty", F.col("price").alias("unit_price"), "total",
            F.lit(None).cast("string").alias("raw_json"),
        )
