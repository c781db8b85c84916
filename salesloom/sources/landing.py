"""Readers of landed JSON pages: orders, order details, products.

The page API is called elsewhere; its replies land as JSON files, one reply per
line. Reading them is a distributed scan with a declared schema.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom import schemas
from salesloom.functions import cleanse as C
from salesloom.operators.lineage import BROADCAST_ROWS, materialized

OK = "OK"


class RejectedPages(RuntimeError):
    """A page reports an error; the load must not go on as if it were empty."""


# When and where a reply landed: file time, file, place of the split in the file,
# row within the split. Of two versions of a record the later one counts.
ARRIVED = "arrived"


def file_of_page() -> Column:
    """Arrival of a row that a file source reads, up to the place of its split."""
    names = {"time": "file_modification_time", "file": "file_path", "split": "file_block_start"}
    return F.struct(*[F.col(f"_metadata.{field}").alias(name) for name, field in names.items()]).alias(ARRIVED)


def with_arrival(pages: DataFrame) -> DataFrame:
    """Pages with their full arrival; rows that no file source read go by their order. Pages
    that have it, stored ones, keep it."""
    if ARRIVED in pages.columns and "row" in pages.schema[ARRIVED].dataType.names:
        return pages
    if ARRIVED in pages.columns:
        known = [F.col(f"{ARRIVED}.{name}").alias(name) for name in ("time", "file", "split")]
    else:
        kinds = {"time": "timestamp", "file": "string", "split": "bigint"}
        known = [F.lit(None).cast(kind).alias(name) for name, kind in kinds.items()]
    return pages.withColumn(ARRIVED, F.struct(*known, F.monotonically_increasing_id().alias("row")))


def read_pages(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_arrived_pages(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return with_arrival(read_pages(spark, path, schema).select("*", file_of_page()))


def split_ok_rejects(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pages with status OK, and the others with the reason they give."""
    status = F.col("retorno.status")
    ok = pages.where(status == OK)
    rejects = pages.where(status.isNull() | (status != OK)).withColumn("reason", _reason())
    return ok, rejects


def _reason() -> Column:
    return F.coalesce(F.col("retorno.erros"), F.col("retorno.status"), F.lit("no reply"))


def require_ok(pages: DataFrame) -> DataFrame:
    """The pages, or an error when one of them is bad."""
    ok, rejects = split_ok_rejects(pages)
    bad = rejects.select("reason").take(1)
    if bad:
        raise RejectedPages(bad[0]["reason"])
    return ok


class _Entry:
    """Fields of an array element ``w`` that is wrapped (``{wrapper: {...}}``) or bare.

    Each field is picked by itself; no struct is built only to be taken apart.
    """

    def __init__(self, rows: DataFrame, wrapper: str):
        self.wrapped = F.col(f"w.{wrapper}")
        self.names = [name for name in rows.select("w.*").columns if name != wrapper]

    def __getitem__(self, name: str) -> Column:
        return F.when(self.wrapped.isNotNull(), self.wrapped[name]).otherwise(F.col(f"w.{name}"))

    def raw_json(self) -> Column:
        bare = F.struct(*[F.col(f"w.{name}").alias(name) for name in self.names])
        return F.when(self.wrapped.isNotNull(), F.to_json(self.wrapped)).otherwise(F.to_json(bare))


def _entries(pages: DataFrame, array: str, wrapper: str) -> tuple[DataFrame, _Entry]:
    """One row per array element, and its fields; with its place, where arrival is known."""
    if ARRIVED in pages.columns:
        rows = pages.select(ARRIVED, F.posexplode(f"retorno.{array}").alias("pos", "w"))
    else:
        rows = pages.select(F.explode(f"retorno.{array}").alias("w"))
    return rows, _Entry(rows, wrapper)


def _arrival(rows: DataFrame) -> list[Column]:
    """The arrival column of entries, where it is known."""
    return [F.struct(f"{ARRIVED}.*", "pos").alias(ARRIVED)] if ARRIVED in rows.columns else []


def order_rows(pages: DataFrame, amounts: bool = False) -> DataFrame:
    """Order headers of OK pages, on demand with the columns of ``order_amounts``; entries
    without an id are dropped."""
    entries, e = _entries(pages, "pedidos", "pedido")
    return entries.select(
        e["id"].try_cast("bigint").alias("order_id"),
        e["id"].alias("external_id"),
        C.first_filled(e["numero"]).alias("order_number"),
        C.parse_source_day(
            C.first_filled(
                e["data_pedido"], e["data_emissao"], e["data"], e["data_criacao"], e["dataEmissao"]
            )
        ).alias("order_date"),
        C.first_filled(e["canal_venda"], e["origem"]).alias("channel"),
        C.first_filled(e["id_cliente"], e["cliente_id"]).alias("customer_id"),
        C.first_filled(e["nome"], e["cliente"], e["cliente_nome"]).alias("customer_name"),
        C.first_filled(e["situacao"], e["status"]).alias("status"),
        C.number_or_null(
            F.coalesce(e["valor_total"], C.first_nonzero(e["valor"], e["total_pedido"]).cast("string"))
        ).alias("total"),
        e.raw_json().alias("raw_json"),
        *(_amounts(e) if amounts else []),
        *_arrival(entries),
    ).where(F.col("order_id").isNotNull() & (F.col("order_id") != 0))


def staged_order_rows(pages: DataFrame) -> DataFrame:
    """Headers of OK pages as staged for the fact table; the date stays text."""
    entries, e = _entries(pages, "pedidos", "pedido")
    return entries.select(
        e["id"].try_cast("bigint").alias("order_id"),
        C.first_filled(e["numero"]).alias("order_number"),
        C.first_filled(e["data_pedido"], e["data_criacao"]).alias("order_date_text"),
        C.first_filled(e["situacao"]).alias("status"),
        C.first_filled(e["nome"], e["cliente"]).alias("customer_name"),
        C.first_filled(e["vendedor"]).alias("seller"),
        C.first_nonzero(e["valor"], e["total_pedido"]).alias("total"),
        e.raw_json().alias("raw_json"),
        *_arrival(entries),
    ).where(F.col("order_id").isNotNull() & (F.col("order_id") != 0))


def staged_item_rows(details: DataFrame) -> DataFrame:
    """Lines of OK details as staged for the fact table; missing numbers are 0."""
    lines = order_item_rows(details)
    zero = C.zero_if_null
    return lines.select(
        "order_id",
        "item_seq",
        F.lit(None).cast("string").alias("order_number"),
        F.col("sku").alias("code"),
        F.col("product_name").alias("description"),
        zero(F.col("qty")).alias("qty"),
        zero(F.col("price")).alias("unit_price"),
        zero(F.col("total")).alias("total"),
        "raw_json",
    )


def _amounts(e: _Entry) -> list[Column]:
    return [
        C.parse_source_date(
            C.first_filled(e["data_pedido"], e["data_emissao"], e["data"])
        ).alias("ordered_at"),
        *[
            C.number_or_null(e[source]).alias(name)
            for source, name in [
                ("valor_produtos", "products_amount"),
                ("valor_desconto", "discount_amount"),
                ("valor_frete", "freight_amount"),
                ("valor_total", "total_amount"),
            ]
        ],
    ]


def order_amounts(pages: DataFrame) -> DataFrame:
    """The wider header form: instant of the order and its four amounts."""
    entries, e = _entries(pages, "pedidos", "pedido")
    return entries.select(
        e["id"].try_cast("bigint").alias("order_id"),
        *_amounts(e),
        *_arrival(entries),
    ).where(F.col("order_id").isNotNull())


def detail_keys(details: DataFrame) -> Column:
    return F.coalesce(
        C.first_filled(F.col("retorno.pedido.id")), C.first_filled(F.col("id"))
    ).try_cast("bigint")


def latest_details(details: DataFrame) -> DataFrame:
    """Of each order the OK reply that came last, whole; the lines of two replies never mix."""
    return accepted_details(settled_details(details))[1]


def settled_details(details: DataFrame) -> DataFrame:
    """What all replies come to, one row an order and in one pass: ``_last``, the OK reply that
    came last (null without one), ``reason``, the greatest of the failed ones, and how many
    ``replies`` there were. Those that name no order share a row without ``order_id``."""
    keyed = with_arrival(details).withColumn("_key", detail_keys(details))
    ok = F.col("retorno.status") == OK
    # A reply's place among the OK ones; max_by leaves out null places.
    return keyed.groupBy(F.col("_key").alias("order_id")).agg(
        F.max_by(F.struct("id", "retorno"), F.when(ok, F.col(ARRIVED))).alias("_last"),
        F.max(F.when(~F.coalesce(ok, F.lit(False)), _reason())).alias("reason"),
        F.count(F.lit(1)).alias("replies"),
    )


def settled_stored(details: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """``settled_details`` of stored replies, which seldom name an order twice; stored as well.

    Orders are counted first, and only the replies of repeated ones (and those that name none)
    are compared; the others are neither shuffled nor written again. Where more than ``most``
    orders repeat, all replies are compared.
    """
    keyed = details.select("*", detail_keys(details).alias("_key"))
    repeated = keyed.groupBy("_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or _key is null")
    repeated = materialized(repeated.select(F.col("_key").alias("_again")))
    several = repeated.count()
    if several > most:
        return materialized(settled_details(details))
    ok = F.coalesce(F.col("retorno.status") == OK, F.lit(False))

    def alone(rows: DataFrame) -> DataFrame:
        reply, reason = F.when(ok, F.struct("id", "retorno")).alias("_last"), F.when(~ok, _reason()).alias("reason")
        return rows.select(F.col("_key").alias("order_id"), reply, reason, F.lit(1).cast("bigint").alias("replies"))

    if not several:
        return alone(keyed)
    again = F.broadcast(repeated), F.col("_key").eqNullSafe(F.col("_again"))
    compared = settled_details(keyed.join(*again, "left_semi").drop("_key"))
    return materialized(alone(keyed.join(*again, "left_anti")).unionByName(compared))


def _known() -> Column:
    return F.col("order_id").isNotNull()


def accepted_details(settled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The orders with an OK reply, and their replies, of stored ``settled_details``."""
    ok = settled.where(_known() & F.col("_last").isNotNull())
    return ok.select("order_id"), ok.select("_last.*")


def failed_details(settled: DataFrame) -> DataFrame:
    """order_id, reason of the orders without an OK reply, of stored ``settled_details``."""
    return settled.where(_known() & F.col("_last").isNull()).select("order_id", "reason")


def replaced_orders(details: DataFrame) -> DataFrame:
    """Orders whose detail came back OK; only their stored lines may be replaced."""
    ok, _ = split_ok_rejects(details)
    return ok.select(detail_keys(ok).alias("order_id")).where("order_id is not null").distinct()


def order_item_rows(details: DataFrame) -> DataFrame:
    """Lines of OK details, numbered from 1. The list is at ``pedido.itens`` or ``itens``."""
    ok, _ = split_ok_rejects(details)
    nested, direct = F.col("retorno.pedido.itens"), F.col("retorno.itens")
    lines = ok.select(
        detail_keys(ok).alias("order_id"), F.posexplode(F.coalesce(nested, direct)).alias("pos", "w")
    )
    e = _Entry(lines, "item")
    return lines.select(
        "order_id",
        (F.col("pos") + 1).cast("int").alias("item_seq"),
        C.first_filled(e["id_produto"], e["id"]).alias("product_id"),
        C.first_filled(e["codigo"], e["sku"]).alias("sku"),
        C.first_filled(e["descricao"], e["nome"]).alias("product_name"),
        C.number_or_null(e["quantidade"]).alias("qty"),
        F.coalesce(
            C.number_or_null(e["valor_unitario"]), C.number_or_null(e["valor"])
        ).alias("price"),
        C.number_or_null(e["valor_total"]).alias("total"),
        e.raw_json().alias("raw_json"),
    ).where("order_id is not null")


def product_rows(pages: DataFrame) -> DataFrame:
    """Staged products of OK pages."""
    entries, e = _entries(pages, "produtos", "produto")
    return entries.select(
        e["id"].try_cast("bigint").alias("id"),
        C.first_filled(e["codigo"]).alias("code"),
        C.first_filled(e["nome"], e["descricao"]).alias("name"),
        C.first_filled(e["gtin"]).alias("gtin"),
        C.first_filled(e["unidade"]).alias("unit"),
        C.number_or_null(e["preco"]).alias("price"),
        C.number_or_null(e["preco_promocional"]).alias("promo_price"),
        C.first_filled(e["situacao"]).alias("status"),
        C.first_filled(e["localizacao"]).alias("location"),
        C.parse_source_datetime(e["data_criacao"]).alias("created_at"),
        C.product_tags(e["tags_produto"], e["tags"]).alias("tags"),
        e.raw_json().alias("raw_json"),
        *_arrival(entries),
    ).where("id is not null")


def catalogue_rows(pages: DataFrame) -> DataFrame:
    """Products of OK pages in the catalogue form, with cost and variation type."""
    entries, e = _entries(pages, "produtos", "produto")
    return entries.select(
        e["id"].try_cast("bigint").alias("id"),
        e["codigo"].alias("sku"),
        F.coalesce(e["nome"], e["descricao"]).alias("product_name"),
        C.number_or_null(e["preco"]).alias("price"),
        C.number_or_null(e["preco_promocional"]).alias("promo_price"),
        C.number_or_null(e["preco_custo"]).alias("cost_price"),
        C.number_or_null(e["preco_custo_medio"]).alias("avg_cost"),
        e["unidade"].alias("unit"),
        e["gtin"].alias("gtin"),
        e["tipoVariacao"].alias("variation_type"),
        e["localizacao"].alias("location"),
        e["situacao"].alias("status"),
        C.parse_source_datetime(e["data_criacao"]).alias("created_at"),
        e.raw_json().alias("raw_json"),
        *_arrival(entries),
    ).where("id is not null")


def product_categories(details: DataFrame) -> DataFrame:
    """Tag of each product from the leaf of its category; no category gives ``''``."""
    ok, _ = split_ok_rejects(details)
    product = F.col("retorno.produto")
    return ok.where(product.isNotNull()).select(
        F.coalesce(C.first_filled(product["id"]), C.first_filled(F.col("id"))).try_cast("bigint").alias("id_src"),
        F.coalesce(C.category_leaf(product["categoria"]), F.lit("")).alias("tag"),
    )


def read_order_pages(spark: SparkSession, path: str) -> DataFrame:
    """Order headers from landed search pages; a bad page stops the load."""
    return order_rows(require_ok(read_pages(spark, path, schemas.ORDER_PAGE)))


def read_order_details(spark: SparkSession, path: str) -> DataFrame:
    """Order lines from landed details; bad details contribute no lines."""
    return order_item_rows(read_pages(spark, path, schemas.ORDER_DETAIL))


def read_product_pages(spark: SparkSession, path: str) -> DataFrame:
    """Staged products from landed search pages; a bad page stops the load."""
    return product_rows(require_ok(read_pages(spark, path, schemas.PRODUCT_PAGE)))
