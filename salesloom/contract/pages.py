"""Landed JSON replies derived from the given tables, row by row.

One reply per row keeps the derivation free of shuffles and of groups without a
bound. Field names vary by key, so all fallbacks of the readers are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom import schemas


def _pick(key: Column, position: int, of: int, value: Column) -> Column:
    return F.when(key % of == position, value)


def _parsed(text: Column, rows: DataFrame, schema: str) -> DataFrame:
    """Reply texts read with the schema of the file readers.

    The generator keeps the parsed reply as one value; without it the optimizer
    would parse the text again for every field taken from it.
    """
    return rows.select(F.explode(F.array(F.from_json(text, schema))).alias("r")).select("r.*")


def _wrapped_or_bare(body: dict[str, Column], wrapper: str, wrapped: Column) -> Column:
    inner = F.when(wrapped, F.struct(*[value.alias(name) for name, value in body.items()]))
    bare = [F.when(~wrapped, value).alias(name) for name, value in body.items()]
    return F.struct(inner.alias(wrapper), *bare)


def order_pages(orders: DataFrame) -> DataFrame:
    return _parsed(page_texts(orders), orders, schemas.ORDER_PAGE)


def page_texts(orders: DataFrame) -> Column:
    key = F.col("order_id")
    text = F.date_format("order_date", "dd/MM/yyyy")
    dirty = (
        F.when(key % 73 == 0, F.date_format("order_date", "yyyy-MM-dd"))
        .when(key % 79 == 0, "31/02/2001")
        .when(key % 7 == 0, F.concat(text, F.lit(" 10:24:18")))
        .otherwise(text)
    )
    amount = F.col("total").cast("string")
    body = {
        "id": key.cast("string"),
        "numero": F.when(key % 5 != 0, F.col("order_number")).otherwise(""),
        "data_pedido": _pick(key, 0, 4, dirty),
        "data_emissao": _pick(key, 1, 4, dirty),
        "data": _pick(key, 2, 4, dirty),
        "data_criacao": _pick(key, 3, 4, dirty),
        "nome": _pick(key, 0, 3, F.col("customer_name")),
        "cliente": _pick(key, 1, 3, F.col("customer_name")),
        "cliente_nome": _pick(key, 2, 3, F.col("customer_name")),
        "id_cliente": _pick(key, 0, 2, F.col("customer_id")),
        "cliente_id": _pick(key, 1, 2, F.col("customer_id")),
        "canal_venda": _pick(key, 0, 2, F.col("channel")),
        "origem": _pick(key, 1, 2, F.col("channel")),
        "situacao": F.when(key % 3 != 0, F.col("status")).otherwise(""),
        "status": F.col("status"),
        "valor_produtos": F.when(key % 5 != 0, amount),
        "valor_desconto": F.when(key % 6 == 0, "1.5").otherwise(""),
        "valor_frete": F.when(key % 4 == 0, "n/d").otherwise("12.25"),
        "valor_total": _pick(key, 0, 3, amount),
        "valor": _pick(key, 1, 3, amount),
        "total_pedido": F.when(key % 3 != 0, amount),
    }
    bad = key % 83 == 0
    page = F.struct(
        F.when(bad, "Erro").otherwise("OK").alias("status"),
        F.lit("1").alias("numero_paginas"),
        F.when(bad, "limite de acessos").alias("erros"),
        F.when(~bad, F.array(_wrapped_or_bare(body, "pedido", key % 2 == 0))).alias("pedidos"),
    )
    return F.to_json(F.struct(page.alias("retorno")))


def order_details(items: DataFrame) -> DataFrame:
    """Details with one to three lines: the line itself wrapped, and up to twice bare under
    other names."""
    return _parsed(detail_texts(items), items, schemas.ORDER_DETAIL)


def detail_texts(items: DataFrame) -> Column:
    key = F.col("order_id")
    qty, price, total = (F.col(c).cast("string") for c in ("qty", "price", "total"))
    line = {
        "id_produto": F.col("product_id"), "codigo": F.col("sku"), "descricao": F.col("product_name"),
        "quantidade": qty, "valor_unitario": price, "valor_total": total,
    }
    other = {
        "id": F.col("product_id"), "sku": F.col("sku"), "nome": F.col("product_name"),
        "quantidade": F.when(key % 13 == 0, "").otherwise(qty), "valor": price,
        "valor_total": F.when(key % 17 == 0, "n/d").otherwise(total),
    }
    fields = {**line, **other}
    first = F.struct(
        F.struct(*[v.alias(n) for n, v in line.items()]).alias("item"),
        *[F.lit(None).cast("string").alias(n) for n in fields],
    )
    second = F.struct(
        F.lit(None).cast(f"struct<{','.join(f'{n}:string' for n in line)}>").alias("item"),
        *[other.get(n, F.lit(None).cast("string")).alias(n) for n in fields],
    )
    lines = F.slice(F.array(first, second, second), 1, (key % 3 + 1).cast("int"))
    bad = key % 89 == 0
    reply = F.struct(
        F.when(bad, "Erro").otherwise("OK").alias("status"),
        F.when(~bad & (key % 5 != 0), F.struct(key.cast("string").alias("id"), lines.alias("itens"))).alias("pedido"),
        F.when(~bad & (key % 5 == 0), lines).alias("itens"),
    )
    return F.to_json(F.struct(key.cast("string").alias("id"), reply.alias("retorno")))


def line_order(items: DataFrame) -> Column:
    """Text by which the line of an order that counts as its last is told; equal lines are equal."""
    rest = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("product_id", "sku", "product_name", "qty", "price", "total")]
    return F.concat_ws("|", F.lpad(F.col("item_seq").cast("string"), 9, "0"), *rest)


def arriving_details(items: DataFrame) -> DataFrame:
    """Details that arrive in the order of their lines, so that an order's last line is known."""
    rows = items.select("*", line_order(items).alias("file"))
    text = detail_texts(rows)
    arrived = F.struct(F.lit(None).cast("timestamp").alias("time"), "file", F.lit(0).cast("bigint").alias("split"))
    read = F.explode(F.array(F.from_json(text, schemas.ORDER_DETAIL)))  # parsed once, see _parsed
    return rows.select(read.alias("r"), arrived.alias("arrived")).select("r.*", "arrived")


def last_lines(items: DataFrame) -> DataFrame:
    """One line of each order, its last."""
    return items.groupBy("order_id").agg(F.max_by(F.struct(*items.columns), line_order(items)).alias("r")).select("r.*")


def product_pages(products: DataFrame) -> DataFrame:
    """Product pages whose tags come in each of the four shapes."""
    return _parsed(product_texts(products), products, schemas.PRODUCT_PAGE)


def product_texts(products: DataFrame) -> Column:
    key = F.abs("id")
    brand = F.trim(F.split("tags", ",")[0])
    kind = F.trim(F.split("tags", ",")[1])
    described = F.array(
        F.struct(brand.alias("descricao"), F.lit(None).cast("string").alias("nome"), F.lit("1").alias("idTag")),
        F.struct(F.lit("").alias("descricao"), kind.alias("nome"), F.lit("2").alias("idTag")),
        F.struct(F.lit("").alias("descricao"), F.lit("").alias("nome"), F.lit("3").alias("idTag")),
    )
    has = F.col("tags").isNotNull()
    created = (
        F.when(key % 9 == 1, F.lit("31/02/2000 99:00:00"))
        .when(key % 5 == 0, F.date_format("created_at", "dd/MM/yyyy"))
        .otherwise(F.date_format("created_at", "dd/MM/yyyy HH:mm:ss"))
    )
    body = [
        F.col("id").cast("string").alias("id"),
        F.col("sku").alias("codigo"),
        F.when(key % 2 == 0, F.col("product_name")).alias("nome"),
        F.col("product_name").alias("descricao"),
        F.col("gtin"), F.col("unit").alias("unidade"), F.col("status").alias("situacao"),
        F.col("location").alias("localizacao"),
        F.when(key % 11 == 0, "abc").otherwise(F.col("price").cast("string")).alias("preco"),
        F.coalesce(F.col("promo_price").cast("string"), F.lit("")).alias("preco_promocional"),
        created.alias("data_criacao"),
        F.when(has & (key % 4 == 0), described).alias("tags_produto"),
    ]
    objects = F.transform(
        described,
        lambda t: F.struct(t["descricao"].alias("descricao"), t["nome"].alias("nome"), t["idTag"].alias("id")),
    )
    shapes = [
        F.struct(*body, F.when(has, F.array(brand, F.lit(""), kind)).alias("tags")),
        F.struct(*body, F.when(has, objects).alias("tags")),
        F.struct(*body, F.col("tags")),
    ]

    def page(product: Column) -> Column:
        entry = F.array(F.struct(product.alias("produto")))
        return F.to_json(F.struct(F.struct(F.lit("OK").alias("status"), entry.alias("produtos")).alias("retorno")))

    return F.when(key % 4 == 1, page(shapes[0])).when(key % 4 == 2, page(shapes[1])).otherwise(page(shapes[2]))


def product_details(products: DataFrame) -> DataFrame:
    """Product details with a category path; some have none, some blank parts."""
    key = F.abs("id")
    path = F.concat(F.lit("Casa >> "), F.col("product_name"), F.lit(" >> "), F.col("location"))
    category = (
        F.when(key % 6 == 0, F.lit(None)).when(key % 6 == 1, F.concat(path, F.lit(" >>  >> "))).when(key % 6 == 2, " >> ")
        .otherwise(path)
    )
    product = F.struct(F.col("id").cast("string").alias("id"), category.alias("categoria"))
    reply = F.struct(F.when(key % 31 == 0, "Erro").otherwise("OK").alias("status"), product.alias("produto"))
    text = F.to_json(F.struct(F.col("id").cast("string").alias("id"), reply.alias("retorno")))
    return _parsed(text, products, schemas.PRODUCT_DETAIL)
