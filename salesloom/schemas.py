"""Explicit schemas of the warehouse tables and of the landed JSON pages, as DDL text."""

from __future__ import annotations

# Schemas are DDL text, as ``DataFrameReader.schema`` and ``from_json`` take it.
MONEY = "decimal(18,4)"

ORDERS = (
    "order_id bigint, external_id string, order_number string, order_date date, channel string, "
    "customer_id string, customer_name string, status string, total decimal(18,4), raw_json string"
)
ORDER_ITEMS = (
    "order_id bigint, item_seq int, product_id string, sku string, product_name string, "
    "qty decimal(18,4), price decimal(18,4), total decimal(18,4), raw_json string"
)
ORDER_AMOUNTS = (
    "order_id bigint, ordered_at timestamp, products_amount decimal(18,4), discount_amount decimal(18,4), "
    "freight_amount decimal(18,4), total_amount decimal(18,4)"
)
PRODUCTS = (
    "id bigint, sku string, product_name string, price decimal(18,4), promo_price decimal(18,4), "
    "cost_price decimal(18,4), avg_cost decimal(18,4), unit string, gtin string, variation_type string, "
    "location string, status string, created_at timestamp_ntz, raw_json string"
)
STG_PRODUCTS = (
    "id bigint, code string, name string, gtin string, unit string, price decimal(18,4), "
    "promo_price decimal(18,4), status string, location string, created_at timestamp_ntz, "
    "tags string, raw_json string"
)
STG_ORDERS = (
    "order_id bigint, order_number string, order_date_text string, status string, customer_name string, "
    "seller string, total decimal(18,4), raw_json string"
)
STG_ORDER_ITEMS = (
    "order_id bigint, item_seq int, order_number string, code string, description string, "
    "qty decimal(18,4), unit_price decimal(18,4), total decimal(18,4), raw_json string"
)
DIM_PRODUCT = (
    "product_key bigint, code string, id_src bigint, name string, gtin string, unit string, status string, "
    "location string, price decimal(18,4), promo_price decimal(18,4), created_at timestamp_ntz, "
    "updated_at timestamp, tags string"
)
DIM_DATE = (
    "date_key int, date_value date, year int, month int, day int, month_name string, dow int, "
    "dow_name string, is_weekend boolean"
)
F_SALES = (
    "date_key int, order_id bigint, item_seq int, order_number string, product_key bigint, code string, "
    "description string, qty decimal(18,4), unit_price decimal(18,4), total decimal(18,4), order_status string"
)
REJECTED_DETAILS = "order_id bigint, reason string"
REJECTED_PAGES = "file string, reason string, page string"
LOAD_BATCHES = "stream string, number bigint, pages bigint, rejected bigint, rows bigint, parts string"
ORDER_MONTHS = "order_id bigint, month string"
PRODUCT_KEYS = "code string, product_key bigint"
PRODUCT_NAMES = "name string, number bigint"
STATE_DAYS = (
    "day date, orders bigint, order_total decimal(28,4), qty decimal(28,4), items decimal(28,4), line_revenue decimal(38,4)"
)
STATE_CHANNELS = "day date, channel string, orders bigint, order_total decimal(28,4), line_revenue decimal(38,4)"
STATE_PRODUCTS = (
    "day date, sku string, product_name string, qty decimal(28,4), items decimal(28,4), total decimal(28,4), line_revenue decimal(38,4)"
)
STATE_SALES = "day date, units decimal(28,4), revenue decimal(38,4)"
STATE_NAMES = "day date, bucket bigint, names binary"

# Landed pages. Every scalar may arrive as text or number, so all are read as
# text and typed by the cleansing functions.
_ORDER_FIELDS = (
    "id string, numero string, data_pedido string, data_emissao string, data string, data_criacao string, "
    "dataEmissao string, nome string, cliente string, cliente_nome string, id_cliente string, "
    "cliente_id string, canal_venda string, origem string, situacao string, status string, "
    "vendedor string, valor_produtos string, valor_desconto string, valor_frete string, "
    "valor_total string, valor string, total_pedido string"
)
_LINE_FIELDS = (
    "id_produto string, id string, codigo string, sku string, descricao string, nome string, "
    "quantidade string, valor_unitario string, valor string, valor_total string"
)
_PRODUCT_FIELDS = (
    "id string, codigo string, nome string, descricao string, gtin string, unidade string, situacao string, "
    "localizacao string, preco string, preco_promocional string, preco_custo string, "
    "preco_custo_medio string, tipoVariacao string, data_criacao string, "
    "tags_produto array<struct<idTag:string,id:string,descricao:string,nome:string>>, tags string, "
    "categoria string"
)


def _fields_as(fields: str) -> str:
    parts = [part.strip().split(" ", 1) for part in fields.split(", ")]
    return ",".join(f"{name}:{kind}" for name, kind in parts)


def _page(entry: str, fields: str, wrapper: str, extra: str = "") -> str:
    body = _fields_as(fields)
    return (
        f"retorno struct<status:string,numero_paginas:string,{extra}erros:string,"
        f"{entry}:array<struct<{wrapper}:struct<{body}>,{body}>>>"
    )


ORDER_PAGE = _page("pedidos", _ORDER_FIELDS, "pedido", "numeroPaginas:string,")
PRODUCT_PAGE = _page("produtos", _PRODUCT_FIELDS, "produto", "numero_paginas_total:string,mensagens:string,")
_LINES = f"itens:array<struct<item:struct<{_fields_as(_LINE_FIELDS)}>,{_fields_as(_LINE_FIELDS)}>>"
# A landed detail keeps the id it was asked for beside the reply.
ORDER_DETAIL = (
    f"id string, numero string, retorno struct<status:string,erros:string,"
    f"pedido:struct<id:string,numero:string,{_LINES}>,{_LINES}>"
)
PRODUCT_DETAIL = (
    f"id string, retorno struct<status:string,erros:string,produto:struct<{_fields_as(_PRODUCT_FIELDS)}>>"
)
