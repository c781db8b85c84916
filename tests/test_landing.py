"""Landed JSON files: shapes, fallbacks, failures, incremental load."""

import json
from datetime import date, datetime
from decimal import Decimal

import pytest

from salesloom.sources import landing
from salesloom.sources.warehouse import Warehouse
from salesloom.streaming.ingest import (
    apply_order_details, apply_order_pages, fill_product_tags, load_fact_window, ingest_increment, ingest_products, load_increment_batch, not_yet_loaded, stored_high_mark,
)
from salesloom import schemas
from tests.conftest import rows_of


def land(folder, name, *replies):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(r) for r in replies) + "\n")
    return str(folder)


def page(*orders, status="OK", **extra):
    return {"retorno": {"status": status, "numero_paginas": 1, "pedidos": list(orders), **extra}}


def detail(order_id, *lines, status="OK", direct=False):
    body = {"itens": list(lines)} if direct else {"pedido": {"id": order_id, "itens": list(lines)}}
    return {"id": str(order_id), "retorno": {"status": status, **body}}


def test_order_fallbacks(spark, tmp_path):
    path = land(
        tmp_path, "p.json",
        page(
            {"pedido": {"id": 1, "numero": "10", "data_pedido": "05/03/2024", "nome": "Ana", "canal_venda": "loja",
                        "situacao": "Aprovado", "valor_total": 10.5, "valor": 99}},
            {"id": "2", "data_emissao": "06/03/2024", "data_pedido": "", "cliente": "Bia", "origem": "site",
             "status": "Aberto", "valor": "0", "total_pedido": "7"},
        ),
        page({"pedido": {"numero": "no id"}}, {"pedido": {"id": "3", "data": "2024-03-07", "valor_total": "abc"}}),
    )
    got = {r.order_id: r for r in landing.read_order_pages(spark, path).collect()}
    assert set(got) == {1, 2, 3}
    assert (got[1].order_date, got[1].customer_name, got[1].channel, got[1].total) == (date(2024, 3, 5), "Ana", "loja", Decimal("10.5"))
    assert (got[2].order_date, got[2].customer_name, got[2].channel, got[2].status) == (date(2024, 3, 6), "Bia", "site", "Aberto")
    assert got[2].total == 7 and got[2].order_number is None
    assert got[3].order_date is None and got[3].total is None
    assert json.loads(got[1].raw_json)["valor"] == "99"


def test_line_shapes(spark, tmp_path):
    path = land(
        tmp_path, "d.json",
        detail(1, {"item": {"id_produto": "7", "codigo": "A", "descricao": "a", "quantidade": "2", "valor_unitario": "3.5"}},
               {"item": {"id": 8, "sku": "B", "nome": "b", "quantidade": "", "valor": 4, "valor_total": 0}}),
        detail(2, {"codigo": "", "descricao": "bare", "quantidade": 1}, direct=True),
        detail(3, {"item": {"codigo": "X"}}, status="Erro"),
        detail(4),
    )
    rows = rows_of(landing.read_order_details(spark, path), "order_id", "item_seq", "product_id", "sku", "product_name", "qty", "price", "total")
    assert sorted(rows) == [
        (1, 1, "7", "A", "a", 2.0, 3.5, None),
        (1, 2, "8", "B", "b", None, 4.0, 0.0),
        (2, 1, None, None, "bare", 1.0, None, None),
    ]
    details = landing.read_pages(spark, path, schemas.ORDER_DETAIL)
    assert sorted(rows_of(landing.replaced_orders(details))) == [(1,), (2,), (4,)]


def test_replies_are_settled_in_one_pass(spark, tmp_path):
    path = land(
        tmp_path, "d.json", detail(1, {"item": {"codigo": "A"}}), detail(1, {"item": {"codigo": "B"}}), detail(1, status="Erro"),
        detail(2, status="Erro"), detail(2, status="Zero"), detail(None, {"item": {"codigo": "C"}}), detail(4),
    )
    settled = landing.settled_details(landing.read_arrived_pages(spark, path, schemas.ORDER_DETAIL))
    ids, latest = landing.accepted_details(settled)
    assert sorted(rows_of(ids)) == [(1,), (4,)]
    assert rows_of(landing.order_item_rows(latest), "order_id", "sku") == [(1, "B")]
    assert rows_of(landing.failed_details(settled)) == [(2, "Zero")]
    assert sum(r.replies for r in settled.collect()) == 7


def test_arriving_details_are_parsed_once(spark):
    from salesloom.contract import pages
    from salesloom.contract.tables import Shop
    from tests.conftest import SMALL
    from tests.test_plans import plan_of

    for made in (landing.replaced_orders, landing.settled_details):
        assert plan_of(made(pages.arriving_details(Shop(spark, SMALL).order_items))).count("from_json") <= 2


def test_bad_page_stops_the_load(spark, tmp_path):
    path = land(tmp_path, "p.json", page({"pedido": {"id": 1}}), page(status="Erro", erros=[{"erro": "limite"}]))
    with pytest.raises(landing.RejectedPages, match="limite"):
        landing.read_order_pages(spark, path)
    _, rejects = landing.split_ok_rejects(landing.read_pages(spark, path, schemas.ORDER_PAGE))
    assert rejects.count() == 1


def test_product_pages(spark, tmp_path):
    products = [
        {"produto": {"id": 1, "codigo": "A", "nome": "a", "preco": "9.9", "situacao": "A",
                     "data_criacao": "31/10/2023 10:24:18", "tags": ["x", "y"]}},
        {"produto": {"id": 2, "codigo": "", "descricao": "b", "preco": "", "tags_produto": [{"descricao": "t"}]}},
    ]
    path = land(tmp_path, "p.json", {"retorno": {"status": "OK", "produtos": products}})
    rows = rows_of(landing.read_product_pages(spark, path), "id", "code", "name", "price", "created_at", "tags")
    assert sorted(rows) == [
        (1, "A", "a", 9.9, datetime(2023, 10, 31, 10, 24, 18), "x,y"), (2, None, "b", None, None, "t"),
    ]
    pages = landing.read_pages(spark, path, schemas.PRODUCT_PAGE)
    assert rows_of(landing.catalogue_rows(pages).orderBy("id"), "id", "sku", "product_name") == [(1, "A", "a"), (2, "", "b")]


def orders_of(warehouse):
    return sorted(rows_of(warehouse.load("orders"), "order_id", "status", "total"))


def lines_of(warehouse):
    return sorted(rows_of(warehouse.load("order_items"), "order_id", "item_seq", "sku", "month"))


def order(order_id, day, status="novo", total="1"):
    return {"pedido": {"id": order_id, "data_pedido": day, "situacao": status, "valor_total": total}}


def line(sku):
    return {"item": {"codigo": sku, "quantidade": "1", "valor_unitario": "1"}}


def test_streamed_increments(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    pages, details = tmp_path / "pages", tmp_path / "details"
    land(pages, "1.json", page(order(1, "05/03/2024"), order(2, "06/03/2024")))
    land(details, "1.json", detail(1, line("A"), line("B")), detail(2, line("C")))
    ingest_increment(spark, warehouse, str(pages), str(details))
    assert orders_of(warehouse) == [(1, "novo", 1.0), (2, "novo", 1.0)]
    assert lines_of(warehouse) == [(1, 1, "A", "2024-03"), (1, 2, "B", "2024-03"), (2, 1, "C", "2024-03")]

    # The same page lands again, order 2 changes, 3 comes late; the detail of 1
    # fails (its lines stay), the one of 2 is empty (its lines go); the detail of
    # 9 comes before its header.
    land(pages, "2.json", page(order(1, "05/03/2024"), order(2, "06/03/2024")))
    land(pages, "3.json", page(order(2, "06/04/2024", "pago", "2"), order(3, "06/03/2024")))
    land(details, "2.json", detail(1, status="Erro"), detail(2), detail(3, line("D")), detail(9, line("E")))
    ingest_increment(spark, warehouse, str(pages), str(details))
    assert orders_of(warehouse) == [(1, "novo", 1.0), (2, "pago", 2.0), (3, "novo", 1.0)]
    assert lines_of(warehouse) == [
        (1, 1, "A", "2024-03"), (1, 2, "B", "2024-03"), (3, 1, "D", "2024-03"), (9, 1, "E", "none"),
    ]

    assert rows_of(warehouse.load("rejected_details"), "order_id", "reason") == [(1, "Erro")]

    # Nothing new: nothing changes. Then the header of 9 arrives and its line
    # moves to the header's month; order 3 moves month and takes its line along.
    ingest_increment(spark, warehouse, str(pages), str(details))
    land(pages, "4.json", page(order(9, "01/05/2024"), order(3, "02/06/2024")))
    land(details, "4.json", detail(1, line("A"), line("B")))
    ingest_increment(spark, warehouse, str(pages), str(details))
    assert rows_of(warehouse.load("rejected_details"), "order_id", "reason") == []
    assert lines_of(warehouse) == [
        (1, 1, "A", "2024-03"), (1, 2, "B", "2024-03"), (3, 1, "D", "2024-06"), (9, 1, "E", "2024-05"),
    ]
    months = {r.order_id: r.month for r in warehouse.load("orders").collect()}
    assert months == {1: "2024-03", 2: "2024-04", 3: "2024-06", 9: "2024-05"}


def test_batch_twin_reads_the_last_day_again(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    assert stored_high_mark(warehouse.load("orders")) is None
    assert str(stored_high_mark(warehouse.load("orders"), "2020-01-01")) == "2020-01-01"

    def read(*orders):
        return spark.read.schema(schemas.ORDER_PAGE).json(land(tmp_path / f"p{len(orders)}", "p.json", page(*orders)))

    load_increment_batch(warehouse, read(order(1, "05/03/2024"), order(2, "31/12/2019")), floor="2020-01-01")
    assert [r[0] for r in orders_of(warehouse)] == [1]
    later = read(order(1, "05/03/2024", "pago"), order(3, "05/03/2024"), order(4, "04/03/2024"))
    assert load_increment_batch(warehouse, later) == ["2024-03"]
    assert orders_of(warehouse) == [(1, "pago", 1.0), (3, "novo", 1.0)]
    assert not_yet_loaded(landing.order_rows(later), warehouse.load("orders")).count() == 2


def test_product_load_builds_the_dimension(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))

    def products(*entries):
        return {"retorno": {"status": "OK", "produtos": [{"produto": e} for e in entries]}}

    land(tmp_path / "pp", "1.json", products(
        {"id": 1, "codigo": "A", "nome": "undated"}, {"id": 2, "codigo": "A", "nome": "dated", "data_criacao": "01/01/2020"},
        {"id": 3, "nome": "no code"}))
    ingest_products(spark, warehouse, str(tmp_path / "pp"))
    assert rows_of(warehouse.load("dim_product"), "code", "id_src", "name") == [("A", 2, "dated")]
    land(tmp_path / "pp", "2.json", products({"id": 2, "codigo": "A", "nome": "renamed", "data_criacao": "01/01/2020"},
                                              {"id": 5, "codigo": "B", "nome": "b"}))
    ingest_products(spark, warehouse, str(tmp_path / "pp"))
    assert sorted(rows_of(warehouse.load("dim_product"), "code", "id_src", "name")) == [("A", 2, "renamed"), ("B", 5, "b")]
    assert warehouse.load("stg_products").count() == 4
    assert sorted(rows_of(warehouse.load("products"), "id", "product_name"))[1] == (2, "renamed")


def test_facts_from_pages(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    land(tmp_path / "pp", "1.json", {"retorno": {"status": "OK", "produtos": [{"produto": {"id": 1, "codigo": "A", "nome": "a"}}]}})
    ingest_products(spark, warehouse, str(tmp_path / "pp"))
    pages = spark.read.schema(schemas.ORDER_PAGE).json(land(tmp_path / "p", "p.json", page(order(1, "05/03/2024"), order(2, "01/01/2024"))))
    details = spark.read.schema(schemas.ORDER_DETAIL).json(
        land(tmp_path / "d", "d.json", detail(1, line("A"), line("Z")), detail(2, line("A")), detail(7, status="Erro")))

    def facts():
        rows = warehouse.load("f_sales").selectExpr("order_id", "item_seq", "date_key", "code", "product_key is not null", "total")
        return sorted(rows_of(rows))

    assert load_fact_window(warehouse, pages, details, "2024-03-10") == ["2024-02", "2024-03"]
    assert facts() == [(1, 1, 20240305, "A", True, 0.0), (1, 2, 20240305, "Z", False, 0.0)]
    load_fact_window(warehouse, pages, details, "2024-03-10")
    assert len(facts()) == 2 and warehouse.load("stg_order_items").count() == 3


def test_tags_from_landed_details(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    entries = [{"produto": {"id": n, "codigo": f"S{n}", "nome": "n", "situacao": "A"}} for n in (1, 2, 3)]
    land(tmp_path / "pp", "1.json", {"retorno": {"status": "OK", "produtos": entries}})
    ingest_products(spark, warehouse, str(tmp_path / "pp"))
    replies = [
        {"id": "1", "retorno": {"status": "OK", "produto": {"id": 1, "categoria": "A >> B >> "}}},
        {"id": "2", "retorno": {"status": "OK", "produto": {"id": 2}}},
        {"id": "3", "retorno": {"status": "Erro"}},
    ]
    details = spark.read.schema(schemas.PRODUCT_DETAIL).json(land(tmp_path / "pd", "1.json", *replies))
    fill_product_tags(warehouse, details)
    assert sorted(rows_of(warehouse.load("dim_product"), "code", "tags")) == [("S1", "B"), ("S2", ""), ("S3", None)]


def test_the_last_version_to_arrive_counts(spark, tmp_path):
    """Of an order, with another day and status; its old month is left."""
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    batch = page(order(1, "05/03/2024", "Em aberto"), order(1, "05/03/2024", "Cancelado")), page(order(2, "09/03/2024", "z")), page(order(2, "01/02/2024", "a"))
    apply_order_pages(warehouse, landing.read_arrived_pages(spark, land(tmp_path / "p", "1.json", *batch), schemas.ORDER_PAGE))
    assert orders_of(warehouse) == [(1, "Cancelado", 1.0), (2, "a", 1.0)]
    assert {r.order_id: r.month for r in warehouse.load("orders").collect()} == {1: "2024-03", 2: "2024-02"}


def test_lines_of_two_replies_never_mix(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    path = land(tmp_path / "d", "1.json", detail(1, line("A"), line("B"), line("C")), detail(1, line("N")))
    apply_order_details(warehouse, landing.read_arrived_pages(spark, path, schemas.ORDER_DETAIL))
    assert lines_of(warehouse) == [(1, 1, "N", "none")]


def test_bad_pages_are_kept_and_good_ones_loaded(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    pages, details = tmp_path / "pages", tmp_path / "details"
    land(pages, "1.json", page(status="Erro", erros=[{"erro": "limite"}]), page(order(1, "05/03/2024")))
    land(details, "1.json", detail(1, line("A")))
    ingest_increment(spark, warehouse, str(pages), str(details))
    land(pages, "2.json", page(order(2, "06/03/2024")))
    ingest_increment(spark, warehouse, str(pages), str(details))
    assert [r[0] for r in orders_of(warehouse)] == [1, 2]
    (reject,) = warehouse.load("rejected_pages").collect()
    assert reject.file.endswith("1.json") and "limite" in reject.reason
    bad = landing.read_arrived_pages(spark, str(pages), schemas.ORDER_PAGE)
    with pytest.raises(landing.RejectedPages):
        load_increment_batch(warehouse, bad, strict=True)


def test_undated_orders_are_loaded_and_future_days_raise_no_mark(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))

    def read(name, *orders):
        return landing.read_arrived_pages(spark, land(tmp_path / name, "p.json", page(*orders)), schemas.ORDER_PAGE)

    load_increment_batch(warehouse, read("a", order(1, "05/03/2024"), order(2, "05/03/2999"), order(3, "2024-03-05")), as_of="2024-03-10")
    load_increment_batch(warehouse, read("b", order(4, "06/03/2024"), order(5, "01/03/2024")), as_of="2024-03-10")
    assert [r[0] for r in orders_of(warehouse)] == [1, 2, 3, 4]


def test_filled_tags_survive_a_product_load(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    entries = [{"produto": {"id": n, "codigo": f"S{n}", "nome": "n", "situacao": "A"}} for n in (1, 2)]
    land(tmp_path / "pp", "1.json", {"retorno": {"status": "OK", "produtos": entries}})
    ingest_products(spark, warehouse, str(tmp_path / "pp"))
    reply = {"id": "2", "retorno": {"status": "OK", "produto": {"id": 2, "categoria": "A >> B"}}}
    fill_product_tags(warehouse, spark.read.schema(schemas.PRODUCT_DETAIL).json(land(tmp_path / "pd", "1.json", reply)))
    entries[1]["produto"]["nome"] = "renamed"
    land(tmp_path / "pp", "2.json", {"retorno": {"status": "OK", "produtos": entries}})
    ingest_products(spark, warehouse, str(tmp_path / "pp"))
    assert sorted(rows_of(warehouse.load("dim_product"), "code", "name", "tags")) == [("S1", "n", None), ("S2", "renamed", "B")]


def test_a_moved_order_leaves_no_facts_behind(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))

    def load(name, day, as_of):
        pages = landing.read_arrived_pages(spark, land(tmp_path / f"p{name}", "p.json", page(order(1, day), order(2, "05/01/2024"))), schemas.ORDER_PAGE)
        details = landing.read_arrived_pages(spark, land(tmp_path / f"d{name}", "d.json", detail(1, line("A")), detail(2, line("B"))), schemas.ORDER_DETAIL)
        return load_fact_window(warehouse, pages, details, as_of, 20)

    assert load(1, "06/01/2024", "2024-01-10") == ["2023-12", "2024-01"]
    assert load(2, "05/03/2024", "2024-03-10") == ["2024-02", "2024-03", "2024-01"]
    assert sorted(rows_of(warehouse.load("f_sales"), "order_id", "date_key")) == [(1, 20240305), (2, 20240105)]


def test_a_batch_that_spark_repeats_is_left_out(spark, tmp_path):
    """A job that dies after the switch and before Spark notes the batch as done meets it again."""
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    pages, details = tmp_path / "pages", tmp_path / "details"
    land(pages, "1.json", page(status="Erro", erros=[{"erro": "limite"}]), page(order(1, "05/03/2024")))
    land(details, "1.json", detail(1, line("A")))
    ingest_increment(spark, warehouse, str(pages), str(details))
    number, entries = warehouse.catalog.current()
    for stream in ("orders", "order_items"):
        for file in (tmp_path / "wh/_progress" / stream / "commits").glob("*0*"):
            file.unlink()
    ingest_increment(spark, warehouse, str(pages), str(details))
    assert warehouse.catalog.current() == (number, entries)
    land(pages, "2.json", page(order(2, "06/03/2024"), order(1, "05/03/2024")), page(status="Erro"))
    ingest_increment(spark, warehouse, str(pages), str(details))
    assert [r[0] for r in orders_of(warehouse)] == [1, 2]
    assert warehouse.load("rejected_pages").count() == 2
    batches = sorted(rows_of(warehouse.load("load_batches"), "stream", "number", "pages", "rejected", "rows", "parts"))
    assert batches == [("order_items", 0, 1, 0, 1, "2024-03"), ("orders", 0, 2, 1, 1, "2024-03"), ("orders", 1, 2, 1, 2, "2024-03")]


def test_a_batch_that_dies_is_loaded_by_the_next_run(spark, tmp_path, monkeypatch):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    land(tmp_path / "pages", "1.json", page(order(1, "05/03/2024")), page(status="Erro"))
    land(tmp_path / "details", "1.json", detail(1, line("A")))

    def die(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(warehouse.catalog, "switch", die)
        with pytest.raises(Exception, match="killed"):
            ingest_increment(spark, warehouse, str(tmp_path / "pages"), str(tmp_path / "details"))
    assert orders_of(warehouse) == [] and warehouse.load("rejected_pages").count() == 0
    ingest_increment(spark, warehouse, str(tmp_path / "pages"), str(tmp_path / "details"))
    assert [r[0] for r in orders_of(warehouse)] == [1] and warehouse.load("rejected_pages").count() == 1
    assert lines_of(warehouse) == [(1, 1, "A", "2024-03")]


def test_pages_are_computed_once(spark, tmp_path):
    from pyspark.sql import functions as F

    entries = [order(1, "05/03/2024"), order(1, "06/04/2024"), order(2, "05/03/2024")]
    replies = spark.read.schema(schemas.ORDER_PAGE).json(land(tmp_path / "p", "p.json", page(*entries), page(status="Erro", erros="x")))
    met = spark.sparkContext.accumulator(0)

    def seen(status):
        met.add(1)
        return status

    status = F.udf(seen).asNondeterministic()(F.col("retorno.status"))
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    account = apply_order_pages(warehouse, replies.select(F.col("retorno").withField("status", status).alias("retorno")))
    assert met.value == 2
    assert (account["pages"], account["rejected"], account["rows"]) == (2, 1, 3)
    assert sorted((r.order_id, r.month) for r in warehouse.load("orders").collect()) == [(1, "2024-04"), (2, "2024-03")]
    assert sorted((r.order_id, r.month) for r in warehouse.load("order_amounts").collect()) == [(1, "2024-04"), (2, "2024-03")]
