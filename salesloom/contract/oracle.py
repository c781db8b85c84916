"""The same queries as SQL for an independent engine, over the given tables."""

from __future__ import annotations

from salesloom.contract.registry import _CONTENTS as CONTENTS
from salesloom.contract.registry import END, START, TAG, VOCABULARY
from salesloom.contract.tables import AS_OF
from salesloom.plans import questions as Q

DAY = f"DATE '{AS_OF}'"
MONEY = "DECIMAL(18,4)"

# Twins of ``tables.Shop``.
TABLES = {
    "o": f"""
SELECT o_orderkey AS order_id, 'EXT-' || o_orderkey AS external_id,
  CAST(o_orderkey + 100000 AS VARCHAR) AS order_number, CAST(o_orderdate AS DATE) AS order_date,
  CASE WHEN o_orderkey%17=0 THEN '' WHEN o_orderkey%23=0 THEN NULL WHEN o_orderkey%29=0 THEN '  '
       WHEN o_orderkey%59=0 THEN 'null' ELSE o_orderpriority END AS channel,
  CAST(o_custkey AS VARCHAR) AS customer_id,
  CASE WHEN o_orderkey%31<>0 THEN 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') END AS customer_name,
  CASE o_orderstatus WHEN 'F' THEN 'Aprovado' WHEN 'O' THEN 'Em aberto' ELSE 'aprovação parcial' END AS status,
  CAST(CASE WHEN o_orderkey%19=0 THEN NULL WHEN o_orderkey%47=0 THEN 0
       ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS {MONEY}) AS total
FROM orders""",
    "i": f"""
SELECT l_orderkey AS order_id, l_linenumber AS item_seq, CAST(l_partkey AS VARCHAR) AS product_id,
  CASE WHEN l_orderkey%37=0 THEN NULL WHEN l_orderkey%41=0 THEN '' ELSE 'SKU-' || l_partkey END AS sku,
  CASE WHEN l_orderkey%53<>0 THEN 'Produto ' || (l_partkey%64) || ' ' || l_linestatus END AS product_name,
  CASE WHEN l_orderkey%61<>0 THEN CAST(l_quantity AS {MONEY}) END AS qty,
  CASE WHEN l_orderkey%67<>0 THEN CAST(CAST(floor(l_extendedprice * 100 / l_quantity) AS DECIMAL(16,0))
       * CAST(0.01 AS DECIMAL(3,2)) AS {MONEY}) END AS price,
  CAST(CASE WHEN l_orderkey%11=0 THEN NULL WHEN l_orderkey%43=0 THEN 0
       ELSE CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) END AS {MONEY}) AS total
FROM lineitem""",
    "p0": f"""
SELECT p_partkey, p_size, 'SKU-' || p_partkey AS sku, p_name AS product_name,
  CAST(p_retailprice AS {MONEY}) AS price,
  CASE WHEN p_partkey%7<>0 THEN CAST(CAST(p_retailprice AS {MONEY}) * CAST(0.9 AS DECIMAL(2,1)) AS {MONEY}) END AS promo_price,
  CASE WHEN p_partkey%10<>0 THEN CAST(CAST(p_retailprice AS {MONEY}) * CAST(0.6 AS DECIMAL(2,1)) AS {MONEY}) END AS cost_price,
  lpad(CAST(p_partkey AS VARCHAR), 13, '0') AS gtin, 'UN' AS unit, 'A-' || p_size AS location,
  CASE WHEN p_size<=45 THEN 'A' ELSE 'I' END AS status,
  CASE WHEN p_partkey%13<>0 THEN p_brand || ', ' || p_type || ' ,' END AS tags
FROM part""",
    "p": f"""
SELECT p_partkey AS id, CASE WHEN p_partkey%9<>0 THEN CAST(DATE '2000-01-01' + CAST(p_partkey%500 AS INTEGER) AS TIMESTAMP) END AS created_at,
  sku, product_name, price, promo_price, cost_price, gtin, unit, location, status, tags FROM p0
UNION ALL
SELECT -p_partkey-1, TIMESTAMP '1999-01-01', sku, product_name || ' (old)', price, promo_price,
  CAST(cost_price + 1 AS {MONEY}), gtin, unit, location, 'A', tags FROM p0 WHERE p_size >= 40""",
    "d": """
SELECT sku AS code, id AS id_src, product_name AS name, gtin, unit, status, location, price, promo_price,
  created_at, tags FROM p
QUALIFY row_number() OVER (PARTITION BY sku ORDER BY created_at DESC NULLS LAST, id DESC) = 1""",
    "k": "SELECT code, row_number() OVER (ORDER BY code) AS product_key FROM d",
    "li": """
SELECT i.*, o.order_date, o.channel, o.status FROM i JOIN o USING (order_id)""",
    "e": f"""
SELECT li.order_date AS day, coalesce(li.product_name, '(sem nome)') AS product,
  nullif(trim(coalesce(d.tags,''), ', '), '') AS tags, coalesce(li.qty, 0) AS qty,
  coalesce(li.total, CAST(li.qty*li.price AS {MONEY}), 0) AS total, li.sku
FROM li JOIN d ON d.code = li.sku AND d.status = 'A'""",
    "f": f"""
SELECT coalesce(h.day, {DAY}) AS day, order_id, item_seq, order_number, code, description, qty, unit_price, total,
  order_status, product_key
FROM (SELECT order_id, item_seq, sku AS code, product_name AS description, coalesce(qty,0) AS qty,
        coalesce(price,0) AS unit_price, coalesce(total,0) AS total FROM i
      QUALIFY row_number() OVER (PARTITION BY order_id, item_seq ORDER BY sku DESC NULLS LAST,
        product_name DESC NULLS LAST, i.qty DESC NULLS LAST, price DESC NULLS LAST, i.total DESC NULLS LAST) = 1)
JOIN (SELECT order_id, order_number, status AS order_status,
        CASE WHEN order_id%71<>0 THEN order_date END AS day FROM o) h USING (order_id)
LEFT JOIN k USING (code)""",
}
_NEEDS = {"p": ["p0"], "d": ["p0", "p"], "li": ["i", "o"], "e": ["i", "o", "li", "p0", "p", "d"], "f": ["i", "o", "p0", "p", "d", "k"], "k": ["p0", "p", "d"]}
_TYPES = {"s": "VARCHAR", "b": "BIGINT", "d": "DOUBLE", "t": "BOOLEAN"}
# Revenue of a line: total, else quantity times price.
REV = f"coalesce(total, CAST(coalesce(qty,0)*coalesce(price,0) AS {MONEY}))"
RECENT = f"order_date >= {DAY} - "


def _sql(needs: str, columns: str, body: str) -> str:
    """Query with its table definitions; ``columns`` gives each result type."""
    wanted = set()
    for name in needs.split():
        wanted.update(_NEEDS.get(name, []), [name])
    tables = ", ".join(f"{name} AS ({sql})" for name, sql in TABLES.items() if name in wanted)
    shown = ", ".join(f"CAST({c.split(':')[0]} AS {_TYPES[c.split(':')[1]]}) AS {c.split(':')[0]}" for c in columns.split())
    with_part = f"WITH {tables} " if tables else ""
    return f"{with_part}SELECT {shown} FROM ({body}) AS answer"


def _pct(current: str, previous: str, digits: int = 2) -> str:
    """Change in percent, rounded half away from zero in whole numbers."""
    change = f"CAST(({current} - {previous}) * 10000 AS HUGEINT)"
    base = f"CAST({previous} * 10000 AS HUGEINT)"
    scale = 10 ** digits * 100
    return (
        f"CASE WHEN {previous} > 0 THEN CAST(sign({change}) * ((abs({change}) * {2 * scale} + {base}) // (2 * {base})) AS DOUBLE)"
        f" / {10 ** digits} END"
    )


def _round_ratio(top: str, bottom: str, digits: int) -> str:
    """Quotient of non-negative money by a positive number, rounded in whole numbers."""
    n, m = f"CAST({top} * 10000 AS HUGEINT)", f"CAST({bottom} * 10000 AS HUGEINT)"
    return f"CAST((2 * {n} * {10 ** digits} + {m}) // (2 * {m}) AS DOUBLE) / {10 ** digits}"


def _ratio(top: str, bottom: str, otherwise: str = "NULL") -> str:
    return f"CASE WHEN {bottom} <> 0 THEN CAST({top} AS DOUBLE) / CAST({bottom} AS DOUBLE) ELSE {otherwise} END"


def _label(column: str, default: str) -> str:
    return f"coalesce(nullif(trim({column}),''), '{default}')"


APPROVED = "status ILIKE '%aprov%'"
# Lines that the replies of ``src`` hold, see ``pages.order_details``.
REPLY_LINES = """
  SELECT order_id, 1 + n AS item_seq, product_id, nullif(sku,'') AS sku, product_name,
    CASE WHEN n=0 OR order_id%13<>0 THEN qty END AS qty, price, CASE WHEN n=0 OR order_id%17<>0 THEN total END AS total
  FROM {src}, (SELECT unnest([0, 1, 2]) AS n) WHERE order_id%89<>0 AND n <= order_id%3"""
# The last line of an order, by the text that tells its place.
LAST_LINE = """(SELECT * FROM i QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY
  concat_ws('|', lpad(CAST(item_seq AS VARCHAR), 9, '0'), product_id, coalesce(sku,''), coalesce(product_name,''),
    coalesce(CAST(i.qty AS VARCHAR),''), coalesce(CAST(price AS VARCHAR),''), coalesce(CAST(i.total AS VARCHAR),'')) DESC) = 1)"""
ORACLE: dict[str, str] = {}


def _sales_reports() -> dict[str, str]:
    headers = f"SELECT order_date AS day, count(*) AS orders, sum(total) AS total FROM o GROUP BY 1"
    full90 = f"order_date >= {DAY} - 90 AND order_date < {DAY}"
    ranked = f"""
      SELECT {_label('sku', '(sem sku)')} AS sku, {_label('product_name', '(sem nome)')} AS product_name,
        coalesce(sum(total),0) AS revenue, coalesce(sum(qty),0) AS qty FROM li WHERE %s GROUP BY 1, 2"""
    ranking = """SELECT row_number() OVER (ORDER BY revenue DESC NULLS LAST, sku, product_name) AS rank, *
      FROM (%s)"""
    rank_cols = "rank:b sku:s product_name:s revenue:d qty:d"
    weekly = """SELECT %s AS channel, CAST(date_trunc('week', order_date) AS DATE) AS week, sum(total) AS revenue,
      count(DISTINCT order_id) AS orders FROM o WHERE %s GROUP BY 1, 2"""
    abc = f"""
      SELECT sku, product_name, revenue, pct AS cumulative_pct,
        CASE WHEN pct <= 70 THEN 'A' WHEN pct <= 90 THEN 'B' ELSE 'C' END AS class FROM (
        SELECT *, {_round_ratio('cum * 100', 'total', 1)} AS pct FROM (
          SELECT *, sum(revenue) OVER (ORDER BY revenue DESC NULLS LAST) AS cum, sum(revenue) OVER () AS total FROM (
            SELECT sku, product_name, sum(total) AS revenue FROM li WHERE %s GROUP BY 1, 2)))"""
    periods = """
      SELECT coalesce(nullif(sku,''), nullif(product_name,''), 'SEM_CODIGO') AS code,
        first(coalesce(product_name,'') ORDER BY order_id, item_seq, coalesce(product_name,'')) FILTER (WHERE now) AS description,
        count(*) FILTER (WHERE now) AS lines, count(*) FILTER (WHERE NOT now) AS previous_lines,
        sum(coalesce(qty,0)) FILTER (WHERE now) AS qty, sum(coalesce(total,0)) FILTER (WHERE now) AS revenue,
        sum(coalesce(total,0)) FILTER (WHERE NOT now) AS previous
      FROM (SELECT *, order_date >= {day} - {n} AS now FROM li WHERE order_date >= {day} - 2*{n} AND order_date <= {day})
      GROUP BY 1"""
    p30, p180 = periods.format(day=DAY, n=30), periods.format(day=DAY, n=180)
    drops = """SELECT code, description, {r} AS revenue, {p} AS previous, {c} AS change_pct FROM ({src})
      WHERE lines > 0 AND previous_lines > 0 AND previous > 0 AND revenue - previous <= -(CAST({t} AS DECIMAL(6,4)) * previous)"""
    cents = lambda c: f"CAST(CAST({c} AS DECIMAL(38,2)) AS DOUBLE)"
    drops_of = lambda src, t: drops.format(r=cents("revenue"), p=cents("previous"), c=_pct("revenue", "previous", 1), src=src, t=t)
    drop_cols = "code:s description:s revenue:d previous:d change_pct:d"
    customers = """SELECT %s AS customer, count(DISTINCT order_id) AS orders, sum(total) AS revenue FROM o WHERE %s
      GROUP BY 1 ORDER BY revenue DESC NULLS LAST, customer NULLS LAST LIMIT %d"""
    days14 = f"SELECT order_date AS day, count(*) AS orders, coalesce(sum(total),0) AS revenue FROM o GROUP BY 1 ORDER BY 1 DESC LIMIT 14"
    daily90 = f"""
      SELECT o.order_date AS day, count(*) AS orders, coalesce(sum(o.total),0) AS revenue, coalesce(sum(q.qty),0) AS items
      FROM o LEFT JOIN (SELECT order_id, sum(qty) AS qty FROM i GROUP BY 1) q USING (order_id)
      WHERE o.{RECENT}90 GROUP BY 1"""
    daily_channels = f"""SELECT order_date AS day, {_label('channel', '(sem canal)')} AS channel, count(*) AS orders,
      coalesce(sum(total),0) AS revenue FROM o GROUP BY 1, 2"""
    return {
        "daily_orders_from_lines": _sql("o i", "day:s orders:b items:d revenue:d", f"""
          SELECT o.order_date AS day, count(DISTINCT o.order_id) AS orders, sum(x.qty) AS items, sum(x.rev) AS revenue
          FROM o LEFT JOIN (SELECT order_id, coalesce(qty,0) AS qty, {REV} AS rev FROM i) x USING (order_id) GROUP BY 1"""),
        "daily_orders_from_headers": _sql("o i", "day:s orders:b revenue:d items:d", daily90),
        "channel_revenue_from_lines": _sql("o i", "channel:s revenue:d active_days:b", f"""
          SELECT {_label('o.channel', 'Desconhecido')} AS channel, sum(coalesce(x.rev,0)) AS revenue,
            count(DISTINCT o.order_date) AS active_days
          FROM o LEFT JOIN (SELECT order_id, {REV} AS rev FROM i) x USING (order_id) WHERE o.{RECENT}30 GROUP BY 1"""),
        "channel_orders": _sql("o", "channel:s orders:b revenue:d", f"""
          SELECT {_label('channel', '(sem canal)')} AS channel, count(*) AS orders, coalesce(sum(total),0) AS revenue
          FROM o WHERE {RECENT}30 GROUP BY 1"""),
        "product_sales": _sql("li", "sku:s product_name:s qty:d revenue:d", f"""
          SELECT sku, coalesce(max(product_name),'') AS product_name, sum(coalesce(qty,0)) AS qty, sum({REV}) AS revenue
          FROM li WHERE {RECENT}90 GROUP BY 1"""),
        "product_ranking": _sql("li", rank_cols, ranking % (ranked % f"{RECENT}90")),
        "product_ranking_sliced": _sql("li", rank_cols, ranking % (ranked % "true")),
        "top_ranked_products": _sql("li", rank_cols, f"SELECT * FROM ({ranking % (ranked % f'{RECENT}90')}) WHERE rank <= 10"),
        "sales_enriched_lines": _sql("e", "day:s product:s tags:s qty:d total:d", "SELECT * FROM e"),
        "sales_enriched_rollup": _sql("e", "day:s product:s tags:s qty:d total:d lines:b", """
          SELECT day, product, tags, sum(qty) AS qty, sum(total) AS total, count(*) AS lines FROM e GROUP BY day, sku, product, tags"""),
        "weekly_channel_revenue": _sql("o", "channel:s week:s revenue:d orders:b", weekly % ("channel", f"{RECENT}90")),
        "weekly_channel_change": _sql("o", "channel:s week:s revenue:d previous:d change_pct:d", f"""
          SELECT *, {_pct('revenue', 'previous')} AS change_pct FROM (
            SELECT *, lag(revenue) OVER (PARTITION BY channel ORDER BY week) AS previous FROM ({weekly % ("channel", f"{RECENT}90")}))"""),
        "weekly_growth_leaders": _sql("o", "channel:s week:s revenue:d previous:d change:d", f"""
          SELECT *, {_ratio('(revenue - previous)', 'previous')} AS change FROM (
            SELECT *, lag(revenue) OVER (PARTITION BY channel ORDER BY week) AS previous
            FROM ({weekly % ("coalesce(channel,'(sem canal)')", f"{RECENT}56 AND {APPROVED}")}))
          WHERE previous IS NOT NULL ORDER BY change DESC NULLS LAST, channel, week LIMIT 15"""),
        "falling_products": _sql("li", "sku:s product_name:s revenue:d previous:d delta:d change_pct:d", f"""
          SELECT *, revenue - previous AS delta, {_pct('revenue', 'previous')} AS change_pct FROM (
            SELECT sku, product_name, sum(total) FILTER (WHERE {RECENT}30) AS revenue,
              sum(total) FILTER (WHERE {RECENT}60 AND order_date < {DAY} - 30) AS previous
            FROM li GROUP BY 1, 2)
          WHERE previous > 0 ORDER BY delta ASC NULLS LAST, sku NULLS LAST, product_name NULLS LAST LIMIT 50"""),
        "falling_products_approved": _sql("li", "sku:s product_name:s previous:d revenue:d change:d", f"""
          SELECT sku, product_name, previous, revenue, {_ratio('(revenue - previous)', 'previous')} AS change FROM (
            SELECT sku, product_name, count(*) FILTER (WHERE is_new) AS sold,
              coalesce(sum(total) FILTER (WHERE is_new), 0) AS revenue,
              sum(sum(total) FILTER (WHERE NOT is_new)) OVER (PARTITION BY sku) AS previous
            FROM (SELECT *, order_date >= {DAY} - 30 AS is_new FROM li
              WHERE {RECENT}60 AND order_date < {DAY} AND {APPROVED})
            GROUP BY sku, product_name)
          WHERE sku IS NOT NULL AND sold > 0 AND revenue < previous
          ORDER BY change NULLS LAST, previous DESC, sku, product_name NULLS LAST LIMIT 20"""),
        "product_drops": _sql("li", drop_cols, drops_of(p30, "0.3")),
        "product_drops_half_year": _sql("li", drop_cols, drops_of(p180, "0.5")),
        "sku_totals": _sql("li", "code:s description:s lines:b previous_lines:b qty:d revenue:d previous:d", p30),
        "top_skus": _sql("li", "code:s description:s qty:d revenue:d",
            f"SELECT * FROM ({p30}) WHERE lines > 0 ORDER BY revenue DESC NULLS LAST, code LIMIT 20"),
        "unsold_products": _sql("li p", "code:s name:s status:s", f"""
          SELECT sku AS code, coalesce(product_name,'') AS name, coalesce(status,'') AS status FROM p
          WHERE nullif(sku,'') IS NOT NULL AND sku NOT IN (SELECT code FROM ({p30}) WHERE lines > 0)"""),
        "kpi_comparison": _sql("o li", "revenue:d orders:b previous_revenue:d previous_orders:b average_ticket:d previous_average_ticket:d", f"""
          SELECT *, {_ratio('revenue', 'orders', '0')} AS average_ticket,
            {_ratio('previous_revenue', 'previous_orders', '0')} AS previous_average_ticket FROM (
            SELECT (SELECT coalesce(sum(total),0) FROM li WHERE {RECENT}30 AND order_date <= {DAY}) AS revenue,
              (SELECT count(*) FROM o WHERE {RECENT}30 AND order_date <= {DAY}) AS orders,
              (SELECT coalesce(sum(total),0) FROM li WHERE {RECENT}60 AND order_date < {DAY} - 30) AS previous_revenue,
              (SELECT count(*) FROM o WHERE {RECENT}60 AND order_date < {DAY} - 30) AS previous_orders)"""),
        "top_customers": _sql("o", "customer:s orders:b revenue:d", customers % ("customer_name", f"{RECENT}90", 50)),
        "top_customers_approved": _sql("o", "customer:s orders:b revenue:d",
            customers % ("coalesce(customer_name,'(sem nome)')", f"{full90} AND {APPROVED}", 20)),
        "abc_curve": _sql("li", "sku:s product_name:s revenue:d cumulative_pct:d class:s", abc % f"{RECENT}90"),
        "abc_curve_sliced": _sql("li", "sku:s product_name:s revenue:d cumulative_pct:d class:s", abc % "true"),
        "abc_leaders": _sql("li", "position:b sku:s product_name:s revenue:d cumulative_share:d class:s", f"""
          SELECT *, {_ratio('cum', 'total')} AS cumulative_share,
            CASE WHEN cum * 100 <= total * 80 THEN 'A' WHEN cum * 100 <= total * 95 THEN 'B' ELSE 'C' END AS class FROM (
            SELECT *, rank() OVER (ORDER BY revenue DESC NULLS LAST) AS position,
              sum(revenue) OVER (ORDER BY revenue DESC NULLS LAST) AS cum, sum(revenue) OVER () AS total FROM (
              SELECT sku, product_name, sum(total) AS revenue FROM li WHERE {full90} AND {APPROVED} GROUP BY 1, 2))
          ORDER BY revenue DESC NULLS LAST, sku NULLS LAST, product_name NULLS LAST LIMIT 30"""),
        "average_ticket": _sql("o", "channel:s month:s orders:b revenue:d average_ticket:d", f"""
          SELECT *, {_round_ratio('revenue', 'orders', 2)} AS average_ticket FROM (
            SELECT channel, CAST(date_trunc('month', order_date) AS DATE) AS month, count(DISTINCT order_id) AS orders,
              sum(total) AS revenue FROM o WHERE {RECENT}180 GROUP BY 1, 2)"""),
        "average_ticket_approved": _sql("o", "channel:s month:s orders:b revenue:d average_ticket:d", f"""
          SELECT *, {_ratio('revenue', 'orders', '0')} AS average_ticket FROM (
            SELECT coalesce(channel,'(sem canal)') AS channel, CAST(date_trunc('month', order_date) AS DATE) AS month,
              count(*) AS orders, sum(total) AS revenue
            FROM o WHERE order_date >= date_trunc('month', {DAY}) - INTERVAL 5 MONTH AND {APPROVED} GROUP BY 1, 2)"""),
        "gross_margin": _sql("li p", "sku:s product_name:s qty:d revenue:d cost:d margin:d margin_share:d", f"""
          SELECT *, revenue - cost AS margin, {_ratio('(revenue - cost)', 'revenue')} AS margin_share FROM (
            SELECT li.sku, product_name, sum(qty) AS qty, sum(total) AS revenue,
              coalesce(sum(CAST(qty * coalesce(cost_price,0) AS DECIMAL(38,4))), 0) AS cost
            FROM li LEFT JOIN (SELECT sku, cost_price FROM p QUALIFY row_number() OVER
                (PARTITION BY sku ORDER BY created_at DESC NULLS LAST, id DESC) = 1) c ON c.sku = li.sku
            WHERE {full90} AND {APPROVED} GROUP BY 1, 2 HAVING sum(total) > 0)
          ORDER BY revenue DESC, sku NULLS LAST, product_name NULLS LAST LIMIT 20"""),
        "fact_daily_sales": _sql("f", "day:s revenue:d qty:d", "SELECT day, sum(total) AS revenue, sum(qty) AS qty FROM f GROUP BY 1"),
        "fact_top_skus": _sql("f d", "code:s name:s qty:d revenue:d", f"""
          SELECT f.code, coalesce(d.name, f.description) AS name, sum(f.qty) AS qty, sum(f.total) AS revenue
          FROM f LEFT JOIN d ON d.code = f.code WHERE day BETWEEN {DAY} - 30 AND {DAY} GROUP BY 1, 2
          ORDER BY revenue DESC, code NULLS LAST, name NULLS LAST LIMIT 20"""),
        "last_days_series": _sql("o", "day:s orders:b revenue:d average_ticket:d",
            f"SELECT *, {_ratio('revenue', 'orders', '0')} AS average_ticket FROM ({days14})"),
        "last_days_headline": _sql("o", "orders:b revenue:d average_ticket:d", f"""
          SELECT *, {_ratio('revenue', 'orders', '0')} AS average_ticket FROM (
            SELECT sum(orders) AS orders, sum(revenue) AS revenue FROM ({days14}))"""),
        "daily_channel_orders": _sql("o", "day:s channel:s orders:b revenue:d", daily_channels),
        "channel_totals": _sql("o", "channel:s orders:b revenue:d", f"""
          SELECT channel, sum(orders) AS orders, CAST(sum(revenue) AS DECIMAL(38,2)) AS revenue
          FROM ({daily_channels}) WHERE day > {DAY} - 30 GROUP BY 1"""),
        "mean_items_per_day": _sql("o i", "mean_items:d", f"SELECT avg(CAST(items AS DOUBLE)) AS mean_items FROM ({daily90}) WHERE day >= {DAY} - 14"),
        "mean_items_newest_days": _sql("o i", "mean_items:d", f"""
          SELECT avg(CAST(items AS DOUBLE)) AS mean_items FROM (SELECT * FROM ({daily90}) ORDER BY day DESC LIMIT 14)"""),
        "report_tables": _sql("o i li", "section:s rank:b key:s name:s revenue:d quantity:d", f"""
          SELECT 'channels' AS section, NULL AS rank, {_label('channel', '(sem canal)')} AS key, NULL AS name,
            CAST(coalesce(sum(total),0) AS DOUBLE) AS revenue, CAST(count(*) AS DOUBLE) AS quantity FROM o WHERE {RECENT}30 GROUP BY 3
          UNION ALL SELECT 'top_products', rank, sku, product_name, CAST(revenue AS DOUBLE), CAST(qty AS DOUBLE)
            FROM ({ranking % (ranked % f"{RECENT}90")}) WHERE rank <= 10
          UNION ALL SELECT 'items_per_day', NULL, 'mean', NULL, NULL,
            CAST(CAST(avg(CAST(items AS DOUBLE)) AS DECIMAL(38,4)) AS DOUBLE) FROM ({daily90}) WHERE day >= {DAY} - 14"""),
    }


def _period_reports() -> dict[str, str]:
    inside = f"day >= DATE '{START}' AND day < DATE '{END}' + 1"
    by_tag = f"{inside} AND tags ILIKE '%{TAG}%'"
    summary_cols = "start:s end:s tag:s units:d revenue:d products:b days:b revenue_per_unit:d".replace("end:", '"end":')
    summary = """SELECT DATE '{s}' AS start, DATE '{e}' AS "end", {tag} AS tag, sum(qty) AS units, sum(total) AS revenue,
      count(DISTINCT product) AS products, count(DISTINCT day) AS days,
      CASE WHEN sum(qty) > 0 THEN CAST(sum(total) AS DOUBLE) / CAST(sum(qty) AS DOUBLE) ELSE 0 END AS revenue_per_unit
      FROM e WHERE {where}"""
    top = """SELECT product, {tag} AS tag, sum(qty) AS units, sum(total) AS revenue FROM e WHERE {where} GROUP BY 1
      ORDER BY revenue DESC, product LIMIT {n}"""
    monthly = """SELECT *, CASE WHEN highest > 0 THEN greatest(5, CAST(revenue AS DOUBLE) / CAST(highest AS DOUBLE) * 100) ELSE 0 END AS bar_width
      FROM (SELECT *, max(revenue) OVER () AS highest FROM (
        SELECT CAST(date_trunc('month', day) AS DATE) AS month, {tag} AS tag, sum(qty) AS units, sum(total) AS revenue
        FROM e WHERE {where} GROUP BY 1))"""
    parts = {"plain": dict(tag="NULL", where=inside), "tag": dict(tag=f"'{TAG}'", where=by_tag)}
    top_cols, month_cols = "product:s tag:s units:d revenue:d", "month:s tag:s units:d revenue:d bar_width:d"
    return {
        "period_summary": _sql("e", summary_cols, summary.format(s=START, e=END, **parts["plain"])),
        "period_summary_by_tag": _sql("e", summary_cols, summary.format(s=START, e=END, **parts["tag"])),
        "top_products_in_period": _sql("e", top_cols, top.format(n=10, **parts["plain"])),
        "top_products_in_period_by_tag": _sql("e", top_cols, top.format(n=25, **parts["tag"])),
        "monthly_sales": _sql("e", month_cols, monthly.format(**parts["plain"])),
        "monthly_sales_by_tag": _sql("e", month_cols, monthly.format(**parts["tag"])),
        "tag_list": _sql("d", "tag:s", """SELECT DISTINCT tag FROM (
          SELECT trim(unnest(string_split(tags, ','))) AS tag FROM d WHERE status = 'A' AND tags <> '') WHERE tag <> ''"""),
        "sales_question_totals": _sql("e", "revenue:d qty:d lines:b", """
          SELECT sum(total) AS revenue, sum(qty) AS qty, count(*) AS lines FROM e
          WHERE (tags ILIKE '%economy%' OR tags ILIKE '%brand#2%') AND year(day) = 2000 AND month(day) = 5"""),
        "sales_question_lines": _sql("e", "day:s product:s tags:s qty:d revenue:d", """
          SELECT day, product, tags, qty, total AS revenue FROM e WHERE tags ILIKE '%small%' AND year(day) = 2001"""),
    }


def _words(column: str, words) -> str:
    return "(" + " OR ".join(f"contains({column}, '{w}')" for w in words) + ")"


def _question_reports() -> dict[str, str]:
    months = ", ".join(f"'{name}'" for name, _ in Q.MONTH_NAMES)
    words = ", ".join(f"'{tag}'" for tag in VOCABULARY)
    month_case = " ".join(f"WHEN contains(t, '{name}') THEN {number}" for name, number in Q.MONTH_NAMES)
    vocabulary = ", ".join(f"'{tag}'" for tag in sorted(VOCABULARY))
    read = f"""
      SELECT question_id, CAST(nullif(regexp_extract(t, '20[0-9][0-9]', 0), '') AS BIGINT) AS year,
        CASE {month_case} END AS month, list_filter([{vocabulary}], lambda x: contains(t, x)) AS tag_set,
        {_words('t', Q.TOTAL_WORDS)} AS wants_totals,
        NOT (length(t) <= {Q.SMALL_TALK_LENGTH} OR regexp_matches(t, '{Q.SMALL_TALK}'))
          AND ({_words('t', Q.ANALYSIS_WORDS)} OR {_words('t', Q.COMPARISON_WORDS)}) AS uses_data
      FROM (SELECT conv_id * 1000 + turn AS question_id, lower(trim(
        CASE WHEN conv_id%3=0 THEN 'Quanto vendi ' WHEN conv_id%3=1 THEN 'Analise o produto ' ELSE 'Oi ' END
        || CASE WHEN conv_id%5<>0 THEN 'de ' || ([{words}])[CAST(conv_id%6+1 AS INTEGER)] || ' ' ELSE '' END
        || CASE WHEN conv_id%4=0 THEN 'ou ' || ([{words}])[CAST(turn%6+1 AS INTEGER)] || ' ' ELSE '' END
        || CASE WHEN conv_id%2=0 THEN 'em ' || ([{months}])[CAST(conv_id%13+1 AS INTEGER)] || ' ' ELSE '' END
        || CASE WHEN turn%3<>0 THEN 'de 200' || (conv_id%2) || ' ' ELSE '' END || ': ' || text)) AS t FROM conversations)"""
    joined = """FROM q LEFT JOIN e ON q.uses_data AND (len(tag_set) = 0 OR len(list_filter(tag_set, lambda x: contains(lower(e.tags), x))) > 0)
        AND (q.year IS NULL OR year(e.day) = q.year) AND (q.month IS NULL OR month(e.day) = q.month)"""
    cols = "question_id:b year:b month:b tags:s wants_totals:t uses_data:t"
    # Sales are summed before the condition join to keep the check affordable.
    cells = """SELECT tags, year(day) AS y, month(day) AS m, sum(total) AS total, sum(qty) AS qty, count(*) AS lines
      FROM e GROUP BY 1, 2, 3"""
    return {
        "questions_read": _sql("", cols, f"SELECT *, array_to_string(tag_set, ',') AS tags FROM ({read})"),
        "questions_answered": _sql("e", f"{cols} revenue:d qty:d lines:b", f"""
          WITH q AS ({read}), c AS ({cells}),
            asked AS (SELECT DISTINCT tag_set, year, month FROM q WHERE uses_data),
            a AS (SELECT tag_set, asked.year, asked.month, sum(total) AS revenue, sum(qty) AS qty, sum(lines) AS lines
              FROM asked JOIN c ON (len(tag_set) = 0 OR len(list_filter(tag_set, lambda x: contains(lower(c.tags), x))) > 0)
                AND (asked.year IS NULL OR y = asked.year) AND (asked.month IS NULL OR m = asked.month) GROUP BY 1, 2, 3)
          SELECT q.*, array_to_string(q.tag_set, ',') AS tags, a.revenue, a.qty,
            CASE WHEN uses_data THEN coalesce(a.lines, 0) END AS lines
          FROM q LEFT JOIN a ON q.uses_data AND a.tag_set = q.tag_set AND a.year IS NOT DISTINCT FROM q.year
            AND a.month IS NOT DISTINCT FROM q.month"""),
        "question_all_lines": _sql("e", "question_id:b lines:b revenue:d", f"""
          WITH q AS (SELECT * FROM ({read}) WHERE uses_data AND NOT wants_totals)
          SELECT question_id, count(*) AS lines, sum(total) AS revenue
          FROM q JOIN e ON (len(tag_set) = 0 OR len(list_filter(tag_set, lambda x: contains(lower(e.tags), x))) > 0)
            AND (q.year IS NULL OR year(e.day) = q.year) AND (q.month IS NULL OR month(e.day) = q.month) GROUP BY 1"""),
        "question_lines": _sql("e", "question_id:b position:b day:s product:s line_tags:s qty:d revenue:d", f"""
          WITH q AS (SELECT * FROM ({read}) WHERE uses_data AND NOT wants_totals),
            asked AS (SELECT DISTINCT tag_set, year, month FROM q),
            a AS (SELECT asked.*, e.day, product, tags AS line_tags, qty, total AS revenue,
                row_number() OVER (PARTITION BY tag_set, asked.year, asked.month
                  ORDER BY day, product, total, qty, tags NULLS FIRST) AS position
              FROM asked JOIN e ON (len(tag_set) = 0 OR len(list_filter(tag_set, lambda x: contains(lower(e.tags), x))) > 0)
                AND (asked.year IS NULL OR year(e.day) = asked.year) AND (asked.month IS NULL OR month(e.day) = asked.month)
              QUALIFY position <= 10)
          SELECT question_id, position, day, product, line_tags, qty, revenue FROM q JOIN a ON a.tag_set = q.tag_set
            AND a.year IS NOT DISTINCT FROM q.year AND a.month IS NOT DISTINCT FROM q.month"""),
    }


def _profiles() -> dict[str, str]:
    counts = {"orders": "o", "order_items": "i", "products": "p"}
    union = " UNION ALL ".join(f"SELECT '{n}' AS \"table\", count(*) AS \"rows\" FROM {t}" for n, t in counts.items())
    cents = "CAST(sum(total) AS DECIMAL(38,2))"
    return {
        "load_summary": _sql("o li", "orders:b lines:b gross:d", f"""
          SELECT (SELECT count(*) FROM o WHERE order_date BETWEEN DATE '2001-07-02' AND {DAY}) AS orders,
            count(*) AS lines, coalesce(sum(total),0) AS gross FROM li WHERE order_date BETWEEN DATE '2001-07-02' AND {DAY}"""),
        "load_sample": _sql("li", "order_id:b order_date:s item_seq:b sku:s product_name:s qty:d price:d total:d", """
          SELECT * FROM li WHERE order_date BETWEEN DATE '2001-06-01' AND DATE '2001-06-30'
          ORDER BY order_date DESC, order_id DESC, item_seq, sku NULLS LAST, product_name NULLS LAST, qty NULLS LAST,
            price NULLS LAST, total NULLS LAST LIMIT 10"""),
        "table_counts": _sql("o i p", '"table":s "rows":b', union),
        "table_counts_row": _sql("o i p", "orders:b order_items:b products:b",
            "SELECT (SELECT count(*) FROM o) AS orders, (SELECT count(*) FROM i) AS order_items, (SELECT count(*) FROM p) AS products"),
        "order_range": _sql("o", "first_day:s last_day:s orders:b total:d",
            f"SELECT min(order_date) AS first_day, max(order_date) AS last_day, count(*) AS orders, {cents} AS total FROM o"),
        "newest_days": _sql("o", "day:s orders:b total:d",
            f"SELECT order_date AS day, count(*) AS orders, {cents} AS total FROM o GROUP BY 1 ORDER BY 1 DESC LIMIT 10"),
        "channels_by_revenue": _sql("o", "channel:s orders:b total:d", f"""
          SELECT coalesce(channel,'(null)') AS channel, count(*) AS orders, {cents} AS total FROM o GROUP BY 1
          ORDER BY total DESC NULLS LAST, channel LIMIT 15"""),
        "newest_orders": _sql("o", "order_id:b external_id:s order_number:s order_date:s channel:s status:s total:d",
            "SELECT * FROM o ORDER BY order_date DESC NULLS LAST, order_id DESC LIMIT 5"),
        "newest_lines": _sql("li", "order_id:b order_date:s item_seq:b sku:s product_name:s qty:d price:d total:d", """
          SELECT * FROM li ORDER BY order_date DESC NULLS LAST, order_id DESC, item_seq, sku NULLS LAST,
            product_name NULLS LAST, qty NULLS LAST, price NULLS LAST, total NULLS LAST LIMIT 5"""),
        "newest_products": _sql("p", "id:b sku:s product_name:s price:d cost_price:d", "SELECT * FROM p ORDER BY id DESC LIMIT 5"),
        "newest_rows": _sql("o", "id:b numero:s total:d",
            "SELECT order_id AS id, order_number AS numero, total FROM o ORDER BY 1 DESC LIMIT 3"),
        "tag_coverage": _sql("e", "products:b with_tags:b enriched_rows:b", """
          SELECT count(*) AS products, count(*) FILTER (WHERE tags <> '') AS with_tags,
            (SELECT count(*) FROM e) AS enriched_rows FROM d"""),
        "tagged_sample": _sql("d", "code:s name:s tags:s", "SELECT * FROM d WHERE tags <> '' ORDER BY code LIMIT 10"),
    }


def _sources() -> dict[str, str]:
    dirty_day = """CASE WHEN order_id%73=0 OR order_id%79=0 THEN NULL ELSE order_date END"""
    month = f"coalesce(strftime({dirty_day}, '%Y-%m'), 'none')"
    line_cols = "order_id:b item_seq:b product_id:s sku:s product_name:s qty:d price:d total:d"
    landed = """
      SELECT id, sku AS code, product_name AS name, gtin, unit, CASE WHEN abs(id)%11<>0 THEN price END AS price, promo_price,
        status, location, CASE WHEN abs(id)%9<>1 THEN strftime(created_at, '%Y-%m-%d %H:%M:%S') END AS created_at,
        CASE WHEN tags IS NULL THEN NULL
          WHEN abs(id)%4 IN (0, 2) THEN trim(split_part(tags,',',1)) || ',' || trim(split_part(tags,',',2)) || ',3'
          WHEN abs(id)%4 = 1 THEN trim(split_part(tags,',',1)) || ',' || trim(split_part(tags,',',2))
          ELSE tags END AS tags FROM p"""
    return {
        "landed_order_pages": _sql("o", "order_id:b external_id:s order_number:s order_date:s channel:s customer_id:s customer_name:s status:s total:d", f"""
          SELECT order_id, CAST(order_id AS VARCHAR) AS external_id, CASE WHEN order_id%5<>0 THEN order_number END AS order_number,
            {dirty_day} AS order_date, nullif(channel,'') AS channel, customer_id, customer_name, status,
            CASE WHEN order_id%3=0 THEN total ELSE nullif(total, 0) END AS total
          FROM o WHERE order_id%83<>0 AND order_id<>0"""),
        "landed_order_amounts": _sql("o", "order_id:b ordered_at:s products_amount:d discount_amount:d freight_amount:d total_amount:d", f"""
          SELECT order_id, strftime(CASE WHEN order_id%4<>3 THEN {dirty_day} END + INTERVAL 3 HOUR, '%Y-%m-%d %H:%M:%S') AS ordered_at,
            CASE WHEN order_id%5<>0 THEN total END AS products_amount, CASE WHEN order_id%6=0 THEN 1.5 END AS discount_amount,
            CASE WHEN order_id%4<>0 THEN 12.25 END AS freight_amount,
            CASE WHEN order_id%3=0 THEN total END AS total_amount FROM o WHERE order_id%83<>0"""),
        "stored_orders_upserted": _sql("o", "order_id:b status:s total:d month:s", f"""
          SELECT order_id, CASE WHEN NOT ({RECENT}60) THEN status WHEN {APPROVED} THEN 'Entregue' ELSE 'Em aberto' END AS status,
            CASE WHEN order_id%3=0 THEN total ELSE nullif(total, 0) END AS total, coalesce(strftime({dirty_day}, '%Y-%m'), 'none') AS month
          FROM o WHERE order_id%83<>0 AND order_id<>0"""),
        "stored_page_rejects": _sql("o", "reason:s pages:b", """
          SELECT 'limite de acessos' AS reason, 1 AS pages WHERE EXISTS (SELECT 1 FROM o WHERE order_id%83=0)"""),
        "orders_as_csv": _sql("o", "order_id:b order_date:s customer_name:s status:s total:d",
            "SELECT order_id, order_date, customer_name, status, total FROM o"),
        "staged_orders": _sql("o", "order_id:b order_number:s order_date_text:s status:s customer_name:s seller:s total:d", """
          SELECT order_id, CASE WHEN order_id%5<>0 THEN order_number END AS order_number,
            CASE WHEN order_id%4 IN (0, 3) THEN
              CASE WHEN order_id%73=0 THEN CAST(order_date AS VARCHAR) WHEN order_id%79=0 THEN '31/02/2001'
                ELSE strftime(order_date, '%d/%m/%Y') || CASE WHEN order_id%7=0 THEN ' 10:24:18' ELSE '' END END END AS order_date_text,
            CASE WHEN order_id%3<>0 THEN status END AS status,
            CASE WHEN order_id%3<>2 THEN customer_name END AS customer_name, NULL AS seller,
            CASE WHEN order_id%3<>0 THEN nullif(total, 0) END AS total
          FROM o WHERE order_id%83<>0 AND order_id<>0"""),
        "staged_items": _sql("i", "code:s description:s lines:b qty:d total:d unpriced:b", """
          SELECT nullif(sku,'') AS code, product_name AS description, sum(1 + order_id%3) AS lines,
            sum(coalesce(qty,0) + CASE WHEN order_id%13<>0 THEN order_id%3 * coalesce(qty,0) ELSE 0 END) AS qty,
            sum(coalesce(total,0) + CASE WHEN order_id%17<>0 THEN order_id%3 * coalesce(total,0) ELSE 0 END) AS total,
            coalesce(sum(1 + order_id%3) FILTER (WHERE coalesce(price,0) = 0), 0) AS unpriced
          FROM i WHERE order_id%89<>0 GROUP BY 1, 2"""),
        "landed_page_rejects": _sql("o", "reason:s pages:b", "SELECT 'limite de acessos' AS reason, count(*) AS pages FROM o WHERE order_id%83=0"),
        "landed_order_details": _sql("i", f"{line_cols}", REPLY_LINES.format(src="i")),
        "stored_order_amounts": _sql("o", "order_id:b ordered_at:s products_amount:d discount_amount:d freight_amount:d total_amount:d month:s", f"""
          SELECT order_id, strftime(CASE WHEN order_id%4<>3 THEN {dirty_day} END + INTERVAL 3 HOUR, '%Y-%m-%d %H:%M:%S') AS ordered_at,
            CASE WHEN order_id%5<>0 THEN total END AS products_amount, CASE WHEN order_id%6=0 THEN 1.5 END AS discount_amount,
            CASE WHEN order_id%4<>0 THEN 12.25 END AS freight_amount, CASE WHEN order_id%3=0 THEN total END AS total_amount,
            {month} AS month FROM o WHERE order_id%83<>0 AND order_id<>0"""),
        "stored_lines_replaced": _sql("o i", f"{line_cols} month:s", f"""
          WITH doubled AS (SELECT * REPLACE (CASE WHEN order_id IN (SELECT order_id FROM o WHERE {RECENT}30) THEN CAST(qty * 2 AS {MONEY}) ELSE qty END AS qty)
            FROM {LAST_LINE})
          SELECT l.*, coalesce(stored, 'none') AS month FROM ({REPLY_LINES.format(src="doubled")}) AS l
          LEFT JOIN (SELECT order_id, {month} AS stored FROM o WHERE order_id%83<>0 AND order_id<>0) USING (order_id)"""),
        "stored_detail_rejects": _sql("i", "order_id:b reason:s", "SELECT DISTINCT order_id, 'Erro' AS reason FROM i WHERE order_id%89=0"),
        "stored_dimension": _sql("p", "product_key:b code:s id_src:b name:s gtin:s unit:s status:s location:s price:d promo_price:d created_at:s updated_at:s tags:s", f"""
          WITH pages AS ({landed}),
          first_keys AS (SELECT code, row_number() OVER (ORDER BY code) AS product_key FROM (SELECT DISTINCT code FROM pages WHERE status = 'I')),
          keys AS (FROM first_keys UNION ALL SELECT code, (SELECT count(*) FROM first_keys) + row_number() OVER (ORDER BY code)
            FROM (SELECT DISTINCT code FROM pages WHERE code NOT IN (SELECT code FROM first_keys))),
          newest AS (SELECT * FROM pages QUALIFY row_number() OVER (PARTITION BY code ORDER BY created_at DESC NULLS LAST, id DESC) = 1),
          early AS (SELECT code, tags FROM pages WHERE status = 'I'
            QUALIFY row_number() OVER (PARTITION BY code ORDER BY created_at DESC NULLS LAST, id DESC) = 1)
          SELECT product_key, code, id AS id_src, name, gtin, unit, status, location, price, promo_price, created_at,
            '{AS_OF} 00:00:00' AS updated_at, coalesce(newest.tags, early.tags) AS tags
          FROM newest JOIN keys USING (code) LEFT JOIN early USING (code)"""),
        "stream_increments": _sql("o i", "order_id:b status:s total:d month:s lines:b qty:d", f"""
          WITH heads AS (SELECT order_id, status, CASE WHEN order_id%3=0 THEN total ELSE nullif(total, 0) END AS total, {month} AS month
              FROM o WHERE order_id%83<>0 AND order_id<>0),
            sums AS (SELECT order_id, count(*) AS lines, sum(qty) AS qty FROM ({REPLY_LINES.format(src=LAST_LINE)}) GROUP BY 1)
          SELECT order_id, status, total, coalesce(month, 'none') AS month, lines, qty FROM heads FULL JOIN sums USING (order_id)"""),
        "stream_batches": _sql("o i", 'stream:s number:b pages:b rejected:b "rows":b parts:s', f"""
          WITH heads AS (SELECT order_id, order_date >= {DAY} - 60 AS late, order_id%83=0 AS bad, {month} AS month FROM o),
          kept AS (SELECT * FROM heads WHERE NOT bad AND order_id<>0),
          replies AS (SELECT DISTINCT order_id FROM i),
          first_months AS (SELECT order_id, month FROM kept WHERE NOT late),
          sums AS (SELECT order_id, count(*) AS lines FROM ({REPLY_LINES.format(src=LAST_LINE)}) GROUP BY 1),
          spread AS (SELECT r.order_id, coalesce(f.month, 'none') AS early, coalesce(k.month, 'none') AS late_month
            FROM replies r LEFT JOIN first_months f USING (order_id) LEFT JOIN kept k USING (order_id) WHERE r.order_id%89<>0)
          SELECT 'orders' AS stream, CAST(late AS BIGINT) AS number, count(*) AS pages, count(DISTINCT CASE WHEN bad THEN PART END) AS rejected,
            count(*) FILTER (WHERE NOT bad AND order_id<>0) AS "rows",
            string_agg(DISTINCT month, ',' ORDER BY month) FILTER (WHERE NOT bad AND order_id<>0) AS parts
          FROM (SELECT *, 0 AS PART FROM heads) GROUP BY late
          UNION ALL SELECT 'order_items', n, (SELECT count(*) FROM replies), (SELECT count(*) FROM replies WHERE order_id%89=0),
            (SELECT sum(lines) FROM sums), CASE n WHEN 0 THEN (SELECT string_agg(DISTINCT early, ',' ORDER BY early) FROM spread)
              ELSE (SELECT string_agg(DISTINCT late_month, ',' ORDER BY late_month) FROM spread) END
          FROM (SELECT unnest([0, 1]) AS n)"""),
        "landed_product_pages": _sql("p", "id:b code:s name:s gtin:s unit:s price:d promo_price:d status:s location:s created_at:s tags:s", landed),
        "landed_catalogue": _sql("p", "id:b sku:s product_name:s price:d promo_price:d cost_price:d avg_cost:d unit:s gtin:s variation_type:s location:s status:s created_at:s", f"""
          SELECT *, code AS sku, name AS product_name, NULL AS cost_price, NULL AS avg_cost, NULL AS variation_type FROM ({landed})"""),
        "product_category_tags": _sql("p", "id_src:b tag:s", """
          SELECT id AS id_src, CASE WHEN abs(id)%6 IN (0, 2) THEN '' ELSE location END AS tag FROM p WHERE abs(id)%31<>0"""),
        "rows_as_json": _sql("o", "order_id:b " + " ".join(f"json_{c}:s" for c in (
            "order_id external_id order_number order_date channel customer_id customer_name status").split()) + " json_total:d", """
          SELECT order_id, order_id AS json_order_id, external_id AS json_external_id, order_number AS json_order_number,
            order_date AS json_order_date, channel AS json_channel, customer_id AS json_customer_id,
            customer_name AS json_customer_name, status AS json_status, total AS json_total FROM o"""),
    }


def _cleansing() -> dict[str, str]:
    ok = "order_id%10 IN (3,5,6,7,8,9)"
    number = "CASE WHEN order_id%6 IN (2,4,5) THEN total END"
    search = "translate(product_name, 'aei', 'ãéí')"
    return {
        "clean_dates": _sql("o", "order_id:b instant:s utc_day:s local_day:s local_time:s date_key:b", f"""
          SELECT order_id, CASE WHEN {ok} THEN strftime(order_date + INTERVAL 3 HOUR, '%Y-%m-%d %H:%M:%S') END AS instant,
            CASE WHEN {ok} THEN order_date END AS utc_day, CASE WHEN {ok} THEN order_date END AS local_day,
            CASE WHEN {ok} THEN CAST(order_date AS VARCHAR) || CASE WHEN order_id%10=3 THEN ' 23:59:58' ELSE ' 00:00:00' END END AS local_time,
            year(order_date)*10000 + month(order_date)*100 + day(order_date) AS date_key FROM o"""),
        "clean_numbers": _sql("o", "order_id:b number:d number_or_zero:d first_nonzero:d guarded:d guarded_zero:d", f"""
          SELECT order_id, number, coalesce(number, 0) AS number_or_zero, coalesce(nullif(number, 0), 7) AS first_nonzero,
            {_ratio('total', 'number')} AS guarded, {_ratio('total', 'number', '0')} AS guarded_zero
          FROM (SELECT *, {number} AS number FROM o)"""),
        "clean_labels": _sql("o", "order_id:b channel:s channel_unknown:s customer:s approved:t", f"""
          SELECT order_id, CASE WHEN trim(coalesce(channel,'')) IN ('', 'null') THEN '(sem canal)' ELSE channel END AS channel,
            {_label('channel', 'Desconhecido')} AS channel_unknown, {_label('customer_name', '(sem nome)')} AS customer,
            {APPROVED} AS approved FROM o"""),
        "clean_lines": _sql("i", "code:s lines:b revenue:d valued_lines:b", f"""
          SELECT coalesce(nullif(sku,''), nullif(product_name,''), 'SEM_CODIGO') AS code, count(*) AS lines, sum({REV}) AS revenue,
            count(coalesce(total, CAST(qty*price AS {MONEY}))) AS valued_lines FROM i GROUP BY 1"""),
        "clean_tags": _sql("p", "id:b tags:s none:s", "SELECT id, nullif(trim(tags, ', '), '') AS tags, NULL AS none FROM p"),
        "recent_windows": _sql("o", " ".join(f"last_{n}_days:b" for n in (14, 30, 56, 60, 90, 180))
            + " six_months:b full_90_days:b through_july:b year_2000:b may_2000:b any_may:b", f"""
          SELECT {", ".join(f"count(*) FILTER (WHERE {RECENT}{n}) AS last_{n}_days" for n in (14, 30, 56, 60, 90, 180))},
            count(*) FILTER (WHERE order_date >= DATE '2001-03-01') AS six_months,
            count(*) FILTER (WHERE {RECENT}90 AND order_date < {DAY}) AS full_90_days,
            count(*) FILTER (WHERE year(order_date) = 2001 AND month(order_date) = 7) AS through_july,
            count(*) FILTER (WHERE year(order_date) = 2000) AS year_2000,
            count(*) FILTER (WHERE year(order_date) = 2000 AND month(order_date) = 5) AS may_2000,
            count(*) FILTER (WHERE month(order_date) = 5) AS any_may FROM o"""),
        "tag_queue": _sql("d", "id_src:b code:s name:s", "SELECT * FROM d WHERE tags IS NULL AND status = 'A'"),
        "product_search_contains": _sql("p", "id:b sku:s product_name:s", f"""
          SELECT id, sku, {search} AS product_name FROM p WHERE contains(strip_accents(lower({search} || ' ' || sku)), 'widg')"""),
        "product_search_word": _sql("p", "id:b sku:s product_name:s", f"""
          SELECT id, sku, {search} AS product_name FROM p WHERE regexp_matches(strip_accents(lower({search})), '\\bring\\b')"""),
        "product_search_prefix": _sql("p", "id:b sku:s product_name:s", f"SELECT id, sku, {search} AS product_name FROM p WHERE lower(sku) LIKE 'sku-1%'"),
        "product_search_exact": _sql("p", "id:b sku:s product_name:s", f"""
          SELECT id, sku, {search} AS product_name FROM p WHERE strip_accents(lower({search})) = 'red widget'"""),
        "record_search": _sql("o p", "kind:s id:s", """
          SELECT 'order' AS kind, order_id AS id FROM o WHERE contains(lower(customer_name), 'customer#00000001')
          UNION ALL SELECT 'customer', c_custkey FROM customer WHERE contains(lower(c_name), 'customer#00000001')
          UNION ALL SELECT 'product', id FROM p WHERE contains(lower(sku || product_name), 'customer#00000001')"""),
        "orders_page": _sql("o", "order_id:b order_date:s status:s",
            "SELECT order_id, order_date, status FROM o ORDER BY order_date DESC NULLS LAST, order_id LIMIT 50 OFFSET 100"),
    }


def _maintenance() -> dict[str, str]:
    fixed = f"CASE WHEN total IS NULL OR total = 0 THEN CAST(coalesce(qty,0)*coalesce(price,0) AS {MONEY}) ELSE total END"
    dim = "code:s id_src:b name:s gtin:s unit:s status:s location:s price:d promo_price:d created_at:s updated_at:s tags:s"
    dim_row = """SELECT sku AS code, id AS id_src, product_name AS name, gtin, unit, status, location, price, promo_price,
      strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at, '{stamp} 00:00:00' AS updated_at, {tags} AS tags FROM p {where}
      QUALIFY row_number() OVER (PARTITION BY sku ORDER BY p.created_at DESC NULLS LAST, id DESC) = 1"""
    order_cols = "order_id:b external_id:s order_number:s order_date:s channel:s customer_id:s customer_name:s status:s total:d"
    recent60, recent30 = f"{RECENT}60", f"{RECENT}30"
    return {
        "order_lines": _sql("li", "order_id:b sku:s qty:d total:d order_date:s channel:s", "SELECT * FROM li"),
        "order_running_share": _sql("o", "customer_id:s orders:d cumulative:d grand_total:d", """
          SELECT *, sum(orders) OVER (ORDER BY orders DESC) AS cumulative, sum(orders) OVER () AS grand_total
          FROM (SELECT customer_id, count(*) AS orders FROM o GROUP BY 1)"""),
        "calendar_orders": _sql("o", "date_key:b date_value:s year:b month:b day:b month_name:s dow:b dow_name:s is_weekend:t orders:b", f"""
          SELECT CAST(strftime(v, '%Y%m%d') AS BIGINT) AS date_key, v AS date_value, year(v) AS year, month(v) AS month, day(v) AS day,
            strftime(v, '%B') AS month_name, dayofweek(v) AS dow, strftime(v, '%A') AS dow_name, dayofweek(v) IN (0,6) AS is_weekend, orders
          FROM (SELECT CAST(unnest(generate_series({DAY} - INTERVAL 6 YEAR, {DAY} + INTERVAL 1 YEAR, INTERVAL 1 DAY)) AS DATE) AS v)
          LEFT JOIN (SELECT order_date, count(*) AS orders FROM o GROUP BY 1) ON order_date = v"""),
        "dimension_products": _sql("p k", f"product_key:b {dim}", f"SELECT * FROM ({dim_row.format(stamp=AS_OF, tags='tags', where='')}) JOIN k USING (code)"),
        "dimension_upsert": _sql("p", f"product_key:b {dim}", f"""
          WITH c AS ({dim_row.format(stamp=AS_OF, tags="tags", where="WHERE status = 'A'")}),
          first_keys AS (SELECT code, row_number() OVER (ORDER BY code) AS product_key FROM (SELECT DISTINCT sku AS code FROM p WHERE status = 'I')),
          keys AS (FROM first_keys UNION ALL SELECT code, (SELECT count(*) FROM first_keys) + row_number() OVER (ORDER BY code)
            FROM c WHERE code NOT IN (SELECT code FROM first_keys))
          SELECT u.*, product_key FROM (
          SELECT * REPLACE (coalesce(tags, CASE WHEN code IN (SELECT sku FROM p WHERE status = 'I') THEN 'x' END) AS tags)
          FROM c UNION ALL SELECT * FROM ({dim_row.format(stamp="2001-01-01", tags="'x'", where="WHERE status = 'I'")})
          WHERE code NOT IN (SELECT code FROM c)) AS u JOIN keys USING (code)"""),
        "orders_upserted": _sql("o", f"{order_cols} version:b", f"""
          SELECT * REPLACE (CASE WHEN {recent60} THEN CASE WHEN {APPROVED} THEN 'Entregue' ELSE 'Em aberto' END ELSE status END AS status),
            CASE WHEN {recent60} THEN CASE WHEN {APPROVED} THEN 2 ELSE 1 END ELSE 0 END AS version
          FROM o WHERE order_date < DATE '2001-07-01' OR {recent60}"""),
        "order_lines_replaced": _sql("li", "order_id:b item_seq:b product_id:s sku:s product_name:s qty:d price:d total:d", f"""
          SELECT * REPLACE (CASE WHEN {recent30} AND status = 'Aprovado' THEN qty * 2 ELSE qty END AS qty) FROM li
          WHERE NOT ({recent30} AND status = 'aprovação parcial')"""),
        "orders_migrated": _sql("o", order_cols, """
          SELECT * REPLACE (CASE WHEN order_date < DATE '2000-01-01' THEN external_id END AS external_id) FROM o"""),
        "items_migrated": _sql("o i", "order_id:b item_seq:b product_id:s sku:s product_name:s qty:d price:d total:d", """
          WITH early AS (SELECT order_id FROM o WHERE order_date < DATE '2000-01-01'),
          known AS (SELECT * FROM i WHERE order_id IN (SELECT order_id FROM early))
          SELECT * FROM known UNION ALL
          SELECT * FROM (SELECT * FROM i QUALIFY row_number() OVER (PARTITION BY order_id, item_seq ORDER BY product_id DESC NULLS LAST,
            sku DESC NULLS LAST, product_name DESC NULLS LAST, i.qty DESC NULLS LAST, price DESC NULLS LAST, i.total DESC NULLS LAST) = 1)
          WHERE (order_id, item_seq) NOT IN (SELECT (order_id, item_seq) FROM known)"""),
        "fact_window_loaded": _sql("o i k", "date_key:b order_id:b item_seq:b order_number:s product_key:b code:s description:s qty:d unit_price:d total:d order_status:s month:s", f"""
          WITH heads AS (SELECT order_id, CASE WHEN order_id%5<>0 THEN order_number END AS order_number,
              CASE WHEN order_id%3<>0 THEN status END AS order_status,
              CASE WHEN order_id%4 IN (0, 3) AND order_id%73<>0 AND order_id%79<>0 THEN order_date END AS known
            FROM o WHERE order_id%83<>0 AND order_id<>0),
          dated AS (SELECT *, coalesce(known, {DAY}) AS day FROM heads WHERE coalesce(known, {DAY}) BETWEEN {DAY} - 90 AND {DAY})
          SELECT CAST(strftime(day, '%Y%m%d') AS BIGINT) AS date_key, order_id, item_seq, order_number, product_key, code, description, qty, unit_price,
            total, order_status, strftime(day, '%Y-%m') AS month
          FROM (SELECT order_id, item_seq, sku AS code, product_name AS description, coalesce(qty,0) AS qty, coalesce(price,0) AS unit_price,
              coalesce(total,0) AS total FROM ({REPLY_LINES.format(src=LAST_LINE)}))
          JOIN dated USING (order_id) LEFT JOIN k USING (code)"""),
        "fact_reloaded": _sql("f", "date_key:b order_id:b item_seq:b order_number:s code:s description:s qty:d unit_price:d total:d order_status:s product_key:b",
            "SELECT *, CAST(strftime(day, '%Y%m%d') AS BIGINT) AS date_key FROM f"),
        "backfilled_orders": _sql("o i", "order_id:b channel:s total:d", f"""
          SELECT order_id, CASE WHEN channel IS NULL OR channel = '' OR channel ILIKE 'null' THEN '(sem canal)' ELSE channel END AS channel,
            CASE WHEN total IS NULL OR total = 0 THEN coalesce(s, total) ELSE total END AS total
          FROM o LEFT JOIN (SELECT order_id, sum({fixed}) AS s FROM i GROUP BY 1) USING (order_id)"""),
        "backfilled_items": _sql("i", "order_id:b item_seq:b sku:s total:d", f"SELECT * REPLACE ({fixed} AS total) FROM i"),
        "tags_filled": _sql("d", "code:s tags:s updated_at:s", f"""
          WITH queue AS (SELECT id_src, code FROM d WHERE tags IS NULL AND status = 'A'),
            found AS (SELECT d.code, CASE WHEN abs(id_src)%6 IN (0, 2) THEN '' ELSE location END AS tag
              FROM d WHERE code IN (SELECT code FROM queue) AND abs(id_src)%31<>0)
          SELECT d.code, coalesce(found.tag, d.tags) AS tags,
            CASE WHEN found.code IS NOT NULL THEN '2001-08-02 00:00:00' ELSE '{AS_OF} 00:00:00' END AS updated_at
          FROM d LEFT JOIN found ON found.code = d.code"""),
        "columns_added": _sql("o", "order_id:b channel:s seller:s freight:d", "SELECT order_id, channel, NULL AS seller, NULL AS freight FROM o"),
        "duplicate_line_keys": _sql("i", 'order_id:b item_seq:b "rows":b', """
          SELECT order_id, item_seq, count(*) AS "rows" FROM i GROUP BY 1, 2 HAVING count(*) > 1"""),
        "reports_refreshed": _sql("o li", '"table":s "rows":b', f"""
          SELECT 'daily_orders' AS "table", (SELECT count(DISTINCT order_date) FROM o WHERE {RECENT}90) AS "rows"
          UNION ALL SELECT 'channels_30d', (SELECT count(DISTINCT {_label('channel', '(sem canal)')}) FROM o WHERE {recent30})
          UNION ALL SELECT 'product_ranking_90d', (SELECT count(*) FROM (SELECT DISTINCT {_label('sku', '(sem sku)')},
            {_label('product_name', '(sem nome)')} FROM li WHERE {RECENT}90))
          UNION ALL SELECT 'daily_orders_lines', (SELECT count(DISTINCT order_date) FROM o)
          UNION ALL SELECT 'channel_lines_30d', (SELECT count(DISTINCT {_label('channel', 'Desconhecido')}) FROM o WHERE {recent30})
          UNION ALL SELECT 'product_sales_90d', (SELECT count(*) FROM (SELECT DISTINCT sku FROM li WHERE {RECENT}90))
          UNION ALL SELECT 'daily_channels', (SELECT count(*) FROM (SELECT DISTINCT order_date, {_label('channel', '(sem canal)')} FROM o))"""),
    }


def _contents() -> str:
    """Rows of all stored reports, from the reports' own twins."""
    sources = {
        "daily_orders": "daily_orders_from_headers", "channels_30d": "channel_orders", "product_ranking_90d": "product_ranking",
        "daily_orders_lines": "daily_orders_from_lines", "channel_lines_30d": "channel_revenue_from_lines",
        "product_sales_90d": "product_sales", "daily_channels": "daily_channel_orders",
    }
    parts = []
    for report, (key, name, *measures) in CONTENTS.items():
        numbers = ", ".join(f"CAST({column or 'NULL'} AS DOUBLE) AS {alias}" for column, alias in zip(measures, "abc", strict=True))
        parts.append(f"SELECT '{report}' AS report, {key} AS key, CAST({name or 'NULL'} AS VARCHAR) AS name, {numbers} FROM ({ORACLE[sources[report]]})")
    return " UNION ALL ".join(parts)


for _group in (_sales_reports, _period_reports, _question_reports, _profiles, _sources, _cleansing, _maintenance):
    ORACLE.update(_group())
ORACLE["reports_contents"] = ORACLE["reports_contents_incremental"] = _contents()
ORACLE["period_summary_merged"] = ORACLE["period_summary"]
ORACLE["orders_page_after"] = ORACLE["orders_page"]
ORACLE["product_search_indexed"] = ORACLE["product_search_word"]
ORACLE["record_search_indexed"] = ORACLE["record_search"]
