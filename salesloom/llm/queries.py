"""Named queries of this subpackage and, where SQL can say it, their twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from salesloom.llm import conversation_repair, embedding_dedup, html_text, jaccard_join, langid, mixing, packing, pii, quality
from salesloom.llm import recurrent_lm, sketch_search, swap_packing, url_filter
from salesloom.llm.common import table
from salesloom.llm.repair_sql import REPAIR

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def query(function):
    QUERIES[function.__name__] = function
    return function


def tokenizer_json(name: str = "byte_bpe_50k.json") -> str:
    """A vocabulary file of the installed package, read on the driver and shipped to the tasks."""
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        return file.read()


@query
def op1_power_of_two_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_json(), with_ids=False)


@query
def op2_perplexity_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge_quality(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", *quality.MEASURES, "base_failed", "kept", "log_perplexity")


@query
def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


@query
def op4_embedding_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_components(table(spark, sf_dir, "embeddings"))


@query
def op5_recurrent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recurrent_lm.score_documents(table(spark, sf_dir, "documents"))


@query
def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


@query
def op7_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score")


@query
def op8_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


@query
def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


@query
def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


@query
def op11_sketch_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op12_swap_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return swap_packing.pack(table(spark, sf_dir, "documents"), tokenizer_json("word_bpe_49k.json"), with_ids=False)


@query
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_report(conversation_repair.damage(table(spark, sf_dir, "conversations")))


_RULE_ROWS = ", ".join(f"('{host}', '{path}', '{action}')" for host, path, action in URL_RULES)

ORACLE["op3_url_filters"] = rf"""
WITH rules(rule_host, rule_path, action) AS (VALUES {_RULE_ROWS}),
parts AS (
    SELECT page_id,
        coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
        coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path,
        row_number() OVER () AS row_no
    FROM pages
),
fitting AS (
    SELECT row_no, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
        arg_max(action, length(rule_host || rule_path)) AS action
    FROM parts JOIN rules
        ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    GROUP BY row_no
)
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict
FROM parts LEFT JOIN fitting USING (row_no)
"""

ORACLE["op9_source_mix"] = rf"""
WITH sized AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
    FROM documents
),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
    SELECT *, CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3
        WHEN 0 THEN 5e0 WHEN 1 THEN 2e0 ELSE 1e0 END AS weight,
        CAST(source_size * 3 AS DOUBLE) AS most
    FROM sources
),
tried AS (
    SELECT *, CAST(sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER (
            ORDER BY most / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
        / sum(weight) OVER (ORDER BY most / weight, source ASC NULLS LAST
            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share
    FROM weighed
),
level AS (SELECT max(share) FILTER (WHERE share * weight <= most) AS level FROM tried),
targets AS (
    SELECT source, source_size, coalesce(least((SELECT level FROM level) * weight, most), most) AS target FROM weighed
),
numbered AS (
    SELECT *, row_number() OVER (PARTITION BY source, size > 0 ORDER BY size, doc_id) - 1 AS place FROM sized
),
drawn AS (
    SELECT n.*, t.source_size, t.target, t.target / t.source_size AS rate,
        CAST(CAST('0x' || substr(md5('mix-1:' || coalesce('s' || n.source, 'n')), 1, 8) AS BIGINT) AS DOUBLE)
            / 4294967296e0 AS off
    FROM numbered n JOIN targets t ON n.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
    CASE WHEN size = 0 THEN 0 ELSE CAST(least(floor(off + (place + 1) * rate) - floor(off + place * rate), 3) AS BIGINT) * size END AS taken
FROM drawn
"""

ORACLE["op10_jaccard_join"] = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w
    FROM documents
),
shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 OR w IS NULL THEN []
        WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] END) AS s
    FROM words
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id
),
links AS (
    SELECT a, b FROM shared JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
    WHERE 100 * n_both >= 80 * (x.n + y.n - n_both)
),
reached(node, root) AS (
    SELECT a, a FROM links
    UNION
    SELECT l.b, r.root FROM reached r JOIN links l ON l.a = r.node
)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(r.root, d.doc_id) AS component_id
FROM documents d LEFT JOIN sizes s USING (doc_id)
    LEFT JOIN (SELECT node, min(root) AS root FROM reached GROUP BY node) r ON r.node = d.doc_id
"""

ORACLE["op4_embedding_tiles"] = """
WITH RECURSIVE usable AS (
    SELECT vec_id, label, v, sqrt(list_sum([x * x FOR x IN v])) AS norm
    FROM (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL)
    WHERE list_sum([x * x FOR x IN v]) > 0 AND len([x FOR x IN v IF x IS NULL OR NOT isfinite(x)]) = 0
),
links AS (
    SELECT p.vec_id AS a, q.vec_id AS b
    FROM usable p JOIN usable q ON p.label = q.label AND p.vec_id <> q.vec_id AND len(p.v) = len(q.v)
    WHERE list_dot_product(p.v, q.v) / (p.norm * q.norm) >= 0.98
),
reached(node, root) AS (
    SELECT a, a FROM links
    UNION
    SELECT l.b, r.root FROM reached r JOIN links l ON l.a = r.node
),
roots AS (SELECT node, min(root) AS root FROM reached GROUP BY node),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n, 0) AS n_links, coalesce(root, e.vec_id) AS component_id, coalesce(root, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN counted ON a = e.vec_id LEFT JOIN roots ON node = e.vec_id
"""

ORACLE["op11_sketch_search"] = r"""
WITH texts AS (
    SELECT doc_id, row_number() OVER () AS row_no,
        regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
),
sized AS (SELECT doc_id, row_no, terms, CAST(len(terms) AS BIGINT) AS n FROM texts WHERE len(terms) > 0),
totals AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM sized),
lengths AS (SELECT doc_id, row_no, 10 + (90 * n * n_docs) // n_terms AS m FROM sized, totals),
asked AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
),
words AS (SELECT row_no, unnest(terms) AS term FROM sized),
held AS (
    SELECT row_no, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY row_no, term
),
weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM held, totals GROUP BY term
),
scored AS (
    SELECT item_id, doc_id, row_no, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
    FROM asked JOIN held USING (term) JOIN weights USING (term) JOIN lengths USING (row_no)
    GROUP BY item_id, doc_id, row_no
),
ranked AS (
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST) AS INTEGER) AS rank,
        doc_id, score
    FROM scored WHERE score > 0
)
SELECT * FROM ranked WHERE rank <= 10
"""

ORACLE["op13_conversation_repair"] = REPAIR
