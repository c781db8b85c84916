"""Operators on pages and embeddings, the SQL twins, and the pipeline."""

import random
import time
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from salesloom.llm import embedding_dedup, html_text, url_filter
from salesloom.llm.queries import ORACLE, QUERIES, URL_RULES
from tests.conftest import SMALL

# URLs


def judge(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = next((k for k, c in enumerate(rest) if c in "/?#"), len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:].split("?")[0].split("#")[0]
    fits = [(len(h + p), h + p, action) for h, p, action in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[1:] if fits else (None, "allow")))


def test_cascade_is_exact(spark):
    rng = random.Random(1)
    labels = ["a", "b", "cc", "com", "net", "www", "x-y"]
    rules = list({(".".join(rng.choices(labels, k=rng.randint(1, 3))), "/" + rng.choice(["", "en/", "fr/x"]), "") for _ in range(40)})
    rules = [(h, p, rng.choice(["allow", "block"])) for h, p, _ in rules]
    urls = [None, "", "no scheme", "http://", "https://COM", "http://com/", "a://b?c://d/e"]
    urls += [f"http://{'.'.join(rng.choices(labels, k=rng.randint(1, 5)))}{rng.choice(['', '/', '/en/1', '/fr/x', '/fr/', '?q', '#f'])}" for _ in range(3000)]
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)], "page_id bigint, url string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(pages, rules).collect()}
    assert got == {i: judge(u, rules) for i, u in enumerate(urls)}


def test_urls_without_rows_or_rules(spark):
    pages = spark.createDataFrame([], "page_id bigint, url string")
    assert url_filter.judge_urls(pages, URL_RULES).count() == 0
    one = spark.createDataFrame([(1, "http://a.com/x")], "page_id bigint, url string")
    assert tuple(url_filter.judge_urls(one, []).first()) == (1, "a.com", "/x", None, "allow")


def test_filter_size_is_checked(spark):
    pages = spark.createDataFrame([(1, "http://a.com/x")], "page_id bigint, url string")
    with pytest.raises(ValueError, match="max_filter_bytes"):
        url_filter.judge_urls(pages, [("com", "/", "allow")], max_filter_bytes=1)


# embeddings


def brute_links(rows, threshold=0.98):
    n = len(rows)
    unit = []
    for _, v, label in rows:
        ok = v is not None and len(v) and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)
        unit.append(np.array(v, float) / np.linalg.norm(np.array(v, float)) if ok else None)
    links = [set() for _ in range(n)]
    for i in range(n):
        for j in range(i):
            if unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold:
                links[i].add(j)
                links[j].add(i)
    out, seen = [None] * n, set()
    for start in range(n):
        if start in seen:
            continue
        group, todo = {start}, [start]
        while todo:
            for k in links[todo.pop()] - group:
                group.add(k)
                todo.append(k)
        seen |= group
        least = min(rows[k][0] for k in group)
        for k in group:
            out[k] = (rows[k][0], len(links[k]), least, rows[k][0] == least)
    return Counter(out)


def test_embedding_links(spark):
    rng = np.random.default_rng(4)
    rows = []
    for label in (0, 1, 2):
        for _ in range(60):
            center = rng.standard_normal(24)
            rows += [(center + rng.standard_normal(24) * rng.choice([0, 0.02, 0.1, 0.2]), label) for _ in range(rng.integers(1, 5))]
    rows += [(np.full(24, 0.5), 1)] * 150 + [(np.full(24, 2.0), 1)] * 3
    rows = [(i, [float(x) for x in v], label) for i, (v, label) in enumerate(rows)]
    n = len(rows)
    odd = [None, [], [0.0] * 24, [float("nan")] * 24, [1.0, None], [float("inf"), 1.0], [1.0, 0.0], [2.0, 0.0]]
    rows += [(n + k, v, 1) for k, v in enumerate(odd)] + [(n + 50, rows[0][1], None)]
    frame = spark.createDataFrame([(*r, 5) for r in rows], "vec_id bigint, embedding array<double>, label int, component_id int")
    got = embedding_dedup.embedding_components(frame, tile=32).collect()
    assert Counter(map(tuple, got)) == brute_links(rows)


def test_embeddings_of_nothing(spark):
    assert embedding_dedup.embedding_components(spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")).count() == 0


# HTML

PAGE = """<html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header>Site <a href=/>Home</a></header><nav><ul><li><a href=/a>Menu one</a><li><a href=/b>Menu two</a></ul></nav>
<div class="cookie-notice">We use the cookies of this site and that is it for you.</div>
<article><h1>A&nbsp;title &amp; more</h1><p>The first <b>paragraph</b> of the
text is long enough to be decided by its stop words.<!-- hidden <p>no</p> --><p>Short one.
<form><input name=q><label>Find it in the archive of all the pages</label></form>
<p>And the second paragraph is here, with an <a href=/x>inline link</a> in the middle of it.</p>
<section id="comments"><p>The comment of a reader that is as long as the text of the page.</p></section></article>
<aside><p>The related reading of the day is in the sidebar of this page.</p></aside><footer>&copy; the owner</footer></body></html>"""


def test_main_text():
    assert html_text.main_text(PAGE).split("\n\n") == [
        "A title & more", "The first paragraph of the text is long enough to be decided by its stop words.", "Short one.",
        "And the second paragraph is here, with an inline link in the middle of it.",
    ]


def test_pages_without_an_article_go_by_their_blocks():
    page = "<div><a href=1>One</a> <a href=2>Two</a></div><div><h2>Head</h2><p>This is the text of the page and it is long enough for a decision.</p><p>Yes.</p></div><p><a href=3>More of it</a></p>"
    assert html_text.main_text(page).split("\n\n") == ["Head", "This is the text of the page and it is long enough for a decision.", "Yes."]


def test_blocks_are_joined_by_an_empty_line(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    for row in html_text.extract(pages).collect():
        blocks = row.text.split("\n\n")
        assert all(block and block == " ".join(block.split()) for block in blocks) or row.text == ""
        assert row.n_chars == len(row.text)


PARAGRAPH = "The text of the page is here and it is long enough for a decision by its words."


@pytest.mark.parametrize("attributes", ["title=it's", "title=it's class=x", "title='", 'title="', "x'y", '"', "a = 'b>c'", 'a="b>c" d', "data-x='\"' y", "=", "a=b=c'"])
def test_quotes_that_open_no_value_swallow_nothing(attributes):
    page = f"<p {attributes}>{PARAGRAPH}</p><p class=y>{PARAGRAPH}</p>"
    assert html_text.main_text(page) == f"{PARAGRAPH}\n\n{PARAGRAPH}"


def test_very_long_pages_are_read_whole():
    page = "<div>" + f"<p title='it' data=\"x\">{PARAGRAPH}</p>" * 20_000 + "<p " + "a=b " * 100_000
    start = time.monotonic()
    assert html_text.main_text(page) == "\n\n".join([PARAGRAPH] * 20_000)
    assert time.monotonic() - start < 20


@pytest.mark.parametrize("page", [None, "", "   ", "<p", "<!-- open", "<script>x", "</div></p>", "<a href='"])
def test_broken_pages_have_no_text(page):
    assert html_text.main_text(page) == ""


def test_extract_keeps_every_row(spark):
    rows = [(1, "u", PAGE, "clash"), (1, "u", PAGE, "clash"), (None, None, None, None), (2, "v", "<p>a < b &lt; c</p>", "")]
    got = html_text.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")).collect()
    assert len(got) == 4 and all(len(r.text) == r.n_chars for r in got)
    assert [r.text for r in got if r.page_id == 2] == ["a < b < c"]
    assert html_text.extract(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


# twins and pipeline


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "pages", "embeddings", "benchmark", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SMALL}/{table}.parquet')")
    result = connection.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    got = Counter(map(tuple, QUERIES[name](spark, SMALL).select(*columns).collect()))
    assert got == Counter(map(tuple, result.fetchall()))


def test_pipeline_stages(spark, edge_docs, no_docs):
    docs = edge_docs
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, SMALL)
        if name != "packing":
            assert made.schema.names == edge_docs.schema.names
            docs = corpus_pipeline.stored(made)
            kept[name] = Counter(row.doc_id for row in docs.collect())
        else:
            assert made.count() > 0
    assert not {1, 2, 3, 9} & set(kept["language_id"])
    assert kept["near_duplicates"][6] == 1 and 7 not in kept["near_duplicates"] and {4, 5, 8, 10, 11} <= set(kept["near_duplicates"])
    assert kept["personal_data"] == kept["near_duplicates"]
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, SMALL).count() == 0


def test_pipeline_draws_rows_with_one_id_and_size_apart(spark):
    """Of 300 rows that share a null id and a size the mix takes a share, not all or none."""
    rows = [(None, f"{k:04d} b c d e f", "a") for k in range(300)] + [(k, "x " * 6, "b") for k in range(3000)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = Counter(row.text for row in corpus_pipeline.mix_sources(spark, frame, "").where("source = 'a'").collect())
    assert len(got) == 300 and set(got.values()) == {3}
    flipped = frame.withColumn("source", F.when(F.col("source") == "a", "z").otherwise("a"))
    got = Counter(row.text for row in corpus_pipeline.mix_sources(spark, flipped, "").where("source = 'z'").collect())
    assert max(got.values()) <= 3 and sum(got.values()) == 900


def test_stages_discard_what_the_one_before_stored(spark, edge_docs):
    import os

    first = corpus_pipeline.mix_sources(spark, edge_docs, "")
    first.count()
    paths = [frame.stored_at for frame in corpus_pipeline._left]
    assert paths
    corpus_pipeline.pack_sequences(spark, edge_docs, "").count()
    assert not any(os.path.exists(path.removeprefix("file:")) for path in paths)


def test_pipeline_redacts(spark):
    rows = [(1, "write to joe@example.com or +1 (555) 123-4567 now", 40, "x"), (2, None, None, "y"), (3, "clean", 5, "z")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, n_chars bigint, _seeds string")
    got = sorted(map(tuple, corpus_pipeline.redact_personal_data(spark, frame, "").collect()))
    assert got == [(1, "write to [EMAIL] or [PHONE] now", 31, "x"), (2, None, None, "y"), (3, "clean", 5, "z")]
