"""Substring joins, the stored search index, keyset pages, and joins with heavy keys."""

import random
import re

import pytest
from pyspark.sql import functions as F

from salesloom.operators.grams import contained, grams, key_grams
from salesloom.operators.ordering import high_first, last_key, low_first, page, page_after
from salesloom.operators.skew import heavy_values, spread_left_join
from salesloom.plans import questions as Q
from salesloom.plans import search
from salesloom.sources.warehouse import Warehouse
from tests.conftest import rows_of

# --- texts and terms ------------------------------------------------------------


def test_grams(spark):
    df = spark.createDataFrame([("abcabc",), ("ab",), ("",), (None,), ("日本語é",)], "t string")
    assert [r[0] for r in df.select(grams(F.col("t"))).collect()] == [["abc", "bca", "cab"], [], [], None, ["日本語", "本語é"]]
    assert df.select(grams(F.col("t"), 1)).first()[0] == ["a", "b", "c"]


def test_contained_equals_brute_force(spark):
    rng = random.Random(3)
    texts = {k: "".join(rng.choices("abcé ", k=rng.randrange(0, 40))) for k in range(300)} | {900: "", 901: None, 902: "x" * 5000 + "abc"}
    terms = {"".join(rng.choices("abcé ", k=rng.randrange(1, 7))) for _ in range(200)} | {"xxx", "never there"}
    got = contained(
        spark.createDataFrame(list(texts.items()), "id int, text string"), "id", "text",
        spark.createDataFrame([(t,) for t in [*terms, "", None]], "term string"),
    ).collect()
    assert sorted(map(tuple, got)) == sorted((k, t) for k, text in texts.items() for t in terms if text and t in text)


def test_key_grams_avoid_what_all_terms_share(spark):
    terms = spark.createDataFrame([(f"brand#{k:04d}",) for k in range(500)] + [("ab",)], "term string")
    keys = {r.term: r.gram for r in key_grams(terms).collect()}
    assert len(keys) == 501 and keys["ab"] == "ab"
    assert not any(gram in ("bra", "ran", "and", "nd#") for gram in keys.values())


def test_ten_thousand_tags_meet_texts_without_a_literal(spark, conf):
    tags = spark.range(10_000).select(F.concat(F.lit("tag#"), F.lpad(F.col("id").cast("string"), 5, "0"), F.lit("!")).alias("tag"))
    texts = spark.range(2000).select(
        F.col("id").alias("question_id"),
        F.concat(F.lit("Quanto vendi de tag#"), F.lpad((F.col("id") * 7 % 12_000).cast("string"), 5, "0"), F.lit("! no ano de 2024, o total")).alias("text"),
    )
    read = Q.read_questions(texts, tags)
    found = {r.question_id: r.tags for r in read.collect()}
    assert found == {k: [f"tag#{k * 7 % 12_000:05d}!"] if k * 7 % 12_000 < 10_000 else [] for k in range(2000)}
    plan = read._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in plan and "tag#00042" not in plan and "Cartesian" not in read._jdf.queryExecution().executedPlan().toString()


# --- the stored index -------------------------------------------------------------

PRODUCTS = [
    (1, "SKU-1", "Red Widget"), (2, "SKU-12", "blue wídget"), (3, None, "Ring"), (4, "X", "Earring"), (5, "ring-5", None), (6, "", "Straße 9"),
    (7, "SKU-7", "Ångström ring"), (8, "q", "日本 widget"), (9, None, None), (10, "SKU-10", "RED  WIDGET"), (11, "ab", "a"),
]


@pytest.fixture(scope="module")
def products(spark):
    return spark.createDataFrame(PRODUCTS, "id bigint, sku string, product_name string")


@pytest.fixture(scope="module")
def index(spark, products, tmp_path_factory):
    shop = Warehouse(spark, str(tmp_path_factory.mktemp("index")))
    search.build_search_index(shop, "product_grams", search.product_texts(products), buckets=8)
    return shop


@pytest.mark.parametrize("mode", ["contains", "word", "prefix", "exact"])
@pytest.mark.parametrize("field", ["auto", "name", "sku"])
def test_the_index_finds_what_the_scan_finds(products, index, field, mode):
    for term in ("widget", "WÍDGET", "ring", "sku-1", "red widget", "", None, "a", "strasse", "日本", "nothing like it", "angstrom"):
        expected = sorted(r.id for r in search.product_search(products, term, field, mode).collect())
        assert sorted(r.id for r in search.product_search_indexed(products, index, "product_grams", term, field, mode).collect()) == expected, term


def test_records_by_the_index(spark, products, tmp_path):
    records = {"product": products, "order": spark.createDataFrame([(1, "Widget order", 5), (77, "none", None)], "id bigint, note string, n int")}
    shop = Warehouse(spark, str(tmp_path))
    search.build_search_index(shop, "record_grams", search.record_texts(records))
    for term in ("widget", '"id":1', "order", "no", "", "zzz zzz", "日本"):
        for kind in (None, "order"):
            expected = sorted(map(tuple, search.record_search(records, term, kind).collect()))
            assert sorted(map(tuple, search.record_search_indexed(records, shop, "record_grams", term, kind).collect())) == expected


def test_a_search_reads_only_the_buckets_of_its_runs(spark, tmp_path):
    shop = Warehouse(spark, str(tmp_path))
    many = spark.range(3000).select(F.lit("product").alias("kind"), F.col("id").cast("string").alias("id"), F.concat(F.lit("widget "), F.hex("id")).alias("text"))
    search.build_search_index(shop, "grams", many, buckets=32)
    found = search.search_candidates(shop, "grams", "widget bb")
    assert {int(r.id) for r in found.collect()} == {k for k in range(3000) if f"widget {k:X}".lower().startswith("widget bb")} or found.count() == 0
    found = search.search_candidates(shop, "grams", "widget BB")
    assert {int(r.id) for r in found.collect()} == {k for k in range(3000) if f"widget {k:X}".startswith("widget BB")}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*bucket#\d+ IN \(", plan) and re.search(r"PushedFilters: \[[^\]]*In\(gram", plan)


def test_the_index_lists_places_not_every_run_of_every_text(spark, tmp_path):
    """Its rows grow with the runs of a segment, its lists say what the runs of each text say."""
    shop = Warehouse(spark, str(tmp_path))
    rows = [("order", str(i), f"widget {i % 10}") for i in range(2000)] + [("odd", "1", "wídget \U0001f600x"), ("odd", None, "ab"), (None, "2", None), ("odd", "3", "a\x00\x00\x00")]
    search.build_search_index(shop, "grams", spark.createDataFrame(rows, "kind string, id string, text string").coalesce(1), buckets=4)
    index = shop.load("grams")
    assert index.count() < 200
    names = {r.segment: list(zip(r.kinds, r.ids, strict=True)) for r in index.where("gram is null").collect()}
    assert sorted(map(str, (pair for own in names.values() for pair in own))) == sorted(str((kind, key)) for kind, key, _ in rows)
    found = {}
    for r in index.where("gram is not null").collect():
        found.setdefault(r.gram, []).extend(names[r.segment][place] for place in r.places)
    expected = {}
    for kind, key, text in rows:
        runs = {(text or "")[k : k + 3] for k in range(len(text or "") - 2)} | ({""} if re.search(r"[^\x20-\x7E]", text or "") else set())
        for run in runs:
            expected.setdefault(run, []).append((kind, key))
    assert {run: sorted(map(str, of)) for run, of in found.items()} == {run: sorted(map(str, of)) for run, of in expected.items()}


# --- pages -------------------------------------------------------------------------


@pytest.mark.parametrize("order", [[("a", True), ("b", False), ("id", False)], [("b", False), ("a", True), ("id", True)], [("id", True)]])
def test_pages_by_key_equal_pages_by_number(spark, order):
    rng = random.Random(1)
    rows = [(k, rng.choice([None, 1, 2, 3]), rng.choice([None, "x", "y"])) for k in range(83)]
    df = spark.createDataFrame(rows, "id int, a int, b string")
    columns = [high_first(name) if descending else low_first(name) for name, descending in order]
    last, number, seen = None, 1, []
    while True:
        one = page_after(df, 10, order, last)
        assert rows_of(one) == rows_of(page(df, number, 10, *columns))
        following = last_key(one, order)
        if following is None:
            break
        seen += rows_of(one)
        last, number = following, number + 1
    assert len(seen) == len(set(seen)) == 83


def test_a_far_page_skips_what_lies_before(spark, tmp_path):
    spark.range(0, 200_000, 1, 4).select("id", (F.col("id") % 7).alias("v")).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    far = page_after(table, 10, [("id", False)], [199_000])
    assert [r.id for r in far.collect()] == list(range(199_001, 199_011))
    plan = far._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject(limit=10" in plan and re.search(r"PushedFilters: \[[^\]]*GreaterThan", plan) and "Offset" not in plan


# --- heavy keys ----------------------------------------------------------------------


def lines(spark):
    """A third of 90,000 lines hold one code, a ninth none."""
    code = F.when(F.col("id") % 3 == 0, "HOT").when(F.col("id") % 9 != 1, F.concat(F.lit("c"), (F.col("id") % 5000).cast("string")))
    return spark.range(0, 90_000, 1, 6).select((F.col("id") / 3).cast("bigint").alias("order_id"), F.col("id").alias("item_seq"), code.alias("code"))


def test_heavy_values_are_found_by_a_sketch(spark, conf):
    conf(spark__sql__shuffle__partitions="8")
    assert heavy_values(lines(spark), "code") == ["HOT"]
    assert heavy_values(lines(spark).where("code <> 'HOT'"), "code") == []
    assert heavy_values(lines(spark).limit(0), "code") == []


def test_a_hot_code_and_missing_codes_are_spread(spark, conf):
    conf(
        spark__sql__shuffle__partitions="12", spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false",
    )
    rows = lines(spark)
    products = spark.createDataFrame([(f"c{k}", k) for k in range(0, 5000, 2)] + [("HOT", -1), (None, -2)], "code string, product_key int")
    plain = rows.join(products.where("code is not null"), "code", "left")
    spread = spread_left_join(rows, products, "code", heavy_values(rows, "code"), ["order_id", "item_seq"])
    digest = lambda df: df.select(F.sum(F.xxhash64("order_id", "item_seq", "code", "product_key").cast("decimal(38,0)")), F.count(F.lit(1))).first()
    assert digest(spread) == digest(plain) and spread.columns == ["order_id", "item_seq", "code", "product_key"]

    def largest(df):
        held = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
        return max(held) / (sum(held) / 12)

    assert largest(plain) > 4 and largest(spread) < 1.5
