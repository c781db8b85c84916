"""Edge cases of the cleansing expressions."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from salesloom.functions import cleanse as C
from salesloom.functions import predicates as P


def values(spark, cases, expression, ddl="c string"):
    rows = [(i, *(case if isinstance(case, tuple) else (case,))) for i, case in enumerate(cases)]
    df = spark.createDataFrame(rows, f"i int, {ddl}")
    return [row.v for row in df.select("i", expression.alias("v")).orderBy("i").collect()]


DATES = ["05/03/2024", "05/03/2024 10:24:18", "2024-03-05", "31/02/2024", "", None, "5/3/2024", "ontem"]


def test_source_date(spark):
    days = values(spark, DATES, C.parse_source_day(F.col("c")))
    assert days == [date(2024, 3, 5), date(2024, 3, 5)] + [None] * 6


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo", "Asia/Tokyo"])
def test_source_instant_is_independent_of_the_session_zone(spark, conf, zone):
    conf(spark__sql__session__timeZone=zone)
    moment = C.parse_source_date(F.col("c"))
    seconds = values(spark, DATES, F.unix_seconds(moment))
    assert seconds == [1709607600, 1709607600] + [None] * 6  # 2024-03-05T03:00:00Z
    assert values(spark, DATES[:1], C.utc_day(moment)) == [date(2024, 3, 5)]


def test_source_datetime(spark):
    cases = ["31/10/2023 10:24:18", "31/10/2023", "31/02/2023 10:00:00", "2023-10-31", "31/10", None, ""]
    assert values(spark, cases, C.parse_source_datetime(F.col("c"))) == [
        datetime(2023, 10, 31, 10, 24, 18), datetime(2023, 10, 31), None, None, None, None, None,
    ]


def test_numbers(spark):
    cases = ["1.5", " 2 ", "", "  ", "abc", "1,5", None, "0"]
    dec = [None if v is None else Decimal(v) for v in ("1.5", "2", None, None, None, None, None, "0")]
    assert values(spark, cases, C.number_or_null(F.col("c"))) == dec
    assert values(spark, cases, C.number_or_zero(F.col("c"))) == [v or Decimal(0) for v in dec]
    assert values(spark, cases, C.first_nonzero(F.col("c"), F.lit("9")))[-1] == Decimal(9)


def test_labels(spark):
    cases = ["loja", "", "   ", None, "null", "NULL", " ml "]
    assert values(spark, cases, C.channel_label(F.col("c"))) == [
        "loja", "(sem canal)", "(sem canal)", "(sem canal)", "(sem canal)", "(sem canal)", "ml",
    ]
    assert values(spark, cases[:5], C.label_or(F.col("c"), "x")) == ["loja", "x", "x", "x", "null"]


def test_sku_key(spark):
    cases = [("A", "d"), ("", "d"), (None, "d"), ("", ""), (None, None)]
    assert values(spark, cases, C.sku_key(F.col("a"), F.col("b")), "a string, b string") == [
        "A", "d", "d", "SEM_CODIGO", "SEM_CODIGO",
    ]


def test_line_revenue(spark):
    d = Decimal
    cases = [(d(5), d(1), d(1)), (None, d(2), d(3)), (None, None, d(3)), (d(0), d(2), d(3)), (None, None, None)]
    columns = [F.col(c) for c in "tqp"]
    ddl = "t decimal(18,4), q decimal(18,4), p decimal(18,4)"
    assert values(spark, cases, C.line_revenue(*columns), ddl) == [5, 6, 0, 0, 0]
    assert values(spark, cases, C.line_revenue(*columns, default_zero=False), ddl) == [5, 6, None, 0, None]


def test_ratio_and_change(spark):
    d = Decimal
    cases = [(d(1), d(4)), (d(1), d(0)), (d(1), None), (None, d(2))]
    ddl = "n decimal(18,4), m decimal(18,4)"
    assert values(spark, cases, C.ratio(F.col("n"), F.col("m")), ddl) == [0.25, None, None, None]
    assert values(spark, cases, C.ratio(F.col("n"), F.col("m"), 0.0), ddl) == [0.25, 0.0, 0.0, None]
    pct = values(spark, [(d("1.005"), d(1)), (d(1), d(0)), (d(0), d(3))], C.change_pct(F.col("n"), F.col("m")), ddl)
    assert [None if v is None else float(v) for v in pct] == [0.5, None, -100.0]
    # 85.1499...% must not become 85.15 first and 85.2 then, also for the widest sums.
    wide = "n decimal(38,4), m decimal(38,4)"
    cases = [(d("10795.9761"), d("72700.0464"))]
    assert values(spark, cases, C.change_pct(F.col("n"), F.col("m"), 1), wide)[0] == d("-85.1")
    assert values(spark, [(d(1), d(3))], C.percent(F.col("n"), F.col("m"), 2), wide)[0] == d("33.33")
    assert values(spark, [(d(1), d(0))], C.percent(F.col("n"), F.col("m"), 2), wide)[0] is None


def test_category_leaf(spark):
    cases = ["A >> B >> C", "A", " A >>  >> ", " >> ", "", None]
    assert values(spark, cases, C.category_leaf(F.col("c"))) == ["C", "A", "A", None, None, None]


def test_strip_tags(spark):
    assert values(spark, [" ,a, b ,", "a", ",, ", "", None], C.strip_tags(F.col("c"))) == ["a, b", "a", None, None, None]


def test_product_tags_take_every_shape(spark):
    ddl = "l array<struct<idTag:string,id:string,descricao:string,nome:string>>, t string"
    cases = [
        ([("1", None, "a", None), (None, None, "", "b"), ("7", None, None, ""), (None, "8", None, None), (None, None, None, None)], None),
        ([], '["x"]'),
        (None, '["x","","y"]'),
        (None, '[{"descricao":"x"},{"nome":"y"},{"id":3},{"other":1}]'),
        (None, '["x",{"nome":"y"}]'),
        (None, "[]"),
        (None, "plain, text"),
        (None, None),
    ]
    assert values(spark, cases, C.product_tags(F.col("l"), F.col("t")), ddl) == [
        "a,b,7,8", "", "x,y", "x,y,3", "x,y", "", "plain, text", None,
    ]


def test_date_parts(spark):
    cases = [date(2024, 2, 29), date(2024, 3, 3)]
    assert values(spark, cases, C.date_key(F.col("c")), "c date") == [20240229, 20240303]
    assert values(spark, cases, C.week_of(F.col("c")), "c date") == [date(2024, 2, 26), date(2024, 2, 26)]
    assert values(spark, cases, C.month_of(F.col("c")), "c date") == [date(2024, 2, 1), date(2024, 3, 1)]


# --- predicates ----------------------------------------------------------------


def test_tag_match_takes_wildcards_literally(spark):
    cases = ["Luxo 100%", "base_x", "basexx", None]
    assert values(spark, cases, P.has_any_tag(F.col("c"), "100%")) == [True, False, False, None]
    assert values(spark, cases, P.has_any_tag(F.col("c"), ["BASE_"])) == [False, True, False, None]


def test_end_day_is_included(spark):
    cases = [date(2024, 1, 31), date(2024, 2, 1), date(2023, 12, 31)]
    assert values(spark, cases, P.through_day(F.col("c"), "2024-01-01", "2024-01-31"), "c date") == [True, False, False]


def test_months_window_starts_at_the_month(spark):
    cases = [date(2024, 1, 1), date(2023, 12, 31)]
    assert values(spark, cases, P.since_months(F.col("c"), "2024-06-15", 6), "c date") == [True, False]


@pytest.mark.parametrize(
    "term, mode, expected",
    [
        ("pão", "contains", ["Pao de queijo", "PÃO", "Apaozinho"]),
        ("pao", "exact", ["PÃO"]),
        ("pão", "prefix", ["Pao de queijo", "PÃO"]),
        ("pao", "word", ["Pao de queijo", "PÃO"]),
        ("queijo", "word", ["Pao de queijo"]),
        ("c++ (x)", "contains", ["c++ (x)"]),
        ("a.b", "word", []),
        ("", "exact", ["Pao de queijo", "PÃO", "Apaozinho", "c++ (x)"]),
    ],
)
def test_search_modes(spark, term, mode, expected):
    names = ["Pao de queijo", "PÃO", "Apaozinho", "c++ (x)"]
    df = spark.createDataFrame([(n,) for n in names], "c string")
    assert [r.c for r in df.where(P.matches(F.col("c"), term, mode)).collect()] == expected
