"""Reading and answering question texts, against a plain Python answer."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from salesloom.plans import questions as Q

VOCABULARY = ["caneta", "caneta gel", "agenda", "luxo"]
TEXTS = [
    (1, "Quanto vendi de caneta gel em março de 2024? Quero o total por favor"),
    (2, "Qual foi o faturamento de 2023 considerando todos os produtos da loja"),
    (3, "oi, tudo bem?"),
    (4, "Analise as vendas de agenda ou luxo no mes de maio, por gentileza amigo"),
    (5, "Mostre o produto caneta em janeiro de 2024 na lista completa, sem somar nada"),
    (6, "Melhor produto entre agenda e caneta no ano de 2023, me mostre as linhas"),
    (7, "ping: quero saber o faturamento total da loja no ano de 2024 inteiro"),
    (8, "Quero o relatório do produto xadrez de marco em 2031, com todas as linhas"),
]


@pytest.fixture(scope="module")
def sales(spark):
    rows = []
    for n in range(400):
        tags = ["Caneta Gel, Luxo", "agenda", None, "AGENDA,luxo", "outra"][n % 5]
        rows.append((date(2023 + n % 2, 1 + n % 12, 1 + n % 28), f"p{n % 7}", tags, n % 9, n % 13 + 1))
    return spark.createDataFrame(rows, "day date, product string, tags string, q int, t int").select(
        "day", "product", "tags", F.col("q").cast("decimal(18,4)").alias("qty"), F.col("t").cast("decimal(18,4)").alias("total")
    )


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(TEXTS, "question_id bigint, text string")


def test_small_talk_needs_whole_words(spark):
    filler = " e depois quero o total de vendas da loja inteira"
    cases = {"olá": False, "oi,": False, "oito produtos": True, "olás": True, "teste": False, "quero": True}
    df = spark.createDataFrame([(i, text + filler) for i, text in enumerate(cases)], "question_id int, text string")
    got = [r.uses_data for r in Q.read_questions(df, VOCABULARY).orderBy("question_id").collect()]
    assert got == list(cases.values())


def test_reading(texts):
    read = {r.question_id: r for r in Q.read_questions(texts, VOCABULARY).collect()}
    assert (read[1].year, read[1].month, read[1].tags) == (2024, 3, ["caneta", "caneta gel"])
    assert (read[2].year, read[2].month, read[2].tags, read[2].wants_totals) == (2023, None, [], True)
    assert not read[3].uses_data and not read[7].uses_data
    assert (read[4].month, read[4].tags, read[4].wants_totals) == (5, ["agenda", "luxo"], True)
    assert not read[5].wants_totals and read[5].month == 1
    assert (read[8].month, read[8].year) == (3, 2031)


def brute(sales, read):
    for s in sales:
        tags = (s.tags or "").lower()
        if read.tags and not any(t in tags for t in read.tags):
            continue
        if read.year and s.day.year != read.year:
            continue
        if read.month and s.day.month != read.month:
            continue
        yield s


def test_answers_equal_brute_force(spark, sales, texts):
    read = {r.question_id: r for r in Q.read_questions(texts, VOCABULARY).collect()}
    rows = sales.collect()
    answers = {r.question_id: r for r in Q.answer_questions(texts, sales, VOCABULARY).collect()}
    assert set(answers) == set(read)
    for key, question in read.items():
        hits = list(brute(rows, question))
        if not question.uses_data:
            assert answers[key].revenue is None and answers[key].lines is None
            continue
        assert answers[key].lines == len(hits)
        assert answers[key].revenue == (sum(h.total for h in hits) if hits else None)
        one = Q.sales_question(sales, question.tags, question.year, question.month).first()
        assert (one.revenue, one.lines) == (answers[key].revenue, answers[key].lines)


def test_lines_equal_brute_force(sales, texts):
    read = {r.question_id: r for r in Q.read_questions(texts, VOCABULARY).collect()}
    rows = sales.collect()
    got = {}
    for r in Q.question_lines(texts, sales, VOCABULARY, limit=4).orderBy("question_id", "position").collect():
        got.setdefault(r.question_id, []).append((r.day, r["product"], r.revenue))
    for key, question in read.items():
        if question.uses_data and not question.wants_totals:
            hits = sorted((h.day, h["product"], h.total) for h in brute(rows, question))[:4]
            assert got.get(key, []) == hits
        else:
            assert key not in got


def test_sums_of_lines_list_no_line(sales, texts):
    from tests.test_plans import plan_of

    listed = Q.question_lines(texts, sales, VOCABULARY).groupBy("question_id").agg(F.count(F.lit(1)).alias("lines"), F.sum("revenue").alias("revenue"))
    summed = Q.question_lines(texts, sales, VOCABULARY, summed=True)
    assert listed.count() and sorted(map(tuple, summed.collect())) == sorted(map(tuple, listed.collect()))
    assert "product" not in plan_of(summed)  # cells of a tag text and a month, not lines


def test_single_question_lines(sales):
    lines = Q.sales_question(sales, ["luxo"], 2024, 6, aggregate=False).collect()
    assert lines and [r.day for r in lines] == sorted(r.day for r in lines)
    assert all("luxo" in r.tags.lower() and (r.day.year, r.day.month) == (2024, 6) for r in lines)
