"""Answers to sales questions: one given as filters, or a table of texts.

The texts are Portuguese. The tags to look for are a parameter: a list or a table of any
size. Texts and tags meet by equality joins (``operators.grams``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesloom.functions import cleanse as C
from salesloom.functions import predicates as P
from salesloom.operators.grams import contained, spread_by
from salesloom.operators.lineage import materialized

# Month names in the order they are looked for, with their number.
MONTH_NAMES = (
    ("janeiro", 1), ("fevereiro", 2), ("marco", 3), ("março", 3), ("abril", 4), ("maio", 5),
    ("junho", 6), ("julho", 7), ("agosto", 8), ("setembro", 9), ("outubro", 10),
    ("novembro", 11), ("dezembro", 12),
)
# Words that ask for totals.
TOTAL_WORDS = ("quanto", "total", "faturamento", "vendi", "vendas")
# What makes a text a data question.
SMALL_TALK_LENGTH = 40
GREETINGS = ("oi", "olá", "ola", "teste", "testando", "ping", "funciona", "você funciona", "vc funciona")
ANALYSIS_WORDS = (
    "analise", "análise", "relatório", "resumo", "insights", "tendência", "tendencias", "vendas",
    "faturamento", "receita", "lucro", "margem", "ticket", "listagem", "categoria",
    "produto", "top", "ranking", "comparar", "comparação", "comparacao", "vale mais a pena",
    "melhor", "pior", "vs", "versus",
)
COMPARISON_WORDS = (" ou ", " vs ", "versus", "vale mais a pena")

# A greeting as the first whole word; accented letters are part of a word.
SMALL_TALK = rf"^({'|'.join(GREETINGS)})($|[^\p{{L}}\p{{N}}_])"


def sales_question(
    sales: DataFrame,
    tags: Sequence[str] = (),
    year: int | None = None,
    month: int | None = None,
    aggregate: bool = True,
) -> DataFrame:
    """Totals, or the matching lines by day, of enriched sales."""
    rows = sales
    if tags:
        rows = rows.where(P.has_any_tag(F.col("tags"), tags))
    rows = rows.where(P.in_year_month(F.col("day"), year, month))
    if aggregate:
        lines = F.sum("lines") if "lines" in sales.columns else F.count(F.lit(1))
        return rows.agg(
            F.sum("total").alias("revenue"),
            F.sum("qty").alias("qty"),
            F.coalesce(lines, F.lit(0)).cast("bigint").alias("lines"),
        )
    return rows.select("day", "product", "tags", "qty", F.col("total").alias("revenue")).orderBy("day")


# --- reading the texts --------------------------------------------------------


def contains_any(text: Column, words: Sequence[str]) -> Column:
    return C.any_of(F.contains(text, F.lit(word)) for word in words)


def vocabulary_table(spark: SparkSession, vocabulary: Sequence[str] | DataFrame) -> DataFrame:
    """Distinct tags, in column ``term``; of a table the first column is taken."""
    if isinstance(vocabulary, DataFrame):
        return vocabulary.select(F.col(vocabulary.columns[0]).cast("string").alias("term")).where("term <> ''").distinct()
    return spark.createDataFrame([(tag,) for tag in sorted(set(vocabulary))], "term string")


def named_month(text: Column) -> Column:
    """Number of the first month name, in calendar order, that a text contains."""
    first = F.when(F.contains(text, F.lit(MONTH_NAMES[0][0])), MONTH_NAMES[0][1])
    for name, number in MONTH_NAMES[1:]:
        first = first.when(F.contains(text, F.lit(name)), number)
    return first


def read_questions(questions: DataFrame, vocabulary: Sequence[str] | DataFrame) -> DataFrame:
    """What each question text asks for: year, month, tags (sorted), totals or lines, and
    whether it needs data at all. ``question_id`` identifies a question."""
    lowered = questions.select("question_id", F.lower(F.trim("text")).alias("text"))
    lowered = spread_by(lowered, "question_id")
    named = contained(lowered, "question_id", "text", vocabulary_table(questions.sparkSession, vocabulary))
    # A question's tags are few: those its own text contains.
    tags = named.groupBy("question_id").agg(F.sort_array(F.collect_set("term")).alias("tags"))
    text = F.col("text")
    year = F.regexp_extract(text, r"20\d{2}", 0)
    small_talk = (F.length(text) <= SMALL_TALK_LENGTH) | text.rlike(SMALL_TALK)
    wants_data = contains_any(text, ANALYSIS_WORDS) | contains_any(text, COMPARISON_WORDS)
    read = lowered.select(
        "question_id",
        F.nullif(year, F.lit("")).cast("int").alias("year"),
        named_month(text).alias("month"),
        contains_any(text, TOTAL_WORDS).alias("wants_totals"),
        (~small_talk & wants_data).alias("uses_data"),
    )
    none = F.array().cast("array<string>")
    return read.join(tags, "question_id", "left").select(
        "question_id", "year", "month", F.coalesce("tags", none).alias("tags"), "wants_totals", "uses_data"
    )


# --- answering them -----------------------------------------------------------

_COMBO = ["tags", "q_year", "q_month"]


def _as_filters(read: DataFrame) -> DataFrame:
    """Questions with their calendar filter as a key; stored, because they are read twice."""
    return materialized(read.withColumns({"q_year": F.coalesce("year", F.lit(0)), "q_month": F.coalesce("month", F.lit(0))}))


def _unions(combos: DataFrame, held: DataFrame, vocabulary: Sequence[str] | DataFrame) -> DataFrame:
    """tags, held: for every set of tags asked for, the tag texts of sales that hold one of
    them, once each: the union of the tags' postings."""
    texts = held.select("held", F.lower("held").alias("text")).distinct()
    postings = contained(texts, "held", "text", vocabulary_table(held.sparkSession, vocabulary))
    asked = combos.select("tags").distinct().select("tags", F.explode("tags").alias("term"))
    return asked.join(postings, "term").select("tags", "held").distinct()


def _calendar_keys(day: Column) -> Column:
    """The four calendar filters a day satisfies; 0 stands for any."""
    year, month = F.year(day), F.month(day)
    pairs = [(year, month), (year, F.lit(0)), (F.lit(0), month), (F.lit(0), F.lit(0))]
    return F.array(*[F.struct(y.alias("q_year"), m.alias("q_month")) for y, m in pairs])


_SUMS = ["revenue", "qty", "lines"]


def _added() -> list[Column]:
    return [F.sum(name).alias(name) for name in _SUMS]


def _held_text() -> Column:
    return F.coalesce("tags", F.lit("")).alias("held")


def answer_questions(questions: DataFrame, sales: DataFrame, vocabulary: Sequence[str] | DataFrame) -> DataFrame:
    """Totals for every question, in one job.

    Sales are summed once by tag text and month. A tag has a posting of the tag texts that
    contain it; the texts of a question are the union of its tags' postings, and its
    answer is the sum of their cells. A question without tags takes the sums of all texts.
    """
    asked = _as_filters(read_questions(questions, vocabulary))
    combos = asked.where("uses_data").select(*_COMBO).distinct()
    lines = F.sum("lines") if "lines" in sales.columns else F.count(F.lit(1))
    # Read several times below, so the sales are summed into a few stored rows once.
    months = materialized(
        sales.groupBy(_held_text(), C.month_of(F.col("day")).alias("month_start")).agg(
            F.sum("total").alias("revenue"), F.sum("qty").alias("qty"), lines.alias("lines")
        )
    )

    def by_calendar(cells: DataFrame, *keys: str) -> DataFrame:
        each = cells.withColumn("key", F.explode(_calendar_keys(F.col("month_start"))))
        return each.groupBy(*keys, "key.q_year", "key.q_month").agg(*_added())

    tagged = (
        combos.join(_unions(combos, months, vocabulary), "tags")
        .join(by_calendar(months, "held"), ["held", "q_year", "q_month"])
        .groupBy(*_COMBO)
        .agg(*_added())
    )
    whole = by_calendar(months.groupBy("month_start").agg(*_added()))
    untagged = combos.where(F.size("tags") == 0).join(whole, ["q_year", "q_month"]).select(*_COMBO, *_SUMS)
    answers = tagged.unionByName(untagged)
    return asked.join(answers, _COMBO, "left").select(
        "question_id",
        "year",
        "month",
        F.array_join("tags", ",").alias("tags"),
        "wants_totals",
        "uses_data",
        F.when(F.col("uses_data"), F.col("revenue")).alias("revenue"),
        F.when(F.col("uses_data"), F.col("qty")).alias("qty"),
        F.when(F.col("uses_data"), F.coalesce("lines", F.lit(0))).alias("lines"),
    )


def question_lines(
    questions: DataFrame, sales: DataFrame, vocabulary: Sequence[str] | DataFrame, limit: int | None = None,
    summed: bool = False,
) -> DataFrame:
    """All lines for every question that asks for lines; with a ``limit``, the first
    ones by day and their position; ``summed``, how many there are and their revenue, for
    the questions that get any. Those are sums of whole cells, so each line is added up once
    in its cell and no line is listed for a question.

    Sales lie in cells of a tag text and a month, of which there are few. Every distinct
    filter is first turned into its cells, and lines meet filters by the cell, so a line is
    read once and no key holds more than one month of one tag text. With a limit, only the
    first lines of each cell are kept before that: a line outside them cannot be among the
    first of a filter that includes the cell.
    """
    asked = _as_filters(read_questions(questions, vocabulary)).where("uses_data and not wants_totals")
    combos = asked.select(*_COMBO).distinct()
    order = [F.col("day"), F.col("product"), F.col("revenue"), F.col("qty"), F.col("line_tags")]
    each = sales.select(
        _held_text(), C.month_of(F.col("day")).alias("month_start"), "day", "product", F.col("tags").alias("line_tags"), "qty",
        F.col("total").alias("revenue"),
    )
    cell = ["held", "month_start"]
    if summed:
        each = materialized(each.groupBy(*cell).agg(F.count(F.lit(1)).alias("lines"), F.sum("revenue").alias("revenue")))
    elif limit is not None:
        numbered = each.withColumn("n", F.row_number().over(Window.partitionBy(*cell).orderBy(*order)))
        each = materialized(numbered.where(F.col("n") <= limit).drop("n"))
    cells = materialized(each.select(*cell).distinct())
    calendar = cells.withColumn("key", F.explode(_calendar_keys(F.col("month_start")))).select(*cell, "key.q_year", "key.q_month")
    tagged = combos.join(_unions(combos, cells, vocabulary), "tags").join(calendar, ["held", "q_year", "q_month"])
    untagged = combos.where(F.size("tags") == 0).join(calendar, ["q_year", "q_month"])
    wanted = tagged.select(*_COMBO, *cell).unionByName(untagged.select(*_COMBO, *cell))
    found = wanted.join(each, cell).drop(*cell)
    if summed:
        totals = found.groupBy(*_COMBO).agg(F.sum("lines").alias("lines"), F.sum("revenue").alias("revenue"))
        return asked.join(totals, _COMBO).select("question_id", "lines", "revenue")
    columns = ["day", "product", "line_tags", "qty", "revenue"]
    if limit is None:
        return asked.join(found, _COMBO).select("question_id", *columns)
    position = F.row_number().over(Window.partitionBy(*_COMBO).orderBy(*order))
    first = found.withColumn("position", position).where(F.col("position") <= limit)
    return asked.join(first, _COMBO).select("question_id", "position", *columns)
