"""A training-data pipeline over ``documents``.

Language identification, near-duplicate removal, redaction of personal data, mixing of
the sources and packing into sequences. Every stage takes all rows that the one before
left, and all but the last return the columns of ``documents``, whatever other columns
there are. Null, empty and repeated rows: texts without a letter leave in the first
stage; rows equal in id and text count as copies; a null id is never a duplicate.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.llm import jaccard_join, langid, mixing, packing, pii
from salesloom.llm.common import discard, recorded, stored, table
from salesloom.llm.queries import tokenizer_json

# Share of a text that its main language must hold.
MIN_SHARE = 0.4


def _numbered(docs: DataFrame) -> list[str]:
    """Names for the carried columns that clash with none of an operator's own."""
    return [f"_c{place}" for place in range(len(docs.columns))]


def _named(docs: DataFrame) -> list:
    return [F.col(f"`{name}`") for name in docs.columns]


_left: list[DataFrame] = []


def _stage(function):
    """A stage that discards what the one before it stored on its way, which nothing reads any
    more once that one's result is written. So a result must be written before the next
    stage is called."""

    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        discard(*_left)
        _left.clear()
        with recorded() as frames:
            made = function(spark, docs, sf_dir)
        _left.extend(frames)
        return made

    return run_stage


@_stage
def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter, and those of which no language holds ``MIN_SHARE``."""
    carried = _numbered(docs)
    languages = langid.learn(docs.where(langid.fold(F.col("doc_id"), 4) != 2))
    rows = docs.select(*[c.alias(n) for c, n in zip(_named(docs), carried, strict=True)], F.col("text"))
    judged = langid.predict(rows, languages, carried)
    kept = judged.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= MIN_SHARE))
    return kept.select(*[F.col(n).alias(name) for n, name in zip(carried, docs.columns, strict=True)])


@_stage
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document stays of each group of linked ones: the one with the smallest id."""
    _, found = jaccard_join.link_documents(docs)
    gone = stored(found.where("node <> component").select(F.col("node").alias("_gone")))
    kept = docs.join(gone, F.col("doc_id") == F.col("_gone"), "left_anti")
    repeated = stored(docs.groupBy("doc_id").count().where("count > 1 and doc_id is not null").select(F.col("doc_id").alias("_twice")))
    if repeated.isEmpty():
        return kept
    same = F.col("doc_id") == F.col("_twice")
    once = kept.join(repeated, same, "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.join(repeated, same, "left_anti").unionByName(once)


@_stage
def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each span of personal data gives way to its kind in brackets; ``n_chars`` follows."""
    carried = _numbered(docs)
    rows = docs.select(
        *[c.alias(n) for c, n, name in zip(_named(docs), carried, docs.columns, strict=True) if name != "text"],
        F.col("text"), F.col("text").isNull().alias("_none"),
    )
    keep = [c for c in rows.columns if c != "text"]
    found = pii.find_spans(rows, keep, with_text=True)
    text = F.when(~F.col("_none"), pii.redact(F.col("_text"), F.col("_spans")))
    changed = F.size("_spans") > 0

    def column(n: str, name: str):
        if name == "text":
            return text.alias(name)
        if name == "n_chars":
            return F.when(changed, F.length(text).cast(docs.schema[name].dataType)).otherwise(F.col(n)).alias(name)
        return F.col(n).alias(name)

    return found.select(*[column(n, name) for n, name in zip(carried, docs.columns, strict=True)])


@_stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as its source's draw takes it. Rows are told apart by their place in
    the table, so those that share id and size have draws of their own."""
    carried = _numbered(docs)
    rows = docs.select(*[c.alias(n) for c, n in zip(_named(docs), carried, strict=True)], F.monotonically_increasing_id().alias("_row"))
    own = dict(zip(docs.columns, carried, strict=True))
    read = rows.select("_row", *[F.col(own[name]).alias(name) for name in ("doc_id", "source", "text")])
    drawn = mixing.mix(read, keep=["_row"]).where("taken > 0")
    copies = drawn.select(F.col("_row").alias("_drawn"), (F.col("taken") / F.col("size")).cast("int").alias("_copies"))
    met = rows.join(copies, F.col("_row") == F.col("_drawn")).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return met.select(*[F.col(n).alias(name) for name, n in own.items()])


@_stage
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences with their token ids."""
    return packing.pack(docs, tokenizer_json())


STAGES = [
    ("language_id", keep_known_languages),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", redact_personal_data),
    ("source_mix", mix_sources),
    ("packing", pack_sequences),
]

#: Language inference, redaction and tokenizing can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written as Parquet and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = stored(docs)
    return docs
