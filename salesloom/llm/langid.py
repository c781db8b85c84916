"""Language identification by multilingual mixture inference.

Training counts the character trigrams of each language's documents, hashed into
``BUCKETS`` places: tasks count in numpy, Spark adds up. Every trigram has a letter in
its middle; text is lower-cased and everything but letters counts as one blank. The
likelihood table has ``BUCKETS`` x languages entries, whatever the size of the corpus.

A text is a mixture: each trigram comes from one of its languages. Expectation-
maximisation estimates the proportions, for the best language alone, then with the next
ones added in the order of their weight in the mixture of all. A larger set is taken while
twice its gain in log likelihood is over ``penalty * log(trigrams)``. The prediction is
the set's language of the largest proportion, and the score that proportion.

Defined cases: null text or one without a letter is ``und`` with score 0, and so is every
text if nothing was learned; equal proportions go to the first language by name; a null
``doc_id`` is neither learned from nor held out; repeated rows are predicted each; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 17
SMOOTHING = 0.05
PENALTY = 4.0
STEPS = 25
UNKNOWN = "und"


@cache
def letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(point).isalpha() for point in range(0x110000)), bool, 0x110000)


def trigram_buckets(text: str | None) -> np.ndarray:
    """Buckets of the trigrams around each letter of the whole text."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    if not len(points):
        return np.zeros(0, np.int64)
    is_letter = letters()[points]
    padded = np.zeros(len(points) + 2, np.uint64)
    padded[1:-1] = np.where(is_letter, points, 0)
    mixed = padded[:-2] * np.uint64(0x9E3779B1) + padded[1:-1] * np.uint64(0x85EBCA77C2B2AE63) + padded[2:] * np.uint64(0xC2B2AE3D27D4EB4F)
    mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(0x9FB21C651E98DF25)
    return (mixed >> np.uint64(40)).astype(np.int64)[is_letter] % BUCKETS


def count_trigrams(labelled: DataFrame) -> DataFrame:
    """lang, bucket, n over the whole texts of the given documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column("text"), batch.column("lang").to_pylist(), strict=True):
                n = held.setdefault(lang, np.zeros(BUCKETS, np.int64))
                found = trigram_buckets(text.as_py())
                np.add.at(n, found, 1)
        for lang, n in held.items():
            found = np.flatnonzero(n)
            columns = [pa.array([lang] * len(found), pa.string()), pa.array(found), pa.array(n[found])]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "bucket", "n"])

    counted = labelled.select("lang", "text").mapInArrow(count, "lang string, bucket long, n long")
    return counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


class Languages:
    """Names in order, and the likelihood of each bucket in each of them."""

    def __init__(self, counts: pa.Table):
        self.names = sorted(set(counts.column("lang").to_pylist()))
        n = np.zeros((BUCKETS, max(1, len(self.names))))
        column = {name: place for place, name in enumerate(self.names)}
        where = [column[name] for name in counts.column("lang").to_pylist()]
        n[counts.column("bucket").to_numpy(), where] = counts.column("n").to_numpy()
        self.p = ((n + SMOOTHING) / (n.sum(axis=0) + SMOOTHING * BUCKETS)).astype(np.float32)


def proportions(p: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, float]:
    """Mixture weights by expectation-maximisation, and the log likelihood they give."""
    weights = np.full(p.shape[1], 1.0 / p.shape[1])
    total = n.sum()
    for _ in range(STEPS):
        shares = p * weights
        moved = (n / shares.sum(axis=1)) @ shares / total
        settled = np.abs(moved - weights).max() < 1e-3
        weights = moved
        if settled:
            break
    return weights, float(n @ np.log(p @ weights))


def infer(text: str | None, languages: Languages, penalty: float = PENALTY) -> tuple[list[str], list[float]]:
    """The text's languages and their proportions, largest first; empty if unknown."""
    found = trigram_buckets(text)
    if not len(found) or not languages.names:
        return [], []
    buckets, n = np.unique(found, return_counts=True)
    p = languages.p[buckets].astype(float)
    single = n @ np.log(p)
    best = int(np.argmax(single))
    chosen, weights, likelihood = [best], np.ones(1), float(single[best])
    if len(languages.names) > 1:
        every, _ = proportions(p, n)
        others = [k for k in np.argsort(-every, kind="stable") if k != best]
        for k in others:
            tried, gained = proportions(p[:, [*chosen, k]], n)
            if 2 * (gained - likelihood) <= penalty * np.log(len(found)):
                break
            chosen, weights, likelihood = [*chosen, int(k)], tried, gained
    ranked = sorted(zip(weights, chosen, strict=True), key=lambda x: (-x[0], x[1]))
    return [languages.names[k] for _, k in ranked], [float(min(1.0, w)) for w, _ in ranked]


def learn(labelled: DataFrame) -> Languages:
    """From documents with text and lang; at most ``BUCKETS`` rows a language come to the driver."""
    known = labelled.where("text is not null and lang is not null")
    return Languages(count_trigrams(known).toArrow())


def predict(docs: DataFrame, languages: Languages, keep: list[str], penalty: float = PENALTY) -> DataFrame:
    """``keep`` columns with lang_pred, score, languages and proportions."""
    shared = docs.sparkSession.sparkContext.broadcast(languages)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    schema = f"{fields}, lang_pred string, score double, languages array<string>, proportions array<double>"

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            inferred = [infer(text.as_py(), shared.value, penalty) for text in batch.column("_text")]
            columns = [
                *[batch.column(name) for name in keep],
                pa.array([names[0] if names else UNKNOWN for names, _ in inferred], pa.string()),
                pa.array([shares[0] if shares else 0.0 for _, shares in inferred], pa.float64()),
                pa.array([names for names, _ in inferred], pa.list_(pa.string())),
                pa.array([shares for _, shares in inferred], pa.list_(pa.float64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "lang_pred", "score", "languages", "proportions"])

    return docs.select(*keep, F.col("text").alias("_text")).mapInArrow(judge, schema)


def fold(doc_id: Column, folds: int) -> Column:
    """Checksum of the id as text, modulo ``folds``."""
    return F.crc32(doc_id.cast("string")) % folds


def identify(docs: DataFrame, folds: int = 4, held: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred, score, languages, proportions of every document."""
    part = fold(F.col("doc_id"), folds)
    languages = learn(docs.where(part != held))
    predicted = predict(docs, languages, ["doc_id"])
    return predicted.withColumn("held_out", F.coalesce(part == held, F.lit(False)))
