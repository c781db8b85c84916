"""Ranked lexical search by hashed max-sketches.

A term's impact in a document depends on its occurrences and the document's length. The
impacts of a document are folded into a sketch of ``SKETCH`` cells, each the greatest
impact of the terms that hash to it. A batch of items looks its terms up in the sketches
of a slice of documents: the weighted sum of the cells is an upper bound of a document's
score, since another term in a cell can only raise it. Documents are then scored exactly
in descending order of their bounds, until a bound lies below the score that the last
place of the item's list has reached so far. No document that belongs to a list is lost.

Items are taken in blocks of about ``BLOCK_TERMS`` terms, so what is sent to the tasks is
bounded; each block reads the documents twice, for the counts of its terms and for the
search. A task sends its own best documents of each item; Spark merges them.

Defined cases: null and empty texts have no terms; such documents count in no statistic and
are in no list; very long texts are taken in spans of about ``SPAN`` bytes, cut between
terms; rows that repeat are documents of their own, in the order of equal scores; a null
``doc_id`` comes last among equal scores. Benchmark rows of one ``item_id`` (null too) are
one item with the terms of all of them; an item without terms or found in no document has
no rows; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
import re
import zlib
from bisect import insort
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesloom.llm.common import LOWER, UPPER, ascii_lower, slices, stored

SKETCH = 4096
BLOCK_TERMS = 100_000
# Cells looked up at once, over all documents of a slice.
LOOKUPS = 1 << 22
SPAN = 1 << 20
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# The same on UTF-8, whose bytes beyond ASCII all belong to terms.
_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
_BETWEEN = re.compile(rb"[^0-9a-z\x80-\xff]")
_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())


def spans(text: str | None) -> Iterator[list[bytes]]:
    """Terms of a text with repeats, span by span."""
    data = (text or "").encode().translate(_LOWER)
    begin = 0
    while begin < len(data):
        border = _BETWEEN.search(data, begin + SPAN)
        end = border.start() if border else len(data)
        yield _TERM.findall(data, begin, end)
        begin = end


@dataclass
class Block:
    """Items of a block: their ids, and terms one item after the other."""

    ids: list
    begins: np.ndarray
    terms: list[bytes]

    def weighed(self, n_docs: int, found: dict[bytes, int]) -> list[int]:
        return [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * found.get(term, 0) + 1))) for term in self.terms]


def item_terms(items: DataFrame) -> DataFrame:
    """item_id, term: the distinct terms of each item."""
    terms = F.array_distinct(F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(TERM), F.lit(0)))
    return items.select("item_id", F.explode(terms).alias("term")).distinct()


def blocks(items: DataFrame, block_terms: int = BLOCK_TERMS) -> Iterator[Block]:
    """Whole items in blocks of about ``block_terms`` terms (one item's at least)."""
    terms = stored(item_terms(items))
    count = -(-terms.count() // block_terms)
    number = F.pmod(F.xxhash64("item_id"), F.lit(max(count, 1)))
    for block in range(count):
        # A block has a bounded number of terms, so it fits the driver and each task.
        rows = terms.where(number == block).groupBy("item_id").agg(F.sort_array(F.collect_list("term")).alias("terms")).collect()
        if rows:
            sizes = np.array([len(row.terms) for row in rows])
            yield Block([row.item_id for row in rows], np.cumsum(sizes) - sizes, [term.encode() for row in rows for term in row.terms])


def corpus_counts(docs: DataFrame, terms: list[bytes]) -> tuple[int, int, dict[bytes, int]]:
    """Documents with a term, all terms with repeats, and the documents that hold each of ``terms``."""
    wanted = docs.sparkSession.sparkContext.broadcast(frozenset(terms))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, n_docs, n_terms = Counter(), 0, 0
        for batch in (part for held in batches for part in slices(held, "text")):
            for text in batch.column("text"):
                held, n = set(), 0
                for terms in spans(text.as_py()):
                    n += len(terms)
                    held.update(wanted.value.intersection(terms))
                found.update(held)
                n_docs, n_terms = n_docs + (n > 0), n_terms + n
        yield pa.RecordBatch.from_pylist(
            [{"term": None, "n": n_docs, "of": n_terms}, *({"term": term, "n": n, "of": 0} for term, n in found.items())],
            pa.schema([("term", pa.binary()), ("n", pa.int64()), ("of", pa.int64())]),
        )

    rows = docs.select("text").mapInArrow(count, "term binary, n long, of long")
    # One row for each term of the block.
    totals = {row.term and bytes(row.term): row for row in rows.groupBy("term").agg(F.sum("n").alias("n"), F.sum("of").alias("of")).collect()}
    whole = totals.pop(None, None)
    return (whole.n, whole.of, {term: row.n for term, row in totals.items()}) if whole else (0, 0, {})


class Cells(dict):
    """The sketch cell of a term; remembers up to a million."""

    def __missing__(self, term: bytes) -> int:
        cell = zlib.crc32(term) % SKETCH
        if len(self) >= 1_000_000:
            self.clear()
        self[term] = cell
        return cell


def sketches(counts: list[Counter], sizes: np.ndarray, cells: Cells) -> np.ndarray:
    """One row of ``SKETCH`` cells per document: the greatest impact of the terms in a cell."""
    row = np.repeat(np.arange(len(counts)), [len(count) for count in counts])
    cell = np.array([cells[term] for count in counts for term in count], np.int64)
    times = np.array([n for count in counts for n in count.values()], np.int64)
    impact = 1_000_000_000 * times // (1000 * times + 8 * sizes[row])
    rising = np.argsort(impact, kind="stable")
    folded = np.zeros((len(counts), SKETCH), np.int32)
    folded[row[rising], cell[rising]] = impact[rising]  # the last of equal places stays
    return folded


def best_documents(docs: DataFrame, block: Block, k: int) -> DataFrame:
    """item (its number in the block), doc_id, score: each task's own best."""
    n_docs, n_terms, found = corpus_counts(docs, block.terms)
    weights = block.weighed(n_docs, found)
    shared = docs.sparkSession.sparkContext.broadcast((block.begins, block.terms, weights, n_docs, n_terms))
    id_type = docs.schema["doc_id"].dataType

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begins, terms, weights, n_docs, n_terms = shared.value
        cells, weighed = Cells(), np.array(weights, np.int64)
        places = np.array([cells[term] for term in terms], np.int64)
        ends = [*begins[1:].tolist(), len(terms)]
        asked = [list(zip(terms[a:b], weights[a:b], strict=True)) for a, b in zip(begins.tolist(), ends, strict=True)]
        lists: list[list] = [[] for _ in asked]
        least = np.ones(len(asked), np.int64)  # a score that a document needs at least

        for batch in (part for held in batches for part in slices(held, "text", rows=max(1, LOOKUPS // max(len(terms), SKETCH)))):
            counts, sizes, ids = [], [], []
            for text, doc_id in zip(batch.column("text"), batch.column("doc_id"), strict=True):
                count = Counter()
                for held in spans(text.as_py()):
                    count.update(held)
                if count:
                    n = sum(count.values())
                    counts.append(count)
                    sizes.append(10 + 90 * n * n_docs // n_terms)
                    ids.append(doc_id.as_py())
            if not counts:
                continue
            looked_up = sketches(counts, np.array(sizes, np.int64), cells)[:, places]
            bounds = np.add.reduceat(looked_up * weighed, begins, axis=1)
            hopeful = bounds >= least
            for item in np.flatnonzero(hopeful.any(axis=0)).tolist():
                rows = np.flatnonzero(hopeful[:, item])
                best = lists[item]
                for row in rows[np.argsort(-bounds[rows, item], kind="stable")].tolist():
                    if bounds[row, item] < least[item]:
                        break
                    count, size = counts[row], 8 * sizes[row]
                    score = sum(weight * (1_000_000_000 * n // (1000 * n + size)) for term, weight in asked[item] if (n := count[term]))
                    if score >= least[item]:
                        insort(best, (-score, ids[row] is None, ids[row] or 0))
                        del best[k:]
                        if len(best) == k:
                            least[item] = -best[-1][0]
        rows = [(item, None if no_id else doc_id, -score) for item, best in enumerate(lists) for score, no_id, doc_id in best]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(column), kind) for column, kind in zip(zip(*rows, strict=True) if rows else ((), (), ()), kinds, strict=True)],
            ["item", "doc_id", "score"],
        )

    kinds = [pa.int32(), pa.string() if id_type.typeName() == "string" else pa.int64(), pa.int64()]
    schema = f"item int, doc_id {id_type.simpleString() if id_type.typeName() == 'string' else 'bigint'}, score bigint"
    return docs.select("doc_id", "text").mapInArrow(search, schema)


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of each item."""
    spark = docs.sparkSession
    id_type = items.schema["item_id"].dataType.simpleString()
    found = spark.createDataFrame([], f"item_id {id_type}, doc_id {docs.schema['doc_id'].dataType.simpleString()}, score bigint")
    for block in blocks(items):
        names = spark.createDataFrame(list(enumerate(block.ids)), f"item int, item_id {id_type}")
        best = best_documents(docs, block, k).join(F.broadcast(names), "item").select("item_id", "doc_id", "score")
        found = found.unionByName(stored(best))
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
