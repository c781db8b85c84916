"""Which texts contain which terms, by equality joins on short runs of characters."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.operators.lineage import broadcast_if_small, materialized

GRAM = 3
# Listed for texts with a character that is no printable ASCII.
ODD = ""
# Rows and characters of a segment at most, but for one text that is longer.
SEGMENT_ROWS, SEGMENT_CHARS = 1 << 12, 1 << 21


def grams(text: Column, size: int = GRAM) -> Column:
    """The distinct runs of ``size`` characters of a text; none where it is shorter."""
    # A look-ahead consumes nothing, so every place of the text gives a match.
    return F.array_distinct(F.regexp_extract_all(text, F.lit(rf"(?s)(?=(.{{{size}}}))"), F.lit(1)))


def spread_by(df: DataFrame, key: str) -> DataFrame:
    """Rows dealt to all shuffle tasks by their key."""
    return df.repartition(max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))), key)


def key_grams(terms: DataFrame) -> DataFrame:
    """term, gram: of each term's grams the one that the fewest terms hold, so that a gram
    all terms begin with finds nothing in vain. A term shorter than a gram is its own."""
    held = terms.select("term", F.explode(grams(F.col("term"))).alias("gram"))
    sharing = held.groupBy("gram").agg(F.count(F.lit(1)).alias("sharing"))
    rarest = held.join(sharing, "gram").groupBy("term").agg(F.min(F.struct("sharing", "gram")).alias("rarest"))
    short = terms.where(F.char_length("term").between(1, GRAM - 1)).select("term", F.col("term").alias("gram"))
    return rarest.select("term", "rarest.gram").unionByName(short)


def contained(texts: DataFrame, key: str, text: str, terms: DataFrame) -> DataFrame:
    """key, term: every term that a text contains, once. ``key`` identifies a text; null and
    empty terms are in none. ``terms`` has the distinct terms in column ``term``.

    Texts send their grams and keys to the terms' key grams; what meets is looked up in the
    text itself. Nothing grows with texts times terms. Texts are dealt out by key first: the
    last join needs them so, and a few large files of texts keep all tasks busy.
    """
    texts = spread_by(texts, key)
    terms = terms.where("term <> ''")
    lengths = terms.where(F.char_length("term") < GRAM).select(F.char_length("term")).distinct().collect()
    sizes = [GRAM, *sorted(row[0] for row in lengths)]  # three numbers at most
    runs = F.concat(*[grams(F.col(text), size) for size in sizes])
    keys = broadcast_if_small(materialized(key_grams(terms)))
    met = texts.select(key, F.explode(runs).alias("gram")).join(keys, "gram").select(key, "term").distinct()
    return met.join(texts.select(key, text), key).where(F.contains(F.col(text), F.col("term"))).select(key, "term")


def gram_lists(texts: DataFrame) -> DataFrame:
    """segment, gram, places and segment, kinds, ids of texts (kind, id, text).

    A segment is some consecutive rows of a task. For each gram there is one row with the
    places, from 0, of the segment's texts that hold it, and for the segment itself one row
    without a gram, with the kinds and ids by place. So nothing is shuffled or sorted for
    each gram of each text.
    """

    def listed(rows: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The grams, where each one's places begin (one more at the end), and the places."""
        lengths = [len(text or "") for text in rows]
        points = np.frombuffer("".join(text or "" for text in rows).encode("utf-32-le"), "<u4")
        owner = np.repeat(np.arange(len(rows)), lengths)
        odd = np.unique(owner[(points < 0x20) | (points > 0x7E)])
        counts = np.bincount(points)
        letters = np.flatnonzero(counts)
        code = (np.cumsum(counts > 0) - 1)[points]
        base, n = len(letters), len(rows)
        same = owner[: -GRAM + 1] == owner[GRAM - 1 :]
        keys = np.zeros(len(same), np.int64)
        for at in range(GRAM):
            keys = keys * base + code[at : at + len(same)]
        known = None
        if base**GRAM * n >= 1 << 63:  # far more letters than a text of one language has
            known, keys = np.unique(keys, return_inverse=True)
        held = keys[same] * n + owner[: -GRAM + 1][same]
        held.sort()
        held = held[np.diff(held, prepend=-1) != 0]
        keys, places = held // n, held % n
        starts = np.flatnonzero(np.diff(keys, prepend=-1))
        found = keys[starts] if known is None else known[keys[starts]]
        runs = np.column_stack([letters[found // base ** (GRAM - 1 - at) % base] for at in range(GRAM)]) if base else np.zeros((0, GRAM), "<u4")
        text = runs.astype("<u4").tobytes().decode("utf-32-le")
        grams = [text[at : at + GRAM] for at in range(0, len(text), GRAM)]
        bounds = np.append(starts, len(places))
        if len(odd):
            grams, places, bounds = [*grams, ODD], np.append(places, odd), np.append(bounds, len(places) + len(odd))
        return grams, bounds, places

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment = TaskContext.get().partitionId() << 32
        for batch in batches:
            rows = batch.column("text").to_pylist()
            sizes = np.array([len(text or "") for text in rows], np.int64)
            part = (np.cumsum(sizes) - sizes) // SEGMENT_CHARS + np.arange(len(rows)) // SEGMENT_ROWS
            cuts = np.flatnonzero(np.diff(part, prepend=-1))
            for begin, end in zip(cuts, np.append(cuts, len(rows))[1:], strict=True):
                grams, bounds, places = listed(rows[begin:end])
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(places, pa.int32()))
                held = [batch.column(name).slice(int(begin), int(end - begin)).to_pylist() for name in ("kind", "id")]
                no_list, n = pa.nulls(1, lists.type), len(grams)
                names = [pa.array([*[None] * n, own], pa.list_(pa.string())) for own in held]
                columns = [pa.array([segment] * (n + 1)), pa.array([*grams, None], pa.string()), pa.concat_arrays([lists, no_list]), *names]
                yield pa.RecordBatch.from_arrays(columns, ["segment", "gram", "places", "kinds", "ids"])
                segment += 1

    return texts.select("kind", "id", "text").mapInArrow(post, "segment long, gram string, places array<int>, kinds array<string>, ids array<string>")
