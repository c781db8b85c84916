"""Packing by power-of-two decomposition.

A document's ids are cut into pieces whose lengths are powers of two: as many of the
sequence length as fit, then the binary digits of the rest from the highest down. Pieces
of one length are dealt to sequences of their own, ``seq_len / length`` to each, so a
sequence holds equal pieces, no piece crosses documents and no id is lost. The pieces of
a length that fill no whole sequence are split by the binary digits of their number into
sequences whose sizes are powers of two again, so no sequence is padded.

Tokenizing runs once, in Arrow batches, and its pieces are written down. Each task numbers
its pieces by length; the counts by task and length give every task its start in the
global numbering, so no rows are sorted or gathered.

Defined cases: null or empty text is the end id alone; a null ``doc_id`` is carried; rows
that repeat are packed each; an empty table gives no rows; other columns are not read.
Texts are tokenized whole, very long ones too. Special tokens in a text are ordinary text.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesloom.llm.common import slices, small_batches, stored
from salesloom.llm.segments import byte_letters
from salesloom.operators.lineage import broadcast_if_small

SEQ_LEN = 2048
END_ID = 1
PIECES = "start long, length long, ids_crc32 long, doc_tokens long, slot int, ordinal long"
# Fixed value: the first step of byte-level vocabularies.
PARTS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_ranks(vocabulary: dict) -> dict[bytes, int] | None:
    """Bytes and id of each token of a byte-level vocabulary whose ids are the order of its
    merges, so that the ids alone say what is merged first; None for any other."""
    model, step = vocabulary["model"], vocabulary["pre_tokenizer"] or {}
    plain = step.get("type") == "ByteLevel" and step.get("use_regex") and not step.get("add_prefix_space")
    if model["type"] != "BPE" or not plain or vocabulary["normalizer"] or model.get("end_of_word_suffix"):
        return None
    letters = {letter: byte for byte, letter in byte_letters().items()}
    ids = model["vocab"]
    merged = [ids["".join(pair.split(" ") if isinstance(pair, str) else pair)] for pair in model["merges"]]
    special = {token["content"] for token in vocabulary["added_tokens"]}
    if merged != sorted(merged) or not all(set(token) <= letters.keys() for token in ids if token not in special):
        return None
    return {bytes(letters[letter] for letter in token): rank for token, rank in ids.items() if token not in special}


def text_encoder(tokenizer_json: str) -> Callable[[str], np.ndarray]:
    """Encodes a text into uint32 ids.

    Vocabularies that ``byte_ranks`` can read are encoded from their ranks, at half the cost;
    the ids are the tokenizer's own. Others, and texts whose runs of white space are too
    long for that, are left to the tokenizer.
    """

    @cache
    def tokenizer():  # made when a text needs it
        from tokenizers import Tokenizer

        made = Tokenizer.from_str(tokenizer_json)
        made.encode_special_tokens = True
        return made

    def by_tokenizer(text: str) -> np.ndarray:
        return np.array(tokenizer().encode(text, add_special_tokens=False).ids, "<u4")

    ranks = byte_ranks(json.loads(tokenizer_json))
    if not ranks:
        return by_tokenizer
    from tiktoken import Encoding

    encoding = Encoding("documents", pat_str=PARTS, mergeable_ranks=ranks, special_tokens={})

    def by_ranks(text: str) -> np.ndarray:
        try:
            return encoding.encode_to_numpy(text, disallowed_special=())
        except ValueError:
            return by_tokenizer(text)

    return by_ranks


def piece_lengths(n: int, seq_len: int = SEQ_LEN) -> list[int]:
    """Whole sequences, then the binary digits of the rest."""
    whole, rest = divmod(n, seq_len)
    return [seq_len] * whole + [1 << bit for bit in range(rest.bit_length() - 1, -1, -1) if rest >> bit & 1]


def cut_pieces(docs: DataFrame, tokenizer_json: str, seq_len: int, end_id: int, with_ids: bool) -> DataFrame:
    """One row per piece, numbered by length within its task."""
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_json)  # the vocabulary file: fixed size
    id_type = docs.schema["doc_id"].dataType
    schema = f"doc_id {id_type.simpleString()}, {PIECES}" + (", ids array<int>" if with_ids else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = text_encoder(shared.value)
        slot, numbered = TaskContext.get().partitionId(), dict.fromkeys(piece_lengths(2 * seq_len - 1, seq_len), 0)
        for batch in (part for held in batches for part in slices(held, "text")):
            rows, starts, lengths, crcs, totals, ordinals, ids = [], [], [], [], [], [], []
            for row, text in enumerate(batch.column("text")):
                whole = np.append(encode(text.as_py() or ""), np.uint32(end_id)).astype("<u4")
                at = 0
                for length in piece_lengths(len(whole), seq_len):
                    piece = whole[at : at + length]
                    rows.append(row)
                    starts.append(at)
                    lengths.append(length)
                    crcs.append(zlib.crc32(piece.tobytes()))
                    totals.append(len(whole))
                    ordinals.append(numbered[length])
                    numbered[length] += 1
                    if with_ids:
                        ids.append(piece.astype("i4"))
                    at += length
            columns = [
                batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(starts, pa.int64()),
                pa.array(lengths, pa.int64()), pa.array(crcs, pa.int64()), pa.array(totals, pa.int64()),
                pa.array(np.full(len(rows), slot, "i4")), pa.array(ordinals, pa.int64()),
            ]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "slot", "ordinal"]
            if with_ids:
                bounds = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype("i4")
                columns.append(pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(ids) if ids else np.zeros(0, "i4"))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select("doc_id", "text").mapInArrow(cut, schema)


def _shift(name: str, value: Column, by: Column) -> Column:
    return F.call_function(name, value, by.cast("int"))


def place_pieces(pieces: DataFrame, seq_len: int = SEQ_LEN) -> DataFrame:
    """Adds sequence_id and offset to numbered pieces."""
    held = pieces.groupBy("slot", "length").agg((F.max("ordinal") + 1).alias("held"))
    of_length = Window.partitionBy("length")
    earlier = of_length.orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    counted = held.select(
        "slot", "length", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("begin"), F.sum("held").over(of_length).alias("all_held")
    )
    per = (F.lit(seq_len) / F.col("length")).cast("bigint")
    lengths = counted.select("length", "all_held").distinct()  # one row for each power of two
    full = F.floor(F.col("all_held") / per)
    rest = F.col("all_held") % per
    before = Window.orderBy("length").rowsBetween(Window.unboundedPreceding, -1)
    bases = lengths.select(
        F.col("length").alias("of_length"), full.alias("full"), rest.alias("rest"), per.alias("per"),
        F.coalesce(F.sum(full + F.bit_count(rest)).over(before), F.lit(0)).alias("first_id"),
    )
    starts = counted.join(F.broadcast(bases), F.col("length") == F.col("of_length")).select(
        F.col("slot").alias("at_slot"), "of_length", "begin", "full", "rest", "per", "first_id"
    )
    # A few counts for each task; pieces, which may hold their ids, meet them where they lie.
    starts = broadcast_if_small(stored(starts))
    joined = pieces.join(starts, (F.col("slot") == F.col("at_slot")) & (F.col("length") == F.col("of_length")))
    number = F.col("begin") + F.col("ordinal")
    left = number - F.col("full") * F.col("per")
    # Among the pieces left over, the highest digit in which their number and the
    # piece's place differ names the block of that many pieces it lies in.
    digit = F.length(F.bin(F.col("rest").bitwiseXOR(left))) - 1
    above = _shift("shiftright", F.col("rest"), digit + 1)
    whole = left < 0
    sequence = F.when(whole, F.floor(number / F.col("per"))).otherwise(F.col("full") + F.bit_count(above))
    inside = F.when(whole, number % F.col("per")).otherwise(left - _shift("shiftleft", above, digit + 1))
    return joined.select(
        *[c for c in pieces.columns if c not in ("slot", "ordinal")],
        (F.col("first_id") + sequence).cast("bigint").alias("sequence_id"),
        (inside * F.col("length")).cast("bigint").alias("offset"),
    )


def pack(docs: DataFrame, tokenizer_json: str, seq_len: int = SEQ_LEN, end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, (ids,) sequence_id, offset: one row per piece."""
    with small_batches(docs.sparkSession):
        pieces = stored(cut_pieces(docs, tokenizer_json, seq_len, end_id, with_ids))
    return place_pieces(pieces, seq_len)
