"""Best-fit packing of documents into sequences, improved by swap-based local search.

Documents are tokenized in Arrow batches and stay whole; only those longer than a sequence
are cut, into full sequences and a rest. Pieces are dealt at random into shards of about
``SHARD`` pieces. A shard is packed by best fit and then by local search
(``swap_search``): moves, one-for-one and two-for-one exchanges between underfull
sequences, each raising the sum of squared fills, until sequences empty. A shard holds so
many pieces that its rounding is small, and what there is of it meets again: the emptiest
sequences of all shards are opened, and their pieces dealt into fewer shards, until one
shard takes them. So no task ever sees more than a shard, at any size of the corpus.

Ids, pieces and placements are written down between the steps, so a lost executor's tasks
run again with the same outcome.

Defined cases: null or empty text is the end id alone; a null ``doc_id`` is carried; rows
that repeat are packed each; very long texts are tokenized whole; an empty table gives no
rows; other columns are not read. Special tokens in a text are ordinary text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.llm.common import partitions, slices, stored
from salesloom.llm.segments import BatchEncoder
from salesloom.llm.swap_search import Bins

SEQ_LEN = 4096
END_ID = 1
SHARD = 4_000
# Of a shard's sequences, the emptiest one in so many is packed again in the next round.
REOPENED = 32
PIECES = "piece int, start long, length long, ids_crc32 long, slot int, ordinal long"


def whole_pieces(docs: DataFrame, tokenizer_json: str, seq_len: int, end_id: int, with_ids: bool) -> DataFrame:
    """One row per piece; ``slot`` and ``ordinal`` identify it."""
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_json)  # the vocabulary file: fixed size
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {PIECES}" + (", ids array<int>" if with_ids else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = BatchEncoder(shared.value)
        slot, ordinal = TaskContext.get().partitionId(), 0
        for batch in (part for held in batches for part in slices(held, "text")):
            ids, places = encoder.ids(batch.column("text"), end_id)
            sizes = np.diff(places)
            counts = -(-sizes // seq_len)
            rows = np.repeat(np.arange(len(sizes)), counts)
            piece = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)
            start = piece * seq_len
            length = np.minimum(sizes[rows] - start, seq_len)
            begin = places[rows] + start
            spans = list(zip(begin.tolist(), (begin + length).tolist(), strict=True))
            data = memoryview(ids.astype("<u4").view(np.uint8))
            columns = [
                batch.column("doc_id").take(pa.array(rows)), pa.array(piece.astype("i4")), pa.array(start), pa.array(length),
                pa.array([zlib.crc32(data[4 * a : 4 * b]) for a, b in spans], pa.int64()),
                pa.array(np.full(len(rows), slot, "i4")), pa.array(np.arange(ordinal, ordinal + len(rows))),
            ]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "slot", "ordinal"]
            if with_ids:
                bounds = np.append(begin, places[-1]).astype("i4")
                columns.append(pa.ListArray.from_arrays(pa.array(bounds), pa.array(ids.astype("i4"))))
                names.append("ids")
            ordinal += len(rows)
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select("doc_id", "text").mapInArrow(cut, schema)


def pack_shard(lengths: list[int], capacity: int) -> list[list[int]]:
    """Sequences of pieces, by place in ``lengths``: best fit as they come, improved by
    swaps; where that ends above the least conceivable number, also from the longest down."""
    bins = Bins(lengths, capacity)
    bins.best_fit()
    bins.improve()
    best = bins.packed()
    if len(best) > bins.least_bins():
        order = sorted(range(len(lengths)), key=lambda piece: -lengths[piece])
        again = Bins([lengths[piece] for piece in order], capacity)
        again.best_fit()
        again.improve()
        if len(again.packed()) < len(best):
            best = [[order[place] for place in held] for held in again.packed()]
    return best


def _placed_shards(dealt: DataFrame, round_: int, capacity: int) -> DataFrame:
    """Sequences of every shard; ``reopened`` marks the emptiest."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = None
        for batch in (*batches, None):
            left = batch if left is None else left if batch is None else _joined(left, batch)
            if left is None:
                return
            shard = left.column("shard").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(shard)]
            whole = cuts if batch is None else cuts[:-1]  # the last shard may go on
            for begin, end in zip(whole, whole[1:], strict=False):
                yield pack(left.slice(begin, end - begin))
            left = left.slice(whole[-1])

    def pack(rows: pa.RecordBatch) -> pa.RecordBatch:
        lengths = rows.column("length").to_pylist()
        packed = pack_shard(lengths, capacity)
        packed.sort(key=lambda held: sum(lengths[piece] for piece in held))
        reopen = -(-len(packed) // REOPENED)
        sequence, offset, reopened = np.zeros(len(lengths), "i8"), np.zeros(len(lengths), "i8"), np.zeros(len(lengths), bool)
        first = (round_ << 59) + (rows.column("shard")[0].as_py() << 28) if len(lengths) else 0
        for number, held in enumerate(packed):
            at = 0
            for piece in held:
                sequence[piece], offset[piece], reopened[piece] = first + number, at, number < reopen
                at += lengths[piece]
        return pa.RecordBatch.from_arrays(
            [rows.column("slot"), rows.column("ordinal"), rows.column("length"), *map(pa.array, (sequence, offset, reopened))],
            ["slot", "ordinal", "length", "sequence_id", "offset", "reopened"],
        )

    schema = "slot int, ordinal long, length long, sequence_id long, offset long, reopened boolean"
    return dealt.mapInArrow(place, schema)


def _joined(left: pa.RecordBatch, right: pa.RecordBatch) -> pa.RecordBatch:
    return pa.Table.from_batches([left, right]).combine_chunks().to_batches()[0] if right.num_rows and left.num_rows else left if left.num_rows else right


def place_pieces(pieces: DataFrame, seq_len: int = SEQ_LEN, shard: int = SHARD) -> DataFrame:
    """slot, ordinal, sequence_id, offset of pieces (slot, ordinal, length).

    Full pieces are sequences of their own, with negative ids.
    """
    alone = pieces.where(F.col("length") == seq_len).select(
        "slot", "ordinal", (-1 - F.col("slot").cast("long") * (1 << 32) - F.col("ordinal")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    done, left, round_ = [alone], pieces.where(F.col("length") < seq_len).select("slot", "ordinal", "length"), 0
    while True:
        shards = max(1, -(-left.count() // shard))
        # Shards are dealt anew in each round, and sorted so that a task that runs again packs alike.
        number = F.pmod(F.xxhash64("slot", "ordinal", F.lit(round_)), F.lit(shards))
        dealt = left.withColumn("shard", number).repartition(min(shards, partitions(pieces.sparkSession)), "shard")
        placed = stored(_placed_shards(dealt.sortWithinPartitions("shard", "slot", "ordinal"), round_, seq_len))
        columns = ["slot", "ordinal", "sequence_id", "offset"]
        if shards == 1:
            done.append(placed.select(*columns))
            break
        done.append(placed.where("not reopened").select(*columns))
        left, round_ = placed.where("reopened").select("slot", "ordinal", "length"), round_ + 1
    whole = done[0]
    for more in done[1:]:
        whole = whole.unionByName(more)
    return whole


def pack(docs: DataFrame, tokenizer_json: str, seq_len: int = SEQ_LEN, end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, (ids,) sequence_id, offset: one row per piece."""
    pieces = stored(whole_pieces(docs, tokenizer_json, seq_len, end_id, with_ids))
    placed = place_pieces(pieces, seq_len)
    return pieces.join(placed, ["slot", "ordinal"]).drop("slot", "ordinal")
