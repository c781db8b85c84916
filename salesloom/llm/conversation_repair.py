"""Repair of the order of turns in conversations, as whole rows with their texts.

Rows are judged by Spark: blank, said before in the conversation, or truncated. What the
search for the cheapest edits needs of a row is one byte, so a task reads its
conversations as sorted rows without texts, one conversation at a time, and finds each
one's edits by depth-first branch-and-bound (``turn_search``). The edits then go in front
of the conversation's rows, which stream through them; neither pass holds the texts of a
conversation, however long it is. One conversation is read by one task, since its edits,
and the digest of its repaired text, follow its order.

Order: ``turn`` (null first); rows of one turn by role, then by the digest of their text.
Defined cases: a null ``role`` or ``text`` is one space, which makes the row blank or its
initial illegal; null ``conv_id`` is a conversation of its own; a conversation whose rows
are all dropped keeps its zeros; rows that repeat count as said before; very long texts and
conversations are taken whole; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from salesloom.llm import turn_search as search
from salesloom.llm.common import stored

SPACES = " \t\n\x0b\x0c\r"
ROLES = {search.USER: "user", search.ASSISTANT: "assistant"}
COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def damage(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, _dropped: rows damaged by a checksum of their key. Dropped
    rows stay, marked, so that their conversation is not forgotten."""
    spaced = {name: F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("conv_id", "turn", "role", "text")}
    drawn = F.crc32(F.concat(spaced["conv_id"], F.lit(":"), spaced["turn"])) % 20
    text = F.when(drawn == 1, "").when(drawn == 2, F.translate(spaced["text"], ".!?", "")).otherwise(spaced["text"])
    rows = turns.select(
        "conv_id", "turn", F.when(drawn == 4, "user").otherwise(spaced["role"]).alias("role"), text.alias("text"), drawn.alias("drawn")
    )
    twice = F.explode(F.when(F.col("drawn") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", "role", "text", (F.col("drawn") == 0).alias("_dropped"), twice.alias("_copy")).drop("_copy")


def _digested(turns: DataFrame) -> DataFrame:
    dropped = F.col("_dropped") if "_dropped" in turns.columns else F.lit(False)
    return turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), dropped.alias("_dropped")
    ).withColumn("digest", F.unhex(F.sha2("text", 256)))


def judged(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, digest, code: rows without texts; a dropped row's code is null."""
    solid = F.rtrim(F.col("text"), F.lit(SPACES))
    rows = _digested(turns).select(
        "conv_id", "turn", "role", "digest", "_dropped",
        (solid == "").alias("blank"), (~F.right(solid, F.lit(1)).isin(".", "!", "?")).alias("truncated"),
    )
    said = Window.partitionBy("conv_id", "_dropped", "role", "digest").orderBy(F.col("turn").asc_nulls_first())
    fault = (
        F.when(F.col("blank"), search.BLANK)
        .when(F.row_number().over(said) > 1, search.DUPLICATE)
        .when(F.col("truncated"), search.TRUNCATED)
        .otherwise(search.SOUND)
    )
    initial = F.left("role", F.lit(1))
    role = F.when(initial == "s", search.SYSTEM).when(initial == "u", search.USER).when(initial == "a", search.ASSISTANT).otherwise(search.OTHER)
    code = F.when(~F.col("_dropped"), 4 * role + fault).cast("int")
    # One exchange serves the window and the search.
    return rows.repartition("conv_id").select("conv_id", "turn", "role", "digest", code.alias("code"))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows as tuples, with whether each begins another conversation."""
    before: object = _runs  # no conversation's id
    for batch in batches:
        for row in zip(*[column.to_pylist() for column in batch.columns], strict=True):
            yield row[0] is not before and row[0] != before, row
            before = row[0]


def _batch(rows: list[tuple], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(list(c), kind) for c, kind in zip(columns, kinds.values(), strict=True)], list(kinds))


class _Conversation:
    def __init__(self, conv_id):
        self.conv_id, self.codes, self.turns, self.first, self.last = conv_id, bytearray(), 0, None, None

    def add(self, turn, code) -> None:
        if code is None:
            return
        self.codes.append(code)
        if turn is not None and turn != self.last:  # rows come sorted
            self.first = turn if self.first is None else self.first
            self.last, self.turns = turn, self.turns + 1

    def result(self) -> tuple:
        codes = bytes(self.codes)
        faults = [sum(codes.count(4 * role + fault) for role in range(4)) for fault in (search.BLANK, search.DUPLICATE, search.TRUNCATED)]
        illegal = sum((a // 4, b // 4) not in _NEIGHBOURS for a, b in zip(codes, codes[1:], strict=False))
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        cost, audit = search.cheapest_edits(codes)
        return (self.conv_id, gaps, *faults, illegal, cost, audit, codes)


_NEIGHBOURS = {(search.SYSTEM, search.USER), (search.USER, search.ASSISTANT), (search.ASSISTANT, search.USER)}


def edits(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, codes: one row per
    conversation of ``judged`` rows."""
    id_type = rows.schema["conv_id"].dataType.simpleString()
    kinds = {"conv_id": to_arrow_type(rows.schema["conv_id"].dataType), **dict.fromkeys(COUNTS, pa.int64()), "audit": pa.string(), "codes": pa.binary()}

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done, size = None, [], 0

        for begins, (conv_id, turn, code) in _runs(batches):
            if begins:
                if now:
                    done.append(now.result())
                    size += len(now.codes)
                if len(done) >= 10_000 or size >= 1 << 24:
                    yield _batch(done, kinds)
                    done, size = [], 0
                now = _Conversation(conv_id)
            now.add(turn, code)
        if now:
            yield _batch([*done, now.result()], kinds)

    ordered = rows.sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "digest"
    )
    counts = ", ".join(f"{name} long" for name in COUNTS)
    return ordered.select("conv_id", "turn", "code").mapInArrow(find, f"conv_id {id_type}, {counts}, audit string, codes binary")


def _with_edits(turns: DataFrame, found: DataFrame) -> DataFrame:
    """Each conversation's edits in front of its rows, in one sorted partition."""
    rows = _digested(turns).where("not _dropped").drop("_dropped")
    heads = found.select(
        "conv_id", F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"), F.lit(None).cast("string").alias("role"),
        F.col("audit").alias("text"), F.col("codes").alias("digest"), F.lit(0).alias("part"),
    )
    both = rows.withColumn("part", F.lit(1)).unionByName(heads).repartition("conv_id")
    return both.sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(), "part", F.col("turn").asc_nulls_first(), "role", "digest"
    ).select("conv_id", "part", "role", "text", F.when(F.col("part") == 0, F.col("digest")).alias("codes"))


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, role, text) of what the edits leave, row by row; (conv_id, None, None) begins a conversation."""
    left, at, now = iter(()), 0, None
    wanted = None

    def inserted():
        nonlocal wanted
        wanted = next(left, None)
        while wanted is not None and wanted[0] is None:
            yield now, ROLES[wanted[1]], ""
            wanted = next(left, None)

    for _, (conv_id, part, role, text, codes) in _runs(batches):
        if part == 0:
            left, at, now, audit = iter(list(search.roles_after(text, codes))), 0, conv_id, text
            kept = iter([edit for edit in audit if edit != "I"])
            yield conv_id, None, None
            yield from inserted()
            continue
        if wanted is not None and wanted[0] == at:
            yield conv_id, ROLES[wanted[1]] if next(kept) == "R" else role, text
            yield from inserted()
        else:
            next(kept)
        at += 1


def repaired_rows(turns: DataFrame, found: DataFrame) -> DataFrame:
    """conv_id, place, role, text: the rows of the repaired conversations."""
    id_type = turns.schema["conv_id"].dataType.simpleString()
    kinds = {"conv_id": to_arrow_type(turns.schema["conv_id"].dataType), "place": pa.int64(), "role": pa.string(), "text": pa.string()}

    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, place, size = [], 0, 0
        for conv_id, role, text in _repaired(batches):
            if role is None:
                place = 0
                continue
            rows.append((conv_id, place, role, text))
            place, size = place + 1, size + len(text)
            if size >= 1 << 22 or len(rows) >= 10_000:
                yield _batch(rows, kinds)
                rows, size = [], 0
        yield _batch(rows, kinds)

    return _with_edits(turns, found).mapInArrow(repair, f"conv_id {id_type}, place long, role string, text string")


def repaired_digests(turns: DataFrame, found: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256: of the repaired rows as ``role:text``, joined by newlines."""
    id_type = turns.schema["conv_id"].dataType.simpleString()
    kinds = {"conv_id": to_arrow_type(turns.schema["conv_id"].dataType), "repaired_sha256": pa.string()}

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, now = [], None
        for conv_id, role, text in _repaired(batches):
            if role is None:
                if now:
                    done.append((*now, said.hexdigest()))
                if len(done) >= 10_000:
                    yield _batch(done, kinds)
                    done = []
                now, said, between = (conv_id,), hashlib.sha256(), b""
                continue
            said.update(between + f"{role}:{text}".encode())
            between = b"\n"
        yield _batch([*done, (*now, said.hexdigest())] if now else done, kinds)

    return _with_edits(turns, found).mapInArrow(digest, f"conv_id {id_type}, repaired_sha256 string")


def repair_report(turns: DataFrame) -> DataFrame:
    """conv_id, the counts, cost, audit and digest of each conversation."""
    found = stored(edits(judged(turns)))
    digests = repaired_digests(turns, found)
    same = found["conv_id"].eqNullSafe(digests["conv_id"])
    return found.join(digests, same).select(found["conv_id"], *COUNTS, "audit", "repaired_sha256")
