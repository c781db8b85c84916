"""Jaccard join of documents on word shingles, by PartEnum signatures.

Sets are put into size bands ``[l, 5l/4]``; two sets with a Jaccard similarity of 4/5 or more
lie in one band or in neighbouring ones, and differ in at most ``k = 2r/9`` elements,
``r`` being the larger band's end. For its own band and the next, a set splits the element
domain into ``k + 1 + spare`` parts by hash and has one signature for each part that it
has elements in: the hash of those elements. Similar sets agree on at least ``spare + 1``
parts, so if one of them has at most ``spare`` empty parts they share a signature. Sets
with more empty parts also have their ``s - ceil(4s/5) + 1`` smallest elements as
signatures; two similar sets of that kind share one of those.

No pairs within a signature are listed. First every member is compared with the smallest
member alone, which links most of a group of copies and settles the signatures of two
documents. Where members are in different components after that, they are compared with
one member drawn by hash, for ``DRAWS`` rounds, which joins documents that link with many
others; a drawn one is done with its signature. Only members of components that are still
different are compared with each other, and a pair that shares many signatures is listed at
the first of them (nearly always but once, see ``open_pairs``). Candidates pass the sizes and a bound on the difference from 512-bit parity sketches
(a differing element flips one bit; large sets have 4,096 bits besides) before the shingle sets of their whole texts are
intersected.

Signatures travel as packed numbers, 8 bytes each, to the task of their bucket, which
sorts them, some at a time, and keeps those of two documents or more. A signature that several documents of
one slice of an Arrow batch share is resolved there, and only its smallest document goes on,
flagged; a flagged document that meets any other keeps the signature for all its members.

Words and shingles are compared as 64-bit hashes. Defined cases: null, empty or blank
text has no shingles and links with nothing; fewer than five words make one shingle of the
whole sequence; a null ``doc_id`` is never linked and its component is null; rows with the
same ``doc_id`` are one document with the links of each of its texts, and each is
returned; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.llm.common import partitions, slices, small_batches, stored
from salesloom.llm.components import components
from salesloom.llm.url_filter import Level

WIDTH = 5
SKETCH_WORDS = 8
#: Sets of so many elements have a second sketch of so many words: a short one is full and rejects nothing.
LONG_FROM, LONG_WORDS = 800, 64
# Bytes of text hashed at a time; some 50 times as much memory is used for it.
CHUNK_BYTES = 1 << 18
# Bytes of text whose sets are held at a time.
SLICE_BYTES = 1 << 21
#: Signatures of a bucket that are sorted at a time; about 100 bytes are held for each.
PASS_SIGNATURES = 1 << 19
DRAWS = 2
#: Classes of signatures whose smallest one every member carries, to tell pairs listed elsewhere.
CLASSES = 8
#: Up to this size a filter of the wanted ids spares the shuffle of other texts; results are the same without it.
FILTER_BYTES = 16 << 20
#: Documents of one slice of a batch from which a shared signature is resolved there.
SHARED = 4
U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> U(33))) * U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U(33))) * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * U(0x9E3779B97F4A7C15))
IS_WHITE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
PLACES = mix(np.arange(1, WIDTH + 1, dtype=np.uint64) * U(0xD6E8FEB86659FD93)) | U(1)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and where each text's words begin (one more at the end)."""
    joined = b" ".join(texts)
    raw = np.frombuffer(joined, np.uint8)
    white = IS_WHITE[raw]
    starts = np.flatnonzero(~white & np.concatenate([[True], white[:-1]])) if len(raw) else np.zeros(0, np.int64)
    begins = np.cumsum([0] + [len(text) + 1 for text in texts])
    bounds = np.searchsorted(starts, begins)
    if not len(starts):
        return np.zeros(0, np.uint64), bounds
    place = np.arange(len(raw)) - np.repeat(starts, np.diff(np.append(starts, len(raw)))).astype(np.int64) if starts[0] == 0 else None
    if place is None:
        place = np.zeros(len(raw), np.int64)
        place[starts[0] :] = np.arange(starts[0], len(raw)) - np.repeat(starts, np.diff(np.append(starts, len(raw))))
    powers = np.multiply.accumulate(np.concatenate([[U(1)], np.full(int(place.max()), U(0x100000001B3), np.uint64)]))
    values = BYTE_VALUES[raw] * powers[place]
    values[white] = 0
    return mix(np.add.reduceat(values, starts)), bounds


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    out: list[np.ndarray] = []
    chunk: list[bytes] = []
    held = 0

    def flush() -> None:
        words, bounds = word_hashes(chunk)
        n = len(words) - WIDTH + 1
        windows = np.zeros(max(n, 0), np.uint64)
        for place in range(WIDTH if n > 0 else 0):
            windows += words[place : place + n] * PLACES[place]
        windows = mix(windows)
        for begin, end in zip(bounds[:-1], bounds[1:], strict=True):
            if end - begin >= WIDTH:
                out.append(np.unique(windows[begin : end - WIDTH + 1]))
            elif end > begin:
                few = words[begin:end] * PLACES[: end - begin]
                out.append(mix(np.array([few.sum() + U(end - begin)], np.uint64)))
            else:
                out.append(np.zeros(0, np.uint64))
        chunk.clear()

    for text in texts:
        chunk.append((text or "").encode("utf-8", "surrogatepass").lower())
        held += len(chunk[-1])
        if held >= CHUNK_BYTES:
            flush()
            held = 0
    if chunk:
        flush()
    return out


@cache
def band_ends() -> np.ndarray:
    """Largest size of each band, up to sizes that no text reaches."""
    ends, low = [], 1
    while low < 1 << 40:
        ends.append(5 * low // 4)
        low = ends[-1] + 1
    return np.array(ends, np.int64)


@cache
def parts_of(band: int) -> tuple[int, int]:
    """Number of parts of the domain for a band, and how many may be empty."""
    end = int(band_ends()[band])
    k = 2 * end // 9
    least = int(band_ends()[band - 2]) + 1 if band > 1 else 1  # the smallest set with this band's signatures
    n = 1.15 * (k + 1)
    empty = n * np.exp(-least / n)
    spare = int(np.ceil(empty + 3 * np.sqrt(empty))) if k else 0
    return k + 1 + spare, spare


def signatures(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of all sets, and the set each belongs to."""
    sizes = np.array([len(s) for s in sets], np.int64)
    full = np.flatnonzero(sizes)
    if not len(full):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    elements = np.concatenate([sets[k] for k in full])
    owner = np.repeat(np.arange(len(full)), sizes[full])
    bands = np.searchsorted(band_ends(), sizes[full])
    place_hash, value_hash = mix(elements ^ U(0x5851F42D4C957F2D)), mix(elements ^ U(0x14057B7EF767814F))
    found, owners = [], []
    weak = np.zeros(len(full), bool)
    for step in (0, 1):
        plan = np.array([parts_of(int(band) + step) for band in bands], np.int64).reshape(-1, 2)
        parts, spare = plan[:, 0], plan[:, 1]
        begin = np.concatenate([[0], np.cumsum(parts)])
        part = (place_hash % parts[owner].astype(np.uint64)).astype(np.int64)
        cell = begin[owner] + part
        order = np.argsort(cell, kind="stable")
        cells, first = np.unique(cell[order], return_index=True)
        sums = np.add.reduceat(value_hash[order], first)
        of = np.searchsorted(begin, cells, side="right") - 1
        tag = (bands[of] + step).astype(np.uint64) * U(0x9E3779B97F4A7C15) + (cells - begin[of]).astype(np.uint64) * U(0xC2B2AE3D27D4EB4F)
        found.append(mix(sums ^ mix(tag)))
        owners.append(of)
        weak |= parts - np.bincount(of, minlength=len(full)) > spare
    for k in np.flatnonzero(weak):
        own = sets[full[k]]
        prefix = own[: len(own) - (4 * len(own) + 4) // 5 + 1]  # sets are in hash order
        found.append(mix(prefix ^ U(0x2545F4914F6CDD1D)))
        owners.append(np.full(len(prefix), k))
    return np.concatenate(found), full[np.concatenate(owners)]


def parities(own: np.ndarray, words: int) -> np.ndarray:
    """Whether an odd number of the elements falls on each of ``64 * words`` bits."""
    flips = np.bincount((own >> U(20)).astype(np.int64) % (64 * words), minlength=64 * words) & 1
    return np.packbits(flips.astype(np.uint8)).view(np.uint64)


def describe(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, two hashes of the set, its parity sketch and, for a large set, a longer one."""
    sketch = ", ".join(f"s{k} long" for k in range(SKETCH_WORDS))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "text", SLICE_BYTES)):
            sets = shingle_sets(batch.column("text").to_pylist())
            hashes = np.zeros((len(sets), 2), np.uint64)
            words = np.zeros((len(sets), SKETCH_WORDS), np.uint64)
            longer = []
            for row, own in enumerate(sets):
                longer.append(parities(own, LONG_WORDS).view(np.int64) if len(own) >= LONG_FROM else [])
                if len(own):
                    hashes[row] = own.sum(), mix(own ^ U(0x632BE59BD9B4E019)).sum()
                    words[row] = parities(own, SKETCH_WORDS)
            columns = [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64())]
            columns += [pa.array(np.ascontiguousarray(c).view(np.int64)) for c in [*hashes.T, *words.T]]
            columns.append(pa.array(longer, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "h0", "h1", *[f"s{k}" for k in range(SKETCH_WORDS)], "longer"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, n_shingles long, h0 long, h1 long, {sketch}, longer array<long>")


def shared_signatures(docs: DataFrame) -> DataFrame:
    """sig, doc_id, pivot: members of the signatures that two documents or more have.

    Of a signature with two documents in all, ``sig`` is null and there is but the larger
    one: its pair with the pivot says everything. Pairs come once from each task.
    """
    buckets = partitions(docs.sparkSession)
    low = U((1 << 48) - 1)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                ids = part.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
                sets = shingle_sets(part.column("text").to_pylist())
                # Copies within the batch have the same signatures: the smallest stands for them.
                order = np.argsort(ids, kind="stable")
                first: dict[tuple[int, int, int], int] = {}
                for row in order:
                    own = sets[row]
                    if len(own) and first.setdefault((len(own), int(own.sum()), int(own[0])), row) != row:
                        sets[row] = own[:0]
                sigs, rows = signatures(sets)
                rank = np.empty(len(ids), np.int64)
                rank[order] = np.arange(len(ids))
                sort = np.lexsort((rank[rows], sigs))
                sigs, rows = sigs[sort], rows[sort]
                head = np.concatenate([[True], sigs[1:] != sigs[:-1]]) if len(sigs) else np.zeros(0, bool)
                starts = np.flatnonzero(head)
                size = np.diff(np.append(starts, len(sigs)))
                many = np.repeat(size >= SHARED, size)
                pivot = np.repeat(rows[starts], size)
                out = []
                if many.any():
                    out.append((int(mix(sigs[:1])[0] % U(buckets)), True, np.column_stack([sigs[many], ids[rows[many]].view(np.uint64), ids[pivot[many]].view(np.uint64)]).tobytes()))
                sent = ~many | head
                sigs, rows, lone = sigs[sent], rows[sent], ~many[sent]
                bucket = (sigs >> U(48)).astype(np.int64) % buckets if buckets <= 1 << 16 else (mix(sigs) % U(buckets)).astype(np.int64)
                packed = ((sigs & low) << U(16)) | rows.astype(np.uint64)
                sort = np.lexsort((lone, bucket))  # heads of resolved signatures first
                bucket, packed, lone = bucket[sort], packed[sort], lone[sort]
                cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
                for at, end in zip(cuts, np.append(cuts, len(bucket))[1:], strict=True):
                    own = packed[at:end]
                    used, place = np.unique(own & U(0xFFFF), return_inverse=True)
                    flagged = int((~lone[at:end]).sum())
                    body = np.concatenate([np.array([len(used), flagged], U), ids[used.astype(np.int64)].view(np.uint64), (own & ~U(0xFFFF)) | place.astype(np.uint64)])
                    out.append((int(bucket[at]), False, body.tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.bool_()), pa.array([o[2] for o in out], pa.binary())],
                    ["bucket", "resolved", "body"],
                )

    def opened(numbers: np.ndarray, turn: int, passes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Signatures of one pass over a packed body, their documents, and whether they came unflagged."""
        n, flagged = int(numbers[0]), int(numbers[1])
        own = numbers[n + 2 :]
        place = np.flatnonzero((own >> U(16)) % U(passes) == turn)
        own = own[place]
        return own >> U(16), numbers[2 : n + 2].view(np.int64)[(own & U(0xFFFF)).astype(np.int64)], place >= flagged

    def distinct(pairs: np.ndarray) -> np.ndarray:
        pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
        return pairs[np.concatenate([[True], (pairs[1:] != pairs[:-1]).any(axis=1)])] if len(pairs) else pairs

    def rows_of(sig: np.ndarray | None, doc: np.ndarray, pivot: np.ndarray) -> pa.RecordBatch:
        known = pa.nulls(len(doc), pa.int64()) if sig is None else pa.array(sig.view(np.int64))
        return pa.RecordBatch.from_arrays([known, *[pa.array(x.view(np.int64)) for x in (doc, pivot)]], ["sig", "doc_id", "pivot"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0
        for batch in batches:
            for resolved, body in zip(batch.column("resolved").to_pylist(), batch.column("body"), strict=True):
                numbers = np.frombuffer(body.as_buffer(), np.uint64)
                if resolved:
                    rows = numbers.reshape(-1, 3)
                    yield rows_of(rows[:, 0] & low, *[np.ascontiguousarray(rows[:, k]) for k in (1, 2)])
                    continue
                held.append(numbers.copy())
                total += len(numbers) - int(numbers[0]) - 2
        passes = total // PASS_SIGNATURES + 1
        pairs = [np.zeros((0, 2), np.int64)]
        for turn in range(passes):
            sig, doc, lone = (np.concatenate(x) for x in zip(*[opened(numbers, turn, passes) for numbers in held], strict=True)) if held else [np.zeros(0, U)] * 3
            if not len(sig):
                continue
            sort = np.lexsort((lone, doc, sig))  # of equal rows the flagged one stays
            sig, doc, lone = sig[sort], doc[sort], lone[sort]
            fresh = np.concatenate([[True], (sig[1:] != sig[:-1]) | (doc[1:] != doc[:-1])])
            sig, doc, lone = sig[fresh], doc[fresh], lone[fresh]
            starts = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
            size = np.diff(np.append(starts, len(sig)))
            pivot = np.repeat(doc[starts], size)
            more = (size > 2) | (size == 2) & ~np.logical_and.reduceat(lone, starts)  # a flagged one stands for others
            several = np.repeat(more, size)
            yield rows_of(sig[several], doc[several], pivot[several])
            two = np.repeat((size == 2) & ~more, size) & (doc != pivot)
            pairs.append(distinct(np.column_stack([doc[two], pivot[two]])))
        found = distinct(np.concatenate(pairs))
        yield rows_of(None, np.ascontiguousarray(found[:, 0]), np.ascontiguousarray(found[:, 1]))

    sent = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(send, "bucket int, resolved boolean, body binary")
    return sent.repartition(buckets, "bucket").mapInArrow(gather, "sig long, doc_id long, pivot long")


def _close(a: str, b: str) -> Column:
    """Sizes and sketches allow a similarity of 4/5."""
    flips = sum((F.bit_count(F.col(f"{a}.s{k}").bitwiseXOR(F.col(f"{b}.s{k}"))) for k in range(SKETCH_WORDS)), F.lit(0))
    n, m = F.col(f"{a}.n_shingles"), F.col(f"{b}.n_shingles")
    both = F.zip_with(f"{a}.longer", f"{b}.longer", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    # Only one of the two may be large enough for the longer sketch.
    longer = F.aggregate(both, F.lit(0), lambda done, bits: done + F.coalesce(bits, F.lit(0)))
    return (5 * F.least(n, m) >= 4 * F.greatest(n, m)) & (9 * flips <= n + m) & (9 * longer <= n + m)


def open_pairs(left_open: DataFrame, traits: DataFrame) -> DataFrame:
    """a, b: pairs of one signature and different components that may be similar, from (sig, doc_id, component).

    Near copies share hundreds of signatures. Every member carries the smallest of its signatures in
    each of ``CLASSES`` classes; where two members agree on one of these they share it, so they are
    not listed at a larger one. The smallest signature that a pair shares always lists it.
    """
    own = [F.min(F.when(F.pmod("sig", F.lit(CLASSES)) == k, F.col("sig"))).alias(f"c{k}") for k in range(CLASSES)]
    rest = stored(left_open.join(traits.drop("h0", "h1").join(left_open.groupBy("doc_id").agg(*own), "doc_id"), "doc_id"))
    left, right = rest.alias("l"), rest.alias("r")
    listed = [F.coalesce((F.col(f"l.c{k}") == F.col(f"r.c{k}")) & (F.col(f"l.c{k}") < F.col("l.sig")), F.lit(False)) for k in range(CLASSES)]
    elsewhere = reduce(Column.__or__, listed)
    apart = (F.col("l.component") < F.col("r.component")) & ~elsewhere & _close("l", "r")
    return left.join(right, (F.col("l.sig") == F.col("r.sig")) & apart).select(
        F.greatest("l.doc_id", "r.doc_id").alias("a"), F.least("l.doc_id", "r.doc_id").alias("b")
    )


def verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The (stored) pairs (a, b) whose shingle sets have a similarity of 4/5 or more."""
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text").where("id is not null")
    wanted = stored(pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct())
    n = wanted.count()
    if 0 < n < FILTER_BYTES:  # a byte a key is more than the filter takes
        texts = texts.where(Level(wanted, n, 0.05, 0, FILTER_BYTES).holds(F.col("id")))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "x", SLICE_BYTES)):
            kept = []
            left, right = (shingle_sets(batch.column(c).to_pylist()) for c in ("x", "y"))
            for x, y in zip(left, right, strict=True):
                both = np.concatenate([x, y])
                both.sort()
                shared = int((both[1:] == both[:-1]).sum())
                kept.append(100 * shared >= 80 * (len(both) - shared))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(kept, pa.bool_()))

    of_a = pairs.join(texts, F.col("a") == F.col("id")).select("a", "b", F.col("text").alias("x"))
    both = of_a.join(texts, F.col("b") == F.col("id")).select("a", "b", "x", F.col("text").alias("y"))
    return both.mapInArrow(compare, "a long, b long").distinct()


def link_documents(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n_shingles) of every row, and (node, component) of every linked document."""
    with small_batches(docs.sparkSession):
        return _link(docs)


def _link(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    described = stored(describe(docs))
    usable = described.where("doc_id is not null and n_shingles > 0").withColumn("doc_id", F.col("doc_id").cast("long"))
    same = usable.groupBy("h0", "h1", "n_shingles").agg(F.min("doc_id").alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1")
    copies = usable.join(same.select("h0", "h1", "n_shingles", "head"), ["h0", "h1", "n_shingles"]).select(F.col("doc_id").alias("a"), F.col("head").alias("b"))
    copies = stored(copies.where("a > b"))
    members = stored(shared_signatures(docs))
    traits = usable.select("doc_id", "n_shingles", "h0", "h1", *[f"s{k}" for k in range(SKETCH_WORDS)], "longer")

    def close_pairs(pairs: DataFrame) -> DataFrame:
        """Distinct pairs of different sets that may be similar."""
        met = pairs.distinct().alias("p").join(traits.alias("l"), F.col("p.a") == F.col("l.doc_id")).join(traits.alias("r"), F.col("p.b") == F.col("r.doc_id"))
        other = (F.col("l.h0") != F.col("r.h0")) | (F.col("l.h1") != F.col("r.h1"))
        return met.where(other & _close("l", "r")).select("p.a", "p.b").distinct()

    tried = stored(close_pairs(members.where("doc_id > pivot").select(F.col("doc_id").alias("a"), F.col("pivot").alias("b"))))
    links = stored(copies.unionByName(verified(tried, docs)))
    found = stored(components(links))

    def unsettled(open_members: DataFrame) -> DataFrame:
        """sig, doc_id, component of the signatures whose members are in several components."""
        own = open_members.select("sig", "doc_id").join(found, F.col("doc_id") == F.col("node"), "left")
        own = own.select("sig", "doc_id", F.coalesce("component", "doc_id").alias("component"))
        ends = own.groupBy("sig").agg(F.min("component").alias("low"), F.max("component").alias("high"))
        return own.join(ends.where("low < high").select("sig"), "sig", "left_semi")

    # A copy has the signatures of its head. A resolved pivot may be listed twice, which does no harm.
    heads = copies.select(F.col("a").alias("copy")).distinct()
    several = members.where("sig is not null").select("sig", "doc_id").join(heads, F.col("doc_id") == F.col("copy"), "left_anti")
    left_open = stored(unsettled(several))
    for draw in range(DRAWS):
        if left_open.isEmpty():
            break
        drawn = left_open.groupBy(F.col("sig").alias("of")).agg(F.min(F.struct(F.xxhash64("sig", "doc_id", F.lit(draw)).alias("h"), "doc_id", "component")).alias("d"))
        against = left_open.join(drawn, (F.col("sig") == F.col("of")) & (F.col("component") != F.col("d.component")))
        pairs = against.select(F.greatest("doc_id", "d.doc_id").alias("a"), F.least("doc_id", "d.doc_id").alias("b"))
        fresh = stored(close_pairs(pairs).join(tried, ["a", "b"], "left_anti"))
        tried = stored(tried.unionByName(fresh))
        links = stored(links.unionByName(verified(fresh, docs)))
        found = stored(components(links))
        # A drawn member has met all the others of its signature.
        met = drawn.select("of", F.col("d.doc_id").alias("done"))
        left_open = stored(unsettled(left_open.join(met, (F.col("sig") == F.col("of")) & (F.col("doc_id") != F.col("done")))))
    if left_open.isEmpty():
        return described.select("doc_id", "n_shingles"), found
    last = open_pairs(left_open, traits)
    last = stored(last.distinct().join(tried, ["a", "b"], "left_anti"))
    return described.select("doc_id", "n_shingles"), stored(components(links.unionByName(verified(last, docs))))


def jaccard_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id: one row per row of ``docs``."""
    counted, found = link_documents(docs)
    joined = counted.join(found, F.col("doc_id") == F.col("node"), "left")
    return joined.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
