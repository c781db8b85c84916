"""Log-likelihood of documents under a gated recurrent language model in numpy.

Words are counted over all training documents. The most frequent ones are units of the
output; every other word falls to one of ``TAIL_UNITS`` units by its ending, and within
such a unit it has its share of the counts, with one more share for words never seen. So
the model gives every word a probability. Units are put into classes of about equal
frequency, and the output is a class softmax times a softmax within the class.

Training is by truncated backpropagation over windows of stretches that run in step. A
document is cut into stretches of ``STRETCH`` tokens, so very long ones do not run alone;
the state begins anew with each and is carried through its windows. It goes in rounds: every task trains a copy of the parameters on its share of the round's documents,
and the copies are averaged, weighed by their tokens, first within ``GROUPS`` groups and
then on the driver. Each training document is in one round. Scoring runs whole documents
in step and carries their state from window to window.

Counts of the ``KNOWN`` most frequent words travel to the tasks; rarer words of a text are
joined to the counts by a 64-bit hash.

Defined cases: null or empty text is the end token alone; a null ``doc_id`` is neither
learned from nor held out; without training tokens both scores are 0; repeated rows are
scored each; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.llm.common import slices, small_batches, stored
from salesloom.llm.jaccard_join import CHUNK_BYTES, IS_WHITE, mix, word_hashes
from salesloom.llm.langid import fold

KNOWN = 200_000
UNITS = 1024
TAIL_UNITS = 128
CLASSES = 32
HIDDEN = 16
WINDOW = 32
STREAMS = 512
STRETCH = 256
ROUNDS = 3
RATE = 0.1
GROUPS = 16
SLICE = 8 << 20
END = np.uint64(0x1F3D5B79)
F32 = np.float32


def hashed(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and ending units of all words, an end token after each text's; text bounds."""
    raw = [(text or "").encode("utf-8", "surrogatepass").lower() for text in texts]
    part = np.cumsum([0, *map(len, raw)])[:-1] // CHUNK_BYTES
    found = [hashed_chunk(raw[begin:end]) for begin, end in zip(*chunk_bounds(part), strict=True)]
    sizes = np.concatenate([np.zeros(1, np.int64), *[np.diff(bounds) for _, _, bounds in found]])
    words, endings = (np.concatenate([chunk[k] for chunk in found]) if found else np.zeros(0, kind) for k, kind in ((0, np.uint64), (1, np.int32)))
    return words, endings, np.cumsum(sizes)


def chunk_bounds(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    begins = np.flatnonzero(np.diff(part, prepend=-1))
    return begins, np.append(begins, len(part))[1:]


def hashed_chunk(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    words, bounds = word_hashes(raw)
    joined = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    white = IS_WHITE[joined]
    last = np.flatnonzero(~white[:-1] & white[1:])
    three = [np.where(last >= k, joined[np.maximum(last - k, 0)], 32).astype(np.uint64) for k in range(3)]
    ending = (mix(three[0] | three[1] << np.uint64(8) | three[2] << np.uint64(16)) % np.uint64(TAIL_UNITS)).astype(np.int32)
    places = bounds[1:]
    return np.insert(words, places, END), np.insert(ending, places, 0), bounds + np.arange(len(bounds))


def count_words(docs: DataFrame) -> DataFrame:
    """hash, ending, n of every token; tasks add up before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            h, e, n = (np.concatenate(parts) for parts in zip(*held, strict=True))
            found, first, place = np.unique(h, return_index=True, return_inverse=True)
            return found, e[first], np.bincount(place, n, len(found)).astype(np.int64)

        def rows() -> pa.RecordBatch:
            h, e, n = merged()
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(e), pa.array(n)], ["h", "ending", "n"])

        for part in (part for batch in batches for part in slices(batch, "text")):
            h, e, _ = hashed(part.column("text").to_pylist())
            found, first, n = np.unique(h, return_index=True, return_counts=True)
            held.append((found, e[first], n))
            if sum(len(h) for h, _, _ in held) > 1_000_000:
                held[:] = [merged()]
                if len(held[0][0]) > 600_000:
                    yield rows()
        if held:
            yield rows()

    counted = docs.select("text").mapInArrow(count, "h long, ending int, n long")
    return counted.groupBy("h").agg(F.min("ending").alias("ending"), F.sum("n").alias("n"))


class Lexicon:
    """Known words' hashes and counts in hash order, their units, and the units' classes."""

    def __init__(self, known: pa.Table, tails: pa.Table, total: int, distinct: int):
        h = known.column("h").to_numpy().view(np.uint64)
        n, ending = known.column("n").to_numpy(), known.column("ending").to_numpy()
        self.total, self.distinct = total, distinct
        top = min(UNITS, len(h))  # rows come by count
        mass = np.zeros(top + TAIL_UNITS)
        mass[:top] = n[:top]
        tail = np.zeros(TAIL_UNITS)
        tail[tails.column("ending").to_numpy()] = tails.column("n").to_numpy() + 0.5 * tails.column("words").to_numpy()
        np.subtract.at(tail, ending[:top], n[:top] + 0.5)
        self.tail = np.maximum(tail, 0) + 0.5  # one share for words never seen
        mass[top:] = self.tail
        # Units by falling mass, cut into classes of about equal mass.
        order = np.argsort(-mass, kind="stable")
        place = np.empty(len(mass), np.int32)
        place[order] = np.arange(len(mass))
        self.mass = mass[order]
        share = np.cumsum(self.mass) / self.mass.sum()
        rough = np.minimum(((share - self.mass / self.mass.sum() / 2) * CLASSES).astype(int), CLASSES - 1)
        self.of_class = np.unique(rough, return_inverse=True)[1].astype(np.int32)
        self.begin = np.searchsorted(self.of_class, np.arange(self.of_class[-1] + 2))
        self.tail_place = place[top:]
        sort = np.argsort(h)
        self.hashes, self.counts = h[sort], n[sort]
        unit = np.full(len(h), -1, np.int32)
        unit[:top] = place[:top]
        self.unit = unit[sort]

    def look_up(self, h: np.ndarray, ending: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Unit of each token, its count (-1 if not known here) and whether its unit is a tail."""
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        known = self.hashes[at] == h
        unit = np.where(known, self.unit[at], -1)
        tail = unit < 0
        return np.where(tail, self.tail_place[ending], unit), np.where(known, self.counts[at], -1), tail


class Network:
    """Parameters and passes of the model; ``p`` maps names to float32 arrays."""

    NAMES = ("x", "u", "wc", "bc", "wo", "bo")

    def __init__(self, lexicon: Lexicon, packed: bytes | None = None):
        units, classes = len(lexicon.mass), len(lexicon.begin) - 1
        self.begin, self.of_class = lexicon.begin, lexicon.of_class
        self.room = np.empty(0, F32)
        self.shapes = {"x": (units, 3 * HIDDEN), "u": (HIDDEN, 3 * HIDDEN), "wc": (classes, HIDDEN), "bc": (classes,), "wo": (units, HIDDEN), "bo": (units,)}
        if packed is None:
            random = np.random.default_rng(7)
            self.p = {name: (random.standard_normal(shape) * 0.1).astype(F32) for name, shape in self.shapes.items()}
            weight = np.add.reduceat(lexicon.mass, self.begin[:-1])
            self.p["bc"] = np.log(weight / weight.sum()).astype(F32)
            self.p["bo"] = np.log(lexicon.mass / weight[self.of_class]).astype(F32)
        else:
            flat, at = np.frombuffer(packed, F32), 0
            self.p = {}
            for name, shape in self.shapes.items():
                size = int(np.prod(shape))
                self.p[name] = flat[at : at + size].reshape(shape).copy()
                at += size

    def packed(self) -> np.ndarray:
        return np.concatenate([self.p[name].ravel() for name in self.NAMES])

    def step(self, x: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
        """One step of the gates: x is the input's share, h the state."""
        a = h @ self.p["u"]
        zr = 1 / (1 + np.exp(-(x[:, : 2 * HIDDEN] + a[:, : 2 * HIDDEN])))
        z, r, an = zr[:, :HIDDEN], zr[:, HIDDEN:], a[:, 2 * HIDDEN :]
        n = np.tanh(x[:, 2 * HIDDEN :] + r * an)
        return n + z * (h - n), z, r, an, n

    def output(self, h: np.ndarray, unit: np.ndarray, grad: dict[str, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """Log probability of each unit after its state; with ``grad``, the gradients of their negative sum."""
        p, rows = self.p, np.arange(len(unit))
        # States lie between -1 and 1, which bounds the logits; large ones are shifted before exp.
        reach = max(float((np.abs(p[w]).sum(axis=1) + np.abs(p[b])).max()) for w, b in (("wc", "bc"), ("wo", "bo")))

        def exponentials(states: np.ndarray, w: np.ndarray, b: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Logits of the targets and all exponentials, which hold until the next call: one buffer serves all."""
            size = len(states) * len(w)
            if size > len(self.room):
                self.room = np.empty(size, F32)
            logits = np.matmul(states, w.T, out=self.room[:size].reshape(len(states), len(w)))
            logits += b
            if reach > 80:
                logits -= logits.max(axis=1, keepdims=True)
            picked = logits[rows[: len(states)], target]
            return picked, np.exp(logits, out=logits)

        of = self.of_class[unit]
        logs, e = exponentials(h, p["wc"], p["bc"], of)
        total = e.sum(axis=1)
        logs -= np.log(total)
        back = None
        if grad is not None:
            e /= total[:, None]
            e[rows, of] -= 1
            grad["wc"], grad["bc"], back = e.T @ h, e.sum(axis=0), e @ p["wc"]
            grad["wo"], grad["bo"] = np.zeros_like(p["wo"]), np.zeros_like(p["bo"])
        order = np.argsort(of, kind="stable")
        cuts = np.searchsorted(of[order], np.arange(len(self.begin)))
        for c in range(len(self.begin) - 1):
            own, lo, hi = order[cuts[c] : cuts[c + 1]], self.begin[c], self.begin[c + 1]
            if not len(own) or hi - lo == 1:
                continue
            mine, target = h[own], unit[own] - lo
            picked, e = exponentials(mine, p["wo"][lo:hi], p["bo"][lo:hi], target)
            total = e.sum(axis=1)
            logs[own] += picked - np.log(total)
            if grad is not None:
                e /= total[:, None]
                e[rows[: len(own)], target] -= 1
                grad["wo"][lo:hi], grad["bo"][lo:hi] = e.T @ mine, e.sum(axis=0)
                back[own] += e @ p["wo"][lo:hi]
        return logs, back


def in_step(bounds: np.ndarray) -> np.ndarray:
    """Texts from the longest to the shortest, so those still running are the first ones."""
    return np.argsort(-np.diff(bounds), kind="stable")


def window_of(units: np.ndarray, starts: np.ndarray, sizes: np.ndarray, at: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Units of the running texts from step ``at`` on, and which places hold one."""
    steps = at + np.arange(width)
    valid = steps[None, :] < sizes[:, None]
    return units[np.where(valid, starts[:, None] + steps, 0)], valid


def score_texts(net: Network, units: np.ndarray, bounds: np.ndarray, end_unit: int) -> np.ndarray:
    """Natural log probability of each text; its state runs through all its windows."""
    order, out = in_step(bounds), np.zeros(len(bounds) - 1)
    sizes, starts = np.diff(bounds)[order], bounds[:-1][order]
    h = np.zeros((len(order), HIDDEN), F32)
    before = np.full(len(order), end_unit)
    at = 0
    while len(sizes) and at < sizes[0]:
        active = int(np.searchsorted(-sizes, -at, side="left"))  # those longer than ``at``
        h, before = h[:active], before[:active]
        width = min(WINDOW, int(sizes[0]) - at)
        target, valid = window_of(units, starts[:active], sizes[:active], at, width)
        states = np.empty((width, active, HIDDEN), F32)
        for t in range(width):
            h = net.step(net.p["x"][before], h)[0]
            states[t] = h
            before = target[:, t]
        mask = valid.T
        logs, _ = net.output(states[mask], target.T[mask])
        out[order[:active]] += np.bincount(np.broadcast_to(np.arange(active), mask.shape)[mask], logs, active)
        at += width
    return out


def stretches(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and sizes of all stretches, the longest first."""
    n = -(-np.diff(bounds) // STRETCH)
    text = np.repeat(np.arange(len(n)), n)
    starts = bounds[:-1][text] + STRETCH * (np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n))
    sizes = np.minimum(STRETCH, bounds[1:][text] - starts)
    order = np.argsort(-sizes, kind="stable")
    return starts[order], sizes[order]


def train_texts(net: Network, squares: dict[str, np.ndarray], units: np.ndarray, bounds: np.ndarray, end_unit: int) -> None:
    """Truncated backpropagation over all texts, ``STREAMS`` stretches in step."""
    p = net.p
    every_start, every_size = stretches(bounds)
    # What stands before a stretch: the token before it, or an end token.
    previous = np.where(np.isin(every_start, bounds), end_unit, units[np.maximum(every_start - 1, 0)])
    for first in range(0, len(every_start), STREAMS):
        some = slice(first, first + STREAMS)
        starts, sizes = every_start[some], every_size[some]
        h, before = np.zeros((len(starts), HIDDEN), F32), previous[some]
        for at in range(0, int(sizes[0]), WINDOW):
            active = int(np.searchsorted(-sizes, -at, side="left"))
            h, before = h[:active], before[:active]
            width = min(WINDOW, int(sizes[0]) - at)
            target, valid = window_of(units, starts[:active], sizes[:active], at, width)
            inputs = np.column_stack([before, target[:, :-1]])
            kept, states = [], np.empty((width, active, HIDDEN), F32)
            for t in range(width):
                old = h
                h, z, r, an, n = net.step(p["x"][inputs[:, t]], h)
                kept.append((old, z, r, an, n))
                states[t] = h
            before = target[:, -1]
            mask = valid.T
            grad: dict[str, np.ndarray] = {}
            _, back = net.output(states[mask], target.T[mask], grad)
            from_output = np.zeros_like(states)
            from_output[mask] = back
            dx = np.empty((width, active, 3 * HIDDEN), F32)
            dh = np.zeros((active, HIDDEN), F32)
            du = np.zeros_like(p["u"])
            for t in range(width - 1, -1, -1):
                old, z, r, an, n = kept[t]
                dh = dh + from_output[t]
                dn = dh * (1 - z) * (1 - n * n)
                dz = dh * (old - n) * z * (1 - z)
                dr = dn * an * r * (1 - r)
                dx[t] = np.concatenate([dz, dr, dn], axis=1)
                da = np.concatenate([dz, dr, dn * r], axis=1)
                du += old.T @ da
                dh = dh * z + da @ p["u"].T
            tokens = max(1, int(mask.sum()))
            grad["u"] = du
            flat, rows = inputs.T.ravel(), dx.reshape(-1, 3 * HIDDEN)
            sort = np.argsort(flat, kind="stable")
            used, begin = np.unique(flat[sort], return_index=True)
            sums = np.add.reduceat(rows[sort], begin)
            scale = F32(1 / np.sqrt(tokens))
            for name, g in grad.items():
                g = np.clip(g * scale, -1, 1)
                squares[name] += g * g
                p[name] -= F32(RATE) * g / np.sqrt(squares[name])
            g = np.clip(sums * scale, -1, 1)
            squares["x"][used] += g * g
            p["x"][used] -= F32(RATE) * g / np.sqrt(squares["x"][used])


def train_round(docs: DataFrame, lexicon: Lexicon, packed: bytes | None) -> bytes | None:
    """Parameters after one round over ``docs``: the tasks' copies, averaged by their tokens."""
    context = docs.sparkSession.sparkContext
    shared = context.broadcast((lexicon, packed))
    end_unit = int(lexicon.look_up(np.array([END]), np.zeros(1, np.int32))[0][0])

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, packed = shared.value
        net, tokens = Network(lexicon, packed), 0
        squares = {name: np.full(shape, 0.1, F32) for name, shape in net.shapes.items()}
        for part in (part for batch in batches for part in slices(batch, "text", SLICE)):
            h, ending, bounds = hashed(part.column("text").to_pylist())
            train_texts(net, squares, lexicon.look_up(h, ending)[0], bounds, end_unit)
            tokens += len(h)
        if tokens:
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId() % GROUPS], pa.int32()), pa.array([float(tokens)]), pa.array([net.packed().tobytes()], pa.binary())],
                ["slot", "weight", "params"],
            )

    def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, weight = None, 0.0
        for batch in batches:
            for w, params in zip(batch.column("weight").to_pylist(), batch.column("params"), strict=True):
                own = np.frombuffer(params.as_buffer(), F32).astype(float) * w
                total, weight = own if total is None else total + own, weight + w
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([weight]), pa.array([(total / weight).astype(F32).tobytes()], pa.binary())], ["weight", "params"])

    copies = docs.select("text").mapInArrow(train, "slot int, weight double, params binary")
    groups = copies.repartition(GROUPS, "slot").mapInArrow(average, "weight double, params binary").collect()  # GROUPS rows at most
    if not groups:
        return packed
    weight = sum(row.weight for row in groups)
    return sum(np.frombuffer(row.params, F32).astype(float) * (row.weight / weight) for row in groups).astype(F32).tobytes()


def learn(training: DataFrame, counts: DataFrame, rounds: int = ROUNDS) -> tuple[Lexicon, bytes | None] | None:
    """Lexicon and parameters, or nothing if there is no training text."""
    total, distinct = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    if not total:
        return None
    known = counts.orderBy(F.col("n").desc(), "h").limit(KNOWN).toArrow()
    tails = counts.groupBy("ending").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).toArrow()
    lexicon, packed = Lexicon(known, tails, total, distinct), None
    for k in range(rounds):
        packed = train_round(training.where(F.pmod(F.xxhash64("doc_id"), F.lit(rounds)) == k), lexicon, packed)
    return lexicon, packed


def score_documents(docs: DataFrame, folds: int = 5, held: int = 1, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document."""
    part = fold(F.col("doc_id"), folds)
    training = docs.where(part != held).select("doc_id", "text")
    with small_batches(docs.sparkSession):  # training and scoring take slices of SLICE bytes as they are
        counts = stored(count_words(training))
    learned = learn(training, counts, rounds)
    shared = docs.sparkSession.sparkContext.broadcast(learned)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if shared.value is not None:
            lexicon, packed = shared.value
            net, whole = Network(lexicon, packed), np.log10(lexicon.total + 0.5 * (lexicon.distinct + 1))
            end_unit = int(lexicon.look_up(np.array([END]), np.zeros(1, np.int32))[0][0])
        for part in (part for batch in batches for part in slices(batch, "text", SLICE)):
            h, ending, bounds = hashed(part.column("text").to_pylist())
            n = len(bounds) - 1
            sizes = np.diff(bounds)
            if shared.value is None:
                known, base, model = (np.zeros(n, np.int64), np.zeros(n), np.zeros(n))
                text_of, rare, times = (np.zeros(0, np.int64),) * 3
            else:
                unit, count, tail = lexicon.look_up(h, ending)
                owner = np.repeat(np.arange(n), sizes)
                here = count >= 0
                own = np.where(here, np.log10(np.maximum(count, 0) + 0.5), 0.0)  # the rest is joined
                known = np.bincount(owner, here, n).astype(np.int64)
                base = np.bincount(owner, own - whole, n)
                within = np.where(tail, own - np.log10(lexicon.tail[ending]), 0.0)
                model = score_texts(net, unit, bounds, end_unit) / np.log(10) + np.bincount(owner, within, n)
                missed = np.flatnonzero(~here)
                sort = missed[np.lexsort((h[missed], owner[missed]))]
                head = np.flatnonzero(np.concatenate([[True], (h[sort][1:] != h[sort][:-1]) | (owner[sort][1:] != owner[sort][:-1])])) if len(sort) else sort
                text_of, rare, times = owner[sort][head], h[sort][head].view(np.int64), np.diff(np.append(head, len(sort)))
            cuts = pa.array(np.searchsorted(text_of, np.arange(n + 1)).astype("i4"))
            columns = [
                part.column("doc_id"), *[pa.array(c) for c in (sizes.astype(np.int64), known, base, model)],
                pa.ListArray.from_arrays(cuts, pa.array(rare)), pa.ListArray.from_arrays(cuts, pa.array(times.astype("i4"))),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "known", "base", "model", "rare", "times"])

    schema = f"doc_id {id_type}, n_tokens long, known long, base double, model double, rare array<long>, times array<int>"
    scored = docs.select("doc_id", "text").mapInArrow(score, schema)
    scored = stored(scored.withColumn("row", F.monotonically_increasing_id()))
    rare = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("r")).select("row", F.col("r.rare").alias("h"), F.col("r.times").alias("times"))
    joined = rare.join(counts.select("h", "n"), "h", "left")
    added = joined.groupBy(F.col("row").alias("of")).agg(
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("logs"), F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("seen")
    )
    every = scored.join(added, F.col("row") == F.col("of"), "left")
    logs = F.coalesce("logs", F.lit(0.0))
    return every.select(
        "doc_id", F.coalesce(part == held, F.lit(False)).alias("held_out"), "n_tokens", (F.col("known") + F.coalesce("seen", F.lit(0))).alias("n_known"),
        F.lit(learned[0].total if learned else 0).cast("bigint").alias("train_tokens"), (F.col("base") + logs).alias("base_score"), (F.col("model") + logs).alias("score"),
    )
