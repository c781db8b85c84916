"""Quality rules: repetition rules, and perplexity under a modified Kneser-Ney model.

The model has one part per language and is made of character n-grams. Letters a-z (case
folded), space, common marks and every other code point have a symbol of their own; digits
share one, and so do the signs of the symbol count. Code points above U+FFFF are two symbols,
as in UTF-16, so a 4-gram is a key of 64 bits and no two different ones share a key. Tasks
count the 4-grams of their texts in numpy, Spark adds the counts up and derives the
continuation counts of the lower orders and the counts of counts, over all documents.

A model of up to ``MODEL_KEYS`` 4-grams goes to every task as arrays sorted by key, looked up
by binary search. A greater one (scripts of thousands of signs) stays in Spark: the
probabilities are joined to the different 4-grams of each few MB of texts, and these texts
are scored with them, so no task and no driver holds more; both ways give the same scores.
The ``MAX_LANGS`` languages with the most documents have parts of their own, all further
ones share one; bands are always those of a document's own language.

A document's score is its log10 perplexity per run of letters, so marks between the words
of a text cost it something even where they are common. For each language, the band is
``[q1 - low * (q3 - q1), q3 + high * (q3 - q1)]`` over the documents of the language that
pass the repetition rules; documents outside fail. Short texts have wider bands: the
distance to the band's middle is shrunk by ``runs / (runs + SHRINK)``.

Defined cases: null text has no words and fails the base rules; very long texts are scored
whole; a null language is a language of its own; a language of few documents has the band
of those few; a text without symbols has score 0, one without letters counts as one run; repeated rows are judged each;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.llm.common import slices, small_batches, stored

ORDER = 4
# Bits of a symbol in a key: enough for the named ones, and for all.
NAMED_BITS = 6
BITS = 16
# Order 0 deals equal shares to the 40 named symbols, and as many as 24 of them have to the others.
NAMED = 40
OTHERS = (1 << NAMED_BITS) - NAMED
# 4-grams of a model that is sent to every task, some 24 bytes each with the lower orders.
MODEL_KEYS = 1 << 22
# 4-grams of a language that a counting task holds before it sends them on.
HELD_KEYS = 1 << 21
SPACE = 0
LOW, HIGH = 3.0, 3.0
SHRINK = 30
WHITE = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
MAX_LANGS = 64
# The part that languages beyond those share; no language has such a name.
REST = "\uffff"
# Symbols of their own besides space (0) and a-z (1-26); digits share 27, ``SYMBOLS`` 39.
MARKS = ".,!?'\"-()@/"


def symbol_table() -> np.ndarray:
    """Symbol of each UTF-16 unit: the named ones share some, all others have one each."""
    table = np.arange(1 << BITS, dtype=np.uint64)
    others = np.ones(128, bool)
    for white in WHITE:
        table[ord(white)], others[ord(white)] = SPACE, False
    for place in range(26):
        table[ord("a") + place] = table[ord("A") + place] = 1 + place
        others[ord("a") + place] = others[ord("A") + place] = False
    for digit in "0123456789":
        table[ord(digit)], others[ord(digit)] = 27, False
    for place, mark in enumerate(MARKS):
        table[ord(mark)], others[ord(mark)] = 28 + place, False
    for sign in SYMBOLS:
        table[ord(sign)], others[ord(sign)] = 28 + len(MARKS), False
    table[:128][others] = NAMED + np.arange(others.sum())  # below 128, where the others begin
    return table


def ngram_keys(text: str, table: np.ndarray, bits: int = NAMED_BITS) -> np.ndarray:
    """Keys of all 4-grams of a text that begins after ``ORDER - 1`` spaces. ``NAMED_BITS``
    hold texts of named symbols, ``BITS`` hold all."""
    units = np.frombuffer(text.encode("utf-16-le", "surrogatepass"), dtype="<u2")
    if not len(units):
        return np.zeros(0, np.int64)
    codes = np.concatenate([np.full(ORDER - 1, SPACE, np.uint64), table[units]])
    n = len(units)
    keys = codes[:n]
    for place in range(1, ORDER):
        keys = (keys << np.uint64(bits)) | codes[place : place + n]
    return keys.view(np.int64)


def letter_runs(keys: np.ndarray) -> int:
    """Number of runs of letters, or of code points without a named symbol."""
    last = keys & ((1 << BITS) - 1)
    letter = ((last > 0) & (last <= 26)) | (last >= NAMED)
    return int(letter[:1].sum() + (letter[1:] & ~letter[:-1]).sum())


def by_language(batch: pa.RecordBatch, own: frozenset) -> dict[str | None, list[int]]:
    """Rows of each part of the model."""
    groups: dict[str | None, list[int]] = {}
    for row, lang in enumerate(batch.column("lang").to_pylist()):
        groups.setdefault(lang if lang in own else REST, []).append(row)
    return groups


def modelled_languages(docs: DataFrame, most: int = MAX_LANGS) -> frozenset:
    """The ``most`` languages with the most documents."""
    counts = docs.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    return frozenset(row.lang for row in counts.orderBy(F.col("n").desc(), F.col("lang").asc_nulls_first()).limit(most).collect())


def summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    found, place = np.unique(np.concatenate(keys), return_inverse=True)
    return found, np.bincount(place, np.concatenate(counts), len(found)).astype(np.int64)


def counted_rows(lang: str | None, found: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array([lang] * len(found), pa.string()), pa.array(found), pa.array(n.astype(np.int64))]
    return pa.RecordBatch.from_arrays(columns, ["lang", "key", "n"])


def count_ngrams(docs: DataFrame, own: frozenset) -> DataFrame:
    """lang (of a part), key, n of every 4-gram of every text; tasks add up before the shuffle."""
    table = symbol_table()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str | None, tuple[np.ndarray, np.ndarray]] = {}
        for batch in (part for whole in batches for part in slices(whole, "text")):
            texts = batch.column("text")
            for lang, rows in by_language(batch, own).items():
                every = [ngram_keys(texts[row].as_py() or "", table, BITS) for row in rows]
                found, n = np.unique(np.concatenate(every), return_counts=True)
                old = held.get(lang)
                held[lang] = summed([old[0], found], [old[1], n]) if old else (found, n)
                if len(held[lang][0]) > HELD_KEYS:
                    yield counted_rows(lang, *held.pop(lang))
        for lang, (found, n) in held.items():
            yield counted_rows(lang, found, n)

    counted = docs.select("lang", "text").mapInArrow(count, "lang string, key long, n long")
    return counted.groupBy("lang", "key").agg(F.sum("n").alias("n"))


def with_lower_orders(counts: DataFrame) -> DataFrame:
    """Adds the lower orders, counted by the number of different symbols before them."""
    orders = [counts.select("lang", F.lit(ORDER).alias("size"), "key", "n")]
    for size in range(ORDER - 1, 0, -1):
        key = F.col("key").bitwiseAND(F.lit((1 << BITS * size) - 1))
        shorter = orders[-1].groupBy("lang", key.alias("key")).agg(F.count(F.lit(1)).alias("n"))
        orders.append(shorter.select("lang", F.lit(size).alias("size"), "key", "n"))
    frame = orders[0]
    for shorter in orders[1:]:
        frame = frame.unionByName(shorter)
    return frame


def discounts(n: np.ndarray) -> np.ndarray:
    """Discounts for counts 0, 1, 2 and 3 or more; half a count where the counts of
    counts are too sparse for the estimate."""
    return discounts_of(np.bincount(np.minimum(n, 5), minlength=6))


def discounts_of(tallies: Sequence[int]) -> np.ndarray:
    """``discounts`` from how many n-grams have each count up to 4, and 5 or more."""
    of = np.asarray(tallies, float)
    if not of[1] or not of[2]:
        return np.array([0.0, 0.5, 0.5, 0.5])
    y = of[1] / (of[1] + 2 * of[2])
    made = [k - (k + 1) * y * of[k + 1] / of[k] if of[k] else 0.5 for k in (1, 2, 3)]
    return np.array([0.0, *[min(max(d, 0.05), k - 0.05) for k, d in zip((1, 2, 3), made, strict=True)]])


def base_of_others(n: int) -> float:
    """Probability at order 0 of a symbol that is not named, where a part has ``n`` of them."""
    return OTHERS * 2.0**-NAMED_BITS / max(int(n), OTHERS)


class Model:
    """One language's n-grams in sorted arrays: keys of ``bits`` a symbol and interpolated
    log10 probabilities by order, contexts and their log10 back-off weights."""

    def __init__(self, orders: dict[int, tuple[np.ndarray, np.ndarray]], bits: int = NAMED_BITS):
        self.bits = bits
        self.keys, self.logs, self.contexts, self.weights = {}, {}, {}, {}
        self.other = base_of_others((orders[1][0] >= NAMED).sum())
        for size in range(1, ORDER + 1):
            keys, n = orders[size]
            sort = np.argsort(keys, kind="stable")
            keys, n = keys[sort].astype(np.int64), n[sort]
            cut = discounts(n)
            contexts, place = np.unique(keys >> bits, return_inverse=True)
            total = np.bincount(place, n, len(contexts))
            taken = np.bincount(place, cut[np.minimum(n, 3)], len(contexts))
            rest = taken / total
            lower = 10 ** self.logs_of(size - 1, self.shorter(size, keys))
            p = (n - cut[np.minimum(n, 3)]) / total[place] + rest[place] * lower
            self.keys[size], self.logs[size] = keys, np.log10(p)
            self.contexts[size], self.weights[size] = contexts, np.log10(np.maximum(rest, 1e-12))

    def shorter(self, size: int, keys: np.ndarray) -> np.ndarray:
        """Keys without their first symbol; those of order 0 are the last symbol."""
        return keys & ((1 << self.bits * max(size - 1, 1)) - 1)

    def logs_of(self, size: int, keys: np.ndarray) -> np.ndarray:
        """log10 probability of each key's last symbol after its others."""
        if size == 0:
            return np.log10(np.where(keys < NAMED, 2.0**-NAMED_BITS, self.other))
        known = self.keys[size]
        place = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        out = self.logs[size][place]
        missed = np.flatnonzero(known[place] != keys)
        if len(missed):
            key = keys[missed]
            contexts = self.contexts[size]
            at = np.minimum(np.searchsorted(contexts, key >> self.bits), len(contexts) - 1)
            weight = np.where(contexts[at] == key >> self.bits, self.weights[size][at], 0.0)
            out = out.copy()
            out[missed] = weight + self.logs_of(size - 1, self.shorter(size, key))
        return out


def encoded(names: pa.ChunkedArray) -> tuple[np.ndarray, list[str | None]]:
    """Places of the names in the list of different ones, which may hold null, and that list."""
    coded = pa.chunked_array(names.chunks, pa.string()).combine_chunks().dictionary_encode(null_encoding="encode")
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_pylist()


def train(counts: DataFrame) -> dict[str | None, Model]:
    """One model per part from the stored counts of all documents, which come to the driver."""
    table = with_lower_orders(counts).toArrow()
    part, names = encoded(table.column("lang"))
    size, key, n = (table.column(c).to_numpy() for c in ("size", "key", "n"))
    models = {}
    for place, name in enumerate(names):
        own = part == place
        orders = {k: (key[own & (size == k)], n[own & (size == k)]) for k in range(1, ORDER + 1)}
        models[name] = Model(orders, BITS)
    return models


def probabilities(counts: DataFrame) -> DataFrame:
    """lang, key, log of the 4-grams of the stored counts: ``Model`` as Spark joins. A part has
    four rows of counts of counts, which alone come to the driver."""
    orders = stored(with_lower_orders(counts))
    tiny = [F.count_if(F.col("n") == k) if k < 5 else F.count_if(F.col("n") >= k) for k in range(1, 6)]
    tallies = orders.groupBy("lang", "size").agg(F.array(*tiny).alias("of"), F.count_if(F.col("key") >= NAMED).alias("others")).collect()
    others = {row.lang: base_of_others(row.others) for row in tallies if row["size"] == 1}
    cuts = [(row.lang, row["size"], *map(float, discounts_of([0, *row.of])[1:]), others[row.lang]) for row in tallies]
    cuts = F.broadcast(counts.sparkSession.createDataFrame(cuts, "of_lang string, of_size int, d1 double, d2 double, d3 double, other double"))
    below = None
    for size in range(1, ORDER + 1):
        here = orders.where(F.col("size") == size)
        here = here.join(cuts, F.col("lang").eqNullSafe(F.col("of_lang")) & (F.col("size") == F.col("of_size")))
        cut = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        context = F.shiftright("key", BITS)
        here = here.select("lang", "key", "n", cut.alias("cut"), "other", context.alias("context"))
        sums = here.groupBy(F.col("lang").alias("of_lang"), F.col("context").alias("of_context"))
        sums = sums.agg(F.sum("n").alias("total"), F.sum("cut").alias("taken"))
        same = F.col("lang").eqNullSafe(F.col("of_lang")) & (F.col("context") == F.col("of_context"))
        here = here.join(sums, same).drop("of_lang", "of_context")
        if below is None:
            lower = F.when(F.col("key") < NAMED, F.lit(2.0**-NAMED_BITS)).otherwise(F.col("other"))
        else:
            shorter = F.col("key").bitwiseAND(F.lit((1 << BITS * (size - 1)) - 1))
            same = F.col("lang").eqNullSafe(F.col("of_lang")) & (shorter == F.col("of_key"))
            here, lower = here.join(below.toDF("of_lang", "of_key", "lower"), same), F.col("lower")
        p = (F.col("n") - F.col("cut")) / F.col("total") + F.col("taken") / F.col("total") * lower
        below = here.select("lang", "key", p.alias("p"))
    return below.select("lang", "key", F.log10("p").alias("log"))


class Known:
    """Probabilities of all 4-grams that some texts have, looked up as in ``Model``."""

    def __init__(self, keys: np.ndarray, logs: np.ndarray):
        sort = np.argsort(keys, kind="stable")
        self.keys, self.logs = keys[sort], logs[sort]

    def logs_of(self, size: int, keys: np.ndarray) -> np.ndarray:
        return self.logs[np.searchsorted(self.keys, keys)]


def repetition(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = text.encode("utf-8", "surrogatepass").split()  # bytes split at space and 0x09-0x0D only
    lines = [line for line in text.split("\n") if line.strip(WHITE)]
    repeated = 0
    if len(words) > 5:
        seen: dict[bytes, int] = {}
        ids = np.fromiter((seen.setdefault(word, len(seen)) for word in words), np.uint64, len(words))
        ids = (ids + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        ids ^= ids >> np.uint64(29)
        windows = np.zeros(len(words) - 4, np.uint64)
        for place in range(5):
            windows = (windows ^ ids[place : place + len(windows)]) * np.uint64(0xBF58476D1CE4E5B9)
            windows ^= windows >> np.uint64(32)
        found, place, n = np.unique(windows, return_inverse=True, return_counts=True)
        if len(found) < len(windows):
            marks = np.zeros(len(words) + 1, np.int64)
            twice = np.flatnonzero(n[place] > 1)
            np.add.at(marks, twice, 1)
            np.add.at(marks, twice + 5, -1)
            repeated = int((np.cumsum(marks) > 0).sum())
    white = sum(map(text.count, WHITE))
    return len(words), len(text) - white, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated


MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def judged(batch: pa.RecordBatch, models: dict, own: frozenset, table: np.ndarray) -> pa.RecordBatch:
    """doc_id, lang, the measures, log10 perplexity and n_runs of a batch of texts."""
    texts = [text or "" for text in batch.column("text").to_pylist()]
    measures = np.array([repetition(text) for text in texts], np.int64).reshape(len(texts), len(MEASURES))
    scores, sizes = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
    for lang, rows in by_language(batch, own).items():
        every = [ngram_keys(texts[row], table, BITS) for row in rows]
        n = np.array([len(keys) for keys in every])
        logs = models[lang].logs_of(ORDER, np.concatenate(every)) if lang in models else np.zeros(n.sum())
        sums = np.add.reduceat(np.append(logs, 0.0), np.concatenate([[0], np.cumsum(n)[:-1]])) * (n > 0)
        runs = np.array([letter_runs(keys) for keys in every])
        scores[rows] = -sums / np.maximum(runs, 1)
        sizes[rows] = runs
    columns = [batch.column("doc_id"), batch.column("lang"), *[pa.array(m) for m in measures.T], pa.array(scores), pa.array(sizes)]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "lang", *MEASURES, "log_perplexity", "n_runs"])


def _measured_schema(docs: DataFrame) -> str:
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return f"doc_id {id_type}, lang string, " + ", ".join(f"{m} long" for m in MEASURES) + ", log_perplexity double, n_runs long"


def measure_everywhere(docs: DataFrame, models: dict[str | None, Model], own: frozenset) -> DataFrame:
    """The texts judged where they are read, with a model that every task holds."""
    shared = docs.sparkSession.sparkContext.broadcast(models)
    table = symbol_table()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "text")):
            yield judged(batch, shared.value, own, table)

    return docs.select("doc_id", "lang", "text").mapInArrow(judge, _measured_schema(docs))


def measure_by_chunks(docs: DataFrame, logs: DataFrame, own: frozenset) -> DataFrame:
    """The texts judged by chunks of a few MB, which meet the probabilities of their own 4-grams."""
    table = symbol_table()
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "text")):
            yield batch.append_column("chunk", pa.array([uuid.uuid4().hex] * batch.num_rows))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "text")):
            for chunk in batch.column("chunk").unique():
                part = batch.filter(pc.equal(batch.column("chunk"), chunk))
                texts = part.column("text")
                for lang, rows in by_language(part, own).items():
                    keys = np.unique(np.concatenate([ngram_keys(texts[row].as_py() or "", table, BITS) for row in rows]))
                    columns = [pa.array([chunk.as_py()] * len(keys), pa.string()), pa.array([lang] * len(keys), pa.string()), pa.array(keys)]
                    yield pa.RecordBatch.from_arrays(columns, ["chunk", "of_lang", "of_key"])

    def judge(texts: pa.Table, known: pa.Table) -> pa.Table:
        part, names = encoded(known.column("lang"))
        keys, logs = known.column("key").to_numpy(), known.column("log").to_numpy()
        models = {name: Known(keys[part == place], logs[part == place]) for place, name in enumerate(names)}
        batches = texts.select(["doc_id", "lang", "text"]).combine_chunks().to_batches()
        return pa.Table.from_batches([judged(batch, models, own, table) for batch in batches])

    # Which chunk a text is in is drawn once and stored.
    texts = stored(docs.select("doc_id", "lang", "text").mapInArrow(deal, f"doc_id {id_type}, lang string, text string, chunk string"))
    keys = texts.select("lang", "text", "chunk").mapInArrow(found, "chunk string, of_lang string, of_key long")
    same = F.col("lang").eqNullSafe(F.col("of_lang")) & (F.col("key") == F.col("of_key"))
    known = keys.join(logs, same).select("chunk", "lang", "key", "log")
    return texts.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(judge, _measured_schema(docs))


def measure(docs: DataFrame, own: frozenset, min_words: int, max_repeat_pct: int, most: int = MODEL_KEYS) -> DataFrame:
    """doc_id, lang, the measures, base_failed, log10 perplexity and n_runs. A model of ``most``
    4-grams at most is sent to the tasks."""
    counts = stored(count_ngrams(docs, own))
    if counts.count() <= most:
        measured = measure_everywhere(docs, train(counts), own)
    else:
        measured = measure_by_chunks(docs, stored(probabilities(counts)), own)
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_pct * F.col("n_words"))
    return measured.withColumn("base_failed", failed)


def judge_quality(
    docs: DataFrame, min_words: int = 10, max_repeat_pct: int = 20, low: float = LOW, high: float = HIGH
) -> DataFrame:
    """doc_id, lang, measures, base_failed, log_perplexity, kept: one row per row of ``docs``."""
    own = modelled_languages(docs)
    with small_batches(docs.sparkSession):
        measured = stored(measure(docs, own, min_words, max_repeat_pct))
    quartiles = F.percentile_approx("log_perplexity", F.array(F.lit(0.25), F.lit(0.75)), 10_000)
    bands = measured.where("not base_failed").groupBy("lang").agg(quartiles.alias("q"))
    q1, q3 = F.col("q")[0], F.col("q")[1]
    bands = bands.select(
        F.col("lang").alias("of_lang"), q1.alias("q1"), q3.alias("q3"),
        (q1 - low * (q3 - q1)).alias("band_low"), (q3 + high * (q3 - q1)).alias("band_high"),
    )
    scored = measured.join(bands, F.col("lang").eqNullSafe(F.col("of_lang")), "left")
    trust = F.col("n_runs") / (F.col("n_runs") + SHRINK)
    middle = (F.col("q1") + F.col("q3")) / 2
    shrunk = middle + (F.col("log_perplexity") - middle) * trust
    kept = ~F.col("base_failed") & F.coalesce(shrunk.between(F.col("band_low"), F.col("band_high")), F.lit(True))
    return scored.select("doc_id", "lang", *MEASURES, "base_failed", "log_perplexity", kept.alias("kept"))
