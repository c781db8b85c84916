"""Personal data by bootstrapped contextual extraction.

Seeds are the spans that fixed rules find: emails, IPv4 addresses, card numbers that pass
the Luhn check, and international phone numbers. The words before and after a span are
its lexical patterns. Looser rules give candidates: written-out emails, phone numbers
without a country code, IPv6 addresses, card-like numbers. Patterns and the values they
surround make a graph that is scored in rounds: a pattern's confidence is the score of
the values it surrounds over all occurrences of its word in the corpus - as a whole word
if it stands apart from the span, at the start or end of words if it is glued to it, and
in any case those next to a span -, a value's score
the chance that one of its patterns is right (seeds keep 1). Candidates that end with a
score of ``accept`` or more are added; seeds always stay.

Everything is a column expression, a grouping or a join. Patterns with fewer than
``MIN_SUPPORT`` values are left out of the graph, the words of the others are counted in
all texts behind a Bloom filter of them, and every grouping adds up before its shuffle.

Defined cases: null text is empty and has no span; overlapping spans of different kinds
are all reported; a candidate that overlaps a seed of its kind is none; repeated rows are
searched each; an empty table gives no rows; other columns are carried if asked for.
Spans count code points, the end exclusive.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.llm.common import WORD, ascii_lower, stored
from salesloom.llm.url_filter import MAX_FILTER_BYTES, Level

KINDS = ("email", "ip", "card", "phone")
MIN_SUPPORT = 3
ACCEPT = 0.5
ROUNDS = 3
DOUBT = 2.0
REACH = 40
GROUP = 128

# Runs are matched from their start or from the end of the previous match only, and
# without backtracking into them, so long runs take linear time.
SEEDS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9]){15,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
HINTS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
CANDIDATES = {
    "email": r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{1,64}(?:\x20?[(\[{]at[)\]}]\x20?|\x20at\x20|@)[a-z0-9-]{1,63}(?:(?:\x20?[(\[{]dot[)\]}]\x20?|\x20dot\x20)[a-z0-9-]{1,63})+",
    "ip": r"(?i)(?<![0-9a-f:])(?:[0-9a-f]{1,4}:){7}[0-9a-f]{1,4}(?![0-9a-f:])",
    "card": r"(?<![0-9.\x20+-])[0-9]{4}(?:[\x20-]?[0-9]{4}){2}[\x20-]?[0-9]{1,7}(?![0-9])",
    "phone": r"(?<![0-9+.)(-])\(?[0-9]{3,4}\)?[\x20.-][0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9.-])",
}
CANDIDATE_HINTS = {"email": r"(?i)[(\[{\x20]dot[)\]}\x20]", "ip": r"(?i)[0-9a-f]:[0-9a-f]", "card": r"[0-9]{4}", "phone": r"[0-9]{3}[\x20.)-]"}
IP_PART = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
SPAN = "struct<kind:string,start:bigint,stop:bigint,value:string,before:string,after:string>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the check-sum."""

    def part(digit: Column, place: Column) -> Column:
        doubled = digit.cast("int") * F.when(place % 2 == 1, 2).otherwise(1)
        return doubled - F.when(doubled > 9, 9).otherwise(0)

    parts = F.transform(F.split(F.reverse(digits), "(?<=.)(?=.)"), part)
    return F.aggregate(parts, F.lit(0), lambda a, b: a + b) % 10 == 0


def _holds(kind: str, value: Column) -> Column:
    """Whether a match of a fixed rule passes the rule's check."""
    if kind == "ip":
        return value.rlike(rf"^{IP_PART}(?:\.{IP_PART}){{3}}$")
    if kind == "card":
        digits = _digits(value)
        return F.when(F.length(digits).between(16, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    return F.lit(True)


def _matches(text: Column, kind: str, pattern: str, wanted: Column) -> Column:
    """All matches of a pattern as spans with the text around them.

    The text between matches comes from splitting by the same pattern; positions are the
    sums of both lengths before them.
    """
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    n = F.size(values)
    pairs = F.arrays_zip(values.alias("value"), F.slice(gaps, 1, n).alias("gap"), F.slice(gaps, 2, n).alias("next"))
    none = F.array().cast(f"array<{SPAN}>")
    return F.when(wanted, _bound(pairs, lambda made: _placed(kind, made))).otherwise(none)


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda a, b: a + b)


def _placed(kind: str, pairs: Column) -> Column:
    """Spans of matches and the text between them.

    A span begins behind the blocks of ``GROUP`` matches before its own and the matches
    before it in its block, so finding all places takes little more than one pass.
    """

    def from_lengths(lengths: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), (F.size(lengths) / GROUP).cast("int")), lambda k: _sum(F.slice(lengths, k * GROUP + 1, F.lit(GROUP))))
        return _bound(blocks, lambda sums: F.transform(pairs, lambda pair, k: span(pair, k, lengths, sums)))

    def span(pair: Column, k: Column, lengths: Column, sums: Column) -> Column:
        block = (k / GROUP).cast("int")
        before = _sum(F.slice(sums, F.lit(1), block)) + _sum(F.slice(lengths, block * GROUP + 1, k % GROUP))
        return _bound(before + F.length(pair["gap"]), lambda start: F.struct(
            F.lit(kind).alias("kind"), start.cast("bigint").alias("start"), (start + F.length(pair["value"])).cast("bigint").alias("stop"),
            pair["value"].alias("value"),
            F.substring(pair["gap"], -REACH, REACH).alias("before"), F.substring(pair["next"], 1, REACH).alias("after"),
        ))

    lengths = F.transform(pairs, lambda pair: F.length(pair["gap"]) + F.length(pair["value"]))
    return _bound(lengths, from_lengths)


def seed_spans(text: Column) -> Column:
    """Spans of the fixed rules, by kind as listed and then by start."""

    def of(kind: str) -> Column:
        wanted = F.contains(text, F.lit(HINTS[kind])) if HINTS[kind] else text.rlike("[0-9]")
        return F.filter(_matches(text, kind, SEEDS[kind], wanted), lambda s: _holds(kind, s["value"]))

    return F.concat(*map(of, KINDS))


def candidate_spans(text: Column, seeds: Column) -> Column:
    """Spans of the looser rules that overlap no seed of their kind."""
    found = F.concat(*[_matches(text, kind, CANDIDATES[kind], text.rlike(CANDIDATE_HINTS[kind])) for kind in KINDS])
    clear = lambda c: ~F.exists(seeds, lambda s: (s["kind"] == c["kind"]) & (s["start"] < c["stop"]) & (c["start"] < s["stop"]))
    return F.filter(found, clear)


def _graph(searched: DataFrame) -> DataFrame:
    """kind, value, is_seed, side, unit, word, n: values and the words next to them, counted.

    ``unit`` says of what the word is an occurrence: a whole word (W), or the start (P) or
    end (S) of the word that the span is in.
    """
    spans = searched.select(F.explode("_seeds").alias("s"), F.lit(True).alias("is_seed")).unionByName(
        searched.select(F.explode("_candidates").alias("s"), F.lit(False).alias("is_seed"))
    )
    left = F.regexp_extract(F.col("s.before"), rf"({WORD})[\x20\x09-\x0D]*$", 1)
    right = F.regexp_extract(F.col("s.after"), rf"^[\x20\x09-\x0D]*({WORD})", 1)
    unit_left = F.when(F.col("s.before").rlike(r"[\x20\x09-\x0D]$"), "W").otherwise("P")
    unit_right = F.when(F.col("s.after").rlike(r"^[\x20\x09-\x0D]"), "W").otherwise("S")
    sides = F.array(
        F.struct(F.lit("L").alias("side"), unit_left.alias("unit"), ascii_lower(left).alias("word")),
        F.struct(F.lit("R").alias("side"), unit_right.alias("unit"), ascii_lower(right).alias("word")),
    )
    edges = spans.select(F.col("s.kind").alias("kind"), F.col("s.value").alias("value"), "is_seed", F.explode(sides).alias("p"))
    edges = edges.select("kind", "value", "is_seed", "p.side", "p.unit", "p.word").where("word <> ''")
    return edges.groupBy("kind", "value", "is_seed", "side", "unit", "word").agg(F.count(F.lit(1)).alias("n"))


def _units(word: Column, lengths: dict[str, list[int]]) -> Column:
    """A word as a whole and its starts and ends of the given lengths, each behind its unit's letter."""

    def cut(unit: str, of) -> Column:
        proper = F.filter(F.array(*map(F.lit, lengths[unit])), lambda k: k < F.length(word))
        return F.transform(proper, lambda k: F.concat(F.lit(unit), of(k)))

    parts = [F.array(F.concat(F.lit("W"), word))]
    parts += [cut("P", lambda k: F.substr(word, F.lit(1), k))] if lengths["P"] else []
    parts += [cut("S", lambda k: F.substr(word, F.length(word) - k + 1, k))] if lengths["S"] else []
    return F.concat(*parts)


def accepted_values(searched: DataFrame, text: Column, accept: float = ACCEPT, rounds: int = ROUNDS) -> DataFrame:
    """kind, value of the candidates that their patterns confirm."""
    edges = stored(_graph(searched))
    pattern = ["kind", "side", "unit", "word"]
    used = edges.groupBy(*pattern).agg(F.count(F.lit(1)).alias("support"), F.sum("n").alias("beside")).where(F.col("support") >= MIN_SUPPORT)
    # Only patterns next to a candidate can confirm one.
    used = stored(used.join(edges.where("not is_seed").select(*pattern).distinct(), pattern, "left_semi"))
    words = stored(used.select(F.concat("unit", "word").alias("key")).distinct())
    n = words.count()
    if not n:
        return edges.where(F.lit(False)).select("kind", "value")
    held = Level(words, n, 0.01, 0, MAX_FILTER_BYTES)
    # Fragments are of at most REACH lengths.
    sizes = used.where("unit <> 'W'").select("unit", F.length("word").alias("size")).distinct().collect()
    lengths = {unit: sorted(row["size"] for row in sizes if row["unit"] == unit) for unit in "PS"}
    every = searched.select(F.explode(F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0))).alias("key"))
    every = every.select(F.explode(_units(F.col("key"), lengths)).alias("key")).where(held.holds(F.col("key")))
    totals = every.groupBy("key").agg(F.count(F.lit(1)).alias("total"))
    # A fragment between two spans is at no word's end, so what stands beside spans counts at least.
    total = F.greatest(F.coalesce("total", F.lit(0)), "beside").alias("total")
    patterns = stored(used.join(totals, F.concat("unit", "word") == F.col("key"), "left").select(*pattern, total))
    graph = stored(edges.join(patterns, pattern))
    scores = graph.select("kind", "value", "is_seed").distinct().withColumn("score", F.col("is_seed").cast("double"))
    for _ in range(rounds):
        weighed = graph.join(scores, ["kind", "value", "is_seed"]).groupBy(*pattern, "total").agg(F.sum(F.col("n") * F.col("score")).alias("hits"))
        confident = weighed.select(*pattern, F.least(F.col("hits") / (F.col("total") + DOUBT), F.lit(0.999999)).alias("confidence"))
        wrong = graph.join(confident, pattern).groupBy("kind", "value", "is_seed").agg(F.sum(F.log(1 - F.col("confidence"))).alias("wrong"))
        scores = stored(wrong.select("kind", "value", "is_seed", F.when(F.col("is_seed"), 1.0).otherwise(1 - F.exp("wrong")).alias("score")))
    return scores.where(~F.col("is_seed") & (F.col("score") >= accept)).select("kind", "value")


def find_spans(
    docs: DataFrame, keep: Sequence[str] = ("doc_id",), accept: float = ACCEPT, rounds: int = ROUNDS, with_text: bool = False
) -> DataFrame:
    """``keep`` columns (and ``_text``, the searched text) with ``_seeds`` and ``_spans``:
    the fixed rules' spans, and all."""
    keep = list(keep)
    source = docs.select(*keep, F.coalesce(F.col("text"), F.lit("")).alias("_text"))
    seeded = source.withColumn("_row", F.monotonically_increasing_id()).withColumn("_seeds", seed_spans(F.col("_text")))
    # Rows are numbered and searched once; later reads see the same numbers.
    searched = stored(seeded.withColumn("_candidates", candidate_spans(F.col("_text"), F.col("_seeds"))))
    keep += ["_text"] if with_text else []
    met = searched.where(F.size("_candidates") > 0)
    # Texts without a candidate are as the fixed rules leave them, and are not moved.
    plain = searched.where(F.size("_candidates") == 0).select(*keep, "_seeds", F.col("_seeds").alias("_spans"))
    if met.isEmpty():
        return plain
    values = accepted_values(searched, F.col("_text"), accept, rounds)
    added = met.select("_row", F.explode("_candidates").alias("s")).join(
        values.withColumnRenamed("kind", "of_kind").withColumnRenamed("value", "of_value"),
        (F.col("s.kind") == F.col("of_kind")) & (F.col("s.value") == F.col("of_value")),
    )
    added = added.groupBy(F.col("_row").alias("_at")).agg(F.collect_list("s").alias("_added"))  # spans of one text
    every = F.concat("_seeds", F.coalesce("_added", F.array().cast(f"array<{SPAN}>")))
    rank = lambda s: F.array_position(F.array(*[F.lit(k) for k in KINDS]), s["kind"])
    order = lambda a, b: F.when(rank(a) != rank(b), rank(a) - rank(b)).otherwise(a["start"] - b["start"]).cast("int")
    joined = met.join(added, F.col("_row") == F.col("_at"), "left")
    return plain.unionByName(joined.select(*keep, "_seeds", F.array_sort(every, order).alias("_spans")))


def span_names(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, seed counts by kind, digest of the seeds and all spans."""
    found = find_spans(docs)

    def count(kind: str) -> Column:
        return F.size(F.filter("_seeds", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    counts = [count(kind) for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(span_names(F.col("_seeds")), 256).alias("base_sha256"), span_names(F.col("_spans")).alias("spans"))


def redact(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; overlapping spans give one mark."""
    ordered = F.array_sort(spans, lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(b["stop"] - a["stop"]).cast("int"))
    begin = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def step(done: Column, span: Column) -> Column:
        plain = F.substr(text, (done["at"] + 1).cast("int"), (span["start"] - done["at"]).cast("int"))
        fresh = F.concat(done["out"], plain, F.lit("["), F.upper(span["kind"]), F.lit("]"))
        covered = span["start"] < done["at"]
        return F.struct(F.greatest(done["at"], span["stop"]).alias("at"), F.when(covered, done["out"]).otherwise(fresh).alias("out"))

    done = F.aggregate(ordered, begin, step)
    cut = F.concat(done["out"], F.substr(text, (done["at"] + 1).cast("int")))
    return F.when(F.size(spans) > 0, cut).otherwise(text)
