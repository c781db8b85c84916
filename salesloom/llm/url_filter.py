"""URL rules by Bloom filter cascades: exact set membership without joins.

The keys a URL can match are known: the last ``n`` labels of its host followed by the
first ``m`` characters of its path, for each shape ``(n, m)`` that some rule has. All
such keys of the corpus are the key universe. Level 0 of a cascade encodes the listed
keys; level 1 the universe's false positives of level 0; level 2 the listed keys that
level 1 wrongly holds; and so on until a level has no false positive. The first level
that lacks a key decides it, so every key of the universe is judged exactly.

Sizes: with ``r`` listed keys and ``s`` others, level 0 takes the false-positive rate
``r * sqrt(0.5) / s`` and the other levels 0.5. A cascade then needs about
``1.44 * r * log2(s / r)`` bits and a few more a key: it follows the list and only the
logarithm of the corpus. The words travel as a literal of the plan; ``max_filter_bytes``
is checked before they are fetched.

Defined cases: a null url or one without ``://`` has an empty host and path and fits no
rule; a rule that is both allowed and blocked blocks; without rules, or where none
fits, the verdict is ``allow`` and the rule null; an empty table gives no rows; repeated
rows are judged each; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.llm.common import ascii_lower, stored

MAX_FILTER_BYTES = 64 << 20
LEVEL_RATE = 0.5


def url_host(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, "://([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def _positions(key: Column, level: int, bits: int, hashes: int) -> list[Column]:
    """Bit places of a key by double hashing; each level has its own two hashes."""
    first = F.pmod(F.xxhash64(key, F.lit(2 * level)), F.lit(bits))
    second = F.pmod(F.xxhash64(key, F.lit(2 * level + 1)), F.lit(bits))
    return [F.pmod(first + F.lit(i) * second, F.lit(bits)) for i in range(hashes)]


class Level:
    """One Bloom filter, as 64-bit words in an array literal."""

    def __init__(self, keys: DataFrame, n: int, rate: float, level: int, max_bytes: int):
        hashes = max(1, round(-math.log2(rate)))
        bits = 64 * math.ceil((-math.log(rate) / math.log(2) ** 2 * n + 64) / 64)
        if bits // 8 > max_bytes:
            raise ValueError(f"a level of {bits // 8} bytes is over max_filter_bytes={max_bytes}")
        self.level, self.bits, self.hashes = level, bits, hashes
        place = F.explode(F.array(*_positions(F.col("key"), level, bits, hashes)))
        words = (
            keys.select(place.alias("place"))
            .groupBy(F.floor(F.col("place") / 64).cast("int").alias("word"))
            .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("place") % 64).cast("int"))).alias("bits"))
        )
        held = {row.word: row.bits for row in words.collect()}  # at most bits / 64 rows
        self.words = ",".join(str(held.get(i, 0)) for i in range(bits // 64))

    def holds(self, key: Column) -> Column:
        words = F.split(F.lit(self.words), ",").cast("array<bigint>")
        tests = [
            F.getbit(F.element_at(words, (F.floor(p / 64) + 1).cast("int")), (p % 64).cast("int")) == 1
            for p in _positions(key, self.level, self.bits, self.hashes)
        ]
        return reduce(lambda a, b: a & b, tests)


class Cascade:
    """Exact membership of ``listed`` among ``universe`` (frames with one column ``key``)."""

    def __init__(self, listed: DataFrame, universe: DataFrame, max_bytes: int = MAX_FILTER_BYTES):
        tagged = (
            universe.select("key", F.lit(False).alias("is_listed"), F.lit(True).alias("is_seen"))
            .unionByName(listed.select("key", F.lit(True).alias("is_listed"), F.lit(False).alias("is_seen")))
            .groupBy("key")
            .agg(F.max("is_listed").alias("is_listed"), F.max("is_seen").alias("is_seen"))
        )
        # Listed keys that no URL can ask for need no place in the filter.
        inside = tagged.where("is_listed and is_seen").select("key")
        outside = tagged.where("not is_listed").select("key")
        self.levels: list[Level] = []
        n, others = inside.count(), outside.count()
        while n:
            rate = LEVEL_RATE
            if not self.levels:
                rate = min(LEVEL_RATE, n * math.sqrt(LEVEL_RATE) / max(others, 1))
            level = Level(inside, n, rate, len(self.levels), max_bytes)
            self.levels.append(level)
            # What the new level wrongly holds must be held by the next one.
            inside, outside = stored(outside.where(level.holds(F.col("key")))), inside
            n = inside.count()

    def holds(self, key: Column) -> Column:
        verdict = F.lit(len(self.levels) % 2 == 1)
        for depth in range(len(self.levels) - 1, -1, -1):
            verdict = F.when(self.levels[depth].holds(key), verdict).otherwise(F.lit(depth % 2 == 1))
        return verdict


def rule_shapes(rules: Sequence[tuple[str, str, str]]) -> list[tuple[int, int]]:
    return sorted({(host.count(".") + 1, len(path)) for host, path, _ in rules})


def candidate_keys(host: Column, path: Column, shapes: Sequence[tuple[int, int]]) -> Column:
    """Every key of the given shapes that the url has, as an array without nulls."""
    labels = F.size(F.split(host, r"\."))
    keys = [
        F.when(
            (labels >= n) & (F.length(path) >= m),
            F.concat(F.substring_index(host, ".", -n), F.substring(path, 1, m)),
        )
        for n, m in shapes
    ]
    return F.array_compact(F.array(*keys)) if keys else F.array().cast("array<string>")


def judge_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]],
    url: str = "url",
    keep: Sequence[str] = ("page_id",),
    max_filter_bytes: int = MAX_FILTER_BYTES,
) -> DataFrame:
    """``keep`` columns, host, path, the longest fitting rule and its verdict.

    ``rules`` are (host, path start, ``allow`` or ``block``).
    """
    spark = pages.sparkSession
    host, path = url_host(F.col(url)), url_path(F.col(url))
    shapes = rule_shapes(rules)
    read = pages.select(*keep, host.alias("host"), path.alias("path"))
    if not rules:
        return read.select(*keep, "host", "path", F.lit(None).cast("string").alias("rule"), F.lit("allow").alias("verdict"))
    asked = pages.select(F.explode(candidate_keys(host, path, shapes)).alias("key"))
    universe = stored(asked.distinct())
    lists = spark.createDataFrame([(h + p, action) for h, p, action in rules], "key string, action string")
    holds = {
        action: Cascade(lists.where(F.col("action") == action).select("key"), universe, max_filter_bytes).holds
        for action in ("block", "allow")
    }

    def judged(key: Column) -> Column:
        action = F.when(holds["block"](key), "block").when(holds["allow"](key), "allow")
        return F.struct(F.length(key).alias("size"), key.alias("key"), action.alias("action"))

    fits = F.filter(F.transform(candidate_keys(F.col("host"), F.col("path"), shapes), judged), lambda k: k["action"].isNotNull())
    best = F.array_max(fits)
    return read.select(
        *keep, "host", "path", best["key"].alias("rule"), F.coalesce(best["action"], F.lit("allow")).alias("verdict")
    )
