"""Connected components of a link table, by alternating stars.

Each round hangs the larger neighbours of every node, then its smaller ones, under the
smallest node it knows (large star and small star); the table turns into one star per
component in a logarithmic number of rounds. Links are only grouped with a minimum, and
joined to one row per node, so a hub neither gathers its neighbours in memory nor blocks
adaptive execution from splitting it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.llm.common import discard, stored


def _star(links: DataFrame, large: bool) -> DataFrame:
    """``links`` has one row (u, v) per link with u > v."""
    ways = links.select(F.col("u"), F.col("v"))
    if large:
        ways = ways.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = ways.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")).withColumnRenamed("u", "of")
    hung = ways.join(least, F.col("u") == F.col("of"))
    moved = hung.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")) if large else hung.select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:
        moved = moved.unionByName(least.select(F.col("of").alias("u"), F.col("m").alias("v")))
    return moved.where("u > v").distinct()


def components(links: DataFrame) -> DataFrame:
    """node, component for every node of a link table (a, b); the component is its smallest node."""
    pairs = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct()
    now = stored(pairs)
    seen = None
    while True:
        then = stored(_star(_star(now, large=True), large=False))
        # The order-free digest of the links tells whether a round changed them.
        digest = tuple(then.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        discard(now)
        now = then
        if digest == seen:
            break
        seen = digest
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
