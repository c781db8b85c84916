"""Mixing sources to target weights by systematic sampling.

Every document of a source is expected ``target / source_size`` times. The expected
copies are added up along the documents of the source, one random offset is added, and
a document is emitted once for each integer boundary its stretch crosses. The documents
are laid out by size, so neighbours stand in for one another and the words taken come
near the target; the offset comes from a hash of the source and the seed, so reruns agree.

The prefix sums never gather a source: documents are range-partitioned by (source, size,
id) into slices, numbered inside each slice, and each slice starts from the counts of the
earlier ones. Since all documents of a source are expected equally often, the prefix sum
is their number times that.

Targets: sources in code-point order, null last, weigh ``weights`` in turn and share all
sizes; what exceeds ``cap`` times a source's size is shared again by weight. The fixed
point is ``min(cap * size, level * weight)``; the level follows from the sources sorted
by ``cap * size / weight``.

Defined cases: null or empty text has size 0, is never taken and does not count as a
document of the draw; a source of size 0 has target 0; null source is a source of its
own; documents with the same id and size are interchangeable; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesloom.llm.common import n_words, partitions, stored

WEIGHTS = (5.0, 2.0, 1.0)
CAP = 3
SEED = "mix-1"


def source_targets(sized: DataFrame, weights: Sequence[float] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """One row per source with its size and target; the windows run over these rows alone."""
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    wheel = F.array(*[F.lit(float(w)) for w in weights])
    weighed = sources.withColumn("weight", F.element_at(wheel, (place % len(weights) + 1).cast("int")))
    limit = (F.col("source_size") * cap).cast("double")
    order = Window.orderBy(limit / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    # Level if exactly the sources before this one are at their cap.
    level = (F.sum("source_size").over(Window.partitionBy()) - cap * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / F.sum(
        "weight"
    ).over(onward)
    tried = weighed.withColumn("level", level).withColumn("fits", F.col("level") * F.col("weight") <= limit)
    # From the first source that fits on, all have their share of its level.
    settled = tried.withColumn(
        "level", F.first(F.when(F.col("fits"), F.col("level")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    target = F.when(F.col("level").isNull(), limit).otherwise(F.least(F.col("level") * F.col("weight"), limit))
    return settled.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, cap: int = CAP, seed: str = SEED, keep: Sequence[str] = ()
) -> DataFrame:
    """``keep`` columns, doc_id, size, source_size, target and taken, one row per row of ``docs``."""
    spark = docs.sparkSession
    sized = docs.select(*keep, "doc_id", "source", n_words(F.col("text")).alias("size"))
    order = ["source", "size", "doc_id"]
    sliced = stored(sized.repartitionByRange(partitions(spark), *order).withColumn("slice", F.spark_partition_id()))
    targets = source_targets(sliced, weights, cap)
    drawn = sliced.where("size > 0")
    counts = drawn.groupBy("source", "slice").agg(F.count(F.lit(1)).alias("held"))
    earlier = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("source", "slice", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("start"))
    known = starts.join(targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).select(
        F.col("source").alias("of"), F.col("slice").alias("in_slice"), "start", "source_size", "target"
    )
    inside = F.row_number().over(Window.partitionBy("slice", "source").orderBy("size", "doc_id")) - 1
    numbered = drawn.withColumn("inside", inside)
    placed = numbered.join(known, (F.col("slice") == F.col("in_slice")) & F.col("source").eqNullSafe(F.col("of")))
    rate = F.col("target") / F.col("source_size")
    name = F.concat(F.lit(seed), F.lit(":"), F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n")))
    offset = F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
    index = F.col("start") + F.col("inside")
    copies = F.floor(offset + (index + 1) * rate) - F.floor(offset + index * rate)
    # Rounding of the products must not add a copy beyond the cap.
    taken = (F.least(copies, F.lit(cap)) * F.col("size")).cast("bigint")
    mixed = placed.select(*keep, "doc_id", "size", "source_size", "target", taken.alias("taken"))
    unsized = sliced.where("size = 0").join(targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
    return mixed.unionByName(unsized.select(*keep, "doc_id", "size", "source_size", "target", F.lit(0).cast("bigint").alias("taken")))
