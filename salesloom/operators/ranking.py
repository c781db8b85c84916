"""Running sums and row numbers over a whole table without sorting it in one task.

A window without ``partitionBy`` moves every row into a single partition. Here
the rows are range-partitioned into sorted slices, each slice is totalled, and
every slice starts from the total of the slices before it. Only the slice
totals, one row per partition, meet in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesloom.operators.lineage import materialized

SUM_TYPE = "decimal(38,4)"


def _sliced(df: DataFrame, order: Sequence[Column], slices: int | None) -> DataFrame:
    """Rows in sorted slices. Written down, because range bounds come from a
    sample and must not be drawn again by a second reader or a retried task."""
    count = slices or max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    ranged = df.repartitionByRange(count, *order)
    return materialized(ranged.withColumn("_slice", F.spark_partition_id()))


def _slice_offsets(sliced: DataFrame, amounts: dict[str, Column]) -> DataFrame:
    """Totals of all earlier slices; one row per slice."""
    totals = sliced.groupBy("_slice").agg(*[agg.alias(name) for name, agg in amounts.items()])
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        "_slice", *[F.coalesce(F.sum(name).over(before), F.lit(0)).alias(name) for name in amounts]
    )


def numbered(df: DataFrame, name: str, order: Sequence[Column], slices: int | None = None) -> DataFrame:
    """``ROW_NUMBER() OVER (ORDER BY ...)``. ``order`` must identify a row."""
    sliced = _sliced(df, order, slices)
    offsets = _slice_offsets(sliced, {"_before": F.count(F.lit(1))})
    inside = F.row_number().over(Window.partitionBy("_slice").orderBy(*order))
    # One row per slice, so the broadcast side is bounded by the partition count.
    joined = sliced.join(F.broadcast(offsets), "_slice")
    return joined.withColumn(name, F.col("_before") + inside).drop("_slice", "_before")


def running_share(df: DataFrame, value: str, slices: int | None = None) -> DataFrame:
    """Adds ``cumulative``: the sum of ``value`` over all rows with at least this
    row's value (ties share it), and ``grand_total``. Null values come last.

    Equal values are first merged, so a value held by very many rows is one row
    while slicing; the join back is an inner join on the value, which adaptive
    execution can split when one value is that common.
    """
    base = materialized(df)
    values = base.where(F.col(value).isNotNull()).groupBy(value).agg(F.sum(value).alias("_held"))
    order = F.col(value).desc()
    sliced = _sliced(values, [order], slices)
    grand_total = F.lit(sliced.agg(F.sum("_held")).first()[0]).cast(SUM_TYPE)
    offsets = _slice_offsets(sliced, {"_before": F.sum("_held")})
    inside = F.sum("_held").over(Window.partitionBy("_slice").orderBy(order))
    running = sliced.join(F.broadcast(offsets), "_slice").select(
        value, (F.col("_before") + inside).cast(SUM_TYPE).alias("cumulative")
    )
    ranked = base.join(running, value)
    unvalued = base.where(F.col(value).isNull()).withColumn("cumulative", grand_total)
    return ranked.select(*base.columns, "cumulative").unionByName(unvalued).withColumn("grand_total", grand_total)
