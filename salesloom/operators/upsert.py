"""Insert-or-update, replace and insert-if-new as joins; no row-at-a-time writes.

The functions return the new table, or the new rows of those partitions of it that
hold an old or a new version of a changed row; ``Warehouse`` stores them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.operators.lineage import BROADCAST_ROWS, broadcast_if_small, materialized


def newest_per_key(df: DataFrame, keys: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """Keep one row per key: the greatest by ``newest``, missing values lowest;
    full ties go to the greatest row. Rows without a key are dropped.

    An aggregate, not a window: it combines before the shuffle, so a key with
    very many versions sends one row per task.
    """
    rest = [c for c in df.columns if c not in keys and c not in newest]
    if not rest and not newest:
        return df.where(~_any_null(keys)).distinct()
    # Structs compare field by field with null lowest.
    packed = F.struct(*newest, *rest)
    best = (
        df.where(~_any_null(keys)).groupBy(*keys).agg(F.max(packed).alias("_best"))
    )
    return best.select(*[F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in df.columns])


def newest_of_stored(rows: DataFrame, keys: Sequence[str], newest: Sequence[str], most: int = BROADCAST_ROWS) -> DataFrame:
    """``newest_per_key`` of stored rows whose keys seldom repeat, stored as well.

    Keys are counted first, and only the rows of repeated ones are compared; the others are
    neither shuffled nor written again. Where more than ``most`` keys repeat, all rows are compared.
    """
    known = rows.where(~_any_null(keys))
    repeated = known.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1").select(*keys)
    repeated = materialized(repeated)
    several = repeated.count()
    if not several:
        return known
    if several > most:
        return materialized(newest_per_key(rows, keys, newest))
    repeated = F.broadcast(repeated)
    single = known.join(repeated, list(keys), "left_anti").select(*rows.columns)
    compared = newest_per_key(known.join(repeated, list(keys), "left_semi").select(*rows.columns), keys, newest)
    return materialized(single.unionByName(compared))


def one_of_each(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``newest_per_key`` without an order, for tables whose keys hardly ever repeat:
    keys are counted by hash, and only the rows of repeated ones are compared. The repeated
    keys are stored, so that the other rows are not shuffled for them."""
    known = df.where(~_any_null(keys))
    repeated = known.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1").select(*keys)
    repeated = broadcast_if_small(materialized(repeated))
    single = known.join(repeated, list(keys), "left_anti").select(*df.columns)
    several = known.join(repeated, list(keys), "left_semi").select(*df.columns)
    return single.unionByName(newest_per_key(several, keys, []))


def _any_null(keys: Sequence[str]) -> Column:
    condition = F.col(keys[0]).isNull()
    for key in keys[1:]:
        condition = condition | F.col(key).isNull()
    return condition


def upsert(target: DataFrame, changes: DataFrame, keys: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """Target with the newest change of each key replacing or joining its row."""
    latest = newest_per_key(changes, keys, newest)
    return replace_keys(target, latest.select(*keys), latest, keys)


def replace_keys(target: DataFrame, replaced: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target without the rows of the ``replaced`` keys, plus ``rows``. Few keys are best
    stored before (``broadcast_if_small``): the target is not shuffled then."""
    kept = target.join(replaced.select(*keys).distinct(), list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(rows.select(*target.columns))


def insert_new(target: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target plus those rows whose key it does not hold yet."""
    fresh = newest_per_key(rows, keys, []).join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(fresh.select(*target.columns))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row; empty when the key is unique."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


class RepeatedKey(ValueError):
    """A key that must be unique is held by several rows."""


def require_unique(df: DataFrame, keys: Sequence[str], name: str) -> None:
    """Raise ``RepeatedKey`` with an example if a key is held by more than one row."""
    repeated = duplicate_keys(df, keys).take(1)
    if repeated:
        raise RepeatedKey(f"{name}: {repeated[0].asDict()}")


def changed_partitions(
    target: DataFrame,
    replaced: DataFrame,
    rows: DataFrame,
    keys: Sequence[str],
    partition: str,
    within: Sequence[str] | None = None,
) -> tuple[DataFrame, list[str]]:
    """``replace_keys`` on the partitions of a table that it changes: their new rows, and
    which they are: those that hold a replaced row or receive a new one.

    ``within`` names the partitions that can hold a replaced row, when that is known;
    otherwise the key columns of the table are searched. Partitions of which every row is
    replaced are not read beyond that. ``replaced`` is materialized; of ``rows``, the
    partitions are read before the rows themselves.
    """
    replaced = broadcast_if_small(replaced)
    searched = target if within is None else target.where(F.col(partition).isin(list(within)))
    holding = searched.select(*keys, partition).join(replaced, list(keys), "left_semi")
    held, all_rows = ({row[0]: row[1] for row in rows_of.groupBy(partition).count().collect()} for rows_of in (holding, searched))
    touched = sorted({*held, *distinct_values(rows.select(partition))})
    staying = [part for part in touched if part not in held or held[part] < all_rows[part]]
    return replace_keys(target.where(F.col(partition).isin(staying)), replaced, rows, keys), touched


def distinct_values(column: DataFrame) -> list[str]:
    """Distinct partition values: months, say, so a few hundred whatever the table size."""
    return sorted(row[0] for row in column.distinct().collect())
