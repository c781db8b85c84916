"""Sorts with stated null placement, top-k and paging."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def high_first(column: str | Column) -> Column:
    """Descending; missing values last."""
    return (F.col(column) if isinstance(column, str) else column).desc_nulls_last()


def low_first(column: str | Column) -> Column:
    """Ascending; missing values last."""
    return (F.col(column) if isinstance(column, str) else column).asc_nulls_last()


def top(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """First k rows; each task keeps only its own k. End ``order`` with a unique key."""
    return df.orderBy(*order).limit(k)


def beyond(order: Sequence[tuple[str, bool]], last: Sequence) -> Column:
    """Rows that come after the key ``last`` in an order of (column, descending) pairs with
    missing values last. The bare columns are compared, so Parquet can skip what lies before."""
    condition, same = F.lit(False), F.lit(True)
    for (name, descending), value in zip(order, last, strict=True):
        column = F.col(name)
        if value is not None:
            later = column < F.lit(value) if descending else column > F.lit(value)
            condition = condition | (same & (later | column.isNull()))
        same = same & column.eqNullSafe(F.lit(value))
    first, descending = order[0]
    if last[0] is not None:
        bound = F.col(first) <= F.lit(last[0]) if descending else F.col(first) >= F.lit(last[0])
        condition = (bound | F.col(first).isNull()) & condition
    return condition


def page_after(df: DataFrame, size: int, order: Sequence[tuple[str, bool]], last: Sequence | None = None) -> DataFrame:
    """The ``size`` rows that follow the key ``last`` (the first ones without it). ``order``
    must identify a row. Whatever the page, each task keeps ``size`` rows at most."""
    rows = df if last is None else df.where(beyond(order, last))
    return top(rows, size, *[high_first(name) if descending else low_first(name) for name, descending in order])


def last_key(page: DataFrame, order: Sequence[tuple[str, bool]]) -> list | None:
    """Key of a page's last row, from which the next page starts; none after an empty page."""
    rows = page.select(*[name for name, _ in order]).tail(1)
    return list(rows[0]) if rows else None


def page(df: DataFrame, number: int, size: int, *order: Column) -> DataFrame:
    """Page ``number`` (from 1) of the ordered rows. Gathers the rows of all pages before it;
    ``page_after`` does not."""
    return df.orderBy(*order).offset((max(number, 1) - 1) * size).limit(size)
