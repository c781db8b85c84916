"""Row predicates of the reports. Date predicates compare the bare column, so
Parquet can skip row groups and whole partitions."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.functions.cleanse import any_of, as_date, fold_accents

# Status code of an active product, and the text all approved states hold.
ACTIVE = "A"
APPROVED = "aprov"


def since_days(column: Column, as_of, days: int) -> Column:
    """On or after the day ``days`` before the as-of day."""
    return column >= F.date_sub(as_date(as_of), days)


def since_months(column: Column, as_of, months: int) -> Column:
    """Within the last ``months`` calendar months, the current one included."""
    return column >= F.add_months(F.trunc(as_date(as_of), "MM"), 1 - months).cast("date")


def half_open(column: Column, start: Column, end: Column) -> Column:
    return (column >= start) & (column < end)


def last_full_days(column: Column, as_of, days: int) -> Column:
    """The last ``days`` days; the as-of day itself is left out."""
    return half_open(column, F.date_sub(as_date(as_of), days), as_date(as_of))


def through_day(column: Column, start: date | str, end: date | str) -> Column:
    """From the first to the last day, both included."""
    return half_open(column, as_date(start), F.date_add(as_date(end), 1))


def status_has(column: Column, text: str = APPROVED) -> Column:
    """Status contains a text, in any letter case."""
    return F.contains(F.lower(column), F.lit(text.lower()))


def is_active(column: Column) -> Column:
    return column == ACTIVE


def has_any_tag(tags: Column, wanted: str | Sequence[str]) -> Column:
    """Tag text contains one of the wanted tags; ``%`` and ``_`` are plain characters."""
    wanted = [wanted] if isinstance(wanted, str) else list(wanted)
    return any_of(F.contains(F.lower(tags), F.lit(tag.lower())) for tag in wanted)


def in_year_month(day: Column, year: int | None = None, month: int | None = None) -> Column:
    """Calendar filter. A year is written as a range, which Parquet can use."""
    condition = F.lit(True)
    if year is not None and month is not None:
        first = F.lit(f"{year:04d}-{month:02d}-01").cast("date")
        return half_open(day, first, F.add_months(first, 1))
    if year is not None:
        condition = half_open(day, as_date(f"{year:04d}-01-01"), as_date(f"{year + 1:04d}-01-01"))
    if month is not None:
        condition = F.month(day) == month
    return condition


def has_tags(tags: Column) -> Column:
    return tags.isNotNull() & (tags != "")


def awaits_tags(dim: DataFrame) -> DataFrame:
    """All active products that were never given a tag."""
    waiting = dim.where(F.col("id_src").isNotNull() & F.col("tags").isNull() & is_active(F.col("status")))
    return waiting.select("id_src", "code", "name")


def matches(text: Column, term: str | None, mode: str = "contains") -> Column:
    """Search match, blind to letter case and accents. An empty term matches all.

    Modes: ``contains``, ``prefix``, ``exact``, ``word``. The first three compare
    under an accent-insensitive collation. Pattern matching takes no collated
    text, so ``word`` folds the accents itself.
    """
    if not term:
        return F.lit(True)
    collated = F.collate(text, "UNICODE_CI_AI")
    wanted = F.collate(F.lit(term), "UNICODE_CI_AI")
    if mode == "exact":
        return collated == wanted
    if mode == "prefix":
        return F.startswith(collated, wanted)
    if mode == "word":
        special = r".*+?^${}()|[]\\"
        quoted = "".join("\\" + ch if ch in special else ch for ch in term)
        return F.rlike(fold_accents(text), F.concat(F.lit(r"\b"), fold_accents(F.lit(quoted)), F.lit(r"\b")))
    if mode == "contains":
        return F.contains(collated, wanted)
    raise ValueError(f"unknown search mode: {mode}")
