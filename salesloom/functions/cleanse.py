"""Column expressions that turn raw shop records into typed values.

All are built-in Spark expressions, so they stay inside generated code, and none
depends on the session time zone.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from salesloom.schemas import MONEY

# The source writes local dates at this offset.
SOURCE_OFFSET = "-03:00"
# Labels shown for missing values, by report.
UNKNOWN_CHANNEL = "Desconhecido"
NO_CHANNEL = "(sem canal)"
NULL_CHANNEL = "(null)"
NO_SKU = "(sem sku)"
NO_NAME = "(sem nome)"
NO_CODE = "SEM_CODIGO"


def as_date(value: date | str | Column | None = None) -> Column:
    """The as-of day of a report; today when not given."""
    if value is None:
        return F.current_date()
    if isinstance(value, Column):
        return value.cast("date")
    return F.lit(str(value)).cast("date")


# --- text -----------------------------------------------------------------


def filled(column: Column) -> Column:
    """Blank text becomes null."""
    return F.nullif(F.trim(column), F.lit(""))


def first_filled(*columns: Column) -> Column:
    """First value that is neither null nor empty text."""
    return F.coalesce(*[F.nullif(column, F.lit("")) for column in columns])


def label_or(column: Column, default: str) -> Column:
    """Trimmed text, or a label where it is missing or blank."""
    return F.coalesce(filled(column), F.lit(default))


def channel_label(column: Column, default: str = NO_CHANNEL) -> Column:
    """Channel label; blank text and the word ``null`` count as missing."""
    text = filled(column)
    return F.coalesce(F.when(F.lower(text) != "null", text), F.lit(default))


def sku_key(code: Column, description: Column) -> Column:
    """Key under which a line is counted: code, else description, else a constant."""
    return F.coalesce(F.nullif(code, F.lit("")), F.nullif(description, F.lit("")), F.lit(NO_CODE))


def strip_tags(tags: Column) -> Column:
    """Strip commas and spaces at both ends; nothing left means null."""
    return F.nullif(F.btrim(F.coalesce(tags, F.lit("")), F.lit(", ")), F.lit(""))


def fold_accents(column: Column) -> Column:
    """Lower-case text without the accents of Western European languages."""
    return F.translate(
        F.lower(column),
        "áàâãäåéèêëíìîïóòôõöúùûüçñýÿ",
        "aaaaaaeeeeiiiiooooouuuucnyy",
    )


def category_leaf(category: Column) -> Column:
    """Last non-blank part of ``A >> B >> C``."""
    parts = F.filter(F.transform(F.split(category, ">>"), lambda part: F.trim(part)), lambda part: part != "")
    return F.when(F.size(parts) > 0, F.element_at(parts, -1))


def product_tags(tags_list: Column, tags_text: Column) -> Column:
    """Tags of a product as ``a,b,c``.

    ``tags_list`` is the array of tag objects; ``tags_text`` the JSON text of the
    other field, which holds an array of words, an array of objects, or one word.
    """
    from_list = F.array_join(
        F.filter(
            F.transform(
                tags_list,
                lambda t: first_filled(t["descricao"], t["nome"], t["idTag"], t["id"]),
            ),
            lambda name: name.isNotNull(),
        ),
        ",",
    )

    def name_of(element: Column) -> Column:
        described = first_filled(
            F.get_json_object(element, "$.descricao"),
            F.get_json_object(element, "$.nome"),
            F.get_json_object(element, "$.id"),
        )
        return F.when(element.startswith("{"), described).otherwise(F.nullif(element, F.lit("")))

    elements = F.from_json(tags_text, "array<string>")
    from_text = F.array_join(
        F.filter(F.transform(elements, name_of), lambda name: name.isNotNull()), ","
    )
    is_array = F.ltrim(tags_text).startswith("[")
    return F.coalesce(from_list, F.when(is_array, from_text).otherwise(tags_text))


# --- numbers --------------------------------------------------------------


def number_or_null(column: Column, kind: str = MONEY) -> Column:
    """Text to number; blank or non-numeric text gives null."""
    return filled(column).try_cast(kind)


def number_or_zero(column: Column, kind: str = MONEY) -> Column:
    return F.coalesce(number_or_null(column, kind), F.lit(0).cast(kind))


def first_nonzero(*amounts: Column) -> Column:
    """First amount that is neither missing nor zero."""
    return F.coalesce(*[F.nullif(number_or_null(a), F.lit(0).cast(MONEY)) for a in amounts])


def zero_if_null(column: Column) -> Column:
    return F.coalesce(column, F.lit(0).cast(MONEY))


def line_revenue(total: Column, qty: Column, price: Column, default_zero: bool = True) -> Column:
    """Line total, else quantity times price."""
    if default_zero:
        qty, price = zero_if_null(qty), zero_if_null(price)
    return F.coalesce(total, (qty * price).cast(MONEY))


def ratio(numerator: Column, denominator: Column, otherwise: float | None = None) -> Column:
    """Quotient as double; ``otherwise`` where the denominator is zero or null."""
    quotient = numerator.cast("double") / denominator.cast("double")
    return F.when(denominator != 0, quotient).otherwise(F.lit(otherwise).cast("double"))


def percent(part: Column, whole: Column, digits: int) -> Column:
    """``part`` of ``whole`` in percent, rounded on decimals; null for a zero whole.

    Sums of money are very wide decimals, and dividing those as they are leaves
    six digits, which would round twice. At this width ten digits are kept.
    """
    part, whole = part.cast("decimal(24,4)"), whole.cast("decimal(24,4)")
    return F.when(whole != 0, F.round(part * 100 / whole, digits))


def change_pct(current: Column, previous: Column, digits: int = 2) -> Column:
    """Change against a positive previous value in percent."""
    return F.when(previous > 0, percent(current - previous, previous, digits))


# --- dates ----------------------------------------------------------------


def parse_source_date(text: Column) -> Column:
    """``dd/MM/yyyy`` to the instant of that midnight at the source; else null."""
    day = F.substring(text, 1, 10)
    stamped = F.concat(day, F.lit(f" {SOURCE_OFFSET}"))
    return F.when(day.rlike(r"^\d{2}/\d{2}/\d{4}$"), F.try_to_timestamp(stamped, F.lit("dd/MM/yyyy XXX")))


def parse_source_day(text: Column) -> Column:
    """``dd/MM/yyyy`` to a date; else null."""
    day = F.substring(text, 1, 10)
    return F.when(day.rlike(r"^\d{2}/\d{2}/\d{4}$"), F.try_to_date(day, "dd/MM/yyyy"))


def parse_source_datetime(text: Column) -> Column:
    """``dd/MM/yyyy HH:mm:ss`` with optional time to a zone-free timestamp; else null."""
    text = F.trim(text)
    iso = F.regexp_replace(text, r"^(\d{2})/(\d{2})/(\d{4})( \d{2}:\d{2}:\d{2})?$", "$3-$2-$1$4")
    return F.when(iso != text, iso.try_cast("timestamp_ntz"))


def utc_day(moment: Column) -> Column:
    """UTC calendar day of an instant, whatever the session time zone is."""
    return F.convert_timezone(None, F.lit("UTC"), moment.cast("timestamp_ntz")).cast("date")


def date_key(day: Column) -> Column:
    """Day as the integer yyyyMMdd."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def month_of(day: Column) -> Column:
    """First day of the month of a date."""
    return F.trunc(day, "MM")


def week_of(day: Column) -> Column:
    """Monday of the week of a date."""
    return F.trunc(day, "WEEK")


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)
