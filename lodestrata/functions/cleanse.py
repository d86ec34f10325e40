"""Column-to-Column cleansing. Every function stays inside the JVM expression tree."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Each pattern has a catch-all branch, so a text that is no date is rewritten to dashes and the
# cast that follows yields NULL: one regular expression per value instead of a test and a rewrite.
# The zeros in the replacements pad short years to the four digits the cast asks for.
_TIME = r"(?:[01]?\d|2[0-4]):[0-5]?\d(?::[0-5]?\d(?:\.\d{1,9})?)?"
_ZONE = r"\s*(?:Z|[+-]\d{2}(?::?\d{2})?)?"
YEAR_FIRST = rf"^(?:\s*(\d{{1,4}})([-/ \\])(\d{{1,2}})\2(\d{{1,2}})(?:[T ]{_TIME}{_ZONE})?\s*|(?s:.*))$"
MONTH_FIRST = r"^(?:\s*(\d{1,2})/(\d{1,2})/(\d{1,4})\s*|(?s:.*))$"
_MOMENT = (
    rf"^(?:\s*(\d{{4}})([-/ \\])(\d{{1,2}})\2(\d{{1,2}})"
    rf"(?:[T ]({_TIME}){_ZONE})?\s*|(?s:.*))$"
)


def blank_to_null(value: Column) -> Column:
    """Trimmed text, NULL when nothing is left."""
    return F.nullif(F.trim(value), F.lit(""))


def parse_date(value: Column) -> Column:
    """Year-month-day text first, month/day/year second, NULL for anything else.

    Text that a date is written back as (four digits, two, two) is taken as it stands; only other spellings meet the expressions.
    """
    text = blank_to_null(value)
    plain = text.try_cast("date")
    year_first = F.regexp_replace(text, YEAR_FIRST, "000$1-$3-$4").try_cast("date")
    month_first = F.regexp_replace(text, MONTH_FIRST, "000$3-$1-$2").try_cast("date")
    return F.when((F.char_length(text) == 10) & (plain.cast("string") == text), plain).otherwise(F.coalesce(year_first, month_first))


def parse_timestamp(value: Column) -> Column:
    """Zoneless timestamp; a bare date is midnight, a zone suffix is ignored."""
    text = blank_to_null(value)
    return F.regexp_replace(text, _MOMENT, "$1-$3-$4 $5").try_cast("timestamp_ntz")


def month_from_period(period: Column) -> Column:
    """First day of a YYYY_MM period. A malformed period is an error, not a NULL."""
    return F.to_date(F.concat(period, F.lit("_01")), "yyyy_MM_dd")


def map_variants(value: Column, variants: Mapping[str, str]) -> Column:
    """Canonical label of a known spelling (trimmed, any case), else NULL."""
    pairs = [F.lit(part) for spelling, label in variants.items() for part in (spelling.lower(), label)]
    return F.try_element_at(F.create_map(*pairs), F.lower(F.trim(value)))


def try_int(value: Column) -> Column:
    """Whole number from text, halves rounded away from zero, NULL when not numeric."""
    return F.round(value.try_cast("decimal(38,18)"), 0).try_cast("int")


def bounded_int(value: Column, low: int, high: int) -> tuple[Column, Column]:
    """(number inside [low, high] or NULL, flag). Text that is no number is not flagged."""
    number = try_int(value)
    inside = number.between(low, high)
    flagged = blank_to_null(value).isNotNull() & ~inside
    return F.when(inside, number), F.coalesce(flagged, F.lit(False))


def full_match(value: Column, pattern: str) -> Column:
    """Whole-text match; NULL stays NULL and a trailing newline does not slip through."""
    return value.rlike(rf"^(?:{pattern})\z")


def out_of_range_or_null(value: Column, low, high) -> Column:
    return value.isNull() | ~value.between(low, high)


def out_of_order(earlier: Column, later: Column) -> Column:
    """True when both are known and the later event precedes the earlier one; never NULL."""
    return F.coalesce(later < earlier, F.lit(False))


def outside_interval(point: Column, start: Column, end: Column) -> Column:
    """True without a start, before it, or after a known end. A NULL point stays NULL."""
    return start.isNull() | (point < start) | (end.isNotNull() & (point > end))


def safe_ratio(numerator: Column, denominator: Column, scale: float = 1.0, digits: int | None = None) -> Column:
    """scale * numerator / denominator as double, NULL on a zero denominator."""
    ratio = F.try_divide(F.lit(float(scale)) * numerator.cast("double"), denominator.cast("double"))
    return ratio if digits is None else F.round(ratio, digits)


def parse_keyed_value(text: Column, key: Column, as_type: str = "decimal(10,2)") -> Column:
    """Value stored under a per-row key in dictionary-looking text. The text is only ever parsed.

    It is read as the one element of an array, because a parser that stops after the first document
    would accept anything that follows it. A comma before the closing brace is tolerated.
    """
    document = F.regexp_replace(F.replace(text, F.lit("'"), F.lit('"')), r",\s*}\s*$", "}")
    elements = F.from_json(F.concat(F.lit("["), document, F.lit("]")), "array<map<string,string>>")
    only = F.transform(F.array(elements), lambda found: F.when(F.size(found) == 1, found[0]))[0]  # parses once
    return F.try_element_at(only, F.trim(key)).try_cast(as_type)


def join_text(*parts: Column) -> Column:
    """Concatenation that skips NULL parts."""
    return F.concat_ws("", *parts)
