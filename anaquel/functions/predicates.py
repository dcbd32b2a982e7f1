"""Row predicates of the quality rules, as Spark expressions.

Each ``*_error`` is true for a value the rule counts, and never null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Year, month and day in digits; month and day may have one digit, a day of one digit also a space before
# it. The calendar check follows.
DATE_SHAPE = "^[0-9]{4}-[0-9]{1,2}-([0-9]{1,2}| [1-9])$"

# Java flags: d lets `$` stop only before "\n", U makes classes such as \s follow Unicode.
PATTERN_FLAGS = "(?dU)"


def strict_date(value: Column) -> Column:
    """The date in a text of the form year-month-day, null for anything else. Year 0 is not a year."""
    text = value.cast("string")
    shaped = text.rlike(PATTERN_FLAGS + DATE_SHAPE) & ~text.startswith("0000") & ~text.endswith("\n")
    return F.when(shaped, F.try_to_date(F.replace(text, F.lit(" "), F.lit("")), "yyyy-M-d"))


def strict_int(value: Column, width: str = "int") -> Column:
    """The whole number in a text, null when it is none or does not fit."""
    return value.try_cast(width)


def pattern_error(value: Column, pattern: str) -> Column:
    return F.coalesce(~value.cast("string").rlike(PATTERN_FLAGS + pattern), F.lit(True))


def range_error(value: Column, low: int, high: int) -> Column:
    return F.coalesce(~strict_int(value, "bigint").between(low, high), F.lit(True))


def separator_error(value: Column, separator: str) -> Column:
    """A literal separator in the text; null and empty text pass."""
    return F.coalesce(F.contains(value.cast("string"), F.lit(separator)), F.lit(False))


def date_error(value: Column) -> Column:
    return strict_date(value).isNull()
