"""Column functions for parsing and tidying text, dates and numbers.

Text that cannot be parsed gives null, never an error. All of them are
built-in expressions and stay in generated code.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space in text.
WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# Date spellings tried in this order.
DATE_FORMATS = ("MMMM d, yyyy", "MMM d, yyyy", "yyyy-MM-dd", "d MMMM yyyy", "M/d/yyyy")
# Spellings of a unit and the form kept.
DURATION_UNITS = {"mins": "min", "minutes": "min", "seasons": "season"}
# Fixed value: a valid account name has 1 to 39 letters, digits or inner hyphens.
LOGIN_PATTERN = "^[A-Za-z0-9](?:[A-Za-z0-9-]{0,37}[A-Za-z0-9])?$"


def strip(text: str | Column) -> Column:
    """Remove white space of every kind from both ends."""
    return F.btrim(text, F.lit(WHITESPACE))


def extract(text: str | Column, pattern: str) -> Column:
    """First group of the first match, null without a match."""
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def first_number(text: str | Column) -> Column:
    """First run of digits as a number."""
    return extract(text, r"(\d+)").try_cast("bigint")


def first_word(text: str | Column) -> Column:
    """First run of letters in lower case."""
    return F.lower(extract(text, "([a-zA-Z]+)"))


def mapped(value: str | Column, mapping: Mapping[str, str]) -> Column:
    """Replace known values, keep others."""
    column = F.col(value) if isinstance(value, str) else value
    result = column
    for old, new in mapping.items():
        result = F.when(column == old, F.lit(new)).otherwise(result)
    return result


def parse_date(text: str | Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Timestamp from the first format that fits, else null."""
    trimmed = strip(text)
    return F.coalesce(*[F.try_to_timestamp(trimmed, F.lit(f)) for f in formats])


def iso_timestamp(text: str | Column) -> Column:
    """Timestamp from ISO-8601 text, null if it is none."""
    return F.try_to_timestamp(text)


def to_int(value: str | Column) -> Column:
    column = F.col(value) if isinstance(value, str) else value
    return column.try_cast("int")


def split_trimmed(text: str | Column, separator: str = ",") -> Column:
    """Array of the parts between separators, each without outer white space."""
    return F.transform(F.split(text, separator), strip)


def date_key(day: str | Column) -> Column:
    """Date as a yyyymmdd number."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.day(day)


def iso_weekday(day: str | Column) -> Column:
    """1 for Monday to 7 for Sunday."""
    return F.weekday(day) + 1


def day_name(day: str | Column) -> Column:
    return F.date_format(day, "EEEE")


def owner_part(full_name: str | Column) -> Column:
    return F.split(full_name, "/", 2).getItem(0)


def repo_part(full_name: str | Column) -> Column:
    """All after the first slash, null if there is none."""
    return F.get(F.split(full_name, "/", 2), F.lit(1))


def is_full_name(full_name: str | Column) -> Column:
    """Whether the text is owner/name with both parts filled."""
    return F.coalesce((owner_part(full_name) != "") & (repo_part(full_name) != ""), F.lit(False))


def is_login(text: str | Column) -> Column:
    """Whether the trimmed text is a valid account name."""
    return F.coalesce(strip(text).rlike(LOGIN_PATTERN), F.lit(False))


def file_key(text: str | Column) -> Column:
    """Text usable as a file name: slashes become underscores, ends are trimmed."""
    return strip(F.regexp_replace(text, "/", "_"))
