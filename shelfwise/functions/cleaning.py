"""Text to typed value, never failing: blanks and unparseable text become NULL.

Each cast evaluates its input once for ordinary values. Spark substitutes these expressions
into filters, so a cast that tested its input first would run the test at every mention.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Which text counts as a value, the ordinary spelling first. Spark's own casts accept a
# little more ('10d', '0x1p3', '2026' as a date) and a little less ('2.7' as an integer,
# '1_000'), so these decide. Padding may stay: the casts ignore it.
_DIGITS = r"\d+(?:_\d+)*+"
_NUMBER = rf"(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?\d+)?"
INTEGER = rf"^\s*[+-]?{_NUMBER}\s*$"
DOUBLE = rf"^\d++(?:\.\d*+)?$|^\s*[+-]?(?:{_NUMBER}|(?i:nan|inf|infinity))\s*$"
DATE = (
    r"^\d{4}-\d\d-\d\d$"
    r"|^\s*\d{4}([-/])\d{1,2}\1\d{1,2}(?:[ T]\d{1,2}:\d{1,2}:\d{1,2}(?:\.\d+)?)?\s*$"
)


def clean_text(column: Column | str) -> Column:
    """Trim spaces; an empty rest is NULL. Tabs and newlines are left alone."""
    return F.nullif(F.trim(column), F.lit(""))


def _matched(text: Column | str, pattern: str, mark: str, by: str) -> Column:
    """The text with ``mark`` replaced if it is a value, else an empty string, which no cast
    accepts."""
    return F.replace(F.regexp_extract(text, pattern, 0), F.lit(mark), F.lit(by))


def _double(text: Column | str, pattern: str) -> Column:
    return _matched(text, pattern, "_", "").try_cast("double")


def _plain_double(text: Column | str) -> Column:
    # Between two digits, what the cast accepts is a decimal number to the pattern too, unless it
    # is hexadecimal; only underscores need the pattern. So the ordinary spelling needs none.
    text = F.col(text) if isinstance(text, str) else text
    ordinary = (
        F.substring(text, 1, 1).between("0", "9") & F.substring(text, -1, 1).between("0", "9")
        & ~F.contains(text, F.lit("_")) & ~F.contains(text, F.lit("x")) & ~F.contains(text, F.lit("X"))
    )
    return F.when(ordinary, text).otherwise(_matched(text, DOUBLE, "_", "")).try_cast("double")


def _integer(text: Column | str) -> Column:
    # Plain integers stop at the first cast; decimals round half away from zero.
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(text.try_cast("int"), F.round(_double(text, INTEGER)).try_cast("int"))


def _date(text: Column | str) -> Column:
    # Ten characters with dashes and a digit in these places are a date to the cast only if all
    # others are digits too, so the ordinary spelling needs no pattern.
    text = F.col(text) if isinstance(text, str) else text
    ordinary = (
        (F.length(text) == 10) & (F.substring(text, 5, 1) == "-") & (F.substring(text, 8, 1) == "-")
        & F.substring(text, 10, 1).between("0", "9")
    )
    return F.when(ordinary, text).otherwise(_matched(text, DATE, "/", "-")).try_cast("date")


_CASTS = {"int": _integer, "integer": _integer, "double": _plain_double, "date": _date}


def clean_cast(column: Column | str, data_type: str) -> Column:
    """Typed value of a raw text column, or NULL."""
    if data_type in _CASTS:
        return _CASTS[data_type](column)
    if data_type in ("string", "text", "varchar"):
        return clean_text(column)
    return clean_text(column).try_cast(data_type)
