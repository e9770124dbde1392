"""Lenient text casts as built-in expressions: bad text becomes NULL, never an error.

Numbers accept fractions, exponents and single underscores between digits, and
round half away from zero when an integer is wanted; integers may be hexadecimal
(0x) or binary (0b). Dates accept four notations. The shape of a text is checked
before it is cast, because a failed cast costs an exception per row and dirty
columns fail often.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted text shapes.
SHORT_INTEGER = r"^\s*[+-]?[0-9]{1,18}\s*$"
SHORT_NUMBER = r"^[0-9]{1,15}$"
DIGITS = r"[0-9]+(?:_[0-9]+)*"
NUMBER = rf"^\s*[+-]?({DIGITS}\.?({DIGITS})?|\.{DIGITS})([eE][+-]?{DIGITS})?\s*$"
HEXADECIMAL = r"^\s*0[xX]0*[0-9a-fA-F]{1,16}\s*$"
BINARY = r"^\s*0[bB]0*[01]{1,64}\s*$"
SPECIAL_DOUBLE = r"(?i)^\s*([+-]?inf(inity)?|nan)\s*$"
TIME = r"[ T](([01]?[0-9]|2[0-3]):[0-5]?[0-9](:[0-5]?[0-9](\.[0-9]+)?)?|24:00(:00(\.0+)?)?)( ?(Z|UTC|[+-][0-9]{2}(:?[0-9]{2})?))?"
ISO_DATE = rf"^[0-9]+([-/ \\])[0-9]{{1,2}}\1[0-9]{{1,2}}({TIME})?$"
ISO_DATE_PARTS = r"^([0-9]+)[-/ \\]([0-9]{1,2})[-/ \\]([0-9]{1,2})"
MONTH_NAME_DATE = r"^[A-Za-z]+ +[0-9]{1,2}, +[0-9]{1,4}$"
MONTH_FIRST_DATE = r"^([0-9]{1,2})([-/])([0-9]{1,2})\2([0-9]{1,4})$"
MONTH_NAME_FORMAT = "MMMM d, y"


def lenient_long(text: Column) -> Column:
    plain = F.regexp_replace(text, r"[\s_]", "")
    whole = F.regexp_extract(plain, r"^([+-]?[0-9]*)", 1)
    # the first digit of the fraction alone decides how to round
    up = F.regexp_extract(plain, r"\.([0-9])", 1) >= "5"
    step = F.when(up & plain.startswith("-"), -1).when(up, 1).otherwise(0)
    rounded = F.try_add(F.when(whole.isin("", "+", "-"), F.lit(0)).otherwise(whole.try_cast("long")), step)
    scaled = F.round(plain.try_cast("decimal(38,18)"), 0).try_cast("long")
    digits = F.substring(plain, 3, 2**31 - 1)
    return (
        F.when(text.rlike(SHORT_INTEGER), text.try_cast("long"))
        .when(text.rlike(NUMBER), F.when(plain.rlike("[eE]"), scaled).otherwise(rounded))
        .when(text.rlike(HEXADECIMAL), F.conv(digits, 16, 10).try_cast("long"))
        .when(text.rlike(BINARY), F.conv(digits, 2, 10).try_cast("long"))
    )


def lenient_int(text: Column) -> Column:
    return lenient_long(text).try_cast("int")


def lenient_double(text: Column) -> Column:
    return (
        F.when(text.rlike(SHORT_NUMBER), text.try_cast("double"))
        .when(text.rlike(NUMBER), F.replace(text, F.lit("_"), F.lit("")).try_cast("double"))
        .when(text.rlike(SPECIAL_DOUBLE), text.try_cast("double"))
    )


def lenient_date(text: Column) -> Column:
    """Year first (-, /, \\ or space), ``March 1, 2025``, ``3-1-2025`` and ``3/1/2025``.

    The first notation that gives a day of the calendar counts, so ``3-1-25`` is a
    day of the year 3. Years may have fewer than four digits.
    """
    trimmed = F.trim(text)

    def day(shape: str, pattern: str, order: str) -> Column:
        ordered = F.regexp_replace(F.regexp_replace(trimmed, pattern, order), "^([0-9]{1,3}-)", "000$1")
        return F.when(trimmed.rlike(shape), F.regexp_extract(ordered, "^([0-9]+-[0-9]+-[0-9]+)", 1).try_cast("date"))

    month_name = F.try_to_date(F.regexp_replace(trimmed, " +", " "), MONTH_NAME_FORMAT)
    return F.when(text.contains("#"), F.lit(None).cast("date")).otherwise(
        F.coalesce(
            day(ISO_DATE, ISO_DATE_PARTS, "$1-$2-$3"),
            day(MONTH_FIRST_DATE, MONTH_FIRST_DATE, "$4-$1-$3"),
            F.when(trimmed.rlike(MONTH_NAME_DATE), month_name),
        )
    )
