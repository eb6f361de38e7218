"""Cleaning and parsing expressions (ingest ops I1-I3, I12, I13, I15; rules R1, R5, R6).

All functions take and return ``Column`` objects, so they stay inside
whole-stage codegen; nothing here is a Python UDF.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Strings that mean "missing" in a messy numeric cell.
MISSING_TOKENS = ["", "nan", "none", "null"]

# Fixed value: the characters that count as white space in a text.
WHITE_SPACE = (r"[\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")

# The ways in which a date is written as text.
DATE_PATTERNS = [
    "yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd'T'HH:mm",
    "yyyy-MM-dd'T'HH:mm:ssXXX", "M/d/yyyy", "M/d/yyyy HH:mm:ss", "M/d/yyyy HH:mm", "M/d/yy", "yyyy/M/d", "M-d-yyyy",
    "MMM d, yyyy", "MMMM d, yyyy", "MMM d yyyy", "MMMM d yyyy", "d MMM yyyy", "d MMMM yyyy", "d-MMM-yyyy",
]

# Fixed value: the form of every text that a cast to double reads, and of few others.
NUMBER_FORM = (r"(?i)^[\s\x00-\x20]*+[+-]?(nan|inf(inity)?|[0-9]*+(\.[0-9]*+)?+(e[+-]?[0-9]++)?+"
               r"|0x[0-9a-f]*+(\.[0-9a-f]*+)?+p[+-]?[0-9]++)[df]?[\s\x00-\x20]*+$")

# Fixed value: day zero of the spreadsheet serial-date calendar.
SERIAL_DATE_EPOCH = "1899-12-30"
# Fixed value: serial number of the day after 9999-12-31.
SERIAL_DATE_LIMIT = 2958466


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double(c) -> Column:
    """A text as a double, NULL where it is none.  The cast is only tried on texts
    that look like a number, as each failed one is costly."""
    return F.when(_c(c).rlike(NUMBER_FORM), _c(c).try_cast("double"))


def null_nan(c) -> Column:
    """NaN is missing, as in pandas; turn it into NULL once at the boundary."""
    c = _c(c)
    return F.nanvl(c.cast("double"), F.lit(None).cast("double"))


def norm_text(c) -> Column:
    """Strip, lower-case and collapse whitespace; NULL becomes ''."""
    text = F.coalesce(_c(c).cast("string"), F.lit(""))
    return F.trim(F.regexp_replace(F.lower(text), WHITE_SPACE + "+", " "))


def parse_number(c) -> Column:
    """Messy number ("12 g", "~8.5", "3,221", "5g/day") -> double or NULL.

    Keeps digits, '.', ',', '+', '-'; drops thousands commas; anything that is
    still not a number (e.g. "2-3") becomes NULL.  Letters are removed before
    parsing, so "1e5" reads as 15 (documented quirk Q15).
    """
    s = F.trim(_c(c).cast("string"))
    cleaned = F.regexp_replace(F.regexp_replace(s, r"[^0-9.,+\-]", ""), ",", "")
    return (
        F.when(s.isNull() | F.lower(s).isin(MISSING_TOKENS), F.lit(None).cast("double"))
        .when(cleaned == "", F.lit(None).cast("double"))
        .otherwise(cleaned.try_cast("double"))
    )


def trailing_int(c) -> Column:
    """Trailing integer of a header such as ``weight_15`` -> 15, else NULL."""
    digits = F.regexp_extract(F.trim(_c(c).cast("string")), r"(\d+)$", 1)
    return F.when(digits == "", F.lit(None).cast("bigint")).otherwise(digits.try_cast("bigint"))


def zero_to_null_for_end(value, phase) -> Column:
    """A zero in an end-phase measurement means 'not measured'."""
    v = _c(value)
    return F.when((_c(phase) == "end") & (v == 0), F.lit(None).cast("double")).otherwise(v)


def parse_mixed_date(c) -> Column:
    """A date cell may be text or a spreadsheet serial day number.

    Numbers are days after 1899-12-30; text is parsed leniently and a bad
    value becomes NULL (never an error).
    """
    s = F.trim(_c(c).cast("string"))
    number = to_double(s)
    serial = F.when(F.abs(number) < SERIAL_DATE_LIMIT, number)  # neither NaN nor infinite
    as_serial = F.date_add(F.lit(SERIAL_DATE_EPOCH).cast("date"), F.floor(serial).cast("int"))
    return F.when(serial.isNotNull(), as_serial).otherwise(parse_text_date(s))


def _fixed_characters(pattern: str) -> str:
    """A LIKE pattern of a date pattern's fixed characters, lower-cased: a text that
    the date pattern reads has them all, in this order."""
    fixed = re.sub("'([^']*)'|[A-Za-z]+", lambda m: m.group(1) or "%", pattern).lower()
    return "%" + "%".join(fixed.replace("%", "")) + "%"


def parse_text_date(c) -> Column:
    """A date written as text in one of ``DATE_PATTERNS``, else NULL.  A pattern is
    only tried on texts with its fixed characters, as each failed try is costly."""
    s = F.trim(_c(c).cast("string"))
    return F.coalesce(*[F.when(F.lower(s).like(_fixed_characters(p)), F.try_to_timestamp(s, F.lit(p)))
                        for p in DATE_PATTERNS]).cast("date")


def says_something(c) -> Column:
    """A text that is there and is none of the words for a missing value."""
    return F.coalesce(~F.lower(F.trim(_c(c).cast("string"))).isin(MISSING_TOKENS), F.lit(False))


def date_rejected(c) -> Column:
    """A cell that says something, but no date that ``parse_mixed_date`` knows."""
    return says_something(c) & parse_mixed_date(c).isNull()


def resolve_fiber(insoluble, soluble, generic, generic_raw=None) -> Column:
    """fiber = insoluble + soluble when both are known, else the generic
    column, converted from mg to g when its raw text mentions mg."""
    ins, sol, gen = _c(insoluble), _c(soluble), _c(generic)
    scale = F.lit(1.0)
    if generic_raw is not None:
        scale = F.when(F.lower(_c(generic_raw).cast("string")).contains("mg"), F.lit(0.001)).otherwise(F.lit(1.0))
    return F.when(ins.isNotNull() & sol.isNotNull(), ins + sol).otherwise(gen * scale)


def safe_div(a, b) -> Column:
    """X / 0 is NULL (the reference turns inf into NaN), never an error."""
    return F.try_divide(_c(a), _c(b))


def week_index(date, origin, one_based: bool = False) -> Column:
    """P5: whole weeks since the subject's origin date (floor division)."""
    w = F.floor(F.datediff(_c(date), _c(origin)) / F.lit(7)).cast("int")
    return w + F.lit(1) if one_based else w
