"""Text clean-up, parsing and recoding expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from creditmart.functions.casting import as_double, as_int

# Patterns of the source systems' text fields.
DIGITS_AND_DOT = r"[^0-9\.]"
DIGITS_S_AND_DOT = r"[^0-9s\.]"
DIGITS_ONLY = r"[^0-9]"
YEARS = r"([0-9]+) Years?"
MONTHS = r"([0-9]+) Months?"
HAS_LETTER = r"[a-zA-Z]"
SSN = r"[0-9]{3}-[0-9]{2}-[0-9]{4}"


def strip_chars(c: Column, pattern: str = DIGITS_AND_DOT) -> Column:
    """Delete every character the pattern matches."""
    return F.regexp_replace(c, pattern, "")


def parse_number(c: Column, pattern: str = DIGITS_AND_DOT, scale: int | None = 2) -> Column:
    """Dirty text to double; text without a readable number gives NULL.

    The sign is not a kept character, so '-100' reads as 100.
    """
    value = as_double(strip_chars(c, pattern))
    return value if scale is None else F.round(value, scale)


def parse_count(c: Column, pattern: str = DIGITS_AND_DOT) -> Column:
    """Dirty text to int, truncating a fraction."""
    return as_int(strip_chars(c, pattern))


def parse_months(c: Column) -> Column:
    """'10 Years and 9 Months' to 129; a missing part counts 0, and so does NULL text."""

    def part(pattern: str) -> Column:
        return F.coalesce(as_double(F.regexp_extract(c, pattern, 1)), F.lit(0.0))

    return part(YEARS) * 12 + part(MONTHS)


def recode(c: Column, sentinel: str, replacement: str) -> Column:
    """Replace one sentinel value; everything else, NULL included, stays."""
    return F.when(c == sentinel, F.lit(replacement)).otherwise(c)


def recode_unmatched(c: Column, pattern: str, replacement: str) -> Column:
    """Replace text in which the pattern is nowhere found; NULL stays."""
    return F.when(~c.rlike(pattern), F.lit(replacement)).otherwise(c)


def pattern_flag(c: Column, pattern: str = SSN) -> Column:
    """0 where the text lacks the pattern, else 1. NULL text has no failed match, so it is 1."""
    return F.when(~c.rlike(pattern), F.lit(0)).otherwise(F.lit(1))


def first_keyword(c: Column, codes: dict[str, int], default: int) -> Column:
    """Code of the first keyword (case-sensitive) contained in the text."""
    out = None
    for word, code in codes.items():
        hit = c.contains(word)
        out = F.when(hit, F.lit(code)) if out is None else out.when(hit, F.lit(code))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


# Codes of the payment-behaviour text.
SPENDING_CODES = {"High": 1, "Low": 0}
PAYMENT_SIZE_CODES = {"Small": 1, "Medium": 2, "Large": 3}


def spending_level(c: Column) -> Column:
    return first_keyword(c, SPENDING_CODES, -1)


def payment_size(c: Column) -> Column:
    return first_keyword(c, PAYMENT_SIZE_CODES, 0)
