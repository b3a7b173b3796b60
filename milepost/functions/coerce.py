"""Lenient coercion of text columns: junk becomes NULL instead of an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The characters that count as white space at either end of a text.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Words read as booleans.
TRUE_WORDS = ["1", "true", "t", "yes", "y", "on"]
FALSE_WORDS = ["0", "false", "f", "no", "n", "off"]

_PLAIN_TEXT = r"^[!-~](?:[ -~]*[!-~])?\z"
_PLAIN_NUMBER = r"^-?[0-9]+(?:\.[0-9]+)?$"
_PADDED_NUMBER = r"^ *-?[0-9]+(?:\.[0-9]+)? *\z"
_DIGITS = r"[0-9]+(?:_[0-9]+)*"
_NUMBER = (
    rf"^(?:[+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?"
    r"|[+-]?(?:(?i)inf|infinity|nan)|true|false)$"
)
_ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"
_ISO_MOMENT = (
    r"^\d{4}-\d{2}-\d{2}[T ]([01]\d|2[0-3])(:[0-5]\d(:[0-5]\d([.,]\d+)?)?)?"
    r"(Z|[+-]([01]\d|2[0-3]):?[0-5]\d)?$"
)
_BASIC_DATE = r"^\d{8}$"


def strip(c) -> Column:
    """Remove white space of every kind from both ends (SQL ``trim`` removes blanks only).

    A named column is tested first for ASCII text between blanks, of which the cheap ``trim`` gives the same.
    """
    if not isinstance(c, str):
        return F.btrim(c, F.lit(WHITESPACE))
    plain = F.trim(F.col(c))
    return F.when(plain.rlike(_PLAIN_TEXT), plain).otherwise(F.btrim(F.col(c), F.lit(WHITESPACE)))


def text_or_null(c) -> Column:
    """Stripped text, NULL when nothing is left."""
    return F.nullif(strip(c), F.lit(""))


def blank_trim(c: Column) -> Column:
    """SQL trim (blanks only), NULL when nothing is left."""
    return F.nullif(F.trim(c), F.lit(""))


def first_non_blank(*columns: Column) -> Column:
    return F.coalesce(*[text_or_null(c) for c in columns])


def first_filled(a: Column, b: Column) -> Column:
    """``a`` unless it is NULL or empty. A text of blanks still counts as filled."""
    return F.coalesce(F.nullif(a, F.lit("")), b)


def number_text(c) -> Column:
    """The number spelled by a text, without white space; empty when the text is no number.

    Plain digits, between blanks or not, are the usual case and pass after one cheap test. The full rule also takes exponents,
    digit groups (``1_000``), NaN, infinities and the words true and false, but not the type
    suffixes and hexadecimal floats that the JVM parser would accept.
    """
    c = F.col(c) if isinstance(c, str) else c
    spelled = F.replace(F.regexp_extract(strip(c), _NUMBER, 0), F.lit("_"), F.lit(""))
    return F.when(c.rlike(_PADDED_NUMBER), F.trim(c)).when(c.rlike(_PLAIN_NUMBER), c).otherwise(spelled)


def with_number_text(df: DataFrame, names: list[str]) -> DataFrame:
    """Replaces columns by their number text, so that a coercion can refer to it repeatedly."""
    return df.withColumns({n: number_text(n) for n in names})


def number_to_double(n: Column) -> Column:
    """Double from number text. Empty text is left out: a failing cast to double costs an exception."""
    return F.coalesce(F.when(n != "", n.try_cast("double")), F.when(n == "true", 1.0).when(n == "false", 0.0))


def number_to_long(n: Column) -> Column:
    """Integer from number text; fractions are cut off, NaN and infinities give NULL."""
    return F.coalesce(n.try_cast("bigint"), number_to_double(n).try_cast("bigint"))


def to_double(c) -> Column:
    """Number from text. NaN and infinities are kept, as the source kept them; junk is NULL."""
    return number_to_double(number_text(c))


def to_long(c) -> Column:
    """Integer from text; fractions are cut off, NaN, infinities and junk give NULL."""
    return number_to_long(number_text(c))


def double_to_long(c) -> Column:
    """Integer from a double column: cut off, NULL when it does not fit."""
    return (F.col(c) if isinstance(c, str) else c).try_cast("bigint")


def to_bool(c) -> Column:
    """Boolean from text words."""
    s = F.lower(strip(c))
    return F.when(s.isin(*TRUE_WORDS), F.lit(True)).when(s.isin(*FALSE_WORDS), F.lit(False))


def number_to_bool(c) -> Column:
    """Boolean from a numeric column: anything but zero is true."""
    return (F.col(c) if isinstance(c, str) else c) != 0


def iso_date(c) -> Column:
    """Date from ``YYYY-MM-DD`` or ``YYYYMMDD`` alone; a time of day makes it junk."""
    s = strip(c)
    dashed = F.concat_ws("-", F.substring(s, 1, 4), F.substring(s, 5, 2), F.substring(s, 7, 2))
    return F.when(s.rlike(_ISO_DATE), s.try_cast("date")).when(
        s.rlike(_BASIC_DATE), dashed.try_cast("date")
    )


def to_date(c) -> Column:
    """Date part of an ISO date or ISO date-time."""
    s = strip(c)
    moment = F.when(s.rlike(_ISO_MOMENT), F.substring(s, 1, 10).try_cast("date"))
    return F.coalesce(iso_date(c), moment)
