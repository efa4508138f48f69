"""Value conversion between German text and Spark types, as Column -> Column functions.

Every function is a composition of built-in expressions, so it stays inside whole-stage
codegen.  Nothing here raises on bad input: a value that does not convert becomes NULL, and
``rejected`` says whether that happened, so a caller can count such values or refuse the table.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The space separators (Unicode category Zs) that trimming removes.
SPACES = (
    " \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u202f\u205f\u3000"
)
# Fixed value: control characters removed from text columns.
CONTROL_CHARS = r"[\x00-\x1F\x7F-\x9F]"

_GERMAN_DATE = r"^\d{1,2}\.\d{1,2}\.\d{4}$"
_USUAL_GERMAN_DATE = r"^\d\d\.\d\d\.(?:1[6-9]|[2-9]\d)\d\d\z"
_SPACED_GERMAN_DATE = rf"^[{SPACES}]*(\d{{1,2}}\.\d{{1,2}}\.\d{{4}})[{SPACES}]*$"
_PLAIN_DOUBLE = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def _as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_spaces(c: Column | str) -> Column:
    return F.trim(_as_col(c), F.lit(SPACES))


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(trim_spaces(c), F.lit(""))


def clean_text(c: Column | str) -> Column:
    """Remove every control character, then trim outer spaces."""
    return trim_spaces(F.regexp_replace(_as_col(c), CONTROL_CHARS, ""))


def _number_text(c: Column, decimal: str, grouping: str) -> Column:
    plain = F.replace(c, F.lit(grouping), F.lit("")) if grouping else c
    return plain if decimal == "." else F.replace(plain, F.lit(decimal), F.lit("."))


def to_decimal(
    c: Column | str, precision: int, scale: int, decimal: str = ",", grouping: str = "."
) -> Column:
    """Localised decimal text to DECIMAL(precision, scale), rounding half up; bad text is NULL.

    The cast refuses whatever is not a number, but would read exponents (1e3) and the digits of
    other scripts; both are kept from it by byte checks, which cost less than a pattern.
    """
    c = _as_col(c)
    plain = ~F.contains(c, F.lit("e")) & ~F.contains(c, F.lit("E"))
    if (decimal + grouping).isascii():
        plain = plain & (F.octet_length(c) == F.length(c))
    else:
        plain = c.rlike(rf"^\s*[+-]?[0-9\Q{decimal}{grouping}\E]+\s*$")
    number = _number_text(c, decimal, grouping).try_cast(f"decimal({precision},{scale})")
    return F.when(plain, number)


def to_integer(c: Column | str, grouping: str = ".") -> Column:
    """Grouped integer text to BIGINT; anything but sign and digits is NULL."""
    return _number_text(_as_col(c), ".", grouping).try_cast("bigint")


def to_date(c: Column | str) -> Column:
    """``D.M.YYYY`` text to DATE; blank or impossible dates are NULL."""
    c = _as_col(c)
    # Parsing text that is no date is costly, so only text of the right form gets there.
    inner = F.regexp_extract(c, _SPACED_GERMAN_DATE, 1)
    parts = [F.substring(c, at, n) for at, n in ((7, 4), (4, 2), (1, 2))]
    # The usual form needs no formatter; what is no date in it is left to the formatter.
    usual = F.when(c.rlike(_USUAL_GERMAN_DATE), F.concat_ws("-", *parts).try_cast("date"))
    other = F.when(c.rlike(_GERMAN_DATE), F.try_to_date(c, "d.M.yyyy")).when(
        c.rlike(_SPACED_GERMAN_DATE), F.try_to_date(inner, "d.M.yyyy")
    )
    return F.coalesce(usual, other)


def iso_date(c: Column | str) -> Column:
    """``YYYY-M-D`` or ``YYYY/M/D`` text to DATE."""
    text = trim_spaces(c)
    return F.when(
        text.rlike(r"^\d{4}([-/])\d{1,2}\1\d{1,2}$"),
        F.replace(text, F.lit("/"), F.lit("-")).try_cast("date"),
    )


def iso_timestamp(c: Column | str) -> Column:
    """``YYYY-MM-DD hh:mm[:ss[.f]]`` text to TIMESTAMP_NTZ."""
    text = trim_spaces(c)
    return F.when(
        text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}[ T]\d{1,2}:\d{2}(:\d{2}(\.\d{1,9})?)?$"),
        text.try_cast("timestamp_ntz"),
    )


def plain_double(c: Column | str) -> Column:
    """Point-decimal text to DOUBLE; ``nan``, ``inf`` and type suffixes are refused."""
    c = _as_col(c)
    return F.when(c.rlike(_PLAIN_DOUBLE), trim_spaces(c).try_cast("double"))


def german_double(c: Column | str, decimal: str = ",", grouping: str = ".") -> Column:
    """Localised decimal text to DOUBLE."""
    plain = _number_text(_as_col(c), decimal, grouping)
    return F.when(
        plain.rlike(r"^\s*[+-]?(\d+\.?\d*|\.\d+)\s*$"), trim_spaces(plain).try_cast("double")
    )


def plain_boolean(c: Column | str) -> Column:
    text = F.lower(trim_spaces(c))
    return F.when(text.isin("true", "t"), F.lit(True)).when(text.isin("false", "f"), F.lit(False))


def voucher_date(c: Column | str, year: Column | int) -> Column:
    """Voucher date ``DDMM`` or ``DMM`` plus the year of the batch header.

    The last two characters are the month and the rest is the day, so ``103`` is 1 March.
    """
    text = trim_spaces(c)
    year = year if isinstance(year, Column) else F.lit(year)
    parts = F.concat_ws(
        "-",
        F.lpad(year.cast("string"), 4, "0"),
        F.right(text, F.lit(2)),
        F.substring(text, F.lit(1), F.length(text) - 2),
    )
    return F.when(text.rlike(r"^\d{3,4}$"), parts.try_cast("date"))


def booking_decimal(c: Column | str, precision: int, scale: int) -> Column:
    """German decimal of a booking batch: trimmed, blank is NULL."""
    return to_decimal(blank_to_null(c), precision, scale)


def rejected(raw: Column, typed: Column, blank_ok: bool = False) -> Column:
    """True where a value was present but did not convert.  Dates and booking fields treat
    blank text as absent, numbers do not."""
    present = raw.isNotNull()
    if blank_ok:
        present = present & (trim_spaces(raw) != "")
    return F.coalesce(present & typed.isNull(), F.lit(False))


def export_decimal(c: Column | str, scale: int | None = None) -> Column:
    """Number to text with a decimal comma and no grouping.  A scale rounds half up first."""
    c = _as_col(c)
    if scale is not None:
        c = c.try_cast(f"decimal(38,{scale})")
    return F.replace(c.cast("string"), F.lit("."), F.lit(","))


def export_integer(c: Column | str) -> Column:
    return _as_col(c).cast("string")


def export_date(c: Column | str) -> Column:
    return F.date_format(_as_col(c), "dd.MM.yyyy")


def export_text(c: Column | str) -> Column:
    return _as_col(c).cast("string")
