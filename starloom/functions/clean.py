"""Column expressions that turn raw text into typed values.

Everything here is a built-in Spark expression, so a whole row is cleaned in
one code-generated projection. Text that cannot be read becomes NULL; the
staging step sends such rows to its rejects frame.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns and formats of the raw extracts.
NOT_INTEGER_CHARS = r"[^0-9\-]"
NOT_DECIMAL_CHARS = r"[^0-9\.-]"
US_TIMESTAMP = "M/d/yyyy H:mm"
NOT_AVAILABLE = "N/A"


def _stripped(c: Column, pattern: str) -> Column:
    # What is left may be blank, which reads as NULL.
    return F.regexp_replace(c, pattern, "")


def _to_integer(c: Column, kind: str) -> Column:
    # Text that is a plain number already skips the pattern.
    return F.coalesce(c.try_cast(kind), _stripped(c, NOT_INTEGER_CHARS).try_cast(kind))


def to_long(c: Column) -> Column:
    """Digits and minus signs as BIGINT. A decimal point is removed as well
    (``'12.0'`` reads 120) and an inner minus (``'12-3'``) gives NULL."""
    return _to_integer(c, "bigint")


def to_int(c: Column) -> Column:
    """As :func:`to_long`, for INT."""
    return _to_integer(c, "int")


def to_decimal(c: Column, precision: int, scale: int) -> Column:
    """Amount text without currency and thousands marks, rounded half up."""
    return _stripped(c, NOT_DECIMAL_CHARS).try_cast(f"decimal({precision},{scale})")


def percent_to_fraction(c: Column) -> Column:
    """``'35%'`` as 0.3500. The text is always divided by 100, also ``'0.35'``."""
    wide = to_decimal(c, 24, 12)
    return (wide * F.lit("0.01").cast("decimal(2,2)")).try_cast("decimal(7,4)")


def to_ts(c: Column) -> Column:
    """Month/day/year hour:minute, with or without leading zeros."""
    return F.try_to_timestamp(c, F.lit(US_TIMESTAMP)).cast("timestamp_ntz")


def loses_point(c: Column) -> Column:
    """True where integer cleaning drops a decimal point and so changes the value."""
    return F.coalesce(c.contains("."), F.lit(False))


def text_or_na(c: Column) -> Column:
    """Trim, then default: blank text stays blank."""
    return F.coalesce(F.trim(c), F.lit(NOT_AVAILABLE))


def na_then_trim(c: Column) -> Column:
    """Default, then trim."""
    return F.trim(F.coalesce(c, F.lit(NOT_AVAILABLE)))


def is_present(c: Column) -> Column:
    """Neither NULL nor blank."""
    return F.trim(F.coalesce(c, F.lit(""))) != ""


def full_name(first: Column, last: Column) -> Column:
    """First and last name without the ``N/A`` parts; both unknown gives ``''``
    and a blank part keeps its separator."""
    known = [F.nullif(part, F.lit(NOT_AVAILABLE)) for part in (first, last)]
    return F.concat_ws(" ", *known)


def as_decimal(c: Column, precision: int = 18, scale: int = 2) -> Column:
    """Value of any type read as a decimal, blank text as NULL."""
    return F.nullif(c.cast("string"), F.lit("")).try_cast(f"decimal({precision},{scale})")
