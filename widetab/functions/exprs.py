"""Small column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text tokens the reference treats as missing.
DEFAULT_NA_TOKENS = ("-1", "", "[]")

# Fixed value: layout of text dates in the reference data (day, upper-case
# month abbreviation, two-digit year, then time of day).
TEXT_DATE_FORMAT = "ddMMMyy:HH:mm:ss"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_if_token(c, tokens: Iterable[str] = DEFAULT_NA_TOKENS) -> Column:
    """NULL when the text value is one of ``tokens``; otherwise the value."""
    c = col_(c)
    return F.when(~c.isin(list(tokens)), c)


def nan_to_null(c) -> Column:
    """NaN → NULL for doubles (Spark keeps NaN distinct from NULL)."""
    c = col_(c)
    return F.when(~F.isnan(c), c)


def parse_text_date(c, fmt: str = TEXT_DATE_FORMAT, pivot_year: int = 69) -> Column:
    """Parse a text date; unparsable → NULL.

    The result is a TIMESTAMP_NTZ holding the wall-clock time, so it means
    the same instant (read as UTC, as the reference did) whatever the
    session time zone. Spark maps two-digit years to 2000-2099; POSIX ``%y``
    maps 69-99 to the 1900s, so those are moved back one century.
    """
    ts = F.try_to_timestamp(col_(c), F.lit(fmt)).cast("timestamp_ntz")
    if "yy" not in fmt or "yyyy" in fmt:
        return ts
    return F.when(F.year(ts) >= 2000 + pivot_year,
                  F.timestamp_add("YEAR", F.lit(-100), ts)).otherwise(ts)


def epoch_seconds(c) -> Column:
    """Timestamp → seconds since the epoch, as double."""
    return F.unix_timestamp(col_(c)).cast("double")


def safe_ratio(num, den) -> Column:
    """num / den as double; NULL when den is 0 or NULL (ANSI-safe)."""
    return F.try_divide(col_(num).cast("double"), col_(den).cast("double"))
