"""Casts from raw text that give NULL instead of failing. All stay in codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def safe_int(value: Column | str) -> Column:
    """Whole number of 64 bits, halves away from zero: ``'30.6'`` is 31.

    A direct string-to-int cast rejects a fraction, hence the decimal step,
    which rounds once from the full text.
    """
    return _column(value).try_cast("decimal(38,0)").try_cast("bigint")


def safe_decimal(value: Column | str, precision: int, scale: int) -> Column:
    return _column(value).try_cast(f"decimal({precision},{scale})")


#: A whole date and nothing after it but a time of day, with or without a zone. Spark's own
#: cast also takes years, months and dates with any text after them.
MOMENT = r"^\s*(?!0000)\d{4}-\d{1,2}-\d{1,2}([ T]\d{1,2}:\d{1,2}(:\d{1,2}(\.\d{1,9})?)?(Z|[+-]\d{1,2}:?\d{2})?)?\s*$"


def safe_timestamp(value: Column | str) -> Column:
    """Timestamp without zone from ``yyyy-MM-dd``, with ``T`` or a space before any time.

    Years are 0001 to 9999. A zone after the time is dropped: times count as they are written.
    The cast drops most zones itself; only where it fails are they cut off first.
    """
    text = _column(value)
    without_zone = F.regexp_replace(text, r"(:\d{1,2}(?:\.\d{1,9})?)(?:Z|[+-]\d{1,2}:?\d{2})\s*$", "$1")
    return F.when(text.rlike(MOMENT), F.coalesce(text.try_cast("timestamp_ntz"), without_zone.try_cast("timestamp_ntz")))


def safe_date(value: Column | str) -> Column:
    """The day of ``safe_timestamp``: NULL as well if the time after the date is none."""
    return safe_timestamp(value).cast("date")


def iso_text(value: Column | str) -> Column:
    """ISO text of a zone-free timestamp, whatever the session's zone.

    The fraction always has six digits, so text order is time order.
    """
    text = F.translate(_column(value).cast("timestamp_ntz").cast("string"), " ", "T")
    return F.rpad(F.concat(text, F.when(F.length(text) == 19, ".").otherwise("")), 26, "0")
