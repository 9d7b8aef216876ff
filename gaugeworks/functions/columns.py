"""Tolerant column conversions: a value that does not convert becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Space, tab, line feed, vertical tab, form feed, carriage return.
WHITESPACE = " \t\n\x0b\x0c\r"

_UUID = "^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column | str) -> Column:
    """Trim spaces; what is empty afterwards is NULL."""
    return F.nullif(F.trim(_col(c)), F.lit(""))


def strip(c: Column | str) -> Column:
    """Trim every kind of ASCII whitespace, not only spaces."""
    return F.btrim(_col(c), F.lit(WHITESPACE))


def to_int(c: Column | str) -> Column:
    """Text to an integer. Blanks are common and set aside first: a failing cast is slow."""
    return F.nullif(strip(c), F.lit("")).try_cast("int")


def to_double(c: Column | str) -> Column:
    return F.nullif(strip(c), F.lit("")).try_cast("double")


def to_decimal(c: Column | str, precision: int, scale: int) -> Column:
    return _col(c).try_cast(f"decimal({precision},{scale})")


def to_instant(c: Column | str, source_tz: str = "UTC") -> Column:
    """ISO text to a point in time.

    Text with an offset says its zone. Text without one is read in
    ``source_tz``, whatever the zone of the session is. For text only: a column that
    is a point in time already needs no parsing (``type_events`` tells them apart).
    """
    text = strip(c)
    zone = "Z" if source_tz == "UTC" else f" {source_tz}"
    # A sign or a Z behind the date starts an offset. Seconds may be left out
    # in the text, but the cast wants them in front of a zone.
    has_offset = F.substring(text, 11, 40).rlike("[zZ+-]")
    zoned = (
        F.when(has_offset, F.regexp_replace(text, r"([T ]\d{2}:\d{2})([zZ+-])", "$1:00$2"))
        .when(~F.contains(text, F.lit(":")), F.concat(text, F.lit(f" 00:00:00{zone}")))
        .when(text.rlike(r"[T ]\d{1,2}:\d{1,2}$"), F.concat(text, F.lit(f":00{zone}")))
        .otherwise(F.concat(text, F.lit(zone)))
    )
    # Without a date the cast would take a time of day as one of today.
    return F.when(text.rlike(r"^\d{4,6}-"), zoned.try_cast("timestamp"))


def ntz_instant(c: Column | str) -> Column:
    """A zoneless UTC time as a point in time, whatever the zone of the session is."""
    c = _col(c)
    seconds = F.date_part(F.lit("SECOND"), c)  # decimal(8,6)
    return F.timestamp_micros(
        F.unix_date(c.cast("date")) * F.lit(86_400_000_000)
        + F.hour(c) * F.lit(3_600_000_000)
        + F.minute(c) * F.lit(60_000_000).cast("bigint")
        + (seconds * 1_000_000).cast("bigint")
    )


def point_part(c: Column | str, index: int) -> Column:
    """Text of the first (latitude) or second (longitude) part of ``"lat, lon"``."""
    return F.trim(F.split_part(F.trim(_col(c)), F.lit(","), F.lit(index)))


def is_finite(c: Column | str) -> Column:
    """False for NULL, NaN and both infinities."""
    c = _col(c).cast("double")
    return F.coalesce(
        c.between(F.lit(-1.7976931348623157e308), F.lit(1.7976931348623157e308)), F.lit(False)
    )


def is_uuid(c: Column | str) -> Column:
    return _col(c).rlike(_UUID)


def differs(a: Column | str, b: Column | str) -> Column:
    """NULL-safe inequality."""
    return ~_col(a).eqNullSafe(_col(b))


def outside(c: Column | str, low: float, high: float) -> Column:
    """Range violation. NULL passes; NaN sorts above every number and fails."""
    return ~_col(c).between(F.lit(low), F.lit(high))
