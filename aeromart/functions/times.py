"""Instants and calendar parts. Days are those of the session time zone unless `tz` is given."""

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed import CSV_TIME_FORMAT


def as_utc(at: datetime) -> datetime:
    """The instant in UTC; a time without a zone already is."""
    return at.replace(tzinfo=timezone.utc) if at.tzinfo is None else at.astimezone(timezone.utc)


def parse_iso(col: Column) -> Column:
    """ISO-8601 text with an offset to an instant; bad text is NULL."""
    return F.try_to_timestamp(col)


def parse_ts_tz(date_col: Column, tz_col: Column) -> Column:
    """Local date-time text and `+hh:mm` offset text to an instant; NULL if either is NULL."""
    return F.try_to_timestamp(F.concat(date_col, F.lit(" "), tz_col), F.lit(CSV_TIME_FORMAT))


def to_date(col: Column, tz: str | None = None) -> Column:
    """Calendar day of an instant; with `tz` the day there, in whatever zone the session is."""
    if tz is None:
        return F.to_date(col)
    return F.convert_timezone(F.current_timezone(), F.lit(tz), col.cast("timestamp_ntz")).cast("date")


def year_month(col: Column) -> tuple[Column, Column]:
    """Year and two-digit month, both text, as the partition folders spell them."""
    return F.year(col).cast("string"), F.lpad(F.month(col).cast("string"), 2, "0")
