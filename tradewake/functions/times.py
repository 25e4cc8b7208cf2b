"""Time conversions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"
BUSINESS_ZONE = "+08:00"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_key(ms: Column | str) -> Column:
    """Epoch milliseconds to ``yyyyMMdd`` in the session zone."""
    return F.date_format(F.timestamp_millis(_col(ms)), "yyyyMMdd")


def day_millis(text: Column | str) -> Column:
    """Date prefix of a text time to epoch milliseconds of that midnight; null when unreadable."""
    date = F.substring(_col(text), 1, 10).try_cast("date")
    return F.unix_millis(date.cast("timestamp"))


def text_millis(text: Column | str, zone: str = BUSINESS_ZONE) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` read in ``zone`` to epoch milliseconds; null when unreadable.

    The offset is part of the cast text, so the session zone plays no role. The cast is many
    times faster than a parse by pattern.
    """
    return F.unix_millis(F.concat(_col(text), F.lit(zone)).try_cast("timestamp"))


def age_years(birthday: Column | str, as_of: Column | None = None) -> Column:
    """Whole years of 365 days between a ``yyyy-MM-dd`` birthday and ``as_of`` (default today)."""
    today = F.current_date() if as_of is None else as_of
    days = F.datediff(today, _col(birthday).try_cast("date"))
    return F.floor(days / 365).cast("int")


def rowtime_seconds(ms: Column | str) -> Column:
    """Epoch milliseconds to a timestamp cut to whole seconds."""
    return F.timestamp_seconds((_col(ms) - _col(ms) % 1000) / 1000)


def rowtime_millis(ms: Column | str) -> Column:
    return F.timestamp_millis(_col(ms))


def time_text(ts: Column | str) -> Column:
    """Format a timestamp, or a text that holds one."""
    return F.date_format(_col(ts), TEXT_FORMAT)


def processing_millis(as_of_ms: int | None = None) -> Column:
    """The clock in whole seconds as milliseconds; a fixed value makes results repeatable."""
    if as_of_ms is not None:
        return F.lit(as_of_ms).cast("bigint")
    return F.unix_seconds(F.current_timestamp()) * 1000


def window_bounds(window: Column | str = "window") -> tuple[Column, Column]:
    """Text start and end of a window column, named ``stt`` and ``edt``."""
    w = _col(window)
    return time_text(w["start"]).alias("stt"), time_text(w["end"]).alias("edt")
