"""Calendar parts and tumbling windows."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

CALENDAR_MONTHS = {"month": 1, "quarter": 3, "year": 12}
FIXED_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def split_window(window: str) -> tuple[int, str]:
    """'2 weeks' -> (2, 'week')."""
    match = re.fullmatch(r"\s*(\d+)\s+([a-z]+?)s?\s*", window.lower())
    if not match or int(match[1]) < 1:
        raise ValueError(f"not a window length: {window!r}")
    count, unit = int(match[1]), match[2]
    if unit not in CALENDAR_MONTHS and unit not in FIXED_SECONDS:
        raise ValueError(f"not a window unit: {unit!r}")
    return count, unit


def is_shorter_than_a_day(window: str) -> bool:
    count, unit = split_window(window)
    return count * FIXED_SECONDS.get(unit, 31 * 86400) < 86400


def window_start(timestamp: Column, window: str) -> Column:
    """Start of the tumbling window holding `timestamp`.

    Months, quarters and years follow the calendar (`window()` refuses them);
    fixed lengths are aligned to 1970-01-01 00:00 as `window()` does.
    """
    count, unit = split_window(window)
    if unit not in CALENDAR_MONTHS:
        return F.window(timestamp, f"{count} {unit}s")["start"]
    months = count * CALENDAR_MONTHS[unit]
    if months == 1:
        return F.trunc(timestamp.cast("date"), "month")
    since_epoch = (F.year(timestamp) - 1970) * 12 + F.month(timestamp) - 1
    return F.add_months(F.lit("1970-01-01").cast("date"), since_epoch - F.pmod(since_epoch, F.lit(months)))


def window_end(start: Column, window: str) -> Column:
    """End of the window that begins at `start`."""
    count, unit = split_window(window)
    if unit in CALENDAR_MONTHS:
        return F.add_months(start.cast("date"), count * CALENDAR_MONTHS[unit])
    return start + F.expr(f"INTERVAL '{count * FIXED_SECONDS[unit]}' SECOND")


def calendar_parts(timestamp: Column) -> dict[str, Column]:
    """Date, hour, weekday (Monday = 0), month, quarter and year."""
    return {
        "date": F.to_date(timestamp),
        "hour": F.hour(timestamp).cast("bigint"),
        "day_of_week": F.weekday(timestamp).cast("bigint"),
        "month": F.month(timestamp).cast("bigint"),
        "quarter": F.quarter(timestamp).cast("bigint"),
        "year": F.year(timestamp).cast("bigint"),
    }
