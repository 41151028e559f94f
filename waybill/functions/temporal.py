"""Calendar and duration expressions on zone-less timestamps.

None of them depends on the session time zone.
"""

from __future__ import annotations

from datetime import datetime

from waybill.functions.numeric import text
from waybill.profile import OFF_PEAK, TIME_WINDOWS, WINDOW_ORDER

DAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def instant(t: datetime) -> str:
    return f"TIMESTAMP_NTZ '{t.isoformat(sep=' ')}'"


def seconds_between(start: str, end: str) -> str:
    """Seconds as a double, fractions kept.

    The difference of two zone-less timestamps is an interval; reading it through
    a compact decimal is about twice as fast as ``timestampdiff``, which also goes
    through the session time zone.
    """
    return f"CAST(CAST(CAST({end} - {start} AS INTERVAL SECOND) AS DECIMAL(18,6)) AS DOUBLE)"


def hour_of(ts: str) -> str:
    return f"CAST(hour({ts}) AS BIGINT)"


def iso_weekday(ts: str) -> str:
    """1 = Monday ... 7 = Sunday."""
    return f"CAST(weekday({ts}) + 1 AS BIGINT)"


def day_name(ts: str) -> str:
    return f"element_at(array({', '.join(map(text, DAY_NAMES))}), weekday({ts}) + 1)"


def is_weekend(ts: str) -> str:
    return f"coalesce(weekday({ts}) >= 5, FALSE)"


def time_window(ts: str) -> str:
    """Band of the hour, looked up in one label per hour of the day."""
    labels = [
        next((label for label, first, last in TIME_WINDOWS if first <= hour <= last), OFF_PEAK)
        for hour in range(24)
    ]
    named = f"element_at(array({', '.join(map(text, labels))}), hour({ts}) + 1)"
    return f"coalesce({named}, {text(OFF_PEAK)})"


def window_rank(window: str) -> str:
    """Position of a time window in report order."""
    return f"array_position(array({', '.join(map(text, WINDOW_ORDER))}), {window})"
