"""Which days a run processes.  Plain dates; the data behind them is in Spark."""

from __future__ import annotations

from datetime import date, timedelta
from typing import NamedTuple


class Window(NamedTuple):
    start: date
    end_exclusive: date
    last_day: date


def latest(*days: date | None) -> date | None:
    """The latest of the given days, ignoring missing ones."""
    return max((d for d in days if d is not None), default=None)


def resume_day(
    has_cursor: bool, cursor_day: date | None, contiguous_day: date | None
) -> date | None:
    """Last processed day: the earlier of cursor and stored contiguous days when
    both are known; a cursor without a day wins over the stored days."""
    if not has_cursor:
        return contiguous_day
    if cursor_day is not None and contiguous_day is not None:
        return min(cursor_day, contiguous_day)
    return cursor_day


def processing_window(
    min_day: date,
    max_day: date,
    last_processed: date | None = None,
    start: date | None = None,
    end: date | None = None,
    today: date | None = None,
) -> Window | None:
    """Days to process, None when there are none.

    A requested start wins; otherwise work resumes after the last processed day
    or at the first source day.  The end is the earliest of the last source day,
    today and the requested end.
    """
    bounds = [d for d in (max_day, today, end) if d is not None]
    last_day = min(bounds)
    if start is None:
        start = min_day if last_processed is None else last_processed + timedelta(days=1)
    start = max(start, min_day)
    end_exclusive = last_day + timedelta(days=1)
    return Window(start, end_exclusive, last_day) if start < end_exclusive else None
