"""Report dates as users write them."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone


def parse_report_date(text: str) -> datetime:
    """An ISO date or datetime as a naive UTC datetime; ``Z`` and offsets are
    converted, and what has none is UTC already.  ValueError for anything else."""
    at = datetime.fromisoformat(text.strip())
    return at.astimezone(timezone.utc).replace(tzinfo=None) if at.tzinfo else at


def report_bounds(start: str, end: str, end_exclusive: str | None = None) -> tuple[date, date]:
    """Start and exclusive end of an inclusive report window, as dates."""
    stop = parse_report_date(end_exclusive).date() if end_exclusive else parse_report_date(end).date() + timedelta(days=1)
    return parse_report_date(start).date(), stop
