"""Month arithmetic for snapshots."""

from __future__ import annotations

import datetime as dt
import re

_MONTH = re.compile(r"^(\d{4})-(\d{2})$")
LONGEST_BACKFILL = 12


def parse_month(text: str) -> dt.date:
    """The first day of a month written YYYY-MM."""
    found = _MONTH.match(text.strip())
    if not found:
        raise ValueError(f"not a month: {text!r}")
    return dt.date(int(found[1]), int(found[2]), 1)


def first_of_month(text: str) -> dt.date:
    """A date YYYY-MM-DD that must be the first of its month."""
    day = dt.date.fromisoformat(text)
    if day.day != 1:
        raise ValueError(f"not the first of a month: {text}")
    return day


def shifted(month: dt.date, by: int) -> dt.date:
    years, zero_based = divmod(month.year * 12 + month.month - 1 + by, 12)
    return dt.date(years, zero_based + 1, 1)


def months_between(start: dt.date, end: dt.date) -> list[dt.date]:
    """Both ends included; a reversed range is an error."""
    first, last = start.replace(day=1), end.replace(day=1)
    if last < first:
        raise ValueError(f"{end} is before {start}")
    count = (last.year - first.year) * 12 + last.month - first.month
    return [shifted(first, k) for k in range(count + 1)]


def expected_months(processing: dt.date, lag: int, lookback: int) -> list[dt.date]:
    """The ``lookback`` months whose publication is due: the newest is ``lag`` months before the processing date's."""
    if lag < 0 or lookback < 1:
        raise ValueError("lag must not be negative and lookback must be positive")
    newest = shifted(processing.replace(day=1), -lag)
    return months_between(shifted(newest, 1 - lookback), newest)


def backfill_months(start: str, end: str) -> list[dt.date]:
    """At most LONGEST_BACKFILL months, with both ends given."""
    if not start or not end:
        raise ValueError("a backfill needs both of its ends")
    found = months_between(parse_month(start), parse_month(end))
    if len(found) > LONGEST_BACKFILL:
        raise ValueError(f"a backfill has at most {LONGEST_BACKFILL} months")
    return found
