"""Paginated event sources that may repeat pages, time out and answer out of order."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.dedup import first_by

RETRIES = 3


@dataclass(frozen=True)
class Page:
    snapshot_id: str
    page_number: int
    cursor: str | None
    next_cursor: str | None
    events: Sequence[dict]


def read_pages(fetch: Callable[[str | None], Page], *, retries: int = RETRIES, on_page: Callable[[Page], None] = lambda page: None) -> Iterator[Page]:
    """Pages from the first cursor to the last; each is asked for again after a timeout, at most ``retries`` times."""
    cursor, seen = None, set()
    while True:
        for attempt in range(retries + 1):
            try:
                page = fetch(cursor)
                break
            except TimeoutError:
                if attempt == retries:
                    raise
        if page.page_number not in seen:
            seen.add(page.page_number)
            on_page(page)
        yield page
        if page.next_cursor is None:
            return
        cursor = page.next_cursor


def ingest(fetch: Callable[[str | None], Page], **options) -> list[dict]:
    """The events of all pages, the first of each event_id."""
    events: dict[str, dict] = {}
    for page in read_pages(fetch, **options):
        for event in page.events:
            if not event.get("event_id"):
                raise ValueError(f"page {page.page_number}: an event has no event_id")
            events.setdefault(event["event_id"], event)
    return list(events.values())


def same_events(a: Sequence[dict], b: Sequence[dict]) -> bool:
    """Whether two replays saw the same events, in whatever order."""
    return {e["event_id"]: e for e in a} == {e["event_id"]: e for e in b}


def first_seen(events: DataFrame, keys: Sequence[str], page: str, position: str) -> DataFrame:
    """The same for events in a frame: the first of each key by page and position in it."""
    return first_by(events, keys, [F.col(page), F.col(position)])


class Simulated:
    """A source that misbehaves in the same way each time: it repeats pages, times out once a page, and reverses even pages."""

    def __init__(self, events: Sequence[dict], page_size: int, *, repeated: Sequence[int] = (), timeouts: Sequence[int] = (), reverse_even: bool = False, snapshot_id: str = "simulated"):
        order = []
        for number in range(-(-len(events) // page_size)):
            order += [number] * (2 if number in repeated else 1)
        self.events, self.size, self.order, self.pending = list(events), page_size, order, {*timeouts}
        self.reverse_even, self.snapshot_id = reverse_even, snapshot_id

    def __call__(self, cursor: str | None) -> Page:
        at = int(cursor or 0)
        number = self.order[at]
        if number in self.pending:
            self.pending.discard(number)
            raise TimeoutError(f"page {number}")
        events = self.events[number * self.size : (number + 1) * self.size]
        if self.reverse_even and number % 2 == 0:
            events = events[::-1]
        return Page(self.snapshot_id, number, cursor, str(at + 1) if at + 1 < len(self.order) else None, events)
