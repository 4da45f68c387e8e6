"""A paginated HTTP source as a Spark data source, for batches and for streams whose offsets are cursors.

    spark.dataSource.register(paged.PagedSource)   # or paged.register(spark)
    spark.read.format("tidemark_pages").option("url", url).load()
    spark.readStream.format("tidemark_pages").option("url", url).load()

The source answers GET ``url?cursor=c`` with a page: {"snapshot_id", "page", "events": [{"event_id", ...}, ...], "next"}; ``next`` is
the cursor that follows, also where its page is not there yet: such a page has no events and a null ``next``.  The first cursor
is empty.  A stream also asks ``url?newest=1`` for {"cursor"}, the first one whose page is not there yet.

Pages are walked by tasks, which turn each into rows and forget it: nothing passes through the driver but cursors.  A task that
is tried again walks the same cursors again; a stream commits the cursor that it has reached, so after a stop it goes on there.
A source may repeat pages and reorder events; ``pages.first_seen`` and ``streaming.events.once`` take each event once.

Options: ``url``; ``start``, the first cursor; ``starts``, more cursors in order, separated by commas, where other tasks begin;
``retries`` and ``wait``, the first of the growing waits in seconds; ``timeout`` of a request.
"""

from __future__ import annotations

import http.client
import json
import sys
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

NAME = "tidemark_pages"
SCHEMA = "event_id string, event string, snapshot_id string, page bigint, position int"
RETRY_STATUSES = (429, 500, 502, 503, 504)
LONGEST_WAIT = 600.0


def asked(url: str, options: dict[str, str], **query: str) -> dict:
    """The JSON that a source answers; refused, broken and short answers are asked for again after growing waits."""
    place = f"{url}{'&' if '?' in url else '?'}{urllib.parse.urlencode(query)}"
    retries, pause = int(options.get("retries", 4)), float(options.get("wait", 1.0))
    for attempt in range(retries + 1):
        told = 0.0
        try:
            with urllib.request.urlopen(place, timeout=float(options.get("timeout", 60))) as answer:  # noqa: S310
                return json.loads(answer.read())
        except urllib.error.HTTPError as error:
            if error.code not in RETRY_STATUSES or attempt == retries:
                raise
            after = error.headers.get("Retry-After") or ""
            told = float(after) if after.isdigit() else 0.0
        except (OSError, http.client.HTTPException, json.JSONDecodeError):
            if attempt == retries:
                raise
        time.sleep(min(LONGEST_WAIT, max(told, pause * 2**attempt)))
    raise AssertionError("not reached")


class Stretch(InputPartition):
    """Pages from one cursor up to another; None: to the last."""

    def __init__(self, start: str, end: str | None):
        super().__init__(start)
        self.start, self.end = start, end


def walked(options: dict[str, str], stretch: Stretch) -> Iterator[tuple]:
    """The rows of a stretch, page by page."""
    cursor: str | None = stretch.start
    seen: set[str] = set()
    while cursor is not None and cursor != stretch.end:
        if cursor in seen:
            raise ValueError(f"cursor {cursor} leads back to itself")
        seen.add(cursor)
        page = asked(options["url"], options, cursor=cursor)
        for position, event in enumerate(page["events"]):
            if not event.get("event_id"):
                raise ValueError(f"page {page['page']}: an event has no event_id")
            yield str(event["event_id"]), json.dumps(event, sort_keys=True), page.get("snapshot_id"), int(page["page"]), position
        cursor = page.get("next")
    if cursor is None and stretch.end is not None:
        raise ValueError(f"no page leads to cursor {stretch.end}")


class PagedReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = options

    def partitions(self) -> list[Stretch]:
        starts = [self.options.get("start", ""), *(s for s in self.options.get("starts", "").split(",") if s)]
        return [Stretch(a, b) for a, b in zip(starts, [*starts[1:], None], strict=True)]

    def read(self, partition: Stretch) -> Iterator[tuple]:
        return walked(self.options, partition)


class PagedStream(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.options = options

    def initialOffset(self) -> dict:
        return {"cursor": self.options.get("start", "")}

    def latestOffset(self) -> dict:
        return {"cursor": asked(self.options["url"], self.options, newest="1")["cursor"]}

    def partitions(self, start: dict, end: dict) -> list[Stretch]:
        return [Stretch(start["cursor"], end["cursor"])] if start != end else []

    def read(self, partition: Stretch) -> Iterator[tuple]:
        return walked(self.options, partition)


class PagedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def _checked(self) -> dict[str, str]:
        options = {k.lower(): v for k, v in self.options.items()}
        if not options.get("url"):
            raise ValueError(f"{NAME} needs the option url")
        return options

    def reader(self, schema) -> PagedReader:
        return PagedReader(self._checked())

    def streamReader(self, schema) -> PagedStream:
        return PagedStream(self._checked())


def register(spark: SparkSession) -> None:
    """Makes the format known; its classes go to the tasks by value, so machines need not have this package."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(PagedSource)
