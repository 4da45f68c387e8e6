"""Landing of immutable, checksum-addressed snapshots, on any file system that Spark reads.

Content goes through in chunks: what is fetched is written beside its place and hashed on the way, its footer is read where it
lies, and a rename that overwrites nothing lands it.  A run that breaks off leaves nothing at the place.
"""

from __future__ import annotations

import datetime as dt
import email.utils
import hashlib
import http.client
import re
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import asdict, dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

from tidemark.sources.files import CHUNK, Files, Taken

REQUIRED_COLUMNS = ["VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "PULocationID", "DOLocationID"]
RETRIES, BACKOFF, RETRY_STATUSES = 4, 1.0, (429, 500, 502, 503, 504)
#: Breaks of a connection, be it at its start or within the content.
TRANSIENT = (urllib.error.URLError, TimeoutError, ConnectionError, http.client.HTTPException)
#: The longest that a source may ask to be waited for, in seconds.
LONGEST_WAIT = 600.0
_LANDED = re.compile(r"snapshot=([0-9a-f]{64})(?:/|$)")


@dataclass(frozen=True)
class Snapshot:
    source_month: str
    snapshot_id: str
    uri: str
    checksum: str
    rows_received: int | None
    bytes_received: int
    source_url: str = ""
    source_version: str = ""

    def payload(self) -> dict:
        return asdict(self)


class Conflict(ValueError):
    """Other content is already at an immutable place."""


@dataclass
class Tally:
    """SHA-256 and size of the chunks that go through."""

    digest: object = field(default_factory=hashlib.sha256)
    size: int = 0

    def through(self, chunks: Iterable[bytes]) -> Iterator[bytes]:
        for chunk in chunks:
            self.digest.update(chunk)
            self.size += len(chunk)
            yield chunk

    @property
    def checksum(self) -> str:
        return self.digest.hexdigest()


def _settled(files: Files, staged: str, path: str, checksum: str) -> str:
    try:
        files.settle(staged, path)
    except Taken:
        if files.checksum(path) == checksum:
            return "already_landed"
        raise Conflict(path) from None
    return "landed"


def land(spark: SparkSession, chunks: Iterable[bytes], path: str, expected: str | None = None) -> str:
    """Creates a file that is never changed: ``landed``, or ``already_landed`` if the same bytes are there."""
    files, tally = Files(spark), Tally()
    staged = files.stage(path, tally.through(chunks))
    if not tally.size or expected not in (None, tally.checksum):
        files.delete(staged)
        raise ValueError(f"checksum {tally.checksum}, not {expected}" if tally.size else "nothing to land")
    return _settled(files, staged, path, tally.checksum)


@dataclass(frozen=True)
class Response:
    """What a fetcher gives: HTTP status, declared length if any, content in chunks, and how long the source asks to wait."""

    status: int
    length: int | None
    chunks: Iterable[bytes] = ()
    retry_after: float | None = None


def asked_wait(value: str | None, now: dt.datetime | None = None) -> float | None:
    """The seconds that a Retry-After header tells, which is a number or a date; None where it tells nothing."""
    if not value:
        return None
    try:
        return max(0.0, float(value))
    except ValueError:
        pass
    try:
        moment = email.utils.parsedate_to_datetime(value)
    except ValueError:
        return None
    return max(0.0, (moment - (now or dt.datetime.now(dt.UTC))).total_seconds())


def by_http(url: str, timeout: float = 60) -> Response:
    """Fetches a URL; the content is read as it is asked for."""
    try:
        answer = urllib.request.urlopen(url, timeout=timeout)  # noqa: S310
    except urllib.error.HTTPError as error:
        return Response(error.code, None, retry_after=asked_wait(error.headers.get("Retry-After")))
    length = answer.headers.get("Content-Length")
    return Response(answer.status, int(length) if length else None, iter(lambda: answer.read(CHUNK), b""))


def stored(spark: SparkSession) -> Callable[[str], Response]:
    """A fetcher of what lies on file systems that Spark reads, file:// among them."""
    files = Files(spark)
    return lambda uri: Response(200, None, files.chunks(uri)) if files.exists(uri) else Response(404, None)


def by_scheme(spark: SparkSession) -> Callable[[str], Response]:
    """The fetcher that a URL's scheme asks for."""
    other = stored(spark)
    return lambda url: (by_http if urllib.parse.urlsplit(url).scheme in ("http", "https") else other)(url)


class Short(ConnectionError):
    """The content ended before its declared length."""


def fetched[T](fetch: Callable[[str], Response], url: str, take: Callable[[Response], T], *, wait: Callable[[float], None] = time.sleep) -> T | None:
    """What ``take`` makes of a response with content; None where there is nothing; other statuses raise.

    Statuses that ask for it, broken connections and time-outs, also within the content, are tried again after growing waits, or
    as long as the source asks, LONGEST_WAIT at most.  ``take`` starts anew each time.
    """
    for attempt in range(RETRIES + 1):
        asked, failure = None, None
        try:
            response = fetch(url)
            if response.status == 200:
                return take(response)
            if response.status == 404:
                return None
            asked, failure = response.retry_after, OSError(f"{url}: status {response.status}")
            if response.status not in RETRY_STATUSES:
                raise failure
        except TRANSIENT as error:
            failure = error
        if attempt == RETRIES:
            raise failure
        wait(min(LONGEST_WAIT, max(BACKOFF * 2**attempt, asked or 0.0)))
    return None


def parquet_rows(spark: SparkSession, path: str) -> int:
    """Rows of a Parquet file that has the required columns; anything else raises."""
    try:
        frame = spark.read.parquet(path)
    except (PySparkException, Py4JJavaError) as error:
        raise ValueError(f"not a Parquet file: {path}") from error
    if missing := [c for c in REQUIRED_COLUMNS if c not in frame.columns]:
        raise ValueError(f"columns missing: {', '.join(missing)}")
    if not (rows := frame.count()):
        raise ValueError("the file has no rows")
    return rows


def fetch_snapshot(spark: SparkSession, month: str, url: str, folder: str, fetch: Callable[[str], Response], *, wait: Callable[[float], None] = time.sleep) -> Snapshot | None:
    """Lands a month's file below its checksum; None where it is not there yet."""
    files = Files(spark)

    def take(response: Response) -> tuple[str, Tally]:
        tally = Tally()
        aside = files.stage(f"{folder}/staging/source_month={month}/data.parquet", tally.through(response.chunks))
        if response.length not in (None, tally.size):
            files.delete(aside)
            raise Short(f"{url}: {tally.size} of {response.length} bytes")
        return aside, tally

    if (taken := fetched(fetch, url, take, wait=wait)) is None:
        return None
    staged, tally = taken
    try:
        visible = f"{folder}/staging/source_month={month}/checked-{tally.checksum}.parquet"  # readers pass over hidden files
        if files.exists(visible):
            files.delete(visible)  # left by a run that broke off
        files.settle(staged, visible)
        staged = visible
        rows = parquet_rows(spark, staged)
    except BaseException:
        files.delete(staged)
        raise
    path = f"{folder}/landed/source_month={month}/snapshot={tally.checksum}/data.parquet"
    _settled(files, staged, path, tally.checksum)
    return Snapshot(month, tally.checksum, path, tally.checksum, rows, tally.size, url, version_of(spark, path))


def is_landed(uri: str) -> bool:
    """Whether a place tells the checksum of what is there."""
    return bool(_LANDED.search(uri))


def version_of(spark: SparkSession, path: str) -> str:
    """A text that is greater for what was landed later: when the object was made, in milliseconds."""
    return f"{Files(spark).modified(path):020d}"


def landed_snapshot(month: str, uri: str, version: str = "") -> Snapshot:
    """A snapshot whose place already tells its checksum; how many rows it has is not known."""
    found = _LANDED.search(uri)
    if not found:
        raise ValueError(f"no checksum in {uri}")
    return Snapshot(month, found[1], uri, found[1], None, 0, uri, version)


def candidate_months(today: dt.date, count: int) -> list[str]:
    """Months before this one, newest first."""
    months, year, month = [], today.year, today.month
    for _ in range(count):
        year, month = (year - 1, 12) if month == 1 else (year, month - 1)
        months.append(f"{year:04d}-{month:02d}")
    return months


def discover_latest(candidates: Iterable[str], status_of: Callable[[str], int]) -> str | None:
    """The newest month that is there; 403 and 404 mean absent, other statuses raise."""
    for month in candidates:
        status = status_of(month)
        if status == 200:
            return month
        if status not in (403, 404):
            raise OSError(f"{month}: status {status}")
    return None


def resumed(snapshots: Iterable[Mapping], uris: Mapping[str, str]) -> dict[str, Snapshot]:
    """Snapshots that an earlier attempt of a run has landed from the very URIs that are asked for, by month."""
    return {s["source_month"][:7]: Snapshot(**(dict(s) | {"source_month": s["source_month"][:7]})) for s in snapshots if uris.get(s["source_month"][:7]) in (s["source_url"], s["uri"])}


def plan_landing(expected: list[str], found: dict[str, Snapshot | None], published: dict[str, str], dirty: set[str], backfill: bool = False) -> dict:
    """Which snapshots a run processes.

    Only the newest expected month may be absent, and only if it was never published.  Unchanged months are skipped unless
    they are dirty or backfilled; with nothing left the run has NO_DATA.
    """
    absent = [m for m in expected if found.get(m) is None]
    wrong = [m for m in absent if m != expected[-1] or m in published]
    if wrong:
        raise ValueError(f"months missing: {', '.join(wrong)}")
    work = [s for m in expected if (s := found.get(m)) and (backfill or m in dirty or published.get(m) != s.snapshot_id)]
    status = {"status": "SUCCESS"} if work else {"status": "NO_DATA", "reason": "no_changed_snapshots"}
    return status | {"snapshots": [s.payload() for s in work], "unavailable_months": absent}
