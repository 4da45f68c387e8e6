"""Landing, pages, rescue reads, months, configuration, monitoring, and the whole way of a snapshot."""

import datetime as dt
import http.client
import io
import json
import urllib.error
import urllib.parse

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import months
from tidemark.operators.tables import Table
from tidemark.plans import config, daily, monitor
from tidemark.sources import landing, paged, pages, rescue
from tidemark.sources.files import Files, Taken, Unsafe
from tidemark.streaming import bronze


def parquet(**columns) -> bytes:
    out = io.BytesIO()
    pq.write_table(pa.table(columns or {c: [1] for c in landing.REQUIRED_COLUMNS}), out)
    return out.getvalue()


def test_landing(spark, tmp_path):
    path = f"{tmp_path}/a/b.parquet"
    assert landing.land(spark, [b"x", b"y"], path) == "landed" and landing.land(spark, [b"xy"], path) == "already_landed"
    with pytest.raises(landing.Conflict):
        landing.land(spark, [b"y"], path)
    for chunks, expected in (([], None), ([b"z"], "0")):
        with pytest.raises(ValueError):
            landing.land(spark, chunks, f"{tmp_path}/c", expected)
    assert Files(spark).read(path) == b"xy" and Files(spark).names(f"{tmp_path}/a") == ["b.parquet"]


def test_landing_that_breaks_off_leaves_nothing(spark, tmp_path):
    path = f"{tmp_path}/a/b.parquet"

    def lost():
        yield b"x" * 10
        raise ConnectionError

    with pytest.raises(ConnectionError):
        landing.land(spark, lost(), path)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(Files, "settle", lambda *a: (_ for _ in ()).throw(ConnectionError()))
        with pytest.raises(ConnectionError):
            landing.land(spark, [b"y"], path)
    assert not Files(spark).exists(path)
    assert landing.land(spark, [b"z"], path) == "landed" and Files(spark).read(path) == b"z"


def test_fetch(spark, tmp_path):
    content = parquet()
    whole = lambda: landing.Response(200, len(content), iter([content[:100], content[100:]]))
    waits, answers = [], iter([landing.Response(503, None), landing.Response(429, None), whole()])
    assert landing.fetched(lambda url: next(answers), "u", lambda r: r.status, wait=waits.append) == 200 and waits == [1.0, 2.0]

    def snapshot(response):
        return landing.fetch_snapshot(spark, "2024-01", "u", str(tmp_path), lambda url: response, wait=waits.append)

    first = snapshot(whole())
    assert first.rows_received == 1 and landing.landed_snapshot("2024-01", first.uri).snapshot_id == first.snapshot_id == Files(spark).checksum(first.uri)
    assert snapshot(whole()) == first and landing.is_landed(first.uri) and not landing.is_landed("u")
    assert snapshot(landing.Response(404, None)) is None
    bad = [(403, None, b""), (500, None, b""), (200, 5, content), (200, None, b"not parquet"), (200, None, parquet(a=[1])), (200, None, parquet(**{c: pa.array([], pa.int64()) for c in landing.REQUIRED_COLUMNS}))]
    for status, length, body in bad:
        with pytest.raises((OSError, ValueError)):
            snapshot(landing.Response(status, length, [body]))
    assert Files(spark).names(f"{tmp_path}/staging/source_month=2024-01") == []
    with pytest.raises(ValueError):
        landing.landed_snapshot("2024-01", "no/checksum")
    again = landing.resumed([first.payload()], {"2024-01": "u"})
    assert again == {"2024-01": first} and landing.resumed([first.payload()], {"2024-01": "elsewhere"}) == {}


def test_fetchers(spark, tmp_path):
    import http.server
    import threading

    (tmp_path / "here").write_bytes(b"abc" * 1000)

    class Handler(http.server.SimpleHTTPRequestHandler):
        def __init__(self, *args):
            super().__init__(*args, directory=str(tmp_path))

        def log_message(self, *args):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    fetch = landing.by_scheme(spark)
    try:
        for base in (f"http://127.0.0.1:{server.server_port}", f"file://{tmp_path}", str(tmp_path)):
            found = fetch(f"{base}/here")
            assert found.status == 200 and b"".join(found.chunks) == b"abc" * 1000 and found.length in (None, 3000)
            assert fetch(f"{base}/not-here").status == 404
    finally:
        server.shutdown()


class Broken:
    """Content whose connection breaks after some chunks, some times; then it is whole."""

    def __init__(self, content, breaks):
        self.content, self.breaks, self.asked = content, breaks, 0

    def __call__(self, url):
        self.asked += 1
        if self.asked <= len(self.breaks) and isinstance(self.breaks[self.asked - 1], BaseException):
            raise self.breaks[self.asked - 1]
        return landing.Response(200, len(self.content), self._chunks(self.breaks[self.asked - 1] if self.asked <= len(self.breaks) else None))

    def _chunks(self, how):
        yield self.content[:50]
        if how == "reset":
            raise ConnectionResetError("within the content")
        if how == "incomplete":
            raise http.client.IncompleteRead(b"x")
        if how != "short":
            yield self.content[50:]


def test_broken_connections_are_tried_again(spark, tmp_path):
    content, waits = parquet(), []
    source = Broken(content, [urllib.error.URLError("no route"), TimeoutError(), "reset", "short"])
    found = landing.fetch_snapshot(spark, "2024-01", "u", str(tmp_path), source, wait=waits.append)
    assert found.bytes_received == len(content) and waits == [1.0, 2.0, 4.0, 8.0] and found.source_version > "0" * 20
    for breaks in (["incomplete"] * 9, [ConnectionRefusedError()] * 9):
        with pytest.raises((http.client.HTTPException, ConnectionError)):
            landing.fetch_snapshot(spark, "2024-02", "u", str(tmp_path), Broken(content, breaks), wait=waits.append)
    assert Files(spark).names(f"{tmp_path}/staging/source_month=2024-02") == []
    with pytest.raises(KeyError):  # what is no break of a connection is not tried again
        landing.fetched(lambda url: (_ for _ in ()).throw(KeyError()), "u", lambda r: r, wait=waits.append)


def test_retry_after():
    assert landing.asked_wait("12") == 12 and landing.asked_wait(None) is None and landing.asked_wait("soon") is None and landing.asked_wait("-3") == 0
    now = dt.datetime(2024, 1, 1, tzinfo=dt.UTC)
    assert landing.asked_wait("Mon, 01 Jan 2024 00:01:30 GMT", now) == 90
    waits, answers = [], iter([landing.Response(429, None, retry_after=30.0), landing.Response(503, None, retry_after=9999.0), landing.Response(503, None), landing.Response(200, None)])
    assert landing.fetched(lambda url: next(answers), "u", lambda r: r.status, wait=waits.append) == 200 and waits == [30.0, landing.LONGEST_WAIT, 4.0]


def test_a_server_that_drops_connections(spark, tmp_path):
    """By HTTP: the first answer asks to wait, the second breaks off within the content, the third is whole."""
    import http.server
    import threading

    content, asked, waits = parquet(), [], []

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            asked.append(1)
            if len(asked) == 1:
                self.send_response(503)
                self.send_header("Retry-After", "7")
                self.end_headers()
                return
            self.send_response(200)
            self.send_header("Content-Length", str(len(content)))
            self.end_headers()
            self.wfile.write(content if len(asked) > 2 else content[:100])

        def log_message(self, *args):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        found = landing.fetch_snapshot(spark, "2024-01", f"http://127.0.0.1:{server.server_port}/x", str(tmp_path), landing.by_scheme(spark), wait=waits.append)
    finally:
        server.shutdown()
    assert found.rows_received == 1 and waits == [7.0, 2.0] and len(asked) == 3


def test_creation_on_condition(spark, tmp_path, monkeypatch):
    """As on an object store: no rename; and a file system that can do neither is refused."""
    files = Files(spark)
    monkeypatch.setattr("tidemark.sources.files.RENAMED", {"hdfs"})
    with pytest.raises(Unsafe):
        files.create(f"{tmp_path}/a", b"1")
    monkeypatch.setattr("tidemark.sources.files.CONDITIONAL", {"file"})
    files.create(f"{tmp_path}/sub/b", b"first")
    staged = files.stage(f"{tmp_path}/sub/b", [b"second"])
    with pytest.raises(Taken):  # the other writer was past the look whether there is one
        files.settle(staged, f"{tmp_path}/sub/b")
    assert files.read(f"{tmp_path}/sub/b") == b"first" and files.names(f"{tmp_path}/sub") == ["b"]
    table = Table(spark, f"{tmp_path}/t")
    table.append(spark.range(3))
    table.append(spark.range(2))
    assert table.read().count() == 5 and landing.land(spark, [b"z"], f"{tmp_path}/z") == "landed" and landing.land(spark, [b"z"], f"{tmp_path}/z") == "already_landed"


def test_discovery_and_plan():
    candidates = landing.candidate_months(dt.date(2024, 2, 10), 3)
    assert candidates == ["2024-01", "2023-12", "2023-11"]
    assert landing.discover_latest(candidates, {"2024-01": 403, "2023-12": 200}.get) == "2023-12"
    with pytest.raises(OSError):
        landing.discover_latest(candidates, lambda m: 500)
    snap = lambda month, name: landing.Snapshot(month, name, "u", name, 1, 1)
    expected = ["2023-11", "2023-12"]
    plan = landing.plan_landing(expected, {"2023-11": snap("2023-11", "b"), "2023-12": None}, {"2023-11": "a"}, set())
    assert [s["snapshot_id"] for s in plan["snapshots"]] == ["b"] and plan["unavailable_months"] == ["2023-12"]
    same = {"2023-11": snap("2023-11", "a"), "2023-12": snap("2023-12", "c")}
    assert landing.plan_landing(expected, same, {"2023-11": "a", "2023-12": "c"}, set())["status"] == "NO_DATA"
    assert len(landing.plan_landing(expected, same, {"2023-11": "a", "2023-12": "c"}, {"2023-11"})["snapshots"]) == 1
    assert len(landing.plan_landing(expected, same, {"2023-11": "a", "2023-12": "c"}, set(), backfill=True)["snapshots"]) == 2
    for found, known in (({"2023-12": same["2023-12"]}, {}), ({"2023-11": same["2023-11"]}, {"2023-12": "c"})):
        with pytest.raises(ValueError):
            landing.plan_landing(expected, found, known, set())


def test_pages():
    events = [{"event_id": str(k), "value": k} for k in range(5)]
    seen = []
    source = pages.Simulated(events, 2, repeated=[1], timeouts=[2], reverse_even=True)
    got = pages.ingest(source, on_page=lambda p: seen.append(p.page_number))
    assert pages.same_events(got, events) and seen == [0, 1, 2]
    assert not pages.same_events(got[1:], events)
    with pytest.raises(TimeoutError):
        pages.ingest(lambda cursor: (_ for _ in ()).throw(TimeoutError()))
    with pytest.raises(ValueError):
        pages.ingest(pages.Simulated([{"value": 1}], 1))


def test_rescue(spark, tmp_path):
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.DoubleType())])
    for name, columns in {"fits": {"a": pa.array([1], pa.int32()), "b": [1.0]}, "more": {"a": pa.array([2], pa.int32()), "b": [2.0], "c": ["x"]}, "wide": {"a": pa.array([3, 1 << 40], pa.int64()), "b": [3.0, 4.0]}, "less": {"a": pa.array([5], pa.int32())}}.items():
        pq.write_table(pa.table(columns), f"{tmp_path}/{name}.parquet")
    rows = {r["b"]: (r["a"], r["_rescued_data"]) for r in rescue.read_rescued(spark, [f"{tmp_path}/{n}.parquet" for n in ("fits", "more", "wide", "less")], schema).collect()}
    assert rows == {1.0: (1, None), 2.0: (2, '{"c":"x"}'), 3.0: (3, None), 4.0: (None, '{"a":1099511627776}'), None: (5, None)}
    assert rescue.read_rescued(spark, [], schema).count() == 0


def test_stream_takes_files_once(spark, tmp_path):
    folder = f"{tmp_path}/raw/source_month=2024-01/snapshot={'a' * 64}"
    schema = T.StructType([T.StructField("x", T.LongType())])
    spark.range(3).toDF("x").write.parquet(folder)
    for _ in range(2):
        bronze.ingest(bronze.read_stream(spark, f"{tmp_path}/raw", schema), f"{tmp_path}/out", f"{tmp_path}/cp")
    found = spark.read.parquet(f"{tmp_path}/out")
    assert found.count() == 3
    row = found.first()
    assert row["source_snapshot_id"] == "a" * 64 and str(row["source_month"]) == "2024-01-01" and row["_source_file"]
    received = found.select(F.col("_source_file").alias("uri")).distinct().withColumn("rows_received", F.lit(4))
    assert bronze.complete(found, received).count() == received.count()
    spark.range(2).toDF("x").write.parquet(folder.replace("2024-01", "2024-02"))
    bronze.ingest(bronze.read_stream(spark, f"{tmp_path}/raw", schema), f"{tmp_path}/out", f"{tmp_path}/cp")
    assert spark.read.parquet(f"{tmp_path}/out").count() == 5


def test_rescued_stream_takes_a_batch_once(spark, tmp_path, monkeypatch):
    schema = T.StructType([T.StructField("x", T.LongType())])
    folder = f"{tmp_path}/raw/source_month=2024-01/snapshot={'1' * 64}"
    spark.range(3).toDF("x").write.parquet(folder)
    spark.range(2).select(F.col("id").alias("x"), F.lit("more").alias("y")).write.mode("append").parquet(folder)
    table = Table(spark, f"{tmp_path}/bronze", "source_snapshot_id")
    take = lambda: bronze.ingest_rescued(table, f"{tmp_path}/raw", f"{tmp_path}/cp", schema)
    real = Table.append

    def lost(self, *args):
        real(self, *args)
        raise ConnectionError("after the rows are in")

    with monkeypatch.context() as patch, pytest.raises(Exception, match="after the rows"):
        patch.setattr(Table, "append", lost)
        take()
    for _ in range(2):
        take()
    found = table.read()
    assert found.count() == 5 and table.read(["1" * 64]).filter(F.col("_rescued_data").isNotNull()).count() == 2
    row = found.first()
    assert row["source_snapshot_id"] == "1" * 64 and str(row["source_month"]) == "2024-01-01" and row["_source_file"].endswith(".parquet")


def test_months():
    assert months.expected_months(dt.date(2024, 2, 15), 2, 2) == [dt.date(2023, 11, 1), dt.date(2023, 12, 1)]
    assert len(months.backfill_months("2023-01", "2023-12")) == 12
    for start, end in (("2023-01", "2024-01"), ("2023-02", "2023-01"), ("2023-01", ""), ("2023-13", "2023-12"), ("x", "y")):
        with pytest.raises(ValueError):
            months.backfill_months(start, end)
    with pytest.raises(ValueError):
        months.first_of_month("2024-01-02")


ARGS = ["--environment", "dev ", "--catalog", "c", "--bucket", "bucket", "--project", "p", "--dataset", "d", "--pipeline-run-id", "r-1"]


def test_config():
    found = config.runtime([*ARGS, "--start-month", "2024-01", "--end-month", "2024-02", "--source-uri", "2024-01=a;2024-02=b", "--allow-unpublished", "true"])
    assert found["environment"] == "dev" and found["source_uris"] == {"2024-01": "a", "2024-02": "b"} and not found["allow_unpublished"]
    assert config.table_name("dev", "gold", "t", "c") == "c_dev.gold.t"
    assert config.checkpoint_path("bucket", "dev", "x") != config.schema_path("bucket", "dev", "x") != config.schema_path("bucket", "test", "x")
    for extra in (["--start-month", "2024-01"], ["--start-month", "2024-01", "--end-month", "2024-02", "--source-uri", "2024-01=a"], ["--processing-date", "x"]):
        with pytest.raises(ValueError):
            config.runtime([*ARGS, *extra])
    with pytest.raises(ValueError):
        config.identifier("a;b")


def test_guards_and_alerts():
    budget = config.Budget()
    assert "dev" in budget.plan("dev", 6, 180, True)
    for asked in (("prod", 1, 1, True), ("dev", 1, 1, False), ("dev", 7, 1, True), ("dev", 1, 181, True), ("dev", 0, 1, True)):
        with pytest.raises(PermissionError):
            budget.plan(*asked)
    assert len(budget.objections("prod", 0, 181, False)) == 4
    fires, mark = config.should_alert("dev", "K", "s", None)
    assert fires and config.should_alert("dev", "K", "s", mark) == (False, mark)


def test_monitor():
    setting = config.DEFAULTS | {"environment": "dev", "processing_date": "2024-02-15"}
    marts = [{"mart": m, "month": "2023-12-01", "rows": 1, "trips": 2} for m in "abc"]
    good = {"status": "SUCCESS", "snapshots": [{"source_month": "2023-12-01", "rows_received": 100}], "gold_metrics": marts, "serving_status": "READY_FOR_SERVING", "serving_handoff": {"exports": [1, 2, 3]}}
    monitor.check(good, setting, ["2023-11-01"], 0)
    bad = {
        "NO_DATA": ({"status": "NO_DATA"}, ["2023-12-01"], 2), "SOURCE_MISSING": ({"status": "NO_DATA"}, [], 0), "SOURCE_FRESHNESS": ({"status": "NO_DATA"}, ["2023-10-01"], 0),
        "SOURCE_COMPLETENESS": (good, [], 0), "SOURCE_ROWS": (good | {"snapshots": [{"source_month": "2023-12-01", "rows_received": 99}]}, ["2023-11-01"], 0),
        "HANDOFF": (good | {"gold_metrics": marts[:2]}, ["2023-11-01"], 0), "SERVING": (good | {"serving_metrics": [m | {"trips": 3} for m in marts]}, ["2023-11-01"], 0),
    }
    for kind, (payload, published, streak) in bad.items():
        with pytest.raises(monitor.Breach) as found:
            monitor.check(payload, setting, published, streak)
        assert found.value.kind == kind and len(found.value.fingerprint) == 64
    several = good | {"snapshots": [{"source_month": "2023-12-01", "rows_received": 99}], "gold_metrics": marts[:2]}
    with pytest.raises(monitor.Breach) as found:
        monitor.check(several, setting, [], 0)
    assert [found.value.kind, *(b.kind for b in found.value.also)] == ["SOURCE_COMPLETENESS", "SOURCE_ROWS", "HANDOFF"]
    monitor.check(good | {"serving_metrics": marts}, setting, ["2023-11-01"], 0)


def test_entry_contract(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns
    assert entry.oracle_sql().keys() <= entry.queries().keys()


def test_schemas_of_many_files(spark, tmp_path, monkeypatch):
    """Hundreds of files take a merge or two each change of types, not one each; rows are rescued as if each were read alone."""
    declared = T.StructType([T.StructField("x", T.LongType()), T.StructField("y", T.StringType())])
    for day, columns in enumerate([{"x": [1], "y": ["a"]}, {"x": [2]}, {"x": [3], "z": [7]}, {"x": ["4"], "y": ["b"]}, {"x": ["five"], "w": [1.5]}, {"x": [6], "z": ["q"]}]):
        for part in range(30):
            (tmp_path / f"d{day}").mkdir(exist_ok=True)
            pq.write_table(pa.table(columns), tmp_path / f"d{day}/part-{part:03}.parquet")
    paths = [str(p) for p in tmp_path.rglob("*.parquet")]
    merges, real = [], rescue.merged_schemas
    monkeypatch.setattr(rescue, "merged_schemas", lambda *a: merges.append(real(*a)) or merges[-1])
    found = rescue.read_rescued(spark, paths, declared, "_file")
    assert len(merges[0]) <= 16 and sorted(f for _, files in merges[0] for f in files) == sorted(paths)
    got = {(r["x"], r["y"], r["_rescued_data"]): r["n"] for r in found.groupBy("x", "y", "_rescued_data").agg(F.count("*").alias("n")).collect()}
    assert got == dict.fromkeys([(1, "a", None), (2, None, None), (3, None, '{"z":7}'), (4, "b", None), (None, None, '{"x":"five","w":1.5}'), (6, None, '{"z":"q"}')], 30)
    assert rescue.merged_schemas(spark, []) == []
    (tmp_path / "d0/broken.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception, match="(?i)footer|parquet"):
        real(spark, [*paths, str(tmp_path / "d0/broken.parquet")])


def test_the_driver_merges_few_schemas(spark, tmp_path, monkeypatch):
    """Of 1,000 files that all differ by a column, the driver asks for one schema."""
    for k in range(1000):
        pq.write_table(pa.table({"x": [k], f"extra{k % 50}": [k]}), tmp_path / f"{k:04}.parquet")
    asked = []
    reader = type(spark.read)
    real = reader.parquet
    monkeypatch.setattr(reader, "parquet", lambda self, *paths, **o: asked.append(len(paths)) or real(self, *paths, **o))
    found = rescue.read_rescued(spark, [str(p) for p in tmp_path.iterdir()], T.StructType([T.StructField("x", T.LongType())]))
    assert asked == [1000, 1000]
    assert found.count() == 1000 and found.filter(F.col("_rescued_data") == F.concat(F.lit('{"extra'), F.col("x") % 50, F.lit('":'), F.col("x"), F.lit("}"))).count() == 1000


class Pages:
    """An HTTP source whose cursors are numbers in disguise; every page fails once, and some break off."""

    def __init__(self, events, size, repeated=()):
        import http.server
        import threading

        self.events, self.size, self.asked, self.there = events, size, [], len(events)
        order = [n for n in range(-(-len(events) // size)) for _ in range(2 if n in repeated else 1)]
        outer = self

        class Handler(http.server.BaseHTTPRequestHandler):
            def do_GET(self):
                query = dict(urllib.parse.parse_qsl(urllib.parse.urlsplit(self.path).query, keep_blank_values=True))
                pages = [n for n in order if n * size < outer.there]
                if "newest" in query:
                    return self.answer({"cursor": f"c{len(pages)}"})
                at = int(query["cursor"][1:] or 0)
                outer.asked.append(at)
                if outer.asked.count(at) == 1:
                    if at % 3 == 0:
                        self.send_error(503)
                        return None
                    if at % 3 == 1:
                        self.send_response(200)
                        self.send_header("Content-Length", "500")
                        self.end_headers()
                        self.wfile.write(b'{"events": [')
                        return None
                if at >= len(pages):
                    return self.answer({"snapshot_id": "s", "page": at, "events": [], "next": None})
                found = events[pages[at] * size : min(outer.there, (pages[at] + 1) * size)]
                return self.answer({"snapshot_id": "s", "page": pages[at], "events": found[::-1] if pages[at] % 2 else found, "next": f"c{at + 1}"})

            def answer(self, document):
                body = json.dumps(document).encode()
                self.send_response(200)
                self.send_header("Content-Length", str(len(body)))
                self.end_headers()
                self.wfile.write(body)

            def log_message(self, *args):
                pass

        self.server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        threading.Thread(target=self.server.serve_forever, daemon=True).start()
        self.url = f"http://127.0.0.1:{self.server.server_port}/events"


def test_paged_source(spark, tmp_path):
    """A batch, a batch by several tasks, and a stream that is stopped and started again as the source grows: the same events."""
    events = [{"event_id": f"e{k}", "value": k} for k in range(95)]
    source = Pages(events, 10, repeated=(2, 7))
    try:
        paged.register(spark)
        read = lambda **more: spark.read.format(paged.NAME).options(url=source.url, wait="0.01", **more).load()
        batch = read().collect()
        assert len(batch) == 115 and sorted({r["event_id"] for r in batch}) == sorted(e["event_id"] for e in events)
        once = lambda frame: sorted((r["event_id"], r["event"]) for r in pages.first_seen(frame, ["event_id"], "page", "position").collect())
        want = once(read())
        assert want == sorted((e["event_id"], json.dumps(e, sort_keys=True)) for e in events)
        several = read(starts="c4,c9")
        assert several.rdd.getNumPartitions() == 3 and once(several) == want

        def run():
            stream = spark.readStream.format(paged.NAME).options(url=source.url, wait="0.01").load()
            stream.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
            return spark.read.parquet(f"{tmp_path}/out")

        source.there = 40
        assert run().count() == 50
        seen = len(source.asked)
        assert run().count() == 50 and len(source.asked) == seen  # nothing new, nothing asked for
        source.there = 80
        run()
        assert min(source.asked[seen:]) >= 5  # goes on where it ended
        source.there = 95
        assert once(run()) == want
        with pytest.raises(Exception, match="url"):
            spark.read.format(paged.NAME).load().count()
    finally:
        source.server.shutdown()


def test_paged_source_gives_up(spark):
    options = {"url": "http://127.0.0.1:9/none", "retries": "1", "wait": "0.001", "timeout": "1"}
    with pytest.raises(OSError):
        paged.asked(options["url"], options, cursor="")
    loop = iter([{"page": 0, "events": [{"event_id": "a"}], "next": "x"}, {"page": 1, "events": [], "next": "x"}])
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(paged, "asked", lambda *a, **k: next(loop))
        with pytest.raises(ValueError, match="leads back"):
            list(paged.walked(options, paged.Stretch("", None)))
        patch.setattr(paged, "asked", lambda *a, **k: {"page": 0, "events": [{"event_id": ""}], "next": None})
        with pytest.raises(ValueError, match="no event_id"):
            list(paged.walked(options, paged.Stretch("", None)))
        patch.setattr(paged, "asked", lambda *a, **k: {"page": 0, "events": [], "next": None})
        with pytest.raises(ValueError, match="no page leads"):
            list(paged.walked(options, paged.Stretch("", "z")))


def test_a_run_finds_its_month():
    there = {"2023-11": 200, "2023-12": 200, "2024-01": 404}
    setting = {"processing_date": "2024-02-10", "discover_months": 3}
    fetch = lambda url: landing.Response(there.get(url.removeprefix("u/"), 404), None)
    assert daily.newest_month(setting, fetch, lambda m: f"u/{m}") == ["2023-12"] and daily.newest_month({}, fetch, str) == []
    with pytest.raises(ValueError):
        daily.newest_month(setting, lambda url: landing.Response(404, None), str)
    assert config.runtime([*ARGS, "--discover-months", "3", "--initial-load", "true"])["initial_load"]
    with pytest.raises(ValueError):
        config.runtime([*ARGS, "--discover-months", "3", "--start-month", "2024-01", "--end-month", "2024-02"])
