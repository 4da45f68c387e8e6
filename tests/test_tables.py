"""Writes that replace, insert and publish; marts against values computed by hand."""

import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F

from tidemark.operators.quantiles import exact_quantile
from tidemark.operators.tables import Table
from tidemark.plans import marts, publish, quality, state
from tidemark.sources.files import Files, Taken

D = decimal.Decimal


def months(spark, *rows):
    return spark.createDataFrame(list(rows), "source_month string, trip_id string, amount int")


def test_snapshot_replace(spark, tmp_path):
    table = Table(spark, f"{tmp_path}/t", "source_month")
    jan, feb = "2024-01-01", "2024-02-01"
    table.overwrite(months(spark, (jan, "old", 10), (jan, "deleted", 20), (feb, "untouched", 30)))
    for _ in range(2):
        table.replace_partition(months(spark, (jan, "corrected", 15)), jan)
        assert sorted(r["amount"] for r in table.read().collect()) == [15, 30]
    with pytest.raises(ValueError):
        table.replace_partition(months(spark, (feb, "x", 1)), jan)
    table.replace_partition(months(spark, (jan, "x", 1)).limit(0), jan)
    assert [r["amount"] for r in table.read().collect()] == [30]
    table.replace_partition(table.read().withColumn("amount", F.col("amount") + 1), feb)
    assert [r["amount"] for r in table.read().collect()] == [31]
    assert table.read([jan]).count() == 0 and table.read([feb]).count() == 1
    assert [r["amount"] for r in table.read(version=1).orderBy("amount").collect()] == [10, 20, 30]


class Lost(RuntimeError):
    pass


def broken_at(monkeypatch, owner, name, nth):
    """The nth call of a function fails, after which it works again."""
    calls, real = [], getattr(owner, name)

    def call(*args, **kwargs):
        calls.append(1)
        if len(calls) == nth:
            raise Lost
        return real(*args, **kwargs)

    monkeypatch.setattr(owner, name, call)


@pytest.mark.parametrize("step", ["_written", "_next", "settle", "stage"])
def test_a_write_that_breaks_off_changes_nothing(spark, tmp_path, step):
    table = Table(spark, f"{tmp_path}/t", "source_month")
    jan, feb = "2024-01-01", "2024-02-01"
    table.overwrite(months(spark, (jan, "old", 10), (feb, "untouched", 30)))
    with pytest.MonkeyPatch.context() as patch:
        broken_at(patch, Files if step in ("settle", "stage") else Table, step, 1)
        with pytest.raises(Lost):
            table.replace_partition(months(spark, (jan, "new", 15)), jan)
    assert sorted(r["amount"] for r in table.read().collect()) == [10, 30]
    table.replace_partition(months(spark, (jan, "new", 15)), jan)
    assert sorted(r["amount"] for r in table.read().collect()) == [15, 30]
    table.vacuum(versions=1)
    assert sorted(r["amount"] for r in table.read().collect()) == [15, 30]


def test_writers_that_overtake_each_other_lose_nothing(spark, tmp_path):
    table = Table(spark, f"{tmp_path}/t")
    rows = lambda *x: spark.createDataFrame(list(x), "k int, v int")
    table.overwrite(rows((0, 0)))
    real, others = Table._next, [rows((1, 1)), rows((2, 2))]

    def overtaken(self, *args):
        if others:
            other = others.pop()
            Table(spark, self.path).append(other)
        return real(self, *args)

    for write in (lambda: table.append(rows((3, 3))), lambda: table.upsert(rows((0, 9)), ["k"]), lambda: table.insert_new(rows((2, 7), (4, 4)), ["k"])):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(Table, "_next", overtaken)
            write()
        others = [rows((len(others) + 5, 5))] if len(others) == 0 else others
    found = dict(map(tuple, table.read().collect()))
    assert found[0] == 9 and {1, 2, 3, 4} <= found.keys() and found[2] == 2


def test_a_batch_goes_in_once(spark, tmp_path):
    table = Table(spark, f"{tmp_path}/t")
    for number in (0, 0, 1, 1, 0):
        table.append(spark.range(2), ("stream", number))
    assert table.read().count() == 4


def test_insert_only_and_upsert(spark, tmp_path):
    table = Table(spark, f"{tmp_path}/t")
    rows = lambda *x: spark.createDataFrame(list(x), "k int, v int")
    table.insert_new(rows((1, 1), (1, 1)), ["k"])
    table.insert_new(rows((1, 2)), ["k"])
    assert table.read().count() == 1
    table.insert_new(rows((2, 2)), ["k"])
    table.insert_new(rows((3, 3)).limit(0), ["k"])
    assert table.read().count() == 2
    table.upsert(rows((2, 5), (4, 4)), ["k"])
    assert sorted(map(tuple, table.read().collect())) == [(1, 1), (2, 5), (4, 4)]


SILVER = "trip_id string, pickup_location_id int, rate_code_id int, payment_type_id int, pickup_at timestamp_ntz, trip_distance_mi double, fare_amount decimal(10,2), tip_amount decimal(10,2), total_amount decimal(10,2), pickup_month date"


def test_marts_of_a_month(spark, tmp_path):
    at, month = dt.datetime(2024, 1, 15, 8), dt.date(2024, 1, 1)
    fact = spark.createDataFrame([("a", 4, 1, 1, at, 5.0, D("10.00"), D("2.00"), D("15.30"), month), ("b", 4, 2, 2, at, 5.0, D("10.00"), D("2.00"), D("15.30"), month)], SILVER)
    from tidemark.operators import reference

    zones = spark.createDataFrame([(4, "M", "Z")], "location_id int, borough string, zone string")
    made = marts.build_month(fact, "2024-01-01", zones, reference.rate_codes(spark), reference.payment_types(spark))
    revenue = made["revenue_by_zone_hour"].collect()
    assert len(revenue) == 1 and revenue[0]["total_revenue"] == D("30.60") and revenue[0]["trip_count"] == 2
    fares = {r["is_flat_fare"]: r["avg_fare_per_mile"] for r in made["fare_integrity_daily"].collect()}
    assert fares == {False: 2.0, True: None}
    mix = {r["payment_type_name"]: (r["avg_tip_pct"], r["pct_of_month_trips"]) for r in made["payment_mix_monthly"].collect()}
    assert mix == {"Credit card": (0.2, 0.5), "Cash": (None, 0.5)}
    marts.reconciled(fact, made, "2024-01-01")
    with pytest.raises(ValueError):
        marts.reconciled(fact.unionByName(fact), made, "2024-01-01")
    marts.write_month(made, f"{tmp_path}/gold", "2024-01-01")
    marts.write_month({k: v.limit(0) for k, v in made.items()}, f"{tmp_path}/gold", "2024-01-01")


def test_publication(spark, tmp_path):
    frame = lambda n: spark.createDataFrame([("x", n)], "k string, trip_count long")

    def given(run, months_of_run):
        exports = [publish.export(frame(n), f"{tmp_path}/exports", "m", month, run) for month, n in months_of_run.items()]
        metrics = [{"mart": "m", "month": month, "rows": 1, "trips": n} for month, n in months_of_run.items()]
        return publish.handoff(run, exports, metrics, ["m"])

    first = given("r1", {"2024-01-01": 3, "2024-02-01": 4})
    done = publish.publish(spark, first, f"{tmp_path}/serving")
    assert publish.publish(spark, first, f"{tmp_path}/serving") == done
    publish.publish(spark, given("r2", {"2024-01-01": 5}), f"{tmp_path}/serving")
    assert sorted(r["trip_count"] for r in publish.serving(spark, f"{tmp_path}/serving", "m").collect()) == [4, 5]
    broken = given("r3", {"2024-01-01": 9})
    broken["metrics"][0]["trips"] = 8
    with pytest.raises(ValueError):
        publish.publish(spark, broken, f"{tmp_path}/serving")
    assert sorted(r["trip_count"] for r in publish.serving(spark, f"{tmp_path}/serving", "m").collect()) == [4, 5]
    with pytest.raises(ValueError):
        publish.handoff("r", first["exports"], [], ["m"])
    with pytest.raises(Exception, match="(?i)exist"):
        publish.export(frame(1), f"{tmp_path}/exports", "m", "2024-01-01", "r1")
    with pytest.raises(ValueError):
        publish.publish(spark, first | {"pipeline_run_id": "r4", "exports": first["exports"] * 2}, f"{tmp_path}/serving")
    publish.publish(spark, given("r5", {"2024-03-01": 6}), f"{tmp_path}/serving", initial=True)
    assert [r["trip_count"] for r in publish.serving(spark, f"{tmp_path}/serving", "m").collect()] == [6]
    Files(spark).create_json(f"{tmp_path}/manifest.json", {"a": 1})
    with pytest.raises(Taken):
        Files(spark).create_json(f"{tmp_path}/manifest.json", {"a": 2})
    assert Files(spark).read_json(f"{tmp_path}/manifest.json") == {"a": 1} and Files(spark).names(str(tmp_path / "none")) == []
    assert publish.serving_type("decimal(10,2)") == "NUMERIC" and publish.serving_type("timestamp_ntz") == "DATETIME"
    with pytest.raises(ValueError):
        publish.serving_type("binary")


@pytest.mark.parametrize(("owner", "step", "nth"), [(publish, "_verified", 1), (Table, "replace_partitions", 1), (Table, "replace_partitions", 2), (Table, "_next", 2), (Files, "create_json", 3), (Files, "settle", 3)])
def test_a_publication_that_breaks_off_is_not_seen(spark, tmp_path, owner, step, nth):
    """Whatever the step at which a run fails, serving shows the publication before it; the rerun publishes it."""
    frame = lambda n: spark.createDataFrame([("x", n)], "k string, trip_count long")
    folder = f"{tmp_path}/serving"

    def given(run, n):
        exports = [publish.export(frame(n), f"{tmp_path}/exports", mart, "2024-01-01", run) for mart in "ab"]
        return publish.handoff(run, exports, [{"mart": mart, "month": "2024-01-01", "rows": 1, "trips": n} for mart in "ab"], ["a", "b"])

    def served():
        return [publish.serving(spark, folder, mart).first()["trip_count"] for mart in "ab"]

    publish.publish(spark, given("r1", 1), folder)
    second = given("r2", 2)
    with pytest.MonkeyPatch.context() as patch:
        broken_at(patch, owner, step, nth)
        with pytest.raises(Lost):
            publish.publish(spark, second, folder)
    assert served() == [1, 1] and publish.receipt(spark, folder, "r2") is None
    with pytest.raises(ValueError):
        publish.reconcile(spark, second, folder)
    done = publish.publish(spark, second, folder)
    assert served() == [2, 2] and publish.publish(spark, second, folder) == done
    assert publish.reconcile(spark, second, folder) == [{"mart": mart, "month": "2024-01-01", "rows": 1, "trips": 2} for mart in "ab"]


def test_exported_months(spark, tmp_path):
    frame = spark.createDataFrame([(dt.date(2024, 1, 1), 1), (dt.date(2024, 1, 1), 2), (dt.date(2024, 2, 1), 3)], "pickup_month date, trip_count long")
    exports = publish.export_months(frame, str(tmp_path), "m", "pickup_month", "v1")
    assert [(e["month"], spark.read.parquet(e["uri"]).count()) for e in exports] == [("2024-01-01", 2), ("2024-02-01", 1)]
    wrong = publish.handoff("r", [exports[0] | {"month": "2024-03-01"}], [{"mart": "m", "month": "2024-03-01", "rows": 2, "trips": 3}], ["m"])
    with pytest.raises(ValueError, match="other months"):
        publish.publish(spark, wrong, f"{tmp_path}/serving")


def test_exact_quantiles(spark):
    import random

    draw = random.Random(3)
    rows = [("a", draw.randrange(50)) for _ in range(5000)] + [("b", draw.random()) for _ in range(20_001)] + [("c", 7.0), ("d", None), (None, 2.0), (None, 1.0)]
    frame = spark.createDataFrame([(k, None if v is None else float(v)) for k, v in rows], "k string, v double")
    for share in (0.0, 0.05, 0.5, 0.95, 1.0):
        want = {}
        for key in ("a", "b", "c", None):
            own = sorted(v for k, v in rows if k == key and v is not None)
            want[key] = own[max(0, -(-int(round(share * 100)) * len(own) // 100) - 1)]
        assert dict(map(tuple, exact_quantile(frame, ["k"], F.col("v"), share, "q").collect())) == want


def metric(**changes):
    return {"source_snapshot_id": "s", "rows_in": 100, "rows_out": 97, "rows_quarantined": 3, "raw_rows_quarantined": 3, "rows_deduplicated": 0} | changes


def test_gate(spark):
    snapshot = [{"snapshot_id": "s", "rows_received": 100}]
    quality.check(spark, [metric()], snapshot, 0.03)
    bad = [([metric()], snapshot, 0.02), ([metric()], snapshot, 2), ([], snapshot, 0.1), ([metric(rows_out=96)], snapshot, 0.1), ([metric()], [{"snapshot_id": "s", "rows_received": 99}], 0.1), ([metric(rows_out=101, rows_deduplicated=-4)], snapshot, 0.1), ([metric()] * 2, snapshot, 0.1), ([metric()], [], 0.1)]
    for metrics, snapshots, threshold in bad:
        with pytest.raises(ValueError):
            quality.check(spark, metrics, snapshots, threshold)
    assert quality.gate(spark, {"metrics": [metric(rows_in=0)], "snapshots": snapshot})["status"] == "NO_DATA"
    with pytest.raises(ValueError, match="TOO_SMALL"):
        quality.gate(spark, {"metrics": [metric()], "snapshots": snapshot}, least_rows=101)
    unknown = {"metrics": [metric()], "snapshots": [{"snapshot_id": "s", "rows_received": None}]}
    assert quality.gate(spark, unknown, least_rows=101) == unknown
    two = [metric(), metric(source_snapshot_id="t", rows_in=0)]
    with pytest.raises(ValueError, match="t: EMPTY"):
        quality.gate(spark, {"metrics": two, "snapshots": [*snapshot, {"snapshot_id": "t", "rows_received": 0}]})
    assert quality.breach_report([{"quarantine_rate": 0.2}], 0.1, "r")["status"] == "BLOCKED_BY_DQ"
    assert quality.breach_report([{"quarantine_rate": 0.1}], 0.1, "r")["required_action"] is None


def test_run_state(spark, tmp_path, monkeypatch):
    run, journal = state.RunState(spark, f"{tmp_path}/state", "r1"), Table(spark, f"{tmp_path}/journal")
    snapshots = [{"source_month": "2024-01-01", "snapshot_id": "s", "uri": "u"}]
    assert run.find("source_landing") is None
    with pytest.raises(RuntimeError):
        run.completed("source_landing")
    landed = state.run_task(run, "source_landing", None, lambda p: {"snapshots": snapshots}, journal=journal)
    assert landed["cost_context"]["task"] == "source_landing"
    with pytest.raises(RuntimeError):
        state.run_task(run, "transform_silver", "source_landing", lambda p: (_ for _ in ()).throw(RuntimeError("x" * 5000)), journal=journal)
    with pytest.raises(RuntimeError):
        run.completed("transform_silver")
    assert len(run.find("transform_silver")["error"]) == state.LONGEST_ERROR
    state.run_task(run, "transform_silver", "source_landing", lambda p: p | {"months": ["2024-01-01"], "metrics": [{"rows_in": 5, "rows_out": 4}]}, journal=journal)
    assert run.completed("transform_silver")["months"] == ["2024-01-01"]
    logged = {(r["task_name"], r["status"]): r["rows_in"] for r in journal.read().collect()}
    assert logged == {("source_landing", "SUCCESS"): 0, ("transform_silver", "FAILED"): 0, ("transform_silver", "SUCCESS"): 5}
    state.run_task(run, "dq_gate", "transform_silver", lambda p: p | {"months": []})
    with pytest.raises(RuntimeError):
        run.completed("dq_gate")
    later = state.RunState(spark, f"{tmp_path}/state", "r2")
    state.run_task(later, "source_landing", None, lambda p: {"snapshots": snapshots})
    with pytest.raises(RuntimeError):
        run.ensure_not_superseded()
    later.ensure_not_superseded()
    nothing = state.RunState(spark, f"{tmp_path}/state", "r3")
    state.run_task(nothing, "source_landing", None, lambda p: {"status": "NO_DATA"})
    assert state.run_task(nothing, "transform_silver", "source_landing", lambda p: 1 / 0)["status"] == "NO_DATA"
    for status, payload in (("DONE", {}), ("SUCCESS", {}), ("NO_DATA", {"snapshots": snapshots}), ("NO_DATA", {"reason": state.REPLAY, "metrics": [{"rows_in": 1}]})):
        with pytest.raises(ValueError):
            state.validate(status, payload)
    before = sorted(map(tuple, run.log().select("pipeline_run_id", "task_name", "status").collect()))
    monkeypatch.setattr(state.RunState, "MANY", 2)
    nothing.write("transform_silver", "FAILED", {})
    assert len(nothing.table.version().folders[""]) == 1
    after = sorted(map(tuple, run.log().select("pipeline_run_id", "task_name", "status").collect()))
    assert after == sorted([r for r in before if r[:2] != ("r3", "transform_silver")] + [("r3", "transform_silver", "FAILED")])


def test_compare_runs():
    run = {"run_id": "a", "tasks": dict.fromkeys(state.TASKS, "SUCCESS"), "metrics": [{"n": 1}], "snapshots": ["s"]}
    state.compare_runs(run, run | {"run_id": "b"})
    for change in ({}, {"run_id": "b", "tasks": {}}, {"run_id": "b", "metrics": []}, {"run_id": "b", "tasks": dict.fromkeys(state.TASKS, "FAILED")}):
        with pytest.raises(ValueError):
            state.compare_runs(run, run | change)


def test_payloads_are_variants(spark, tmp_path):
    """Stored as VARIANT or as text, a log says the same; text that is no JSON says nothing."""
    moment = dt.datetime(2024, 1, 1)
    payloads = [
        '{"snapshots":[{"source_month":"2024-01-01","snapshot_id":"a","uri":"u"},{"source_month":"2024-02-01","snapshot_id":"b"}],"error":"x \\"y\\"","cost_context":{"duration_ms":12,"environment":"dev","backfill":false}}',
        "{}", "not json", '{"snapshots":null,"metrics":[{"rows_in":1}]}', None, '{"snapshots":[]}',
    ]
    text = spark.createDataFrame([(f"r{k}", "monitor", "SUCCESS", p, moment) for k, p in enumerate(payloads)], state.SCHEMA)
    stored = Table(spark, f"{tmp_path}/log")
    stored.append(text.withColumn("payload", F.try_parse_json("payload")))
    for log in (text, stored.read()):
        told = {r["pipeline_run_id"]: r.asDict() for r in state.run_metrics(log).collect()}
        assert (told["r0"]["error"], told["r0"]["task_duration_ms"], told["r0"]["environment"], told["r0"]["is_backfill"]) == ('x "y"', "12", "dev", "false")
        assert told["r0"]["source_snapshots"].startswith('[{"') and told["r3"]["silver_metrics"] == '[{"rows_in":1}]'
        assert all(told[f"r{k}"]["error"] is None and told[f"r{k}"]["source_snapshots"] is None for k in (1, 2, 4))
        assert sorted((r["pipeline_run_id"], r["source_month"], r["snapshot_id"], r["uri"]) for r in state.snapshots_of(log).collect()) == [("r0", "2024-01-01", "a", "u"), ("r0", "2024-02-01", "b", None)]
        assert state.latest_per(log.union(log), state.SCHEMA_KEYS, "updated_at").count() == len(payloads)
        assert {r["snapshot_id"] for r in state.published(log).collect()} == {"a", "b"}
    plan = state.run_metrics(stored.read())._jdf.queryExecution().optimizedPlan().toString()
    assert "get_json_object" not in plan and "parse_json" not in plan


def test_a_partitioned_write_makes_few_files(spark, tmp_path):
    """Rows of many tasks that belong to a few partitions are gathered first."""
    table = Table(spark, f"{tmp_path}/t", "p")
    table.overwrite(spark.range(4000).repartition(16).select("id", (F.col("id") % 5).cast("string").alias("p")))
    files = [f for f in table.read().inputFiles() if f.endswith(".parquet")]
    assert len(files) <= 10 and table.read().count() == 4000 and table.read(["3"]).count() == 800


def test_receipts_read_what_was_published_since(spark, tmp_path, monkeypatch):
    """A run's receipt is looked for among the publications that were made since it first tried, not among all."""
    mart = spark.createDataFrame([(dt.date(2024, 1, 1), 5, decimal.Decimal("1.00"))], "pickup_month date, trip_count long, total_revenue decimal(20,2)")

    def given(run):
        export = publish.export(mart, f"{tmp_path}/exports", "m", "2024-01-01", run)
        return publish.handoff(run, [export], [{"mart": "m", "month": "2024-01-01", "rows": 1, "trips": 5}], ["m"])

    folder = f"{tmp_path}/serving"
    for k in range(4):
        publish.publish(spark, given(f"r{k}"), folder)
    read, real = [], Files.read_json
    monkeypatch.setattr(Files, "read_json", lambda self, path: read.append(path) or real(self, path))
    assert publish.receipt(spark, folder, "none") is None and read == []
    assert publish.receipt(spark, folder, "r3")["number"] == 4 and sum("/publications/" in p for p in read) == 1
    assert publish.receipt(spark, folder, "r0")["number"] == 1
    again = {"pipeline_run_id": "r2", "exports": [], "metrics": []}
    assert publish.publish(spark, again, folder)["number"] == 3 and len(publish.publications(spark, folder)) == 4


def test_serving_has_the_rows_of_the_exports(spark, tmp_path):
    """The same number of rows and trips is not enough."""
    def mart(*revenues):
        return spark.createDataFrame([(dt.date(2024, 1, 1), 5, decimal.Decimal(r)) for r in revenues], "pickup_month date, trip_count long, total_revenue decimal(20,2)")

    export = publish.export(mart("1.00", "2.00"), f"{tmp_path}/exports", "m", "2024-01-01", "r")
    given = publish.handoff("r", [export], [{"mart": "m", "month": "2024-01-01", "rows": 2, "trips": 10}], ["m"])
    publish.publish(spark, given, f"{tmp_path}/serving")
    assert publish.reconcile(spark, given, f"{tmp_path}/serving")[0]["trips"] == 10
    publish.export(mart("1.00", "3.00"), f"{tmp_path}/exports", "m", "2024-01-01", "r", overwrite=True)
    with pytest.raises(ValueError, match="other rows"):
        publish.reconcile(spark, given, f"{tmp_path}/serving")
