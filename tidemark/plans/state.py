"""Durable run state: one row for each run and task, with a payload that crosses from task to task.

A payload is JSON that is parsed once, when it is written, and stored as a VARIANT; what reads a field takes its typed path.
Logs whose payload is still text are parsed once where they are read; text that is no JSON has no fields and no snapshots.
"""

from __future__ import annotations

import datetime as dt
import json
import time
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import VariantType

from tidemark.operators.tables import Table

SCHEMA = "pipeline_run_id string, task_name string, status string, payload string, updated_at timestamp"
STORED = SCHEMA.replace("payload string", "payload variant")
SCHEMA_KEYS = ("pipeline_run_id", "task_name")
LOG_SCHEMA = (
    "pipeline_run_id string, task_name string, batch_id string, source_snapshot_id string, rows_in bigint, rows_out bigint, "
    "rows_deduplicated bigint, rows_quarantined bigint, status string, started_at timestamp, ended_at timestamp"
)
#: The tasks of a run, in order, and those whose months must be those of the run's snapshots.
TASKS = ["source_landing", "reference_preflight", "bronze_ingest", "transform_silver", "dq_gate", "aggregate_gold", "export_serving", "monitor"]
MONTH_TASKS = {"transform_silver", "dq_gate", "aggregate_gold", "export_serving"}
REPLAY = "snapshot_already_processed"
LONGEST_ERROR = 4000


def _is_replay(payload: Mapping) -> bool:
    return payload.get("reason") == REPLAY


#: What must hold of the payload of each status.
CONTRACTS: dict[str, Sequence[tuple[str, Callable[[Mapping], bool]]]] = {
    "RUNNING": (),
    "FAILED": (),
    "SUCCESS": (("a success names its snapshots", lambda p: bool(p.get("snapshots"))),),
    "NO_DATA": (
        ("only a replay has snapshots without data", lambda p: _is_replay(p) or not p.get("snapshots")),
        ("a replay reads no rows", lambda p: not _is_replay(p) or sum(m.get("rows_in", 0) for m in p.get("metrics") or []) == 0),
    ),
}
#: Statuses whose payload the next task may take up.
COMPLETE = ("SUCCESS", "NO_DATA")


def validate(status: str, payload: Mapping) -> None:
    """Raises ValueError with all that a payload lacks for its status."""
    if status not in CONTRACTS:
        raise ValueError(f"unknown status {status}")
    if broken := [said for said, holds in CONTRACTS[status] if not holds(payload)]:
        raise ValueError(f"{status}: {'; '.join(broken)}")


def months_agree(payload: Mapping) -> bool:
    """Each month is that of one snapshot."""
    return sorted(payload.get("months") or []) == sorted({s["source_month"] for s in payload["snapshots"]}) and len(payload["months"]) == len(payload["snapshots"])


# -- what a state log says, as frames ---------------------------------------------------------------------------------


def latest_per(log: DataFrame, keys: Sequence[str], moment: str) -> DataFrame:
    """The latest row of each key; later payloads win ties, by their text."""
    rest = [c for c in log.columns if c not in keys]
    kinds = {f.name: f.dataType for f in log.schema}
    order = F.struct(moment, *(F.to_json(c).alias(c) if isinstance(kinds[c], VariantType) else F.col(c) for c in rest if c != moment))
    newest = log.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("__row"))
    return newest.select(*keys, *(F.col(f"__row.{c}").alias(c) for c in rest))


_SNAPSHOTS = "array<struct<source_month: string, snapshot_id: string, uri: string>>"


def payload_of(log: DataFrame) -> Column:
    """A log's payload as a VARIANT, be it stored as one or as text."""
    return F.col("payload") if isinstance(log.schema["payload"].dataType, VariantType) else F.try_parse_json("payload")


def snapshots_of(log: DataFrame) -> DataFrame:
    """Each snapshot of each row's payload."""
    listed = F.try_variant_get(payload_of(log), "$.snapshots", _SNAPSHOTS)
    return log.withColumn("__s", F.explode(listed)).select("pipeline_run_id", "task_name", "status", "updated_at", "__s.*")


def published(log: DataFrame) -> DataFrame:
    """(source_month, snapshot_id, updated_at): what each month was last published from."""
    done = log.filter((F.col("task_name") == "monitor") & (F.col("status") == "SUCCESS"))
    return latest_per(snapshots_of(done).select("source_month", "updated_at", "snapshot_id"), ["source_month"], "updated_at")


def dirty_months(log: DataFrame) -> DataFrame:
    """(source_month): months that were landed after they were last published, or never published."""
    landed = snapshots_of(log.filter((F.col("task_name") == "source_landing") & (F.col("status") == "SUCCESS"))).groupBy("source_month").agg(F.max("updated_at").alias("landed_at"))
    out = published(log).select("source_month", F.col("updated_at").alias("published_at"))
    both = landed.join(out, "source_month", "left")
    return both.filter(F.col("published_at").isNull() | (F.col("landed_at") > F.col("published_at"))).select("source_month")


def changed_plan(candidates: DataFrame, published_snapshots: DataFrame, dirty: DataFrame, backfill: bool = False) -> DataFrame:
    """Candidates (source_month, snapshot_id) with action: process what is new, changed or dirty, skip the rest."""
    known = published_snapshots.select("source_month", F.col("snapshot_id").alias("__known"))
    marked = candidates.join(known, "source_month", "left").join(dirty.select("source_month", F.lit(True).alias("__dirty")), "source_month", "left")
    work = F.lit(backfill) | F.col("__known").isNull() | (F.col("__known") != F.col("snapshot_id")) | F.coalesce(F.col("__dirty"), F.lit(False))
    return marked.select("source_month", "snapshot_id", F.when(work, "process").otherwise("skip").alias("action"))


def superseded(log: DataFrame) -> DataFrame:
    """(pipeline_run_id): runs whose landing shares a month with a later landing."""
    plans = snapshots_of(log.filter((F.col("task_name") == "source_landing") & (F.col("status") == "SUCCESS"))).select("pipeline_run_id", "source_month", "updated_at")
    newest = plans.groupBy("source_month").agg(F.max("updated_at").alias("__newest"))
    return plans.join(newest, "source_month").filter(F.col("updated_at") < F.col("__newest")).select("pipeline_run_id").distinct()


def no_data_streak(log: DataFrame, runs: int) -> DataFrame:
    """(streak): how many of the newest ``runs`` landings in a row had no data."""
    recent = log.filter((F.col("task_name") == "source_landing") & F.col("status").isin("SUCCESS", "NO_DATA")).orderBy(F.col("updated_at").desc()).limit(runs)
    breaks = F.sum(F.when(F.col("status") != "NO_DATA", 1).otherwise(0)).over(Window.orderBy(F.col("updated_at").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return recent.withColumn("__breaks", breaks).agg(F.count_if(F.col("__breaks") == 0).alias("streak"))


def freshness(log: DataFrame, now: Column, hours: int = 26) -> DataFrame:
    """(freshness_status): whether a source check ended within the last hours."""
    ended = log.filter((F.col("task_name") == "source_landing") & F.col("status").isin("SUCCESS", "NO_DATA")).agg(F.max("updated_at").alias("last"))
    late = F.col("last").isNull() | (F.col("last") < now - F.expr(f"INTERVAL {hours} HOURS"))
    return ended.select(F.when(late, "ALERT: no completed source check").otherwise("OK").alias("freshness_status"))


def run_metrics(log: DataFrame) -> DataFrame:
    """What a dashboard shows of each task."""
    paths = {
        "error": "error", "source_snapshots": "snapshots", "silver_metrics": "metrics", "gold_metrics": "gold_metrics", "serving_metrics": "serving_metrics",
        "unavailable_months": "unavailable_months", "task_duration_ms": "cost_context.duration_ms", "environment": "cost_context.environment", "is_backfill": "cost_context.backfill",
    }
    named = log.select("pipeline_run_id", "task_name", "status", "updated_at", payload_of(log).alias("__payload"))
    fields = [F.try_variant_get("__payload", f"$.{path}", "string").alias(name) for name, path in paths.items()]
    return named.select("pipeline_run_id", "task_name", "status", "updated_at", *fields).orderBy(F.col("updated_at").desc())


# -- the store and the tasks that use it ------------------------------------------------------------------------------


class RunState:
    """The state of a pipeline, seen by one run: a table to which statuses are only added; the last of a task counts.

    Adding needs no look at what others add, so runs that overlap lose nothing.
    """

    #: Folders of the table before it is rewritten as one.
    MANY = 200

    def __init__(self, spark: SparkSession, folder: str, run_id: str):
        self.spark, self.run_id, self.table = spark, run_id, Table(spark, folder)

    def log(self) -> DataFrame:
        """The last status of each task of each run."""
        return latest_per(self.table.read(), ["pipeline_run_id", "task_name"], "updated_at") if self.table.exists() else self.spark.createDataFrame([], STORED)

    def write(self, task: str, status: str, payload: Mapping) -> None:
        validate(status, payload)
        row = self.spark.createDataFrame([(self.run_id, task, status, json.dumps(payload, sort_keys=True), dt.datetime.now(dt.UTC))], SCHEMA).withColumn("payload", F.parse_json("payload"))
        now = self.table.version()
        if now and sum(map(len, now.folders.values())) >= self.MANY:
            self.table.upsert(self.log().unionByName(row).coalesce(1), [*SCHEMA_KEYS, "updated_at"])
        else:
            self.table.append(row)

    def find(self, task: str) -> dict | None:
        """The payload of a task of this run, with its status."""
        rows = self.log().filter((F.col("pipeline_run_id") == self.run_id) & (F.col("task_name") == task)).select("status", F.to_json("payload").alias("payload")).limit(2).collect()
        if len(rows) > 1:
            raise RuntimeError(f"two states of {task} in run {self.run_id}")
        return json.loads(rows[0]["payload"]) | {"status": rows[0]["status"]} if rows else None

    def completed(self, task: str) -> dict:
        """The same, of a task that must be done and in order."""
        found = self.find(task)
        if found is None or found["status"] not in COMPLETE:
            raise RuntimeError(f"{task} of run {self.run_id} is {found['status'] if found else 'not there'}")
        validate(found["status"], found)
        if task in MONTH_TASKS and found["status"] == "SUCCESS" and not months_agree(found):
            raise RuntimeError(f"{task}: months and snapshots differ")
        return found

    def ensure_not_superseded(self) -> None:
        if not superseded(self.log()).filter(F.col("pipeline_run_id") == self.run_id).isEmpty():
            raise RuntimeError(f"run {self.run_id} is superseded by a later landing")


class Task:
    """One task of a run, as a context: it takes up what its upstream left, and whatever happens inside becomes its status.

    given: the upstream's payload.  idle: there is nothing to do, as the upstream had no data.  finish(): the task's own payload.
    """

    def __init__(self, run: RunState, name: str, upstream: str | None, *, environment: str = "dev", backfill: bool = False, journal: Table | None = None):
        self.run, self.name, self.upstream, self.journal = run, name, upstream, journal
        self.context = {"environment": environment, "task": name, "backfill": backfill}
        self.given: dict = {}
        self.payload: dict = {}

    def __enter__(self) -> Task:
        self.began, self.clock = dt.datetime.now(dt.UTC), time.monotonic()
        self.given = self.payload = self.run.completed(self.upstream) if self.upstream else {}
        self.idle = self.given.get("status") == "NO_DATA"
        if not self.idle:
            if self.upstream:
                self.run.ensure_not_superseded()
            self.run.write(self.name, "RUNNING", self.given)
        return self

    def finish(self, payload: Mapping) -> None:
        self.payload = dict(payload)

    def __exit__(self, kind, error, trace) -> None:
        status = "FAILED" if error else "NO_DATA" if self.idle else self.payload.get("status", "SUCCESS")
        told = {"error": str(error)[:LONGEST_ERROR]} if error else {}
        self.payload = (self.given if error else self.payload) | told | {"cost_context": self.context | {"duration_ms": round(1000 * (time.monotonic() - self.clock))}}
        self.run.write(self.name, status, self.payload)
        if self.journal is not None:
            log_run(self.journal, journal_row(self, status))


def run_task(run: RunState, name: str, upstream: str | None, action: Callable[[dict], dict], **settings) -> dict:
    """A task that is one function of its upstream's payload."""
    with Task(run, name, upstream, **settings) as task:
        if not task.idle:
            task.finish(action(task.given))
    return task.payload


def journal_row(task: Task, status: str) -> tuple:
    """What the run log says of a task: how many rows its payload tells of."""
    counts = {c: sum(m.get(c, 0) for m in task.payload.get("metrics") or []) for c in ("rows_in", "rows_out", "rows_deduplicated", "rows_quarantined")}
    snapshots = ",".join(s["snapshot_id"] for s in task.payload.get("snapshots") or [])
    return (task.run.run_id, task.name, f"{task.run.run_id}:{task.name}", snapshots, *counts.values(), status, task.began, dt.datetime.now(dt.UTC))


def log_run(table: Table, row: Sequence) -> None:
    """Appends a row of LOG_SCHEMA."""
    table.append(table.spark.createDataFrame([tuple(row)], LOG_SCHEMA))


def compare_runs(first: dict, second: dict) -> None:
    """Raises unless two runs, each with all of its tasks, gave the same.

    Each run: run_id, tasks (name to status), metrics and snapshots.
    """
    if first["run_id"] == second["run_id"]:
        raise ValueError("a run cannot be its own replay")
    for run in (first, second):
        if {*run["tasks"]} != {*TASKS}:
            raise ValueError(f"run {run['run_id']} does not have all tasks")
        if any(status != "SUCCESS" for status in run["tasks"].values()):
            raise ValueError(f"run {run['run_id']} did not succeed")
    for part in ("metrics", "snapshots"):
        if sorted(map(repr, first[part])) != sorted(map(repr, second[part])):
            raise ValueError(f"the runs differ in {part}")


# -- the manifest of landed snapshots ---------------------------------------------------------------------------------

MANIFEST_SCHEMA = (
    "pipeline_run_id string, source_month string, snapshot_id string, uri string, checksum string, rows_received bigint, "
    "bytes_received bigint, source_url string, source_version string, idempotency_key string, landed_at timestamp"
)


def write_manifest(table: Table, run_id: str, snapshots: Sequence[dict], dataset: str = "trips", system: str = "source") -> None:
    """One row for each run, snapshot and checksum; landing again changes it in place."""
    from tidemark.functions.identity import object_key

    rows = [
        (run_id, s["source_month"], s["snapshot_id"], s["uri"], s["checksum"], s["rows_received"], s["bytes_received"], s["source_url"], s["source_version"],
         object_key(system, dataset, s["snapshot_id"], s["uri"], s["checksum"]), dt.datetime.now(dt.UTC))
        for s in snapshots
    ]
    if rows:
        table.upsert(table.spark.createDataFrame(rows, MANIFEST_SCHEMA), ["pipeline_run_id", "snapshot_id", "checksum"])
