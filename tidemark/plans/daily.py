"""The daily run: eight tasks in a chain, of which only durable state crosses from one to the next."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.months import expected_months
from tidemark.functions.trips import BRONZE_SCHEMA
from tidemark.operators import reference, silver
from tidemark.operators.clustering import z_ordered
from tidemark.operators.observed import hold_stored, watched
from tidemark.operators.tables import Table, work_folder
from tidemark.plans import marts, monitor, publish, quality, state
from tidemark.sources import landing
from tidemark.sources.files import Files
from tidemark.streaming import bronze


@dataclass(frozen=True)
class Lakehouse:
    """The folders of one environment and the tables in them."""

    spark: SparkSession
    folder: str
    config: Mapping

    def table(self, name: str, partition: str | None = None) -> Table:
        return Table(self.spark, f"{self.folder}/{name}", partition)

    @property
    def raw(self) -> str:
        return f"{self.folder}/raw"

    def dimensions(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Zones, rate codes and payment types, each of which keeps its contract."""
        age = self.config["reference_max_age_days"]
        named = [("zone", "location_id", ["borough", "zone"]), ("rate_code", "rate_code_id", ["rate_code_name", "is_flat_fare"]), ("payment_type", "payment_type_id", ["payment_type_name", "tip_is_recorded"])]
        return tuple(reference.validated(self.table(f"reference/{name}").read(), key, required, age) for name, key, required in named)

    def seed(self, zone_csv: str) -> None:
        """Loads the dimensions anew."""
        for name, frame in (("zone", reference.zones(self.spark, zone_csv)), ("rate_code", reference.rate_codes(self.spark)), ("payment_type", reference.payment_types(self.spark))):
            self.table(f"reference/{name}").overwrite(reference.stamped(frame))


def _month(text: str) -> str:
    return f"{text[:7]}-01"


SNAPSHOT_FIELDS = ["source_month", "snapshot_id", "uri", "checksum", "rows_received", "bytes_received", "source_url", "source_version"]


def newest_month(config: Mapping, fetch: Callable[[str], landing.Response], url_of: Callable[[str], str]) -> list[str]:
    """For a run that is to find out by itself (``discover_months``: how far back): the newest month that its source has."""
    if not (count := config.get("discover_months")):
        return []
    months = landing.candidate_months(dt.date.fromisoformat(config["processing_date"]), count)
    found = landing.discover_latest(months, lambda month: fetch(url_of(month)).status)  # contents are not read
    if found is None:
        raise ValueError(f"none of {months[-1]} to {months[0]} is there")
    return [found]


def source_landing(lake: Lakehouse, run: state.RunState, fetch: Callable[[str], landing.Response], url_of: Callable[[str], str], wait: Callable[[float], None]) -> dict:
    """Lands the months that are due and plans what the run has to process.

    Each landed month is in the manifest at once, so a run that is taken up again does not fetch it anew.  Months that the
    configuration gives URIs for come from there; a URI that tells a checksum is landed already.
    """
    config = lake.config
    asked = config.get("months") or newest_month(config, fetch, url_of) or [m.strftime("%Y-%m") for m in expected_months(dt.date.fromisoformat(config["processing_date"]), config["publication_lag_months"], config["late_arrival_months"])]
    log = run.log()
    published = {r["source_month"][:7]: r["snapshot_id"] for r in state.published(log).collect()}  # a row for each month
    dirty = {r["source_month"][:7] for r in state.dirty_months(log).collect()}
    uris = {m: (config.get("source_uris") or {}).get(m) or url_of(m) for m in asked}
    manifest = lake.table("reference/ingestion_manifest")
    mine = manifest.read().filter(F.col("pipeline_run_id") == run.run_id).select(*SNAPSHOT_FIELDS).collect() if manifest.exists() else []  # a row for each month
    found: dict[str, landing.Snapshot | None] = dict(landing.resumed([r.asDict() for r in mine], uris))
    for month in asked:
        if month not in found:
            given = landing.is_landed(uris[month])
            found[month] = landing.landed_snapshot(month, uris[month], _version(lake, uris[month])) if given else landing.fetch_snapshot(lake.spark, month, uris[month], lake.raw, fetch, wait=wait)
            if found[month]:
                state.write_manifest(manifest, run.run_id, [found[month].payload() | {"source_month": _month(month)}])
    plan = landing.plan_landing(asked, found, published, dirty, backfill=bool(config.get("months")))
    plan["snapshots"] = [s | {"source_month": _month(s["source_month"])} for s in plan["snapshots"]]
    return plan


def _version(lake: Lakehouse, uri: str) -> str:
    """The version of what lies there, a file or a folder of them; nothing where it cannot be told."""
    return landing.version_of(lake.spark, uri) if Files(lake.spark).exists(uri) else ""


def bronze_table(lake: Lakehouse) -> Table:
    return lake.table("bronze", "source_snapshot_id")


def bronze_ingest(lake: Lakehouse, payload: dict) -> dict:
    """Takes in new files, rescues what drifts, and makes sure that every snapshot is there in full."""
    table = bronze_table(lake)
    bronze.ingest_rescued(table, f"{lake.raw}/landed", f"{lake.folder}/checkpoints/bronze", BRONZE_SCHEMA)
    wanted = {s["snapshot_id"]: s["rows_received"] for s in payload["snapshots"]}
    rows = table.read([*wanted]).groupBy("source_snapshot_id").count().collect()
    got = {r["source_snapshot_id"]: r["count"] for r in rows}
    short = [s for s, n in wanted.items() if not got.get(s) or (n is not None and got[s] != n)]
    if short:
        raise RuntimeError(f"snapshots not taken in whole: {', '.join(short)}")
    return payload


def transform_silver(lake: Lakehouse, run_id: str, payload: dict) -> dict:
    """Replaces each snapshot's month in the clean and the quarantine table.

    Counts are taken while rows are written, and what is then stored is held against them.
    """
    lookups, metrics = silver.trip_lookups(*lake.dimensions()), []
    for snapshot in payload["snapshots"]:
        month = snapshot["source_month"]
        tags = {"pipeline_run_id": run_id, "batch_id": f"{run_id}:{month}", "_source_object_version": snapshot.get("source_version") or None}
        batch = bronze_table(lake).read([snapshot["snapshot_id"]]).withColumns({name: F.lit(tag).cast("string") for name, tag in tags.items()})
        checked_at = work_folder(lake.spark)
        classified, came = watched(silver.classify(batch, lookups), rows_in=F.count(F.lit(1)), raw_rows_quarantined=F.count("reason_code"))
        classified.write.parquet(checked_at)  # read by both that follow
        valid, others = silver.split(lake.spark.read.schema(classified.schema).parquet(checked_at))
        counted = came()
        targets = (("silver/trips_clean", "rows_out", silver.clean(valid)), ("silver/trips_quarantine", "rows_quarantined", others.withColumn("quarantined_at", F.current_timestamp())))
        for name, count, frame in targets:
            table = lake.table(name, "source_month")
            written, told = watched(frame.withColumn("source_month", F.lit(month)))
            table.replace_partition(written, month)
            counted[count] = told()["rows"]
            hold_stored(table.read([month]), "source_snapshot_id", {snapshot["snapshot_id"]: counted[count]})
        Files(lake.spark).delete(checked_at)
        counted["rows_deduplicated"] = counted["rows_in"] - counted["rows_out"] - counted["rows_quarantined"]
        metrics.append({"source_snapshot_id": snapshot["snapshot_id"], "source_month": month} | counted)
    return payload | {"metrics": metrics, "months": [s["source_month"] for s in payload["snapshots"]]}


def aggregate_gold(lake: Lakehouse, payload: dict) -> dict:
    """Rebuilds the marts of the touched months and reconciles them with silver."""
    dims, clean, gold = lake.dimensions(), lake.table("silver/trips_clean"), []
    for month in payload["months"]:
        fact = clean.read([month])
        marts.write_month(marts.build_month(fact, month, *dims), f"{lake.folder}/gold", month)
        written = {m.name: _mart(lake, m.name, month) for m in marts.MARTS}
        marts.reconciled(fact, written, month)
        for name, frame in written.items():
            n = frame.agg(F.count("*").alias("rows"), F.coalesce(F.sum("trip_count"), F.lit(0)).alias("trips")).first()
            gold.append({"mart": name, "month": month, "rows": n["rows"], "trips": n["trips"]})
    return payload | {"gold_metrics": gold}


def _mart(lake: Lakehouse, name: str, month: str) -> DataFrame:
    return lake.table(f"gold/{name}", "pickup_month").read([month])


def export(lake: Lakehouse, run_id: str, payload: dict) -> dict:
    """Exports the touched months, hands them over, publishes them and reads them back."""
    exports = [publish.export(_mart(lake, m["mart"], m["month"]), f"{lake.folder}/exports", m["mart"], m["month"], run_id, overwrite=True) for m in payload["gold_metrics"]]
    given = publish.handoff(run_id, exports, payload["gold_metrics"], [m.name for m in marts.MARTS])
    files, place = Files(lake.spark), f"{lake.folder}/handoffs/{run_id}.json"
    if not files.exists(place):
        files.create_json(place, given)
    elif files.read_json(place)["metrics"] != given["metrics"]:
        raise ValueError(f"run {run_id} has handed over something else")
    publish.publish(lake.spark, given, f"{lake.folder}/serving", initial=bool(lake.config.get("initial_load")))
    served = publish.reconcile(lake.spark, given, f"{lake.folder}/serving")
    return payload | {"serving_handoff": {"uri": place, "exports": exports}, "serving_status": given["status"], "serving_metrics": served}


def check(lake: Lakehouse, run: state.RunState, payload: dict) -> dict:
    log = run.log()
    streak = state.no_data_streak(log, lake.config["monitoring"]["max_no_data_runs"]).first()["streak"]
    monitor.check(payload, lake.config, [r["source_month"] for r in state.published(log).collect()], streak)
    return payload


#: Rows of a file that maintenance makes, versions of a table that stay readable, and hours after which a folder that no version
#: names is left by a write that broke off.
ROWS_A_FILE, VERSIONS_KEPT, ABANDONED_HOURS = 5_000_000, 10, 72
#: What is laid out how: the partitions of the run, by the columns that readers filter on.
LAYOUTS = {"bronze": ["tpep_pickup_datetime"], "silver/trips_clean": ["pickup_at", "pickup_location_id"]}


def maintain(lake: Lakehouse, payload: dict, *, rows_a_file: int = ROWS_A_FILE) -> dict[str, int]:
    """Lays out what the run has written, in files of some size in the order of a Morton curve, and deletes what no version needs;
    gives the files of each partition.  Tables keep their rows, so marts and rollups need not follow."""
    made = {}
    for name, by, values in (("bronze", "source_snapshot_id", [s["snapshot_id"] for s in payload["snapshots"]]), ("silver/trips_clean", "source_month", payload["months"])):
        table = lake.table(name, by)
        for value in values:
            files = max(1, -(-table.read([value]).count() // rows_a_file))
            if table.rewrite(lambda rows, files=files, name=name: z_ordered(rows, LAYOUTS[name], files), [value]):
                made[f"{name}/{value}"] = files
        table.vacuum(VERSIONS_KEPT, ABANDONED_HOURS)
    return made


def daily(lake: Lakehouse, fetch: Callable[[str], landing.Response] | None = None, url_of: Callable[[str], str] = str, *, wait: Callable[[float], None] = time.sleep) -> dict:
    """Runs all tasks; a run that failed is taken up by running it again under the same id.

    fetch: by the URL's scheme, where none is given.  url_of: where a month's file is, for months without a URI of their own.
    """
    config = lake.config
    run_id = config["pipeline_run_id"]
    run = state.RunState(lake.spark, f"{lake.folder}/reference/pipeline_run_state", run_id)
    limits = config["monitoring"]
    actions = {
        "source_landing": lambda p: source_landing(lake, run, fetch or landing.by_scheme(lake.spark), url_of, wait),
        "reference_preflight": lambda p: lake.dimensions() and p,
        "bronze_ingest": lambda p: bronze_ingest(lake, p),
        "transform_silver": lambda p: transform_silver(lake, run_id, p),
        "dq_gate": lambda p: quality.gate(lake.spark, p, config["quarantine_threshold"], limits["min_snapshot_rows"]),
        "aggregate_gold": lambda p: aggregate_gold(lake, p),
        "export_serving": lambda p: export(lake, run_id, p),
        "monitor": lambda p: check(lake, run, p),
    }
    done, upstream, journal = {}, None, lake.table("reference/pipeline_run_log")
    for task in state.TASKS:
        done = state.run_task(run, task, upstream, actions[task], environment=config["environment"], backfill=bool(config.get("months")), journal=journal)
        upstream = task
    if done.get("status", "SUCCESS") == "SUCCESS" and done.get("months"):
        maintain(lake, done)
    return done
