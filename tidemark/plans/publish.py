"""Publication of marts: exports, handoff, staged verification, and one small file that makes it visible and is its receipt."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.digests import digests, unequal
from tidemark.operators.tables import ATTEMPTS, Table
from tidemark.sources.files import Files, Taken

#: What the serving side calls Spark's types.
SERVING_TYPES = {
    "string": "STRING", "tinyint": "INTEGER", "smallint": "INTEGER", "int": "INTEGER", "bigint": "INTEGER", "float": "FLOAT", "double": "FLOAT",
    "boolean": "BOOL", "date": "DATE", "timestamp": "TIMESTAMP", "timestamp_ntz": "DATETIME",
}


def serving_type(kind: str) -> str:
    if kind.startswith("decimal"):
        return "NUMERIC"
    if kind not in SERVING_TYPES:
        raise ValueError(f"no serving type for {kind}")
    return SERVING_TYPES[kind]


def export(frame: DataFrame, folder: str, mart: str, month: str, version: str, overwrite: bool = False) -> dict:
    """Writes one month of a mart to a versioned place; an existing one is an error unless it is to be overwritten."""
    uri = f"{folder}/{version}/{mart}/month={month}"
    frame.write.mode("overwrite" if overwrite else "errorifexists").parquet(uri)
    return {"mart": mart, "month": month, "uri": uri}


def export_months(frame: DataFrame, folder: str, mart: str, month: str, version: str) -> list[dict]:
    """The same for all months of a mart, in one write."""
    place = f"{folder}/{version}/{mart}"
    frame.withColumn("month", F.col(month).cast("string")).write.partitionBy("month").parquet(place)
    names = [n for n in Files(frame.sparkSession).names(place) if n.startswith("month=")]
    return [{"mart": mart, "month": n.removeprefix("month="), "uri": f"{place}/{n}"} for n in names]


def month_metrics(frame: DataFrame, mart: str, month: str = "pickup_month") -> DataFrame:
    """(mart, month, n_rows, trips, revenue) of each month of a mart."""
    revenue = F.sum("total_revenue") if "total_revenue" in frame.columns else F.lit(None)
    grouped = frame.groupBy(F.col(month).alias("month")).agg(F.count("*").alias("n_rows"), F.sum("trip_count").alias("trips"), revenue.cast("decimal(20,2)").alias("revenue"))
    return grouped.select(F.lit(mart).alias("mart"), "month", "n_rows", "trips", "revenue")


def mismatches(expected: DataFrame, actual: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Keys that only one side has, or whose values differ."""
    a = expected.select(*keys, F.struct(*values).alias("__a"))
    b = actual.select(*keys, F.struct(*values).alias("__b"))
    return a.join(b, list(keys), "full_outer").filter(~F.col("__a").eqNullSafe(F.col("__b"))).select(*keys)


def handoff(run_id: str, exports: Sequence[Mapping], metrics: Sequence[Mapping], marts: Sequence[str]) -> dict:
    """What the serving side is given; every mart must have each month once, in exports and metrics alike."""
    def keys(rows: Sequence[Mapping]) -> list[tuple]:
        return sorted((r["mart"], r["month"]) for r in rows)

    months = {r["month"] for r in exports}
    if keys(exports) != keys(metrics) or keys(exports) != sorted((m, x) for m in marts for x in months):
        raise ValueError("exports and metrics do not correspond")
    return {"pipeline_run_id": run_id, "status": "READY_FOR_SERVING", "exports": list(exports), "metrics": list(metrics)}


_MONTH = "__month"


def publications(spark: SparkSession, folder: str) -> list[str]:
    return [f"{folder}/publications/{n}" for n in Files(spark).names(f"{folder}/publications") if n.endswith(".json") and not n.startswith(".")]


def pointer(spark: SparkSession, folder: str) -> dict | None:
    """The publication in force: its number, run, version of each mart's table, and metrics."""
    found = publications(spark, folder)
    return Files(spark).read_json(found[-1]) if found else None


def _claimed(spark: SparkSession, folder: str, run_id: str, now: Mapping | None = None) -> int | None:
    """The publication that was in force when a run first tried to publish, which its own ones are after; None if it never did.

    now: the publication in force, for a run that tries; its first try is on record from then on."""
    files, place = Files(spark), f"{folder}/claims/{hashlib.sha256(run_id.encode()).hexdigest()}.json"
    if now is not None and not files.exists(place):
        try:
            files.create_json(place, {"pipeline_run_id": run_id, "after": now["number"]})
        except Taken:
            pass  # another attempt of the run has just done so
    return files.read_json(place)["after"] if files.exists(place) else None


def receipts(spark: SparkSession, folder: str, run_id: str) -> list[dict]:
    """The publications of a run; only those are read that were made since it first tried."""
    if (after := _claimed(spark, folder, run_id)) is None:
        return []
    since = [p for p in publications(spark, folder) if int(p.rsplit("/", 1)[1].split(".")[0]) > after]
    return [d for p in since if (d := Files(spark).read_json(p))["pipeline_run_id"] == run_id]


def receipt(spark: SparkSession, folder: str, run_id: str) -> dict | None:
    """The publication of a run."""
    found = receipts(spark, folder, run_id)
    return found[-1] if found else None


def _bare(uri: str) -> str:
    """A folder without its scheme, as different spellings of one place have it in common."""
    return "/" + re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:", "", uri).strip("/")


def _staged(spark: SparkSession, months: Mapping[str, str]) -> DataFrame:
    """The exports of a mart, by month, as one frame with the month that each row was exported for."""
    frame = spark.read.parquet(*months.values())
    place = F.regexp_replace(F.regexp_replace(F.col("_metadata.file_path"), "^[A-Za-z][A-Za-z0-9+.-]*:/*", "/"), "/[^/]*$", "")
    named = F.create_map(*(F.lit(x) for month, uri in months.items() for x in (_bare(uri), month)))
    return frame.withColumn(_MONTH, F.element_at(named, place))


def _verified(spark: SparkSession, given: Mapping) -> dict[str, DataFrame]:
    """The exports of a handoff by mart, held against what was announced."""
    places: dict[str, dict[str, str]] = {}
    for e in given["exports"]:
        if e["month"] in places.setdefault(e["mart"], {}):
            raise ValueError(f"{e['mart']}: {e['month']} is given twice")
        places[e["mart"]][e["month"]] = e["uri"]
    staged = {mart: _staged(spark, months) for mart, months in places.items()}
    for mart, frame in staged.items():
        strays = F.count_if(F.col("pickup_month").cast("string") != F.col(_MONTH)) if "pickup_month" in frame.columns else F.lit(0)
        rows = frame.groupBy(_MONTH).agg(F.count("*").alias("n"), F.sum("trip_count").alias("trips"), strays.alias("strays")).collect()  # one for each month
        got = dict.fromkeys(places[mart], (0, 0)) | {r[_MONTH]: (r["n"], r["trips"]) for r in rows}
        announced = {m["month"]: (m["rows"], m["trips"]) for m in given["metrics"] if m["mart"] == mart}
        if stray := [r[_MONTH] for r in rows if r["strays"]]:
            raise ValueError(f"{mart}: rows of other months in {', '.join(stray)}")
        if got != announced:
            raise ValueError(f"{mart}: exports have {got}, {announced} were announced")
    return staged


def publish(spark: SparkSession, given: Mapping, folder: str, *, initial: bool = False) -> dict:
    """Replaces the months of a handoff in the serving tables; a first load (``initial``) replaces the tables.

    Exports are verified, and written as new versions of the marts' tables: only the months that are given.  One file, made
    last and never changed, then says which versions are in force and for which run: it is pointer and receipt at once, so a
    run that broke off anywhere before it has published nothing, and one that has it is published.  Versions build on those
    in force, not on what an unfinished publication has left.
    """
    if done := receipt(spark, folder, given["pipeline_run_id"]):
        return done
    _claimed(spark, folder, given["pipeline_run_id"], pointer(spark, folder) or {"number": 0})
    staged = _verified(spark, given)
    for _ in range(ATTEMPTS):
        now = pointer(spark, folder) or {"number": 0, "versions": {}}
        versions = {} if initial else dict(now["versions"])
        for mart, frame in sorted(staged.items()):
            base, months = 0 if initial else now["versions"].get(mart, 0), sorted(m["month"] for m in given["metrics"] if m["mart"] == mart)
            versions[mart] = Table(spark, f"{folder}/{mart}", _MONTH).replace_partitions(frame, months, base)
        done = {"number": now["number"] + 1, "pipeline_run_id": given["pipeline_run_id"], "versions": versions, "metrics": list(given["metrics"])}
        try:
            Files(spark).create_json(f"{folder}/publications/{done['number']:010d}.json", done)
        except Taken:
            continue  # another run has published in between
        return done
    raise Taken(f"{folder}: overtaken {ATTEMPTS} times")


def serving(spark: SparkSession, folder: str, mart: str) -> DataFrame:
    return _served(spark, folder, mart).drop(_MONTH)


def _served(spark: SparkSession, folder: str, mart: str, months: Sequence[str] | None = None) -> DataFrame:
    return Table(spark, f"{folder}/{mart}", _MONTH).read(months, pointer(spark, folder)["versions"][mart])


def reconcile(spark: SparkSession, given: Mapping, folder: str) -> list[dict]:
    """What serving shows of a handoff's months (mart, month, rows, trips); raises if it is not what was announced, if its rows are
    not those of the exports, by digests, or if the run is not published exactly once."""
    if len(found := receipts(spark, folder, given["pipeline_run_id"])) != 1:
        raise ValueError(f"{len(found)} receipts of run {given['pipeline_run_id']}")
    served = []
    for mart in sorted({m["mart"] for m in given["metrics"]}):
        announced = {m["month"]: (m["rows"], m["trips"]) for m in given["metrics"] if m["mart"] == mart}
        shown = _served(spark, folder, mart, [*announced])
        found = shown.groupBy(_MONTH).agg(F.count("*").alias("n"), F.sum("trip_count").alias("trips"))
        got = dict.fromkeys(announced, (0, 0)) | {r[_MONTH]: (r["n"], r["trips"]) for r in found.collect()}  # a row for each month of the handoff
        if got != announced:
            raise ValueError(f"{mart}: serving has {got}, {announced} were announced")
        if exported := {e["month"]: e["uri"] for e in given["exports"] if e["mart"] == mart}:
            staged = _staged(spark, exported)
            columns = [c for c in staged.columns if c != _MONTH]
            unlike = unequal(*(digests(frame, [_MONTH], columns) for frame in (staged, shown)), [_MONTH]).collect()  # a row for each month at most
            if unlike:
                raise ValueError(f"{mart}: serving has other rows than the exports of {', '.join(sorted(r[_MONTH] for r in unlike))}")
        served += [{"mart": mart, "month": month, "rows": n, "trips": trips} for month, (n, trips) in sorted(got.items())]
    return served
