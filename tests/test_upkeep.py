"""Layouts, rollups, sketches, skew, digests and event time: what their queries do not show."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import clustering, digests, quantiles, skew
from tidemark.operators.observed import Unlike, hold_stored, watched
from tidemark.operators.rollup import ROWS, Rollup
from tidemark.operators.tables import CHANGE, Table
from tidemark.plans.catalogue_upkeep import hourly_rollup
from tidemark.streaming import events as stream

DATA = "/root/testdata/sf0.001"


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


@pytest.fixture(scope="module")
def events(spark):
    return spark.read.parquet(f"{DATA}/events.parquet").withColumn("day", F.col("ts").cast("date"))


# -- layouts ----------------------------------------------------------------------------------------------------------

def test_ranks_and_bits(spark):
    borders = [10.0, 20.0, 30.0, 40.0, 50.0, 60.0, 70.0]
    found = spark.range(0, 81).select("id", clustering.rank(F.col("id").cast("double"), borders).alias("r")).collect()
    assert all(r["r"] == sum(b <= r["id"] for b in borders) for r in found)
    assert spark.range(1).select(clustering.rank(F.lit(None).cast("double"), borders).alias("r")).first()["r"] == 0
    grid = spark.range(64).select((F.col("id") / 8).cast("long").alias("x"), (F.col("id") % 8).alias("y"))
    for r in grid.withColumn("z", clustering.interleaved([F.col("x"), F.col("y")], 3)).collect():
        assert r["z"] == sum((r["x"] >> b & 1) << 2 * b + 1 | (r["y"] >> b & 1) << 2 * b for b in range(3))


def test_orders_of_all_kinds(spark):
    values = {
        "int": [3, -5, 0, None], "string": ["b", "abc", "", None, "zz", "ab"], "date": [dt.date(2024, 1, 2), dt.date(1960, 5, 1), None],
        "timestamp_ntz": [dt.datetime(2024, 1, 2, 3), dt.datetime(1969, 1, 1), None], "double": [1.5, -2.5, None], "decimal(10,2)": [1, 7, None],
    }
    for kind, own in values.items():
        frame = spark.createDataFrame([(v,) for v in own], "x string" if kind.startswith("dec") else f"x {kind}") if not kind.startswith("dec") else spark.range(3).select(F.col("id").cast(kind).alias("x"))
        told = [r["x"] for r in frame.withColumn("o", clustering.ordinal(F.col("x"), frame.schema["x"].dataType)).orderBy(F.col("o").asc_nulls_first()).collect()]
        assert told == [r["x"] for r in frame.orderBy(F.col("x").asc_nulls_first()).collect()]
    with pytest.raises(TypeError):
        clustering.ordinal(F.col("x"), spark.range(1).select(F.array("id").alias("x")).schema["x"].dataType)
    with pytest.raises(ValueError):
        clustering.morton_key(spark.range(1), ["id"] * 8)


def test_rewrite_keeps_rows_and_yields_to_others(spark, tmp_path, monkeypatch):
    table = Table(spark, f"{tmp_path}/t", "p")
    table.overwrite(spark.range(100).select("id", (F.col("id") % 3).cast("string").alias("p"), F.when(F.col("id") % 7 > 0, F.lit("x")).alias("s")))
    before = rows(table.read())
    assert table.rewrite(lambda df: clustering.z_ordered(df, ["id", "s"], 3), ["1", "9"]) and rows(table.read()) == before
    assert table.rewrite(lambda df: df, ["9"]) is None and Table(spark, f"{tmp_path}/none").rewrite(lambda df: df) is None
    real, calls = Table._written, []

    def meddled(self, frame):
        out = real(self, frame)
        if not calls:
            calls.append(1)
            table.append(spark.createDataFrame([(1000, "1", "late")], "id long, p string, s string"))
        return out

    with monkeypatch.context() as patch:
        patch.setattr(Table, "_written", meddled)
        table.rewrite(lambda df: df.coalesce(1), ["1"])
    assert rows(table.read()) == sorted([*before, (1000, "1", "late")], key=repr)
    assert len(table.vacuum(1, hours=1)) == 0 and len(table.vacuum(1)) > 0 and table.read().count() == 101


# -- rollups ----------------------------------------------------------------------------------------------------------

def test_a_rollup_reads_what_changed(spark, tmp_path, events):
    source = Table(spark, f"{tmp_path}/events", "day")
    rollup = hourly_rollup(source, Table(spark, f"{tmp_path}/hourly", "day"))
    assert rollup.refresh() == [] and rollup.told() == 0
    source.overwrite(events.select("event_id", "ts", "event_type", "value", "day"))
    assert len(rollup.refresh()) == events.select("day").distinct().count() and rollup.refresh() == []
    day = "2024-01-05"
    corrected = source.read([day]).filter("event_id % 2 = 0").withColumn("value", F.col("value") * 2)
    source.replace_partition(corrected, day)
    delta = source.changes(rollup.told(), source.version().number)
    assert all(f"={day}/" in f for f in delta.inputFiles()) and {r[0] for r in delta.select(CHANGE).distinct().collect()} == {1, -1}
    untouched = {k: v for k, v in rollup.target.version().folders.items() if k != day}
    assert rollup.refresh() == [day]
    assert {k: v for k, v in rollup.target.version().folders.items() if k != day} == untouched
    assert rows(rollup.target.read()) == rows(rollup.build(source.read()).select(rollup.target.read().columns))
    source.rewrite(lambda df: df.repartition(3))
    assert rollup.refresh() == [] and rollup.told() == source.version().number
    source.replace_partition(source.read().limit(0), day)
    assert rollup.refresh() == [day] and rollup.target.read([day]).count() == 0


def test_a_rollup_that_breaks_off_is_made_up_for(spark, tmp_path, monkeypatch):
    source, target = Table(spark, f"{tmp_path}/s"), Table(spark, f"{tmp_path}/t", "k")
    rollup = Rollup(source, target, {"k": F.col("k")}, {"total": (F.col("x"), "bigint")})
    frame = spark.createDataFrame([("a", 1), ("a", None), ("b", 5), (None, 2)], "k string, x long")
    source.append(frame)
    with monkeypatch.context() as patch, pytest.raises(ConnectionError):
        patch.setattr(Table, "_next", lambda *a, **k: (_ for _ in ()).throw(ConnectionError()))
        rollup.refresh()
    for _ in range(2):
        rollup.refresh()
    source.append(frame.filter("k IS NULL"))
    rollup.refresh()
    assert rows(target.read().select("k", ROWS, "total")) == rows(spark.createDataFrame([("a", 2, 1), ("b", 1, 5), (None, 2, 4)], "k string, n long, t long"))
    for keys, sums in (({"x": F.col("x")}, {}), ({"k": F.col("k")}, {"y": (F.col("x"), "double")})):
        with pytest.raises(ValueError):
            Rollup(source, target, keys, sums)


# -- sketches ---------------------------------------------------------------------------------------------------------

def test_merged_quantiles_are_within_their_bound(spark):
    """Of 400,000 values in 40 parts, against the exact quantile and by rank; any part, any order, ties and nulls."""
    x = F.when(F.col("id") % 50 == 0, F.lit(None)).when(F.col("id") % 3 == 0, F.lit(7.0)).otherwise(F.pmod(F.xxhash64("id"), F.lit(1_000_003)).cast("double"))
    frame = spark.range(400_000).select((F.col("id") % 2).alias("g"), (F.col("id") % 40).alias("part"), x.alias("x"))
    stored = quantiles.quantile_sketches(frame, ["g", "part"], F.col("x"))
    merged = quantiles.merged_sketches(stored, ["g"])
    assert merged.agg(F.sum("n")).first()[0] == frame.filter("x IS NOT NULL").count()
    for share in (0.5, 0.95, 0.999):
        told = merged.select("g", quantiles.sketched_quantile(share).alias("q"))
        assert all(r["error"] <= 2 * quantiles.RANK_ERROR for r in quantiles.rank_error(frame, ["g"], F.col("x"), told, "q", share).collect())
    exact = {r["g"]: r["q"] for r in quantiles.exact_quantile(frame, ["g"], F.col("x"), 0.95, "q").collect()}
    near = {r["g"]: r["q"] for r in merged.select("g", quantiles.sketched_quantile(0.95).alias("q")).collect()}
    assert all(abs(near[g] - exact[g]) <= 0.01 * exact[g] for g in exact)
    nothing = quantiles.quantile_sketches(frame.filter("x IS NULL"), ["g", "part"], F.col("x"))
    assert quantiles.merged_sketches(nothing, ["g"]).count() == 0


# -- skew -------------------------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def skewed(spark):
    """Keys by Zipf's law, the first of which has a third of 60,000 rows; another key is null."""
    key = F.when(F.col("id") % 3 == 0, F.lit(1)).when(F.col("id") % 11 == 0, F.lit(None)).otherwise((60_000 / (F.pmod(F.xxhash64("id"), F.lit(60_000)) + 1)).cast("int"))
    return spark.range(60_000).select(F.col("id"), key.cast("long").alias("k"), F.concat(F.lit("x"), (F.col("id") % 5).cast("string")).alias("label"))


def test_heavy_keys(spark, skewed):
    found = {r["k"]: r for r in skew.heavy_keys(skewed, ["k"], 0.05).collect()}
    counts = {r["k"]: r["count"] for r in skewed.groupBy("k").count().collect()}
    assert {*found} == {k for k, n in counts.items() if n >= 3000} and {1, None} <= {*found}
    assert all(abs(found[k]["n"] - counts[k]) <= 60 and found[k]["parts"] >= counts[k] // 3000 for k in found)
    assert skew.heavy_keys(skewed.limit(0), ["k"], 0.05).count() == 0
    both = skew.heavy_keys(skewed, ["k", "label"], 0.05).collect()
    assert {(r["k"], r["label"]) for r in both} >= {(1, f"x{i}") for i in range(5)}
    for share in (0, 1.5, 0.0001):
        with pytest.raises(ValueError):
            skew.heavy_keys(skewed, ["k"], share)


def test_skew_is_dealt(spark, skewed):
    heavy = skew.heavy_keys(skewed, ["k"], 0.01).cache()
    plain = skew.task_shares(skewed, ["k"], 50).first()
    dealt = skew.task_shares(skew.salted(skewed, heavy, ["k"], ["id"]), ["k", skew._SALT], 50).first()
    assert plain["largest"] > 16 * plain["mean"] and dealt["largest"] < 4 * dealt["mean"]
    light = skew.salted(skewed, heavy, ["k"], ["id"]).join(heavy.select("k"), "k", "left_anti").filter(F.col("k").isNotNull())
    assert light.filter(F.col(skew._SALT) > 0).isEmpty()  # other keys stay whole


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skewed_join(spark, skewed, how):
    dimension = spark.createDataFrame([(1, "one"), (1, "uno"), (2, "two"), (None, "none"), (99_999, "far")], "k long, name string")
    assert rows(skew.skewed_join(skewed, dimension, ["k"], ["id"], how)) == rows(skewed.join(dimension, ["k"], how))


def test_skewed_aggregate(spark, skewed):
    found = skew.skewed_aggregate(skewed, ["k"], ["id"], {"s": F.collect_set("label"), "c": F.count("*")}, {"n": F.sum("c"), "d": F.size(F.array_distinct(F.flatten(F.collect_list("s"))))})
    assert rows(found) == rows(skewed.groupBy("k").agg(F.count("*").alias("n"), F.countDistinct("label").cast("int").alias("d")))
    with pytest.raises(ValueError):
        skew.skewed_join(skewed, skewed, ["k"], ["id"], "full_outer")


# -- digests ----------------------------------------------------------------------------------------------------------

def test_differences_are_found_without_moving_equal_ranges(spark):
    a = spark.range(50_000).select(F.col("id").alias("key"), (F.col("id") % 7).alias("x"), F.when(F.col("id") % 5 > 0, F.col("id").cast("string")).alias("s"))
    assert digests.differing_spans(a, a.repartition(7), "key") == [] and digests.row_differences(a, a.orderBy(F.desc("key")), "key").count() == 0
    changed = a.withColumn("x", F.when(F.col("key") == 31_000, F.lit(99)).otherwise(F.col("x")))
    swapped = a.withColumn("s", F.when(F.col("key") == 41, F.lit("42")).when(F.col("key") == 42, F.lit("41")).otherwise(F.col("s")))
    repeated, missing = a.union(a.filter("key = 7")), a.filter("key <> 49999")
    nulled = a.withColumn("s", F.when(F.col("key") == 3, F.lit(None)).otherwise(F.col("s")))
    for b, n in ((changed, 2), (swapped, 4), (repeated, 1), (missing, 1), (nulled, 2)):
        spans = digests.differing_spans(a, b, "key", few=100)
        assert 1 <= len(spans) <= 2 and sum(max(s.n_a, s.n_b) for s in spans) <= 200
        assert digests.row_differences(a, b, "key", few=100).count() == n
    unkeyed = a.union(spark.createDataFrame([(None, 1, "x")], "key long, x long, s string"))
    assert rows(digests.row_differences(a, unkeyed, "key")) == [(None, 1, "x", 0, 1)]
    assert rows(digests.row_differences(a.limit(0), a.filter("key < 2"), "key").select("key", "n_a", "n_b")) == [(0, 0, 1), (1, 0, 1)]


def test_digests_of_groups(spark):
    a = spark.createDataFrame([("x", 1, None), ("x", 2, "b"), ("y", 1, "a"), (None, 1, "n")], "g string, v int, s string")
    b = spark.createDataFrame([("x", 2, None), ("x", 1, "b"), ("y", 1, "a"), ("z", 1, "a")], "g string, v int, s string")
    assert rows(digests.unequal(digests.digests(a, ["g"]), digests.digests(b, ["g"]), ["g"])) == [("x", 2, 2), ("z", 0, 1), (None, 1, 0)]


# -- counts while writing ---------------------------------------------------------------------------------------------

def test_counts_are_taken_while_writing(spark, tmp_path):
    seen, told = watched(spark.range(10), rows=F.count(F.lit(1)), odd=F.count_if(F.col("id") % 2 == 1))
    seen.write.parquet(f"{tmp_path}/a")
    assert told() == {"rows": 10, "odd": 5}
    empty, none = watched(spark.range(10).filter("id > 99"))
    empty.write.parquet(f"{tmp_path}/b")
    assert none() == {"rows": 0}
    late = spark.range(10).join(spark.range(5).filter("id > 99"), "id").groupBy("id").count()  # found to be empty while it runs
    shuffled, none = watched(late.repartition("id"), n=F.count(F.lit(1)), total=F.sum("count"))
    shuffled.write.parquet(f"{tmp_path}/c")
    assert none() == {"n": 0, "total": 0}


def test_a_write_that_loses_rows_is_noticed(spark, tmp_path, monkeypatch):
    table = Table(spark, f"{tmp_path}/t", "month")
    frame = spark.createDataFrame([("s1", "m", 1), ("s1", "m", 2), ("s1", "m", 3)], "snapshot string, month string, x int").repartition(3)

    def write() -> int:
        seen, told = watched(frame)
        table.replace_partition(seen, "m")
        return told()["rows"]

    hold_stored(table.read(["m"]) if table.exists() else frame, "snapshot", {"s1": write()})
    real = Table._written
    with monkeypatch.context() as patch:
        def lossy(self, whole):
            return real(self, spark.createDataFrame([tuple(r) for r in whole.collect()][:2], whole.schema))

        patch.setattr(Table, "_written", lossy)
        n = write()
    assert n == 3
    with pytest.raises(Unlike):
        hold_stored(table.read(["m"]), "snapshot", {"s1": n})
    write()
    for wrong in ({"s2": 3}, {"s1": 2, "s2": 1}, {}):
        with pytest.raises(Unlike):
            hold_stored(table.read(["m"]), "snapshot", wrong)
    with pytest.raises(ValueError):
        table.replace_partition(frame.withColumn("month", F.lit("other")), "m")
    assert table.read().count() == 3  # the stray rows are in no version


# -- event time -------------------------------------------------------------------------------------------------------

def moments(*minutes):
    return [dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m) for m in minutes]


def test_a_stream_goes_on_where_it_ended(spark, tmp_path):
    """State outlives the run: an event that comes again in a later run is known, and one that is too late is counted."""
    schema = "id int, ts timestamp_ntz"

    def run(*batch) -> int:
        spark.createDataFrame([(i, t) for i, t in batch], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/raw")
        rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/raw")
        return stream.run_to_end(stream.once(rows, ["id"], "ts", "30 minutes"), f"{tmp_path}/out", f"{tmp_path}/checkpoint")

    a, b, c, d = moments(0, 10, 100, 105)
    assert run((1, a), (2, b), (1, a)) == 0
    assert run((2, b), (3, c)) == 0
    assert run((4, a), (5, d), (3, c)) == 1  # the first is 100 minutes behind
    assert sorted(r["id"] for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [1, 2, 3, 5]


def test_sessions_of_a_batch_are_those_of_a_stream(spark, tmp_path):
    schema = "user int, ts timestamp_ntz"
    batch = spark.createDataFrame([(1, t) for t in moments(0, 5, 30, 34, 400)] + [(2, t) for t in moments(1)], schema)
    grouped = lambda frame: stream.sessions(frame, ["user"], "ts", "10 minutes", "20 minutes", {"n": F.count("*")})
    whole = rows(grouped(batch).select("user", "n"))
    assert whole == [(1, 1), (1, 2), (1, 2), (2, 1)]
    batch.write.parquet(f"{tmp_path}/raw")
    stream.run_to_end(grouped(spark.readStream.schema(schema).parquet(f"{tmp_path}/raw")), f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    assert rows(spark.read.parquet(f"{tmp_path}/out").select("user", "n")) == [(1, 2), (1, 2), (2, 1)]  # the last may still grow
