"""Keys that hold very many rows: found by one pass, and only they are dealt into shares."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Keys that a pass keeps count of; a key with more than a share of 1 / TRACKED of the rows is among them.
TRACKED = 10_000
#: How many of the commonest keys are looked at.
FIRST = 200
_SALT = "__salt"


def heavy_keys(df: DataFrame, keys: Sequence[str], share: float, *, first: int = FIRST, tracked: int = TRACKED) -> DataFrame:
    """(*keys, n, parts): the keys that hold at least that share of the rows, about how many rows, and how many shares of that
    size these make.

    One pass with a sketch of bounded size finds them; there can be 1 / share of them at most, so the result is small however
    many rows there are.  Counts are estimates and decide on the layout alone, never on a result.
    """
    if not 0 < share <= 1 or 1 / share > first:
        raise ValueError(f"a share of {share} can have more than {first} keys")
    # a struct's fields are not told apart by the sketch: its text is, and nulls are kept apart from texts
    named = F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})
    found = df.agg(F.call_function("approx_top_k", named, F.lit(first), F.lit(tracked)).alias("top"), F.count("*").alias("total"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keys).schema)
    rows = found.select(F.explode("top").alias("top"), "total").filter(F.col("top.count") >= share * F.col("total"))
    parts = F.ceil(F.col("top.count") / (share * F.col("total"))).cast("int")
    return rows.select(F.from_json("top.item", kinds).alias("k"), F.col("top.count").alias("n"), parts.alias("parts")).select("k.*", "n", "parts")


def _same(keys: Sequence[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & F.col(k).eqNullSafe(F.col(f"__hot_{k}"))
    return out


def _marked(df: DataFrame, heavy: DataFrame, keys: Sequence[str]) -> DataFrame:
    """df with __parts: into how many shares a row's key is dealt, 1 for most.  heavy has at most FIRST rows, which are broadcast."""
    hot = heavy.limit(FIRST).select(*(F.col(k).alias(f"__hot_{k}") for k in keys), F.col("parts").alias("__parts"))
    return df.join(F.broadcast(hot), _same(keys), "left").withColumn("__parts", F.coalesce("__parts", F.lit(1))).drop(*(f"__hot_{k}" for k in keys))


def salted(df: DataFrame, heavy: DataFrame, keys: Sequence[str], salt_by: Sequence[str]) -> DataFrame:
    """df with a salt: 0, but for rows of heavy keys, which are dealt into as many shares as these need."""
    salt = F.when(F.col("__parts") > 1, F.pmod(F.xxhash64(*salt_by), F.col("__parts"))).otherwise(0).cast("int")
    return _marked(df, heavy, keys).withColumn(_SALT, salt).drop("__parts")


def skewed_aggregate(df: DataFrame, keys: Sequence[str], salt_by: Sequence[str], partial: Mapping[str, Column], final: Mapping[str, Column], *, share: float = 0.02, heavy: DataFrame | None = None) -> DataFrame:
    """An aggregation in two steps, of which the first deals the rows of heavy keys into shares.

    partial: aggregates by name; final: aggregates of those.  For sums and counts Spark's own partial aggregation does as much;
    this is for what that does not shorten, such as collected sets and lists, distinct counts, and windows over a group.
    """
    found = heavy_keys(df, keys, share) if heavy is None else heavy
    first = salted(df, found, keys, salt_by).groupBy(*keys, _SALT).agg(*(e.alias(name) for name, e in partial.items()))
    return first.groupBy(*keys).agg(*(e.alias(name) for name, e in final.items()))


def skewed_join(fact: DataFrame, dimension: DataFrame, keys: Sequence[str], salt_by: Sequence[str], how: str = "inner", *, share: float = 0.02, heavy: DataFrame | None = None) -> DataFrame:
    """fact join dimension on keys of the same names; rows of heavy keys are dealt, and the dimension's rows of these are repeated
    for each share, so that no task is given all rows of a key.  For inner, left, left_semi and left_anti joins.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"{how}: the dimension's rows are repeated, so rows that only it has would be too")
    found = heavy_keys(fact, keys, share) if heavy is None else heavy
    dealt = salted(fact, found, keys, salt_by)
    repeated = _marked(dimension, found, keys).withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.col("__parts") - 1))).drop("__parts")
    return dealt.join(repeated, [*keys, _SALT], how).drop(_SALT)


def task_shares(df: DataFrame, by: Sequence[str], partitions: int) -> DataFrame:
    """(largest, mean): rows of the largest of so many hash partitions, and of the mean one."""
    placed = df.groupBy(F.pmod(F.hash(*by), F.lit(partitions)).alias("p")).agg(F.count("*").alias("n"))
    return placed.agg(F.max("n").alias("largest"), (F.sum("n") / partitions).alias("mean"))


