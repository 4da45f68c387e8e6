"""Exact quantiles of groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: An approximate quantile's rank is off by a share of 1 / ACCURACY at most; the bracket is ten times as wide on either side.
ACCURACY = 10_000


def exact_quantile(df: DataFrame, keys: Sequence[str], value: Column, share: float, name: str) -> DataFrame:
    """(*keys, name): the least value of each group such that at least ``share`` of the group's values are no larger.

    Two approximate quantiles bracket it.  Values below the bracket are only counted; those inside, about a five-hundredth of a
    group, are ranked.  Null values do not count, and a group without others has no row.
    """
    rows = df.select(*keys, value.alias("__x")).filter(F.col("__x").isNotNull())
    margin, named = 10 / ACCURACY, [f"__k{i}" for i in range(len(keys))]
    ends = F.percentile_approx("__x", F.array(F.lit(max(0.0, share - margin)), F.lit(min(1.0, share + margin))), ACCURACY)
    brackets = rows.groupBy(*keys).agg(ends.alias("__ends"), F.count("*").alias("__n")).withColumnsRenamed(dict(zip(keys, named, strict=True)))
    same = F.lit(True)
    for k, n in zip(keys, named, strict=True):
        same = same & F.col(k).eqNullSafe(F.col(n))
    low, high = F.col("__ends")[0], F.col("__ends")[1]
    near = rows.join(brackets, same).filter(F.col("__x") <= high)
    # all that is below the bracket becomes one row, the first of its group
    counted = near.groupBy(*keys, F.when(F.col("__x") >= low, F.col("__x")).alias("__x")).agg(F.count("*").alias("__c"), F.max("__n").alias("__n"))
    reached = F.sum("__c").over(Window.partitionBy(*keys).orderBy(F.col("__x").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    enough = counted.withColumn("__reached", reached).filter(F.col("__x").isNotNull() & (F.col("__reached") >= F.ceil(F.lit(share) * F.col("__n"))))
    return enough.groupBy(*keys).agg(F.min("__x").alias(name))


# -- quantiles of ranges, from sketches of their parts -----------------------------------------------------------------

#: Items of a KLL sketch.  A quantile's rank is off by less than RANK_ERROR of the rows, in 99 of 100 sketches.
ITEMS, RANK_ERROR = 2000, 0.0015


def quantile_sketches(df: DataFrame, keys: Sequence[str | Column], value: Column, *, items: int = ITEMS) -> DataFrame:
    """(*keys, sketch, n): a sketch of each group's values, some kilobytes at any size of the group.

    Sketches of parts (a day of a group) are stored once and merged for any range; null values do not count.
    """
    number = value.cast("double")
    return df.groupBy(*keys).agg(F.kll_sketch_agg_double(number, items).alias("sketch"), F.count(number).alias("n"))


def merged_sketches(sketches: DataFrame, keys: Sequence[str | Column], *, items: int = ITEMS) -> DataFrame:
    """The sketches of larger groups, from those of their parts: (*keys, sketch, n)."""
    filled = sketches.filter(F.col("n") > 0)
    return filled.groupBy(*keys).agg(F.kll_merge_agg_double("sketch", items).alias("sketch"), F.sum("n").alias("n"))


def sketched_quantile(share: float) -> Column:
    """The quantile that the column ``sketch`` tells of; null where the sketch has no value."""
    return F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(share)))


def rank_error(df: DataFrame, keys: Sequence[str], value: Column, estimates: DataFrame, name: str, share: float) -> DataFrame:
    """(*keys, n, error): how far the rank of an estimate (*keys, name) is from ``share``, as a share of the group's values.

    An estimate that some values equal has all of their ranks, of which the nearest counts.
    """
    rows = df.select(*keys, value.cast("double").alias("__x")).filter(F.col("__x").isNotNull())
    ranked = rows.join(estimates.select(*keys, name), list(keys)).groupBy(*keys).agg(
        F.count("*").alias("n"), F.count_if(F.col("__x") < F.col(name)).alias("__below"), F.count_if(F.col("__x") <= F.col(name)).alias("__up_to")
    )
    low, high = F.col("__below") / F.col("n"), F.col("__up_to") / F.col("n")
    return ranked.select(*keys, "n", F.greatest(low - share, share - high, F.lit(0.0)).alias("error"))
