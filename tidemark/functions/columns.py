"""Small column helpers."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def column_or(df: DataFrame, name: str, otherwise: Column) -> Column:
    """The column of that name, or a stand-in where the frame has none."""
    return F.col(name) if name in df.columns else otherwise


def any_of(conditions: Iterable[Column]) -> Column:
    """The disjunction of conditions; false for none."""
    return reduce(or_, conditions, F.lit(False))


def month_of(moment: Column) -> Column:
    """The first day of the month."""
    return F.trunc(moment, "month")


def share(part: Column, whole: Column) -> Column:
    """part / whole, null where the whole is 0 or null."""
    return part / F.nullif(whole, F.lit(0))


def between_dates(moment: Column, start: str, end: str) -> Column:
    """start <= moment < end; a plain range, so that scans can skip row groups."""
    return (moment >= F.lit(start).cast("timestamp_ntz")) & (moment < F.lit(end).cast("timestamp_ntz"))
