"""Layouts that let a scan skip on several columns: rows in the order of a Morton curve."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DataType, DateType, DecimalType, NumericType, StringType, TimestampNTZType, TimestampType

#: Bits of each column's rank.  With 8, a column is cut into 256 ranges of about as many rows each.
BITS = 8
#: A curve's number must stay a positive long.
MOST_BITS = 62
KEY = "__morton"


def ordinal(column: Column, kind: DataType) -> Column:
    """A number that orders the column as its own values do; of strings, their first seven bytes."""
    if isinstance(kind, (DecimalType, NumericType)):
        return column.cast("double")
    if isinstance(kind, DateType):
        return F.unix_date(column).cast("double")
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.unix_micros(column.cast("timestamp")).cast("double")
    if isinstance(kind, (StringType, BinaryType)):
        first = F.rpad(F.hex(F.substring(column.cast("binary"), 1, 7)), 14, "0")
        return F.conv(first, 16, 10).cast("double")
    raise TypeError(f"no order of {kind.simpleString()}")


def rank(value: Column, borders: Sequence[float]) -> Column:
    """How many of the sorted borders, one fewer than a power of two, are at most the value; 0 for null.  Found by halving."""
    size = (len(borders) + 1) // 2
    steps = []
    while size:
        steps.append(size)
        size //= 2
    if not steps:
        return F.lit(0).cast("long")
    listed = F.array(*map(F.lit, borders))
    start = F.lit(0).cast("long")
    return F.aggregate(F.array(*(F.lit(s).cast("long") for s in steps)), start, lambda at, step: F.when(F.element_at(listed, (at + step).cast("int")) <= value, at + step).otherwise(at))


def interleaved(ranks: Sequence[Column], bits: int) -> Column:
    """The bits of all ranks in turn, the highest first."""
    out = F.lit(0).cast("long")
    for bit in range(bits):
        for k, own in enumerate(reversed(ranks)):
            one = F.shiftright(own, bit).bitwiseAND(F.lit(1).cast("long"))
            out = out.bitwiseOR(F.shiftleft(one, bit * len(ranks) + k))
    return out


def borders_of(frame: DataFrame, columns: Sequence[str], bits: int = BITS) -> dict[str, list[float]]:
    """What cuts each column into ranges of about as many rows each: one pass, and 2 ** bits numbers a column for the driver."""
    kinds = {f.name: f.dataType for f in frame.schema}
    shares = F.array(*(F.lit(k / (1 << bits)) for k in range(1, 1 << bits)))
    found = frame.agg(*(F.percentile_approx(ordinal(F.col(c), kinds[c]), shares, 4 << bits).alias(c) for c in columns)).first()
    return {c: list(found[c] or [float("inf")] * ((1 << bits) - 1)) for c in columns}


def morton_key(frame: DataFrame, columns: Sequence[str], bits: int = BITS) -> Column:
    """A row's place on the Morton curve through the quantile ranks of its columns; equal rows are at the same place."""
    if not columns or bits < 1 or bits * len(columns) > MOST_BITS:
        raise ValueError(f"{len(columns)} columns of {bits} bits")
    kinds, borders = {f.name: f.dataType for f in frame.schema}, borders_of(frame, columns, bits)
    return interleaved([rank(ordinal(F.col(c), kinds[c]), borders[c]) for c in columns], bits)


def z_ordered(frame: DataFrame, columns: Sequence[str], files: int, bits: int = BITS) -> DataFrame:
    """The frame in so many partitions, each a stretch of the curve.  Rows at one place may fill several partitions."""
    keyed = frame.withColumn(KEY, morton_key(frame, columns, bits))
    spread = F.xxhash64(*(F.col(c) for c in frame.columns))
    return keyed.repartitionByRange(files, F.col(KEY), *columns, spread).sortWithinPartitions(KEY, *columns).drop(KEY)


def extents(stored: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(file, n, low_c, high_c, ...): what the statistics of each file of a stored frame tell a scan."""
    ends = [e for c in columns for e in (F.min(c).alias(f"low_{c}"), F.max(c).alias(f"high_{c}"))]
    return stored.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("n"), *ends)


def read_by(column: str, low: Column, high: Column) -> Column:
    """Whether a scan for values from low to below high has to read a file of extents()."""
    return (F.col(f"high_{column}") >= low) & (F.col(f"low_{column}") < high)
