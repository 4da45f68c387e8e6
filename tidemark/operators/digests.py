"""Whether two tables hold the same rows, by digests that do not depend on order, and where they do not."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Into how many ranges a range that differs is cut, and of how many rows one need not be cut again.
WAYS, FEW = 32, 1000
#: Rounds of cutting; each makes ranges WAYS times smaller.
ROUNDS = 12
_SUM = "decimal(38,0)"


def digest_columns(columns: Sequence[str]) -> list[Column]:
    """(n, sum_1, sum_2): a multiset of rows as its size and the sums of two hashes of each row.

    Order does not matter and repetitions count; a changed, missing or repeated row changes the sums, and two rows that swapped
    a value do, for a row is hashed whole.  Nulls are told apart from every value, by their pattern."""
    nulls = F.concat(*(F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns))
    one, two = F.xxhash64(*columns, nulls), F.xxhash64(nulls, *(F.col(c) for c in reversed(columns)), F.lit("second"))
    return [F.count("*").alias("n"), F.sum(one.cast(_SUM)).alias("sum_1"), F.sum(two.cast(_SUM)).alias("sum_2")]


def digests(df: DataFrame, by: Sequence[str | Column], columns: Sequence[str] | None = None) -> DataFrame:
    """(*by, n, sum_1, sum_2) of each group of rows."""
    return df.groupBy(*by).agg(*digest_columns(sorted(columns or df.columns)))


def unequal(a: DataFrame, b: DataFrame, by: Sequence[str]) -> DataFrame:
    """The groups (*by, n_a, n_b) whose digests are not the same in both, or that only one has."""
    left, right = (d.select(*by, F.col("n").alias(f"n_{x}"), F.struct("n", "sum_1", "sum_2").alias(f"d_{x}")) for d, x in ((a, "a"), (b, "b")))
    for k in by:
        left, right = left.withColumn(f"__{k}", F.coalesce(F.col(k).cast("string"), F.lit("\0"))), right.withColumn(f"__{k}", F.coalesce(F.col(k).cast("string"), F.lit("\0")))
    right = right.withColumnsRenamed({k: f"b_{k}" for k in by})
    both = left.join(right, [f"__{k}" for k in by], "full_outer").filter(~F.col("d_a").eqNullSafe(F.col("d_b")))
    return both.select(*(F.coalesce(k, f"b_{k}").alias(k) for k in by), F.coalesce("n_a", F.lit(0).cast("long")).alias("n_a"), F.coalesce("n_b", F.lit(0).cast("long")).alias("n_b"))


@dataclass(frozen=True)
class Span:
    """Keys from low to below high (None: no end), and how many rows either side has there."""

    low: int | None
    high: int | None
    n_a: int
    n_b: int

    def holds(self, key: Column) -> Column:
        """Null keys are below all others."""
        out = F.lit(True) if self.low is None else key >= self.low
        if self.high is not None:
            out = out & ((key < self.high) | key.isNull() if self.low is None else key < self.high)
        return F.coalesce(out, F.lit(self.low is None))


def _cut(spans: Sequence[Span], ends: tuple[int, int]) -> list[tuple[int | None, int | None]]:
    """Each range in WAYS of about the same width; what lies outside of all keys goes with the first or the last."""
    out: list[tuple[int | None, int | None]] = []
    for s in spans:
        low, high = ends[0] if s.low is None else s.low, ends[1] + 1 if s.high is None else s.high
        cuts = sorted({low + (high - low) * k // WAYS for k in range(1, WAYS)} - {low, high})
        edges = [s.low, *cuts, s.high]
        out += list(zip(edges, edges[1:], strict=False))
    return out


def differing_spans(a: DataFrame, b: DataFrame, key: str, columns: Sequence[str] | None = None, *, few: int = FEW) -> list[Span]:
    """The ranges of an integer key in which a and b do not hold the same rows, cut down until they have few rows.

    A round reads both tables within the ranges that still differ, by filters that reach their scans, and each side gives one
    row a range; rows of equal ranges never move.  Rounds are at most ROUNDS, and a range of one key is not cut further."""
    wanted = sorted(columns or a.columns)
    ends_of = [df.agg(F.min(key), F.max(key)).first() for df in (a, b)]
    known = [int(v) for r in ends_of for v in r if v is not None]
    ends = (min(known, default=0), max(known, default=0))
    spans, done = [Span(None, None, 1 << 62, 1 << 62)], []
    for _ in range(ROUNDS):
        edges = _cut(spans, ends)
        inside = F.lit(False)
        for s in spans:
            inside = inside | s.holds(F.col(key))
        starts = [ends[0] - 1 if low is None else low for low, _ in edges]
        listed = F.array(*(F.lit(x).cast("long") for x in starts))
        at = F.size(F.filter(listed, lambda x: x <= F.coalesce(F.col(key).cast("long"), F.lit(ends[0] - 1)))) - 1
        told = [digests(df.filter(inside), [at.alias("span")], wanted) for df in (a, b)]
        rows = unequal(*told, ["span"]).collect()  # one for each range that differs
        found = [Span(*edges[r["span"]], r["n_a"], r["n_b"]) for r in sorted(rows, key=lambda r: r["span"])]
        small = [s for s in found if max(s.n_a, s.n_b) <= few or (s.low is not None and s.high is not None and s.high - s.low <= 1)]
        done += small
        spans = [s for s in found if s not in small]
        if not spans:
            break
    return sorted(done + spans, key=lambda s: (s.low is not None, s.low or 0))


def row_differences(a: DataFrame, b: DataFrame, key: str, columns: Sequence[str] | None = None, *, few: int = FEW) -> DataFrame:
    """(*columns, n_a, n_b): the rows that one side has more often than the other, of any number of rows; only rows of ranges
    that differ are compared one by one."""
    wanted = list(columns or a.columns)
    inside = F.lit(False)
    for s in differing_spans(a, b, key, wanted, few=few):
        inside = inside | s.holds(F.col(key))
    sides = [df.filter(inside).groupBy(*wanted).agg(F.count("*").alias("n")).select(*wanted, *((F.col("n") if x == y else F.lit(0).cast("long")).alias(f"n_{y}") for y in "ab")) for df, x in ((a, "a"), (b, "b"))]
    both = sides[0].unionByName(sides[1]).groupBy(*wanted).agg(F.sum("n_a").alias("n_a"), F.sum("n_b").alias("n_b"))
    return both.filter("n_a <> n_b")
