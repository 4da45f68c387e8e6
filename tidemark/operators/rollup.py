"""Rollups that are corrected by what changed in their source, in place of being built anew."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.tables import CHANGE, Table, work_folder

#: The column of a rollup that counts the rows of a group; a group that has none left goes.
ROWS = "n_rows"
_SOURCE = "source"


@dataclass(frozen=True)
class Rollup:
    """Counts and sums of a table by keys, kept in a table of its own.

    keys: name and expression over the source's rows; one of them, by its name, partitions the rollup's table, and should be
    coarse.  sums: name, expression and the type that is stored, which must add and subtract exactly (decimal or integer);
    null values add nothing.  Only what can be subtracted is offered; an average is a sum over ROWS.

    The rollup's version says which version of the source it tells of, so a correction and the note that it was made are one
    write, and a refresh that broke off, or was made twice, changes nothing.
    """

    source: Table
    target: Table
    keys: Mapping[str, Column]
    sums: Mapping[str, tuple[Column, str]]

    def __post_init__(self):
        if self.target.partition not in self.keys:
            raise ValueError("a key partitions the rollup")
        if inexact := [name for name, (_, kind) in self.sums.items() if not kind.startswith(("decimal", "bigint", "int", "long"))]:
            raise ValueError(f"{', '.join(inexact)}: what is subtracted must be exact")

    def _summed(self, rows: DataFrame, sign: Column) -> DataFrame:
        values = {name: F.coalesce(F.sum(sign * value.cast(kind)), F.lit(0)).cast(kind).alias(name) for name, (value, kind) in self.sums.items()}
        return rows.groupBy(*(e.alias(k) for k, e in self.keys.items())).agg(F.sum(sign).cast("long").alias(ROWS), *values.values())

    def build(self, rows: DataFrame) -> DataFrame:
        """The rollup of a frame of source rows."""
        return self._summed(rows, F.lit(1))

    def told(self) -> int:
        """The version of the source that the rollup tells of; 0 before the first."""
        now = self.target.version()
        return now.done.get(_SOURCE, 0) if now else 0

    def refresh(self) -> list[str]:
        """Brings the rollup up to the newest version of the source; gives the partitions that were written.

        Reads the folders of the source that came or went since, and of the rollup the partitions that they touch.
        """
        newest, told = self.source.version(), self.told()
        if newest is None or newest.number == told:
            return []
        by, names = self.target.partition, [ROWS, *self.sums]
        kinds = {ROWS: "long"} | {name: kind for name, (_, kind) in self.sums.items()}
        delta = self._summed(self.source.changes(told, newest.number), F.col(CHANGE))
        moved = F.lit(False)
        for c in names:
            moved = moved | (F.col(c) != 0)
        place = work_folder(self.source.spark)
        delta.filter(moved).write.parquet(place)  # a row for each group that changed: read to know what it touches, and to add it
        changed = self.source.spark.read.schema(delta.schema).parquet(place)
        touched = [r[0] for r in changed.select(F.col(by).cast("string")).distinct().collect()]  # partitions of the rollup
        both = changed if not self.target.exists() else self.target.read(touched).select(*changed.columns).unionByName(changed)
        whole = both.groupBy(*self.keys).agg(*(F.sum(c).cast(kinds[c]).alias(c) for c in names)).filter(F.col(ROWS) != 0)
        self.target.replace_partitions(whole, touched, stream=(_SOURCE, newest.number))
        return sorted(map(str, touched))
