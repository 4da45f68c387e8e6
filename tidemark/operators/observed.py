"""Counts of a frame, taken while it is written: no pass of their own."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def watched(frame: DataFrame, **counts: Column) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """The frame, and what its counts were in the first action on it; that action must read all of it.

    counts: aggregates by name; without any, the number of rows.  A frame that the optimiser finds to be empty tells zeros.
    """
    observation = Observation(f"tidemark-{uuid.uuid4().hex}")
    named = counts or {"rows": F.count(F.lit(1))}
    seen = frame.observe(observation, *(e.alias(name) for name, e in named.items()))

    def told() -> dict[str, int]:
        # where a frame turns out to be empty, the optimiser drops what observes it, and there is no row of counts
        found = observation._jo.getRow()
        return dict.fromkeys(named, 0) if found.schema() is None else {name: value or 0 for name, value in observation.get.items()}

    return seen, told


class Unlike(RuntimeError):
    """What is stored is not what was written."""


def hold_stored(stored: DataFrame, by: str, expected: dict) -> None:
    """Raises unless a stored frame has exactly these numbers of rows for each value of a column; reads that column alone."""
    got = {r[0]: r["count"] for r in stored.groupBy(by).count().collect()}  # a row for each value, of which a part has few
    wanted = {k: n for k, n in expected.items() if n}
    if got != wanted:
        raise Unlike(f"stored by {by}: {got}, written: {wanted}")
