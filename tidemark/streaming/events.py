"""Event time: sessions, repetitions and pairs of events in streams whose rows come late and out of order.

A watermark says how late a row may come.  State is kept until the watermark has passed it and no longer, so it grows with that
delay and not with the stream.  What comes later is dropped, and counted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

#: What Spark calls rows that came after their state was gone.
_DROPPED = "numRowsDroppedByWatermark"


def timed(events: DataFrame, moment: str, late: str) -> DataFrame:
    """Events with a watermark on a column, which becomes a timestamp with zone (streams know no other)."""
    zoned = events.withColumn(moment, F.col(moment).cast("timestamp")) if isinstance(events.schema[moment].dataType, TimestampNTZType) else events
    return zoned.withWatermark(moment, late)


def sessions(events: DataFrame, keys: Sequence[str], moment: str, gap: str, late: str, values: Mapping[str, Column]) -> DataFrame:
    """(*keys, session_start, session_end, *values): a key's events, where none is further than ``gap`` from the next.

    A stream gives a session once, when the watermark has passed its end; a batch gives all.
    """
    grouped = timed(events, moment, late).groupBy(F.session_window(moment, gap).alias("__w"), *keys)
    return grouped.agg(*(e.alias(name) for name, e in values.items())).select(*keys, F.col("__w.start").alias("session_start"), F.col("__w.end").alias("session_end"), *values)


def once(events: DataFrame, keys: Sequence[str], moment: str, late: str) -> DataFrame:
    """Each event once, if its repetitions come within ``late`` of it."""
    return timed(events, moment, late).dropDuplicatesWithinWatermark(list(keys))


def followed(first: DataFrame, then: DataFrame, keys: Sequence[str], within: str, late: str) -> DataFrame:
    """Pairs of events of the same keys, of which the second comes no earlier, and no later than ``within``, after the first.

    first: *keys, first_at and more; then: *keys, then_at and more.  Either side's state is dropped when nothing that may still
    come can be its partner.
    """
    a, b = timed(first, "first_at", late).alias("a"), timed(then, "then_at", late).alias("b")
    same = F.expr(f"then_at >= first_at AND then_at <= first_at + INTERVAL {within}")
    for k in keys:
        same = same & (F.col(f"a.{k}") == F.col(f"b.{k}"))
    return a.join(b, same).select(*(F.col(f"a.{k}").alias(k) for k in keys), *(c for c in first.columns if c not in keys), *(c for c in then.columns if c not in keys))


def run_to_end(stream: DataFrame, folder: str, checkpoint: str) -> int:
    """Appends what a stream gives to a Parquet folder until there is no more; gives the rows that came too late.

    With the same checkpoint it goes on where it ended, state included.
    """
    query = stream.writeStream.format("parquet").option("path", folder).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return sum(state.get(_DROPPED, 0) for told in query.recentProgress for state in told["stateOperators"])
