"""Sharding by jump consistent hashing (operator 1).

A key and the number of shards decide the shard; with one shard more, rows only move into the new one, a share of
1 / shards of them.  There is no ring table and no state: each row's shard is an expression of its key.

The recurrence multiplies 64-bit integers that wrap; ANSI arithmetic does not, so products are made of 16- and 32-bit
halves.  Slots number the rows of a shard: rows are dealt out by shard and by ``lanes`` lanes, numbered in their lane, and
each lane starts where the lanes before it end, so no shard is gathered in one task.  A row's lane follows from its id and
the checksum of its text together: ids that stand in strides, or null ids, are spread by their texts, and copies by their ids.

Cases: a null key counts as 0; a null text has no bytes (size 1, checksum 0); repeated rows get slots of their own; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed values of the method: the multiplier of its generator, in halves of 32 bits, and its number of random bits.
MULTIPLIER_HIGH, MULTIPLIER_LOW = divmod(2862933555777941757, 1 << 32)
RANDOM_BITS = 31
LOW_16, LOW_32 = (1 << 16) - 1, (1 << 32) - 1
#: A row jumps as often as its generator says, about the logarithm of the shards; more jumps than these raise an error.
MOST_JUMPS = 128


def _next_key(high: Column, low: Column) -> tuple[Column, Column]:
    """key * multiplier + 1 modulo 2 ** 64, as halves."""
    c_high, c_low = F.lit(MULTIPLIER_HIGH), F.lit(MULTIPLIER_LOW)
    first, second = low.bitwiseAND(LOW_16) * c_low, F.shiftright(low, 16) * c_low
    sum_low = first.bitwiseAND(LOW_32) + F.shiftleft(second.bitwiseAND(LOW_16), 16) + F.lit(1).cast("long")
    cross = F.shiftleft((F.shiftright(high, 16) * c_low).bitwiseAND(LOW_16), 16) + (high.bitwiseAND(LOW_16) * c_low)
    upper = F.shiftright(first, 32) + F.shiftright(second, 16) + F.shiftright(sum_low, 32) + (low * c_high).bitwiseAND(LOW_32) + cross.bitwiseAND(LOW_32)
    return upper.bitwiseAND(LOW_32), sum_low.bitwiseAND(LOW_32)


def jump_hash(key: Column, shards: int) -> Column:
    """A struct: shard, of ``shards``; grown, the shard of ``shards + 1``.  key: long."""
    if shards < 1:
        raise ValueError("shards must be at least 1")
    key = F.coalesce(key.cast("long"), F.lit(0).cast("long"))
    start = F.struct(
        F.shiftright(key, 32).bitwiseAND(LOW_32).alias("high"), key.bitwiseAND(LOW_32).alias("low"), F.lit(0).cast("long").alias("at"), F.lit(0).cast("long").alias("next")
    )

    def jump(state: Column, _: Column) -> Column:
        high, low = _next_key(state["high"], state["low"])
        draw = F.shiftright(high, 1) + F.lit(1)
        following = F.floor((state["next"] + 1).cast("double") * (F.lit(float(1 << RANDOM_BITS)) / draw.cast("double"))).cast("long")
        return F.when(state["next"] >= shards, state).otherwise(F.struct(high.alias("high"), low.alias("low"), state["next"].alias("at"), following.alias("next")))

    def told(state: Column) -> Column:
        shard = F.when(state["next"] >= shards, state["at"]).otherwise(F.raise_error(F.lit(f"more than {MOST_JUMPS} jumps")).cast("long"))
        return F.struct(shard.cast("int").alias("shard"), F.when(state["next"] == shards, F.lit(shards)).otherwise(shard).cast("int").alias("grown"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(min(shards, MOST_JUMPS))), start, jump, told)


def shard(docs: DataFrame, shards: int = 16, *, lanes: int = 1024) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, text_shard) for docs (doc_id, text).

    text_shard: the shard by the checksum of the text in place of doc_id, where equal texts stand together.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = F.col("doc_id").cast("long")
    lane = F.pmod(F.pmod(F.coalesce(key, F.lit(0)), F.lit(lanes)) + F.pmod(F.crc32(text), F.lit(lanes)), F.lit(lanes)).cast("int")
    keyed = docs.select(key.alias("doc_id"), jump_hash(key, shards).alias("jump"), lane.alias("lane"))
    # how many rows each lane has; the counts are shards * lanes rows at most
    counts = keyed.groupBy(F.col("jump.shard").alias("shard"), "lane").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("lane").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")
    starts = counts.select("shard", "lane", before.alias("first"))
    sized = docs.select(
        key.alias("doc_id"), (F.octet_length(text) + F.lit(1)).cast("long").alias("size"), F.crc32(text).cast("long").alias("text_crc32"),
        F.lit("key").alias("law"), jump_hash(key, shards).alias("jump"), lane.alias("lane"), jump_hash(F.crc32(text), shards)["shard"].alias("text_shard"),
    )
    flat = sized.select("doc_id", "size", "text_crc32", "law", F.col("jump.shard").alias("shard"), F.col("jump.grown").alias("grown_shard"), "lane", "text_shard")
    place = F.row_number().over(Window.partitionBy("shard", "lane").orderBy("doc_id", "size", "text_crc32"))
    numbered = flat.withColumn("place", place).join(starts, ["shard", "lane"])
    return numbered.select("doc_id", "size", "text_crc32", "law", "shard", (F.col("first") + F.col("place") - 1).cast("long").alias("slot"), "grown_shard", "text_shard")


def checksum_table() -> list[int]:
    """What CRC-32 does to each byte, by its rule: eight shifts, with the polynomial where a one falls out."""
    out = []
    for value in range(256):
        for _ in range(8):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        out.append(value)
    return out


def reference_sql(shards: int = 16, lanes: int = 1024) -> str:
    """The same for DuckDB: checksums byte by byte, and a recursive query whose steps are the jumps."""
    table = f"[{', '.join(map(str, checksum_table()))}]::BIGINT[]"
    every = 4294967295
    return f"""
WITH RECURSIVE bytes AS (
    SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size,
           list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT) AS b FROM documents),
summed AS (
    SELECT doc_id, size, xor(list_reduce(list_prepend({every}::BIGINT, b), lambda c, x: xor(c >> 8, ({table})[xor(c & 255, x) + 1])), {every}) AS crc FROM bytes),
jumps(doc_id, kind, key, here, following) AS (
    SELECT doc_id, kind, (CASE WHEN kind = 0 THEN doc_id ELSE crc END)::UHUGEINT, 0::BIGINT, 0::BIGINT FROM summed, (VALUES (0), (1)) AS kinds(kind)
    UNION ALL
    SELECT doc_id, kind, drawn, following, floor((following + 1)::DOUBLE * ({1 << RANDOM_BITS}::DOUBLE / ((drawn >> 33) + 1)::DOUBLE))::BIGINT
    FROM (SELECT *, (key * {(MULTIPLIER_HIGH << 32) + MULTIPLIER_LOW}::UHUGEINT + 1::UHUGEINT) % 18446744073709551616::UHUGEINT AS drawn FROM jumps WHERE following < {shards})),
landed AS (SELECT doc_id, kind, here AS shard, CASE WHEN following = {shards} THEN {shards} ELSE here END AS grown FROM jumps WHERE following >= {shards})
SELECT s.doc_id, s.size::BIGINT AS size, s.crc AS text_crc32, 'key' AS law, a.shard::INTEGER AS shard,
       row_number() OVER (PARTITION BY a.shard ORDER BY (s.doc_id % {lanes} + s.crc % {lanes}) % {lanes}, s.doc_id) - 1 AS slot, a.grown::INTEGER AS grown_shard, b.shard::INTEGER AS text_shard
FROM summed s JOIN landed a ON s.doc_id = a.doc_id AND a.kind = 0 JOIN landed b ON s.doc_id = b.doc_id AND b.kind = 1
"""
