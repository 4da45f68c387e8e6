"""Exact dedup by an extendible-hash index on shared files (operator 3).

Entries: each row's key is the 64-bit hash of its text; with the text's SHA-256 it is written once to a narrow table in the
shared folder.  Equal keys collapse to one key before anything is dealt out, so a group of copies of any size is one key.

Directory: it is addressed by the leading bits of the key.  While an address has more than ``capacity`` keys, the directory
doubles, which splits the overfull buckets by one more bit; addresses whose bucket needs fewer bits (its local depth) share
it.  The doubling ends, for keys are distinct.

Index: each key has a chain of links, one for each different text with that hash.  Keys that occur once have one link, known
from their entry.  The texts of the others are compared by their bytes, by grouping on them; only these texts move, once for
each task that holds one, and how many there are makes no difference to how they move.  The links go to the owners of
buckets: a task owns a contiguous range of buckets and writes their chains in order to the shared folder.

Look-up: a bit map of bounded size tells which rows cannot have a repeated key; these are answered where they stand.  The
others find their bucket in the directory, and in it their chain and link.

Cases: a null text counts as empty.  Of equal texts the row with the largest doc_id stays; a null doc_id is smaller than any
other.  Of rows that tie on doc_id and text one has kept true.  An empty table gives no rows; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.scratch import keep, likely

KEY_BITS = 64
#: By how many doublings the keys are counted ahead.
AHEAD = 6


def prefix(key: Column, depth: Column | int) -> Column:
    """The leading bits of a 64-bit key."""
    return F.call_function("shiftrightunsigned", F.call_function("shiftrightunsigned", key, F.lit(1)), 63 - F.lit(depth) if isinstance(depth, int) else F.lit(63) - depth)


def directory(keys: DataFrame, capacity: int) -> tuple[DataFrame, int]:
    """(address, local_depth, bucket) for each address that has keys, and the global depth; keys has one row for each key (h).

    A bucket is named by its prefix, shifted to the left end of the address, so buckets are ranges of keys in order.
    """
    depth = max(0, math.ceil(math.log2(max(keys.count(), 1) / capacity)))
    while True:
        # keys are counted some bits deeper, once; what a directory of fewer bits has is folded from that
        deep = min(depth + AHEAD, KEY_BITS - 1)
        counted = keep(keys.groupBy(prefix(F.col("h"), deep).alias("address")).agg(F.count("*").alias("n")), "histogram")
        while True:
            histogram = counted.groupBy(F.expr(f"shiftright(address, {deep - depth})").alias("address")).agg(F.sum("n").alias("n"))
            fits = histogram.filter(F.col("n") > capacity).isEmpty()
            if fits or depth == deep:
                break
            depth += 1  # doubling
        if fits or depth == KEY_BITS - 1:
            break
        depth += 1
    histogram = keep(histogram, "histogram")
    levels = histogram.select("address", "n", F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("level"))
    levels = levels.withColumn("bucket", F.expr(f"shiftleft(shiftright(address, {depth} - level), {depth} - level)"))
    sizes = levels.groupBy("level", "bucket").agg(F.sum("n").alias("size"))
    fitting = levels.join(sizes, ["level", "bucket"]).filter((F.col("size") <= capacity) | (F.col("level") == depth))
    leaf = F.min(F.struct("level", "bucket"))
    found = fitting.groupBy("address").agg(leaf.alias("leaf")).select("address", F.col("leaf.level").alias("local_depth"), F.col("leaf.bucket").alias("bucket"))
    return keep(found, "directory"), depth


def placed(rows: DataFrame, addresses: DataFrame, depth: int) -> DataFrame:
    """rows (h, ...) with the bucket of each."""
    return rows.withColumn("address", prefix(F.col("h"), depth)).join(addresses.select("address", "bucket"), "address").drop("address")


def index(links: DataFrame, addresses: DataFrame, depth: int) -> DataFrame:
    """The bucket pages (bucket, h, place, link, size, keep_id, top_row), in shared files: place is that in the key's chain."""
    owned = placed(links, addresses, depth).repartitionByRange("bucket", "h")
    chained = owned.withColumn("place", F.row_number().over(Window.partitionBy("bucket", "h").orderBy("link")))
    return keep(chained.sortWithinPartitions("bucket", "h", "place").select("bucket", "h", "place", "link", "size", "keep_id", "top_row"), "index")


def deduplicate(docs: DataFrame, *, normalise=None, capacity: int = 65_536) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row of docs (doc_id, text).

    normalise: a function from a text column to the column whose equality counts; none leaves texts as they are.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (normalise(text) if normalise else text).alias("text"))
    sha = F.unhex(F.sha2("text", 256))
    entries = keep(source.select("doc_id", F.xxhash64("text").alias("h"), sha.alias("sha"), F.monotonically_increasing_id().alias("row")), "entries")
    first = F.max(F.struct("doc_id", "row"))
    keys = keep(entries.groupBy("h").agg(F.count("*").alias("n"), first.alias("top"), F.min("sha").alias("sha")), "keys")
    repeated = keep(keys.filter("n > 1").select("h"), "repeated")
    flagged = likely(entries, F.col("h"), repeated, "again")
    again = keep(flagged.filter("again").drop("again"), "again")
    # the links of keys that occur once, and those of the others, which are told apart by the bytes of their texts
    once = keys.filter("n = 1").select("h", F.col("sha").alias("link"), F.lit(1).cast("long").alias("size"), F.col("top.doc_id").alias("keep_id"), F.col("top.row").alias("top_row"))
    held = likely(source.withColumn("h", F.xxhash64("text")), F.col("h"), repeated, "again").filter("again").select("h", "text")
    compared = held.groupBy("h", "text").agg(F.count("*").alias("size")).select("h", sha.alias("link"), "size").join(repeated, "h")
    tops = again.groupBy("h", F.col("sha").alias("link")).agg(first.alias("top"))
    several = compared.join(tops, ["h", "link"]).select("h", "link", "size", F.col("top.doc_id").alias("keep_id"), F.col("top.row").alias("top_row"))
    addresses, depth = directory(keys, capacity)
    pages = index(once.unionByName(several), addresses, depth)
    looked_up = placed(again.withColumnRenamed("sha", "link"), addresses, depth).join(pages, ["bucket", "h", "link"])
    digest = F.lower(F.hex("sha")).alias("text_sha256")
    found = looked_up.select("doc_id", "keep_id", F.col("size").alias("group_size"), F.coalesce(F.col("row") == F.col("top_row"), F.lit(False)).alias("kept"), F.lower(F.hex("link")).alias("text_sha256"))
    alone = flagged.filter("not again").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), digest)
    return alone.unionByName(found)
