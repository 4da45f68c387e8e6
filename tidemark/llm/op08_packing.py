"""Best-fit packing by hierarchical residual packing (operator 8).

Each scan task tokenises its documents, cuts those longer than a sequence and packs the pieces best-fit, longest first.
Bins that are nearly full stay as they are.  Underfull bins climb a tree: in each round the bins of ``fan_in``
neighbouring groups are items of one best-fit packing, until one group is left.  Only bin numbers and fills move between
executors; texts and token ids never do.

Memory: a task packs at most ``block_pieces`` pieces at a time.  After a best-fit round a group holds at most one bin that is
at most half full, for two would have been merged; so the small bins that can still come to a group's bins, in all rounds
together, are counted beforehand (``room()``).  Each of them goes into one bin, so of the bins of one fill no more than
that many can ever be taken.  These climb, the rest is emitted: the result is the same as if all climbed, and a group has at
most fan_in * capacity * room() bins, whatever the lengths.

Cases: a null or empty text is a document of the end id alone; null doc_ids are kept; repeated rows are packed once each;
an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.scratch import keep, ship, ship_file
from tidemark.llm.word_tokens import WordTokenizer

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, bin long, at long, fill long"
BIN_BITS = 31


def best_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int], list[int]]:
    """Best-fit decreasing: the bin and offset of each item, and the fill of each bin.

    The open bins stand in stacks by residual; a bit mask of the residuals that have one finds the tightest in one step.
    """
    bins, offsets = [0] * len(lengths), [0] * len(lengths)
    fills: list[int] = []
    open_bins: dict[int, list[int]] = {}
    mask = 0
    for i in sorted(range(len(lengths)), key=lengths.__getitem__, reverse=True):
        need = lengths[i]
        fitting = mask >> need
        if fitting:
            residual = need + (fitting & -fitting).bit_length() - 1
            stack = open_bins[residual]
            b = stack.pop()
            if not stack:
                mask ^= 1 << residual
        else:
            b, residual = len(fills), capacity
            fills.append(0)
        bins[i], offsets[i] = b, fills[b]
        fills[b] += need
        if rest := residual - need:
            open_bins.setdefault(rest, []).append(b)
            mask |= 1 << rest
    return bins, offsets, fills


def _pieces(path: str, capacity: int, block_pieces: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = WordTokenizer.of(path)
        task, bins_before = TaskContext.get().partitionId(), 0
        rows: list[tuple] = []

        def packed() -> pa.RecordBatch:
            nonlocal bins_before
            bins, at, fills = best_fit([r[3] for r in rows], capacity)
            first = (task << BIN_BITS) + bins_before
            bins_before += len(fills)
            columns = [list(c) for c in zip(*rows, strict=True)] + [[first + b for b in bins], at, [fills[b] for b in bins]]
            rows.clear()
            kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 6]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[c.split()[0] for c in PIECES.split(", ")])

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):  # one text at a time in memory
                doc_id = doc_id.as_py()
                ids = tokenizer.encode(text.as_py() or "") + b"\0\0\0\0"
                n = len(ids) // 4
                for k, start in enumerate(range(0, n, capacity)):
                    length = min(capacity, n - start)
                    rows.append((doc_id, k, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)])))
            if len(rows) >= block_pieces:
                yield packed()
        if rows:
            yield packed()

    return run


def rounds(groups: int, fan_in: int) -> int:
    """How many rounds leave one of so many groups, at least one."""
    n = 1
    while (groups := -(-groups // fan_in)) > 1:
        n += 1
    return n


def room(fan_in: int, blocks: int, left: int) -> int:
    """The small bins that a group can meet in ``left`` rounds, in the first of which each of its parts has ``blocks`` of them."""
    return fan_in * (blocks + left - 1)


def _merge(capacity: int, most: int, full: int):
    """One group's round: where each of its bins comes to lie, and whether the merged bin climbs on, as ``most`` of each fill do."""

    def run(key, table):
        group = key[0].as_py()
        old, fill = table.column("bin").to_pylist(), table.column("fill").to_pylist()
        order = sorted(range(len(old)), key=old.__getitem__)  # the same result whatever order the shuffle brought
        bins, base, fills = best_fit([fill[i] for i in order], capacity)
        head: dict[int, int] = {}
        for i, b, o in zip(order, bins, base, strict=True):
            if o == 0:
                head[b] = old[i]
        climbs, before = [False] * len(fills), [0] * (capacity + 1)
        for b in sorted(range(len(fills)), key=head.__getitem__):
            climbs[b] = fills[b] < full and before[fills[b]] < most
            before[fills[b]] += 1
        return pa.table({
            "bin": pa.array([old[i] for i in order], pa.int64()), "new_bin": pa.array([head[b] for b in bins], pa.int64()), "base": pa.array(base, pa.int64()),
            "new_fill": pa.array([fills[b] for b in bins], pa.int64()), "grp": pa.array([group] * len(order), pa.int64()), "climbs": pa.array([climbs[b] for b in bins], pa.bool_()),
        })

    return run


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, *, slack: int = 4, fan_in: int = 16, block_pieces: int = 200_000) -> DataFrame:
    """Pieces of docs (doc_id, text) with sequence_id and offset.

    slack: a bin with at most so many free places is nearly full.  fan_in: groups that a round merges into one.
    """
    ship_file(ship(docs.sparkSession), tokenizer_path)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces = keep(source.mapInArrow(_pieces(tokenizer_path, capacity, block_pieces), PIECES), "pieces")
    moved = merged(pieces, capacity, slack=slack, fan_in=fan_in, block_pieces=block_pieces)
    placed = pieces.join(moved, "bin", "left")
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32", F.coalesce("top", "bin").alias("sequence_id"), (F.col("at") + F.coalesce("base", F.lit(0))).alias("offset")
    )


def merged(pieces: DataFrame, capacity: int, *, slack: int, fan_in: int, block_pieces: int) -> DataFrame:
    """(bin, top, base): the bins of pieces (bin, at, fill) that climbed, the bin each came to lie in, and where in it."""
    full, task = capacity - slack, F.shiftright("bin", BIN_BITS)
    last, longest = pieces.groupBy(task.alias("task")).agg(F.count("*").alias("n")).agg(F.max("task"), F.max("n")).first()
    last, blocks = last or 0, (longest or 0) // block_pieces + 1
    left = rounds(last + 1, fan_in)
    items = pieces.filter((F.col("at") == 0) & (F.col("fill") < full)).select("bin", "fill", task.alias("grp"))
    before = F.row_number().over(Window.partitionBy("grp", "fill").orderBy("bin"))
    items = items.withColumn("before", before).filter(F.col("before") <= room(fan_in, blocks, left)).drop("before")
    moved = None
    while True:
        last //= fan_in
        left -= 1
        step = keep(
            items.withColumn("grp", F.floor(F.col("grp") / fan_in).cast("long")).groupBy("grp").applyInArrow(_merge(capacity, room(fan_in, 1, left), full), "bin long, new_bin long, base long, new_fill long, grp long, climbs boolean"),
            "bins",
        )
        if moved is None:
            moved = step.select("bin", F.col("new_bin").alias("top"), "base")
        else:
            then = step.select(F.col("bin").alias("top"), F.col("new_bin").alias("next"), F.col("base").alias("more"))
            moved = keep(moved.join(then, "top", "left").select("bin", F.coalesce("next", "top").alias("top"), (F.col("base") + F.coalesce("more", F.lit(0))).alias("base")), "moved")
        if last == 0:
            return moved
        items = step.filter("climbs and base = 0").select(F.col("new_bin").alias("bin"), F.col("new_fill").alias("fill"), "grp")
