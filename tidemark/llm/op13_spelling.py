"""Spelling variants by a self-join of vocabulary tries with active-node sets (operator 13).

Words are counted over whole texts.  Two words are near if one inserted, deleted or replaced code point turns one into the
other; a word's form is its most frequent near word, if that is so much more frequent that the word may be a slip of it.

Parts: if words of L and of L or L + 1 code points are near, then for any cut p they have the first p code points in common, or
the last L - p.  So each word goes to the parts of its own length and of the one below, by prefix and by suffix.  A part of
very many words is cut again within what it leaves open, until one code point is open; such a part has no more words than the
alphabet has pairs of letters, so no task is given an unbounded one, and no pair is lost.

Join: the words of a task's parts make tries, from their beginnings where the prefix is common, from their ends otherwise.
The tries are walked level by level, all at once.  A node's active nodes are those whose strings are at most one edit from its
own: itself; its siblings, for a replaced code point; its children, for an inserted one; and the children, under the same
code point, of those that its parent had one edit away.  Two words that end at nodes one edit apart are near.

Cases: a null or empty text has no words.  Null doc_ids count as the empty string in the hash; repeated rows count each.  Ties
of the most frequent near word go to the smallest in the order of code points.  Words may be of any length.  An empty table
gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.scratch import discard, keep, keep_once, likely, ship

#: Runs of letters, and how a run is made to have slips: every 31st loses a code point.
RUN, SLIP = r"[A-Za-zÀ-ÿ]", 31
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
#: Distinct words that a scan task holds before it tells their counts.
HELD = 200_000
#: Words of parts that are joined at a time; a part with more of them is cut again.
AT_A_TIME = 100_000


def runs_of(doc_id: int | None, text: str, least: int) -> list[str]:
    """The words of a text that have at least so many code points, slips made."""
    out, salt = [], zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run in re.findall(RUN + f"{{{least},}}", text):
        word = run.lower() if run.isascii() else run.translate(LOWER)
        h = zlib.crc32(word.encode(), salt)
        if not h % SLIP:
            at = h % len(word)
            word = word[:at] + word[at + 1 :]
            if len(word) < least:
                continue
        out.append(word)
    return out


def _counted(least: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}

        def told() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(counts, pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])
            counts.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                for word in runs_of(doc_id.as_py(), text.as_py() or "", least):
                    counts[word] = counts.get(word, 0) + 1
                if len(counts) >= HELD:
                    yield told()
        yield told()

    return run


def vocabulary(docs: DataFrame, *, least_length: int = 7, least_n: int = 2) -> DataFrame:
    """(word, n): the words of whole texts and how often they occur."""
    ship(docs.sparkSession)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(_counted(least_length), "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_n)


def part_key(word: str, length: int, low: int, high: int) -> int:
    """The part of a word among words of length or length + 1 of which all but low to high, counted in the shorter, is common."""
    known = f"{length},{low},{high},{word[:low]},{word[len(word) - (length - high) :]}"
    return xxhash.xxh64_intdigest(known.encode()) - (1 << 63)


PARTS = "key long, word string, n long, length int, low int, high int"
_PARTS = pa.schema([("key", pa.int64()), ("word", pa.string()), ("n", pa.int64()), *((c, pa.int32()) for c in ("length", "low", "high"))])


def _told(rows: list[tuple[str, int, int, int, int]]) -> pa.RecordBatch:
    """Rows (word, n, length, low, high) with the keys of their parts."""
    columns = list(zip(*rows, strict=True)) if rows else [()] * 5
    keys = [part_key(w, length, low, high) for w, _, length, low, high in rows]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip([keys, *columns], _PARTS, strict=True)], schema=_PARTS)


def _parts(least: int):
    """The parts of words (word, n): two of their own length, two of the one below."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for length in (len(word), len(word) - 1):
                    if length >= least:
                        half = (length + 1) // 2
                        rows += [(word, n, length, half, length), (word, n, length, 0, half)]
            yield _told(rows)

    return run


def _finer(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row of a part (word, n, length, low, high) in the two parts that leave half as much open."""
    for batch in batches:
        rows = []
        for word, n, length, low, high in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            middle = (low + high) // 2
            rows += [(word, n, length, middle, high), (word, n, length, low, middle)]
        yield _told(rows)


def near_pairs(part: np.ndarray, words: list[str], backwards: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which words i, j of one part are one edit apart; the shorter first, else the one that stands first.

    part: the number of each word's part, whose words differ.  backwards: whether to walk a word's part from the ends."""
    spelt = [w[::-1] if back else w for w, back in zip(words, backwards.tolist(), strict=True)]
    sizes = np.fromiter(map(len, spelt), np.int64, len(spelt))
    letters = np.frombuffer("".join(spelt).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    begin = np.cumsum(sizes) - sizes
    none = np.zeros(0, np.int64)

    # tries: a level's nodes are numbered in the order of (parent, code point); keys[d] are these, ends[d] the word that ends there
    keys, ends, node, alive = [none], [np.full(int(part.max(initial=-1)) + 1, -1)], part.astype(np.int64), np.arange(len(words))
    depth = 0
    while len(alive := alive[sizes[alive] > depth]):
        level, at = np.unique(node[alive] << 21 | letters[begin[alive] + depth], return_inverse=True)
        node[alive] = at
        depth += 1
        over = alive[sizes[alive] == depth]
        end = np.full(len(level), -1)
        end[node[over]] = over
        keys.append(level)
        ends.append(end)
    keys += [none, none]
    ends += [none, none]

    def below(level: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The children of nodes x, as (row of x, child); level: the keys of the next level."""
        first = np.searchsorted(level, x << 21)
        n = np.searchsorted(level, (x + 1) << 21) - first
        back = np.cumsum(n) - n
        row = np.repeat(np.arange(len(x)), n)
        return row, first[row] + np.arange(len(row)) - back[row]

    def under(level: np.ndarray, x: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """The child of each x under that code point, or -1."""
        if not len(level):
            return np.full(len(x), -1)
        want = x << 21 | letter
        at = np.minimum(np.searchsorted(level, want), len(level) - 1)
        return np.where(level[at] == want, at, -1)

    def once(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        found = np.unique(np.stack([x, y], axis=1), axis=0) if len(x) else np.zeros((0, 2), np.int64)
        return found[:, 0], found[:, 1]

    left, right = [none], [none]

    def ended(x: np.ndarray, y: np.ndarray, x_depth: int, y_depth: int) -> None:
        a, b = ends[x_depth][x], ends[y_depth][y]
        both = (a >= 0) & (b >= 0)
        left.append(a[both])
        right.append(b[both])

    replaced, inserted = (none, none), (none, none)  # active pairs, of one level, and of a level and the next
    for d in range(depth + 1):
        level, following = keys[d + 1], keys[d + 2] if d + 2 < len(keys) else none
        # nodes that were one edit apart stay so under the same code point
        row, child = below(level, replaced[0])
        other = under(level, replaced[1][row], level[child] & 0x1FFFFF)
        kept = other >= 0
        # siblings: a replaced code point
        parents = np.unique(level >> 21)
        first, n = np.searchsorted(level, parents << 21), np.searchsorted(level, (parents + 1) << 21)
        many = np.repeat(n, n - first) - np.arange(len(level)) - 1
        ahead = np.repeat(np.arange(len(level)), many)
        behind = ahead + 1 + np.arange(len(ahead)) - np.repeat(np.cumsum(many) - many, many)
        deeper = once(np.concatenate([child[kept], ahead]), np.concatenate([other[kept], behind]))
        ended(*deeper, d + 1, d + 1)
        # children: an inserted code point
        now = once(np.concatenate([inserted[0], level >> 21]), np.concatenate([inserted[1], np.arange(len(level))]))
        ended(*now, d, d + 1)
        row, child = below(level, now[0])
        other = under(following, now[1][row], level[child] & 0x1FFFFF)
        kept = other >= 0
        replaced, inserted = deeper, (child[kept], other[kept])
    i, j = np.concatenate(left), np.concatenate(right)
    swap = (sizes[i] == sizes[j]) & (i > j)
    return np.where(swap, j, i), np.where(swap, i, j)


NEAR = "a string, a_n long, b string, b_n long"


def _near(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reads rows of parts, sorted by key; gives near words of the part's length, or that and the next."""

    def joined(table: pa.Table) -> Iterator[pa.RecordBatch]:
        key, n, length, low, high = (table.column(c).to_numpy() for c in ("key", "n", "length", "low", "high"))
        same = key[1:] == key[:-1]
        rows = np.flatnonzero(np.append(same, False) | np.concatenate(([False], same)))
        words = table.column("word").take(pa.array(rows)).to_pylist()
        length, n = length[rows].astype(np.int64), n[rows]
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        i, j = near_pairs(np.unique(key[rows], return_inverse=True)[1], words, low[rows] < length - high[rows])
        own = sizes[i] == length[i]  # else the part of the next length tells them
        i, j = i[own], j[own]
        for at in range(0, len(i), 20_000):
            a, b = i[at : at + 20_000], j[at : at + 20_000]
            yield pa.RecordBatch.from_arrays([pa.array([words[k] for k in a]), pa.array(n[a]), pa.array([words[k] for k in b]), pa.array(n[b])], names=["a", "a_n", "b", "b_n"])

    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.num_rows
        if size >= AT_A_TIME:
            whole = pa.Table.from_batches(held)
            cut = int(np.searchsorted(whole.column("key").to_numpy(), whole.column("key")[-1].as_py()))
            if cut:
                yield from joined(whole.slice(0, cut))
                held = whole.slice(cut).combine_chunks().to_batches()
                size = whole.num_rows - cut
    if held:
        yield from joined(pa.Table.from_batches(held))


def near_words(words: DataFrame, *, least_length: int = 7, part_rows: int = AT_A_TIME) -> DataFrame:
    """(a, a_n, b, b_n): each two near words of words (word, n) once."""
    ship(words.sparkSession)
    parts = words.mapInArrow(_parts(least_length), PARTS)
    done = []
    while True:
        counts = parts.groupBy("key").agg(F.count("*").alias("rows"), F.max(F.col("high") - F.col("low")).alias("open"))
        crowded = keep(counts.filter((F.col("rows") > part_rows) & (F.col("open") > 1)).select(F.col("key").alias("crowd")), "crowded")
        if crowded.isEmpty():
            break
        marked = likely(parts, F.col("key"), crowded, "crowded")
        doubtful = marked.filter("crowded").drop("crowded")
        done += [marked.filter("not crowded").drop("crowded"), doubtful.join(crowded, F.col("key") == F.col("crowd"), "left_anti")]
        again = doubtful.join(crowded, F.col("key") == F.col("crowd"), "left_semi").select("word", "n", "length", "low", "high")
        parts = keep(again.mapInArrow(_finer, PARTS), "finer")
    for own in done:
        parts = parts.unionByName(own)
    return parts.repartition("key").sortWithinPartitions("key").mapInArrow(_near, NEAR).distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): where the forms of forms (word, form) lead.  Each round doubles the steps that are known; a form is some times
    as frequent as its word, so there are few."""
    spark = forms.sparkSession
    now, path = keep_once(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        then, then_path = keep_once(now.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        discard(spark, path)
        now, path = then.select("word", "root"), then_path
        if then.filter("moved").isEmpty():
            return now


def variants(docs: DataFrame, *, least_length: int = 7, least_n: int = 2, times: int = 10, part_rows: int = AT_A_TIME) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each word of docs (doc_id, text)."""
    words = keep(vocabulary(docs, least_length=least_length, least_n=least_n), "words")
    near = keep(near_words(words, least_length=least_length, part_rows=part_rows), "near")
    sides = near.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("other_n"))
    sides = sides.unionByName(near.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("a_n").alias("other_n")))
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form"))).alias("best")
    told = words.join(sides.groupBy("word").agg(F.count("*").alias("n_near"), best), "word", "left")
    is_form = -F.col("best.less") >= times * F.col("n")
    named = keep(told.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(is_form, F.col("best.form")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n")), "named")
    led = roots(named.filter("form is not null"))
    return named.join(led, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
