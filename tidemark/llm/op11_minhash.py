"""MinHash near-duplicates with b-bit signatures (operator 11).

A document's set is its distinct word shingles.  ``K`` hash functions give the set's minima; a band is ``ROWS`` of them in a row.
Of each minimum only the lowest ``BITS`` bits are retained, packed into ``K * BITS / 8`` bytes.  Two signatures' equal parts are
counted by bits; as unlike minima have equal low bits once in 2 ** BITS, the share is corrected for that.

Documents whose sets are equal are one class, named by its least doc_id; only classes take part.  Classes that share a band are
candidates; those whose signatures allow the similarity are decided by their full sets.  Links are told in rounds, and a round
looks only at what the one before has not connected:

1. each class with the least class of each of its bands;
2. with the greatest, and with one that the band's own hash chooses;
3. all pairs of a band that are still apart.  A band of very many rows is dealt into blocks, and each two blocks meet in a task
   of their own.  There signatures decide first and then sketches, which hold all of a set of up to ``FINE`` shingles, and a
   sample of a larger one; only pairs that pass both are told.

So a group of any size costs about its size, if it is connected; look-alikes that are not linked cost signatures and sketches
compared in place, and make no rows.

Bands miss a link at the similarity asked for (0.85) once in (1 - 0.85 ** 6) ** -40, less than 1e-8; more similar ones less
often.  Signatures drop a pair that is ``DOUBT`` standard deviations under it, 1e-9.  Nothing is capped.

Cases: a null or empty text, or one without words, has the empty set and is linked with nothing.  Fewer words than a shingle has
are one shingle.  Rows that repeat a doc_id take the component of their own text.  A row without doc_id links nothing; it has the
component of its set if a row with a doc_id has the same one, else null, and is not kept.  An empty table gives no rows; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.graph import components
from tidemark.llm.scratch import among, discard, keep, keep_once, likely, ship

#: Hash functions, retained bits of each minimum, minima of a band, and bands.
K, BITS, ROWS, BANDS = 512, 2, 6, 40
#: Standard deviations that a signature may lie under what the similarity lets expect.
DOUBT = 6
#: Rows of a band of which all pairs are told in one place; more are dealt into blocks of so many.
BLOCK_ROWS = 4096
#: Shingles of a sketch; of larger sets it has a half, a fourth, ... of the shingles, chosen by the lowest bits of their hashes.
FINE = 2048
#: By how many shingles a sketch may err: it holds 32 bits of each hash.
SLACK = 2
#: Words whose hashes a worker remembers.
REMEMBERED = 300_000
#: Fixed by this seed: the hash functions x -> a * x + b modulo 2 ** 32, and the weights of a shingle's words.
_random = np.random.default_rng(20_11)
_A = _random.integers(0, 1 << 31, K, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = _random.integers(0, 1 << 32, K, dtype=np.uint32)
_WEIGHTS = _random.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class _WordHashes(dict):
    """XXH64 of words; what is not known is computed and remembered for a while."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word, 42)
        return found


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def shingle_set(text: str | None, words_a_shingle: int, known: _WordHashes) -> np.ndarray:
    """The hashes of a text's distinct shingles, in order: each is a weighted sum of its words' hashes, mixed."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    k = min(words_a_shingle, len(words))
    hashes = np.fromiter([known[w] for w in words], np.uint64, len(words))
    n = len(words) - k + 1
    total = np.full(n, k, np.uint64)
    for i in range(k):
        total += hashes[i : i + n] * _WEIGHTS[i % 64]
    return np.unique(_mixed(total))


def minima(own: np.ndarray) -> np.ndarray:
    """The least value of each hash function over a set that is not empty."""
    short = (own >> np.uint64(32)).astype(np.uint32)
    least = np.full(K, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(short), 512):
        least = np.minimum(least, (np.multiply.outer(_A, short[at : at + 512]) + _B[:, None]).min(axis=1))
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    """A number for each band, made of its minima and its place."""
    own = least[: ROWS * BANDS].reshape(BANDS, ROWS).astype(np.uint64)
    return _mixed((own * _WEIGHTS[:ROWS]).sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64) * _WEIGHTS[ROWS]).view(np.int64)


def signature(least: np.ndarray) -> bytes:
    """The lowest bits of the minima, packed; minima are mixed before, so that their low bits are like any others."""
    low = (_mixed(least.astype(np.uint64)) & np.uint64((1 << BITS) - 1)).astype(np.uint8)
    return np.packbits(np.unpackbits(low[:, None], axis=1)[:, -BITS:]).tobytes()


def equal_parts(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many of the K parts of signatures x and y [row, 64-bit word] are equal, by counting bits."""
    differ = x ^ y
    some = differ
    for shift in range(1, BITS):
        some = some | differ >> np.uint64(shift)
    return K - np.bitwise_count(some & np.uint64(_LOWEST)).sum(axis=-1, dtype=np.int64)


_LOWEST = sum(1 << (BITS * i) for i in range(64 // BITS))


def estimate(equal: np.ndarray) -> np.ndarray:
    """The similarity that a number of equal parts tells of, corrected for parts that are equal by chance."""
    chance = 2.0**-BITS
    return (equal / K - chance) / (1 - chance)


def least_equal(similarity: float) -> int:
    """Fewer equal parts than this deny that similarity."""
    share = 2.0**-BITS + (1 - 2.0**-BITS) * similarity
    return math.floor(K * share - DOUBT * math.sqrt(K * share * (1 - share)))


def sketch(own: np.ndarray) -> bytes:
    """A byte that tells how many of the lowest bits of a hash are zero in all that are kept, and 32 bits of each of these."""
    level = max(0, math.ceil(math.log2(max(1, len(own)) / FINE)))
    low = np.unique((own & np.uint64(0xFFFFFFFF)).astype(np.uint32))
    return bytes([level]) + low[(low & np.uint32((1 << level) - 1)) == 0].astype("<u4").tobytes()


class Sketches:
    """The sketches of some rows; passes() tells which may be as similar as that."""

    def __init__(self, values: Sequence[bytes], similarity: float):
        self.similarity = similarity
        self.level = np.array([v[0] for v in values], np.int64)
        n = np.array([(len(v) - 1) // 4 for v in values], np.int64)
        numbers = np.frombuffer(b"".join([v[1:] for v in values]), "<u4")
        kinds, self.flat = np.unique(numbers, return_inverse=True)
        self.ends = np.cumsum(n)
        self.starts, self.marked = self.ends - n, np.zeros(len(kinds), bool)
        #: By level, whether a hash is kept there, and how many of each row are.
        self.kept = {t: (kinds & np.uint32((1 << t) - 1)) == 0 for t in range(int(self.level.max(initial=0)) + 1)}
        over = {t: np.concatenate(([0], np.cumsum(kept[self.flat]))) for t, kept in self.kept.items()}
        self.sizes = {t: x[self.ends] - x[self.starts] for t, x in over.items()}

    def passes(self, i: int, j: np.ndarray) -> np.ndarray:
        ok, own, levels = np.zeros(len(j), bool), self.flat[self.starts[i] : self.ends[i]], np.maximum(self.level[j], self.level[i])
        for t in np.unique(levels).tolist():
            at = np.flatnonzero(levels == t)
            rows = j[at]
            self.marked[own] = self.kept[t][own]
            n = self.ends[rows] - self.starts[rows]
            back = np.cumsum(n) - n
            hits = np.concatenate(([0], np.cumsum(self.marked[self.flat[np.repeat(self.starts[rows] - back, n) + np.arange(int(n.sum()))]])))
            self.marked[own] = False
            common = hits[back + n] - hits[back]
            union = self.sizes[t][rows] + self.sizes[t][i] - common
            least = self.similarity * union - (SLACK if t == 0 else DOUBT * np.sqrt(self.similarity * (1 - self.similarity) * union))
            ok[at] = common >= least
        return ok


def _words_of(values: Iterable[bytes]) -> np.ndarray:
    """Signatures as rows of 64-bit words whose parts don't straddle them."""
    return np.frombuffer(b"".join(values), ">u8").astype(np.uint64).reshape(-1, K * BITS // 64)


SIGNED = "doc_id long, n_shingles long, digest binary, bands array<long>, signature binary"


def _signed(words_a_shingle: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordHashes()
        for batch in batches:
            sizes, digests, bands, signatures = [], [], [], []
            for text in batch.column(1):
                own = shingle_set(text.as_py(), words_a_shingle, known)
                least = minima(own) if len(own) else None
                sizes.append(len(own))
                digests.append(None if least is None else hashlib.sha256(own.tobytes()).digest()[:20])
                bands.append(None if least is None else band_keys(least))
                signatures.append(None if least is None else signature(least))
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(signatures, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_shingles", "digest", "bands", "signature"])

    return run


def signatures(docs: DataFrame, words_a_shingle: int) -> DataFrame:
    """The columns of SIGNED for each row of docs (doc_id, text); nulls where the set is empty."""
    ship(docs.sparkSession)
    return _source(docs).mapInArrow(_signed(words_a_shingle), SIGNED)


def _source(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _sketched(words_a_shingle: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordHashes()
        for batch in batches:
            found = [sketch(shingle_set(text.as_py(), words_a_shingle, known)) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["node", "sketch"])

    return run


def _sets(words_a_shingle: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                own = [shingle_set(text.as_py(), words_a_shingle, known).view(np.int64) for text in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(own, pa.list_(pa.int64()))], names=["node", "own"])

    return run


def _allowed(similarity: float):
    """Pairs (a, b, of_a, of_b) whose signatures allow that similarity, with the estimate."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            equal = equal_parts(*(_words_of(batch.column(i).to_pylist()) for i in (2, 3)))
            ok = pa.array(equal >= least_equal(similarity))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(ok), batch.column(1).filter(ok), pa.array(estimate(equal)).filter(ok)], names=["a", "b", "estimate"])

    return run


def _met(similarity: float):
    """Reads rows (cell, node, component, block, crossed, signature, sketch) sorted by cell; gives the pairs (a, b) of unlike
    components whose signatures and sketches allow that similarity.  In a cell that is crossed, rows of one block are no pairs: they meet elsewhere."""
    least = least_equal(similarity)

    def pairs(cell, node, component, block, crossed, sign, told) -> Iterator[pa.RecordBatch]:
        words, sketches = _words_of(sign), Sketches(told, similarity)
        ends = np.append(np.flatnonzero(cell[1:] != cell[:-1]) + 1, len(cell))
        for i in range(len(cell) - 1):
            end = ends[np.searchsorted(ends, i, "right")]
            j = np.arange(i + 1, end)
            j = j[(component[j] != component[i]) & ~(crossed[j] & (block[j] == block[i]))]
            j = j[equal_parts(words[j], words[i]) >= least] if len(j) else j
            j = j[sketches.passes(i, j)] if len(j) else j
            if len(j):
                own = np.full(len(j), node[i])
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(own, node[j])), pa.array(np.maximum(own, node[j]))], names=["a", "b"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if sum(b.num_rows for b in held) >= BLOCK_ROWS and batch.column(0)[0] != batch.column(0)[-1]:
                whole = pa.Table.from_batches(held)
                cells = whole.column(0).to_numpy()
                cut = int(np.searchsorted(cells, cells[-1]))
                yield from pairs(*_columns(whole.slice(0, cut)))
                held = whole.slice(cut).combine_chunks().to_batches()
        if held:
            yield from pairs(*_columns(pa.Table.from_batches(held)))

    return run


def _columns(table: pa.Table) -> list:
    return [table.column(i).to_pylist() if i >= 5 else table.column(i).to_numpy() for i in range(7)]


def in_cells(rows: DataFrame, most: int) -> DataFrame:
    """Rows (band, n, node, ...) with the cells in which they meet others of their band: one of more than ``most`` rows is dealt
    into blocks, and each two blocks, or one with itself, meet in a cell of their own."""
    dealt = rows.withColumn("blocks", F.ceil(F.col("n") / most).cast("int")).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cell = F.xxhash64("band", F.least("block", "other"), F.greatest("block", "other"))
    return met.withColumn("cell", cell).withColumn("crossed", F.col("block") != F.col("other"))


def _side(prints: DataFrame, side: str) -> DataFrame:
    return prints.select(F.col("doc_id").alias(side), F.col("signature").alias(f"of_{side}"))


def near_duplicates(docs: DataFrame, *, words_a_shingle: int = 5, similarity: float = 0.85, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of docs (doc_id, text): documents whose sets of shingles have at least
    that Jaccard similarity are linked; kept is the one with the least doc_id of those that are connected."""
    source = _source(docs)
    prints = keep(signatures(docs, words_a_shingle), "signatures")
    classes = keep(prints.filter("doc_id is not null and digest is not null").groupBy("digest").agg(F.min("doc_id").alias("node")), "classes")
    # only the row that names a class takes part
    named = prints.filter("doc_id is not null and digest is not null").select("doc_id", "digest", "bands", "signature").join(classes, "digest").filter("doc_id = node")
    own = keep(named.dropDuplicates(["digest"]).select("doc_id", "bands", "signature"), "own")
    bands = own.select(F.col("doc_id").alias("node"), F.explode("bands").alias("band"))
    chosen = F.min(F.struct(F.xxhash64("band", "node").alias("order"), "node"))["node"].alias("chosen")
    buckets = keep(bands.groupBy("band").agg(F.min("node").alias("least"), F.max("node").alias("most"), chosen, F.count("*").alias("n")).filter("least <> most"), "bands")
    shared = keep(among_rows(bands, buckets), "shared")

    def linked(pairs: DataFrame) -> DataFrame:
        """The pairs that full sets confirm."""
        spark = docs.sparkSession
        pairs, pairs_path = keep_once(pairs.distinct(), "pairs")
        told = pairs.join(_side(own, "a"), "a").join(_side(own, "b"), "b").select("a", "b", "of_a", "of_b")
        candidates = keep(told.mapInArrow(_allowed(similarity), "a long, b long, estimate double").select("a", "b"), "candidates")
        discard(spark, pairs_path)
        wanted = keep(candidates.select(F.col("a").alias("doc_id")).union(candidates.select("b")).distinct(), "wanted")
        sets, path = keep_once(among(source, F.col("doc_id"), wanted).mapInArrow(_sets(words_a_shingle), "node long, own array<long>"), "sets")
        both = candidates.join(sets.select(F.col("node").alias("a"), F.col("own").alias("of_a")), "a").join(sets.select(F.col("node").alias("b"), F.col("own").alias("of_b")), "b")
        common = F.size(F.array_intersect("of_a", "of_b"))
        percent = round(100 * similarity)
        found = keep(both.filter(100 * common >= percent * (F.size("of_a") + F.size("of_b") - common)).select("a", "b"), "links")
        discard(spark, path)
        return found

    def towards(rows: DataFrame, hub: str) -> DataFrame:
        return rows.filter(F.col("node") != F.col(hub)).select(F.least("node", hub).alias("a"), F.greatest("node", hub).alias("b"))

    def apart(links: DataFrame) -> DataFrame:
        """The rows of bands that have rows of several components by now."""
        rows = shared.join(components(links), "node", "left").withColumn("component", F.coalesce("component", "node"))
        several = keep(rows.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high").select("band"), "several")
        return keep(rows.join(several, "band", "left_semi"), "apart")

    found = linked(towards(shared, "least"))
    rows = apart(found)
    label = rows.select(F.col("node").alias("hub"), F.col("component").alias("of_hub")).distinct()

    def across(hub: str) -> DataFrame:
        return towards(rows.withColumn("hub", F.col(hub)).join(label, "hub").filter("component <> of_hub"), hub)

    found = found.union(linked(across("most").union(across("chosen"))))
    rows = apart(found).select("band", "n", "node", "component")
    met = keep(rows.select(F.col("node").alias("doc_id")).distinct(), "met")
    sketches = among(source, F.col("doc_id"), met).mapInArrow(_sketched(words_a_shingle), "node long, sketch binary")
    told = keep(own.select(F.col("doc_id").alias("node"), "signature").join(sketches, "node").dropDuplicates(["node"]), "sketches")
    cells = in_cells(rows.join(told, "node"), block_rows)
    dealt = cells.select("cell", "node", "component", "block", "crossed", "signature", "sketch").repartition("cell").sortWithinPartitions("cell", "node")
    found = found.union(linked(dealt.mapInArrow(_met(similarity), "a long, b long")))
    led = classes.join(components(found), "node", "left").select("digest", F.coalesce("component", "node").alias("of_class"))
    whole = prints.select("doc_id", "n_shingles", "digest").join(led, "digest", "left").withColumn("component_id", F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("of_class")))
    return whole.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def among_rows(bands: DataFrame, buckets: DataFrame) -> DataFrame:
    """The rows (band, node) of bands that several classes share, with what buckets tell of these; only likely rows move."""
    marked: Column = F.col("tidemark_shared")
    return likely(bands, F.col("band"), buckets.select("band"), "tidemark_shared").filter(marked).drop("tidemark_shared").join(buckets, "band")
