"""SimHash near-duplicates with pigeonring filtering (operator 2).

Fingerprints: each feature's XXH64, bit by bit; a bit is set if it is set in over half of the features.  Features are word
shingles with their repeats, or a text's distinct words.  A fingerprint has one or more words of 64 bits, one for each seed.

Links: fingerprints are cut into m segments on a ring.  If two differ in at most ``max_distance`` bits, then from some
segment on, each chain of consecutive segments differs in at most its proportional share (the pigeonring principle).  With
m > max_distance that is: nothing in the first segment, one bit at most in the first two, and so on.  The first two
conditions are an equi-join: a row's key is the first segment and the second one; rows also go under the keys whose second
segment lacks one of their set bits, for of two segments that differ in one bit exactly one has it.  Longer chains prune
what meets there, before the full Hamming distance.

near_duplicates() has m > max_distance, so it finds every link.  near_copies() looks for texts whose sets of five-word
shingles are similar; SimHash cannot bound that.  So wide fingerprints of the distinct words, with the same keys (then
stricter than the guarantee asks), only connect most groups cheaply; the rest is found by prefixes, which miss nothing: in
one order of all shingles, rare ones first, two sets that are similar enough share one of their first ones.  All pairs that
share one and are not connected by then are decided by the exact similarity.

Only distinct fingerprints take part, and a bucket gives edges that connect what it links, not all of its pairs; copies
therefore cost nothing and a large group of near copies costs about its size.  No bucket is capped: one of very many rows is
dealt into blocks, and each block of its homes meets each block of its rows in a task of its own.

Cases: a null or empty text has no feature and the fingerprint zero; it is linked like any other (near_copies: to those with
the same words).  Repeated rows and ties keep one row each.  A row without doc_id links nothing; it gets the component of its
fingerprint if a row with a doc_id has the same one, else null (near_copies: null).  An empty table gives no rows; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Collection, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.graph import components
from tidemark.llm.scratch import among, discard, keep, keep_once, likely, ship, without

BITS = 64
#: In a bucket's key, the place on the ring stands above so many bits; no two segments have more.
RING_BITS = 48
#: Rows of a bucket that are compared by shifted columns; larger buckets go through _large_bucket().
SMALL = 8
#: Shingles in the prefixes of more texts than RARE stand last in the order of prefixes; at most COMMON of them, 8 MB, the commonest.
RARE, COMMON = 8, 1_000_000


def shingles(text: str | None, words_a_shingle: int) -> list[bytes]:
    """A text's shingles, repeats included; the whole sequence of its words if there are fewer than a shingle has."""
    words = (text or "").encode().lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    k = min(words_a_shingle, len(words))
    starts = np.concatenate(([0], ends[: len(words) - k] + 1)).tolist()
    return [joined[s:e] for s, e in zip(starts, ends[k - 1 :].tolist(), strict=True)]


def hashed(features: Iterable[bytes], seed: int = 42) -> np.ndarray:
    """The XXH64 of each feature, as eight bytes, the highest first."""
    digest = xxhash.xxh64_digest
    return np.frombuffer(b"".join([digest(x, seed) for x in features]), np.uint8).reshape(-1, 8)


def fingerprint(text: str | None, words_a_shingle: int, seed: int = 42, *, distinct: bool = False) -> int:
    """The SimHash of a whole text."""
    features = shingles(text, words_a_shingle)
    return simhash({*features} if distinct else features, seed)


def simhash(features: Collection[bytes], seed: int = 42) -> int:
    """A bit is set if it is set in the hashes of over half of the features; zero for none."""
    if not features:
        return 0
    hashes = hashed(features, seed)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 4096):
        ones += np.unpackbits(hashes[at : at + 4096], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def _columns(width: int) -> list[str]:
    return [f"fp{i}" for i in range(width)]


def _fingerprints(words_a_shingle: int, width: int, distinct: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [[_signed(fingerprint(text.as_py(), words_a_shingle, 42 + i, distinct=distinct)) for i in range(width)] for text in batch.column(1)]
            found = [pa.array([p[i] for p in prints], pa.int64()) for i in range(width)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *found], names=["doc_id", *_columns(width)])

    return run


def fingerprints(docs: DataFrame, words_a_shingle: int, *, width: int = 1, distinct: bool = False) -> DataFrame:
    """(doc_id, fp0, fp1, ...): the words of the fingerprint as signed longs; seeds from 42 on."""
    ship(docs.sparkSession)
    kinds = ", ".join(f"{c} long" for c in ["doc_id", *_columns(width)])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_fingerprints(words_a_shingle, width, distinct), kinds)


@dataclass(frozen=True)
class Ring:
    """Segments (word, start, bits) of fingerprints of ``width`` words."""

    width: int
    max_distance: int
    parts: tuple[tuple[int, int, int], ...]

    @classmethod
    def of(cls, width: int, a_word: int, max_distance: int) -> Ring:
        cuts = [BITS * i // a_word for i in range(a_word + 1)]
        return cls(width, max_distance, tuple((word, a, b - a) for word in range(width) for a, b in zip(cuts, cuts[1:], strict=False)))

    def masks(self) -> np.ndarray:
        """[segment, chain, word]: the bits of the chain + 1 segments from that segment on."""
        m = len(self.parts)
        out = np.zeros((m, m, self.width), np.uint64)
        for i in range(m):
            for chain in range(m):
                for j in range(chain + 1):
                    word, a, bits = self.parts[(i + j) % m]
                    out[i, chain, word] |= np.uint64(((1 << bits) - 1) << a)
        return out

    def budget(self, chain: int) -> int:
        """The proportional share of the first chain + 1 segments."""
        return (chain + 1) * self.max_distance // len(self.parts)


def _keys(ring: Ring):
    """The rows that each fingerprint sends to the buckets; home: its second segment is the key's own."""
    m = len(ring.parts)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [batch.column(1 + i).to_numpy().view(np.uint64) for i in range(ring.width)]
            node, n = batch.column(0).to_numpy(), batch.num_rows
            for i in range(m):
                (x, a, wa), (y, b, wb) = ring.parts[i], ring.parts[(i + 1) % m]
                first = (words[x] >> np.uint64(a)) & np.uint64((1 << wa) - 1)
                second = (words[y] >> np.uint64(b)) & np.uint64((1 << wb) - 1)
                chosen = [np.arange(n)] + [np.flatnonzero((second >> np.uint64(k)) & np.uint64(1)) for k in range(wb)]
                keys = [second] + [second[rows] ^ np.uint64(1 << k) for k, rows in enumerate(chosen[1:])]
                rows = np.concatenate(chosen)
                key = np.uint64(i << RING_BITS) | first[rows] << np.uint64(wb) | np.concatenate(keys)
                columns = [pa.array(key.astype(np.int64)), pa.array(np.arange(len(rows)) < n), pa.array(node[rows]), *(pa.array(w[rows].view(np.int64)) for w in words)]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "home", "node", *_columns(ring.width)])

    return run


def _linked(x: np.ndarray, segment: np.ndarray | int, masks: np.ndarray, ring: Ring) -> np.ndarray:
    """Which differences x [row, word] pass the chains that start at their segment, and then the whole distance."""
    at = np.arange(len(x))
    for chain in range(2, masks.shape[1]):  # the key has seen to the first two
        start = segment[at] if isinstance(segment, np.ndarray) else segment
        at = at[np.bitwise_count(x[at] & masks[start, chain]).sum(axis=1) <= max(1, ring.budget(chain))]
    ok = np.zeros(len(x), bool)
    ok[at[np.bitwise_count(x[at]).sum(axis=1) <= ring.max_distance]] = True
    return ok


def _large_bucket(fp: np.ndarray, node: np.ndarray, homes: int, segment: int, masks: np.ndarray, ring: Ring, spare: bool) -> list[tuple[np.ndarray, np.ndarray]]:
    """Edges that connect what a bucket links: each home row is held against the rows that aren't yet in its class.

    spare: edges will be verified, so each row that is reached gets one, and one to its neighbour among them.
    """
    label = np.arange(len(fp))
    edges = []
    for i in range(homes):
        rest = np.flatnonzero(label != label[i])
        if not len(rest):
            break
        hits = rest[_linked(fp[rest] ^ fp[i], segment, masks, ring)]
        if len(hits):
            classes, first = np.unique(label[hits], return_index=True)
            ends = hits if spare else hits[first]
            edges.append((np.full(len(ends), node[i]), node[ends]))
            if spare:
                edges.append((node[hits[:-1]], node[hits[1:]]))
            label[np.isin(label, classes)] = label[i]
    return edges


def _edges(ring: Ring, spare: bool):
    """Reads rows sorted by key, home rows first; gives edges between nodes."""
    masks = ring.masks()

    def buckets(key, home, node, *words) -> pa.RecordBatch:
        fp = np.stack([w.view(np.uint64) for w in words], axis=1)
        starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        sizes = np.diff(np.append(starts, len(key)))
        segment = key >> RING_BITS
        left, right = [], []
        small = np.repeat(sizes <= SMALL, sizes)
        for step in range(1, min(SMALL, len(key))):
            at = np.flatnonzero(home[:-step] & small[:-step] & (key[:-step] == key[step:]))
            at = at[_linked(fp[at] ^ fp[at + step], segment[at], masks, ring)]
            left.append(node[at])
            right.append(node[at + step])
        for s, n in zip(starts[sizes > SMALL], sizes[sizes > SMALL], strict=True):
            homes = int(home[s : s + n].sum())
            for a, b in _large_bucket(fp[s : s + n], node[s : s + n], homes, int(segment[s]), masks, ring, spare):
                left.append(a)
                right.append(b)
        pairs = np.stack([np.concatenate(left), np.concatenate(right)], axis=1) if left else np.zeros((0, 2), np.int64)
        pairs = np.unique(np.sort(pairs[pairs[:, 0] != pairs[:, 1]], axis=1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            now = tuple(column.to_numpy(zero_copy_only=False) for column in batch.columns)
            key = now[0]
            if key[-1] == (held[0][0][0] if held else key[0]):  # one bucket so far
                held.append(now)
                continue
            cut = int(np.searchsorted(key, key[-1]))
            yield buckets(*(np.concatenate([*(h[i] for h in held), now[i][:cut]]) for i in range(len(now))))
            held = [tuple(column[cut:] for column in now)]
        if held:
            yield buckets(*(np.concatenate([h[i] for h in held]) for i in range(len(held[0]))))

    return run


def _home_keys(ring: Ring):
    """The keys at home in which each fingerprint stands, one for each segment."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _keys(ring)(batches):
            yield batch.select(["key"]).filter(batch.column(1))

    return run


def crowded(names: DataFrame, ring: Ring, bucket_rows: int) -> DataFrame:
    """(crowd, blocks): the keys with many rows, and into how many blocks these are to be dealt.

    A key's rows are those at home there and those at home in keys with one bit more, so the counts of homes tell of both.
    """
    homes = names.mapInArrow(_home_keys(ring), "key long").groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > bucket_rows)
    m = len(ring.parts)
    bits = F.element_at(F.array(*[F.lit(ring.parts[(i + 1) % m][2]) for i in range(m)]), (F.shiftright("key", RING_BITS) + 1).cast("int"))
    lacking = F.transform(F.sequence(F.lit(0), bits - 1), lambda k: F.when(F.expr("1L").bitwiseAND(F.call_function("shiftright", F.col("key"), k)) == 1, F.col("key").bitwiseXOR(F.call_function("shiftleft", F.expr("1L"), k))))
    reached = homes.select("n", F.explode(F.concat(F.array("key"), F.array_compact(lacking))).alias("crowd"))
    return keep(reached.groupBy("crowd").agg(F.ceil(F.sum("n") / bucket_rows).cast("int").alias("blocks")), "crowded")


def _dealt(rows: DataFrame, crowds: DataFrame) -> DataFrame:
    """Rows (key, home, node, ...) of crowded keys, dealt into cells in place of keys: in a cell, the homes of one block meet all
    rows of another, or of the same.  A cell's number keeps the segment of its key."""
    met = rows.join(crowds, F.col("key") == F.col("crowd")).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))

    def cell(home: Column, other: Column) -> Column:
        mixed = F.call_function("shiftrightunsigned", F.xxhash64("key", home, other), F.lit(64 - RING_BITS))
        return F.call_function("shiftleft", F.shiftright("key", RING_BITS), F.lit(RING_BITS)).bitwiseOR(mixed)

    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    looked_at = met.withColumn("at", every).withColumns({"cell": cell(F.col("at"), F.col("block")), "home": F.col("home") & (F.col("at") == F.col("block"))})
    looking = met.filter("home").withColumn("at", every).filter("at <> block").withColumn("cell", cell(F.col("block"), F.col("at")))
    columns = [F.col("cell").alias("key") if c == "key" else F.col(c) for c in rows.columns]
    return looked_at.select(*columns).union(looking.select(*columns))


def links(classes: DataFrame, ring: Ring, *, spare: bool = False, bucket_rows: int = 20_000) -> DataFrame:
    """Edges (a, b) between the classes (node, fp0, ...) of distinct fingerprints."""
    names = _columns(ring.width)
    kinds = ", ".join(["key long", "home boolean", "node long", *(f"{c} long" for c in names)])
    prints = classes.select("node", *names)
    keys, crowds = prints.mapInArrow(_keys(ring), kinds), crowded(prints, ring, bucket_rows)
    if not crowds.isEmpty():
        marked = likely(keys, F.col("key"), crowds.select("crowd"), "crowded")
        doubtful = marked.filter("crowded").drop("crowded")
        alone = marked.filter("not crowded").drop("crowded").union(doubtful.join(crowds, F.col("key") == F.col("crowd"), "left_anti"))
        keys = alone.union(_dealt(doubtful, crowds))
    return keys.repartition("key").sortWithinPartitions("key", F.desc("home"), "node").mapInArrow(_edges(ring, spare), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, *, words_a_shingle: int = 4, max_distance: int = 4) -> DataFrame:
    """(doc_id, fp0, component_id) for every row of docs (doc_id, text)."""
    prints = keep(fingerprints(docs, words_a_shingle), "fingerprints")
    # a class of equal fingerprints is named by its least doc_id
    classes = keep(prints.filter("doc_id is not null").groupBy("fp0").agg(F.min("doc_id").alias("node")), "classes")
    edges = links(classes, Ring.of(1, max(3, max_distance + 1), max_distance))
    named = classes.join(components(edges), "node", "left").select("fp0", F.coalesce("component", "node").alias("component_id"))
    return prints.join(named, "fp0", "left").select("doc_id", "fp0", "component_id")


def _shingle_hashes(words: list[bytes], words_a_shingle: int) -> np.ndarray:
    """The distinct shingles of a text's words, as signed longs in order."""
    joined = b" ".join(words)
    return np.unique(hashed(shingles(joined.decode(), words_a_shingle)).reshape(-1).view(">i8")).astype(np.int64)


def _first_prefixes(words_a_shingle: int, similarity: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        for batch in batches:
            own = [prefix_of(_shingle_hashes((text.as_py() or "").encode().lower().split(), words_a_shingle), similarity, none, none) for text in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([none, *own]))], names=["key"])

    return run


def _common(source: DataFrame, words_a_shingle: int, similarity: float) -> np.ndarray:
    """The shingles that many texts have in their prefixes while these go by hash alone, the rarer first.

    All texts are counted, so what is rare doesn't depend on the size of the input.  Only the order of prefixes comes from
    here: any order finds the same pairs, and shingles beyond COMMON would just give more pairs to decide.
    """
    found = source.select("text").mapInArrow(_first_prefixes(words_a_shingle, similarity), "key long").groupBy("key").count().filter(F.col("count") > RARE)
    ordered = found.orderBy(F.desc("count"), "key").limit(COMMON).select("key").toArrow().column("key").to_numpy()
    return ordered[::-1].astype(np.int64)


def prefix_of(own: np.ndarray, similarity: float, common: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The first of a set's shingles, the rare before the common: two sets of that Jaccard similarity share one of them,
    for each has at least similarity * size in common with the other.  common is sorted; rank: the place of each."""
    if not len(own):
        return own
    taken = len(own) - math.ceil(similarity * len(own) - 1e-9) + 1
    if not len(common):
        return own[:taken]
    at = np.minimum(np.searchsorted(common, own), len(common) - 1)
    return own[np.argsort(np.where(common[at] == own, rank[at], -1), kind="stable")[:taken]]


def sketch(own: np.ndarray) -> bytes:
    """How many of a set's shingles have each last byte, up to 255."""
    return np.minimum(np.bincount(own & 255, minlength=256), 255).astype(np.uint8).tobytes()


def _can_be_alike(similarity: float):
    """The pairs whose sketches allow that similarity: no more is in common than the lesser counts sum to.  A count of 255
    stands for any higher one too, so a set that has one passes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, 256) for i in (2, 3))
            needs = similarity / (1 + similarity) * (x.sum(axis=1, dtype=np.int64) + y.sum(axis=1, dtype=np.int64)) - 1e-6
            ok = (np.minimum(x, y).sum(axis=1, dtype=np.int64) >= needs) | (np.maximum(x, y) == 255).any(axis=1)
            yield batch.select([0, 1]).filter(pa.array(ok))

    return run


def _worded(width: int, words_a_shingle: int, similarity: float, ordered: np.ndarray):
    """A digest of a text's words in order, the fingerprint of its distinct words, and prefix, size and sketch of its shingles."""
    rank = np.argsort(ordered)
    common = ordered[rank]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequences, prints, prefixes, sizes, sketches = [], [], [], [], []
            for text in batch.column(1):
                words = (text.as_py() or "").encode().lower().split()
                sequences.append(hashlib.sha256(b" ".join(words)).digest())
                prints.append([_signed(simhash({*words}, 42 + i)) for i in range(width)])
                own = _shingle_hashes(words, words_a_shingle)
                prefixes.append(prefix_of(own, similarity, common, rank))
                sizes.append(len(own))
                sketches.append(sketch(own))
            found = [pa.array([p[i] for p in prints], pa.int64()) for i in range(width)]
            told = [pa.array(sequences, pa.binary()), *found, pa.array(prefixes, pa.list_(pa.int64())), pa.array(sizes, pa.int32()), pa.array(sketches, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *told], names=["doc_id", "sequence", *_columns(width), "prefix", "size", "sketch"])

    return run


def _whole_keys(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """The columns of batches sorted by their first one, cut where it changes."""
    held: list[tuple[np.ndarray, ...]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        now = tuple(column.to_numpy(zero_copy_only=False) for column in batch.columns)
        cut = int(np.searchsorted(now[0], now[0][-1])) if not held or held[0][0][0] != now[0][-1] else 0
        if cut or (held and held[0][0][0] != now[0][0]):
            yield tuple(np.concatenate([*(h[i] for h in held), now[i][:cut]]) for i in range(len(now)))
            held = []
        held.append(tuple(column[cut:] for column in now))
    if held:
        yield tuple(np.concatenate([h[i] for h in held]) for i in range(len(held[0])))


def _shared_keys(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows (key, node, size, place), sorted by key, whose key another row has too; n: how many have it."""
    for columns in _whole_keys(batches):
        same = columns[0][1:] == columns[0][:-1]
        rows = np.flatnonzero(np.append(same, False) | np.concatenate(([False], same)))
        starts = np.flatnonzero(np.concatenate(([True], ~same)))
        counts = np.diff(np.append(starts, len(columns[0])))
        yield pa.RecordBatch.from_arrays([*(pa.array(c[rows]) for c in columns), pa.array(np.repeat(counts, counts)[rows].astype(np.int32))], names=["key", "node", "size", "place", "n"])


def _can(similarity: float, size, place, component, i, j):
    """Which rows i and j, of one key, can be as similar as that by their sizes and by what stands behind a first common shingle."""
    left = np.minimum(size[i] - place[i], size[j] - place[j])
    needs = similarity / (1 + similarity) * (size[i] + size[j]) - 1e-6
    return (component[i] != component[j]) & (np.minimum(size[i], size[j]) >= similarity * np.maximum(size[i], size[j]) - 1e-6) & (left >= needs)


def _told(node: np.ndarray, i, j) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(node[i], node[j])), pa.array(np.maximum(node[i], node[j]))], names=["a", "b"])


def _neighbours(similarity: float):
    """Of rows (key, size, node, place, component), sorted by key and size: each with the first of its key and with its
    neighbour, which connects most of a large group."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, size, node, place, component in _whole_keys(batches):
            size, place, i = size.astype(np.int64), place.astype(np.int64), np.arange(len(key))
            starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            first = np.repeat(starts, np.diff(np.append(starts, len(key))))
            for j in (first, np.maximum(first, i - 1)):
                ok = _can(similarity, size, place, component, i, j)
                yield _told(node, i[ok], j[ok])

    return run


def _pairs_of_few(similarity: float):
    """All pairs of rows (key, size, node, place, component), sorted by key and size, of keys with up to SMALL rows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, size, node, place, component in _whole_keys(batches):
            size, place = size.astype(np.int64), place.astype(np.int64)
            for step in range(1, min(SMALL, len(key))):
                i = np.flatnonzero(key[:-step] == key[step:])
                i = i[_can(similarity, size, place, component, i, i + step)]
                yield _told(node, i, i + step)

    return run


def _pairs_of_many(similarity: float):
    """All pairs that sketches let through, of rows (cell, size, node, place, component, block, crossed, sketch), sorted by cell
    and size.  In a cell that is crossed, rows of one block are no pairs: they meet in a cell of their own."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell, size, node, place, component, block, crossed, sketches in _whole_keys(batches):
            counts = np.frombuffer(b"".join(sketches.tolist()), np.uint8).reshape(-1, 256)
            size, place, full = size.astype(np.int64), place.astype(np.int64), (counts == 255).any(axis=1)
            ends = np.append(np.flatnonzero(cell[1:] != cell[:-1]) + 1, len(cell))
            for s, e in zip(np.concatenate(([0], ends[:-1])).tolist(), ends.tolist(), strict=True):
                for i in range(s, e - 1):
                    j = np.arange(i + 1, s + np.searchsorted(size[s:e], size[i] / similarity + 1e-6, "right"))
                    j = j[_can(similarity, size, place, component, np.full(len(j), i), j) & ~(crossed[j] & (block[j] == block[i]))]
                    needs = similarity / (1 + similarity) * (size[i] + size[j]) - 1e-6
                    j = j[full[i] | full[j] | (np.minimum(counts[j], counts[i]).sum(axis=1, dtype=np.int64) >= needs)] if len(j) else j
                    if len(j):
                        yield _told(node, np.full(len(j), i), j)

    return run


def _cells(rows: DataFrame, most: int) -> DataFrame:
    """Rows (key, n, node, ...) with the cells in which they meet others of their key: a key of more than ``most`` rows is dealt
    into blocks, and each two blocks, or one with itself, meet in a cell of their own."""
    blocks = F.ceil(F.col("n") / most).cast("int")
    dealt = rows.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cell = F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other"))
    return met.withColumn("cell", cell).withColumn("crossed", F.col("block") != F.col("other")).drop("blocks", "other")


def _shingle_sets(words_a_shingle: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = [np.unique(hashed(shingles(text.as_py(), words_a_shingle)).reshape(-1).view(">i8")).astype(np.int64) for text in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["node", "own"])

    return run


def near_copies(docs: DataFrame, *, similarity: float = 0.8, words_a_shingle: int = 5, width: int = 2, max_distance: int = 24, block_rows: int = 4096) -> DataFrame:
    """(doc_id, component_id) for every doc_id of docs (doc_id, text): documents whose sets of shingles have at least that
    Jaccard similarity are linked.

    Texts with the same words in the same order are one class.  A first round takes candidates from fingerprints of the
    distinct words.  Then come pairs that share a shingle of their prefixes and are not connected by then: first neighbours,
    which connect most of what is left of a large group, and last all of them, in cells of ``block_rows`` rows at most.  Each
    candidate pair is decided by the shingles of both texts.
    """
    ship(docs.sparkSession)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter("doc_id is not null")
    names = _columns(width)
    kinds = ["doc_id long", "sequence binary", *(f"{c} long" for c in names), "prefix array<long>", "size int", "sketch binary"]
    prints = keep(source.mapInArrow(_worded(width, words_a_shingle, similarity, _common(source, words_a_shingle, similarity)), ", ".join(kinds)), "fingerprints")
    classes = keep(prints.groupBy("sequence").agg(F.min("doc_id").alias("node"), *(F.first(c).alias(c) for c in names)), "classes")
    named = prints.select("doc_id", "sequence").join(classes.select("sequence", "node"), "sequence").groupBy("doc_id").agg(F.max(F.col("doc_id") == F.col("node")).alias("names_one"))
    copies = keep(named.filter("not names_one").select("doc_id"), "copies")
    own = without(prints.select("doc_id", "prefix", "size"), F.col("doc_id"), copies)
    places = own.select(F.col("doc_id").alias("node"), "size", F.posexplode("prefix").alias("place", "key")).select("key", "node", "size", "place")
    shared = keep(places.repartition("key").sortWithinPartitions("key").mapInArrow(_shared_keys, "key long, node long, size int, place int, n int"), "shared")

    def alike(pairs: DataFrame) -> DataFrame:
        spark = pairs.sparkSession
        pairs, pairs_path = keep_once(pairs, "pairs")
        met = keep(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct(), "met")
        sketches = among(prints.select("doc_id", "sketch"), F.col("doc_id"), met)
        of_a, of_b = (sketches.select(F.col("doc_id").alias(side), F.col("sketch").alias(f"of_{side}")) for side in "ab")
        sketched = pairs.join(of_a, "a").join(of_b, "b").select("a", "b", "of_a", "of_b")
        candidates = keep(sketched.mapInArrow(_can_be_alike(similarity), "a long, b long"), "candidates")
        discard(spark, pairs_path)
        wanted = keep(candidates.select(F.col("a").alias("doc_id")).union(candidates.select("b")).distinct(), "wanted")
        sets, path = keep_once(among(source, F.col("doc_id"), wanted).mapInArrow(_shingle_sets(words_a_shingle), "node long, own array<long>"), "shingles")
        both = candidates.join(sets.select(F.col("node").alias("a"), F.col("own").alias("of_a")), "a").join(sets.select(F.col("node").alias("b"), F.col("own").alias("of_b")), "b")
        common = F.size(F.array_intersect("of_a", "of_b"))
        found = keep(both.filter(common >= F.lit(similarity) * (F.size("of_a") + F.size("of_b") - common)).select("a", "b"), "alike")
        discard(spark, path)
        return found

    found = alike(links(classes, Ring.of(width, 5, max_distance), spare=True))
    pair = "a long, b long"

    def apart() -> DataFrame:
        """The rows of shared keys that have rows of several components by now."""
        rows = shared.join(components(found), "node", "left").select("key", "size", "node", "place", F.coalesce("component", "node").alias("component"), "n")
        several = rows.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high").select("key")
        return keep(rows.join(several, "key", "left_semi"), "apart")

    def met(rows: DataFrame, key: str, pairs) -> DataFrame:
        return rows.repartition(key).sortWithinPartitions(key, "size", "node").mapInArrow(pairs, pair)

    columns = ("size", "node", "place", "component")
    found = found.union(alike(met(apart().select("key", *columns), "key", _neighbours(similarity)).distinct()))
    rows = apart()
    few = met(rows.filter(F.col("n") <= SMALL).select("key", *columns), "key", _pairs_of_few(similarity))
    crowd = rows.filter(F.col("n") > SMALL)
    seen = keep(crowd.select(F.col("node").alias("doc_id")).distinct(), "crowd")
    sketched = crowd.join(among(prints.select("doc_id", "sketch"), F.col("doc_id"), seen).dropDuplicates(["doc_id"]).select(F.col("doc_id").alias("node"), "sketch"), "node")
    many = met(_cells(sketched, block_rows).select("cell", *columns, "block", "crossed", "sketch"), "cell", _pairs_of_many(similarity))
    found = found.union(alike(few.union(many).distinct()))
    linked = classes.join(components(found), "node", "left").select("sequence", F.coalesce("component", "node").alias("component_id"))
    return prints.select("doc_id", "sequence").join(linked, "sequence").select("doc_id", "component_id")
