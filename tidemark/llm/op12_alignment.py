"""Cross-tokenizer alignment by union-find over overlapping tokens (operator 12).

Two tokenizers cut the same bytes.  Tokens of one and of the other that share a byte are joined by an edge; the connected
components of that bipartite graph are the minimal groups, which end where a token of either ends.  All pairs of a group's
members are links, and a pair of ids counts once for each document that has it linked.

1. Scan tasks split a space and the text into units at white space, where neither tokenizer has a token that reaches across, and align
   each distinct unit once while a worker remembers it.  A block of documents is one row: documents as the places of their
   units in the block's list, units as the links that they bring, and the block's distinct pairs with the number of its
   documents that hold each.
2. The pairs of all blocks are added up, and each id of the first tokenizer is given its highest count.
3. Each block's pairs are joined with their counts and go back to their block, where units and then documents sum over them.

What is shuffled are the distinct pairs of each block, once to be counted and once to be told, and block rows without texts.
A block is bounded by ``block_chars``, or is one document.  A group's links are held as distinct pairs and how often each
occurs, so a long group costs its distinct ids and not its tokens.

Cases: texts that are null or empty, or that a tokenizer does not give back byte by byte (U+2581 in the text), have no tokens:
zeros and an empty string.  Null doc_ids and repeated rows are kept, each a document of its own in the counts.  Ties of the
highest count are all best.  An empty table gives no rows; other columns are ignored, whatever their names.  A very long text
is a block of its own.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tidemark.llm.op07_bpe import PATTERN
from tidemark.llm.scratch import here, keep, ship, ship_file
from tidemark.llm.word_tokens import LETTERS, ODD, lettered, quiet

#: Units begin at a space, a new line or a tab that follows something visible.
UNIT = re.compile(r"\s*\S+(?:[^\S \n\t]\s*\S*)*|\s+")
#: Units that a worker remembers, and of how many characters at most.
REMEMBERED, LONGEST = 250_000, 60
#: In a pair's number, the id of the first tokenizer stands above so many bits.
PAIR_BITS = 32
#: Links of a group beyond which its distinct ids are paired, and characters of texts that are aligned at a time.
LONG_GROUP, AT_A_TIME = 65_536, 500_000
SPACE = "▁"
LEVEL = 6
#: A character each: what stands between the ids of the two tokenizers in a group's text, and what between groups.
SEPARATORS = (";", "|")


def groups_of(a_ends: np.ndarray, b_ends: np.ndarray) -> np.ndarray:
    """The group of each token, those of a first: the connected components of the graph of overlapping tokens, by union-find.

    The ends are those of tokens that cut the same bytes.  Each stretch between two ends lies in one token of a and one of b,
    which is an edge.  A group's number is its first token of a, so groups are numbered in their order."""
    edges = np.union1d(a_ends, b_ends)
    x, y = np.searchsorted(a_ends, edges), len(a_ends) + np.searchsorted(b_ends, edges)
    parent = np.arange(len(a_ends) + len(b_ends))
    while True:
        low, high = np.minimum(parent[x], parent[y]), np.maximum(parent[x], parent[y])
        apart = low != high
        if not apart.any():
            return parent
        np.minimum.at(parent, high[apart], low[apart])  # the greater root is hung under the least that it meets
        while len(np.flatnonzero((above := parent[parent]) != parent)):
            parent = above


#: A unit as both tokenizers see it: its groups as text, how many tokens, groups and links, its linked pairs and, unless that is
#: once, how often each is linked.  Plain tuples: a worker holds very many.
Unit = tuple[str, int, int, int, int, bytes, bytes]
COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def fast_encoder(tokenizer: Tokenizer) -> tiktoken.Encoding | None:
    """The same vocabulary by ranks, if its ids are in the order of its merges; else None."""
    model = json.loads(tokenizer.to_str())["model"]
    vocab, back = model["vocab"], {letter: bytes([b]) for b, letter in enumerate(LETTERS)}
    merged = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    if merged != sorted(merged) or (merged and merged[0] != len(LETTERS)):
        return None
    return tiktoken.Encoding("tidemark", pat_str=PATTERN, mergeable_ranks={b"".join([back[c] for c in piece]): i for piece, i in vocab.items()}, special_tokens={})


class Aligner:
    """Aligns units of a space and a text; None for one that a tokenizer does not give back."""

    def __init__(self, a_path: str, b_path: str, separators: tuple[str, str] = SEPARATORS):
        self.between = separators[1]
        self.a, self.b = quiet(a_path), SentencePieceProcessor(model_file=here(b_path))
        self.fast, self.model = fast_encoder(self.a), self.a.model
        sizes = {i: len(piece) for piece, i in self.a.get_vocab(with_added_tokens=False).items()}
        if not {*LETTERS} <= self.a.get_vocab(with_added_tokens=False).keys():
            raise ValueError(f"{a_path} is not a byte-level vocabulary")
        pieces = list(map(self.b.id_to_piece, range(self.b.get_piece_size())))
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        most = max(*sizes, len(pieces)) + 1
        self.a_sizes, self.b_sizes = np.zeros(most, np.int64), np.array(list(map(len, self.b_bytes)))
        self.a_sizes[list(sizes)] = list(sizes.values())
        numbers = list(map(str, range(most)))
        #: Ids as text with what follows them: another of the group, the other tokenizer's, or the next group.
        self.another, self.other, self.next = (np.array([x + end for x in numbers], object) for end in (",", *separators))
        #: Whether no piece reaches across the beginning of a unit.
        self.cuts = not any(SPACE in p.lstrip(SPACE) or re.search(r"[ \n\t]", p) for p in pieces)
        self.alone = self.b.piece_to_id(SPACE)
        self.known: dict[str, Unit | None] = {}
        self.older: dict[str, Unit | None] = {}

    def units(self, text: str) -> list[str]:
        return UNIT.findall(" " + text) if self.cuts else [" " + text]

    def align(self, units: list[str]) -> list[Unit | None]:
        """Of distinct units; what a worker remembers is not aligned again."""
        known, older, missing = self.known, self.older, object()
        out = [known.get(u, missing) for u in units]
        absent = [k for k, unit in enumerate(out) if unit is missing]
        fresh = []
        for k in absent:
            if (unit := older.get(units[k], missing)) is missing:
                fresh.append(k)
            else:
                out[k] = unit
        for k, unit in zip(fresh, self._aligned([units[k] for k in fresh]) if fresh else (), strict=True):
            out[k] = unit
        for k in absent:
            if len(units[k]) <= LONGEST:
                if len(self.known) >= REMEMBERED:
                    self.known, self.older = {}, self.known
                self.known[units[k]] = out[k]
        return out

    def _a_ids(self, unit: str) -> list[int]:
        """By the library, piece by piece."""
        return [t.id for _, (x, y) in self.a.pre_tokenizer.pre_tokenize_str(unit) for t in self.model.tokenize(lettered(unit[x:y]))]

    def _b_ids(self, unit: str) -> list[int]:
        """The piece tokenizer adds a space itself: where a unit has none at its start, that piece is taken off."""
        if unit == " ":
            return [self.alone]
        if unit[0] == " ":
            return self.b.encode(unit[1:])
        ids = self.b.encode(unit)
        if ids[:1] != [self.alone]:
            raise ValueError(f"a piece reaches from a space into {unit[:20]!r}")
        return ids[1:]

    def _together(self, units: list[str]) -> tuple[np.ndarray, ...] | None:
        """How many ids each has in a, these, and the same in b, of units that begin with white space and end without, encoded
        as one text; None if that shows them changed."""
        whole = " a" + "".join(units)
        ends = np.cumsum([2, *(len(u.encode()) for u in units)])
        out = []
        for ids, sizes in ((self.fast.encode_ordinary(whole), self.a_sizes), (self.b.encode(whole[1:]), self.b_sizes)):
            ids = np.array(ids, np.int64)
            over = np.cumsum(sizes[ids])
            cuts = np.searchsorted(over, ends) + 1
            if over[-1] != ends[-1] or not (over[cuts - 1] == ends).all():
                return None
            out += [np.diff(cuts), ids[cuts[0] :]]
        return tuple(out) if b"".join(map(self.b_bytes.__getitem__, ids.tolist())) == whole.encode() else None

    def _aligned(self, units: list[str]) -> list[Unit | None]:
        found: list[Unit | None] = [None] * len(units)
        places, made_of = [], []
        easy = [k for k, u in enumerate(units) if not u[-1].isspace() and not ODD.search(u)] if self.fast and self.cuts else []
        hard = {*range(len(units))} - {*easy}
        for at in range(0, len(easy), 500):
            some = easy[at : at + 500]
            if (made := self._together([units[k] for k in some])) is None:
                hard |= {*some}
            else:
                places += some
                made_of.append(made)
        for k in sorted(hard):
            a_ids, b_ids = self._a_ids(units[k]), self._b_ids(units[k])
            # a byte-level vocabulary has all bytes, and spells whatever it is given
            if b"".join([self.b_bytes[i] for i in b_ids]) == units[k].encode():
                places.append(k)
                made_of.append(tuple(np.array(x, np.int64) for x in ([len(a_ids)], a_ids, [len(b_ids)], b_ids)))
        if places:
            for k, unit in zip(places, self._grouped(*map(np.concatenate, zip(*made_of, strict=True))), strict=True):
                found[k] = unit
        return found

    def _grouped(self, n_a: np.ndarray, a_ids: np.ndarray, n_b: np.ndarray, b_ids: np.ndarray) -> list[Unit]:
        """All units at once: their tokens are laid end to end, and as both tokenizers end there, no group reaches across."""
        group = groups_of(np.cumsum(self.a_sizes[a_ids]), np.cumsum(self.b_sizes[b_ids]))
        of_a, of_b = group[: len(a_ids)], group[len(a_ids) :]
        first, size_a = np.unique(of_a, return_counts=True)
        start_b = np.searchsorted(of_b, first)
        size_b = np.searchsorted(of_b, first, "right") - start_b
        # texts: tokens in the order of their groups, each with what follows it
        last_a, last_b = np.append(of_a[1:] != of_a[:-1], True), np.append(of_b[1:] != of_b[:-1], True)
        texts = np.concatenate([np.where(last_a, self.other[a_ids], self.another[a_ids]), np.where(last_b, self.next[b_ids], self.another[b_ids])])
        in_order = texts[np.argsort(group, kind="stable")].tolist()
        # links: each token of a with each of b in its group; of long groups, distinct ids and how often
        end_a, end_b, start = np.cumsum(n_a), np.cumsum(n_b), np.searchsorted(first, np.cumsum(n_a) - n_a)
        n_groups = np.append(start[1:], len(first)) - start
        long = size_a * size_b > LONG_GROUP
        own = np.searchsorted(first, of_a)
        many = np.where(long[own], 0, size_b[own])
        x = np.repeat(np.arange(len(a_ids)), many)
        y = start_b[own[x]] + np.arange(len(x)) - np.repeat(np.cumsum(many) - many, many)
        pairs, times, of_unit = a_ids[x] << PAIR_BITS | b_ids[y], np.ones(len(x), np.int64), np.searchsorted(end_a, x, "right")
        for g in np.flatnonzero(long).tolist():
            (p, np_), (q, nq) = (np.unique(ids[s : s + n], return_counts=True) for ids, s, n in ((a_ids, int(first[g]), int(size_a[g])), (b_ids, int(start_b[g]), int(size_b[g]))))
            pairs = np.concatenate([pairs, (p[:, None] << PAIR_BITS | q).reshape(-1)])
            times = np.concatenate([times, np.multiply.outer(np_, nq).reshape(-1)])
            of_unit = np.concatenate([of_unit, np.full(len(p) * len(q), np.searchsorted(end_a, first[g], "right"))])
        if long.any():
            order = np.argsort(of_unit, kind="stable")
            pairs, times, of_unit = pairs[order], times[order], of_unit[order]
        cuts = np.searchsorted(of_unit, np.arange(len(n_a) + 1)).tolist()
        links = np.bincount(np.searchsorted(end_a, first, "right"), weights=size_a * size_b, minlength=len(n_a)).astype(np.int64).tolist()
        tokens = np.concatenate(([0], end_a + end_b)).tolist()
        told = ["".join(in_order[s:e])[:-1] for s, e in zip(tokens, tokens[1:], strict=False)]
        spans, pairs = list(zip(cuts, cuts[1:], strict=False)), pairs.tobytes()
        often = [times[s:e].astype(np.uint32).tobytes() for s, e in spans] if long.any() else [b""] * len(spans)
        return list(zip(told, n_a.tolist(), n_b.tolist(), n_groups.tolist(), links, [pairs[8 * s : 8 * e] for s, e in spans], often, strict=True))


def _planes(numbers: np.ndarray) -> bytes:
    """Numbers as planes of bytes, the lowest first, compressed; the high planes are nearly nothing."""
    return zstandard.compress(np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), LEVEL)


def _from_planes(value: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(value), np.uint8).reshape(4, -1).T).view("<u4").reshape(-1)


DOC = "doc_id: long, n: long, n_a: long, n_b: long, n_groups: long, n_links: long, groups_sha256: string"
BLOCKS = f"block long, docs array<struct<{DOC}>>, places binary, sizes binary, links binary, times binary, pairs array<long>, holders array<int>"
_DOC = pa.struct([("doc_id", pa.int64()), *((c, pa.int64()) for c in ("n", "n_a", "n_b", "n_groups", "n_links")), ("groups_sha256", pa.string())])
_BLOCK_NAMES = ["block", "docs", "places", "sizes", "links", "times", "pairs", "holders"]


class _Places(dict):
    """The place of each unit in a block; a new one gets the next and is noted."""

    def __init__(self):
        self.fresh: list[str] = []

    def __missing__(self, unit: str) -> int:
        self.fresh.append(unit)
        found = self[unit] = len(self)
        return found


class _Block:
    """The units and documents of a block."""

    def __init__(self, aligner: Aligner):
        self.aligner = aligner
        self.place = _Places()
        self.units: list[Unit | None] = []
        self.told: list[str | None] = []
        self.docs: list[tuple[int | None, str]] = []
        self.places: list[np.ndarray] = []
        self.chars = 0

    def add(self, rows: list[tuple[int | None, str]]) -> None:
        split = [list(map(self.place.__getitem__, self.aligner.units(text))) if text else [] for _, text in rows]
        fresh = self.aligner.align(self.place.fresh)
        self.units += fresh
        self.told += [u and u[0] for u in fresh]
        self.place.fresh.clear()
        told = self.told
        for (doc_id, text), at in zip(rows, split, strict=True):
            self.chars += len(text)
            own = [told[k] for k in at]
            if None in own:
                at, own = [], []
            self.docs.append((doc_id, hashlib.sha256(self.aligner.between.join(own).encode()).hexdigest() if own else ""))
            self.places.append(np.array(at, np.int64))

    def row(self, number: int) -> pa.RecordBatch:
        none = np.zeros(0, np.int64)
        places, n = np.concatenate([none, *self.places]), np.fromiter(map(len, self.places), np.int64, len(self.places))
        often = np.argsort(-np.bincount(places, minlength=len(self.units)), kind="stable")  # frequent units get small numbers
        rank = np.empty(len(often), np.int64)
        rank[often] = np.arange(len(often))
        nothing: Unit = ("", 0, 0, 0, 0, b"", b"")
        _, *counts, own_pairs, own_times = zip(*[self.units[k] or nothing for k in often.tolist()] or [nothing], strict=True)
        sizes = np.fromiter((len(p) // 8 for p in own_pairs), np.int64, len(own_pairs))
        once = np.ones(1, np.uint32).tobytes()
        times = np.frombuffer(b"".join([t or once * (len(p) // 8) for p, t in zip(own_pairs, own_times, strict=True)]), np.uint32)
        pairs, links = np.unique(np.frombuffer(b"".join(own_pairs), np.int64), return_inverse=True)
        places, ends = rank[places], np.cumsum(sizes)
        holders = np.zeros(len(pairs), np.int64)
        shares = np.concatenate(([0], np.cumsum(n)))
        for s, e in zip(shares.tolist(), shares[1:].tolist(), strict=False):
            own = places[s:e]
            many = sizes[own]
            at = np.repeat(ends[own] - np.cumsum(many), many) + np.arange(int(many.sum()))
            holders[links[at]] += 1  # once, however often a pair is among the links
        docs = {"doc_id": [d for d, _ in self.docs], "n": n, "groups_sha256": [x for _, x in self.docs]}
        for c, of_unit in zip(COUNTS, counts, strict=True):
            over = np.concatenate(([0], np.cumsum(np.array(of_unit, np.int64)[places])))
            docs[c] = over[shares[1:]] - over[shares[:-1]]
        doc = pa.StructArray.from_arrays([pa.array(docs[f.name], f.type) for f in _DOC], fields=list(_DOC))
        lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (doc, pa.array(pairs, pa.int64()), pa.array(holders.astype(np.int32)))]
        planes = [pa.array([_planes(x)], pa.binary()) for x in (places, sizes, links, times)]
        return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), lists[0], *planes, *lists[1:]], names=_BLOCK_NAMES)


def _blocks(a_path: str, b_path: str, block_chars: int, separators: tuple[str, str]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, number = Aligner(a_path, b_path, separators), TaskContext.get().partitionId() << 31
        block, rows, chars = _Block(aligner), [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                rows.append((doc_id.as_py(), text.as_py() or ""))
                chars += len(rows[-1][1])
                if chars >= AT_A_TIME or block.chars + chars >= block_chars:
                    block.add(rows)
                    rows, chars = [], 0
                if block.chars >= block_chars:
                    yield block.row(number)
                    block, number = _Block(aligner), number + 1
        block.add(rows)
        if block.docs:
            yield block.row(number)

    return run


ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _documents(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of documents, from blocks and the counts of their pairs in the order of the block."""
    for batch in batches:
        for docs, places, sizes, links, times, counts, best in zip(*(batch.column(i) for i in range(7)), strict=True):
            at, n, link, often = (_from_planes(x.as_py()).astype(np.int64) for x in (places, sizes, links, times))
            count, is_best = (np.array(x.values, np.int64) if x.is_valid else np.zeros(0, np.int64) for x in (counts, best))
            ends = np.cumsum(n)
            docs = docs.as_py()
            shares = np.cumsum([0, *(d["n"] for d in docs)])
            sums = []
            for value in (is_best, count):
                over = np.concatenate(([0], np.cumsum(value[link] * often)))
                of_unit = over[ends] - over[ends - n]
                of_place = np.concatenate(([0], np.cumsum(of_unit[at])))
                sums.append(of_place[shares[1:]] - of_place[shares[:-1]])
            for first in range(0, len(docs), 5000):
                some = docs[first : first + 5000]
                own = {c: pa.array([d[c] for d in some], pa.string() if c == "groups_sha256" else pa.int64()) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")}
                own |= {c: pa.array(s[first : first + 5000]) for c, s in zip(("n_best", "count_sum"), sums, strict=True)}
                names = [c.split()[0] for c in ALIGNED.split(", ")]
                yield pa.RecordBatch.from_arrays([own[c] for c in names], names=names)


def blocks_of(docs: DataFrame, a_path: str, b_path: str, block_chars: int, separators: tuple[str, str] = SEPARATORS) -> DataFrame:
    """A row for each block of documents, kept: documents, units, links, and distinct pairs with how many documents hold each."""
    spark = ship(docs.sparkSession)
    for path in (a_path, b_path):
        ship_file(spark, path)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return keep(source.mapInArrow(_blocks(a_path, b_path, block_chars, separators), BLOCKS), "aligned")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(a, b, count, best) of all linked pairs of ids: in how many documents, and whether no other b has more with that a."""
    told = blocks.select(F.inline(F.arrays_zip("pairs", "holders")))
    counted = keep(told.groupBy("pairs").agg(F.sum("holders").alias("count")), "pairs")
    named = counted.select(F.shiftright("pairs", PAIR_BITS).cast("int").alias("a"), F.col("pairs").bitwiseAND(F.lit((1 << PAIR_BITS) - 1)).cast("int").alias("b"), "pairs", "count")
    highest = named.groupBy("a").agg(F.max("count").alias("highest"))
    return named.join(highest, "a").select("a", "b", "pairs", "count", (F.col("count") == F.col("highest")).alias("best"))


def align(docs: DataFrame, a_path: str, b_path: str, *, block_chars: int = 8_000_000, separators: tuple[str, str] = SEPARATORS) -> DataFrame:
    """A row for each row of docs (doc_id, text), with the columns of ALIGNED: how many tokens, groups and links it has, over how
    many links the a-id's most frequent partner is linked, the sum of all links' counts, and a digest of the groups.

    a_path: a byte-level vocabulary of the tokenizers library.  b_path: a model of sentencepiece that prefixes a space.
    separators: those of the groups' text, of which the digest is made."""
    blocks = blocks_of(docs, a_path, b_path, block_chars, separators)
    counts = keep(pair_counts(blocks).select("pairs", "count", "best"), "counts")
    own = blocks.select("block", F.posexplode("pairs").alias("at", "pairs")).join(counts, "pairs")
    told = F.sort_array(F.collect_list(F.struct("at", "count", F.col("best").cast("long").alias("best")))).alias("told")
    answers = own.groupBy("block").agg(told).select("block", F.col("told.count").alias("counts"), F.col("told.best").alias("best"))
    whole = blocks.drop("pairs", "holders").join(answers, "block", "left")
    return whole.select("docs", "places", "sizes", "links", "times", "counts", "best").mapInArrow(_documents, ALIGNED)
