"""Byte-level BPE with a distinct-word table (operator 7).

1. Scan tasks split whole texts at white space into words and write, for each block of documents, the list of its distinct
   words, dealt by their hash into ``parts``, and each document as the places of its words in that list.  A block is one
   row of a table bucketed by block.
2. The lists of all blocks meet by part.  A part's distinct words are its share of the distinct-word table, a row for each
   word of the corpus, and each is encoded once, there.
3. The table's ids are joined with the pieces of the vocabulary, which is as long as the vocabulary and no longer, and a
   word's pieces put together by position are what it decodes to.
4. Lists and table meet by part again (the lists are shuffled once for both), and each list goes back to its block as ids, in
   the order of the list.  Blocks meet them by a join to whose bucketed side nothing has to be moved, and each document's ids,
   and the bytes they decode to, are put together by position.  A word that decodes to itself sends no bytes along.

Texts are shuffled nowhere; what is shuffled is each block's distinct words and their ids, compressed, and the table.  A task
holds the distinct words of its parts and one part's lists, a share that more partitions make smaller.

A word here is a run without white space, with the space before it, or a run of white space: the vocabulary's own pattern
never matches across such borders, so a word's ids do not depend on its neighbours.  The special tokens' strings are words
of their own.  A text with characters for which this cannot be taken for granted is split by the library instead, and these
pieces go to the model as they are.

Cases: a null text counts as empty: no ids, and the decoded text is empty.  Null doc_ids and repeated rows are kept; an
empty table gives no rows; other columns are ignored, whatever their names.  A very long text is a block of its own.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.scratch import discard, keep_once, place, ship, ship_file
from tidemark.llm.word_tokens import LETTERS, ODD, lettered, quiet

#: Fixed value: the pattern of the byte-level vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: In a list of words: the byte between words, and the one before a piece that the library split off.  UTF-8 has neither.
BETWEEN, WHOLE = b"\xff", b"\xfe"
#: How hard what goes to disk is compressed.
LEVEL = 9
#: Rows of the distinct-word table that are given at a time.
ROWS = 20_000
_WORD = re.compile(r" ?\S+|\s+(?!\S)|\s+")
BLOCKS = "block long, docs array<struct<doc_id: long, n: long>>, places binary, ranks binary, words array<binary>"
ENCODED = "doc_id long, n_tokens long, ids binary, decoded string"


def _special(path: str) -> dict[str, int]:
    return {t.content: i for i, t in quiet(path).get_added_tokens_decoder().items()}


def plain(word: bytes) -> bytes:
    """A word of a list without its mark."""
    return word[1:] if word[:1] == WHOLE else word


class _Splitter:
    """The words of a text; joined without their marks they are the text."""

    def __init__(self, path: str):
        self.library = quiet(path).pre_tokenizer
        names = _special(path)
        self.names = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None

    def _words(self, text: str) -> list[str | bytes]:
        if ODD.search(text.replace("<|", "")):
            return [WHOLE + text[a:b].encode() for _, (a, b) in self.library.pre_tokenize_str(text)]
        return _WORD.findall(text)

    def __call__(self, text: str) -> list[str | bytes]:
        """Words as strings, and pieces that the library split off as marked bytes."""
        if self.names is None or "<|" not in text:
            return self._words(text)
        return [w for k, part in enumerate(self.names.split(text)) for w in ([part] if k % 2 else self._words(part) if part else [])]


def _packed(words: Iterable[bytes]) -> bytes:
    """Words as one compressed value."""
    return zstandard.compress(BETWEEN.join(words), LEVEL)


def _unpacked(value: bytes) -> list[bytes]:
    return zstandard.decompress(value).split(BETWEEN)


def _planes(numbers: np.ndarray) -> bytes:
    """Numbers as planes of bytes, the lowest first, compressed; the high planes are nearly nothing."""
    return zstandard.compress(np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), LEVEL)


def _from_planes(value: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(value), np.uint8).reshape(4, -1).T).view("<u4").reshape(-1)


def _id_kind(path: str) -> str:
    """How ids are written between executors: two bytes each if the vocabulary has no more."""
    return "<u2" if quiet(path).get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"


#: What the type of an element takes off an id, so that short ones hold all of 65,536.
BASE = {"short": 1 << 15, "int": 0}


def _element(path: str) -> str:
    return "short" if _id_kind(path) == "<u2" else "int"


def _blocks(path: str, block_chars: int, parts: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, number = _Splitter(path), TaskContext.get().partitionId() << 31
        seen: dict[str | bytes, int] = {}
        docs: list[dict] = []
        places: list[np.ndarray] = []
        chars = 0

        def block() -> pa.RecordBatch:
            nonlocal number, chars
            words = [w if isinstance(w, bytes) else w.encode() for w in seen]
            part = np.fromiter(map(zlib.crc32, words), np.uint32, len(words)) % parts
            spelt = np.array(sorted(range(len(words)), key=words.__getitem__), np.int64)  # neighbours compress each other
            order = spelt[np.argsort(part[spelt], kind="stable")]
            rank = np.empty(len(words), np.uint32)
            rank[order] = np.arange(len(words), dtype=np.uint32)
            cuts = np.searchsorted(part[order], np.arange(parts + 1)).tolist()
            lists = [_packed(words[i] for i in order[a:b].tolist()) if b > a else None for a, b in zip(cuts, cuts[1:], strict=False)]
            # documents name words by how often the block has them, which makes most numbers small
            at = np.concatenate([np.zeros(0, np.uint32), *places])
            often = np.argsort(-np.bincount(at, minlength=len(words)), kind="stable")
            frequency = np.empty(len(words), np.uint32)
            frequency[often] = np.arange(len(words), dtype=np.uint32)
            columns = [[number], [docs], [_planes(frequency[at])], [_planes(rank[often])], [lists]]
            out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _BLOCK_TYPES, strict=True)], names=["block", "docs", "places", "ranks", "words"])
            number, chars = number + 1, 0
            seen.clear()
            docs.clear()
            places.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                text = text.as_py() or ""
                words = split(text)
                for word in words:
                    if word not in seen:
                        seen[word] = len(seen)
                places.append(np.fromiter(map(seen.__getitem__, words), np.uint32, len(words)))
                docs.append({"doc_id": doc_id.as_py(), "n": len(words)})
                chars += len(text)
                if chars >= block_chars:
                    yield block()
        if docs:
            yield block()

    return run


_BLOCK_TYPES = [pa.int64(), pa.list_(pa.struct([("doc_id", pa.int64()), ("n", pa.int64())])), pa.binary(), pa.binary(), pa.list_(pa.binary())]


def encoder(path: str) -> Callable[[bytes], list[int]]:
    """The ids of a word of a list."""
    model, pattern, names = quiet(path).model, regex.compile(PATTERN), _special(path)

    def encode(word: bytes) -> list[int]:
        text = plain(word).decode()
        if text in names:
            return [names[text]]
        parts = [text] if word[:1] == WHOLE else pattern.findall(text)
        return [t.id for part in parts for t in model.tokenize(lettered(part))]

    return encode


def _distinct_words(path: str):
    """Reads lists (block, part, words); gives (part, word, ids) for each word of this task's parts once, ids less BASE."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, seen, kind = encoder(path), set(), _element(path)
        base = BASE[kind]
        for batch in batches:
            for part, words in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                fresh = sorted({*_unpacked(words.as_py())} - seen)  # neighbours have much in common, which compresses
                seen.update(fresh)
                for at in range(0, len(fresh), ROWS):
                    some = fresh[at : at + ROWS]
                    ids = pa.array(([i - base for i in encode(word)] for word in some), pa.list_({"short": pa.int16(), "int": pa.int32()}[kind]))
                    yield pa.RecordBatch.from_arrays([pa.array([part] * len(some), pa.int32()), pa.array(some, pa.binary()), ids], names=["part", "word", "ids"])

    return run


def _answered(kind: str, base: int):
    """The lists of a part (block, words) as ids: how many words, how many ids each has, and the ids, compressed; and the
    places in the list of words that decode to something else, with that."""

    def run(lists: pa.Table, table: pa.Table) -> pa.Table:
        row = {word: k for k, word in enumerate(table.column("word").to_pylist())}
        ids = table.column("ids").combine_chunks()
        ids = ids if isinstance(ids, pa.Array) else pa.concat_arrays(ids.chunks)
        starts, flat = ids.offsets.to_numpy().astype(np.int64), (ids.values.to_numpy().astype(np.int64) + base).astype(kind)
        lengths, others = np.diff(starts), table.column("other").to_pylist()
        differing = {k for k, other in enumerate(others) if other is not None}
        out, odd = [], []
        for words in lists.column("words"):
            rows = np.fromiter(map(row.__getitem__, _unpacked(words.as_py())), np.int64)
            n = lengths[rows]
            back = np.cumsum(n) - n
            chosen = flat[np.repeat(starts[rows] - back, n) + np.arange(int(n.sum()))]
            out.append(zstandard.compress(np.uint32(len(rows)).tobytes() + n.astype("<u4").tobytes() + chosen.tobytes(), LEVEL))
            odd.append([{"at": at, "decoded": others[k]} for at, k in enumerate(rows.tolist()) if k in differing] if differing else [])
        kinds = pa.list_(pa.struct([("at", pa.int32()), ("decoded", pa.binary())]))
        return pa.table({"block": lists.column("block"), "part": lists.column("part"), "ids": pa.array(out, pa.binary()), "other": pa.array(odd, kinds)})

    return run


def _documents(kind: str, digests: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for docs, places, ranks, words, answers in zip(*(batch.column(i) for i in range(5)), strict=True):
                at = _from_planes(ranks.as_py())[_from_planes(places.as_py())]
                lengths, ids, pieces = [np.zeros(0, np.int64)], [np.zeros(0, "<u4")], []
                for x in answers.as_py() or ():
                    raw, first = zstandard.decompress(x["ids"]), len(pieces)
                    count = int(np.frombuffer(raw, "<u4", 1)[0])
                    lengths.append(np.frombuffer(raw, "<u4", count, 4).astype(np.int64))
                    ids.append(np.frombuffer(raw, kind, offset=4 + 4 * count).astype("<u4"))
                    pieces += map(plain, _unpacked(words[x["part"]].as_py()))
                    for odd in x["other"]:
                        pieces[first + odd["at"]] = odd["decoded"]
                lengths, ids = np.concatenate(lengths), np.concatenate(ids)
                starts = np.cumsum(lengths) - lengths
                rows, first = [], 0
                for doc in docs.as_py():
                    own = at[first : first + doc["n"]]
                    first += doc["n"]
                    n = lengths[own]
                    total = int(n.sum())
                    back = np.cumsum(n) - n
                    chosen = ids[np.repeat(starts[own] - back, n) + np.arange(total)] if total else ids[:0]
                    rows.append((doc["doc_id"], total, chosen.tobytes(), b"".join(map(pieces.__getitem__, own.tolist())).decode(errors="replace")))
                    if len(rows) >= 1000:
                        yield _rows(rows, digests)
                        rows = []
                if rows:
                    yield _rows(rows, digests)

    return run


def _rows(rows: list[tuple], digests: bool) -> pa.RecordBatch:
    doc_ids, totals, ids, texts = zip(*rows, strict=True)
    if digests:
        ids = [hashlib.sha256(x).hexdigest() for x in ids]
        texts = [hashlib.sha256(x.encode()).hexdigest() for x in texts]
    return pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(totals, pa.int64()), pa.array(ids, pa.string() if digests else pa.binary()), pa.array(texts, pa.string())], names=["doc_id", "n_tokens", "ids", "decoded"])


def vocabulary(path: str) -> pa.Table:
    """(id, piece): the bytes of each id."""
    tokenizer = quiet(path)
    back = {letter: b for b, letter in enumerate(LETTERS)}
    pieces = {i: bytes(back[c] for c in piece) for piece, i in tokenizer.get_vocab(with_added_tokens=False).items()}
    pieces |= {i: name.encode() for name, i in _special(path).items()}
    return pa.table({"id": pa.array(pieces, pa.int32()), "piece": pa.array(pieces.values(), pa.binary())})


def decoded(table: DataFrame, pieces: DataFrame, base: int) -> DataFrame:
    """(part, word, ids, other) of a table (part, word, ids): other is what the ids decode to, null where that is the word."""
    named = table.select("part", "word", "ids", F.posexplode("ids").alias("at", "less")).withColumn("id", F.col("less").cast("int") + base).join(F.broadcast(pieces), "id", "left")
    gathered = named.groupBy("part", "word").agg(F.first("ids").alias("ids"), F.sort_array(F.collect_list(F.struct("at", "piece"))).alias("pieces"))
    text = F.aggregate("pieces", F.unhex(F.lit("")), lambda whole, x: F.concat(whole, F.coalesce(x["piece"], F.unhex(F.lit("")))))
    own = F.when(F.hex(F.substring("word", 1, 1)) == WHOLE.hex().upper(), F.expr("substring(word, 2)")).otherwise(F.col("word"))
    return gathered.withColumn("text", text).select("part", "word", "ids", F.when(F.col("text") != own, F.col("text")).alias("other"))


def round_trip(docs: DataFrame, path: str, *, block_chars: int = 16_000_000, digests: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) of docs (doc_id, text): ids are little-endian unsigned 32-bit integers.

    digests: ids and decoded are their SHA-256 in lowercase hex instead, made where the values are.
    """
    spark = ship(docs.sparkSession)
    ship_file(spark, path)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    name, where = f"tidemark_blocks_{uuid.uuid4().hex}", place(spark, "blocks")
    parts, kind = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1), _id_kind(path)
    made = source.mapInArrow(_blocks(path, block_chars, parts), BLOCKS)
    made.write.bucketBy(parts, "block").option("path", where).option("compression", "none").saveAsTable(name)
    blocks = spark.table(name)
    # one shuffle for both that read the lists: they ask for the same columns
    lists = blocks.select("block", F.posexplode("words").alias("part", "words")).filter("words is not null").repartition(parts, "part")
    base = BASE[_element(path)]
    table = lists.mapInArrow(_distinct_words(path), f"part int, word binary, ids array<{_element(path)}>").repartition(parts, "part")
    known = decoded(table, spark.createDataFrame(vocabulary(path)), base)
    answers = lists.groupBy("part").cogroup(known.groupBy("part")).applyInArrow(_answered(kind, base), "block long, part int, ids binary, other array<struct<at: int, decoded: binary>>")
    gathered = answers.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("part", "ids", "other"))).alias("answers"))
    kinds = ENCODED.replace("ids binary", "ids string") if digests else ENCODED
    result = blocks.select("block", "docs", "places", "ranks", "words").join(gathered, "block", "left").select("docs", "places", "ranks", "words", "answers").mapInArrow(_documents(kind, digests), kinds)
    out, _ = keep_once(result, "encoded")
    spark.sql(f"DROP TABLE {name}")
    discard(spark, where)
    return out
