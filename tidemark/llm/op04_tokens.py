"""Token counts by a linear longest-match automaton (operator 4).

Greedy word-piece tokenisation takes, from the left, the longest piece of the vocabulary at each point of a word.  The
vocabulary is a trie with failure links: where a node has no child for the next byte, its failure link leads to the node
that stands for what is left after the pieces that are then certain, and the node knows how many those are.  One pass over
a word's bytes so gives its number of pieces, without building one.

Pieces at the start of a word begin with a space in the vocabulary; all others continue a word.  Words are what stands
between ASCII white space.  A word that cannot be matched to its end counts as one unknown token.

Each Python worker builds the automaton once and remembers the counts of words that take at most ``REMEMBERED`` bytes; a word
longer than ``LONG`` is counted each time it comes.

Cases: a null or empty text has no words and no tokens.  Null doc_ids and repeated rows are kept; an empty table gives no
rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64
from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.scratch import here, ship, ship_file

ROOT, NOWHERE = 0, -1
UNKNOWN = -1
#: Bytes; a word takes OVERHEAD besides its own.
REMEMBERED, LONG, OVERHEAD = 64_000_000, 1000, 100
_made: dict[str, PieceCounts] = {}


def vocabulary(path: str) -> list[bytes]:
    """The pieces of a file of ranks: a piece in base64 and its rank on each line."""
    with open(here(path), "rb") as lines:
        return [base64.b64decode(line.split()[0]) for line in lines if line.strip()]


class Automaton:
    """children: (node << 8 | byte) to node; fail and popped: by node."""

    def __init__(self, pieces: Iterable[bytes]):
        children: dict[int, int] = {}
        parents, whole = [(NOWHERE, 0)], [False]
        for piece in pieces:
            node = ROOT
            for byte in piece:
                at = node << 8 | byte
                if at not in children:
                    children[at] = len(parents)
                    parents.append((node, byte))
                    whole.append(False)
                node = children[at]
            whole[node] = node != ROOT
        self.children = children
        self.fail, self.popped = [NOWHERE] * len(parents), [0] * len(parents)
        below: dict[int, list[int]] = {}
        for node, (parent, _) in enumerate(parents):
            below.setdefault(parent, []).append(node)
        waiting = deque(below.get(ROOT, ()))
        while waiting:
            node = waiting.popleft()
            waiting.extend(below.get(node, ()))
            parent, byte = parents[node]
            if whole[node]:
                self.fail[node], self.popped[node] = ROOT, 1
                continue
            state, popped = self.fail[parent], self.popped[parent]
            while state != NOWHERE and (state << 8 | byte) not in children:
                popped += self.popped[state]
                state = self.fail[state]
            if state != NOWHERE:
                self.fail[node], self.popped[node] = children[state << 8 | byte], popped

    def count(self, word: bytes) -> int:
        """The number of pieces of a word, or UNKNOWN."""
        children, fail, popped = self.children, self.fail, self.popped
        node, n = ROOT, 0
        for byte in word:
            while (following := children.get(node << 8 | byte)) is None:
                n += popped[node]
                node = fail[node]
                if node == NOWHERE:
                    return UNKNOWN
            node = following
        while node != ROOT:
            n += popped[node]
            node = fail[node]
            if node == NOWHERE:
                return UNKNOWN
        return n


class PieceCounts(dict):
    """The counts of words, made when they are first asked for."""

    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton, self.held = automaton, 0

    def __missing__(self, word: bytes) -> int:
        n = self.automaton.count(b" " + word)
        if len(word) <= LONG:
            if self.held > REMEMBERED:
                self.clear()
                self.held = 0
            self[word] = n
            self.held += OVERHEAD + len(word)
        return n


def _counted(path: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _made:
            _made[path] = PieceCounts(Automaton(vocabulary(path)))
        counts = _made[path]
        for batch in batches:
            words, tokens, unknown = [], [], []
            for text in batch.column(1):
                found = list(map(counts.__getitem__, (text.as_py() or "").encode().split()))
                missed = found.count(UNKNOWN)
                words.append(len(found))
                unknown.append(missed)
                tokens.append(sum(found) + 2 * missed)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, pa.int64()) for x in (words, tokens, unknown))], names=["doc_id", "n_words", "n_tokens", "n_unknown"])

    return run


def count_tokens(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """(doc_id, n_words, n_tokens, n_unknown) for docs (doc_id, text)."""
    ship_file(ship(docs.sparkSession), vocabulary_path)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(_counted(vocabulary_path), "doc_id long, n_words long, n_tokens long, n_unknown long")
