"""Operators 11 to 13 against brute force, on odd rows, empty tables and the smallest documents."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tests.llm.conftest import texts
from tidemark.llm import op11_minhash, op12_alignment, op13_spelling, queries

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(params=["odd", "docs"])
def table(request):
    return request.getfixturevalue(request.param)


def components(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


# -- 11 ---------------------------------------------------------------------------------------------------------------

def shingle_set(text, k=5):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def brute_minhash(rows, percent=85):
    """(doc_id, n_shingles, component, kept) of rows (doc_id, text): all pairs of distinct sets."""
    sets = [frozenset(shingle_set(t)) for _, t in rows]
    names = {}
    for (i, _), s in zip(rows, sets, strict=True):
        if s and i is not None:
            names[s] = min(i, names.get(s, i))
    links = [(names[a], names[b]) for a, b in itertools.combinations(names, 2) if 100 * len(a & b) >= percent * len(a | b)]
    led = components(set(names.values()), links)
    whole = [(i, len(s), i if not s else led[names[s]] if s in names else None) for (i, _), s in zip(rows, sets, strict=True)]
    return sorted(((*r, r[0] is not None and r[0] == r[2]) for r in whole), key=repr)


def minhashed(frame, **settings):
    return sorted(map(tuple, op11_minhash.near_duplicates(frame, **settings).collect()), key=repr)


def test_minhash(table, empty):
    assert minhashed(table) == brute_minhash(texts(table))
    assert op11_minhash.near_duplicates(empty).count() == 0


def family(n, words, changed, seed):
    """Texts that share a template of which each has changed some words."""
    draw = random.Random(seed)
    template = [f"t{seed}w{k}" for k in range(words)]
    out = []
    for k in range(n):
        own = list(template)
        for at in draw.sample(range(words), changed):
            own[at] = f"x{seed}y{k}z{at}"
        out.append(" ".join(own))
    return out


def test_minhash_of_families_around_the_threshold(spark):
    """Chains, look-alikes just under the threshold and just over it, copies and short texts; bands dealt into blocks or not."""
    rows = [t for seed, (n, words, changed) in enumerate([(60, 300, 2), (60, 300, 4), (60, 300, 5), (60, 300, 6), (40, 60, 1), (30, 12, 1)]) for t in family(n, words, changed, seed)]
    base = [f"c{k}" for k in range(200)]
    rows += [" ".join(base[3 * k : 3 * k + 120]) for k in range(26)]  # each is like the next alone
    rows += ["a b c", "A  b\tc", "a b c d", "one two three four five", "one two three four five six"]
    rows = list(enumerate(rows + rows[:20] + rows[:5]))
    random.Random(1).shuffle(rows)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_minhash(rows)
    assert len({r[2] for r in want}) < len(want) - 100  # much is linked, and much is not
    for block_rows in (4096, 16):
        assert minhashed(frame, block_rows=block_rows) == want


def test_signatures_estimate_similarity():
    draw, known = random.Random(3), op11_minhash._WordHashes()
    for same, own in ((400, 0), (400, 40), (300, 100), (100, 300), (0, 400)):
        words = [f"s{draw.random()}" for _ in range(same)]
        a, b = (words + [f"{x}{draw.random()}" for _ in range(own)] for x in "ab")
        sets = [op11_minhash.shingle_set(" ".join(t), 1, known) for t in (a, b)]
        signs = [op11_minhash._words_of([op11_minhash.signature(op11_minhash.minima(s))]) for s in sets]
        jaccard = same / (same + 2 * own)
        assert len(signs[0].tobytes()) == op11_minhash.K * op11_minhash.BITS // 8
        assert abs(op11_minhash.estimate(op11_minhash.equal_parts(*signs))[0] - jaccard) < 0.12
        low = [np.unpackbits(np.frombuffer(op11_minhash.signature(op11_minhash.minima(s)), np.uint8)).reshape(-1, op11_minhash.BITS) for s in sets]
        assert op11_minhash.equal_parts(*signs)[0] == (low[0] == low[1]).all(axis=1).sum()  # bit counts are those of the parts
    assert op11_minhash.least_equal(1.0) == op11_minhash.K


def test_bands_find_what_is_as_similar_as_that():
    """Of many pairs right at the threshold, all share a band."""
    known = op11_minhash._WordHashes()
    for k in range(300):
        common, own = [f"{k}c{i}" for i in range(85)], 15
        a, b = (op11_minhash.shingle_set(" ".join(common + [f"{k}{x}{i}" for i in range(own if x == "a" else 0)]), 1, known) for x in "ab")
        one, two = (op11_minhash.band_keys(op11_minhash.minima(s)) for s in (a, b))
        assert (one == two).any() and len({*one.tolist()}) == op11_minhash.BANDS


def test_signature_candidates_follow_the_size_of_a_family(spark):
    """A group of near copies is told by pairs with hubs, not by all pairs."""
    sizes = []
    for n in (100, 400):
        frame = spark.createDataFrame(list(enumerate(family(n, 200, 1, 9))), "doc_id long, text string")
        made = []
        real = op11_minhash.keep

        def noted(df, name, made=made, real=real):
            out = real(df, name)
            if name == "candidates":
                made.append(out.count())
            return out

        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(op11_minhash, "keep", noted)
            assert {r[2] for r in minhashed(frame)} == {0}
        sizes.append(sum(made))
    assert sizes[1] <= 6 * sizes[0]


# -- 12 ---------------------------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def libraries():
    a, b = Tokenizer.from_file(BYTES), SentencePieceProcessor(model_file=PIECES)
    a.encode_special_tokens = True
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    letters = {chr(x): x for x in visible} | {chr(256 + k): x for k, x in enumerate(sorted({*range(256)} - visible))}
    return a, b, lambda i: bytes(letters[c] for c in a.id_to_token(i))


def brute_alignment(libraries, rows):
    a, b, a_bytes = libraries
    found, counts = [], Counter()
    for doc_id, text in rows:
        whole, groups = f" {text}".encode(), []
        one, two = (a.encode(f" {text}", add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        parts = [a_bytes(i) for i in one], [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in two]
        if text and all(b"".join(p) == whole for p in parts):
            ends = [list(itertools.accumulate(map(len, p))) for p in parts]
            i = j = 0
            for cut in sorted({*ends[0]} & {*ends[1]}):
                x, y = ends[0].index(cut, i) + 1, ends[1].index(cut, j) + 1
                groups.append((one[i:x], two[j:y]))
                i, j = x, y
        links = [(x, y) for g, h in groups for x in g for y in h]
        counts.update({*links})
        told = "|".join(",".join(map(str, g)) + ";" + ",".join(map(str, h)) for g, h in groups)
        found.append((doc_id, len(one) if groups else 0, len(two) if groups else 0, len(groups), links, hashlib.sha256(told.encode()).hexdigest() if groups else ""))
    best = {}
    for (x, _), n in counts.items():
        best[x] = max(n, best.get(x, 0))
    return sorted(((d, n, m, g, len(k), sum(counts[p] == best[p[0]] for p in k), sum(counts[p] for p in k), h) for d, n, m, g, k, h in found), key=repr)


def aligned(frame, **settings):
    return sorted(map(tuple, op12_alignment.align(frame, BYTES, PIECES, **settings).collect()), key=repr)


def test_alignment(libraries, table, empty):
    want = brute_alignment(libraries, texts(table))
    assert aligned(table) == want
    assert aligned(table, block_chars=2000) == want  # many blocks, of which pairs are added up
    assert op12_alignment.align(empty, BYTES, PIECES).count() == 0


ODD_TEXTS = [
    " ", "\n", "\t\t", "  ", " a", "a ", "a  b\nc\n\nd\te", "x\r\ny\r", "');\r", "\xa0 a\xa0b  c", "<|endoftext|> x<|endoftext|>", "</s> <unk>", "a▁b", "▁", "\x1c x", "a\x85b", "\n x", " \n x  ", "x　 y",
    "aaaaaaaa" * 200, "é" * 700, "​﻿", "\x00", "ﬁ ½ é",
]


def test_alignment_of_odd_texts(spark, libraries, monkeypatch):
    rows = list(enumerate(ODD_TEXTS))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert aligned(frame) == brute_alignment(libraries, rows)


def test_the_query_tells_groups_as_its_contract_says(spark, libraries, tmp_path):
    """a1,a2|b1;a3|b2,b3: a bar between the two tokenizers' ids, a semicolon between groups."""
    a, b, a_bytes = libraries
    rows = [(1, "unbelievable tokenizers, aligned"), (2, "a▁b"), (3, None), *enumerate(ODD_TEXTS, 4)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r["groups_sha256"] for r in queries.QUERIES["op12_alignment"](spark, str(tmp_path)).collect()}
    for doc_id, text in rows:
        told, x, y = [], [], []
        one, two = (a.encode(f" {text}", add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        sizes = [len(a_bytes(i)) for i in one], [1 if b.is_byte(i) else len(b.id_to_piece(i).replace("▁", " ").encode()) for i in two]
        ends = [[*itertools.accumulate(own)] for own in sizes]
        for end in sorted({*ends[0], *ends[1]}):
            x += [i for i, e in zip(one, ends[0], strict=True) if e == end]
            y += [i for i, e in zip(two, ends[1], strict=True) if e == end]
            if end in ends[0] and end in ends[1]:
                told.append(f"{','.join(map(str, x))}|{','.join(map(str, y))}")
                x, y = [], []
        without = not text or "▁" in text
        assert got[doc_id] == ("" if without else hashlib.sha256(";".join(told).encode()).hexdigest())


@pytest.mark.parametrize("long_group", [op12_alignment.LONG_GROUP, 1])
def test_units_are_aligned_as_their_text(libraries, monkeypatch, long_group):
    """Also where all groups are taken for long ones, and where nothing is encoded together."""
    monkeypatch.setattr(op12_alignment, "LONG_GROUP", long_group)
    own = op12_alignment.Aligner(BYTES, PIECES)
    slow = op12_alignment.Aligner(BYTES, PIECES)
    assert own.fast is not None and own.cuts
    slow.fast = None
    for text in ODD_TEXTS:
        units = list(dict.fromkeys(own.units(text)))
        assert "".join(own.units(text)) == f" {text}"
        told = [dict(zip(units, x.align(units), strict=True)) for x in (own, slow)]
        assert told[0] == told[1]
        whole = [told[0][u] for u in own.units(text)]
        want = brute_alignment(libraries, [(0, text)])[0]
        if None in whole:
            assert want[1:] == (0, 0, 0, 0, 0, 0, "")
        else:
            assert tuple(sum(u[k] for u in whole) for k in range(1, 5)) == want[1:5]
            assert hashlib.sha256("|".join(u[0] for u in whole).encode()).hexdigest() == want[-1]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 5), min_size=1, max_size=30), st.randoms())
def test_groups_are_what_lies_between_common_ends(sizes, draw):
    total = sum(sizes)
    cuts = sorted({*draw.sample(range(1, total + 1), draw.randint(1, total)), total})
    ends = [list(itertools.accumulate(sizes)), cuts]
    found = op12_alignment.groups_of(*(np.array(e) for e in ends)).tolist()
    common = sorted({*ends[0]} & {*ends[1]})
    number = lambda end: next(k for k, c in enumerate(common) if end <= c)
    want = [number(e) for own in ends for e in own]
    names = {}
    assert [names.setdefault(g, w) for g, w in zip(found, want, strict=True)] == want and len({*names.values()}) == len(names)


# -- 13 ---------------------------------------------------------------------------------------------------------------

def one_edit(a, b):
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_spelling(rows, least=7, least_n=2, times=10):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 31 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    words = {w: n for w, n in counts.items() if len(w) >= least and n >= least_n}
    near = defaultdict(list)
    for a, b in itertools.combinations(words, 2):
        if one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        if best and words[best] >= times * n:
            form[w] = best
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), words.get(form.get(w))))
    return sorted(out, key=repr)


def spelt(frame, **settings):
    return sorted(map(tuple, op13_spelling.variants(frame, **settings).collect()), key=repr)


def test_spelling_on_odd_rows(odd, empty):
    assert spelt(odd) == brute_spelling(texts(odd))
    assert op13_spelling.variants(empty).count() == 0


def slips(draw, words, n):
    """Words by a steep frequency, with chains of slips."""
    out = []
    for word, often in words:
        out += [word] * often
        for _ in range(n):
            at, letter = draw.randrange(len(word) + 1), draw.choice("abcéÿz")
            slip = draw.choice([word[:at] + letter + word[at:], word[:at] + word[at + 1 :], word[:at] + letter + word[at + 1 :]])
            out += [slip] * draw.choice([2, 2, 3, often // 10, often // 9 + 1])
    return out


@pytest.mark.parametrize("part_rows", [op13_spelling.AT_A_TIME, 8, 1])
def test_spelling(spark, part_rows):
    """Against all pairs, with parts that are cut once, many times, or not at all."""
    draw = random.Random(7)
    words = [("Maintenance", 400), ("maintenances", 41), ("maintenant", 40), ("bbbbbbbb", 100), ("bbbbbbb", 10), ("ÀÉÈÊËÌÍÎ", 60), ("straßenbahn", 30), ("x" * 300, 40), ("aaaaaaa", 300), ("aaaaaab", 300), ("aaaaaac", 9)]
    pool = slips(draw, words, 25)
    draw.shuffle(pool)
    rows = [(k if k % 17 else None, " ".join(pool[k::40]) + ("×÷ don't 1234567 日本語" if k % 2 else "")) for k in range(40)] + [(100, None), (101, "")]
    assert spelt(spark.createDataFrame(rows, "doc_id long, text string"), part_rows=part_rows) == brute_spelling(rows)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text("abé", min_size=1, max_size=6), unique=True, max_size=40), st.booleans())
def test_tries_find_all_near_words(words, backwards):
    n = len(words)
    i, j = op13_spelling.near_pairs(np.zeros(n, np.int64), words, np.full(n, backwards))
    want = {frozenset((a, b)) for a, b in itertools.combinations(range(n), 2) if one_edit(words[a], words[b])}
    assert {frozenset(p) for p in zip(i.tolist(), j.tolist(), strict=True)} == want


@settings(max_examples=200, deadline=None)
@given(st.text("ab", min_size=7, max_size=11), st.data())
def test_near_words_meet_in_a_part(word, data):
    """Whatever the edit, the two words share a part of the shorter one's length, however finely parts are cut."""
    at = data.draw(st.integers(0, len(word)))
    kind = data.draw(st.sampled_from(["insert", "replace"]))
    other = word[:at] + "c" + word[at + (kind == "replace") :]
    spans = [(0, len(word))]
    while any(high - low > 1 for low, high in spans):
        spans = [s for low, high in spans for s in (((low + high + (low == 0 and high == len(word)) * (len(word) % 2)) // 2, high), (low, (low + high + (low == 0 and high == len(word)) * (len(word) % 2)) // 2)) if s[0] < s[1]]
        assert any(op13_spelling.part_key(word, len(word), *s) == op13_spelling.part_key(other, len(word), *s) for s in spans)


def test_sketches_of_any_size():
    """Small sets are held against each other exactly, larger ones by a sample that never denies what is that similar."""
    draw, known = random.Random(5), op11_minhash._WordHashes()
    for n in (5, 300, 3000, 20_000):
        words = [f"{n}w{draw.random()}" for _ in range(n)]
        same = round(n * 0.93)
        sets = [op11_minhash.shingle_set(" ".join(t), 1, known) for t in (words, words[:same] + [f"{x}x" for x in words[same:]], words[: n // 2] + [f"{x}y" for x in words[n // 2 :]], words)]
        own = op11_minhash.Sketches([op11_minhash.sketch(s) for s in sets], 0.85)
        jaccard = [len({*sets[0].tolist()} & {*s.tolist()}) / len({*sets[0].tolist()} | {*s.tolist()}) for s in sets]
        ok = own.passes(0, np.array([1, 2, 3]))
        assert ok[2] and (ok[0] or jaccard[1] < 0.85) and (not ok[1] or n < 20) and max(map(len, map(op11_minhash.sketch, sets))) < 4 * 2 * op11_minhash.FINE
