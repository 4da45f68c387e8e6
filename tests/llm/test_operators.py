"""Each operator against brute force, on odd rows, empty tables and the smallest documents."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.conftest import texts
from tidemark.llm import graph, op01_sharding, op02_simhash, op03_exact, op04_tokens, op05_quality, op06_licenses, op07_bpe, op08_packing, op09_media, op10_lines, scratch

BYTES, WORDS, RANKS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json", "byte_bpe_50k.tiktoken"))


@pytest.fixture(params=["odd", "docs"])
def table(request):
    return request.getfixturevalue(request.param)


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


# -- 1 ----------------------------------------------------------------------------------------------------------------

def jump(key: int, shards: int) -> int:
    key, at, following = key % 2**64, -1, 0
    while following < shards:
        at = following
        key = (key * 2862933555777941757 + 1) % 2**64
        following = int((at + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return at


def test_sharding(table, empty):
    found = op01_sharding.shard(table, 16).collect()
    want = sorted(((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), "key", jump(i or 0, 16), jump(i or 0, 17)) for i, t in texts(table)), key=repr)
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"], r["law"], r["shard"], r["grown_shard"]) for r in found), key=repr) == want
    slots = defaultdict(list)
    for r in found:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert op01_sharding.shard(empty).count() == 0


def test_lanes_are_even_whatever_the_ids(spark):
    """Ids in strides of the lanes, and null ids, do not meet in one lane: slots stay gapless and the lanes even."""
    frame = spark.range(4000).select(F.when(F.col("id") % 3 > 0, F.col("id") * 1024).alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    found = op01_sharding.shard(frame, 4)
    for r in found.groupBy("shard").agg(F.min("slot"), F.max("slot"), F.countDistinct("slot"), F.count("*")).collect():
        assert (r[1], r[2], r[3]) == (0, r[4] - 1, r[4])
    lanes = [r["count"] for r in frame.groupBy(F.pmod(F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(1024)) + F.pmod(F.crc32("text"), F.lit(1024)), F.lit(1024))).count().collect()]
    assert max(lanes) < 20


def test_jump_hash_of_any_key_and_many_shards(spark):
    keys = [0, 1, -1, 2**63 - 1, -(2**63), *map(int, np.random.default_rng(0).integers(-(2**63), 2**63, 200))]
    frame = spark.createDataFrame([(k,) for k in keys], "k long")
    for shards in (1, 2, 1000, 100_000):
        found = {r["k"]: r["s"] for r in frame.select("k", op01_sharding.jump_hash(F.col("k"), shards)["shard"].alias("s")).collect()}
        assert found == {k: jump(k, shards) for k in keys}
    with pytest.raises(ValueError):
        op01_sharding.jump_hash(F.col("k"), 0)


# -- 2 ----------------------------------------------------------------------------------------------------------------

def brute_fingerprint(text, k):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def classes(items, linked):
    """Least item reachable, by item."""
    root = {i: i for i in items}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {i: find(i) for i in items}


def test_simhash(table, empty):
    prints = {(i, brute_fingerprint(t, 4)) for i, t in texts(table)}
    ids = {i: f for i, f in prints if i is not None}
    pairs = [(a, b) for a in ids for b in ids if a < b and (ids[a] ^ ids[b]).bit_count() <= 4]
    groups = classes(ids, pairs)
    for i, fp, component in op02_simhash.near_duplicates(table).distinct().collect():
        assert (i, fp % 2**64) in prints
        if i is not None:
            assert component == groups[i]
    assert op02_simhash.near_duplicates(table).count() == table.count()
    assert op02_simhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize(("max_distance", "bucket_rows"), [(0, 20_000), (1, 20_000), (2, 20_000), (4, 20_000), (6, 20_000), (4, 30), (2, 7)])
def test_links_are_complete(spark, max_distance, bucket_rows):
    """Random fingerprints around a few centres, so that buckets are small, large, and dealt into blocks."""
    draw = np.random.default_rng(max_distance)
    centres = draw.integers(0, 2**63, 6, dtype=np.uint64)
    values = {int(c) for c in centres}
    for _ in range(600):
        bits = draw.choice(64, draw.integers(0, 6), replace=False)
        values.add(int(centres[draw.integers(6)]) ^ sum(1 << int(b) for b in bits))
    values = sorted(values)
    frame = spark.createDataFrame([(k, v - 2**64 if v >> 63 else v) for k, v in enumerate(values)], "node long, fp0 long")
    ring = op02_simhash.Ring.of(1, max(3, max_distance + 1), max_distance)
    edges = [tuple(r) for r in op02_simhash.links(frame, ring, bucket_rows=bucket_rows).collect()]
    assert all((values[a] ^ values[b]).bit_count() <= max_distance for a, b in edges)
    want = [(a, b) for a in range(len(values)) for b in range(a) if (values[a] ^ values[b]).bit_count() <= max_distance]
    assert classes(range(len(values)), edges) == classes(range(len(values)), want)


def shingle_set(text):
    words = (text or "").lower().split()
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_near_copies(spark, odd, empty):
    draw = np.random.default_rng(1)
    rows_, k = [], 0
    for group in range(30):
        words = [f"w{draw.integers(5000)}" for _ in range(200)]
        for copy in range(5):
            changed = list(words)
            for at in draw.choice(200, copy, replace=False):
                changed[at] = f"new{draw.integers(10**6)}"
            rows_.append((k, " ".join(changed)))
            k += 1
    found = dict(map(tuple, op02_simhash.near_copies(spark.createDataFrame(rows_, "doc_id long, text string")).collect()))
    sets = {i: shingle_set(t) for i, t in rows_}
    pairs = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    want = classes(sets, pairs)
    assert sum(found[a] == found[b] for a, b in pairs) >= 0.95 * len(pairs)
    assert all(want[i] == want[c] for i, c in found.items())  # nothing else is linked
    groups = dict(map(tuple, op02_simhash.near_copies(odd).distinct().collect()))
    assert groups[5] == groups[6] == groups[7] == groups[-5] == -5 and groups[4] == groups[14] == 4 and groups[1] == groups[2] == groups[3] == 1
    assert op02_simhash.near_copies(empty).count() == 0


def test_crowds_in_cells(spark):
    """A key of many rows is dealt into cells, in which each pair of them meets once."""
    rows = spark.range(300).select(F.lit(7).cast("long").alias("key"), F.lit(300).alias("n"), F.col("id").alias("node"))
    for most in (1000, 100, 70):
        met = Counter()
        cells = defaultdict(list)
        for r in op02_simhash._cells(rows, most).collect():
            cells[r["cell"]].append(r)
        for own in cells.values():
            met.update((a["node"], b["node"]) for a in own for b in own if a["node"] < b["node"] and not (b["crossed"] and a["block"] == b["block"]))
            assert len(own) <= 2.6 * most
        assert len(met) == 300 * 299 // 2 and set(met.values()) == {1}


@pytest.mark.parametrize("block_rows", [4096, 500])
def test_near_copies_of_one_template(spark, block_rows):
    """Revisions of pages that all have the template in common are found, though the pages are no copies of each other."""
    draw = np.random.default_rng(5)
    template = [f"t{k}" for k in range(180)]
    # nine in ten words are the template's, so the fingerprints are near; but half of the shingles have a word of the page
    pages = [[w for k in range(20) for w in (*template[9 * k : 9 * k + 9], f"p{i}x{k}")] for i in range(2100)]
    revised = {i: [*page[:150], *(f"r{i}x{k}" for k in range(6)), *page[150:]] for i, page in enumerate(pages) if i % 20 == 0}
    rows_ = [(i, " ".join(p)) for i, p in enumerate(pages)] + [(10_000 + i, " ".join(p)) for i, p in revised.items()]
    frame = spark.createDataFrame([rows_[k] for k in draw.permutation(len(rows_))], "doc_id long, text string")
    found = dict(map(tuple, op02_simhash.near_copies(frame, block_rows=block_rows).collect()))
    assert found == {i: i % 10_000 for i, _ in rows_}


def test_near_copies_cut_or_extended(spark):
    """All pairs at the border are found, whatever the edit: passages that are cut off or added, and changed words."""
    draw = np.random.default_rng(11)
    rows_ = []
    for k in range(600):
        words = [f"w{x}" for x in draw.integers(0, 20_000, int(draw.choice([60, 200, 600])))]
        share = float(draw.choice([0.1, 0.15, 0.19]))
        rows_ += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(words[: round(len(words) * (1 - share))]))]
    sets = dict((i, shingle_set(t)) for i, t in rows_)
    near = {i for i in range(0, 1200, 2) if len(sets[i] & sets[i + 1]) >= 0.8 * len(sets[i] | sets[i + 1])}
    found = dict(map(tuple, op02_simhash.near_copies(spark.createDataFrame(rows_, "doc_id long, text string")).collect()))
    assert len(near) > 500 and {i for i in range(0, 1200, 2) if found[i + 1] == i} == near


def test_near_copies_of_documents(spark):
    """All pairs of a table of documents, by their sets of shingles."""
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    ids, sets, owners = [], [], defaultdict(list)
    for i, t in texts(table):
        ids.append(i)
        sets.append(shingle_set(t))
        for s in sets[-1] or {""}:
            owners[s].append(len(ids) - 1)
    met = {(a, b) for own in owners.values() if len(own) > 1 for a in own for b in own if a < b}
    near = [(ids[a], ids[b]) for a, b in met if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    assert len(near) > 30
    assert dict(map(tuple, op02_simhash.near_copies(table).collect())) == classes(ids, near)


def test_components(spark):
    draw = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in draw.integers(0, 300, (200, 2))] + [(1000 + k, 1001 + k) for k in range(40)] + [(5000, k) for k in range(5001, 5100)]
    found = dict(map(tuple, graph.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    want = classes({x for e in edges for x in e}, edges)
    assert found == {i: c for i, c in want.items() if sum(1 for v in want.values() if v == c) > 1}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


# -- 3 ----------------------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("capacity", [65_536, 4])
def test_exact(table, empty, capacity):
    found = op03_exact.deduplicate(table, capacity=capacity).collect()
    groups = defaultdict(list)
    for i, t in texts(table):
        groups[t or ""].append(i)
    top = {t: max(ids, key=lambda i: (i is not None, i or 0)) for t, ids in groups.items()}
    want = sorted(((i, top[t or ""], len(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in texts(table)), key=repr)
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in found), key=repr) == want
    kept = Counter(r["text_sha256"] for r in found if r["kept"])
    assert set(kept.values()) == {1} and len(kept) == len(groups)
    assert all(r["doc_id"] == r["keep_id"] for r in found if r["kept"])
    assert op03_exact.deduplicate(empty).count() == 0


def test_exact_compares_what_it_is_told(odd):
    found = op03_exact.deduplicate(odd, normalise=F.lower).filter("doc_id in (5, 7)").select("group_size").distinct().collect()
    assert [r[0] for r in found] == [5]


def test_directory(spark):
    """It doubles until no bucket is overfull, however skewed the keys; a bucket that is split has more than the capacity."""
    keys = spark.range(4000).select(F.when(F.col("id") < 3000, F.xxhash64("id").bitwiseAND(F.lit((1 << 54) - 1))).otherwise(F.xxhash64("id")).alias("h"))
    capacity = 100
    addresses, depth = op03_exact.directory(keys, capacity)
    assert depth > 10
    prefixes = Counter((r[0] % 2**64) >> (64 - depth) for r in keys.collect())
    found = addresses.collect()
    assert {r["address"] for r in found} == prefixes.keys()
    for address, local, bucket in found:
        assert bucket == address >> (depth - local) << (depth - local)
        assert sum(n for p, n in prefixes.items() if p >> (depth - local) == address >> (depth - local)) <= capacity
        if local:
            assert sum(n for p, n in prefixes.items() if p >> (depth - local + 1) == address >> (depth - local + 1)) > capacity


def test_collisions_are_chained(spark, monkeypatch):
    """Texts with one hash stand in one chain, and each row finds its own link."""
    monkeypatch.setattr(op03_exact.F, "xxhash64", lambda *columns: F.length(F.coalesce(columns[0].cast("string") if not isinstance(columns[0], str) else F.col(columns[0]), F.lit(""))).cast("long"))
    rows_ = [(k, f"{'abc'[k % 3]}{'x' * (k % 4)}") for k in range(40)]
    found = op03_exact.deduplicate(spark.createDataFrame(rows_, "doc_id long, text string"), capacity=2).collect()
    groups = defaultdict(list)
    for i, t in rows_:
        groups[t].append(i)
    assert sorted((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in found) == [(i, max(groups[t]), len(groups[t]), i == max(groups[t])) for i, t in rows_]


def test_only_repeated_texts_move(spark):
    """Texts reach a shuffle behind the bit map alone, whatever the number of repeated keys."""
    frame = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.when(F.col("id") < 2990, F.col("id")).otherwise(1)).alias("text"))
    keys = spark.createDataFrame([("text 1",)], "text string").select(F.xxhash64("text").alias("h"))
    marked = scratch.likely(frame.withColumn("h", F.xxhash64("text")), F.col("h"), keys, "again")
    assert marked.filter("again").count() < 40 and marked.filter("again and text = 'text 1'").count() == 11
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


# -- 4 ----------------------------------------------------------------------------------------------------------------

def greedy(word, pieces, longest):
    at = n = 0
    while at < len(word):
        size = next((k for k in range(min(longest, len(word) - at), 0, -1) if word[at : at + k] in pieces), 0)
        if not size:
            return op04_tokens.UNKNOWN
        at, n = at + size, n + 1
    return n


@settings(max_examples=300, deadline=None)
@given(st.sets(st.binary(min_size=1, max_size=5).map(lambda b: bytes(97 + x % 3 for x in b)), min_size=1), st.binary(min_size=1, max_size=14).map(lambda b: bytes(97 + x % 3 for x in b)))
def test_longest_match(pieces, word):
    assert op04_tokens.Automaton(pieces).count(word) == greedy(word, pieces, 5)


def test_token_counts(table, empty):
    pieces = {*op04_tokens.vocabulary(RANKS)}
    longest = max(map(len, pieces))
    want = []
    for i, t in texts(table):
        counts = [greedy(b" " + w, pieces, longest) for w in (t or "").encode().split()]
        want.append((i, len(counts), sum(n if n > 0 else 1 for n in counts), counts.count(op04_tokens.UNKNOWN)))
    assert rows(op04_tokens.count_tokens(table, RANKS)) == sorted(want, key=repr)
    assert op04_tokens.count_tokens(empty, RANKS).count() == 0


# -- 5 ----------------------------------------------------------------------------------------------------------------

def test_quality(spark, odd, empty):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = op05_quality.fit(docs, labels)
    found = {r["doc_id"]: r["score"] for r in op05_quality.score(docs, model).collect()}
    truth = {r["doc_id"]: r["quality"] for r in labels.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1}
    assert sum((found[i] >= 0.5) == bool(q) for i, q in truth.items()) >= 0.97 * len(truth)
    again = op05_quality.fit(docs.repartition(5), labels)
    assert np.allclose(again.weights, model.weights)
    scores = op05_quality.score(odd, model).collect()
    assert len(scores) == odd.count() and all(0 <= r["score"] <= 1 for r in scores)
    kept = op05_quality.accepted(odd, model)
    assert kept.columns == odd.columns and kept.count() == sum(r["score"] >= 0.5 for r in scores)
    assert op05_quality.score(empty, model).count() == 0
    for label in (0, 1):
        one_kind = op05_quality.fit(docs, labels.filter(F.col("quality") == label))
        assert {round(r["score"], 6) for r in op05_quality.score(odd, one_kind).collect()} == {float(label)}
        assert op05_quality.accepted(odd, one_kind).count() == label * odd.count()
    none = op05_quality.fit(empty, labels.limit(0))
    assert {r["score"] for r in op05_quality.score(odd, none).collect()} == {0.5} and op05_quality.accepted(odd, none).count() == odd.count()


def test_quality_of_labels_that_disagree_or_repeat(spark, docs):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").select("doc_id", "quality")
    model = op05_quality.fit(docs, labels)
    again = op05_quality.fit(docs.union(docs), labels.union(labels))
    assert np.allclose(again.weights, model.weights) and again.threshold == pytest.approx(model.threshold)
    both = op05_quality.fit(docs, labels.union(labels.withColumn("quality", 1 - F.col("quality"))))
    assert np.abs(both.weights).max() < 0.5 < np.abs(model.weights).max()  # nothing is preferred on the whole


def test_preferences_are_the_best_weights():
    """No step from the fitted weights makes the Bradley-Terry loss over the same pairs smaller."""
    draw = np.random.default_rng(8)
    x = draw.normal(size=(300, 4))
    y = (x @ [2.0, -1.0, 0.5, 0.0] + draw.normal(size=300) > 0).astype(int)
    model = op05_quality.preferences(x, y, float((y == 0).mean()), ridge=1e-3)
    z = np.clip((x - x.mean(axis=0)) / (x.std(axis=0) + 1e-9), -8, 8)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    pick = np.random.default_rng(0)
    winners = np.concatenate([np.repeat(good, 8), pick.choice(good, len(bad) * 8)])
    losers = np.concatenate([pick.choice(bad, len(good) * 8), np.repeat(bad, 8)])

    def loss(w):
        return sum(math.log1p(math.exp(-m)) for m in ((z[winners] - z[losers]) @ w).tolist()) / len(winners) + 5e-4 * float(w @ w)

    least = loss(model.weights)
    assert all(loss(model.weights + 0.01 * step) > least for step in [*np.eye(4), *-np.eye(4), *draw.normal(size=(10, 4))])
    scores = model.raw(x)
    assert abs((scores < model.threshold).mean() - (y == 0).mean()) < 0.02


# -- 6 ----------------------------------------------------------------------------------------------------------------

def test_licenses(spark, odd, empty):
    filler = " ".join(f"w{k}" for k in range(37))
    cases = {k: f"{filler[: 3 * k]} {notice.upper()} {filler}" for k, (_, notice) in enumerate(op06_licenses.TEMPLATES)}
    cases |= {100: filler, 101: "Released under the", 102: "Licensed under the Apache License, Version 1.0."}
    found = defaultdict(set)
    for i, name, containment, _ in op06_licenses.scan(spark.createDataFrame(list(cases.items()), "doc_id long, text string")).collect():
        assert containment >= 0.8
        found[i].add(name)
    assert all(op06_licenses.TEMPLATES[k][0] in found[k] for k in range(len(op06_licenses.TEMPLATES)))
    assert not found.keys() & {100, 101, 102}
    assert op06_licenses.scan(odd).count() == 0 and op06_licenses.scan(empty).count() == 0 and op06_licenses.scan(odd, []).count() == 0


def brute_licenses(rows_, templates):
    """Every window of every text against every template, on sets of shingles."""
    import regex

    def words_of(text):
        return [w for w in regex.split(r"[^\p{L}\p{N}]+", (text or "").lower()) if w]

    def shingles(words):
        return [" ".join(words[i : i + 5]) for i in range(len(words) - 4)]

    best = {}
    for doc_id, text in rows_:
        words = words_of(text)
        own = shingles(words)
        for name, notice in templates:
            wanted = set(shingles(words_of(notice)))
            size = len(wanted)
            pace = max(1, size // 4)
            for start in range(0, len(own), pace):
                begin = max(0, start - pace // 2)
                share = len(wanted & set(own[begin : start + size + pace // 2])) / size
                if share >= 0.8 and (-share, begin) < best.get((doc_id, name), (0, 0)):
                    best[doc_id, name] = (-share, begin)
    return sorted(((i, name, -lacks, begin) for (i, name), (lacks, begin) in best.items()), key=repr)


def test_licenses_of_odd_rows(spark):
    """Null and repeated ids, ties, a very long text of many notices, and whole licences with changed words."""
    draw = np.random.default_rng(6)
    notices = [t for t in op06_licenses.TEMPLATES if len(t[1].split()) >= 6]
    long_text = " ".join(f"{' '.join(f'w{x}' for x in draw.integers(0, 900, 40))} {notices[k % len(notices)][1]}" for k in range(400))
    mit = dict((len(n), n) for name, n in notices if name == "MIT")
    whole = max(mit.items())[1].split()
    changed = [w if k not in (40, 100) else "other" for k, w in enumerate(whole)]
    one = notices[0][1]
    rows_ = [(None, f"x {one}"), (1, f"a b {one} c {one}"), (1, f"a b {one} c {one}"), (2, long_text), (3, " ".join(changed)), (4, " ".join(["before"] * 7 + whole[:60])), (None, None), (5, "")]
    frame = spark.createDataFrame(rows_, "doc_id long, text string").withColumns({"hits": F.lit("x"), "size": F.lit(2), "key": F.lit(3)})
    assert rows(op06_licenses.scan(frame, notices)) == brute_licenses(rows_, notices)


def test_short_license_templates(spark):
    templates = [("rights", "All rights reserved."), ("MIT", "Released under the MIT License."), ("CC0", "CC0")]
    texts_ = [(1, "x y. ALL RIGHTS  reserved! z"), (2, "all rights"), (3, "All rights reserved"), (4, "all x rights reserved"), (5, None), (6, "cc0, released under the MIT license"), (7, "all all rights reserved, all rights reserved")]
    found = op06_licenses.scan(spark.createDataFrame(texts_, "doc_id long, text string"), templates)
    assert rows(found.select("doc_id", "license", "containment", "at_word")) == [(1, "rights", 1.0, 2), (3, "rights", 1.0, 0), (6, "CC0", 1.0, 0), (6, "MIT", 1.0, 1), (7, "rights", 1.0, 1)]
    with pytest.raises(ValueError):
        op06_licenses.scan(found.selectExpr("doc_id", "license AS text"), [("none", "...")])


# -- 7 ----------------------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("block_chars", [16_000_000, 50])
def test_bpe(table, empty, block_chars):
    tokenizer = Tokenizer.from_file(BYTES)
    want = []
    for i, t in texts(table):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), np.array(ids, "<u4").tobytes(), tokenizer.decode(ids, skip_special_tokens=False)))
    got = [(r[0], r[1], bytes(r[2]), r[3]) for r in op07_bpe.round_trip(table, BYTES, block_chars=block_chars).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert op07_bpe.round_trip(empty, BYTES).count() == 0


ENCODE, LIBRARY = op07_bpe.encoder(BYTES), Tokenizer.from_file(BYTES)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("abZ'sdmtrevl 0.1,!\n\t\r  éßµ²½­漢😀<|endoftxar>\x1c\x85"))))
def test_words_encode_as_the_library_does(text):
    from tidemark.llm.word_tokens import WordTokenizer

    words = WordTokenizer.of(WORDS)
    assert np.frombuffer(words.encode(text), "<u4").tolist() == words.tokenizer.encode(text, add_special_tokens=False).ids
    listed = [w if isinstance(w, bytes) else w.encode() for w in op07_bpe._Splitter(BYTES)(text)]
    assert b"".join(map(op07_bpe.plain, listed)) == text.encode()
    assert [i for w in listed for i in ENCODE(w)] == LIBRARY.encode(text, add_special_tokens=False).ids


def test_a_word_of_many_blocks_is_encoded_once(spark, monkeypatch):
    """The table has each word once, and what a word decodes to comes from the join with the vocabulary."""
    words = [b" the", b"the", b" don't", op07_bpe.WHOLE + " größe".encode(), b"<|endoftext|>"]
    lists = [(k, 0, op07_bpe._packed(some)) for k, some in enumerate((words[:3], words[1:], words))]
    table = spark.createDataFrame(lists, "block long, part int, words binary").coalesce(1).mapInArrow(op07_bpe._distinct_words(BYTES), "part int, word binary, ids array<short>")
    base = op07_bpe.BASE["short"]
    assert sorted(bytes(r["word"]) for r in table.collect()) == sorted(words)
    pieces = spark.createDataFrame(op07_bpe.vocabulary(BYTES))
    assert all(r["other"] is None for r in op07_bpe.decoded(table, pieces, base).collect())
    changed = pieces.withColumn("piece", F.when(F.col("piece") == F.encode(F.lit(" the"), "UTF-8"), F.encode(F.lit("X"), "UTF-8")).otherwise(F.col("piece")))
    assert {bytes(r["word"]): r["other"] and bytes(r["other"]) for r in op07_bpe.decoded(table, changed, base).collect()} == {w: b"X" if w == b" the" else None for w in words}


# -- 8 ----------------------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("capacity", [2048, 50])
def test_packing(table, empty, capacity):
    tokenizer = Tokenizer.from_file(WORDS)
    want = []
    for i, t in texts(table):
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        want += [(i, k, s, len(part := ids[s : s + capacity]), zlib.crc32(part.tobytes())) for k, s in enumerate(range(0, len(ids), capacity))]
    found = op08_packing.pack(table.repartition(7), WORDS, capacity, fan_in=2).collect()
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found), key=repr) == sorted(want, key=repr)
    sequences = defaultdict(list)
    for r in found:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    _, _, plain = op08_packing.best_fit([w[3] for w in want], capacity)
    assert len(sequences) <= 1.02 * len(plain) + 2
    assert op08_packing.pack(empty, WORDS).count() == 0


@pytest.mark.parametrize("case", ["just above half", "few small ones last", "any"])
def test_nothing_that_could_be_filled_is_left(spark, case):
    """Bins over half full in all groups but the last, which alone has the small ones."""
    draw, capacity, groups = np.random.default_rng(4), 2048, 40
    pieces = []
    for group in range(groups):
        low, high = {"just above half": (1025, 1040), "few small ones last": (1025, 1026) if group < groups - 1 else (1000, 1001), "any": (1, 2049)}[case]
        lengths = draw.integers(low, high, 100 if low == 1000 else 300).tolist()
        bins, at, fills = op08_packing.best_fit(lengths, capacity)
        pieces += [((group << op08_packing.BIN_BITS) + b, o, fills[b], n) for b, o, n in zip(bins, at, lengths, strict=True)]
    frame = spark.createDataFrame([p[:3] for p in pieces], "bin long, at long, fill long")
    moved = {r["bin"]: (r["top"], r["base"]) for r in op08_packing.merged(frame, capacity, slack=4, fan_in=4, block_pieces=1000).collect()}
    sequences = defaultdict(list)
    for b, at, _, n in pieces:
        top, base = moved.get(b, (b, 0))
        sequences[top].append((base + at, n))
    for parts in sequences.values():
        assert [o for o, _ in sorted(parts)] == np.cumsum([0, *(n for _, n in sorted(parts))])[:-1].tolist() and sum(n for _, n in parts) <= capacity
    plain = len(op08_packing.best_fit([p[3] for p in pieces], capacity)[2])
    assert len(sequences) <= (1.03 if case == "any" else 1.01) * plain


def test_rounds():
    assert [op08_packing.rounds(n, 4) for n in (1, 2, 4, 5, 16, 17)] == [1, 1, 1, 2, 2, 3]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 20)))
def test_best_fit(lengths):
    bins, offsets, fills = op08_packing.best_fit(lengths, 20)
    assert sum(fills) == sum(lengths) and all(0 < f <= 20 for f in fills)
    for b, fill in enumerate(fills):
        parts = sorted((offsets[i], lengths[i]) for i in range(len(lengths)) if bins[i] == b)
        assert [o for o, _ in parts] == np.cumsum([0, *(n for _, n in parts)])[:-1].tolist() and sum(n for _, n in parts) == fill
    assert sum(2 * f <= 20 for f in fills) <= 1


# -- 9 ----------------------------------------------------------------------------------------------------------------

def tune(seed, seconds):
    draw = np.random.default_rng(seed)
    notes = np.repeat(220 * 2 ** (draw.integers(0, 24, int(seconds * 25)) / 12), op09_media.RATE // 25)
    wave = np.sin(2 * np.pi * np.cumsum(notes) / op09_media.RATE)
    return wave


def pcm(wave):
    return bytes(np.clip(np.rint(wave * 80 + 128), 0, 255).astype(np.uint8))


def linked_somewhere(a, b):
    """Whether any grids of two recordings are linked at any offset."""
    return any(
        op09_media.agreement(x, y, ahead, 0.1)[0] for x in a for y in b for ahead in range(-len(y) + op09_media.WIDTH, len(x) - op09_media.WIDTH + 1)
    )


def test_media(spark):
    base = tune(0, 3)
    noisy = base + np.random.default_rng(9).normal(0, 0.02, len(base))
    shift = 25 * op09_media.HOP
    off_grid = base[shift + 13 :]
    recordings = [
        (0, pcm(base)), (1, pcm(base)), (2, pcm(noisy)), (3, pcm(base[shift:])), (4, pcm(tune(5, 3))), (5, b""), (6, None), (7, b"short"), (8, pcm(base)), (9, pcm(off_grid)),
        (10, b"short"), (11, pcm(base[:900])), (12, pcm(base[:900])), (None, pcm(base)), (13, pcm(tune(6, 3))), (13, pcm(noisy)), (14, b"\x80" * 9000), (15, b"\x80" * 8000),
    ]
    frame = spark.createDataFrame(recordings, "id long, audio binary").withColumn("hub_id", F.lit(1)).withColumn("marks", F.lit("x"))
    found = op09_media.align(frame, F.col("id"), F.col("audio")).collect()
    assert sorted(r["id"] for r in found) == sorted(i for i, _ in recordings if i is not None)
    by_id = {r["id"]: r for r in found if r["id"] != 13}
    assert {i: r["class_id"] for i, r in by_id.items()} == {0: 0, 1: 0, 8: 0, 2: 2, 3: 3, 4: 4, 5: None, 6: None, 7: 7, 10: 7, 9: 9, 11: 11, 12: 11, 14: 14, 15: 15}
    assert {i: r["group_id"] for i, r in by_id.items()} == {0: 0, 1: 0, 8: 0, 2: 0, 3: 0, 9: 0, 4: 4, 5: None, 6: None, 7: 7, 10: 7, 11: 11, 12: 11, 14: 14, 15: 15}
    assert {r["group_id"] for r in found if r["id"] == 13} == {0}
    assert (by_id[3]["hub_id"], by_id[3]["shift"], by_id[3]["error"]) == (0, -shift, 0.0) and by_id[0]["hub_id"] is None and by_id[0]["n_links"] == 0
    assert abs(by_id[9]["shift"] + shift + 13) <= 4
    a, b = (op09_media.fingerprints_of([dict(recordings)[k]])[0][0] for k in (0, 2))
    assert by_id[2]["shift"] == 0 and by_id[2]["error"] == pytest.approx(np.bitwise_count(a ^ b).sum() / 32 / len(a), abs=0.01)


def test_media_of_long_recordings_and_ties(spark):
    """An excerpt of a long recording is found where it was cut out; of two places that fit alike, the nearer one counts."""
    long_one, verse = tune(11, 40), tune(12, 1)
    twice = np.concatenate([verse, tune(13, 1)[:8008], verse])  # sevenths of a hop apart
    recordings = [(0, pcm(long_one)), (1, pcm(long_one[200_000:212_000])), (2, pcm(twice)), (3, pcm(verse))]
    found = {r["id"]: r for r in op09_media.align(spark.createDataFrame(recordings, "id long, audio binary"), F.col("id"), F.col("audio")).collect()}
    assert found[1]["group_id"] == 0 and abs(found[1]["shift"] + 200_000) <= 4 and found[1]["best_error"] < 0.1
    assert found[3]["group_id"] == 2 and found[3]["hub_id"] == 2 and found[3]["shift"] == 0


def test_media_on_odd_rows(odd, empty):
    audio = F.encode("text", "UTF-8")
    found = op09_media.align(odd, F.col("doc_id"), audio).collect()
    assert sorted(r["id"] for r in found) == sorted(i for i, _ in texts(odd) if i is not None)
    groups = {r["id"]: r["group_id"] for r in found}
    assert groups[5] == groups[6] == groups[-5] == -5 and groups[4] == groups[14] == 4 and groups[1] is None and groups[2] is None
    assert op09_media.align(empty, F.col("doc_id"), audio).count() == 0


def test_media_finds_what_brute_force_finds(spark, docs):
    """All pairs, grids and offsets: nearly every linked pair is in one group, and nothing else is."""
    draw, recordings = np.random.default_rng(5), []
    prose = [t.encode() for _, t in texts(docs) if t and 1200 < len(t.encode()) < 3000]
    for k in range(8):
        text, wave = prose[k], tune(k, 0.8)
        edited = bytearray(text)
        for at in draw.choice(len(edited), 8, replace=False):
            edited[at] = 97 + int(draw.integers(26))
        louder, noisy, cut = wave * 0.6, wave + draw.normal(0, 0.1, len(wave)), wave[int(draw.integers(1, 2000)) :]
        recordings += [text, text[int(draw.integers(1, 200)) :], text[: len(text) * 4 // 5], bytes(edited), pcm(wave), pcm(louder), pcm(noisy), pcm(cut)]
    prints = op09_media.fingerprints_of(recordings)
    # recordings of one tune or text are all held against each other, and each against one of every other
    pairs = [(i, j) for j in range(len(prints)) for i in range(j) if i // 4 == j // 4 or i % 4 == (j // 4) % 4 == j % 4]
    fine = {k: op09_media.fingerprints_of([r], 4)[0] for k, r in enumerate(recordings) if len(r) < op09_media.SHORT}  # the second scale
    links = [(i, j) for i, j in pairs if linked_somewhere(prints[i], prints[j]) or (i in fine and j in fine and linked_somewhere(fine[i], fine[j]))]
    want = classes(range(len(prints)), links)
    found = {r["id"]: r["group_id"] for r in op09_media.align(spark.createDataFrame(list(enumerate(recordings)), "id long, audio binary"), F.col("id"), F.col("audio")).collect()}
    assert len(links) > 60 and sum(found[i] == found[j] for i, j in links) >= 0.9 * len(links)
    assert all(want[i] == want[c] for i, c in found.items())


def test_a_mark_that_all_recordings_share_has_two_hubs(spark):
    """A recording's candidates are twice as many as its marks at most, however many recordings share them."""
    base = tune(1, 0.3)
    for many in (40, 160):
        recordings = [(k, pcm(base + np.random.default_rng(k).normal(0, 0.01, len(base)))) for k in range(many)]
        prints = op09_media.fingerprints(spark.createDataFrame(recordings, "id long, audio binary"), F.col("id"), F.col("audio"))
        links = op09_media.alignments(prints, 0.1).collect()
        assert {r["id"] for r in links} == set(range(1, many))
        assert len(links) <= 20 * many  # ten with each of the two hubs


def test_grids_differ_by_every_seventh_of_a_hop():
    step = op09_media.HOP // 7
    assert {(a - b) % op09_media.HOP for a in op09_media.PHASES for b in op09_media.PHASES} == set(range(0, op09_media.HOP, step))


def test_fingerprints_do_not_depend_on_their_batch():
    some = [pcm(tune(k, 1 + k / 3)) for k in range(5)]
    together = op09_media.fingerprints_of([b"", *some, b"x"])[1:-1]
    for a, r in zip(together, some, strict=True):
        assert all((x == y).all() for x, y in zip(a, op09_media.fingerprints_of([r])[0], strict=True))
        assert all((x == y).all() for x, y in zip(a, op09_media._restored(op09_media._stored(a)), strict=True))


# -- 10 ---------------------------------------------------------------------------------------------------------------

def brute_lines(table, ratio, least):
    pages = [(i, t, h) for i, t, h in table]
    totals, counts = Counter(h or "" for _, _, h in pages), Counter()
    for _, t, h in pages:
        for line in {x for x in (t or "").split("\n") if x.strip(" ")}:
            counts[h or "", line] += 1
    out = []
    for i, t, h in pages:
        lines = (t or "").split("\n")
        rest = [x for x in lines if not (counts[h or "", x] >= least and counts[h or "", x] > ratio * totals[h or ""])]
        acts = t is not None and len(rest) < len(lines) and any(x.strip(" ") for x in rest)
        out.append((i, "\n".join(rest) if acts else t, len(lines) - len(rest) if acts else 0))
    return sorted(out, key=repr)


def test_lines(spark, odd, empty):
    draw = np.random.default_rng(2)
    pages = [(k, "\n".join(["menu", *(f"line {x}" for x in draw.integers(0, 40, 6)), "", "menu" if k % 2 else " "]), f"h{k % 3}" if k % 10 else None) for k in range(120)]
    pages += [(500 + k, "menu", "h1") for k in range(3)] + [(600, None, "h1"), (601, "", "h2"), (602, "menu", "alone")]
    frame = spark.createDataFrame(pages, "doc_id long, text string, source string")
    for ratio in (0.1, 0.3):
        got = op10_lines.drop_boilerplate(frame, ratio=ratio, dropped="n").select("doc_id", "text", "n")
        assert rows(got) == brute_lines(pages, ratio, 5)
    kept = op10_lines.drop_boilerplate(odd)
    assert kept.columns == odd.columns and rows(kept) == rows(odd)
    assert op10_lines.drop_boilerplate(empty).count() == 0
