"""Operators over the whole corpus: lines, substrings, near duplicates, benchmark, mixing, and the pipeline."""

import collections
import hashlib
import os
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cohortloom.llm import decontaminate, graph, kit, linededup, mixing, neardup, substrings

from .conftest import words

SPACE = " \t\n\v\f\r"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def key(line):
    return line.strip(SPACE).translate(LOWER)


def brute_lines(rows):
    holds = collections.defaultdict(set)
    for d, text in rows:
        for line in (text or "").split("\n"):
            holds[key(line)].add(d)
    out = {}
    for d, text in rows:
        lines = (text or "").split("\n")
        keep = [x for x in lines if not (len(key(x)) >= 20 and len(holds[key(x)]) >= 3 and max(holds[key(x)]) != d)]
        out[d] = (len(lines), len(lines) - len(keep), "\n".join(keep))
    return out


@pytest.mark.parametrize(("block", "few"), [(1 << 21, 1 << 21), (3, 1 << 21), (1 << 21, 0)])
def test_lines_equal_brute_force(make, odd_texts, monkeypatch, block, few):
    """Blocks of either size, and shards that are broadcast or probed by a shuffle."""
    monkeypatch.setattr(linededup, "BLOCK", block)
    monkeypatch.setattr(linededup, "BROADCAST_KEYS", few)
    monkeypatch.setattr(linededup, "SPREAD", 5)
    monkeypatch.setattr(linededup, "SHARD_KEYS", 2)
    monkeypatch.setattr(linededup, "BUCKET_DOCS", 20)
    rng = random.Random(1)
    common = ["É a shared line of some length", " É A shared LINE of some length\t", "twice only, in two documents", "short", "", "another line that many documents hold"]
    texts = ["\n".join(rng.choice(common) if rng.random() < 0.6 else " ".join(words(rng, 5)) for _ in range(rng.randrange(1, 7))) for _ in range(60)] + odd_texts + odd_texts[:3]
    rows = list(enumerate(texts))
    random.Random(3).shuffle(rows)
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in linededup.dedup(make(rows).repartition(5)).collect()}
    assert got == brute_lines(rows)


def test_lines_odd(make, clashing):
    same = "the very same line in all documents"
    docs = make([(None, same), (1, same), (7, f"{same}\nx"), (7, same)], clashing)
    rows = sorted((r.doc_id or -1, r.text) for r in linededup.dedup(docs).collect())
    assert rows == [(-1, ""), (1, ""), (7, same), (7, f"{same}\nx")]
    assert set(docs.columns) <= set(linededup.dedup(docs).columns)
    assert linededup.dedup(make([])).count() == 0


def test_perfect_hash():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 20_000).astype(np.uint64))
    assert sorted(linededup.PerfectHash(keys)(keys).tolist()) == list(range(len(keys)))
    prints, counts, last = kit.mix(keys), np.arange(3, 20_003), np.arange(20_000) * 7
    index = linededup.LineIndex(keys, prints, counts, last)
    found = index.probe(keys, prints)
    assert (found[0] == counts).all() and (found[1] == last).all()


def test_fingerprints_reject_what_is_not_in_the_index():
    """Keys outside the set land on some slot; only the fingerprint tells. Keys that share a placing hash both are found."""
    rng = np.random.default_rng(2)
    keys = np.unique(rng.integers(0, 1 << 63, 5000).astype(np.uint64))
    index = linededup.LineIndex(keys, kit.mix(keys), np.full(len(keys), 3), np.zeros(len(keys), np.int64))
    other = rng.integers(0, 1 << 63, 50_000).astype(np.uint64)
    assert (index.number(other) >= 0).mean() > 0.3 and not index.probe(other, kit.mix(other))[0].any()
    assert not index.probe(keys, kit.mix(keys) + np.uint64(1))[0].any()
    twice = linededup.LineIndex(np.array([5, 5, 6], np.uint64), np.array([1, 2, 3], np.uint64), np.array([3, 4, 5]), np.array([7, 8, 9]))
    asked = np.array([5, 5, 6, 5], np.uint64), np.array([2, 1, 3, 9], np.uint64)
    assert twice.probe(*asked)[0].tolist() == [4, 3, 5, 0] and twice.probe(*asked)[1][:3].tolist() == [8, 7, 9]


def thue_morse(n):
    """Two strings of n letters whose sums of letters times powers agree modulo 2^64 from 1,024 letters on."""
    x = "".join("ab"[k.bit_count() % 2] for k in range(n))
    return x, x.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("n", [512, 1024, 4096])
def test_texts_that_break_linear_hashes(make, n):
    x, y = thue_morse(n)
    rows = [(1, x), (2, x), (3, y)]
    assert len({int(h) for h in kit.hash_words([x, y])}) == 2
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in linededup.dedup(make(rows)).collect()} == brute_lines(rows)
    near = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(make(rows), shingle=2).collect()}
    assert near == brute_near(rows, 2) and near[3][1] == 3
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in substrings.dedup(make(rows), digest=True).collect()}
    assert got == brute_bytes(rows, 50)


def brute_bytes(rows, length):
    first = {}
    for d, text in rows:
        b = (text or "").encode()
        for i in range(len(b) - length + 1):
            w = b[i : i + length]
            first[w] = min(first.get(w, d), d)
    out = {}
    for d, text in rows:
        b = (text or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if first[b[i : i + length]] < d:
                gone[i : i + length] = b"\1" * length
        out[d] = (len(b), sum(gone), sum(1 for i in range(len(b)) if gone[i] and not (i and gone[i - 1])), hashlib.sha256(bytes(c for c, g in zip(b, gone) if not g)).hexdigest())
    return out


@pytest.mark.parametrize("block", [1 << 21, 40])
def test_substrings_equal_brute_force(make, odd_texts, monkeypatch, block):
    monkeypatch.setattr(substrings, "BLOCK", block)
    rng = random.Random(2)
    pieces = [" ".join(words(rng, rng.randrange(4, 40))) for _ in range(6)] + ["aaaa" * 40, "é" * 60]
    texts = []
    for _ in range(50):
        texts.append(" ".join(rng.choice(pieces)[rng.randrange(20) :] if rng.random() < 0.5 else " ".join(words(rng, 6)) for _ in range(rng.randrange(1, 6))))
    rows = list(enumerate(texts + odd_texts[:8] + odd_texts[9:] + texts[:5]))
    rng.shuffle(rows)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in substrings.dedup(make(rows).repartition(4), digest=True).collect()}
    assert got == brute_bytes(rows, 50)


def test_substrings_odd(make, clashing, odd_texts):
    text = " ".join(words(random.Random(4), 30))
    rows = sorted((r.doc_id if r.doc_id is not None else -1, r.n_removed == r.n_bytes, bytes(r.kept)) for r in substrings.dedup(make([(None, text), (3, text), (3, text)], clashing)).collect())
    assert [x[:2] for x in rows] == [(-1, False), (3, True), (3, True)] and rows[0][2] == text.encode()
    assert substrings.dedup(make([])).count() == 0
    long = substrings.dedup(make([odd_texts[8], odd_texts[8]])).collect()
    assert sorted(r.n_removed for r in long) == [0, len(odd_texts[8].encode())]


def test_previous_factors():
    rng = random.Random(6)
    for _ in range(100):
        n = rng.randrange(1, 30)
        doc = np.array([rng.randrange(6) for _ in range(n)])
        common = np.array([0, *(rng.choice([0, 10, 50]) for _ in range(n - 1))])
        got = substrings.previous_factors(doc, common)
        for i in range(n):
            best = 0
            for j in range(n):
                if doc[j] < doc[i]:
                    a, b = min(i, j), max(i, j)
                    best = max(best, int(common[a + 1 : b + 1].min()))
            assert got[i] == best


def brute_near(rows, n, threshold=80):
    sets = {}
    for d, text in rows:
        w = [x for x in "".join(c if c not in SPACE else " " for c in (text or "").translate(LOWER)).split(" ") if x]
        sets[d] = frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d), find(d) == d) for d in sets}


@pytest.mark.parametrize(("shingle", "block"), [(2, 2000), (2, 2), (5, 2000)])
def test_near_duplicates_equal_brute_force(make, odd_texts, monkeypatch, shingle, block):
    monkeypatch.setattr(neardup, "BLOCK", block)
    rng = random.Random(7)
    texts = []
    for _ in range(25):
        base = words(rng, rng.randrange(1, 120))
        for _ in range(rng.randrange(1, 8)):  # chains: each an edit of the one before or of the first
            texts.append(" ".join(base))
            copy = list(base)
            for _ in range(rng.randrange(0, 1 + len(copy) // 30)):
                copy[rng.randrange(len(copy))] = "new" + str(rng.random())
            base = copy if rng.random() < 0.5 else base
    rows = list(enumerate(texts + odd_texts[:8] + odd_texts[9:]))
    rng.shuffle(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(make(rows), shingle=shingle).collect()}
    expected = brute_near(rows, shingle)
    assert got == expected and sum(not e[2] for e in expected.values()) > 20
    kept = {r.doc_id for r in neardup.keep_one(make(rows), shingle=shingle).collect()}
    assert kept == {d for d, e in expected.items() if e[2]}


def test_near_duplicates_one_large_group(make):
    """Copies of one text that are further from each other than from it: all meet at it."""
    rng = random.Random(8)
    base = words(rng, 200, 100_000)
    rows = [(0, " ".join(base))]
    for d in range(1, 120):
        copy = list(base)
        for k in rng.sample(range(200), 7):
            copy[k] = f"new{d}-{k}"
        rows.append((d, " ".join(copy)))
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(make(rows), shingle=2).collect()}
    assert got == {d: e[1] for d, e in brute_near(rows, 2).items()} and set(got.values()) == {0}


def test_near_duplicates_odd(make, clashing, odd_texts):
    rows = neardup.near_duplicates(make([(None, "a b c"), (2, "A b\tc"), (2, "A b\tc"), (3, None), (4, "")], clashing), shingle=2).collect()
    assert sorted((r.doc_id or -1, r.component_id, r.kept) for r in rows) == [(-1, None, True), (2, None, False), (2, None, False), (3, 3, True), (4, 4, True)]
    assert neardup.near_duplicates(make([])).count() == 0
    assert {r.component_id for r in neardup.near_duplicates(make([odd_texts[8], odd_texts[8] + " end"])).collect()} == {0}


@pytest.mark.parametrize("without", ["centre", "edge", "two"])
def test_near_duplicates_of_rows_without_id(make, without):
    """A null id in a shared key: as the centre of a group, on its edge, and twice."""
    rng = random.Random(11)
    base = words(rng, 200, 100_000)
    rows = [(0, " ".join(base))]
    for d in range(1, 30):
        copy = list(base)
        for k in rng.sample(range(200), 7):
            copy[k] = f"new{d}-{k}"
        rows.append((d, " ".join(copy)))
    rows += [(100 + i, " ".join(words(rng, 40, 100_000))) for i in range(4)]
    none = {"centre": {0}, "edge": {7}, "two": {0, 7}}[without]
    docs = make([(None if d in none else d, t) for d, t in rows])
    got = neardup.near_duplicates(docs, shingle=2).collect()
    assert sorted(repr((r.doc_id, r.component_id, r.kept)) for r in got) == sorted(repr((None, None, True) if d in none else (d, d, True) if d >= 100 else (d, None, False)) for d, _ in rows)
    kept = neardup.keep_one(docs, shingle=2).collect()
    assert sorted(repr(r.doc_id) for r in kept) == sorted(["None"] * len(none) + [str(100 + i) for i in range(4)])


def test_sketch_estimates():
    rng = np.random.default_rng(9)
    a = rng.integers(0, 1 << 63, 1000).astype(np.uint64)
    b = np.concatenate([a[:800], rng.integers(0, 1 << 63, 200).astype(np.uint64)])
    row = np.repeat([0, 1], 1000)
    k = neardup.registers(row, np.concatenate([a, b]), 2, 960)
    assert abs(neardup.estimate(k[:1], k[1:], np.array([1000.0]), np.array([1000.0]))[0] - 800 / 1200) < 0.06
    merged = neardup.registers(np.zeros(2000, int), np.concatenate([a, b]), 1, 960)
    assert (merged[0] == k.max(axis=0)).all()


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 160)] + [(200, 201), (201, 200)]
    got = dict(graph.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert {got[i] for i in range(41)} == {0} and {got[i] for i in range(100, 160)} == {100} and got[201] == 200
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_a_hub_is_split_over_tasks(spark, monkeypatch):
    """One id with many links: each join with what is known of ids is split by size in the plan that runs."""
    few = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in few}
    for k, v in few.items():
        spark.conf.set(k, v)
    monkeypatch.setattr(graph, "SPLIT_LINKS", 0)
    try:
        links = spark.range(1, 200_001).select(F.lit(0).cast("long").alias("u"), F.col("id").alias("v"))
        both = kit.cut(links)
        least = kit.cut(both.groupBy("u").agg(F.min("v").alias("m")))
        joined = both.join(least, "u")
        assert len(joined.collect()) == 200_000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
        assert graph.components(links.withColumnsRenamed({"u": "a", "v": "b"})).where("component = 0").count() == 200_001
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_alignment_equals_brute_force():
    rng = random.Random(10)
    match, mismatch, gap = decontaminate.MATCH, decontaminate.MISMATCH, decontaminate.GAP

    def brute(a, b):
        h = np.zeros((len(a) + 1, len(b) + 1), dtype=int)
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                h[i, j] = max(0, h[i - 1, j - 1] + (match if a[i - 1] == b[j - 1] else mismatch), h[i - 1, j] + gap, h[i, j - 1] + gap)
        return h.max()

    for _ in range(150):
        a, b = (np.array([rng.randrange(4) for _ in range(rng.randrange(1, n))]) for n in (10, 25))
        score, start, end = decontaminate.align(a, b)
        assert score == brute(a, b) and (not score or brute(a, b[start:end]) == score)


def test_decontamination(make, spark, odd_texts, clashing, monkeypatch):
    rng = random.Random(11)
    items = [(i, " ".join(words(rng, 30, 5000))) for i in range(6)] + [(6, "ab cd"), (7, None), (8, "")]
    benchmark = spark.createDataFrame(items, "item_id int, text string")
    clean = [" ".join(words(rng, 100, 5000)) for _ in range(20)]
    edited = items[2][1].split()
    edited[4], edited[11], edited[20] = "new1", "new2", "new3"
    del edited[15]
    texts = [*clean, f"{clean[0]} {items[0][1]} {clean[1]}", items[1][1].upper(), f"{clean[2]} {' '.join(edited)}", *[f"{clean[3]} {items[3][1]}"] * 30, *odd_texts]
    expected = {(20, 0), (21, 1), (22, 2), *((d, 3) for d in range(23, 53))}
    for size in (20_000, 2):
        monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", size)
        docs = make(texts, clashing)
        found = decontaminate.contaminated(docs, benchmark).collect()
        assert {(r.doc_id, r.item_id) for r in found} == expected
        assert [r.score for r in found if r.doc_id == 20] == [1.0] and [(r.first_word, r.end_word) for r in found if r.doc_id == 20] == [(100, 130)]
        kept = decontaminate.clean(docs, benchmark)
        assert kept.columns == docs.columns and {r.doc_id for r in kept.select("doc_id").collect()} == set(range(len(texts))) - {d for d, _ in expected}
    assert decontaminate.contaminated(make(texts), benchmark.where("false")).count() == 0
    assert decontaminate.contaminated(make([]), benchmark).count() == 0
    assert decontaminate.contaminated(make([(None, items[0][1])]), benchmark).first().doc_id is None


def test_decontamination_of_a_widely_leaked_item(make, spark, monkeypatch):
    """Partial and edited copies are found whatever number of whole copies there is."""
    rng = random.Random(14)
    item = [f"w{k}" for k in range(40)]
    benchmark = spark.createDataFrame([(1, " ".join(item))], "item_id int, text string")
    edited = [x if k % 8 or not k else "new" for k, x in enumerate(item)]
    pad = " ".join(words(rng, 30, 5000))
    parts = [item[16:], item[:24], item[8:32], edited, edited[10:]]
    texts = [" ".join(item)] * 60 + [f"{pad} {' '.join(x)}" for x in parts] + [f"{pad} {' '.join(item[:19])}", pad]
    found = {r.doc_id: r.score for r in decontaminate.contaminated(make(texts), benchmark).collect()}
    assert set(found) == set(range(65)) and [found[i] for i in (0, 60, 61, 62)] == [1.0, 0.6, 0.6, 0.6]
    assert {r.doc_id for r in decontaminate.clean(make(texts), benchmark).select("doc_id").collect()} == {65, 66}
    (ids, items), = decontaminate.blocks(benchmark, "item_id", "text")
    block, texts = decontaminate._block(ids, items, 3), decontaminate._hashes(pa.array(texts))
    whole = decontaminate._pairs(block, *texts, 3, 0.5)
    monkeypatch.setattr(decontaminate, "HITS", 1)
    assert decontaminate._pairs(block, *texts, 3, 0.5) == whole and len(whole) == 65


def test_decontamination_equals_brute_force(make, spark):
    """All items against all whole passages, each pair by the full alignment table; items' ids are strings."""
    rng = random.Random(18)
    items = {f"q{i}": words(rng, rng.randrange(4, 14), 30) for i in range(12)}
    texts = [None, "", "one two"]
    for _ in range(50):
        text = words(rng, rng.randrange(0, 20), 30)
        for _ in range(rng.randrange(0, 3)):
            copy = list(rng.choice(list(items.values())))
            for _ in range(rng.randrange(0, 4)):
                k = rng.randrange(len(copy))
                copy[k : k + 1] = rng.choice([[], ["new"], [copy[k], "more"]])
            text += copy + words(rng, rng.randrange(0, 9), 30)
        texts.append(" ".join(text))
    got = {(r.doc_id, r.item_id): r.score for r in decontaminate.contaminated(make(texts), spark.createDataFrame([(k, " ".join(w)) for k, w in items.items()], "item_id string, text string")).collect()}
    expected = {}
    for d, text in enumerate(texts):
        own = re.findall(r"[0-9A-Za-z\u0080-\U0010ffff]+", (text or "").lower())
        for name, item in items.items():
            item = [w.lower() for w in item]
            h = np.zeros((len(item) + 1, len(own) + 1), dtype=int)
            for i in range(1, len(item) + 1):
                for j in range(1, len(own) + 1):
                    h[i, j] = max(0, h[i - 1, j - 1] + (decontaminate.MATCH if item[i - 1] == own[j - 1] else decontaminate.MISMATCH), h[i - 1, j] + decontaminate.GAP, h[i, j - 1] + decontaminate.GAP)
            seeds = {tuple(item[i : i + 3]) for i in range(len(item) - 2)} & {tuple(own[i : i + 3]) for i in range(len(own) - 2)}
            if seeds and h.max() >= decontaminate.MIN_SCORE * decontaminate.MATCH * len(item):
                expected[d, name] = h.max() / (decontaminate.MATCH * len(item))
    assert got == expected and len(got) > 40


def test_seeds_are_rare(make, spark):
    """Common n-grams are no seeds, but each run of STRETCH + n - 1 words of an item holds one; pairs are those of runs or rare n-grams."""
    rng = random.Random(19)
    common = "one of the most".split()
    items = [[*words(rng, 6, 5000), *common, *words(rng, 6, 5000)] for _ in range(30)] + [common, common + ["here"]]
    benchmark = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id int, text string")
    pad = lambda: " ".join(words(rng, 20, 5000))
    texts = [f"{pad()} {' '.join(common)} {pad()}" for _ in range(200)] + [" ".join(w) for w in items[:30]] + [" ".join(items[0])] * 400
    docs = make([*texts, None, ""])
    (ids, hashes), = decontaminate.blocks(benchmark, "item_id", "text")
    block = decontaminate._block(ids, hashes, 3)
    held, n = decontaminate._held(docs.select("text"), block, 3)
    own = [t.lower().split() for t in texts]
    grams = lambda w: {tuple(w[i : i + 3]) for i in range(len(w) - 2)}
    of = {decontaminate.windows(h, np.array([0, len(h)]), 3)[0][k]: tuple(x.lower() for x in w[k : k + 3]) for w, h in zip(items, hashes) for k in range(len(w) - 2)}
    inside = [grams(w) for w in own]
    assert n == len(texts) + 2 and held.tolist() == [sum(of[h] in g for g in inside) for h in block.seeds]
    rare = decontaminate._rare(block, held, n, 3, 0.5)
    kept = {(int(i), int(p)) for i, p in zip(rare.item, rare.place)}
    assert all(h in of for h in rare.seeds) and len(rare.first) == len(rare.seeds) + 1 and (np.diff(rare.first) > 0).all()
    assert [p for i, p in kept if i == 5] and not {(5, 6), (5, 7)} & kept and {(0, p) for p in (0, 1, 12, 13)} <= kept
    for i, w in enumerate(items):
        places, stretch = range(len(w) - 2), min(decontaminate.STRETCH, max(1, (len(w) + 1) // 2 - 2))
        assert all({(i, q) for q in places[p : p + stretch]} & kept for p in range(len(places) - stretch + 1))
    found = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, benchmark).collect()}
    assert {(200 + i, i) for i in range(30)} | {(d, 0) for d in range(230, 630)} | {(d, i) for d in range(630) for i in (30, 31)} == found


def test_decontamination_by_items_without_id(make, spark):
    rng = random.Random(16)
    items = [" ".join(words(rng, 20, 5000)) for _ in range(3)]
    benchmark = spark.createDataFrame([(None, items[0]), (None, items[1]), (4, items[2])], "item_id int, text string")
    docs = make([*items, " ".join(words(rng, 40, 5000))])
    assert {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, benchmark).collect()} == {(0, None), (1, None), (2, 4)}
    assert [r.doc_id for r in decontaminate.clean(docs, benchmark).collect()] == [3]


def walk(rows, target, seed="mix", weight=lambda k: 8 + k):
    """Copies of each row of one source, from the definition: (id, size) in, a list of copies out."""
    classes = [s.bit_length() for _, s in rows]
    lo, hi = 0.0, 3.0
    for _ in range(200):  # the factor by halving
        c = (lo + hi) / 2
        lo, hi = (c, hi) if sum(min(3, c * weight(k)) * s for k, (_, s) in zip(classes, rows)) < target else (lo, c)
    e = [min(3, lo * weight(k)) if s else 0 for k, (_, s) in zip(classes, rows)]
    out = [int(x + 1e-9) for x in e]
    due = target - sum(w * s for w, (_, s) in zip(out, rows))

    def rank(i):
        u = (int(hashlib.md5(f"{rows[i][0]}{seed}".encode()).hexdigest()[:12], 16) + 0.5) / 2**48
        p = e[i] - out[i]
        q = u / (1 - u) / (p / (1 - p)) if p > 1e-9 else None
        return q

    for q, _, i in sorted((rank(i), rows[i][0], i) for i in range(len(rows)) if rank(i) is not None):
        if rows[i][1] <= due:
            out[i], due = out[i] + 1, due - rows[i][1]
    return out, e


def test_mixing_targets(make, monkeypatch):
    rows = [(i, "w " * 10, "en", "a") for i in range(50)] + [(100 + i, "w " * 10, "en", "b") for i in range(5)] + [(200, "w " * 7, "en", None), (201, None, "en", None), (202, "", "en", "e")]
    got = mixing.mix(make(rows))
    by = {r.source: r for r in got.groupBy("source").agg(F.first("target").alias("target"), F.sum("taken").alias("taken"), F.max("copies").alias("copies"), F.first("source_size").alias("s")).collect()}
    total = 557
    assert by["b"].target == 150 and by["e"].target == 0 and by[None].target == 21
    assert by["a"].target == pytest.approx(total - 171) and abs(by["a"].taken - by["a"].target) < 10
    assert by["b"].taken == 150 and by[None].taken == 21 and max(r.copies for r in by.values()) <= 3
    order = lambda df: sorted(map(repr, df.collect()))
    assert order(got) == order(mixing.mix(make(rows).repartition(7)))
    monkeypatch.setattr(mixing, "FEW_SOURCES", 1)
    assert order(got) == order(mixing.mix(make(rows)))


@pytest.mark.parametrize("buckets", [1024, 3])
def test_mixing_equals_its_definition(make, monkeypatch, buckets):
    """Unlike documents, one far longer than what is left, and few ranges with many rows each."""
    monkeypatch.setattr(mixing, "BUCKETS", buckets)
    rng = random.Random(15)
    rows = [(i, "w " * int(2 ** rng.uniform(0, 9)), "en", "a") for i in range(150)] + [(999, "w " * 5000, "en", "a")]
    rows += [(6000 + i, "w " * int(2 ** rng.uniform(0, 8)), "en", None) for i in range(80)]
    rows += [(7000 + i, "w " * (7 + i % 3), "en", "c") for i in range(300)] + [(8000, "", "en", "c"), (8001, None, "en", "c")]
    got = mixing.mix(make(rows)).collect()
    assert len(got) == len(rows)
    for source in ("a", None, "c"):
        mine = sorted((r for r in got if r.source == source), key=lambda r: r.doc_id)
        copies, expected = walk([(r.doc_id, r.size) for r in mine], mine[0].target)
        assert [r.copies for r in mine] == copies and [r.expected for r in mine] == pytest.approx(expected)
        missing = mine[0].target - sum(r.taken for r in mine)
        assert 0 <= missing and all(r.size > missing for r in mine if r.size and r.copies == int(r.expected) and r.expected % 1)


def test_mixing_walks_in_few_steps(spark, monkeypatch):
    """A long document stops the front early and 100,000 short ones go through what it leaves: a step a binary digit at most."""
    steps = []
    take = mixing._step
    monkeypatch.setattr(mixing, "_step", lambda *x: steps.append(1) or take(*x))
    docs = spark.range(100_000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (1 + F.col("id") % 3).cast("int")).alias("text"), F.lit("a").alias("source"))
    long = spark.range(5).select((F.lit(1 << 40) + F.col("id")).alias("doc_id"), F.repeat(F.lit("w "), F.lit(70_000)).alias("text"), F.lit("a").alias("source"))
    other = docs.limit(2000).withColumn("source", F.lit("b"))
    got = mixing.mix(docs.unionByName(long).unionByName(other), weights=(1, 1)).cache()
    for r in got.groupBy("source").agg(F.first("target").alias("target"), F.sum("taken").alias("taken")).collect():
        assert 0 <= r.target - r.taken < 1 or r.source == "b"
    assert 1 < len(steps) <= (70_000).bit_length() + 1
    got.unpersist()


def test_mixing_inclusion(make):
    """Over many seeds each size class is taken about as often as its expected copies say, longer ones oftener; order is not that of the random numbers."""
    rows = [(i, "w " * (1, 2, 4, 8, 16)[i // 2 % 5], "en", "ab"[i % 2]) for i in range(400)]
    docs = make(rows)
    taken, expected = collections.Counter(), {}
    for seed in range(8):
        for r in mixing.mix(docs, seed=str(seed)).collect():
            taken[r.source, r.size] += r.copies / (8 * 40)
            expected[r.source, r.size] = r.expected
    assert len(set(expected.values())) > 5
    for k, e in expected.items():
        assert abs(taken[k] - e) < 0.08
        assert e <= expected[k[0], 16] and (k[1] == 16 or e < expected[k[0], 16] or e == 3)


def test_mixing_odd(make, odd_texts, clashing):
    rows = mixing.mix(make([(5, x) for x in odd_texts], clashing)).collect()
    assert len(rows) == len(odd_texts) and all(r.taken <= 3 * r.size for r in rows)
    assert mixing.mix(make([])).count() == 0
    assert {r.taken for r in mixing.mix(make(["", None])).collect()} == {0}


def test_pipeline(make, spark, tmp_path, odd_texts, clashing):
    rng = random.Random(12)
    say = {"en": "the of and to in is".split(), "fr": "le la de et un une".split()}
    texts = [(i, " ".join(rng.choice(say[lang]) + " " + " ".join(words(rng, 3, 5000)) for _ in range(15)), lang, f"s{i % 4}") for i, lang in enumerate(["en", "fr"] * 20)]
    item = " ".join(words(random.Random(13), 25, 9000))
    texts += [(100, texts[0][1] + " the", "en", "s0"), (101, f"{texts[2][1]} {item}", "en", "s1"), *((200 + i, t, "en", None) for i, t in enumerate(odd_texts))]
    make(texts, clashing).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs, kept = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert name == "source_mixing" or out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = {r.doc_id for r in docs.collect()}
    assert set(range(40)) <= kept["language_id"] and not kept["language_id"] & {200, 201, 202, 206, 209}
    assert kept["line_dedup"] == kept["language_id"]
    assert kept["line_dedup"] - kept["near_dedup"] >= {100} and set(range(40)) <= kept["near_dedup"]
    assert kept["near_dedup"] - kept["decontamination"] == {101}
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == kept["source_mixing"]
    empty = docs.limit(0).select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0


def test_pipeline_stages_on_repeated_and_null_ids(make, spark, tmp_path, clashing):
    """Every stage gives each row at most once, and the same on a rerun."""
    rng = random.Random(21)
    text = lambda n: " ".join(words(rng, n, 3000))
    rows = [(1, text(5), "en", "a"), (1, text(50), "en", "a"), (1, text(50), "en", "b"), (None, text(20), "en", "a"), (None, text(20), "en", "a"), (None, text(9), "en", None), (2, "same words here " * 3, "en", "a"), (2, "same words here " * 3, "en", "a"), (3, None, "en", "a"), (4, "", None, "b")]
    rows += [(10 + i, text(30), "en", "ab"[i % 2]) for i in range(12)]
    docs = make(rows, clashing)
    spark.createDataFrame([(1, rows[-1][1]), (None, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    taken = {}
    for name, stage in corpus_pipeline.STAGES:
        out = [tuple(r) for r in stage(spark, docs, str(tmp_path)).select("doc_id", "text", "source").collect()]
        again = [tuple(r) for r in stage(spark, docs.repartition(5), str(tmp_path)).select("doc_id", "text", "source").collect()]
        assert sorted(map(repr, out)) == sorted(map(repr, again)) and len(out) <= len(rows)
        taken[name] = out
    left = collections.Counter((i, t, s) for i, t, _, s in rows)
    for name in ("language_id", "near_dedup", "decontamination", "source_mixing"):
        assert not collections.Counter(taken[name]) - left
    assert len(taken["line_dedup"]) == len(rows) and len(taken["decontamination"]) == len(rows) - 1
    mixed = corpus_pipeline.mix_sources(spark, docs, str(tmp_path)).collect()
    assert all(r.size == len((r.text or "").split()) and r.taken == r.copies * r.size > 0 for r in mixed)
    assert set(docs.columns) - {"size", "target"} <= set(mixed[0].asDict())


def test_language_stage_rejects_what_no_language_holds(make, spark):
    rng = random.Random(22)
    rows = [(i, " ".join(words(rng, 60)), "en", "s") for i in range(40)]
    odd = [(100, " ".join(f"qz{chr(97 + rng.randrange(26))}x{chr(97 + rng.randrange(26))}w" for _ in range(200)), None, "s"), (101, "zq xw", None, "s")]
    kept = {r.doc_id for r in corpus_pipeline.identify_language(spark, make(rows + odd), "").collect()}
    assert kept == set(range(40)) | {101}  # two words tell too little to go


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no tables")
def test_queries_on_tables(spark):
    from cohortloom.llm import queries

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
    for name, query in queries.QUERIES.items():
        n = query(spark, "/root/testdata/sf0.001").count()
        assert n == docs or name == "op3_decontaminate"
    held = queries.op8_language(spark, "/root/testdata/sf0.01").where("held_out").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), "doc_id")
    assert held.where("lang_pred = lang").count() / held.where("lang is not null").count() > 0.97
    held = queries.op1_toxicity(spark, "/root/testdata/sf0.01").where("held_out").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id")
    assert held.where("predicted = toxic").count() / held.count() > 0.93


def test_components_take_few_shuffles_below_the_limit(spark, monkeypatch):
    """A thread of the driver stays for each shuffle of the last minute; both forms of a round give the same."""
    import random

    from cohortloom.llm import graph

    rng = random.Random(3)
    pairs = [(0, k) for k in range(1, 60)] + [(k, k + 1) for k in range(100, 140)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    links = spark.createDataFrame(pairs, "a long, b long")
    number = spark.sparkContext._jsc.sc().newShuffleId
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a != b:
            parent[max(root(a), root(b))] = min(root(a), root(b))
    used = {}
    for limit in (1 << 22, 0):
        monkeypatch.setattr(graph, "SPLIT_LINKS", limit)
        began = number()
        got = {r.id: r.component for r in graph.components(links).collect()}
        used[limit] = number() - began
        assert got == {x: root(x) for x in parent}
    assert 3 * used[1 << 22] <= 2 * used[0]
