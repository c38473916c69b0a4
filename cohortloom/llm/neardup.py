"""MinHash near-dedup with SetSketch registers.

A text's set is its distinct word shingles. Each element of a set is a Poisson
process that hits random registers at exponential times; a register keeps its
least time, and of that the exponent to base ``BASE``, truncated to a byte. Such
registers merge by maximum and agree with a probability that rises with the
Jaccard similarity.

1. Texts with equal sets form a class (counted before the shuffle); its smallest
   id stands for it from here on.
2. ``BANDS`` bands of ``ROWS`` registers each are keys. Within a key, members pair
   with a centre, the member that meets most others over all its keys, so a group
   of any size gives one pair a member.
3. A pair goes on if its similarity, estimated jointly from all registers and the
   two set sizes by maximum likelihood, is within ``MARGIN`` of the threshold, and
   is linked if the full sets confirm it.
4. What these links leave apart inside a key is searched in full: each member outside
   the key's largest component, against that component and the other members
   outside it, in blocks; registers, then full sets. No pair that could join two
   components is left out, and none inside a component is looked at.
5. Components of all links, by smallest id.

Shingles are 64-bit hashes of words' bytes, made by non-linear steps. A link compares
two texts' sets only, so a false match needs two of a pair's shingles to collide (under
1e-7 for sets of a million), whatever the size of the corpus; equal sets are told by
their size and two 64-bit sums. Keys, components and classes that many rows share
are joined by ``spread_join``, so none makes one task read them all.

A pair at the threshold misses all bands with a probability of about 5e-6.
Null and empty texts have empty sets and link with nothing; a text of fewer words
than a shingle is one shingle. Ids are integers; a null id counts as the smallest, so a component with
one is null and all its rows without an id are kept; rows of an id (or of none) that stands for several different texts
count as linked. Very long texts are sketched whole. Other columns
are ignored, and kept by ``keep_one``. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import components
from .kit import NOT_SPACE, NULL_ID, Spans, batch_of, cut, drop, integer_id, lookup, mix, row_of, slices, spread_join, text_bytes, windows, word_spans

SHINGLE = 5
THRESHOLD = 80  # hundredths
BANDS, ROWS = 40, 6
BASE, RATE = 1.1, 20.0
MARGIN = 0.15
BLOCK = 2000
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingles(column: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of the distinct shingles of each text, sorted by both."""
    data, offsets = text_bytes(column)
    start, end, first = word_spans(data, offsets, NOT_SPACE)
    hashes = Spans(data).hashes(start, end)
    h, at = windows(hashes, first, n)
    hs, rows = [h], [row_of(first)[at]]
    size = np.diff(first)
    for c in range(1, n):
        short = np.flatnonzero(size == c)
        if len(short):
            fold = np.full(len(short), c, dtype=np.uint64)
            for k in range(c):
                fold = mix(fold * _STEP + hashes[first[short] + k])
            hs.append(fold)
            rows.append(short)
    h, row = np.concatenate(hs), np.concatenate(rows)
    by = np.lexsort((h, row))
    h, row = h[by], row[by]
    new = np.append(True, (h[1:] != h[:-1]) | (row[1:] != row[:-1]))[: len(h)]
    return row[new], h[new]


def registers(row: np.ndarray, h: np.ndarray, n_rows: int, m: int) -> np.ndarray:
    """SetSketch registers (n_rows, m) of the elements h of each row."""
    times = np.full(n_rows * m, np.inf)
    x, t = np.zeros(len(h)), np.zeros(len(h), dtype=np.uint64)
    live, chunk = np.arange(len(h)), 1
    while len(live):
        step = np.arange(1, chunk + 1, dtype=np.uint64)
        r = mix(h[live][:, None] + (t[live][:, None] + step) * _STEP)
        arrive = x[live][:, None] + np.cumsum(-np.log(((r >> np.uint64(16)).astype(np.float64) + 0.5) / 2.0**48), axis=1) / (RATE * m)
        at = row[live][:, None] * m + (((r & np.uint64(0xFFFF)) * np.uint64(m)) >> np.uint64(16)).astype(np.int64)
        np.minimum.at(times, at.ravel(), arrive.ravel())
        x[live] = arrive[:, -1]
        t[live] += np.uint64(chunk)
        worst = times.reshape(n_rows, m).max(axis=1)
        live = live[x[live] < worst[row[live]]]
        chunk = max(1, min(64, (1 << 17) // max(1, len(live))))
    with np.errstate(divide="ignore"):
        exponent = np.floor(1 - np.log(times) / np.log(BASE))
    return np.clip(np.nan_to_num(exponent, neginf=0), 0, 255).astype(np.uint8).reshape(n_rows, m)


def estimate(k1: np.ndarray, k2: np.ndarray, n1: np.ndarray, n2: np.ndarray, steps: int = 201) -> np.ndarray:
    """Maximum likelihood Jaccard similarity of pairs of sketches (pairs, m) of sets of known sizes."""
    more, less = (k1 > k2).sum(axis=1)[:, None], (k1 < k2).sum(axis=1)[:, None]
    same = k1.shape[1] - more - less
    u = (n1 / (n1 + n2))[:, None]
    v = 1 - u
    j = np.linspace(0, 1, steps)[None, :] * np.minimum(u / v, v / u)

    def p(x):
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    a, b = p(u - v * j), p(v - u * j)
    tiny = 1e-12
    value = more * np.log(a + tiny) + less * np.log(b + tiny) + same * np.log(np.maximum(1 - a - b, 0) + tiny)
    return j[np.arange(len(j)), value.argmax(axis=1)]


def _sketch(docs: DataFrame, n: int, m: int) -> DataFrame:
    schema = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()), ("k", pa.binary())])

    def run(batches):
        for batch in slices(batches):
            row, h = shingles(batch.column("text"), n)
            size = np.bincount(row, minlength=batch.num_rows)
            first = np.searchsorted(row, np.arange(batch.num_rows + 1))
            sums = [np.append(np.uint64(0), np.cumsum(mix(h ^ np.uint64(salt)))) for salt in (1, 2)]
            s1, s2 = ((s[first[1:]] - s[first[:-1]]).view(np.int64) for s in sums)
            k = registers(row, h, batch.num_rows, m)
            yield batch_of(schema, batch.column("id"), size, s1, s2, pa.array([x.tobytes() for x in k], pa.binary()))

    return docs.mapInArrow(run, "id long, n long, s1 long, s2 long, k binary")


def _bands(batches, bands=BANDS, rows=ROWS):
    schema = pa.schema([("key", pa.int64()), ("id", pa.int64()), ("n", pa.int64())])
    for batch in batches:
        count = batch.num_rows
        k = np.frombuffer(b"".join(batch.column("k").to_pylist()), dtype=np.uint8).reshape(count, -1)
        key = np.zeros((count, bands), dtype=np.uint64)
        key += np.arange(1, bands + 1, dtype=np.uint64)[None, :]
        for r in range(rows):
            key = mix(key * _STEP + k[:, r::rows][:, :bands].astype(np.uint64) + np.uint64(1))
        each = np.repeat(np.arange(count), bands)
        yield batch_of(schema, key.ravel().view(np.int64), batch.column("id").to_numpy()[each], batch.column("n").to_numpy()[each])


def _near(a: str, b: str, threshold: int):
    """Whether sets of these sizes can be similar enough."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * threshold


def _likely(pairs: DataFrame, reps: DataFrame, threshold: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            k1, k2 = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint8).reshape(batch.num_rows, -1) for c in ("k1", "k2"))
            j = estimate(k1, k2, batch.column("n1").to_numpy().astype(float), batch.column("n2").to_numpy().astype(float))
            yield batch.select(["a", "b"]).filter(pa.array(j >= threshold / 100 - MARGIN))

    one = reps.select(F.col("id").alias("a"), F.col("n").alias("n1"), F.col("k").alias("k1"))
    two = reps.select(F.col("id").alias("b"), F.col("n").alias("n2"), F.col("k").alias("k2"))
    return pairs.join(one, "a").join(two, "b").mapInArrow(run, "a long, b long")


def _sets(docs: DataFrame, ids: DataFrame, n: int) -> DataFrame:
    """(id, s): the sorted shingle hashes of the documents in ids."""
    schema = pa.schema([("id", pa.int64()), ("s", pa.binary())])

    def run(batches):
        for batch in slices(batches):
            row, h = shingles(batch.column("text"), n)
            first = np.searchsorted(row, np.arange(batch.num_rows + 1))
            yield batch_of(schema, batch.column("id"), pa.array([h[a:b].tobytes() for a, b in zip(first, first[1:])], pa.binary()))

    return docs.join(ids, "id", "left_semi").mapInArrow(run, "id long, s binary")


def _confirm(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Pairs whose full sets are similar enough."""

    def run(batches):
        for batch in batches:
            keep = []
            for s1, s2 in zip(batch.column("s1").to_pylist(), batch.column("s2").to_pylist()):
                a, b = np.frombuffer(s1, np.uint64), np.frombuffer(s2, np.uint64)
                both = int((lookup(a, b) >= 0).sum())
                keep.append(both > 0 and 100 * both >= threshold * (len(a) + len(b) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one = sets.select(F.col("id").alias("a"), F.col("s").alias("s1"))
    two = sets.select(F.col("id").alias("b"), F.col("s").alias("s2"))
    return cut(pairs.join(one, "a").join(two, "b").select("a", "b", "s1", "s2").mapInArrow(run, "a long, b long").distinct())


def _across(apart: DataFrame, placed: DataFrame, reps: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Links between components that meet in a key.

    apart: (id, component, largest) of members of keys that hold more than one component. The members outside a
    key's largest component are the queries of that component: each is held against the component and the other
    queries, in blocks of about BLOCK documents each, first by registers and then by full sets. Only links leave a block.
    """
    queries = cut(apart.where("component <> largest").select("largest", "id", "component").distinct())
    members = placed.select("id", "component").distinct()
    wanted = members.groupBy("component").agg(F.count("*").alias("c")).join(queries.select(F.col("largest").alias("component")).distinct(), "component", "left_semi")
    wanted = cut(wanted)
    inside = spread_join(members, wanted, ["component"], "c").select(F.col("component").alias("largest"), "id", "component")
    targets = cut(inside.unionByName(queries))

    def blocks(rows, name):
        return rows.groupBy("largest").agg(F.count("*").alias("c" + name), F.ceil(F.count("*") / BLOCK).cast("int").alias(name))

    number = cut(blocks(queries, "nq").join(blocks(targets, "nt"), "largest"))
    data = reps.join(sets, "id")

    def dealt(rows, own, other, own_block, other_block, mark):
        found = spread_join(rows, number, ["largest"], "c" + own).withColumn(own_block, F.pmod(F.xxhash64("id"), F.col(own)).cast("int"))
        found = found.join(data, "id").withColumn(other_block, F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        keys = ["largest", "bq", "bt"]
        return found.select(*(F.col(c).alias(mark + c) for c in (*keys, "id", "component", "n", "k", "s"))).groupBy(*(mark + c for c in keys))

    def match(left: pa.Table, right: pa.Table) -> pa.Table:
        ids = [np.zeros(0, np.int64), np.zeros(0, np.int64)]
        if left.num_rows and right.num_rows:
            k = np.frombuffer(b"".join(right.column("t_k").to_pylist()), dtype=np.uint8).reshape(right.num_rows, -1)
            size, of, names = (right.column(f"t_{c}").to_numpy() for c in ("n", "component", "id"))
            held = [np.frombuffer(s, np.uint64) for s in right.column("t_s").to_pylist()]
            for q in left.to_pylist():
                n = q["q_n"]
                near = (of != q["q_component"]) & (100 * np.minimum(size, n) >= threshold * np.maximum(size, n))
                near = np.flatnonzero(near)
                near = near[(k[near] == np.frombuffer(q["q_k"], np.uint8)).mean(axis=1) >= threshold / 100 - MARGIN]
                if len(near):
                    count = size[near]
                    hit = lookup(np.frombuffer(q["q_s"], np.uint64), np.concatenate([held[i] for i in near])) >= 0
                    both = np.add.reduceat(hit, np.cumsum(count) - count, dtype=np.int64)
                    near = near[100 * both >= threshold * (n + count - both)]
                    ids = [np.append(ids[0], np.minimum(names[near], q["q_id"])), np.append(ids[1], np.maximum(names[near], q["q_id"]))]
        return pa.table({"a": pa.array(ids[0], pa.int64()), "b": pa.array(ids[1], pa.int64())})

    pairs = dealt(queries, "nq", "nt", "bq", "bt", "q_").cogroup(dealt(targets, "nt", "nq", "bt", "bq", "t_")).applyInArrow(match, "a long, b long")
    found = cut(pairs.distinct())
    drop(queries, wanted, targets, number)
    return found


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """One row per document: id_col, n_shingles, component_id, kept."""
    rows = docs.select(integer_id(F.col(id_col)).alias("id"), F.col(text_col).alias("text"))
    sketches = cut(_sketch(rows, shingle, BANDS * ROWS))
    classes = cut(sketches.where("n > 0").groupBy("n", "s1", "s2").agg(F.min("id").alias("rep"), F.first("k").alias("k"), F.count("*").alias("c")))
    reps = classes.select(F.col("rep").alias("id"), "n", "k")

    bands = reps.mapInArrow(_bands, "key long, id long, n long")  # made twice: less than writing 40 rows a text
    shared = bands.groupBy("key").agg(F.count("*").alias("c")).where("c > 1")
    members = cut(bands.join(shared, "key"))
    reach = members.groupBy("id").agg(F.sum("c").alias("reach"))
    centres = members.join(reach, "id").groupBy("key").agg(F.max(F.struct("reach", F.bitwise_not("id").alias("lower"), "n")).alias("x")).select("key", F.bitwise_not("x.lower").alias("centre"), F.col("x.n").alias("n2"))
    starred = members.join(centres, "key").where((F.col("id") != F.col("centre")) & _near("n", "n2", threshold))
    tried = cut(starred.select(F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b")).distinct())
    sets = cut(_sets(rows, members.select("id").distinct(), shingle))
    likely = cut(_likely(tried, reps, threshold))
    links = _confirm(likely, sets, threshold)
    drop(tried, likely)

    found = components(links)
    placed = cut(members.join(found, "id", "left").select("key", "id", F.coalesce("component", "id").alias("component")))
    sizes = placed.groupBy("key", "component").agg(F.count("*").alias("c"))
    largest = sizes.groupBy("key").agg(F.max(F.struct("c", "component")).alias("x"), F.count("*").alias("parts")).where("parts > 1").select("key", F.col("x.component").alias("largest"))
    across = _across(placed.join(largest, "key"), placed, reps, sets, threshold)
    drop(members, sets, placed)

    found = components(links.unionByName(across))
    drop(links, across)
    judged = cut(classes.select("n", "s1", "s2", "c", F.col("rep").alias("id")).join(found, "id", "left").select("n", "s1", "s2", "c", F.coalesce("component", "id").alias("component")))
    drop(classes)
    some = spread_join(sketches.where("n > 0").select("id", "n", "s1", "s2"), judged, ["n", "s1", "s2"], "c").select("id", "n", "component")
    out = some.unionByName(sketches.where("n = 0").select("id", "n", F.col("id").alias("component")))
    given = lambda c: F.when(F.col(c) != NULL_ID, F.col(c))
    return out.select(given("id").alias(id_col), F.col("n").alias("n_shingles"), given("component").alias("component_id"), (F.col("id") == F.col("component")).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """The rows of docs whose id is the smallest of its component; columns unchanged."""
    dropped = near_duplicates(docs, id_col, text_col, shingle, threshold).where("not kept").select(F.col(id_col).alias("dropped_id"))
    return docs.join(dropped, F.col(id_col).eqNullSafe(F.col("dropped_id")), "left_anti")
