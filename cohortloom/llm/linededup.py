"""Line dedup with a sharded minimal perfect hash over distinct line hashes.

A line's key is the line stripped of white space at both ends, A-Z lower-cased.
Keys of at least ``min_length`` code points that at least ``min_docs`` documents
hold lose all their lines but those in the largest id that holds them.

1. A key is known by two independent 64-bit hashes of its bytes. Tasks count, in
   blocks, the documents of each key and its largest id; Spark adds the blocks up and
   keeps the keys of at least ``min_docs`` documents. This is the one shuffle of hashes.
2. Those keys are dealt to shards of about ``SHARD_KEYS``. A shard numbers its keys by
   a minimal perfect hash of the first hash and fills arrays in that order: the second
   hash as a fingerprint, the count of documents, the largest id.
3. Documents probe the arrays where they are read; no line is joined and no document
   shuffled. The shards are broadcast if all together hold at most ``BROADCAST_KEYS``
   keys. Beyond that only the keys of the widest spread are (fewer than ``SPREAD``); for
   the others the documents' hashes go to the shards as probes, packed, and what is
   to be dropped comes back by buckets of ids.

Null and empty texts are one empty line and keep it. Ids are integers; a null id
counts as the smallest. Rows that share an id count as a document each, and all
those with the largest id keep their lines. A very long line is a line like others.
Other columns stay, but for n_lines, n_dropped and kept_sha256, which are replaced.
An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .kit import NOT_SPACE, Spans, batch_of, by_part, cut, integer_id, line_spans, mix, pack, prime_above, row_of, slices, text_bytes, unpack

MIN_LENGTH = 20
MIN_DOCS = 3
BLOCK = 1 << 21
SHARD_KEYS = 1 << 18
BROADCAST_KEYS = 1 << 21
SPREAD = 1000
BUCKET_DOCS = 5000


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys: levels of bits, a key at the first level where it is alone."""

    def __init__(self, keys: np.ndarray, gamma: float = 2.0):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        self.size, used, k = len(keys), 0, 0
        while len(keys):
            width = 64 * (int(gamma * len(keys)) // 64 + 1)
            at = self._place(keys, k, width)
            alone = np.bincount(at, minlength=width) == 1
            bits = np.packbits(alone, bitorder="little").view("<u8")
            before = used + np.append(0, np.cumsum(np.bitwise_count(bits), dtype=np.int64))[:-1]
            self.levels.append((bits, before))
            used += int(alone.sum())
            keys, k = keys[~alone[at]], k + 1

    @staticmethod
    def _place(keys, k, width):
        return (mix(keys + np.uint64((k + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) % np.uint64(width)).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; -1 or any number for a key that is not in the set."""
        out = np.full(len(keys), -1, dtype=np.int64)
        left = np.arange(len(keys))
        for k, (bits, before) in enumerate(self.levels):
            at = self._place(keys[left], k, 64 * len(bits))
            word, bit = bits[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = word & ((np.uint64(1) << bit) - np.uint64(1))
            out[left[hit]] = (before[at >> 6] + np.bitwise_count(below))[hit]
            left = left[~hit]
        return out


class LineIndex:
    """One shard: fingerprints, document counts and largest ids in the order of a minimal perfect hash.

    Keys are distinct pairs of a placing hash and a fingerprint; those few that share
    a placing hash with another go to an index of their own.
    """

    def __init__(self, hashes: np.ndarray, prints: np.ndarray, counts: np.ndarray, ids: np.ndarray):
        _, first = np.unique(hashes, return_index=True)
        self.number = PerfectHash(hashes[first])
        order = np.argsort(self.number(hashes[first]))
        self.prints, self.counts, self.last = (x[first][order] for x in (prints, counts, ids))
        more = np.ones(len(hashes), dtype=bool)
        more[first] = False
        self.more = LineIndex(hashes[more], prints[more], counts[more], ids[more]) if more.any() else None

    def probe(self, hashes: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Document count (0: unknown) and largest id of each key."""
        counts, last = np.zeros(len(hashes), np.int64), np.zeros(len(hashes), np.int64)
        if len(self.prints):
            at = self.number(hashes)
            known = np.flatnonzero((at >= 0) & (self.prints[at] == prints))
            counts[known], last[known] = self.counts[at[known]], self.last[at[known]]
        if self.more:
            other, late = self.more.probe(hashes, prints)
            counts, last = np.where(counts, counts, other), np.where(counts, last, late)
        return counts, last


def _keys(column: pa.Array, min_length: int):
    """Bytes; start, end and first line by row; the lines whose keys are long enough, and their two hashes."""
    data, offsets = text_bytes(column)
    start, end, first = line_spans(data, offsets)
    solid = np.flatnonzero(NOT_SPACE[data])
    a = np.append(solid, len(data))[np.searchsorted(solid, start)]
    b = np.append(solid, -1)[np.searchsorted(solid, end) - 1] + 1
    a, b = np.minimum(a, end), np.maximum(b, start)
    b = np.maximum(a, b)
    leads = np.append(0, np.cumsum((data & 0xC0) != 0x80))
    long = np.flatnonzero(leads[b] - leads[a] >= min_length)
    spans = Spans(data)
    return data, start, end, first, long, spans.hashes(a[long], b[long]), spans.hashes(a[long], b[long], salt=1)


def _distinct(*columns: np.ndarray) -> np.ndarray:
    """Places of the first of each distinct row, in the rows' order by the last column first."""
    by = np.lexsort(columns)
    new = np.zeros(len(by), dtype=bool)
    new[:1] = True
    for x in columns:
        new[1:] |= x[by][1:] != x[by][:-1]
    return by[new]


def _line_docs(batch, min_length):
    """Distinct (hash, fingerprint, id) of a slice; rows that share an id give one each."""
    _, _, _, first, long, h, g = _keys(batch.column("text"), min_length)
    row = row_of(first)[long]
    pick = _distinct(g, h, row)
    return h[pick], g[pick], batch.column("id").to_numpy()[row[pick]]


def shared_lines(rows: DataFrame, min_length: int, min_docs: int) -> DataFrame:
    """Keys that at least min_docs documents hold: h, g, c (documents), last (largest id). rows: id, text."""
    schema = pa.schema([(x, pa.int64()) for x in ("h", "g", "c", "last")])

    def count(parts):
        h, g, d = map(np.concatenate, zip(*parts))
        by = np.lexsort((d, g, h))
        h, g, d = h[by], g[by], d[by]
        new = np.ones(len(h), dtype=bool)
        new[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1])
        start = np.flatnonzero(new)
        n = np.diff(np.append(start, len(h)))
        return batch_of(schema, h[start].view(np.int64), g[start].view(np.int64), n, d[start + n - 1])

    def run(batches):
        held, size = [], 0
        for batch in slices(batches):
            held.append(_line_docs(batch, min_length))
            size += len(held[-1][0])
            if size >= BLOCK:
                yield count(held)
                held, size = [], 0
        if size:
            yield count(held)

    counted = rows.mapInArrow(run, "h long, g long, c long, last long").groupBy("h", "g").agg(F.sum("c").alias("c"), F.max("last").alias("last"))
    return cut(counted.where(F.col("c") >= min_docs))


def _shards(shared: DataFrame, n_shards: int) -> DataFrame:
    """(shard, index): the pickled LineIndex of each shard's keys."""

    def build(table: pa.Table) -> pa.Table:
        h, g, c, last = (table.column(x).to_numpy() for x in ("h", "g", "c", "last"))
        index = LineIndex(h.view(np.uint64), g.view(np.uint64), c, last)
        return pa.table({"shard": table.column("shard").slice(0, 1), "index": pa.array([pickle.dumps(index)], pa.binary())})

    return shared.withColumn("shard", F.pmod("h", F.lit(n_shards)).cast("int")).groupBy("shard").applyInArrow(build, "shard int, index binary")


def _probe(shards: dict, n_shards: int, h: np.ndarray, g: np.ndarray):
    """Counts and largest ids from whichever shard each key belongs to."""
    counts, last = np.zeros(len(h), np.int64), np.zeros(len(h), np.int64)
    shard = np.mod(h.view(np.int64), n_shards)
    for k, index in shards.items():
        at = np.flatnonzero(shard == k)
        if len(at):
            counts[at], last[at] = index.probe(h[at], g[at])
    return counts, last


PACKED = "part int, n long, h binary, g binary, d binary"
_SCHEMA = pa.schema([("part", pa.int32()), ("n", pa.int64()), ("h", pa.binary()), ("g", pa.binary()), ("d", pa.binary())])


def _packed(part, n_parts, h, g, d):
    """Keys and documents in one row a part."""
    order, at = by_part(part, n_parts)
    used = np.flatnonzero(np.diff(at))
    picks = [order[at[k] : at[k + 1]] for k in used]
    return batch_of(_SCHEMA, used.astype(np.int32), [len(p) for p in picks], *(pa.array([pack(x[p], delta) for p in picks], pa.binary()) for x, delta in ((h, False), (g, False), (d, True))))


def _unpacked(table: pa.Table):
    sizes = table.column("n").to_pylist()
    return [np.concatenate([unpack(x.as_py(), n, delta) for x, n in zip(table.column(name), sizes)] or [np.zeros(0, np.int64)]) for name, delta in (("h", False), ("g", False), ("d", True))]


def _far_drops(rows: DataFrame, far: DataFrame, n_far: int, min_length: int, n_buckets: int, found_near) -> DataFrame:
    """Packed keys and ids of lines to drop, by bucket of ids, for keys too many to broadcast: probes go to the shards.

    Lines that found_near knows are left out, as the documents drop them on their own.
    """
    n_shards = -(-n_far // SHARD_KEYS)

    def entries(batches):
        for batch in slices(batches):
            h, g, d = _line_docs(batch, min_length)
            new = found_near(h, g)[0] == 0
            h, g, d = h[new], g[new], d[new]
            yield _packed(np.mod(h.view(np.int64), n_shards), n_shards, h, g, d)

    def judge(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.Table.from_batches([], schema=_SCHEMA)
        h, g, d = _unpacked(right)
        counts, last = pickle.loads(left.column("index")[0].as_py()).probe(h.view(np.uint64), g.view(np.uint64))
        gone = (counts > 0) & (d < last)
        return pa.Table.from_batches([_packed(d[gone] % n_buckets, n_buckets, h[gone], g[gone], d[gone])])

    probes = rows.mapInArrow(entries, PACKED)
    return _shards(far, n_shards).groupBy("shard").cogroup(probes.groupBy("part")).applyInArrow(judge, PACKED)


def _without(column: pa.Array, ids: np.ndarray, min_length: int, found_near, far: dict):
    """Per row: number of lines, of dropped lines, the lines that stay. far: (keys, fingerprints) to drop by id."""
    data, start, end, first, long, h, g = _keys(column, min_length)
    row = row_of(first)
    counts, last = found_near(h, g)
    drop = np.zeros(len(start), dtype=bool)
    drop[long] = (counts > 0) & (ids[row[long]] < last)
    at = np.searchsorted(row[long], np.arange(len(column) + 1))
    for r, id in enumerate(ids.tolist() if far else ()):
        if id in far:
            mine = slice(at[r], at[r + 1])
            keys = set(zip(*(x.tolist() for x in far[id])))
            drop[long[mine]] |= np.array([k in keys for k in zip(h[mine].view(np.int64).tolist(), g[mine].view(np.int64).tolist())], dtype=bool)
    raw, texts = data.tobytes(), []
    n_dropped = np.bincount(row[drop], minlength=len(column))
    for r in range(len(column)):
        a, b = first[r], first[r + 1]
        texts.append(b"\n".join(raw[start[k] : end[k]] for k in a + np.flatnonzero(~drop[a:b])) if n_dropped[r] else raw[start[a] : end[b - 1]])
    return np.diff(first), n_dropped, texts


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH, min_docs: int = MIN_DOCS, digest: bool = False) -> DataFrame:
    """All columns of docs with the text's dropped lines gone, and n_lines (before) and n_dropped; digest: kept_sha256 in place of the text."""
    spark = docs.sparkSession
    id = integer_id(F.col(id_col))
    rows = docs.select(id.alias("id"), F.col(text_col).alias("text"))
    shared = shared_lines(rows, min_length, min_docs)
    n_shared, total = shared.agg(F.count("*"), F.sum("c")).first()
    wide = F.lit(n_shared <= BROADCAST_KEYS) | (F.col("c") * SPREAD > F.lit(total or 0))
    n_near = -(-min(n_shared, BROADCAST_KEYS) // SHARD_KEYS) or 1
    near = {row["shard"]: row["index"] for row in _shards(shared.where(wide), n_near).toLocalIterator()}
    held = spark.sparkContext.broadcast(near)
    ready: dict = {}

    def found_near(h, g):
        if "shards" not in ready:
            ready["shards"] = {k: pickle.loads(x) for k, x in held.value.items()}
        return _probe(ready["shards"], n_near, h, g)

    rest = [c for c in docs.columns if c not in (text_col, "n_lines", "n_dropped", "kept_sha256")]
    packed = docs.select(id.alias("id"), F.col(text_col).alias("text"), F.struct(*rest).alias("rest"))
    schema = T.StructType([packed.schema["rest"], *T.StructType.fromDDL("n_lines long, n_dropped long, text string")])

    def result(batch, far):
        n_lines, n_dropped, texts = _without(batch.column("text"), batch.column("id").to_numpy(), min_length, found_near, far)
        text = pa.array([hashlib.sha256(t).hexdigest() for t in texts] if digest else texts, pa.string())
        return pa.RecordBatch.from_arrays([batch.column("rest"), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), text], names=["rest", "n_lines", "n_dropped", "text"])

    if n_shared <= BROADCAST_KEYS:
        out = packed.mapInArrow(lambda batches: (result(batch, {}) for batch in slices(batches)), schema)
    else:
        n_buckets = prime_above(-(-docs.count() // BUCKET_DOCS))
        drops = _far_drops(rows, shared.where(~wide), n_shared, min_length, n_buckets, found_near)

        def apply(left: pa.Table, right: pa.Table) -> pa.Table:
            h, g, d = _unpacked(right)
            by = np.argsort(d, kind="stable")
            ids, at = np.unique(d[by], return_index=True)
            far = dict(zip(ids.tolist(), zip(np.split(h[by], at[1:]), np.split(g[by], at[1:])))) if len(ids) else {}
            return pa.Table.from_batches([result(batch, far) for batch in slices(left.to_batches())])

        bucketed = packed.withColumn("bucket", F.pmod("id", F.lit(n_buckets)).cast("int"))
        out = bucketed.groupBy("bucket").cogroup(drops.groupBy("part")).applyInArrow(apply, schema)
    return out.select("rest.*", "n_lines", "n_dropped", F.col("text").alias("kept_sha256" if digest else text_col))
