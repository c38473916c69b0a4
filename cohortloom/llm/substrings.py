"""Suffix-array dedup of bytes across documents, by longest-previous-factor arrays.

Every window of ``length`` bytes that also starts in a document with a smaller id
is removed; windows overlap freely and are judged on the input.

1. The key of a window is the least hash among its ``GRAM``-byte strings, so equal
   windows have equal keys, and windows that follow each other mostly share theirs
   (a run). Tasks send the distinct keys of their documents to shards in packed
   blocks; a shard tells which keys more than one document holds. A key found
   twice inside a block is known to be shared there and is sent once.
2. The bytes of the runs with shared keys go to shards by key. Among documents that
   meet in one task anyway, a run with the very bytes of an earlier document's (hashes
   find it, the bytes are compared) is removed at once, so a passage that a third of all documents share sends one copy
   a task. A shard sorts the windows of each key (their suffix order, to ``length``
   bytes) with the longest common prefixes of neighbours. For each window the
   nearest entries before and after it in that order with a smaller document give
   the longest previous factor; at ``length`` or more the window goes.
3. The removed windows return to the documents by buckets of ids.

Shards and buckets are as many as the table's bytes ask for, so what a task holds at a
time does not grow with the table, but for a key of which many different windows are
in different documents: all windows of one key are sorted by one shard.

Null and empty texts, and those shorter than ``length``, lose nothing. Ids are
integers; a null id counts as the smallest. Rows that share an id are one
document here: they never remove each other's bytes, and each loses what either
is told to lose only where its own windows match. An empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kit import Spans, batch_of, by_part, integer_id, pack, parts, prime_above, ranges, slices, text_bytes, unpack

LENGTH = 50
GRAM = 16
BLOCK = 1 << 21
CHUNK = 1 << 19
#: Bytes of text to each shard, and half of them to each bucket of ids, whatever the size of the table.
SHARD_BYTES = 1 << 22
KEY_BITS = np.uint64(16)

PACKED = "part int, n long, a binary, b binary, c binary, d binary, e binary"
_SCHEMA = pa.schema([("part", pa.int32()), ("n", pa.int64()), *((x, pa.binary()) for x in "abcde")])


def _rows(part, n_parts, columns, texts=None):
    """A packed row for each part: columns of longs (delta or not), and the bytes of texts (blob, start, size)."""
    order, cut = by_part(part, n_parts)
    out: list = [[], []] + [[] for _ in range(5)]
    for k in np.flatnonzero(np.diff(cut)):
        pick = order[cut[k] : cut[k + 1]]
        out[0].append(int(k))
        out[1].append(len(pick))
        packed = [pack(x[pick], delta) for x, delta in columns]
        if texts:
            blob, start, size = texts
            size = size[pick]
            packed.append(blob[np.repeat(start[pick], size) + ranges(size)].tobytes())
        for j in range(5):
            out[2 + j].append(packed[j] if j < len(packed) else b"")
    return batch_of(_SCHEMA, *out)


def _columns(table, deltas):
    sizes = table.column("n").to_pylist()
    return [np.concatenate([unpack(x.as_py(), n, delta) for x, n in zip(table.column(name), sizes)] or [np.zeros(0, np.int64)]) for name, delta in zip("abcde", deltas)]


def _texts(column: pa.ChunkedArray) -> np.ndarray:
    """The bytes of all rows of a column and eight more, copied once."""
    views = [np.frombuffer(x.as_buffer(), dtype=np.uint8) for x in column]
    return np.concatenate([*views, np.zeros(8, dtype=np.uint8)])


def runs(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one key: key, first window, number of windows, row."""
    width = length - gram + 1
    empty = np.zeros(0, dtype=np.int64)
    if len(data) < length:
        return empty.view(np.uint64), empty, empty, empty
    key = Spans(data, lower=False).grams(gram)
    span = 1
    while span < width:
        step = min(span, width - span)
        key = np.minimum(key[:-step], key[step:])
        span += step
    new = np.append(True, key[1:] != key[:-1])
    for edge in (offsets[:-1], offsets[1:] - length + 1):  # where windows of the next row, or of none, begin
        new[edge[(edge >= 0) & (edge < len(key))]] = True
    start = np.flatnonzero(new)
    count = np.diff(np.append(start, len(key)))
    row = np.searchsorted(offsets, start, "right") - 1
    inside = start + length <= offsets[row + 1]
    start = start[inside]
    return key[start] >> KEY_BITS, start, count[inside], row[inside]


def _shared(rows: DataFrame, length: int, gram: int, n_shards: int, n_buckets: int) -> DataFrame:
    """Places, among each document's runs, of those whose key another document has; by bucket of ids."""

    def block(key, id, place):
        by = np.lexsort((place, id, key))
        key, id, place = key[by], id[by], place[by]
        first = np.append(True, (key[1:] != key[:-1]) | (id[1:] != id[:-1]))[: len(key)]
        key, id, place = key[first], id[first], place[first]
        start = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
        count = np.diff(np.append(start, len(key)))
        known = np.repeat(count > 1, count)
        send = ~known
        send[start] = True
        k, i, p, kn = key[send], id[send], place[send], known[send]
        by = np.lexsort((p, i))
        k, i, p, kn = k[by], i[by], p[by], kn[by]
        yield _rows((k % np.uint64(n_shards)).astype(np.int64), n_shards, [(k, False), (i, True), (p, True), (kn.astype(np.int64), True)])
        if known.any():
            sent = _rows(id[known] % n_buckets, n_buckets, [(id[known], True), (place[known], True)])
            yield sent.set_column(0, "part", pa.array([-1 - x for x in sent.column(0).to_pylist()], pa.int32()))

    def entries(batches):
        held, size = [], 0
        for batch in slices(batches):
            data, offsets = text_bytes(batch.column("text"))
            key, _, _, row = runs(data, offsets, length, gram)
            place = np.arange(len(row)) - np.searchsorted(row, row)
            held.append((key, batch.column("id").to_numpy()[row], place))
            size += len(key)
            if size >= BLOCK:
                yield from block(*map(np.concatenate, zip(*held)))
                held, size = [], 0
        if size:
            yield from block(*map(np.concatenate, zip(*held)))

    def judge(table: pa.Table) -> pa.Table:
        if table.column("part")[0].as_py() < 0:  # known to be shared: on to the documents
            return table.set_column(0, "part", pa.array([-1 - x for x in table.column("part").to_pylist()], pa.int32()))
        key, id, place, known = _columns(table, (False, True, True, True))
        by = np.lexsort((id, key))
        key, id, place, known = key[by], id[by], place[by], known[by]
        start = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
        count = np.diff(np.append(start, len(key)))
        shared = np.repeat((id[start] != id[start + count - 1]) | (np.maximum.reduceat(known, start) > 0), count) & (known == 0)
        id, place = id[shared], place[shared]
        by = np.lexsort((place, id))
        return pa.Table.from_batches([_rows(id[by] % n_buckets, n_buckets, [(id[by], True), (place[by], True)])])

    return rows.mapInArrow(entries, PACKED).groupBy("part").applyInArrow(judge, PACKED)


def _prefixes(text: np.ndarray, at: np.ndarray, group: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows (from at on, length bytes) in order of group and bytes; common prefix, in bytes, with the one before.

    Eight bytes at a time; groups of windows that agree on them need no sorting. group: from 0 on, not falling.
    """
    n = len(at)
    words = np.ndarray((len(text) - 7,), dtype=">u8", buffer=text, strides=(1,))
    bits = int(group[-1]).bit_length() if n else 0

    def word(k, windows):
        left = length - 8 * k
        x = words[at[windows] + 8 * k].astype(np.uint64)
        return x if left >= 8 else x & np.uint64(((1 << 64) - 1) ^ ((1 << (64 - 8 * left)) - 1))

    order = np.argsort((group.astype(np.uint64) << np.uint64(64 - bits)) | (word(0, slice(None)) >> np.uint64(bits))) if bits else np.argsort(word(0, slice(None)))
    differs = np.append(True, group[order][1:] != group[order][:-1])[:n]
    common = np.where(differs, 0, length)
    for level in range((length + 7) // 8):
        tied = ~differs
        tied[:-1] |= ~differs[1:]
        spot = np.flatnonzero(tied)
        if not len(spot):
            break
        value = word(level, order[spot])
        part = np.cumsum(differs[spot])
        falls = (value[1:] < value[:-1]) & (part[1:] == part[:-1])
        if falls.any():
            mixed = np.zeros(part[-1] + 1, dtype=bool)
            mixed[part[1:][falls]] = True
            some = np.flatnonzero(mixed[part])
            again = some[np.lexsort((value[some], part[some]))]
            order[spot[some]], value[some] = order[spot[again]], value[again]
        split = np.append(False, (value[1:] != value[:-1]) & (part[1:] == part[:-1]))
        where = np.flatnonzero(split)
        common[spot[where]] = 8 * level + _leading_zero_bytes(value[where] ^ value[where - 1])
        differs[spot[where]] = True
    return order, common


def _leading_zero_bytes(x: np.ndarray) -> np.ndarray:
    out = np.zeros(len(x), dtype=np.int64)
    for k in range(1, 8):
        out += x < np.uint64(1 << (64 - 8 * k))
    return out


def previous_factors(doc: np.ndarray, common: np.ndarray, wanted: int = 1) -> np.ndarray:
    """Longest previous factor of each entry in suffix order: the longest common prefix with an entry of a smaller document.

    common: of each entry and the one before. The nearest entries before and after
    with smaller documents are found by jumping over those already passed. Lengths
    below wanted are given as 0.
    """
    n = len(doc)
    best = np.zeros(n, dtype=np.int64)
    for backward in (False, True):
        d = doc[::-1] if backward else doc
        c = np.append(0, common[1:][::-1]) if backward else common.copy()
        jump, least = np.arange(n) - 1, np.where(c >= wanted, c, 0)
        least[:1] = 0
        live = np.flatnonzero(least)
        while len(live):
            p = jump[live]
            on = d[p] >= d[live]
            live, p = live[on], p[on]
            new_least = np.minimum(least[live], least[p])
            jump[live], least[live] = jump[p], new_least
            live = live[new_least > 0]
        best = np.maximum(best, least[::-1] if backward else least)
    return best


def _removed(key, id, text, start, n_windows, length):
    """Entry and number of each window of the runs that a smaller document has in a run of the same key.

    text: the bytes of all runs and eight more. Keys are taken some CHUNK windows at a time, which bounds memory.
    """
    by = np.argsort(key, kind="stable")
    firsts = np.flatnonzero(np.append(True, key[by][1:] != key[by][:-1])[: len(key)])
    total = np.append(0, np.cumsum(n_windows[by]))
    upto = total[np.append(firsts[1:], len(key))]
    entries, numbers, k = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
    while k < len(firsts):
        last = max(k + 1, int(np.searchsorted(upto, total[firsts[k]] + CHUNK, "right")))
        some = by[firsts[k] : firsts[last] if last < len(firsts) else len(by)]
        k = last
        number = ranges(n_windows[some])
        entry = np.repeat(some, n_windows[some])
        group = np.cumsum(np.append(False, key[some][1:] != key[some][:-1]))
        order, common = _prefixes(text, start[entry] + number, np.repeat(group, n_windows[some]), length)
        gone = order[previous_factors(id[entry[order]], common, length) >= length]
        entries.append(entry[gone])
        numbers.append(number[gone])
    return np.concatenate(entries), np.concatenate(numbers)


def _spans(gone_id, gone_start, n_buckets, length):
    """Removed windows of documents, as packed spans of windows by bucket of ids."""
    by = np.lexsort((gone_start, gone_id))
    id, start = gone_id[by], gone_start[by]
    new = np.flatnonzero(np.append(True, (id[1:] != id[:-1]) | (start[1:] != start[:-1] + 1))[: len(id)])
    count = np.diff(np.append(new, len(id)))
    return _rows(id[new] % n_buckets, n_buckets, [(id[new], True), (start[new], True), (count, True)])


def _of_documents(left: pa.Table, length: int, gram: int, wanted_id, wanted_place):
    """The wanted runs of a bucket's documents: key, id, offset in the text, windows, and their bytes."""
    by = np.lexsort((wanted_place, wanted_id))
    wanted = dict(zip(*_groups(wanted_id[by], wanted_place[by])))
    out, blobs, base = [], [], 0
    for batch in slices(left.to_batches()):
        data, offsets = text_bytes(batch.column("text"))
        key, start, size, row = runs(data, offsets, length, gram)
        first = np.searchsorted(row, np.arange(batch.num_rows + 1))
        picks = [np.zeros(0, dtype=np.int64)]
        for r, id in enumerate(batch.column("id").to_pylist()):
            places = wanted.get(id)
            if places is not None:
                own = key[first[r] : first[r + 1]]
                places = places[places < len(own)]
                picks.append(first[r] + np.flatnonzero(np.isin(own, own[places])))
        pick = np.concatenate(picks)
        ids = batch.column("id").to_numpy()[row[pick]]
        n = size[pick] + length - 1
        blobs.append(data[np.repeat(start[pick], n) + ranges(n)])
        out.append((key[pick], ids, start[pick] - offsets[row[pick]], size[pick], base + np.cumsum(n) - n))
        base += int(n.sum())
    key, id, offset, size, start = map(np.concatenate, zip(*out))
    return key, id, offset, size, start, np.concatenate(blobs)


def _same_bytes(blob, a, b, n):
    """Whether the n bytes from each a on are those from b on."""
    same = np.ones(len(a), dtype=bool)
    ends = np.cumsum(n)
    k = 0
    while k < len(a):
        last = max(k + 1, int(np.searchsorted(ends, ends[k] - n[k] + CHUNK, "right")))
        inside = ranges(n[k:last])
        equal = blob[np.repeat(a[k:last], n[k:last]) + inside] == blob[np.repeat(b[k:last], n[k:last]) + inside]
        same[k:last] = np.logical_and.reduceat(equal, ends[k:last] - n[k:last] - (ends[k] - n[k]))
        k = last
    return same


def _groups(keys, values):
    names, at = np.unique(keys, return_index=True)
    return names.tolist(), np.split(values, at[1:])


def spans(docs: DataFrame, length: int, gram: int, n_shards: int, n_buckets: int) -> DataFrame:
    """Packed spans of removed windows (id, first window, count) by bucket of ids. docs: bucket, id, text."""
    shared = _shared(docs.select("id", "text"), length, gram, n_shards, n_buckets)

    def send(left: pa.Table, right: pa.Table) -> pa.Table:
        id, place = _columns(right, (True, True))
        if not left.num_rows or not len(id):
            return pa.Table.from_batches([], schema=_SCHEMA)
        key, id, offset, size, start, blob = _of_documents(left, length, gram, id, place)
        n = size + length - 1
        whole = Spans(blob, lower=False).hashes(start, start + n)
        by = np.lexsort((id, whole, n, key))
        same = np.append(False, (key[by][1:] == key[by][:-1]) & (n[by][1:] == n[by][:-1]) & (whole[by][1:] == whole[by][:-1]))
        later = np.flatnonzero(same)
        same[later] = _same_bytes(blob, start[by[later]], start[by[later - 1]], n[by[later]])
        head = np.maximum.accumulate(np.where(same, 0, np.arange(len(by))))
        copy = np.zeros(len(by), dtype=bool)
        copy[by] = same & (id[by] > id[by[head]])
        gone = np.repeat(offset[copy], size[copy]) + ranges(size[copy])
        done = _spans(np.repeat(id[copy], size[copy]), gone, n_buckets, length)
        done = done.set_column(0, "part", pa.array([-1 - x for x in done.column(0).to_pylist()], pa.int32()))
        keep = ~copy
        sent = _rows((key[keep] % np.uint64(n_shards)).astype(np.int64), n_shards, [(key[keep], False), (id[keep], True), (offset[keep], True), (size[keep], True)], (blob, start[keep], n[keep]))
        return pa.Table.from_batches([sent, done], schema=_SCHEMA)

    def judge(table: pa.Table) -> pa.Table:
        if table.column("part")[0].as_py() < 0:
            return table.set_column(0, "part", pa.array([-1 - x for x in table.column("part").to_pylist()], pa.int32()))
        key, id, offset, size = _columns(table, (False, True, True, True))
        n = size + length - 1
        entry, inside = _removed(key, id, _texts(table.column("e")), np.cumsum(n) - n, size, length)
        return pa.Table.from_batches([_spans(id[entry], offset[entry] + inside, n_buckets, length)])

    pairs = docs.groupBy("bucket").cogroup(shared.groupBy("part")).applyInArrow(send, PACKED)
    return pairs.groupBy("part").applyInArrow(judge, PACKED)


def _cut(text: np.ndarray, first, count, length):
    edge = np.zeros(len(text) + 1, dtype=np.int64)
    ok = first + count + length - 1 <= len(text)
    np.add.at(edge, first[ok], 1)
    np.add.at(edge, (first + count + length - 1)[ok], -1)
    gone = np.cumsum(edge)[:-1] > 0
    n_spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
    return gone, n_spans


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, digest: bool = False) -> DataFrame:
    """Per document: id_col, n_bytes, n_removed, n_spans, and the remaining bytes (``kept``), or their kept_sha256 if digest."""
    size = docs.agg(F.sum(F.octet_length(F.col(text_col)).cast("long"))).first()[0] or 0
    n_shards = max(parts(docs.sparkSession), -(-size // SHARD_BYTES))
    n_buckets = prime_above(2 * n_shards)
    id = integer_id(F.col(id_col))
    rows = docs.select(F.pmod(id, F.lit(n_buckets)).cast("int").alias("bucket"), id.alias("id"), F.col(id_col).isNull().alias("no_id"), F.col(text_col).alias("text"))
    removed = spans(rows, length, gram, n_shards, n_buckets)

    def apply(left: pa.Table, right: pa.Table) -> pa.Table:
        id, first, count = _columns(right, (True, True, True))
        by = np.lexsort((first, id))
        found = dict(zip(*_groups(id[by], np.stack([first[by], count[by]], axis=1)))) if len(id) else {}
        n_bytes, n_removed, n_spans, kept = [], [], [], []
        for batch in slices(left.to_batches()):
            data, offsets = text_bytes(batch.column("text"))
            for r, id in enumerate(batch.column("id").to_pylist()):
                text, at = data[offsets[r] : offsets[r + 1]], found.get(id)
                n_bytes.append(len(text))
                runs = 0
                if at is not None:
                    gone, runs = _cut(text, at[:, 0], at[:, 1], length)
                    text = text[~gone]
                n_removed.append(n_bytes[-1] - len(text))
                n_spans.append(runs)
                kept.append(hashlib.sha256(text.tobytes()).hexdigest() if digest else text.tobytes())
        return pa.table([left.column("id"), left.column("no_id"), pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(kept, pa.string() if digest else pa.binary())], names=["id", "no_id", "n_bytes", "n_removed", "n_spans", "kept"])

    out = rows.groupBy("bucket").cogroup(removed.groupBy("part")).applyInArrow(apply, f"id long, no_id boolean, n_bytes long, n_removed long, n_spans long, kept {'string' if digest else 'binary'}")
    return out.select(F.when(~F.col("no_id"), F.col("id")).alias(id_col), "n_bytes", "n_removed", "n_spans", F.col("kept").alias("kept_sha256" if digest else "kept"))
