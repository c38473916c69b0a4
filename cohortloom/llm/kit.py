"""Helpers for the operators of this subpackage: Arrow slices, word hashes, shared state.

Everything here works inside a task on a slice of an Arrow batch of at most
``SLICE_BYTES`` of text (a longer text is a slice of its own), so that a task's
memory follows the slice and not the partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.shared import shared_dir

SLICE_BYTES = 1 << 21

_MULTIPLIER = 0x9E3779B97F4A7C15

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of words split at white space only.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: Bytes of words of ASCII letters, digits and anything outside ASCII.
ALNUM = np.zeros(256, dtype=bool)
for _a, _b in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
    ALNUM[_a:_b] = True
#: The same without digits.
ALPHA = ALNUM.copy()
ALPHA[0x30:0x3A] = False


def cut(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and go on from there, so that a lost executor costs little."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def drop(*tables: DataFrame) -> None:
    """Delete what ``cut`` wrote, once all that was made from these tables is itself written.

    Shuffles that led to them are of no use either; Spark deletes their files when the driver's garbage collection finds them unused.
    """
    for df in tables:
        jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(df._jdf.queryExecution().analyzed().rdd().getCheckpointFile().get())
        path.getFileSystem(conf).delete(path, True)
    if tables:
        jvm.System.gc()


def spread_join(rows: DataFrame, table: DataFrame, keys: list[str], weight: str, most: int = 1000) -> DataFrame:
    """rows joined to the table's row of each key; weight: how many rows have the key.

    Keys that more than one row in ``most`` has, fewer than ``most`` of them, are
    broadcast; a shuffle deals the others, so no task gets more than its share.
    """
    total = table.agg(F.sum(weight)).first()[0] or 0
    wide = F.col(weight) * most > F.lit(total)
    hot = F.broadcast(table.where(wide))
    if total <= most or table.where(wide).isEmpty():
        return rows.join(table, keys)
    rest = rows.join(F.broadcast(table.where(wide).select(*keys)), keys, "left_anti").join(table.where(~wide), keys)
    return rows.join(hot, keys).unionByName(rest)


def more(df: DataFrame, fields: str) -> T.StructType:
    """The schema of df with further fields."""
    return T.StructType([*df.schema.fields, *T.StructType.fromDDL(fields).fields])


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """Batches cut so that the column's texts take at most SLICE_BYTES, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes.astype(np.int64))
        row = 0
        while row < batch.num_rows:
            before = ends[row - 1] if row else 0
            stop = max(row + 1, int(np.searchsorted(ends, before + SLICE_BYTES, "right")))
            yield batch.slice(row, stop - row)
            row = stop


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows, and where each row starts (one more at the end). Null: empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or at[0] == at[-1]:
        return np.zeros(0, dtype=np.uint8), at - at[0]
    return np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]], at - at[0]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose bits are as good as random."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_STEP = np.uint64(0x9E3779B97F4A7C15)
_PIECE = 1024


class Spans:
    """64-bit hashes of any byte ranges of one buffer.

    A range is folded eight bytes at a time, each step a non-linear mix, so no sums of
    bytes can cancel out; a range longer than _PIECE is the fold of its pieces' hashes.
    Hashes of different salts are independent.
    """

    def __init__(self, data: np.ndarray, lower: bool = True):
        self.data = np.zeros(len(data) + 8, dtype=np.uint8)
        self.data[: len(data)] = LOWER[data] if lower else data
        self.words = np.ndarray((len(data) + 1,), dtype="<u8", buffer=self.data, strides=(1,))

    def hashes(self, start: np.ndarray, end: np.ndarray, salt: int = 0) -> np.ndarray:
        size = np.asarray(end, dtype=np.int64) - start
        long = np.flatnonzero(size > _PIECE)
        if not len(long):
            return self._fold(start, size, salt)
        out = np.empty(len(size), dtype=np.uint64)
        short = size <= _PIECE
        out[short] = self._fold(start[short], size[short], salt)
        pieces = -(-size[long] // _PIECE)
        at = np.repeat(start[long], pieces) + ranges(pieces) * _PIECE
        h = self._fold(at, np.minimum(_PIECE, np.repeat(end[long], pieces) - at), salt)
        to = 8 * np.cumsum(pieces)
        out[long] = mix(Spans(h.view(np.uint8), lower=False).hashes(to - 8 * pieces, to, salt) ^ size[long].astype(np.uint64))
        return out

    def _fold(self, start, size, salt):
        h = mix((size.astype(np.uint64) + np.uint64(salt << 32)) * _STEP)
        live, k = np.flatnonzero(size > 0), 0
        while len(live):
            word, left = self.words[start[live] + k], size[live] - k
            part = left < 8
            word[part] &= (np.uint64(1) << (8 * left[part]).astype(np.uint64)) - np.uint64(1)
            h[live] = mix((h[live] ^ word) + _STEP)
            k += 8
            live = live[left > 8]
        return h

    def grams(self, n: int) -> np.ndarray:
        """The hash of the n bytes (8 at least) from each place on that has so many."""
        count = max(0, len(self.data) - 8 - n + 1)
        h = np.zeros(count, dtype=np.uint64)
        for at in sorted({*range(0, n - 7, 8), n - 8}):
            h = mix((h ^ self.words[at : at + count]) + _STEP)
        return h


def word_spans(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word (a maximal run of bytes in table), and each row's first word."""
    inside = np.zeros(len(data) + 1, dtype=bool)
    inside[:-1] = table[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    begins[offsets] = inside[offsets]
    ends = np.zeros(len(data) + 1, dtype=bool)
    ends[1:] = inside[:-1] & (~inside[1:] | begins[1:])
    start, end = np.flatnonzero(begins), np.flatnonzero(ends)
    return start, end, np.searchsorted(start, offsets)


def line_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each line, and each row's first line."""
    breaks = np.flatnonzero(data == 10)
    row = np.searchsorted(offsets, breaks, "right") - 1
    start = np.concatenate([offsets[:-1], breaks + 1])
    end = np.concatenate([breaks, offsets[1:]])
    of = np.concatenate([np.arange(len(offsets) - 1), row])
    by = np.lexsort((start, of))
    last = np.concatenate([row, np.arange(len(offsets) - 1)])
    ends = end[np.lexsort((end, last))]
    return start[by], ends, np.searchsorted(of[by], np.arange(len(offsets)))


def hash_words(words: list[str]) -> np.ndarray:
    """The hashes that Spans gives the same (lower-cased) words."""
    column = pa.array(words, type=pa.string())
    data, offsets = text_bytes(column)
    return Spans(data).hashes(offsets[:-1], offsets[1:])


def per_row(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of values by row; first: each row's first value, and one more at the end."""
    sums = np.zeros(len(values) + 1, dtype=np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=sums[1:])
    return sums[first[1:]] - sums[first[:-1]]


def row_of(first: np.ndarray) -> np.ndarray:
    """The row of each value."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def windows(hashes: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of n consecutive words within a row, and where each window starts."""
    count = np.maximum(np.diff(first) - n + 1, 0)
    at = np.repeat(first[:-1], count) + ranges(count)
    out = np.zeros(len(at), dtype=np.uint64)
    for k in range(n):
        out = mix(out * np.uint64(_MULTIPLIER) + hashes[at + k])
    return out, at


def ranges(counts: np.ndarray) -> np.ndarray:
    """0 .. n-1 for each n."""
    total = int(counts.sum())
    return np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)


def lookup(sorted_keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Index of each value in sorted_keys, or -1."""
    if not len(sorted_keys):
        return np.full(len(values), -1, dtype=np.int64)
    at = np.searchsorted(sorted_keys, values)
    at[at == len(sorted_keys)] = 0
    return np.where(sorted_keys[at] == values, at, -1)


def batch_of(schema: pa.Schema, *columns) -> pa.RecordBatch:
    arrays = [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def pack(values: np.ndarray, delta: bool = True) -> bytes:
    """64-bit integers as compressed bytes; small where neighbours are alike (delta) or high bytes are 0."""
    x = np.ascontiguousarray(values).view(np.int64)
    if delta:
        x = np.diff(x, prepend=np.int64(0))
        x = (x << 1) ^ (x >> 63)
    return pa.compress(np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8).T), codec="zstd", asbytes=True) if len(x) else b""


def unpack(data: bytes, n: int, delta: bool = True) -> np.ndarray:
    if not n:
        return np.zeros(0, dtype=np.int64)
    planes = np.frombuffer(pa.decompress(data, 8 * n, codec="zstd", asbytes=True), dtype=np.uint8)
    x = np.ascontiguousarray(planes.reshape(8, n).T).view(np.int64).reshape(n)
    if delta:
        x = np.cumsum((x.view(np.uint64) >> np.uint64(1)).view(np.int64) ^ -(x & 1))
    return x


def by_part(part: np.ndarray, n_parts: int) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings each part together and leaves it in order, and where each part starts."""
    order = np.argsort(part.astype(np.uint16) if n_parts < 65536 else part, kind="stable")
    return order, np.searchsorted(part[order], np.arange(n_parts + 1))


def prime_above(n: int) -> int:
    """The least odd prime from n on: ids with a common factor still spread over that many buckets."""
    n = max(3, n | 1)
    while any(n % k == 0 for k in range(3, int(n**0.5) + 1, 2)):
        n += 2
    return n


#: A null id as a long. It has no negative, so orders are reversed by bitwise not.
NULL_ID = -(1 << 63)


def integer_id(column: Column) -> Column:
    """Ids as longs; a null one sorts below all others."""
    return F.coalesce(column.cast("long"), F.lit(NULL_ID))
