"""Product quantisation of vectors in exact integer arithmetic.

Each component x becomes floor(scale * x). Vectors are cut into equal consecutive
parts; a part's codebook starts as that part of the rows of smallest id and is moved
by rounds of k-means: every part goes to its nearest entry (squared Euclidean distance,
ties to the lower index), then an entry becomes its parts' componentwise floor(sum / count).

Distances are |x|^2 - 2 x.c + |c|^2, and the dot products come from float64 matrix products
of limbs: integers are cut into digits so short that a product of two digit matrices sums to less
than 2^53, hence exactly; the products are shifted and added in int64. Digits are as many as
the slice at hand needs, one for embeddings of usual size. Values whose distances could leave
int64 (components beyond about 2^29 after scaling) are held against entries in Python integers.

A round is one narrow pass over the vectors; tasks send sums and counts by entry, whose
number is bounded by the codebooks, and only those sums and the codebooks reach the driver.

Rows whose vector is null or holds null or non-finite components are dropped. So are rows whose
length differs from the most common one (of equally common ones, the longer), as no part of theirs compares. A
length that ``parts`` does not divide is filled up with zeros. Rows are ordered by id, nulls
last, then by vector; ids may repeat, and repeated rows each count. With fewer rows than entries, codebooks
are as short as that; a table without a usable row gives no rows. An error that a long can't hold is null, and so is
the label's error then. Other columns are dropped.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kit import batch_of, cut, spread_join

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
#: Rows of one matrix product.
ROWS = 4096
#: Sums travel as digits of so many bits, so that a long holds the sum of any number of tasks'.
SUM_BITS = 30
LONG = (1 << 63) - 1


def whole(x: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) of finite float64 values: int64, or Python integers where some are beyond 2^52. scale: a power of two."""
    if not len(x) or np.abs(x).max() * scale < 2.0**52:
        return np.floor(x * scale).astype(np.int64)
    # from 2^52 / scale on, floats times scale have no fraction that a float could lose
    flat = [int(v) * scale if abs(v) >= 2.0**52 else int(np.floor(v * scale)) for v in x.ravel().tolist()]
    return np.array(flat, dtype=object).reshape(x.shape)


def limb_bits(width: int) -> int:
    """Bits of a digit, such that width products of two digits sum to less than 2^53."""
    return (52 - max(1, width).bit_length()) // 2


def limbs(x: np.ndarray, bits: int) -> list[np.ndarray]:
    """The digits of int64 values, lowest first, as float64; all but the highest are from 0 to 2^bits - 1, the highest has the sign."""
    most = int(np.abs(x).max()) if x.size else 0
    out = []
    while most >= 1 << bits:
        out.append((x & ((1 << bits) - 1)).astype(np.float64))
        x, most = x >> bits, most >> bits  # a floor: the highest digit of -1 stays -1
    return [*out, x.astype(np.float64)]


def dots(a: list[np.ndarray], b: list[np.ndarray], bits: int) -> np.ndarray:
    """Exact a @ b.T modulo 2^64 from digits."""
    out = np.zeros((len(a[0]), len(b[0])), dtype=np.uint64)
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            if (shift := bits * (i + j)) < 64:
                out += (x @ y.T).astype(np.int64).view(np.uint64) << np.uint64(shift)
    return out.view(np.int64)


class Book:
    """One part's entries (Python integers, entry by entry), ready for distances."""

    def __init__(self, entries: list[list[int]], width: int):
        self.entries, self.width, self.bits = entries, width, limb_bits(width)
        #: Differences of two such components, squared and summed, fit int64.
        self.limit = isqrt(LONG // max(1, width)) // 2
        fits = [max(map(abs, e), default=0) <= self.limit for e in entries]
        self.near, self.far = np.flatnonzero(fits), np.flatnonzero(~np.array(fits, dtype=bool))
        c = np.array([entries[k] for k in self.near], dtype=np.int64).reshape(len(self.near), width)
        self.limbs, self.squares = limbs(c, self.bits), (c * c).sum(axis=1)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first nearest entry of each row of x and its distance; distances are Python integers where int64 may not hold them."""
        fits = (np.abs(x) <= self.limit).all(axis=1).astype(bool)
        index, best = np.zeros(len(x), dtype=np.int64), np.zeros(len(x), dtype=np.int64)
        if len(self.near) and fits.any():
            y = x[fits].astype(np.int64)
            d = (y * y).sum(axis=1)[:, None] - 2 * dots(limbs(y, self.bits), self.limbs, self.bits) + self.squares
            at = d.argmin(axis=1)
            index[fits], best[fits] = self.near[at], d[np.arange(len(y)), at]
        if fits.all() and not len(self.far):
            return index, best
        best = best.astype(object)
        for row in range(len(x)):
            known = bool(fits[row]) and len(self.near) > 0
            others = self.far if known else range(len(self.entries))
            found = [(best[row], index[row])] if known else []
            found += [(sum((int(a) - b) ** 2 for a, b in zip(x[row], self.entries[k])), k) for k in others]
            best[row], index[row] = min(found)
        return index, best


@dataclass(frozen=True)
class Codebooks:
    """Entries by part; ``length``: components of a vector, ``width``: of a part."""

    parts: list[list[list[int]]]
    length: int
    width: int
    scale: int = SCALE

    def digest(self) -> str:
        """SHA-256 of all components in decimal, comma-joined, by part, entry and place."""
        return hashlib.sha256(",".join(str(v) for part in self.parts for e in part for v in e).encode()).hexdigest()


def _parted(flat: np.ndarray, rows: int, length: int, width: int, scale: int, parts: int) -> np.ndarray:
    """Rows by part by place: the integers of rows vectors, zeros at the end of the last part."""
    x = whole(flat.astype(np.float64), scale).reshape(rows, length)
    if length < width * parts:
        x = np.concatenate([x, np.zeros((rows, width * parts - length), dtype=x.dtype)], axis=1)
    return x.reshape(rows, parts, width)


def _vectors(batch: pa.RecordBatch, column: str, books: Codebooks):
    """(rows of the batch that count, their integers), some rows at a time."""
    lists = batch.column(column)
    lists = lists.cast(pa.large_list(lists.type.value_type))
    usable = pc.fill_null(pc.equal(pc.list_value_length(lists), books.length), False).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(usable)
    step = max(1, min(ROWS, (1 << 20) // max(1, books.length)))
    for at in range(0, len(rows), step):
        some = rows[at : at + step]
        # a null component becomes nan and falls with the non-finite ones
        flat = lists.take(pa.array(some)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(len(some), books.length)
        finite = np.isfinite(flat).all(axis=1)
        if finite.any():
            yield some[finite], _parted(flat[finite].ravel(), int(finite.sum()), books.length, books.width, books.scale, len(books.parts))


def _digits(value: int) -> list[int]:
    out = []
    while not -(1 << SUM_BITS) <= value < 1 << SUM_BITS:
        out.append(value & ((1 << SUM_BITS) - 1))
        value >>= SUM_BITS
    return [*out, value]


#: sums: the number of rows (at digit 0), then a sum a place.
_SUMS = "part int, entry int, digit int, sums array<long>"


def _sums(shared, column):
    """For mapInArrow: counts and sums by part, entry and digit of the rows of a task."""
    schema = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("digit", pa.int32()), ("sums", pa.list_(pa.int64()))])

    def run(batches):
        books = shared.value
        ready = [Book(p, books.width) for p in books.parts]
        k, width = len(books.parts[0]), books.width
        counts = np.zeros((len(ready), k), dtype=np.int64)
        sums = np.zeros((len(ready), k, width), dtype=object)
        for batch in batches:
            for _, x in _vectors(batch, column, books):
                for p, book in enumerate(ready):
                    index, _ = book.nearest(x[:, p])
                    counts[p] += np.bincount(index, minlength=k)
                    if x.dtype == object or (np.abs(x[:, p]) > 1 << 40).any():  # sums of ROWS values below 2^40 are exact in float64
                        np.add.at(sums[p], index, x[:, p].astype(object))
                    elif width:
                        cells = (index[:, None] * width + np.arange(width)).ravel()
                        sums[p] += np.bincount(cells, weights=x[:, p].ravel().astype(np.float64), minlength=k * width).astype(np.int64).reshape(k, width)
        rows = []
        for p, e in np.argwhere(counts):
            digits = [_digits(int(v)) for v in sums[p, e]]
            for d in range(max(map(len, digits), default=1)):
                rows.append((p, e, d, [int(counts[p, e]) if d == 0 else 0, *(v[d] if d < len(v) else 0 for v in digits)]))
        if rows:
            yield batch_of(schema, *(list(c) for c in zip(*rows)))

    return run


def _usable(vectors: DataFrame, column: str) -> DataFrame:
    finite = F.forall(column, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    return vectors.where(F.col(column).isNotNull() & finite)


def first_books(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, scale: int = SCALE) -> Codebooks | None:
    """The parts of the first rows by id; None without a usable row."""
    kept = _usable(vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")), "v").withColumn("length", F.size("v"))
    common = kept.groupBy("length").agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("length")).first()
    if common is None:
        return None
    kept = kept.where(F.col("length") == common.length)
    # the ids alone first, so that no vector is moved but the few that count
    last = cut(kept.select("id").orderBy(F.asc_nulls_last("id")).limit(entries)).agg(F.count_if(F.col("id").isNull()).alias("nulls"), F.count("*").alias("n"), F.max("id").alias("id")).first()
    if last.n == entries and not last.nulls:
        kept = kept.where(F.col("id") <= F.lit(last.id))
    rows = cut(kept.orderBy(F.asc_nulls_last("id"), "v").limit(entries)).orderBy(F.asc_nulls_last("id"), "v").toArrow()["v"]
    width = -(-common.length // parts)
    flat = rows.combine_chunks().flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    x = _parted(flat, len(rows), common.length, width, scale, parts)
    return Codebooks([[[int(v) for v in e] for e in x[:, p]] for p in range(parts)], common.length, width, scale)


def improve(vectors: DataFrame, books: Codebooks, vector_col: str = "embedding") -> Codebooks:
    """Codebooks after one round over all vectors."""
    shared = vectors.sparkSession.sparkContext.broadcast(books)
    found = vectors.select(vector_col).mapInArrow(_sums(shared, vector_col), _SUMS)
    cells = found.select("part", "entry", "digit", F.posexplode("sums").alias("place", "x")).groupBy("part", "entry", "digit", "place").agg(F.sum("x").alias("x")).toArrow()
    sums = {}
    for p, e, d, place, x in zip(*(cells[c].to_pylist() for c in ("part", "entry", "digit", "place", "x"))):
        sums.setdefault((p, e), [0] * (1 + books.width))[place] += x << (SUM_BITS * d)
    shared.unpersist()
    moved = [[[v // sums[p, e][0] for v in sums[p, e][1:]] if (p, e) in sums else entry for e, entry in enumerate(part)] for p, part in enumerate(books.parts)]
    return Codebooks(moved, books.length, books.width, books.scale)


def train(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Codebooks | None:
    books = first_books(vectors, id_col, vector_col, parts, entries, scale)
    for _ in range(rounds if books else 0):
        books = improve(vectors, books, vector_col)
    return books


def encode(vectors: DataFrame, books: Codebooks, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """id, label, codes (array of entry indexes by part) and error (squared distances summed over parts; null beyond a long)."""
    shared = vectors.sparkSession.sparkContext.broadcast(books)
    given = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("v"))

    def run(batches):
        ready = [Book(p, shared.value.width) for p in shared.value.parts]
        for batch in batches:
            for rows, x in _vectors(batch, "v", shared.value):
                found = [book.nearest(x[:, p]) for p, book in enumerate(ready)]
                # distances below 2^63 may exceed it together
                error = sum(e if e.dtype != object and e.max() < LONG // len(ready) else e.astype(object) for _, e in found).tolist()
                codes = np.stack([i for i, _ in found], axis=1)
                taken = batch.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [taken.column("id"), taken.column("label"), pa.array(codes.tolist(), pa.list_(pa.int32())), pa.array([e if e <= LONG else None for e in error], pa.int64())],
                    names=["id", "label", "codes", "error"],
                )

    kinds = dict(given.dtypes)
    return given.mapInArrow(run, f"id {kinds['id']}, label {kinds['label']}, codes array<int>, error long")


def with_label_error(coded: DataFrame) -> DataFrame:
    """coded (of ``encode``) with label_error: the error summed over all rows of an equal label, nulls together; null if a long can't hold it.

    Sums are made before the shuffle and given back by a broadcast to labels that many rows have, by a join to the others.
    """
    rows = cut(coded.withColumns({"_none": F.col("label").isNull(), "_label": F.coalesce(F.col("label").cast("string"), F.lit(""))}))
    total = F.expr("try_cast(sum(cast(error as decimal(20, 0))) as bigint)")
    sums = cut(rows.groupBy("_none", "_label").agg(F.when(F.count("error") == F.count("*"), total).alias("label_error"), F.count("*").alias("_rows")))
    return spread_join(rows, sums, ["_none", "_label"], "_rows").drop("_none", "_label", "_rows")
