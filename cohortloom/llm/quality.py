"""Quality scores from non-negative positive-unlabelled learning on moments of the whole corpus.

A document is a vector of ``WIDTH`` features: shares of characters, words and lines of several kinds, each with
steps at fixed limits, and the frequencies of hashed words. The classifier g is linear in them with squared loss, so every risk

    P+ = E[(g - 1)^2] over trusted positives,  P- = E[(g + 1)^2] over the same,  U- = E[(g + 1)^2] over unlabelled texts

is a quadratic in the weights whose coefficients are sums over documents. One narrow pass adds them up over
*all* documents; tasks send sums of fixed size, and no text or vector reaches the driver. There the weights minimise

    prior * P+  +  max(0, U- - prior * P-)

exactly. As max(0, r) is the greatest theta * r for theta in [0, 1], and prior * P+ + theta * (U- - prior * P-) is convex for each such
theta, the least of the greatest is found by bisection on theta: 1 where the estimated risk of the negatives stays
positive, else the theta that makes it 0.

The class prior is estimated from the same two samples (``estimate_prior``): a first classifier is fit on one half of the positives, and a second pass
counts how often its scores pass each of a row of limits, on the other half and on all documents. Where a limit leaves only positives, the ratio of
the two shares is the prior; it is read off where the ratio raised by its standard error is least, among limits that half of the positives pass.

A score is (g + 1) / 2, within 0 and 1, which estimates the probability of a positive.

The positives are those of at most ``max_positive`` ids, drawn by a hash of the id and broadcast; every document counts
as unlabelled. Rows with an id that is drawn all count as positives, as often as they stand; null ids never do. Null and empty
texts have no features but the constant and get a score like others. Very long texts are read whole. Without a positive, or without a document,
all scores are the prior given for that case. Repeated rows score alike. Scoring keeps all columns but score and predicted, which are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kit import ALPHA, NOT_SPACE, Spans, batch_of, cut, line_spans, mix, more, per_row, row_of, slices, text_bytes, windows, word_spans

MAX_POSITIVE = 20_000
THRESHOLD = 0.7
#: The score of everything where nothing can be learned.
NO_PRIOR = 0.5
HASHED = 192
#: Limits of the steps of a share.
STEPS = np.array([0.0, 0.004, 0.01, 0.02, 0.04, 0.08, 0.15, 0.25, 0.4, 0.6, 0.8, 0.95])
RIDGE = 1e-4
#: Limits of g in the prior's counts, and the share of positives that must pass one for it to count.
LIMITS = np.linspace(-1.5, 1.5, 301)
MIN_PASS = 0.5

_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "stop": b".?", "call": b"!", "pause": b",;:",
    "quote": b"'\"()-", "mark": b"#*$%&|<>", "other": b"@^~=+_/\\{}[]`", "space": b" ", "break": b"\n", "control": bytes(set(range(32)) - {9, 10, 13}) + b"\x7f",
}
_TABLES = {name: np.isin(np.arange(256), np.frombuffer(chars, np.uint8)) for name, chars in _CLASSES.items()}
_N_SHARES = len(_CLASSES) + 12
WIDTH = 1 + _N_SHARES * (1 + len(STEPS)) + HASHED


def _repeats(row: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
    """For each row the share of its values that stood in it before."""
    _, firsts = np.unique(mix(h ^ mix(row.astype(np.uint64))), return_index=True)
    return 1 - np.bincount(row[firsts], minlength=n) / np.maximum(np.bincount(row, minlength=n), 1)


def features(column: pa.Array) -> np.ndarray:
    """One row of WIDTH features a text."""
    data, offsets = text_bytes(column)
    n = len(offsets) - 1
    size = np.maximum(np.diff(offsets), 1)
    counts = {name: per_row(table[data].astype(np.int64), offsets) for name, table in _TABLES.items()}
    letters = np.maximum(per_row(ALPHA[data].astype(np.int64), offsets), 1)
    start, end, first = word_spans(data, offsets, NOT_SPACE)
    words = np.maximum(np.diff(first), 1)
    hashes, length = Spans(data).hashes(start, end), end - start
    running = {name: np.concatenate([[0], np.cumsum(table[data])]) for name, table in (("upper", _TABLES["upper"]), ("alpha", ALPHA), ("mark", _TABLES["mark"] | _TABLES["other"] | _TABLES["call"]))}
    inside = {name: r[end] - r[start] for name, r in running.items()}
    of_words = lambda x: per_row(x.astype(np.float64), first) / words
    row = row_of(first)
    again = lambda of, h: _repeats(of, h, n)
    three, at = windows(hashes, first, 3)
    a, b, lines = line_spans(data, offsets)
    n_lines = np.maximum(np.diff(lines), 1)
    shares = [counts[c] / size for c in _CLASSES] + [
        counts["upper"] / letters,
        of_words(inside["upper"] >= np.maximum(2, inside["alpha"])), of_words(inside["mark"] > 0), of_words(inside["alpha"] == 0), of_words(length > 20), of_words(length < 3),
        per_row(length.astype(np.float64), first) / words / 20,
        again(row, hashes), again(row[at], three), again(row_of(lines), Spans(data).hashes(a, b)),
        np.minimum(n_lines / words, 1), np.log1p(np.diff(first)) / 12,
    ]
    share = np.stack(shares, axis=1)
    out = np.zeros((n, WIDTH))
    out[:, 0] = 1
    out[:, 1 : 1 + _N_SHARES] = share
    out[:, 1 + _N_SHARES : WIDTH - HASHED] = (share[:, :, None] > STEPS).reshape(n, -1)
    bins = (hashes % np.uint64(HASHED)).astype(np.int64)
    out[:, WIDTH - HASHED :] = np.sqrt(np.bincount(row * HASHED + bins, minlength=n * HASHED).reshape(n, HASHED) / words[:, None])
    out[np.diff(first) == 0, 1:] = 0
    return out


@dataclass(frozen=True)
class Moments:
    """Number, sums and sums of products of feature vectors."""

    n: float
    sums: np.ndarray
    products: np.ndarray

    def __add__(self, other: Moments) -> Moments:
        return Moments(self.n + other.n, self.sums + other.sums, self.products + other.products)

    def risk(self, w: np.ndarray, target: float) -> float:
        """Mean of (x.w - target)^2."""
        return float((w @ self.products @ w - 2 * target * (w @ self.sums)) / self.n + target**2)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    prior: float


def minimise(p: Moments, u: Moments, prior: float, ridge: float = RIDGE) -> np.ndarray:
    """Weights of the least non-negative risk."""
    sp, su = p.products / p.n, u.products / u.n
    mp, mu = p.sums / p.n, u.sums / u.n

    def weights(theta: float) -> np.ndarray:
        h = (1 - theta) * prior * sp + theta * su + ridge * np.eye(len(mp))
        return np.linalg.solve(h, prior * mp - theta * (mu - prior * mp))

    def negatives(w: np.ndarray) -> float:
        return u.risk(w, -1) - prior * p.risk(w, -1)

    low, high, w = 0.0, 1.0, weights(1.0)
    if negatives(w) >= 0:
        return w
    for _ in range(40):
        middle = (low + high) / 2
        w = weights(middle)
        low, high = (middle, high) if negatives(w) > 0 else (low, middle)
    return w


def prior_from_counts(p: np.ndarray, u: np.ndarray, n_p: int, n_u: int) -> float:
    """The ratio of the shares of all and of positives that pass a limit, at the limit where it is surely least; p, u: how many pass each."""
    some = p >= max(1, MIN_PASS * n_p)
    ratio = (u[some] / n_u) / (p[some] / n_p)
    error = np.sqrt(1 / p[some] + 1 / np.maximum(u[some], 1))
    return float(np.clip(ratio[(ratio * (1 + error)).argmin()], 0.01, 0.99))


_SUMS = "kind int, place int, n double, vector binary"
_SUMS_ARROW = pa.schema([("kind", pa.int32()), ("place", pa.int32()), ("n", pa.float64()), ("vector", pa.binary())])
#: Rows of a matrix that travel together.
_STRIPE = 32


def _stripes(kind: int, m: Moments):
    """A Moments as rows of bounded size: sums first, then stripes of products."""
    yield kind, -1, m.n, m.sums.tobytes()
    for at in range(0, WIDTH, _STRIPE):
        yield kind, at, 0.0, m.products[at : at + _STRIPE].tobytes()


def _moments(batches):
    """For mapInArrow: moments of the task's documents, by kind: 0 all, 1 and 2 positives of either half."""
    found = {}
    for batch in slices(batches):
        x, kinds = features(batch.column("text")), batch.column("half").to_numpy(zero_copy_only=False)
        for kind in (0, 1, 2):
            y = x if kind == 0 else x[kinds == kind]
            if len(y):
                m = Moments(float(len(y)), y.sum(axis=0), y.T @ y)
                found[kind] = found[kind] + m if kind in found else m
    for kind, m in found.items():
        yield batch_of(_SUMS_ARROW, *(list(c) for c in zip(*_stripes(kind, m))))


def _add(batches):
    """For mapInArrow: vectors of the same kind and place added, one at a time."""
    sums = {}
    for batch in batches:
        for kind, place, n, vector in zip(*(c.to_pylist() for c in batch.columns)):
            v = np.frombuffer(vector)
            had = sums.get((kind, place))
            sums[kind, place] = (n, v.copy()) if had is None else (had[0] + n, had[1] + v)
    for (kind, place), (n, v) in sums.items():
        yield batch_of(_SUMS_ARROW, [kind], [place], [n], [v.tobytes()])


def moments(docs: DataFrame) -> dict[int, Moments]:
    """Moments of docs (text, half: 1 or 2 for positives, else 0) by kind."""
    rows = docs.select("text", "half").mapInArrow(_moments, _SUMS).repartition("kind", "place").mapInArrow(_add, _SUMS).toArrow().to_pylist()
    found = {}
    for kind in {r["kind"] for r in rows}:
        by = {r["place"]: r for r in rows if r["kind"] == kind}
        products = np.concatenate([np.frombuffer(by[at]["vector"]).reshape(-1, WIDTH) for at in range(0, WIDTH, _STRIPE)])
        found[kind] = Moments(by[-1]["n"], np.frombuffer(by[-1]["vector"]), products)
    return found


def estimate_prior(docs: DataFrame, weights: np.ndarray) -> float | None:
    """The share of positives in docs by a classifier that has not seen those of half 2; None if there are none."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        counts = {k: np.zeros(len(LIMITS) + 1, dtype=np.int64) for k in (0, 2)}
        for batch in slices(batches):
            at = np.searchsorted(LIMITS, features(batch.column("text")) @ shared.value, "right")
            kinds = batch.column("half").to_numpy(zero_copy_only=False)
            for kind in counts:
                counts[kind] += np.bincount(at if kind == 0 else at[kinds == kind], minlength=len(LIMITS) + 1)
        for kind, n in counts.items():
            yield batch_of(pa.schema([("kind", pa.int32()), ("place", pa.int32()), ("n", pa.int64())]), [kind] * len(n), np.arange(len(n), dtype=np.int32), n)

    rows = docs.select("text", "half").mapInArrow(run, "kind int, place int, n long").groupBy("kind", "place").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros((3, len(LIMITS) + 1), dtype=np.int64)
    for r in rows:
        counts[r.kind, r.place] = r.n
    passed = counts[:, ::-1].cumsum(axis=1)[:, ::-1]  # at place k and above: at least the k-th limit below
    return prior_from_counts(passed[2], passed[0], passed[2, 0], passed[0, 0]) if passed[2, 0] else None


def fit(docs: DataFrame, positives: DataFrame, text_col: str = "text", id_col: str = "doc_id", max_positive: int = MAX_POSITIVE, prior: float | None = None) -> Model:
    """Fit on docs; positives holds the ids (id_col) of trusted ones. prior: None to estimate it."""
    drawn = positives.select(F.col(id_col).alias("id")).where("id is not null").distinct().orderBy(F.xxhash64("id", F.lit("quality")), "id").limit(max_positive)
    drawn = cut(drawn.withColumn("half", (1 + F.pmod(F.xxhash64(F.lit("half"), "id"), F.lit(2))).cast("int")))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(drawn), "id", "left").select("text", F.coalesce("half", F.lit(0)).alias("half"))
    found = moments(rows)
    halves = [found[k] for k in (1, 2) if k in found]
    if not halves:
        weights = np.zeros(WIDTH)
        weights[0] = 2 * (prior or NO_PRIOR) - 1
        return Model(weights, prior or NO_PRIOR)
    if prior is None and len(halves) == 2:
        prior = estimate_prior(rows, minimise(halves[0], found[0], NO_PRIOR))
    prior = prior or NO_PRIOR
    return Model(minimise(halves[0] + halves[1] if len(halves) == 2 else halves[0], found[0], prior), prior)


def score_batch(model: Model, column: pa.Array) -> np.ndarray:
    return np.clip((features(column) @ model.weights + 1) / 2, 0, 1)


def score(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """All columns of docs, with ``score`` and ``predicted`` (1 from threshold on) added (or replaced)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [c for c in docs.columns if c not in ("score", "predicted")]

    def run(batches):
        for batch in slices(batches, text_col):
            s = score_batch(shared.value, batch.column(text_col))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s), pa.array((s >= threshold).astype(np.int32))], names=[*names, "score", "predicted"])

    kept = docs.select(*names)
    return kept.mapInArrow(run, more(kept, "score double, predicted int"))
